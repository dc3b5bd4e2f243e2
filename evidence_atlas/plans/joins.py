"""Queries of joins, deduplication, scoring and spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo as G
from ..operators import match as M
from ..operators import merge as D
from ..sources import tables as S
from .catalog import query
from .stand_ins import ELEMENTS, ELEMENTS_SQL, lat, lat_sql, lon, lon_sql

_MATCH = f"(select p_partkey, element_id, any_value(element_ord) as element_ord, arg_min(surface, surf_ord) as surface, any_value(specificity) as specificity from part join {ELEMENTS_SQL} e on contains(replace(p_name, ' ', ''), replace(e.surface, ' ', '')) group by p_partkey, element_id)"


def _elements(spark):
    return S.dictionary_tables(spark, ELEMENTS)


@query("match_elements", f"select p_partkey, element_id, surface, 'surface' as matched_on, specificity::double as specificity from {_MATCH}")
def _(spark, table):
    out = M.match_elements(table("part").select(F.col("p_partkey").alias("name_id"), F.col("p_name").alias("name")), _elements(spark))
    return out.select(F.col("name_id").alias("p_partkey"), "element_id", F.trim("surface").alias("surface"), "matched_on", "specificity")


def _addresses(table):
    return table("part").select(
        F.col("p_partkey").alias("ord"), F.col("p_type").alias("pref_code"), F.lit("m").alias("municipality"), F.col("p_name").alias("oaza"),
        F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(" "), F.regexp_extract("p_brand", "[0-9]+", 0))).alias("koaza"), lat("p_partkey").alias("lat"), lon("p_partkey").alias("lon"),
    )


_NAMED = "(select p_partkey, p_type, p_name || case when p_size % 2 = 0 then regexp_extract(p_brand, '[0-9]+') else '' end as name from part)"
_SCREEN = f"""(select a.p_partkey, a.p_type, regexp_replace(replace(name, ' ', ''), '[0-9]+$', '') as base, m.specificity from {_NAMED} a join
  (select p_partkey, max(specificity) as specificity from {_MATCH} group by p_partkey) m using (p_partkey) where m.specificity >= 0.35)"""


@query("screen_addresses", f"select p_partkey, p_type, specificity::double as specificity from (select *, row_number() over (partition by p_type, base order by p_partkey) as n from {_SCREEN}) where n = 1")
def _(spark, table):
    out = M.screen_addresses(_addresses(table), _elements(spark), 0.35, series="[0-9]+$")
    return out.select(F.col("ord").alias("p_partkey"), F.col("pref_code").alias("p_type"), "specificity")


@query("screen_counts", f"select p_type, count(*) as kept from (select *, row_number() over (partition by p_type, base order by p_partkey) as n from {_SCREEN}) where n = 1 group by p_type")
def _(spark, table):
    out = M.screen_addresses(_addresses(table), _elements(spark), 0.35, series="[0-9]+$")
    return out.groupBy(F.col("pref_code").alias("p_type")).agg(F.count("*").alias("kept"))


@query("count_by_element", f"select element_id, count(*) as n from {_MATCH} group by element_id")
def _(spark, table):
    out = M.match_elements(table("part").select(F.col("p_partkey").alias("name_id"), F.col("p_name").alias("name")), _elements(spark))
    return D.count_listed(out.groupBy("name_id").agg(F.collect_list("element_id").alias("e")), "e", "element_id")


@query("matched_hazards", f"""select p_partkey, list_aggregate(list_sort(list_distinct(flatten(list(hazards)))), 'string_agg', '|') as hazards, max(specificity)::double as specificity
    from (select distinct p_partkey, element_id, specificity, hazards from part join {ELEMENTS_SQL} e on contains(replace(p_name, ' ', ''), replace(e.surface, ' ', ''))) group by p_partkey""")
def _(spark, table):
    m = M.match_elements(table("part").select(F.col("p_partkey").alias("name_id"), F.col("p_name").alias("name")), _elements(spark))
    best = M.best_matches(m)
    return best.select(F.col("name_id").alias("p_partkey"), F.array_join(F.array_sort("hazards"), "|").alias("hazards"), "specificity")


@query(
    "screen_old_names",
    f"""with best as (select p_partkey, max(specificity) as s from {_MATCH} group by p_partkey)
    select p_partkey from (select p_partkey, p_type, replace(p_name, ' ', '') as k, row_number() over (partition by p_type, replace(p_name, ' ', '') order by p_partkey) as n from part join best using (p_partkey)
      where s >= 0.35 and p_size % 2 = 0 and not exists (select 1 from part q where q.p_size = 7 and q.p_type = part.p_type and replace(q.p_name, ' ', '') = replace(part.p_name, ' ', ''))) where n = 1""",
)
def _(spark, table):
    p = table("part")
    places = p.select(F.col("p_partkey").alias("place_id"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd").alias("attribute"), lat("p_partkey").alias("lat"), lon("p_partkey").alias("lon"))
    near = p.select(F.col("p_partkey").alias("place_id"), F.lit("P").alias("pref"), F.col("p_type").alias("municipality"), F.col("p_brand").alias("oaza"))
    now = p.where("p_size = 7").select(F.lit("P").alias("pref"), F.col("p_type").alias("municipality"), F.col("p_name").alias("oaza"), F.lit(None).cast("string").alias("koaza"))
    return M.screen_old_names(places, now, near, _elements(spark), 0.35, ["even"]).select(F.col("place_id").alias("p_partkey"))


@query("name_survives", "select c_custkey, exists (select 1 from supplier where s_nationkey = c_nationkey and s_suppkey % 10 = c_custkey % 10) as survives, case when exists (select 1 from supplier where s_nationkey = c_nationkey and s_suppkey % 10 = c_custkey % 10) then 'current' else 'historical' end as status from customer")
def _(spark, table):
    town = lambda c: F.col(c).cast("string").alias("municipality")
    places = table("customer").select("c_custkey", F.lit("P").alias("pref"), town("c_nationkey"), (F.col("c_custkey") % 10).cast("string").alias("name"))
    now = table("supplier").select(F.lit("P").alias("pref"), town("s_nationkey"), (F.col("s_suppkey") % 10).cast("string").alias("oaza"), F.lit("").alias("koaza"))
    return M.name_survives(places, now).select("c_custkey", "survives", "status")


def _places_of_supplier(table):
    return table("supplier").select(
        F.col("s_suppkey").alias("ord"), F.lit("P").alias("pref"), F.col("s_nationkey").cast("string").alias("municipality"), F.concat(F.lit("z"), (F.col("s_suppkey") % 7).cast("string")).alias("oaza"),
        F.concat(F.lit("k"), (F.col("s_suppkey") % 5).cast("string")).alias("koaza"), F.col("s_name").alias("code"), lat("s_suppkey").alias("lat"), lon("s_suppkey").alias("lon"),
    )


@query(
    "geocode_lookup",
    f"""with o as (select s_nationkey as m, 'z' || s_suppkey % 7 as name, min(s_suppkey) as k from supplier group by all), k as (select s_nationkey as m, 'k' || s_suppkey % 5 as name, min(s_suppkey) as k from supplier group by all),
    t as (select s_nationkey as m, avg({lat_sql('s_suppkey')}) as lat, avg({lon_sql('s_suppkey')}) as lon from supplier group by 1),
    r as (select c_custkey, c_nationkey as m, case when c_custkey % 3 = 0 then 'k' || c_custkey % 5 end as ko, case when c_custkey % 3 = 1 then 'z' || c_custkey % 7 end as oz, 'xz' || c_custkey % 7 || 'y' as name from customer),
    f as (select r.*, a.k as k1, b.k as k2, (select min(o.k) from o where o.m = r.m and contains(r.name, o.name)) as k3, t.lat as tlat, t.lon as tlon
      from r left join k a on a.m = r.m and a.name = r.ko left join o b on b.m = r.m and b.name = r.oz left join t on t.m = r.m)
    select c_custkey, case when k1 is not null then 'koaza' when coalesce(k2, k3) is not null then 'oaza' else 'municipality' end as precision,
      round(case when coalesce(k1, k2, k3) is null then tlat else {lat_sql('coalesce(k1, k2, k3)')} end, 6) as lat, round(case when coalesce(k1, k2, k3) is null then tlon else {lon_sql('coalesce(k1, k2, k3)')} end, 6) as lon
    from f where coalesce(k1, k2, k3) is not null or tlat is not null""",
)
def _(spark, table):
    tables = M.address_tables(_places_of_supplier(table))
    k = F.col("c_custkey")
    r = table("customer").select(
        k.alias("record_id"), F.lit("P").alias("pref"), F.col("c_nationkey").cast("string").alias("municipality"), F.concat(F.lit("xz"), (k % 7).cast("string"), F.lit("y")).alias("name"),
        F.when(k % 3 == 0, F.concat(F.lit("k"), (k % 5).cast("string"))).alias("koaza"), F.when(k % 3 == 1, F.concat(F.lit("z"), (k % 7).cast("string"))).alias("oaza"),
    )
    out = M.geocode_lookup(r, tables)
    return out.select(F.col("record_id").alias("c_custkey"), "precision", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(
    "resolve_location",
    """select c_custkey, case when c_custkey % 4 = 0 then 'given' when c_custkey % 4 = 1 and c_custkey % 3 = 0 then 'koaza' when c_custkey % 2 = 0 and c_nationkey % 2 = 0 then 'feature' when c_custkey % 4 = 1 then 'oaza' else 'municipality' end as precision
    from customer where c_custkey % 4 in (0, 1) or (c_custkey % 2 = 0 and c_nationkey % 2 = 0) or c_custkey % 5 = 0""",
)
def _(spark, table):
    k = F.col("c_custkey")
    point = lambda p: F.struct(lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"), p.alias("precision"))
    c = table("customer")
    name = F.when(F.col("c_nationkey") % 2 == 0, F.concat("c_name", F.lit("沢"))).otherwise(F.col("c_name"))
    r = c.select(k.alias("record_id"), "c_custkey", name.alias("name"), F.when(k % 4 == 0, point(F.lit("given"))).alias("location"))
    local = c.where(k % 4 == 1).select(k.alias("record_id"), lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"), F.when(k % 3 == 0, "koaza").otherwise("oaza").alias("precision"))
    hit = lambda cond, form, title: c.where(cond).select(k.alias("record_id"), F.lit(form).alias("form"), title.alias("title"), lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"), k.alias("ord"))
    hits = hit(k % 2 == 0, "feature", F.concat(F.lit("x"), name)).union(hit(k % 5 == 0, "municipality", name))
    return M.resolve_location(r, local, hits).select("c_custkey", "location.precision")


_HAV = "2 * 6371 * asin(sqrt(least(1, power(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * power(sin(radians({d} - {c}) / 2), 2))))"


def _mentions_and_places(table):
    hazards = lambda c: F.array(F.when(F.col(c) % 2 == 0, F.lit("flood")).otherwise(F.lit("wind")))
    m = table("events").select(F.col("event_id").alias("mention_id"), F.col("event_id").alias("ord"), (F.col("user_id") % 25).cast("string").alias("municipality"), F.col("event_type").alias("name"), lat("event_id").alias("lat"), lon("event_id").alias("lon"), hazards("event_id").alias("hazards"), F.col("user_id").alias("source_id"), F.lit(None).cast("string").alias("locator"))
    name = F.when(F.col("c_mktsegment") == "BUILDING", "click").when(F.col("c_mktsegment") == "FURNITURE", "view").otherwise("purchase")
    p = table("customer").select(F.col("c_custkey").alias("place_id"), F.col("c_nationkey").cast("string").alias("municipality"), F.array(name, name).alias("names"), lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"), F.array(F.lit("flood")).alias("hazards"))
    return m, p


@query(
    "link_records",
    f"""with m as (select event_id, user_id % 25 as town, event_type as name, {lat_sql('event_id')} as lat, {lon_sql('event_id')} as lon, user_id as source from events),
    p as (select c_custkey, c_nationkey as town, case c_mktsegment when 'BUILDING' then 'click' when 'FURNITURE' then 'view' else 'purchase' end as name, {lat_sql('c_custkey')} as lat, {lon_sql('c_custkey')} as lon from customer),
    j as (select c_custkey, event_id, source, {_HAV.format(a='p.lat', b='m.lat', c='p.lon', d='m.lon')} > 900 as far from m join p using (town, name)),
    d as (select *, row_number() over (partition by c_custkey, far, source order by event_id) = 1 as first from j),
    t as (select *, row_number() over (partition by c_custkey, far, first order by event_id) <= 6 as within from d)
    select c_custkey, event_id, case when far then 'too_far' when not first then 'duplicate' when not within then 'over_cap' else 'linked' end as status,
      case when far or not first or not within then null when event_id % 2 = 0 then 'same_place_record' else 'nearby_record' end as relation from t""",
)
def _(spark, table):
    out = M.link_statuses(*_mentions_and_places(table), max_km=900.0)
    return out.select(F.col("place_id").alias("c_custkey"), F.col("mention_id").alias("event_id"), "status", "relation")


@query(
    "place_links",
    f"""with m as (select event_id, user_id % 25 as town, event_type as name, {lat_sql('event_id')} as lat, {lon_sql('event_id')} as lon, user_id as source from events),
    p as (select c_custkey, c_nationkey as town, case c_mktsegment when 'BUILDING' then 'click' when 'FURNITURE' then 'view' else 'purchase' end as name, {lat_sql('c_custkey')} as lat, {lon_sql('c_custkey')} as lon from customer),
    j as (select c_custkey, event_id, source, {_HAV.format(a='p.lat', b='m.lat', c='p.lon', d='m.lon')} > 900 as far from m join p using (town, name)),
    d as (select *, row_number() over (partition by c_custkey, far, source order by event_id) = 1 as first from j),
    t as (select *, row_number() over (partition by c_custkey, far, first order by event_id) <= 6 as within from d)
    select c_custkey, event_id, case when event_id % 2 = 0 then 'same_place_record' else 'nearby_record' end as relation from t where not far and first and within""",
)
def _linked(spark, table, stage=None):
    out = M.link_records(*_mentions_and_places(table), max_km=900.0, stage=stage)
    return out.select(F.col("place_id").alias("c_custkey"), F.col("mention_id").alias("event_id"), "relation")


@query(
    "attach_areas",
    """with a as (select c_nationkey as m, c_custkey % 20 as name, min(c_custkey) as k from customer group by all),
    r as (select o_orderkey, o_custkey % 25 as m, case when o_orderkey % 2 = 0 then o_orderkey % 23 end as oaza, case when o_orderkey % 3 = 0 then o_orderkey % 19 end as koaza, o_orderkey % 29 as name from orders)
    select o_orderkey, coalesce(x.k, y.k, z.k) as area_key from r left join a x on x.m = r.m and x.name = r.oaza left join a y on y.m = r.m and y.name = r.koaza left join a z on z.m = r.m and z.name = r.name""",
)
def _(spark, table):
    s = lambda c: c.cast("string")
    o, k = table("orders"), F.col("o_orderkey")
    r = o.select(k.alias("record_id"), F.lit("P").alias("pref"), s(F.col("o_custkey") % 25).alias("municipality"), s(F.when(k % 2 == 0, k % 23)).alias("oaza"), s(F.when(k % 3 == 0, k % 19)).alias("koaza"), s(k % 29).alias("name"))
    a = table("customer").select(F.col("c_custkey").alias("area_key"), F.col("c_custkey").alias("ord"), F.lit("P").alias("pref"), s(F.col("c_nationkey")).alias("municipality"), s(F.col("c_custkey") % 20).alias("name"))
    return M.attach_areas(r, a)[0].select(F.col("record_id").alias("o_orderkey"), "area_key")


_TAILS = ["", "x", "ld", "d"]


@query(
    "heading_lookup",
    """with p as (select p_partkey, p_type as prov, p_brand as dist, split_part(p_name, ' ', 1) as w from part),
    h as (select p_partkey as h, p_type as prov, p_brand as dist, split_part(p_name, ' ', 2) || left(split_part(p_name, ' ', 1), 2) as w0, case when p_size % 2 = 0 then left(split_part(p_name, ' ', 1), 2) || 'x' else left(split_part(p_name, ' ', 1), 2) end as w from part),
    c as (select h.*, cut * 8 + t.i * 2 + l.i as rank, l.i as lvl, left(w, (length(w) - cut)::int) || t.s as key from h, (values (0), (1), (2)) as c(cut), (values (0, ''), (1, 'x'), (2, 'ld'), (3, 'd')) as t(i, s), (values (0), (1)) as l(i) where cut = 0 or length(w) - cut >= 2),
    j as (select c.h, c.rank, p.p_partkey from c join p on p.prov = c.prov and p.w = c.key and (c.lvl = 1 or p.dist = c.dist)),
    b as (select h, min(rank) as rank from j group by h)
    select j.h as p_partkey, min(j.p_partkey) as place_id, count(*) as candidates from j join b on b.h = j.h and b.rank = j.rank group by j.h""",
)
def _(spark, table):
    p = table("part")
    word = F.split("p_name", " ")[0]
    places = p.select(F.col("p_partkey").alias("place_id"), F.col("p_partkey").alias("ord"), F.col("p_type").alias("province"), F.col("p_brand").alias("district"), word.alias("name"), F.array().cast("array<string>").alias("old_forms"), F.array().cast("array<string>").alias("readings"))
    head = F.when(F.col("p_size") % 2 == 0, F.concat(F.substring(word, 1, 2), F.lit("x"))).otherwise(F.substring(word, 1, 2))
    h = p.select(F.col("p_partkey").alias("heading_id"), F.col("p_type").alias("province"), F.col("p_brand").alias("district"), head.alias("heading"), F.lit("").alias("reading"))
    out = M.heading_lookup(h, M.place_keys(places), places, _TAILS)
    return out.select(F.col("heading_id").alias("p_partkey"), "place_id", "candidates")


@query("place_keys", "select p_type as province, d as district, w as spelling, p_partkey as place_id from (select p_type, p_brand as d, unnest(list_distinct([replace(p_name, ' ', ''), split_part(p_name, ' ', 1)])) as w, p_partkey from part) union all select p_type, null, unnest(list_distinct([replace(p_name, ' ', ''), split_part(p_name, ' ', 1)])), p_partkey from part")
def _(spark, table):
    places = table("part").select(F.col("p_partkey").alias("place_id"), F.col("p_partkey").alias("ord"), F.col("p_type").alias("province"), F.col("p_brand").alias("district"), F.col("p_name").alias("name"), F.array(F.split("p_name", " ")[0]).alias("old_forms"))
    return M.place_keys(places).select("province", "district", "spelling", "place_id")


@query("children_of", "select a.p_partkey as place_id, b.p_partkey as child_id from part a join part b on a.p_type = b.p_type and a.p_name = 'red ' || split_part(b.p_name, ' ', 2) where b.p_size > 40 and a.p_size = 3")
def _(spark, table):
    p = table("part").select(F.col("p_partkey").alias("place_id"), F.col("p_type").alias("province"), F.when(F.col("p_size") == 3, F.col("p_name")).alias("name"), F.when(F.col("p_size") > 40, F.concat(F.lit("red "), F.split("p_name", " ")[1])).alias("parent_entry"))
    return M.children_of(p)


@query("resolve_finding_place", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when l_linenumber = o_custkey % 7 then o_custkey when l_linenumber < 4 then l_linenumber end as place_id, case when l_linenumber <> o_custkey % 7 and l_linenumber >= 4 then 'unknown_place' end as reason from lineitem join orders on l_orderkey = o_orderkey")
def _(spark, table):
    f = table("lineitem").select(F.col("l_orderkey").alias("entry_id"), "l_partkey", "l_suppkey", F.col("l_linenumber").cast("string").alias("name"))
    e = table("orders").select(F.col("o_orderkey").alias("entry_id"), F.col("o_custkey").alias("place_id"), (F.col("o_custkey") % 7).cast("string").alias("heading"))
    kids = table("orders").select(F.col("o_custkey").alias("place_id")).distinct().select("place_id", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("i")).select("place_id", F.col("i").cast("long").alias("child_id"), F.col("i").cast("string").alias("child_name"))
    out = M.resolve_finding_place(f, e, kids)
    return out.select(F.col("entry_id").alias("l_orderkey"), "l_partkey", "l_suppkey", F.col("name").cast("int").alias("l_linenumber"), "place_id", "reason")


@query("province_in", "select s_suppkey, arg_max(n_name, (contains(t, n_name), length(n_name), n_name)) as province from (select s_suppkey, case when s_suppkey % 2 = 0 then 'at NATION_' || s_nationkey || ' x' else reverse('at NATION_' || s_nationkey) end as t from supplier) left join nation on contains(t, n_name) or contains(reverse(t), n_name) group by s_suppkey")
def _(spark, table):
    name = F.concat(F.lit("at NATION_"), "s_nationkey")
    t = table("supplier").select(F.col("s_suppkey").alias("text_id"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(name, F.lit(" x"))).otherwise(F.reverse(name)).alias("text"))
    return M.province_in(t, table("nation").select(F.col("n_name").alias("province"))).select(F.col("text_id").alias("s_suppkey"), "province")


@query("cite_sources", "select d.doc_id, quality, toxic from documents d left join labels l using (doc_id)")
def _(spark, table):
    e = table("documents").select("doc_id", F.col("doc_id").alias("source_id"))
    return M.cite_sources(e, table("labels").select(F.col("doc_id").alias("source_id"), "quality", "toxic")).select("doc_id", "quality", "toxic")


_NEAR = f"""(select c_custkey, s_suppkey, 111 * sqrt(power(b.lat - a.lat, 2) + power((b.lon - a.lon) * cos(radians(a.lat)), 2)) as km,
    trunc(b.lat / 0.1)::int - trunc(a.lat / 0.1)::int as dr, trunc(b.lon / 0.1)::int - trunc(a.lon / 0.1)::int as dc
  from (select c_custkey, {lat_sql('c_custkey')} as lat, {lon_sql('c_custkey')} as lon from customer) a join (select s_suppkey, {lat_sql('s_suppkey * 37')} as lat, {lon_sql('s_suppkey * 37')} as lon from supplier) b
  on abs(trunc(b.lat / 0.1)::int - trunc(a.lat / 0.1)::int) <= 3 and abs(trunc(b.lon / 0.1)::int - trunc(a.lon / 0.1)::int) <= 3)"""
_NEAREST = f"""(select c_custkey, s_suppkey, km from (select *, row_number() over (partition by c_custkey order by km, ring, dr, dc, s_suppkey) as n from (
    select *, greatest(abs(dr), abs(dc)) as ring, greatest(min(greatest(abs(dr), abs(dc))) over (partition by c_custkey), 1) as last from {_NEAR}) where ring <= last) where n = 1 and km <= 25)"""


def _customers(table):
    return table("customer").select(F.col("c_custkey").alias("point_id"), lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"))


def _suppliers(table):
    return table("supplier").select(F.col("s_suppkey").alias("address_id"), F.col("s_suppkey").alias("ord"), lat("s_suppkey * 37").alias("lat"), lon("s_suppkey * 37").alias("lon"), "s_nationkey", "s_name")


@query("nearest_address", f"select c_custkey, s_suppkey, round(km, 4) as km from {_NEAREST}")
def _(spark, table):
    out = G.nearest_address(_customers(table), _suppliers(table).select("address_id", "ord", "lat", "lon"))
    return out.select(F.col("point_id").alias("c_custkey"), F.col("address_id").alias("s_suppkey"), F.round("km", 4).alias("km"))


@query("admin_from_point", f"select c_custkey, n_name as municipality, s_name as oaza from {_NEAREST} join supplier using (s_suppkey) join nation on n_nationkey = s_nationkey")
def _(spark, table):
    a = _suppliers(table)
    near = G.nearest_address(_customers(table), a.select("address_id", "ord", "lat", "lon"))
    out = near.join(a, "address_id").join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return out.select(F.col("point_id").alias("c_custkey"), F.col("n_name").alias("municipality"), F.col("s_name").alias("oaza"))


_CLOSE = f"""(select c_custkey, s_suppkey, km, row_number() over (partition by c_custkey order by km, s_suppkey)::int as rank from (select c_custkey, s_suppkey, {_HAV.format(a='a.lat', b='b.lat', c='a.lon', d='b.lon')} as km
  from (select c_custkey, {lat_sql('c_custkey')} as lat, {lon_sql('c_custkey')} as lon from customer) a, (select s_suppkey, {lat_sql('s_suppkey * 37')} as lat, {lon_sql('s_suppkey * 37')} as lon from supplier) b) where km <= 30 qualify rank <= 5)"""


@query("nearby_monuments", f"select c_custkey, s_suppkey, round(km, 4) as km, rank from {_CLOSE}")
def _(spark, table):
    out = G.nearby(_customers(table), _suppliers(table).select(F.col("address_id").alias("monument_id"), "lat", "lon"), 30.0)
    return out.select(F.col("point_id").alias("c_custkey"), F.col("monument_id").alias("s_suppkey"), F.round("km", 4).alias("km"), "rank")


@query("haversine_km", f"select c_custkey, round({_HAV.format(a=lat_sql('c_custkey'), b='35.0', c=lon_sql('c_custkey'), d='135.0')}, 4) as km from customer")
def _(spark, table):
    return table("customer").select("c_custkey", F.round(G.haversine_km(lat("c_custkey"), lon("c_custkey"), F.lit(35.0), F.lit(135.0)), 4).alias("km"))


def _tile_sql(z: int, k: str) -> str:
    y = f"((1 - ln(tan(radians({lat_sql(k)})) + 1 / cos(radians({lat_sql(k)}))) / pi()) / 2 * {2**z})"
    x = f"(({lon_sql(k)} + 180) / 360 * {2**z})"
    return f"floor({x})::int as x, floor({y})::int as y, floor(({x} - floor({x})) * 256)::int as px, floor(({y} - floor({y})) * 256)::int as py"


@query("tile_pixel", f"select c_custkey, {_tile_sql(12, 'c_custkey')} from customer")
def _(spark, table):
    return table("customer").select("c_custkey", G.tile_pixel(lat("c_custkey"), lon("c_custkey"), 12).alias("t")).select("c_custkey", "t.*")


_ZONES = f"""(select c_custkey, case when y % 3 = 0 then false when y % 3 = 1 then null else (px * 7 + py) % 5 <> 0 end as flood, case when x % 2 = 0 then false else (px * 7 + py) % 5 <> 0 end as slide from (select c_custkey, {_tile_sql(8, 'c_custkey')} from customer))"""


def _zones(table):
    pts = _customers(table)
    tile = pts.select(G.tile_pixel("lat", "lon", 8).alias("t")).select("t.x", "t.y").distinct()
    alpha = F.transform(F.sequence(F.lit(0), F.lit(65535)), lambda i: F.when((i % 256 * 7 + F.floor(i / 256)) % 5 != 0, 200).otherwise(0))
    flood = tile.where("y % 3 <> 0").select(F.lit("flood").alias("layer"), "x", "y", F.when(F.col("y") % 3 == 1, "unreadable").otherwise("ok").alias("status"), alpha.alias("alpha"))
    slide = tile.where("x % 2 <> 0").select(F.lit("slide").alias("layer"), "x", "y", F.lit("ok").alias("status"), alpha.alias("alpha"))
    return G.sample_zones(pts, flood.union(slide), ["flood", "slide"], 8)


@query("sample_zones", f"select c_custkey, flood, slide from {_ZONES}")
def _(spark, table):
    return _zones(table).withColumnRenamed("point_id", "c_custkey")


@query("corroborate", f"select c_custkey, coalesce((select string_agg(s_suppkey::varchar, '|' order by rank) from {_CLOSE} k where k.c_custkey = z.c_custkey), '') as ids, flood, slide, '2024-01-01' as sampled_at from {_ZONES} z where c_custkey % 3 <> 0")
def _(spark, table):
    near = G.nearby(_customers(table), _suppliers(table).select(F.col("address_id").alias("monument_id"), "lat", "lon"), 30.0)
    r = _customers(table).select(F.col("point_id").alias("record_id"), F.when(F.col("point_id") % 3 != 0, F.col("lat")).alias("lat"), "lon")
    out = G.corroborate(r, near, _zones(table), "2024-01-01")
    return out.select(F.col("record_id").alias("c_custkey"), F.array_join("monument_ids", "|").alias("ids"), "flood", "slide", "sampled_at")


def _rings(table):
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    p = F.struct(at.alias("o"), F.struct((F.col("l_quantity") / 7).alias("lon"), (F.col("l_extendedprice") / 7000).alias("lat")).alias("p"))
    return table("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(p))["p"].alias("ring"))


_PTS = "(select l_orderkey, l_quantity / 7 as lon, l_extendedprice / 7000 as lat, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as i, count(*) over (partition by l_orderkey) as n from lineitem)"


@query(
    "ring_measures",
    f"""select a.l_orderkey, round(abs(sum(a.lon * b.lat - b.lon * a.lat)), 6) as area2, any_value(a.n)::int as points, round(min(a.lon), 6) as west, round(max(a.lat), 6) as north from {_PTS} a join {_PTS} b on a.l_orderkey = b.l_orderkey and b.i = a.i % a.n + 1 group by 1""",
)
def _(spark, table):
    r = _rings(table)
    return r.select("l_orderkey", F.round(G.ring_area2("ring"), 6).alias("area2"), F.size("ring").alias("points"), F.round(G.ring_box("ring")["west"], 6).alias("west"), F.round(G.ring_box("ring")["north"], 6).alias("north"))


@query("rings_from_parts", f"select l_orderkey, string_agg(len::varchar, '|' order by part) as sizes from (select l_orderkey, (i > 2)::int as part, count(*) as len from {_PTS} group by all having count(*) >= 4) group by 1")
def _(spark, table):
    cut = _rings(table).select("l_orderkey", G.rings_from_parts("ring", F.when(F.size("ring") > 2, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))).alias("rings"))
    return cut.where(F.size("rings") > 0).select("l_orderkey", F.array_join(F.transform("rings", lambda r: F.size(r).cast("string")), "|").alias("sizes"))


@query(
    "largest_rings",
    f"""with a as (select a.l_orderkey, a.l_orderkey // 4 as area, abs(sum(a.lon * b.lat - b.lon * a.lat)) as a2, any_value(a.n) as n from {_PTS} a join {_PTS} b on a.l_orderkey = b.l_orderkey and b.i = a.i % a.n + 1 group by 1)
    select area, string_agg(n::varchar, '|' order by rk) as sizes from (select *, row_number() over (partition by area order by round(a2, 6) desc, l_orderkey) as rk from a) where rk <= 2 group by area""",
)
def _(spark, table):
    r = _rings(table).groupBy(F.floor(F.col("l_orderkey") / 4).alias("area")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "ring"))), lambda x: x["ring"]).alias("rings"))
    return r.select("area", F.array_join(F.transform(G.largest_rings("rings", 2, 6), lambda x: F.size(x).cast("string")), "|").alias("sizes"))


@query(
    "round_ring",
    f"""with p as (select l_orderkey, i, round_even(lon, 0) as x, round_even(lat, 0) as y from {_PTS}), k as (select *, lag(x) over w as px, lag(y) over w as py, first_value(x) over w as fx, first_value(y) over w as fy from p window w as (partition by l_orderkey order by i)),
    d as (select * from k where i = 1 or x <> px or y <> py), e as (select l_orderkey, count(*) as n, arg_max(x, i) as lx, arg_max(y, i) as ly, any_value(fx) as fx, any_value(fy) as fy from d group by 1)
    select l_orderkey, (n + (lx <> fx or ly <> fy)::int)::int as points from e""",
)
def _(spark, table):
    return _rings(table).select("l_orderkey", F.size(G.round_ring("ring", 0)).alias("points"))


@query(
    "simplify_rings",
    f"""with recursive p as materialized {_PTS}, seg(l_orderkey, a, b) as (select distinct l_orderkey, 1::bigint, n from p where n > 4 union all
      select l_orderkey, unnest([a, f]), unnest([f, b]) from (select l_orderkey, a, b, arg_max(i, (off, -i)) as f, max(off) as m from (select s.*, p.i, case when q.lon = o.lon and q.lat = o.lat then sqrt(power(p.lon - o.lon, 2) + power(p.lat - o.lat, 2))
        else abs((q.lon - o.lon) * (p.lat - o.lat) - (q.lat - o.lat) * (p.lon - o.lon)) / sqrt(power(q.lon - o.lon, 2) + power(q.lat - o.lat, 2)) end as off from seg s join p on p.l_orderkey = s.l_orderkey and p.i > s.a and p.i < s.b join p o on o.l_orderkey = s.l_orderkey and o.i = s.a join p q on q.l_orderkey = s.l_orderkey and q.i = s.b) group by l_orderkey, a, b) where m > 0.5),
    k as (select distinct l_orderkey, unnest([a, b]) as i from seg), few as (select l_orderkey from k group by 1 having count(*) >= 4),
    t as (select p.* from p where l_orderkey not in (select l_orderkey from few) or exists (select 1 from k where k.l_orderkey = p.l_orderkey and k.i = p.i)),
    r as (select l_orderkey, i, n, round_even(lon, 5) as x, round_even(lat, 5) as y from t), g as (select *, lag(x) over w as px, lag(y) over w as py from r window w as (partition by l_orderkey order by i)),
    d as (select l_orderkey, any_value(n)::int as before, count(*) as m, arg_min(x, i) <> arg_max(x, i) or arg_min(y, i) <> arg_max(y, i) as open from g where px is null or x <> px or y <> py group by 1)
    select l_orderkey, before, (m + open::int)::int as after from d where m + open::int >= 4""",
)
def _(spark, table):
    r = _rings(table).select(F.col("l_orderkey").alias("area_key"), F.lit(0).alias("ring_ord"), "ring")
    return G.simplify_rings(r, 0.5).select(F.col("area_key").alias("l_orderkey"), "before", "after")


@query("simplify_borders", "select s_suppkey as area_key, 105 as before, true as thinner, true as same from supplier where s_suppkey + 1 in (select s_suppkey from supplier)")
def _(spark, table):
    """A row of areas between wavy borders: each border is thinned to the same points on both sides."""
    k = F.col("s_suppkey")
    wave = lambda c: F.transform(F.sequence(F.lit(0), F.lit(50)), lambda i: F.struct((c + F.when(i == 25, 0.25).otherwise(F.pmod(i * 7 + c, F.lit(3)) / 1000)).cast("double").alias("lon"), (i / 50).alias("lat")))
    ring = F.concat(wave(k), F.reverse(wave(k + 1)))
    north = F.array(F.struct((k + 0.5).alias("lon"), F.lit(1.2).alias("lat")), F.struct((k + 0.5).alias("lon"), F.lit(1.2).alias("lat")))
    areas = table("supplier").select(k.alias("area_key"), F.lit(0).alias("ring_ord"), F.concat(F.slice(ring, 1, 51), north, F.slice(ring, 52, 51), F.slice(ring, 1, 1)).alias("ring"))
    out = G.simplify_rings(areas, 0.01, shared=True)
    border = lambda c: F.filter("ring", lambda p: (p["lon"] - c >= 0) & (p["lon"] - c <= 0.3) & (p["lat"] <= 1))
    sides = lambda c: F.array_sort(F.array_distinct(border(c)))
    east = out.select("area_key", "before", (F.col("after") < 20).alias("thinner"), sides(F.col("area_key") + 1).alias("east"))
    west = out.select(sides(F.col("area_key")).alias("west"), (F.col("area_key") - 1).alias("before_it")).withColumnRenamed("before_it", "area_key")
    return east.join(west, "area_key").select("area_key", "before", "thinner", ((F.col("east") == F.col("west")) & (F.size("east") >= 3)).alias("same"))


# scoring and merging

_KIND = "case l_returnflag when 'R' then 'gazetteer' when 'A' then 'map' else 'legend' end"


def _evidence(table):
    kind = F.when(F.col("l_returnflag") == "R", "gazetteer").when(F.col("l_returnflag") == "A", "map").otherwise("legend")
    stance = F.when((F.col("l_linestatus") == "O") & (F.col("l_suppkey") % 3 == 0), "disputes").otherwise("supports")
    return table("lineitem").select(F.col("l_orderkey").alias("id"), kind.alias("kind"), stance.alias("stance"), (F.col("l_linenumber") % 4).alias("level"), F.when(F.col("l_partkey") % 2 == 0, "human").otherwise("llm").alias("extracted_by"))


_SCORE = """(with e as (select l_orderkey as id, l_returnflag in ('R', 'N') as origin, not (l_linestatus = 'O' and l_suppkey % 3 = 0) as ok, l_linenumber % 4 as level, l_partkey % 2 = 0 as human from lineitem),
  g as (select id, coalesce(max(case when ok and origin then least(level, 2) end), 0) as origin_level, bool_or(ok and human and level >= 3) as told, bool_or(not ok) as disputed from e group by id),
  r as (select user_id as id, true as struck from events where event_type = 'purchase' group by 1)
  select o_orderkey, coalesce(origin_level, 0)::int as origin_level, case when coalesce(origin_level, 0) < 1 then 0 when coalesce(told, false) or coalesce(struck, false) then 3 else origin_level end::int as evidence_level, coalesce(disputed, false) as disputed
  from orders left join g on g.id = o_orderkey left join r on r.id = o_orderkey)"""


def _scored(table):
    r = table("events").select(F.col("user_id").alias("id"), F.when(F.col("event_type") == "purchase", "named_after").otherwise("nearby_record").alias("relation"))
    return D.score(table("orders").select(F.col("o_orderkey").alias("id")), _evidence(table), r)


@query("origin_level", f"select o_orderkey, origin_level from {_SCORE}")
def _(spark, table):
    return _scored(table).select(F.col("id").alias("o_orderkey"), F.col("origin_level").cast("int").alias("origin_level"))


@query("evidence_level", f"select o_orderkey, evidence_level from {_SCORE}")
def _(spark, table):
    return _scored(table).select(F.col("id").alias("o_orderkey"), F.col("evidence_level").cast("int").alias("evidence_level"))


@query("apply_scores", f"select * from {_SCORE}")
def _(spark, table):
    return _scored(table).select(F.col("id").alias("o_orderkey"), F.col("origin_level").cast("int").alias("origin_level"), F.col("evidence_level").cast("int").alias("evidence_level"), "disputed")


_REC = "(select doc_id as ord, source as id, (n_chars % 4)::int as level from documents)"


@query(
    "merge_records",
    f"""with n as (select *, coalesce(level > max(level) over (partition by id order by ord rows between unbounded preceding and 1 preceding), true) as fresh from {_REC}),
    p as (select id, ord, case when fresh then -ord else ord end as place from n)
    select id, ord, row_number() over (partition by id order by place)::int as merged_pos, ord = (select max(m.ord) from n m where m.id = p.id and m.fresh) as winner from p""",
)
def _(spark, table):
    r = table("documents").select(F.col("doc_id").alias("ord"), F.col("source").alias("id"), (F.col("n_chars") % 4).cast("int").alias("level"))
    win, ev = D.merge_records(r, r.select("id", "ord", F.lit(0).alias("pos")))
    return ev.join(win.select("id", F.col("ord").alias("w")), "id").select("id", "ord", "merged_pos", (F.col("ord") == F.col("w")).alias("winner"))


@query("best_entry", "select place_id, doc_id from (select concat_ws('-', lang, source) as place_id, doc_id, row_number() over (partition by concat_ws('-', lang, source) order by length(text) desc, doc_id) as n from documents) where n = 1")
def _(spark, table):
    e = table("documents").select(F.concat_ws("-", "lang", "source").alias("place_id"), F.col("text").alias("body"), F.col("doc_id").alias("ord"))
    return D.best_entry(e).select("place_id", F.col("ord").alias("doc_id"))


@query("series_dedup", "select p_type, min(p_partkey) as p_partkey from part group by p_type")
def _(spark, table):
    return D.series_dedup(table("part").withColumn("ord", F.col("p_partkey")), "p_type").select("p_type", "p_partkey")


@query("union_sources", "select s_suppkey as id, s_name as name, null::varchar as segment, 0 as source_rank from supplier union all select c_custkey, c_name, c_mktsegment, 1 from customer")
def _(spark, table):
    a = table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return D.union_sources(a, b).select("id", "name", "segment", "source_rank")


@query(
    "learn_char_map",
    """with p as (select p_partkey as ord, split_part(p_name, ' ', 1) as o, split_part(p_name, ' ', 2) as n from part where length(split_part(p_name, ' ', 1)) = length(split_part(p_name, ' ', 2))),
    c as (select ord, i, substr(o, i::int, 1) as old_char, substr(n, i::int, 1) as new_char from p, range(1, 12) as r(i) where i <= length(o)),
    g as (select old_char, new_char, count(*) as k, min((ord, i)) as seen from c where old_char <> new_char group by all having count(*) >= 2)
    select old_char, new_char from (select *, row_number() over (partition by old_char order by k desc, seen) as r from g) where r = 1""",
)
def _(spark, table):
    w = F.split("p_name", " ")
    return D.learn_char_map(table("part").select(F.col("p_partkey").alias("ord"), w[0].alias("old"), w[1].alias("new")))

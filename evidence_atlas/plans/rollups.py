"""Queries of rollups, exports and the read side."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import browse as B
from ..operators import geo as G
from ..operators import match as M
from ..operators import merge as D
from ..operators.report import Stage, stage_report
from ..sources.publish import current_build, publish, read_items, read_records
from ..sources.tables import shared_folder
from .catalog import query
from .joins import _HAV, _SCORE, _linked, _places_of_supplier, _scored
from .stand_ins import lat, lat_sql, lon, lon_sql


@query(
    "totals",
    "select (select count(*) from orders) as records, (select count(*) from customer) as candidates, (select count(*) from supplier) as monuments, (select count(*) from nation) as areas, (select count(*) from orders where o_orderstatus = 'P') as disputed, (select count(*) from orders where o_custkey % 2 = 0) as with_area, (select count(*) from customer where c_acctbal > 0) as candidates_with_record",
)
def _(spark, table):
    o = table("orders").agg(F.count("*").alias("records"), F.count_if(F.col("o_orderstatus") == "P").alias("disputed"), F.count_if(F.col("o_custkey") % 2 == 0).alias("with_area"))
    c = table("customer").agg(F.count("*").alias("candidates"), F.count_if(F.col("c_acctbal") > 0).alias("candidates_with_record"))
    s, n = table("supplier").agg(F.count("*").alias("monuments")), table("nation").agg(F.count("*").alias("areas"))
    one = [x.withColumn("k", F.lit(1)) for x in (o, c, s, n)]  # one row each
    return one[0].join(one[1], "k").join(one[2], "k").join(one[3], "k").drop("k")


@query("count_by_level", f"select evidence_level, count(*) as n from {_SCORE} group by 1")
def _(spark, table):
    return _scored(table).groupBy(F.col("evidence_level").cast("int").alias("evidence_level")).agg(F.count("*").alias("n"))


@query("count_by_hazard", "select hazard, count(*) as n from (select user_id, unnest(list(distinct event_type)) as hazard from events group by user_id) group by hazard")
def _(spark, table):
    return D.count_listed(table("events").groupBy("user_id").agg(F.collect_list("event_type").alias("h")), "h", "hazard")


@query("count_by_relation", "select relation, count(*) as n from (select user_id, case when bool_or(event_type = 'purchase' and event_id % 50 = 0) then 'named_after' when bool_or(event_type = 'error' and event_id % 9 = 0) then 'same_place_record' when bool_or(event_id % 20 = 3) then 'nearby_record' end as relation from events group by user_id) where relation is not null group by 1")
def _(spark, table):
    e = F.col("event_id")
    relation = F.when((F.col("event_type") == "purchase") & (e % 50 == 0), "named_after").when((F.col("event_type") == "error") & (e % 9 == 0), "same_place_record").when(e % 20 == 3, "nearby_record")
    return D.count_by_relation(table("events").select(F.col("user_id").alias("id"), relation.alias("relation")))


@query("prefecture_rollup", "select coalesce(case when c_nationkey % 6 <> 0 then c_nationkey::varchar end, '00') as pref_code, count(*) as total, count(*) filter (c_custkey % 4 >= 2) as documented, count(*) filter (c_custkey % 4 >= 3) as level3 from customer group by 1")
def _(spark, table):
    return D.prefecture_rollup(table("customer").select(F.when(F.col("c_nationkey") % 6 != 0, F.col("c_nationkey").cast("string")).alias("pref_code"), (F.col("c_custkey") % 4).alias("evidence_level")))


@query("candidates_by_pref", "select n_name as pref_code, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1")
def _(spark, table):
    return table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("pref_code")).agg(F.count("*").alias("n"))


@query("areas_by_pref", "select s_nationkey as pref_code, count(*) as n from supplier group by 1")
def _(spark, table):
    return table("supplier").groupBy(F.col("s_nationkey").alias("pref_code")).agg(F.count("*").alias("n"))


_REPORT = f"""with m as (select event_id, user_id % 25 as town, event_type as name, {lat_sql('event_id')} as lat, {lon_sql('event_id')} as lon, user_id as source from events),
    p as (select c_custkey, c_nationkey as town, case c_mktsegment when 'BUILDING' then 'click' when 'FURNITURE' then 'view' else 'purchase' end as name, {lat_sql('c_custkey')} as lat, {lon_sql('c_custkey')} as lon from customer),
    j as (select c_custkey, event_id, source, {_HAV.format(a='p.lat', b='m.lat', c='p.lon', d='m.lon')} > 900 as far from m join p using (town, name)),
    d as (select *, row_number() over (partition by c_custkey, source order by event_id) = 1 as first from j where not far),
    t as (select *, row_number() over (partition by c_custkey order by event_id) as turn from d where first),
    r as (select o_orderkey, o_custkey % 25 as m, case when o_orderkey % 2 = 0 then o_orderkey % 23 end as oaza, o_orderkey % 29 as name from orders),
    x as (select o_orderkey, exists (select 1 from customer where c_nationkey = r.m and (c_custkey % 20 = r.oaza or c_custkey % 20 = r.name)) as found from r)
    select 'link' as stage, (select count(*) from t where turn <= 6) as produced, 0::bigint as skipped,
      'demoted=' || (select count(*) from t where turn <= 6 and event_id % 2 <> 0) || ',mentions=' || (select count(*) from events) || ',too_far=' || (select count(*) from j where far) || ',unmatched=' || (select count(*) from m where not exists (select 1 from p where p.town = m.town and p.name = m.name)) as detail
    union all select 'areas', count(*) filter (found), count(*) filter (not found), '' from x
    union all select 'hazard', count(*) filter (s_suppkey % 4 <> 0), count(*) filter (s_suppkey % 4 = 0), 'in_any_zone=' || count(*) filter (s_suppkey % 4 <> 0 and s_suppkey % 3 = 0) || ',with_monument=' || count(*) filter (s_suppkey % 4 <> 0 and s_suppkey % 5 = 0) from supplier
    union all select 'geocode', count(*) filter (c_nationkey in (select s_nationkey from supplier)), 0, 'koaza=0,municipality=' || count(*) filter (c_nationkey in (select s_nationkey from supplier) and not z) || ',oaza=' || count(*) filter (z)
      from (select c_nationkey, exists (select 1 from supplier where s_nationkey = c_nationkey and s_suppkey % 7 = c_custkey % 9) as z from customer)"""


@query("stage_report", _REPORT)
def _(spark, table):
    """Four stages are written; what they counted on the way is the report."""
    s = lambda c: c.cast("string")
    folder = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    link, areas, hazard, geocode = (Stage(name) for name in ("link", "areas", "hazard", "geocode"))
    _linked(spark, table, link).write.parquet(f"{folder}/link")
    k = F.col("o_orderkey")
    r = table("orders").select(k.alias("record_id"), F.lit("P").alias("pref"), s(F.col("o_custkey") % 25).alias("municipality"), s(F.when(k % 2 == 0, k % 23)).alias("oaza"), F.lit(None).cast("string").alias("koaza"), s(k % 29).alias("name"))
    a = table("customer").select(F.col("c_custkey").alias("area_key"), F.col("c_custkey").alias("ord"), F.lit("P").alias("pref"), s(F.col("c_nationkey")).alias("municipality"), s(F.col("c_custkey") % 20).alias("name"))
    M.attach_areas(r, a, areas)[0].write.parquet(f"{folder}/areas")
    k = F.col("s_suppkey")
    records = table("supplier").select(k.alias("record_id"), F.when(k % 4 != 0, lat("s_suppkey")).alias("lat"), lon("s_suppkey").alias("lon"))
    near = table("supplier").where(k % 5 == 0).select(k.alias("point_id"), k.alias("monument_id"), F.lit(1).alias("rank"))
    zones = table("supplier").select(k.alias("point_id"), (k % 3 == 0).alias("flood"), F.lit(None).cast("boolean").alias("slide"))
    G.corroborate(records, near, zones, "2024-01-01", hazard).write.parquet(f"{folder}/hazard")
    k = F.col("c_custkey")
    asked = table("customer").select(k.alias("record_id"), F.lit("P").alias("pref"), s(F.col("c_nationkey")).alias("municipality"), F.concat(F.lit("z"), s(k % 9)).alias("name"), F.lit(None).cast("string").alias("koaza"), F.lit(None).cast("string").alias("oaza"))
    M.geocode_lookup(asked, M.address_tables(_places_of_supplier(table)), geocode).write.parquet(f"{folder}/geocode")
    pairs = F.transform(F.map_entries("detail"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return stage_report(spark, [link, areas, hazard, geocode]).select("stage", "produced", "skipped", F.array_join(F.array_sort(pairs), ",").alias("detail"))


@query("municipality_centroid", f"select s_nationkey::varchar as municipality, round(avg({lat_sql('s_suppkey')}), 6) as lat, round(avg({lon_sql('s_suppkey')}), 6) as lon from supplier group by 1")
def _(spark, table):
    t = M.address_tables(_places_of_supplier(table))["municipality"]
    return t.select("municipality", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("address_tables", "select s_nationkey::varchar as municipality, 'z' || s_suppkey % 7 as name, min(s_suppkey) as ord from supplier group by all")
def _(spark, table):
    return M.address_tables(_places_of_supplier(table))["oaza"].select("municipality", "name", "ord")


# exports


def _features(table):
    props = {"id": F.col("s_suppkey"), "name": F.col("s_name"), "note": F.when(F.col("s_suppkey") % 2 == 0, F.lit("x"))}
    rows = table("supplier").withColumn("lat", F.when(F.col("s_suppkey") % 9 != 0, lat("s_suppkey"))).withColumn("lon", lon("s_suppkey"))
    return rows.withColumn("feature", B.point_feature("lat", "lon", props)).where("feature is not null").withColumn("ord", F.col("s_suppkey"))


_COORD = f"{{'lat': round({lat_sql('s_suppkey')}, 6), 'lon': round({lon_sql('s_suppkey')}, 6)}}"


@query("toponym_features", f"select s_suppkey, s_name as name, case when s_suppkey % 2 = 0 then 'x' end as note, round({lat_sql('s_suppkey')}, 6) as lat, true as nulls_kept from supplier where s_suppkey % 9 <> 0")
def _(spark, table):
    f = _features(table)
    get = lambda path: F.get_json_object("feature", path)
    return f.select("s_suppkey", get("$.properties.name").alias("name"), get("$.properties.note").alias("note"), get("$.geometry.coordinates[1]").cast("double").alias("lat"), F.contains("feature", F.lit('"note":')).alias("nulls_kept"))


@query("monument_features", "select c_custkey, c_mktsegment as kind, 'Point' as type from customer")
def _(spark, table):
    rows = table("customer").withColumn("lat", lat("c_custkey")).withColumn("lon", lon("c_custkey"))
    f = rows.withColumn("f", B.point_feature("lat", "lon", {"kind": F.col("c_mktsegment")}))
    return f.select("c_custkey", F.get_json_object("f", "$.properties.kind").alias("kind"), F.get_json_object("f", "$.geometry.type").alias("type"))


@query("area_features", "select s_nationkey, count(*)::bigint as points, string_agg(s_suppkey::varchar, ',' order by s_suppkey) as ids from supplier group by 1")
def _(spark, table):
    p = F.struct("s_suppkey", lon("s_suppkey").alias("lon"), lat("s_suppkey").alias("lat"))
    rows = table("supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(p)).alias("ps"))
    f = rows.select("s_nationkey", B.polygon_feature(F.array(F.transform("ps", lambda x: F.struct(x["lon"].alias("lon"), x["lat"].alias("lat")))), {"ids": F.transform("ps", lambda x: x["s_suppkey"])}).alias("f"))
    ids = F.get_json_object("f", "$.properties.ids")
    return f.select("s_nationkey", F.json_array_length(F.get_json_object("f", "$.geometry.coordinates[0]")).cast("long").alias("points"), F.translate(ids, "[]", "").alias("ids"))


@query("feature_collections", "select coalesce(case when s_nationkey % 4 <> 0 then s_nationkey::varchar end, '00') as pref_code, count(*)::bigint as n, string_agg(s_suppkey::varchar, '|' order by s_suppkey) as ids from supplier where s_suppkey % 9 <> 0 group by 1")
def _(spark, table):
    root = f"{shared_folder(spark)}/atlas-{uuid.uuid4().hex}"
    f = _features(table).withColumn("pref_code", F.when(F.col("s_nationkey") % 4 != 0, F.col("s_nationkey").cast("string")))
    publish(spark, root, lambda b: B.feature_collections(b, "candidates", f))
    # every file is a collection of its own that any JSON reader takes
    files = spark.read.schema("type string, features array<struct<properties:struct<id:long>>>, key string").json(f"{current_build(spark, root)}/candidates", multiLine=True)
    each = files.where("type = 'FeatureCollection'").select(F.col("key").alias("pref_code"), F.explode("features.properties.id").alias("id"))
    return each.groupBy("pref_code").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")), "|").alias("ids"))


@query("detail_documents", "select s_suppkey as id, 'L' || s_suppkey % 3 as label, '洪水・河川氾濫' as hazard from supplier union all select c_custkey + 100000, 'L' || c_custkey % 3, '洪水・河川氾濫' from customer where c_custkey % 2 = 0")
def _(spark, table):
    h = F.array(F.lit("flood")).alias("hazards")
    r = table("supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 3).alias("evidence_level"), h, F.array().cast("array<string>").alias("records"))
    c = table("customer").select((F.col("c_custkey") + 100000).alias("id"), (F.col("c_custkey") % 3).alias("evidence_level"), h, F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("r"))).otherwise(F.array().cast("array<string>")).alias("records"))
    root = f"{shared_folder(spark)}/atlas-{uuid.uuid4().hex}"
    publish(spark, root, lambda b: B.detail_files(b, B.detail_documents(r, c, {0: "L0", 1: "L1", 2: "L2"}), 8))
    d = read_records(spark, root, "details")
    return d.select(F.col("id").cast("long").alias("id"), F.get_json_object("document", "$.level_label").alias("label"), F.get_json_object("document", "$.hazard_labels[0]").alias("hazard"))


@query(
    "export_dictionary",
    """select 'element' as kind, p_type as id, count(*) as n, list_aggregate(list_sort(list(distinct p_brand)), 'string_agg', '|') as names from part group by 2
    union all select 'source', s_suppkey::varchar, s_nationkey, s_name from supplier union all select 'label', 'flood', 1, '洪水・河川氾濫' union all select 'label', '2', 1, 'L2'""",
)
def _(spark, table):
    root = f"{shared_folder(spark)}/atlas-{uuid.uuid4().hex}"
    e = table("part").groupBy(F.col("p_type").alias("element_id")).agg(F.count("*").alias("n"), F.sort_array(F.collect_set("p_brand")).alias("surfaces")).withColumn("element_ord", F.col("element_id"))
    s = table("supplier").select(F.col("s_suppkey").alias("source_ord"), F.col("s_suppkey").cast("string").alias("source_id"), F.col("s_nationkey").alias("n"), F.col("s_name").alias("title"))
    publish(spark, root, lambda b: B.export_dictionary(b, e, s, {0: "L0", 2: "L2"}))
    read = lambda name, schema: spark.read.schema(schema).json(f"{current_build(spark, root)}/{name}", multiLine=True)
    doc = read("elements", "elements array<struct<element_id:string,n:long,surfaces:array<string>>>, hazardLabels map<string,string>, evidenceLevelLabels map<string,string>")
    out = doc.select(F.explode("elements").alias("x")).select(F.lit("element").alias("kind"), F.col("x.element_id").alias("id"), "x.n", F.array_join("x.surfaces", "|").alias("names"))
    out = out.union(read("sources", "sources array<struct<source_id:string,n:long,title:string>>").select(F.explode("sources").alias("x")).select(F.lit("source"), "x.source_id", "x.n", "x.title"))
    for labels, label in (("hazardLabels", "flood"), ("evidenceLevelLabels", "2")):
        out = out.union(doc.select(F.lit("label"), F.lit(label), F.lit(1).cast("long"), F.col(labels)[label]))
    return out


@query("published_keys", "select strftime(o_orderdate, '%Y-%m') as key, count(*) as n, o_orderdate < timestamp '1996-01-01' as stale from orders where not (o_orderdate < timestamp '1996-01-01' and strftime(o_orderdate, '%Y-%m') in (select strftime(o_orderdate, '%Y-%m') from orders where o_orderdate >= timestamp '1996-01-01')) group by all")
def _(spark, table):
    """Two builds: the first has the months before 1996, the second those from then on; what was read, and what has gone."""
    root = f"{shared_folder(spark)}/atlas-{uuid.uuid4().hex}"
    o = table("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("pref_code"), F.col("o_orderkey").alias("ord"), F.to_json(F.struct("o_orderkey")).alias("feature"), (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp")).alias("early"))
    publish(spark, root, lambda b: B.feature_collections(b, "areas", o.where("early")))
    first = o.where("early").groupBy(F.col("pref_code").alias("key")).agg(F.count("*").alias("n"))
    gone = publish(spark, root, lambda b: B.feature_collections(b, "areas", o.where("not early")))
    now = read_items(spark, root, "areas").groupBy("key").agg(F.count("*").alias("n"), F.lit(False).alias("stale"))
    return now.union(first.join(gone.select("key"), "key").select("key", "n", F.lit(True)))


@query("dataset_meta", "select list_aggregate(list_sort(list(distinct source)), 'string_agg', '|') as datasets, count(*) as n, '2024-01-01' as built_at, 'a \"b\"|c' as attribution from documents")
def _(spark, table):
    root = f"{shared_folder(spark)}/atlas-{uuid.uuid4().hex}"
    meta = B.dataset_meta(table("documents").select(F.col("source").alias("dataset")), "2024-01-01", ['a "b"', "c"])
    publish(spark, root, lambda b: B.meta_document(b, meta))
    doc = spark.read.schema("builtAt string, datasets array<string>, attribution array<string>, n long").json(f"{current_build(spark, root)}/meta", multiLine=True)
    return doc.select(F.array_join("datasets", "|").alias("datasets"), "n", F.col("builtAt").alias("built_at"), F.array_join("attribution", "|").alias("attribution"))


@query(
    "stats_document",
    f"""select 'toponymsTotal' as field, '' as label, count(*) as n from orders union all select 'disputedTotal', '', count(*) filter (disputed) from {_SCORE} union all select 'byLevel', evidence_level::varchar, count(*) from {_SCORE} group by 2
    union all select 'byPref.' || f, coalesce(case when c_nationkey % 6 <> 0 then c_nationkey::varchar end, '00'), count(*) filter (c_custkey % 4 >= lo) from customer, (values ('total', 0), ('documented', 2), ('level3', 3)) as t(f, lo) group by all
    union all select 'areasByPref', s_nationkey::varchar, count(*) from supplier group by 2""",
)
def _(spark, table):
    root = f"{shared_folder(spark)}/atlas-{uuid.uuid4().hex}"
    scored = _scored(table)
    totals = scored.agg(F.count("*").alias("toponymsTotal"), F.count_if("disputed").alias("disputedTotal"))
    n = F.count("*").alias("n")
    by_pref = D.prefecture_rollup(table("customer").select(F.when(F.col("c_nationkey") % 6 != 0, F.col("c_nationkey").cast("string")).alias("pref_code"), (F.col("c_custkey") % 4).alias("evidence_level")))
    rollups = {"byLevel": (scored.groupBy("evidence_level").agg(n), "evidence_level"), "byPref": (by_pref, "pref_code"), "areasByPref": (table("supplier").groupBy("s_nationkey").agg(n), "s_nationkey"), "byNothing": (scored.where("false").groupBy("id").agg(n), "id")}
    publish(spark, root, lambda b: B.stats_document(b, totals, rollups))
    counts = "map<string,long>"
    doc = spark.read.schema(f"toponymsTotal long, disputedTotal long, byLevel {counts}, byPref map<string,struct<total:long,documented:long,level3:long>>, areasByPref {counts}, byNothing {counts}").json(f"{current_build(spark, root)}/stats", multiLine=True)
    out = doc.select(F.lit("toponymsTotal").alias("field"), F.lit("").alias("label"), F.col("toponymsTotal").alias("n")).union(doc.select(F.lit("disputedTotal"), F.lit(""), "disputedTotal"))
    for field in ("byLevel", "areasByPref", "byNothing"):
        out = out.union(doc.select(F.lit(field), F.explode(field)))
    each = doc.select(F.explode("byPref"))
    for f in ("total", "documented", "level3"):
        out = out.union(each.select(F.lit(f"byPref.{f}"), "key", f"value.{f}"))
    return out


@query("stale_keys", "select distinct o_custkey from orders where o_orderdate < timestamp '1996-01-01' except select o_custkey from orders where o_orderdate >= timestamp '1998-06-01'")
def _(spark, table):
    o = table("orders")
    return B.stale_keys(o.where("o_orderdate < timestamp'1996-01-01'"), o.where("o_orderdate >= timestamp'1998-06-01'"), ["o_custkey"])


@query("size_guard", "select sum(strlen(text))::bigint as bytes, sum(strlen(text)) > 8388608 as over_limit from documents")
def _(spark, table):
    return B.size_guard(table("documents").select(F.col("text").alias("feature")))


# read side


def _rows(table):
    k = F.col("c_custkey")
    return table("customer").select(
        k.alias("id"), F.col("c_name").alias("name"), F.lit("r").alias("reading"), F.col("c_mktsegment").alias("municipality"), (k % 4).cast("int").alias("evidence_level"), F.when(k % 2 == 0, "current").otherwise("historical").alias("status"),
        F.col("c_nationkey").cast("string").alias("pref_code"), F.array(F.when(k % 3 == 0, F.lit("flood")).otherwise(F.lit("wind"))).alias("hazards"), F.array((k % 5).cast("string")).alias("elements"), (k % 7 == 0).alias("disputed"), (k % 2 == 0).alias("in_zone"), (k % 3 == 0).alias("has_record"),
        lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"),
    )


@query("facet_filter", "select c_custkey as id from customer where contains(c_mktsegment, 'BUILD') and c_custkey % 4 in (1, 2) and c_custkey % 3 = 0 and c_custkey % 5 in (1, 2, 3) and c_custkey % 2 = 0")
def _(spark, table):
    return B.facet_filter(_rows(table), "BUILD", levels=[1, 2], hazards=["flood"], elements=["1", "2", "3"], in_zone=True, with_record=True).select("id")


@query("result_list", "select c_custkey as id, (c_custkey % 4)::int as evidence_level from customer order by c_custkey % 4 desc, c_name, c_custkey limit 300")
def _(spark, table):
    return B.result_list(_rows(table)).select("id", "evidence_level")


@query("codes_in_bounds", f"select distinct c_nationkey::varchar as pref_code from customer where {lat_sql('c_custkey')} between 30 and 31 and {lon_sql('c_custkey')} between 130 and 133")
def _(spark, table):
    return B.codes_in_bounds(_rows(table), 130.0, 30.0, 133.0, 31.0)


@query("visible_areas", "select n_nationkey as area_key, n_name from nation where exists (select 1 from supplier where s_nationkey = n_nationkey and s_acctbal > 5000)")
def _(spark, table):
    a = table("nation").select(F.col("n_nationkey").alias("area_key"), "n_name")
    return B.visible_areas(a, table("supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("area_key")))


@query("find_by_id", "select 7 as id, coalesce((select s_name from supplier where s_suppkey = 7 and s_acctbal < -5000), (select c_name from customer where c_custkey = 7)) as name")
def _(spark, table):
    s = table("supplier").select(F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"), "s_acctbal")
    c = table("customer").select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"))
    return B.find_by_id([s.where("s_acctbal < -5000").drop("s_acctbal"), c], 7)


@query("top_elements", "select p_brand as element_id, count(*) as n from part group by 1 order by n desc, element_id limit 10")
def _(spark, table):
    e = table("part").select(F.col("p_brand").alias("element_id"), F.col("p_brand").alias("element_ord")).distinct()
    return B.top_elements(e, table("part").groupBy(F.col("p_brand").alias("element_id")).agg(F.count("*").alias("n")), 10).select("element_id", "n")


@query("facet_counts", "select 'level' as facet, (c_custkey % 4)::varchar as value, count(*) as n from customer group by 2 union all select 'segment', c_mktsegment, count(*) from customer group by 2")
def _(spark, table):
    c = table("customer")
    count = lambda v: c.groupBy(v.alias("value")).agg(F.count("*").alias("n"))
    return B.facet_counts({"level": count(F.col("c_custkey") % 4), "segment": count(F.col("c_mktsegment"))})


@query("glossary_search", "select p_partkey from part where contains(replace(lower(p_name || ' ' || p_type), ' ', ''), 'ringsm')")
def _(spark, table):
    e = table("part").withColumn("specificity", F.col("p_retailprice")).withColumn("element_ord", F.col("p_partkey"))
    return B.glossary_search(e, "Ring SM", ["p_name", "p_type"]).select("p_partkey")


@query("evidence_by_stance", "select l_orderkey as id, count(*) filter (l_linestatus <> 'O') as supports, count(*) filter (l_linestatus = 'O') as disputes from lineitem group by 1")
def _(spark, table):
    return B.evidence_by_stance(table("lineitem").select(F.col("l_orderkey").alias("id"), F.when(F.col("l_linestatus") == "O", "disputes").otherwise("supports").alias("stance")))


@query("load_partition", "select c_custkey, c_nationkey::varchar as pref_code from customer where c_nationkey::varchar in ('3', '5', '99')")
def _(spark, table):
    path = f"{shared_folder(spark)}/customers-{uuid.uuid4().hex}"
    B.write_partitions(table("customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("pref_code")), path)
    return B.load_partition(spark, path, ["3", "5", "99"], "c_custkey long, pref_code string")


@query("validate_dataset", "select 'status' as \"column\", count(*) filter (o_orderstatus = 'P')::bigint as violations from orders union all select 'priority', count(*) filter (o_orderpriority = '5-LOW')::bigint from orders")
def _(spark, table):
    o = table("orders").select(F.col("o_orderstatus").alias("status"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"))
    _, bad = B.validate_dataset(o, {"priority": F.lit("2-HIGH")}, {"status": ["F", "O"], "priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]})
    return bad

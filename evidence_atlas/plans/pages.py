"""Queries of page layout and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import layout as L
from .catalog import query
from .stand_ins import jp, jp_sql

_ROLE = """(with b as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, left(l_returnflag || l_linestatus || 'xxxxxxx', (l_partkey % 8 + 1)::int) as text, l_quantity as x, l_extendedprice / 1000 as y, (l_suppkey % 60)::double as width, l_extendedprice / 200 as height from lineitem),
  m as (select *, coalesce(median(case when width > 0 then width end) over (partition by l_orderkey), 56) as m, max(x) over (partition by l_orderkey) as mx from b),
  g as (select *, x >= mx - 0.5 * m as inside from m), h as (select *, bool_and(not inside or length(text) <= 6) over (partition by l_orderkey) as has from g)
  select *, case when has and inside then 'running' when regexp_matches(text, '^[A-M]+x*$') and height / length(text) < 45 then 'ruby' when length(text) >= 2 and height / length(text) >= 55 and width >= 1.05 * m and regexp_matches(text, '^[NOR]+x*$') then 'heading' else 'body' end as role from h)"""


def _blocks(table):
    text = F.expr("substring(concat(l_returnflag, l_linestatus, 'xxxxxxx'), 1, cast(l_partkey % 8 + 1 as int))")
    return table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", text.alias("text"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_suppkey") % 60).cast("double").alias("width"), (F.col("l_extendedprice") / 200).alias("height"))


def _roles(table):
    return L.classify_blocks(_blocks(table), ["l_orderkey"], "^[A-M]+x*$", "^[NOR]+x*$")


@query("classify_blocks", f"select l_orderkey, l_partkey, l_suppkey, l_linenumber, role from {_ROLE}")
def _(spark, table):
    return _roles(table).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "role")


@query(
    "reading_beside",
    f"""with r as (select * from {_ROLE}) select h.l_orderkey, h.l_partkey, h.l_suppkey, h.l_linenumber, string_agg(b.text, '' order by b.y, b.x, b.text) as reading from r h join r b on h.l_orderkey = b.l_orderkey and b.role = 'ruby' and b.x > h.x and b.x - h.x <= h.width * 2.5 and b.y < h.y + h.height and b.y + b.height > h.y
    where h.role = 'body' group by 1, 2, 3, 4""",
)
def _(spark, table):
    r = _roles(table)
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    h = r.where("role = 'body'").withColumn("heading_id", F.struct(*keys))
    out = L.reading_beside(h.drop("l_partkey", "l_suppkey", "l_linenumber", "text", "role"), r.where("role = 'ruby'"), ["l_orderkey"])
    return out.select("heading_id.*", "reading")


_PAGE = """(select conv_id, turn, case when turn % 4 = 1 and conv_id % 3 <> 0 then 'p' || (conv_id + turn) % 3 end as pb, case when turn % 5 = 2 then 'p' || (conv_id + turn) % 2 end as pj, case when turn % 3 = 0 then 'd' || turn end as db, case when turn % 7 = 4 then 'x' || turn end as rx from conversations)"""


@query(
    "sticky_context",
    f"""with a as (select *, last_value(coalesce(pj, pb) ignore nulls) over w as province from {_PAGE} window w as (partition by conv_id order by turn rows between unbounded preceding and current row)),
    b as (select *, coalesce(pb, lag(province) over (partition by conv_id order by turn)) as mid from a), c as (select *, pj is not null and pj is distinct from mid as change from b),
    d as (select *, sum((pb is not null or change)::int) over (partition by conv_id order by turn rows between unbounded preceding and current row) as seg, case when not change then db end as kept from c)
    select conv_id, turn, province, coalesce(last_value(kept ignore nulls) over w, first_value(rx ignore nulls) over w) as district from d window w as (partition by conv_id, seg order by turn rows between unbounded preceding and current row)""",
)
def _(spark, table):
    t, s = F.col("turn"), F.col("conv_id") + F.col("turn")
    p = table("conversations").select("conv_id", "turn", F.when((t % 4 == 1) & (F.col("conv_id") % 3 != 0), F.concat(F.lit("p"), (s % 3).cast("string"))).alias("pb"), F.when(t % 5 == 2, F.concat(F.lit("p"), (s % 2).cast("string"))).alias("pj"), F.when(t % 3 == 0, F.concat(F.lit("d"), t.cast("string"))).alias("db"), F.when(t % 7 == 4, F.concat(F.lit("x"), t.cast("string"))).alias("rx"))
    return L.sticky_context(p, "conv_id", "turn").select("conv_id", "turn", "province", "district")


@query(
    "entries_from_blocks",
    """with b as (select conv_id, turn, coalesce(text, '') as text, role = 'user' as head, turn % 6 <> 5 as prov, case when turn % 4 <> 2 then conv_id * 100 + turn end as place from conversations),
    e as (select *, sum((head or not prov)::int) over (partition by conv_id order by turn rows between unbounded preceding and current row) as e from b)
    select conv_id, e1 as entry_ord, place_id, substr(body, 1, 500) as body from (select conv_id, e, min(case when head or not prov then turn end) as e1, max(case when head and prov then place end) as place_id, coalesce(string_agg(case when not head and prov then text end, '' order by turn), '') as body from e group by 1, 2) where place_id is not null""",
)
def _(spark, table):
    t = F.col("turn")
    b = table("conversations").select("conv_id", t.alias("ord"), t.alias("frame"), F.when(F.col("role") == "user", "heading").otherwise("body").alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.when(t % 4 != 2, F.col("conv_id") * 100 + t).alias("place_id"), (t % 6 != 5).alias("has_province"))
    return L.entries_from_blocks(b, "conv_id", 500).select("conv_id", "entry_ord", "place_id", "body")


@query("split_fields", "select c_custkey, pos::int as pos, case pos when 0 then 2 when 1 then 6 + length(c_name) else 8 + length(c_name) + length(c_mktsegment) * 2 end::int as \"column\", case pos when 0 then '沢' || c_name when 1 then repeat('山', length(c_mktsegment)) else 'x' end as text from customer, (values (0), (1), (2)) as p(pos)")
def _(spark, table):
    line = F.concat(F.lit("  沢"), "c_name", F.lit("  "), F.repeat(F.lit("山"), F.length("c_mktsegment")), F.lit("  x "))
    return L.split_fields(table("customer").select(F.col("c_custkey").alias("line_id"), line.alias("line"))).select(F.col("line_id").alias("c_custkey"), "pos", "column", "text")


@query(
    "layout_dictionary",
    f"""with p as (select *, min(p_partkey) over (partition by p_type, p_brand) as doc_id, string_split({jp_sql("p_name")}, ' ') as w from part),
    n as (select *, case when length(array_to_string(w, '')) > 10 and len(w) = 2 then w[1] else array_to_string(w, '') end as name, case when length(array_to_string(w, '')) > 10 and len(w) = 2 and w[1] <> w[2] then w[2] end as aza from p),
    k as (select *, length(name) between 1 and 10 and regexp_matches(name, '[ぁ-ヿ一-鿿]') and not regexp_matches(name, '[0-9#]') as ok from n),
    g as (select *, sum(ok::int) over (partition by doc_id order by p_partkey rows unbounded preceding) as g from k)
    select doc_id, (g - 1)::int as entry_ord, '新村' as village, 'シンムラ' as village_reading, '平井町' as area, 'koaza' as level, max(name) filter (ok) as name, max(aza) filter (ok) as aza, max(case when p_size % 3 = 0 then 'シン' end) filter (ok) as reading, 12 as page,
      string_agg(case when ok then '崩壊地名である' || p_size else '' end || case when p_size % 5 = 0 then '続き' || p_size else '' end, '' order by p_partkey) as description
    from g where g > 0 group by doc_id, g""",
)
def _(spark, table):
    """Entries of a column dictionary laid out from the parts of each type and brand: readings, names, prose, prose that goes on."""
    size = F.col("p_size").cast("string")
    row = F.concat(F.when(F.col("p_size") % 3 == 0, "ｼﾝ\n").otherwise(""), F.rpad(jp("p_name"), 40, " "), F.lit("崩壊地名である"), size, F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("\n                    続き"), size)).otherwise(""))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"]), "\n")
    docs = table("part").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("doc_id"), body.alias("b"))
    return L.layout_dictionary(docs.select("doc_id", F.concat(F.lit("山  崩                    前書きの文章である。\n新村（シンムラ）\n（平井町）\n字小字地名\n 12 \n"), "b").alias("text")))


del X

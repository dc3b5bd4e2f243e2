"""Information-theoretic sanitisation of personal data, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, stored, text_or_empty

#: The kinds in the order in which they are listed, with their
#: patterns. Quantifiers are possessive and a run of characters is tried from
#: its start only (or from where the last match ended), so that a long text
#: takes linear time; leftmost matches are the same.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a masked span of each kind is replaced with.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
TERM_MASK = "[TERM]"

#: A term: a run of two or more letters and digits. Context: so many characters on either side.
WORD = r"[\p{L}\p{N}]++"
TERM = r"[\p{L}\p{N}]{2,}+"
CONTEXT = 80

#: Least documents that a term must share with an entity, and least share of
#: the entity's information that it must reveal, to be generalised.
SUPPORT, DISCLOSURE = 2, 0.9


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled; the sum of all digits ends in 0."""
    at = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.try_cast("int").alias("d"), (i % 2).alias("odd")))
    worth = F.transform(at, lambda x: F.when(x["odd"] == 0, x["d"]).when(x["d"] > 4, 2 * x["d"] - 9).otherwise(2 * x["d"]))
    return F.aggregate(worth, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = F.regexp_replace(value, r"(^|\.)0+(?=[0-9])", "$1")
        return F.forall(F.split(part, r"\."), lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))
    n = F.length(_digits(value))
    if kind == "card":
        return n.between(13, 19) & _luhn(_digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _could_hold(kind: str, text: Column) -> Column:
    sign = {"email": "@", "phone": "+", "ip": "."}.get(kind)
    return F.contains(text, F.lit(sign)) if sign else F.lit(True)


_SPAN = "struct<kind:string,start:int,end:int,value:string,left:string,right:string>"


def _spans(kind: str, found: Column, gaps: Column) -> Column:
    """array of _SPAN: the valid matches, given the matches and the text between them.

    start and end are code points (end exclusive): sums of the lengths of what
    lies before. left and right are the context on either side.
    """
    state = f"struct<at:int,out:array<{_SPAN}>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out")).cast(state)
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("v"), F.slice(gaps, 2, F.size(found)).alias("after"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["v"])
        left = F.when(F.length(x["g"]) > CONTEXT, F.regexp_replace(F.right(x["g"], F.lit(CONTEXT)), r"^[\p{L}\p{N}]+", "")).otherwise(x["g"])
        right = F.when(F.length(x["after"]) > CONTEXT, F.regexp_replace(F.left(x["after"], F.lit(CONTEXT)), r"[\p{L}\p{N}]+$", "")).otherwise(x["after"])
        row = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["v"].alias("value"), left.alias("left"), right.alias("right")).cast(_SPAN)
        return F.struct(end.alias("at"), F.when(_valid(kind, x["v"]), F.array_append(acc["out"], row)).otherwise(acc["out"]).alias("out")).cast(state)

    return F.when(F.size(found) > 0, F.aggregate(parts, empty, step, lambda acc: acc["out"])).otherwise(empty["out"])


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column _base: array of _SPAN by kind, then start.

    One projection finds the matches, the next cuts the few texts that have
    any at their matches, so that each pattern runs once over most texts.
    """
    t = text_or_empty(text)
    none = F.array().cast("array<string>")
    out = docs.withColumns({f"_{k}": F.when(_could_hold(k, t), F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none) for k, p in KINDS.items()})
    out = out.withColumns({f"_{k}_gaps": F.when(F.size(f"_{k}") > 0, F.split(t, p, -1)) for k, p in KINDS.items()})
    out = out.withColumn("_base", F.concat(*[_spans(k, F.col(f"_{k}"), F.col(f"_{k}_gaps")) for k in KINDS]))
    return out.drop(*[f"_{k}" for k in KINDS], *[f"_{k}_gaps" for k in KINDS])


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def disclosing_terms(found: DataFrame, docs: DataFrame, doc_id: str, text: str, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(term, kind, value, disclosed): terms that give an entity away, over the whole corpus.

    ``found`` has a row (doc_id, kind, value, left, right) for each base span.
    With N documents, of which n(e) hold an entity and n(t) a term, and n(t,e)
    the documents that have the term in the entity's context, a term discloses
    log(N n(t,e) / (n(t) n(e))) of the entity's log(N / n(e)). A document is
    an id: rows that share one count once everywhere, rows without one never.
    Terms are counted in all texts, each once a document, and the counts are
    pre-aggregated before they meet the pairs.
    """
    ids = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("_t"))
    rows = ids.groupBy("doc_id").agg(F.count("*").alias("rows"))
    total = rows.count()
    again = stored(rows.where("rows > 1").select("doc_id"), "pii-again")
    entity = found.groupBy("kind", "value").agg(F.count_distinct("doc_id").alias("ne")).where((F.col("ne") >= support) & (F.col("ne") < total))
    near = found.join(entity, ["kind", "value"]).select("doc_id", "kind", "value", "ne", F.explode(_terms(F.concat_ws(" ", "left", "right"))).alias("term")).distinct()
    pairs = stored(near.groupBy("term", "kind", "value", "ne").agg(F.count("*").alias("nte")).where(F.col("nte") >= support), "pii-pairs")
    # ids of one row are counted as they come, the terms of others made distinct first
    term = F.explode(_terms(F.col("_t"))).alias("term")
    once = ids.join(again, "doc_id", "left_anti").select(term)
    every = once.unionByName(ids.join(again, "doc_id", "left_semi").select("doc_id", term).distinct().select("term"))
    counts = every.groupBy("term").agg(F.count("*").alias("nt"))
    share = F.ln(F.lit(total) * F.col("nte") / (F.col("nt") * F.col("ne"))) / F.ln(F.lit(total) / F.col("ne"))
    told = stored(pairs.join(counts, "term").withColumn("disclosed", F.round(share, 9)).where(F.col("disclosed") >= disclosure).select("term", "kind", "value", "disclosed"), "pii-terms")
    release(pairs, again)
    return told


def _may_hold(text: Column) -> Column:
    """Whether a text can have a base span: each kind has a digit or an @."""
    return text.rlike("[0-9@]")


def _term_spans(text: Column, terms: Column) -> Column:
    """array<struct<start, end>> of the words of a text that are among the terms, in code points."""
    state = "struct<at:int,out:array<struct<start:int,end:int>>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")).cast(state)
    parts = F.arrays_zip(F.split(text, WORD, -1).alias("g"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    told = F.transform(parts, lambda x: F.struct(F.length(x["g"]).alias("g"), F.coalesce(F.length(x["w"]), F.lit(0)).alias("n"), F.coalesce(F.array_contains(terms, F.lower(x["w"])), F.lit(False)).alias("on")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        row = F.struct(start.alias("start"), (start + x["n"]).alias("end"))
        return F.struct((start + x["n"]).alias("at"), F.when(x["on"], F.array_append(acc["out"], row)).otherwise(acc["out"]).alias("out")).cast(state)

    return F.aggregate(told, empty, step, lambda acc: acc["out"])


def all_spans(docs: DataFrame, doc_id: str, text: str, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(doc_id, copy, spans) of the rows that have spans, in the shared folder; copy names the text.

    Base spans are searched once and kept without the texts. Terms are told
    from them and from all texts; texts with terms are read once more for the
    places of these.
    """
    t = text_or_empty(text)
    held = with_base_spans(docs.where(_may_hold(t)).select(F.col(doc_id).alias("doc_id"), t.alias("_t")), "_t")
    # rows without spans go in a generator: a filter would be moved down and search every text twice
    some = F.explode(F.filter(F.array("_base"), lambda b: F.size(b) > 0)).alias("_base")
    based = stored(held.select("doc_id", F.xxhash64("_t").alias("copy"), some).dropDuplicates(["doc_id", "copy"]), "pii-base")
    found = based.where("doc_id is not null").select("doc_id", F.explode("_base").alias("s")).select("doc_id", "s.kind", "s.value", "s.left", "s.right")
    terms = disclosing_terms(found, docs, doc_id, text, support, disclosure)
    told = found.join(terms.select("term", "kind", "value"), ["kind", "value"]).groupBy("doc_id").agg(F.collect_set("term").alias("_terms"))
    told = stored(told, "pii-told")
    rows = docs.where(_may_hold(t)).select(F.col(doc_id).alias("doc_id"), t.alias("_t")).join(told, "doc_id")
    placed = rows.select("doc_id", F.xxhash64("_t").alias("copy"), _term_spans(F.col("_t"), F.col("_terms")).alias("_at")).dropDuplicates(["doc_id", "copy"])
    base = F.transform("_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    term = F.transform(F.coalesce("_at", nothing), lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    out = stored(based.join(placed, ["doc_id", "copy"], "left").select("doc_id", "copy", F.concat(base, term).alias("spans")), "pii-spans")
    release(based, terms, told)
    return out


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """Every column of ``docs`` plus spans and sanitised_text.

    spans is array<struct<kind, start, end>>: the base kinds in their order and
    then kind ``term``, each by start. sanitised_text has each span replaced
    with the mask of its kind; of spans that overlap, the one that starts first
    (of these, the one listed first) is replaced and the others go with it.

    Nulls count as empty texts; a null doc_id has base spans and takes no part
    in the statistics of terms. Whole texts are read, however long. Repeated
    rows each get their spans; rows that share an id count as one document,
    and each has the terms of all of them. Ties need no order: every term at
    or above the limit goes. An empty table gives an empty result. Columns
    named spans or sanitised_text are replaced.

    Texts without a digit or an @ have no spans and are passed on as they are;
    only the others meet the table of spans.
    """
    kept = [c for c in docs.columns if c not in ("spans", "sanitised_text")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    t = text_or_empty(text)
    spans = all_spans(docs, doc_id, text, support, disclosure).select(F.col("doc_id").alias("_id"), F.col("copy").alias("_at"), F.col("spans").alias("_spans"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    some = rows.where(_may_hold(t)).withColumn("_copy", F.xxhash64(t)).join(spans, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_copy") == F.col("_at")), "left")
    some = some.withColumn("spans", F.coalesce("_spans", none)).withColumn("sanitised_text", masked(t, F.col("spans")))
    names = [*[F.col(f"`{c}`") for c in kept], F.col("spans"), F.col("sanitised_text")]
    plain = rows.where(~_may_hold(t)).withColumns({"spans": none, "sanitised_text": t})
    return some.select(*names).unionByName(plain.select(*names))


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced; only rows that have spans are rebuilt."""
    rank = F.create_map(*[x for i, k in enumerate([*KINDS, "term"]) for x in (F.lit(k), F.lit(i))])
    mask = F.create_map(*[x for k, m in {**MASKS, "term": TERM_MASK}.items() for x in (F.lit(k), F.lit(m))])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    kind = "struct<at:int,parts:array<string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")).cast(kind)

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), mask[s["kind"]])
        fresh = F.struct(s["end"].alias("at"), F.array_append(acc["parts"], piece).alias("parts")).cast(kind)
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts")).cast(kind)
        return F.when(s["start"] >= acc["at"], fresh).otherwise(longer)

    rebuilt = F.aggregate(ordered, zero, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rebuilt).otherwise(text)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark, sf_dir):
    """Counts by kind, digest of the base spans and all spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = sanitise(docs)
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def _kind_sql(place: int, kind: str, pattern: str) -> str:
    return f"select doc_id, '{kind}' as kind, {place} as place, regexp_extract_all(t, '{pattern}') as v, string_split_regex(t, '{pattern}') as g from d where regexp_matches(t, '{pattern}')"


#: The same for DuckDB, with plain quantifiers.
OP1_SQL = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as (
  {_kind_sql(0, 'email', r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')}
  union all {_kind_sql(1, 'ip', r'[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+')}
  union all {_kind_sql(2, 'card', r'[0-9](?:[\x20-]?[0-9])+')}
  union all {_kind_sql(3, 'phone', r'\+[0-9][\x20().0-9-]+[0-9]')}
), e as (select *, unnest(range(1, len(v) + 1)) as i from m),
f as (
  select doc_id, kind, place, v[i] as value, g[i] as l, g[i + 1] as r, regexp_replace(v[i], '[^0-9]', '', 'g') as digits,
    (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0))::bigint as a
  from e
), b as (
  select *, a + length(value) as z from f where case kind
    when 'ip' then len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 or coalesce(try_cast(x as hugeint), 999) > 255)) = 0
    when 'card' then length(digits) between 13 and 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda j:
      case when (length(digits) - j) % 2 = 0 then digits[j]::int when digits[j]::int > 4 then 2 * digits[j]::int - 9 else 2 * digits[j]::int end)) % 10 = 0
    when 'phone' then length(digits) between 9 and 15 else true end
), total as (select count(distinct doc_id) as n from d),
entity as (select kind, value, count(distinct doc_id) as ne from b group by all having count(distinct doc_id) >= {SUPPORT}),
near as (
  select distinct doc_id, kind, value, ne, unnest(regexp_extract_all(lower(
    case when length(l) > {CONTEXT} then regexp_replace(right(l, {CONTEXT}), '^[\p{{L}}\p{{N}}]+', '') else l end || ' ' || case when length(r) > {CONTEXT} then regexp_replace(left(r, {CONTEXT}), '[\p{{L}}\p{{N}}]+$', '') else r end), '[\p{{L}}\p{{N}}]{{2,}}')) as term
  from b join entity using (kind, value)
), pairs as (select term, kind, value, ne, count(*) as nte from near group by all having count(*) >= {SUPPORT}),
counts as (select term, count(*) as nt from (select distinct doc_id, unnest(regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]{{2,}}')) as term from d) group by term),
told as (select term, kind, value from pairs join counts using (term), total where ne < n and round(ln(n * nte / (nt * ne)) / ln(n / ne), 9) >= {DISCLOSURE}),
flagged as (select distinct doc_id, term from (select distinct doc_id, kind, value from b) join told using (kind, value)),
cut as (select doc_id, regexp_extract_all(t, '[\p{{L}}\p{{N}}]+') as v, string_split_regex(t, '[\p{{L}}\p{{N}}]+') as g from d where doc_id in (select doc_id from flagged)),
word as (select doc_id, lower(v[i]) as term, length(v[i]) as n, (sum(length(g[i]) + length(v[i])) over (partition by doc_id order by i))::bigint as z from (select *, unnest(range(1, len(v) + 1)) as i from cut)),
spans as (
  select doc_id, kind, place, a, z from b union all select doc_id, 'term', 4, z - n, z from word join flagged using (doc_id, term)
), s as (
  select doc_id, string_agg(kind || ':' || a || ':' || z, ',' order by place, a) as spans, coalesce(string_agg(case when place < 4 then kind || ':' || a || ':' || z end, ',' order by place, a), '') as base,
    {', '.join(f"count(*) filter (kind = '{k}') as n_{k}" for k in KINDS)}
  from spans group by doc_id
)
select doc_id, {', '.join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join s using (doc_id)
"""

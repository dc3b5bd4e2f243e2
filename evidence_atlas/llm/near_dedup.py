"""Near-duplicate documents by banded SetSketch registers, verified on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WordHasher, mix64, release, small_batches, stored, text_or_empty, words_of
from .components import connected_components

#: SetSketch: registers, base of the exponential spacing, rate, and registers in a band.
#: At similarity 0.8 a pair shares no band with probability (1 - 0.8**4)**24 = 3e-6.
REGISTERS, BASE, RATE, BAND = 96, 1.02, 20.0, 4

#: A pair whose estimate is lower than the threshold by this (ten standard errors) is not verified.
MARGIN = 0.4

_GOLD, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _times(a: np.uint64, k: int) -> np.uint64:
    return np.uint64(int(a) * k & 0xFFFFFFFFFFFFFFFF)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle."""
    if not len(words):
        return words
    k = min(n, len(words))
    size = len(words) - k + 1
    h = np.full(size, _times(_SEED, k) if k < n else _SEED, np.uint64)
    for j in range(k):
        h = mix64(h * _GOLD + words[j : j + size])
    return np.unique(h)


def sketch(sets: list[np.ndarray], registers: int = REGISTERS, base: float = BASE, rate: float = RATE) -> np.ndarray:
    """SetSketch registers (one row for each set, unsigned 16-bit).

    Every element sends out points at exponential distances (rate x registers),
    each to a random register, so the least point of a register is exponential
    with the set's size times ``rate``. An element stops as soon as its next
    point lies beyond the largest minimum of its set: later points change
    nothing. A register keeps floor(1 - log_base(minimum)), not below 0.
    Registers of a union are the maxima of the parts' registers.
    """
    out = np.full(len(sets) * registers, np.inf)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    x, j = np.zeros(len(h)), 0
    while len(h):
        r = mix64(h + _times(_GOLD, 2 * j + 1))
        x = x - np.log(((r >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / (rate * registers)
        slot = ((mix64(r ^ _SEED) >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        np.minimum.at(out, of * registers + slot.astype(np.int64), x)
        on = x < out.reshape(-1, registers).max(1)[of]
        h, of, x, j = h[on], of[on], x[on], j + 1
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(out) / np.log(base))
    return np.clip(np.where(np.isfinite(k), k, 0), 0, 65535).astype("<u2").reshape(-1, registers)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, base: float = BASE) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of register rows, given the set sizes.

    With u and v the shares of the sizes, a register of the first is larger
    with probability p(u - vJ), of the second with p(v - uJ), where
    p(x) = -log_base(1 - x(base - 1)/base); J is searched on a grid of 1/200.
    """
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 201)[None, :] * top
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)
    p1, p2 = p(u - v * grid), p(v - u * grid)
    tiny = 1e-12
    fit = more * np.log(p1 + tiny) + less * np.log(p2 + tiny) + same * np.log(np.maximum(1 - p1 - p2, tiny))
    return np.take_along_axis(grid, fit.argmax(1)[:, None], 1)[:, 0]


def _sets(texts, hasher: WordHasher, n: int) -> Iterator[np.ndarray]:
    for t in texts:
        yield shingle_hashes(hasher.array(words_of(t)), n)


def _row_key(doc_id: str, text: str):
    """Names a row by what it says: rows share it only if id and text are the same."""
    return F.xxhash64(F.col(doc_id), text_or_empty(text))


def sketch_documents(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(doc_id, row, n_shingles, node, registers); node names the set: equal sets, equal nodes."""

    @F.pandas_udf("n_shingles long, node binary, registers binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        hasher = WordHasher()

        def finish(sets):
            return [(len(s), xxhash.xxh3_128_digest(s.tobytes()), r.tobytes()) if len(s) else (0, None, None) for s, r in zip(sets, sketch(sets), strict=True)]

        for texts in batches:
            out, part, size = [], [], 0
            for s in _sets(texts, hasher, n):
                part.append(s)
                size += len(s)
                if size > 150_000:
                    out += finish(part)
                    part, size = [], 0
            yield pd.DataFrame(out + finish(part), columns=["n_shingles", "node", "registers"])

    return docs.select(F.col(doc_id).alias("doc_id"), _row_key(doc_id, text).alias("row"), run(text_or_empty(text)).alias("s")).select("doc_id", "row", "s.*")


def bucket_members(classes: DataFrame) -> DataFrame:
    """(key, node) of every band's bucket that holds at least two classes."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.expr(f"substring(registers, {1 + 2 * BAND * i}, {2 * BAND})")) for i in range(REGISTERS // BAND)])
    every = classes.select("node", F.explode(keys).alias("key"))
    several = every.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    return every.join(several, "key")


#: Bits of the filter that ``passing`` sends to every task: 8 MB, whatever the tables' sizes.
FILTER_BITS = 1 << 26


def passing(rows: DataFrame, key: str, names: DataFrame, name: str) -> DataFrame:
    """The rows whose key may stand in ``names``, picked before they are shuffled for a join with it.

    One bit is set for each name, by its hash, in bitmaps of 32,768 bits that
    Spark aggregates and broadcasts: FILTER_BITS in all. A row whose bit is not
    set has no partner. The more names, the more rows pass in vain; none is lost.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bits = names.select(place(name).alias("_at")).groupBy(F.shiftright("_at", 15).alias("_part")).agg(F.bitmap_construct_agg(F.expr("_at & 32767")).alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast((_at & 32767) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    held = rows.withColumn("_at", place(key)).join(F.broadcast(bits), F.shiftright("_at", 15) == F.col("_part")).withColumn("_byte", byte)
    return held.where("shiftright(_byte, cast(_at & 7 as int)) & 1 = 1").select(*rows.columns)


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(node, items, registers, size) of the given nodes, from the whole text of one row of each class."""

    @F.pandas_udf("node binary, items array<long>")
    def full_set(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        hasher = WordHasher()
        for texts in batches:
            yield pd.DataFrame([(xxhash.xxh3_128_digest(s.tobytes()), s.view(np.int64)) for s in _sets(texts, hasher, n)], columns=["node", "items"])

    # else the comparison of its result would move it below the join, to every document
    full_set = full_set.asNondeterministic()
    # the texts meet names only, in a table whose size is known before the join is planned
    where = stored(nodes.join(classes, "node").select(F.col("node").alias("_node"), F.col("row").alias("_row")), "dedup-names")
    rows = docs.select(_row_key(doc_id, text).alias("_row"), text_or_empty(text).alias("_text"))
    of = passing(rows, "_row", where, "_row").join(where, "_row").select("_node", full_set("_text").alias("s"))
    return of.where("_node = s.node").select("s.*").dropDuplicates(["node"]).join(classes.select("node", "registers", F.col("n_shingles").alias("size")), "node")


def supported(sets: DataFrame, percent: int) -> DataFrame:
    """(node) of the sets that can be linked at all: enough of their items stand in another of the sets.

    What two sets share stands in both, so a set whose items are its own for
    more than the allowed part is linked with none of the others. Items that
    stand once are counted for the one set that has them.
    """
    short = F.xxhash64("node").alias("short")
    items = sets.select(short, F.explode("items").alias("item"))
    lonely = items.groupBy("item").agg(F.count("*").alias("times"), F.min("short").alias("short")).where("times = 1").groupBy("short").agg(F.count("*").alias("lonely"))
    rest = F.col("size") - F.coalesce("lonely", F.lit(0))
    return sets.select("node", short, "size").join(lonely, "short", "left").where(100 * rest >= percent * F.col("size")).select("node")


#: Pairs for which one copy of a pivot's set is sent, so that a pivot of very many pairs is no single key.
PARTNERS = 128


def _with_sets(pairs: DataFrame, sets: DataFrame, estimates: bool = False) -> DataFrame:
    """pairs(a, b, ...) with the items and sizes of both; a may stand in very many pairs."""
    more = ["registers"] if estimates else []
    side = lambda k: [F.col("node").alias(k), F.col("items").alias(f"i{k}"), F.col("size").alias(f"n{k}"), *[F.col(m).alias(f"r{k}") for m in more]]
    copies = pairs.groupBy("a").agg((F.floor(F.count("*") / PARTNERS) + 1).cast("int").alias("copies"))
    few = copies.withColumnRenamed("a", "node").join(passing(sets, "node", pairs, "a"), "node").select(*side("a"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
    salted = pairs.join(copies, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")).drop("copies")
    return salted.join(passing(sets, "node", pairs, "b").select(*side("b")), "b").join(few, ["a", "salt"]).drop("salt")


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) that are linked: by likelihood over the registers first, those near enough on their full sets."""

    @F.pandas_udf("double")
    def estimate(x: pd.Series, y: pd.Series, nx: pd.Series, ny: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        out = []
        for i in range(0, len(x), 2000):
            rows = [np.frombuffer(b"".join(c.iloc[i : i + 2000]), "<u2").reshape(-1, REGISTERS) for c in (x, y)]
            out.append(joint_estimate(*rows, nx.iloc[i : i + 2000].to_numpy(float), ny.iloc[i : i + 2000].to_numpy(float)))
        return pd.Series(np.concatenate(out))

    both = _with_sets(pairs.select("a", "b"), sets, estimates=True).where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    near = both.withColumn("est", estimate("ra", "rb", "na", "nb")).where(F.col("est") >= percent / 100 - MARGIN)
    common = F.size(F.array_intersect("ia", "ib")).cast("long")
    return near.where(100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b")


def _labelled(rows: DataFrame, component: DataFrame) -> DataFrame:
    """rows(node, ...) with the component of each node; a node without links is its own."""
    return rows.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))


def pivot_cells(members: DataFrame) -> DataFrame:
    """(a, node, component): the nodes of all buckets of a pivot a, where they are not one component yet.

    A bucket's pivot is the least node of the component that has most of its
    members, so that the many buckets of one family share one pivot, and two
    members of a bucket always meet in a cell.
    """
    by = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    pivots = by.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("a"), F.count("*").alias("parts")).where("parts > 1").select("key", "a")
    return members.join(pivots, "key").where("node <> a").select("a", "node", "component").distinct()


def open_pairs(cells: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Links with pivots, (a, b); pairs of a cell that may be linked though neither is the pivot; tables to release.

    A set is written as its difference D from the pivot. Two sets differ in
    |D1| + |D2| - 2 |D1 and D2| items, and are linked if these are at most
    (100 - p) / (100 + p) of their joint size. With G = (100 + p) |D| -
    (100 - p) size, the differences must have at least (G1 + G2) / (2 (100 +
    p)) items in common; this is above 0 unless both sets are linked with the
    pivot, and then they are in one component. Ordered by how often the items
    stand in differences of the cell, rarest first, the two therefore have
    an item in common in their first |D| - needed + 1 (the prefix rule), where
    edits that only one text has meet nothing. No pair is lost, and a cell is
    never gathered in one place: pairs meet on (pivot, item).
    """
    both = _with_sets(cells.select("a", F.col("node").alias("b"), "component"), sets)
    diff = F.array_union(F.array_except("ia", "ib"), F.array_except("ib", "ia"))
    d = F.size("diff").cast("long")
    size, link = F.col("nb"), (100 + percent) * d <= (100 - percent) * (F.col("na") + F.col("nb"))
    cut = rows = stored(
        both.withColumn("diff", diff).select("a", F.col("b").alias("node"), "component", size.alias("size"), d.alias("d"), ((100 + percent) * d - (100 - percent) * size).alias("g"), link.alias("linked"), "diff")
        .withColumn("out", ~F.col("linked") & (F.col("component") != F.col("a"))),
        "dedup-cells",
    )
    found = rows.where(F.col("linked") & (F.col("component") != F.col("a"))).select("a", F.col("node").alias("b"))
    least = lambda on: F.min(F.when(on, F.col("g")))
    open_ = rows.groupBy("a").agg(least(F.col("out")).alias("g_out"), least(F.col("linked")).alias("g_in"), least(~F.col("linked")).alias("g_far")).where("g_out is not null")
    rows = rows.join(open_, "a")
    reach = lambda other: F.col("d") - F.ceil((F.col("g") + F.col(other)) / (2.0 * (100 + percent)) - 1e-9) + 1
    rows = rows.withColumns({"to_in": F.when(F.col("out"), reach("g_in")), "to_far": F.when(F.col("out"), reach("g_far")).otherwise(reach("g_out"))})
    item = rows.select("a", "node", "component", "size", "d", "g", "linked", "out", "to_in", "to_far", F.explode("diff").alias("item"))
    times = item.groupBy("a", "item").agg(F.count("*").alias("times")).where("times > 1")
    order, whole = Window.partitionBy("a", "node").orderBy("times", "item"), Window.partitionBy("a", "node")
    placed = item.join(times, ["a", "item"]).withColumn("at", F.col("d") - F.count("*").over(whole) + F.row_number().over(order))
    placed = stored(placed.where(F.col("at") <= F.greatest(F.coalesce("to_in", F.lit(0)), F.coalesce("to_far", F.lit(0)))).drop("times"), "dedup-prefixes")
    own = ["node", "component", "size", "d", "g", "at", "out"]
    one = lambda where, k: placed.where(where).select("a", "item", *[F.col(c).alias(f"{c}{k}") for c in own])
    needed = F.ceil((F.col("g1") + F.col("g2")) / (2.0 * (100 + percent)) - 1e-9)
    fits = (F.col("at1") <= F.col("d1") - needed + 1) & (F.col("at2") <= F.col("d2") - needed + 1) & (100 * F.least("size1", "size2") >= percent * F.greatest("size1", "size2")) & (F.col("component1") != F.col("component2"))
    near = one("out and at <= to_in", 1).join(one("linked and at <= to_far", 2), ["a", "item"]).where(fits)
    far = one("out and at <= to_far", 1).join(one("not linked and at <= to_far", 2), ["a", "item"]).where(fits & (~F.col("out2") | (F.col("node1") < F.col("node2"))))
    pairs = near.select("node1", "node2").union(far.select("node1", "node2")).select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()
    return found, pairs, [cut, placed]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 4, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents whose sets of n-word shingles have a Jaccard similarity of at
    least ``threshold`` (whole percents) are linked; component_id is the
    smallest doc_id reachable and kept marks the document that has it. Fewer
    than n words make one shingle; null or empty texts and texts of white
    space have none and are linked with nothing. A null doc_id counts as no
    id: it never is a component_id unless nothing else is in the component,
    which then is null and kept. Repeated rows are returned as often as given;
    ties need no order, every link at the threshold counts. Whole texts are
    read, however long. An empty table gives an empty result. Other columns of
    ``docs`` are not read.

    Equal sets are one class from the start. A band of registers deals the
    classes into buckets. Classes that share too few shingles with all others
    drop out (``supported``), the members of a bucket are compared with its
    smallest member, and what is then in one component needs no more
    comparisons. The other pairs of a bucket are found through their
    differences from a common pivot (``open_pairs``), so that work follows the
    number of members and not of pairs.
    """
    small_batches(docs.sparkSession)
    percent = round(100 * threshold)
    rows = stored(sketch_documents(docs, doc_id, text, n), "dedup-rows")
    classes = stored(
        rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("row").alias("row"), F.min("registers").alias("registers"), F.min("n_shingles").alias("n_shingles")),
        "dedup-classes",
    )
    buckets = stored(bucket_members(classes), "dedup-buckets")
    sets = stored(full_sets(buckets.select("node").distinct(), classes, docs, doc_id, text, n), "dedup-sets")
    alive = stored(supported(sets, percent), "dedup-alive")
    members = stored(buckets.join(alive, "node", "left_semi"), "dedup-members")
    release(buckets)
    first = members.groupBy("key").agg(F.min("node").alias("a"))
    pairs = stored(members.join(first, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "dedup-pairs")
    links = stored(linked_pairs(pairs, sets, percent), "dedup-links")
    component = stored(connected_components(links, "a", "b"), "dedup-component")
    cells = stored(pivot_cells(_labelled(members, component)), "dedup-pivots")
    found, rest, used = open_pairs(cells, sets, percent)
    rest = stored(rest, "dedup-rest")
    more = stored(found.union(linked_pairs(rest, sets, percent)), "dedup-more")
    release(sets, alive, members, pairs, links, cells, rest, *used)
    component = _joined(component, more)
    return _result(rows, classes, component)


def _joined(component: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links between nodes: those of the components, joined to larger ones."""
    if more.isEmpty():
        return component
    of = lambda k: component.select(F.col("node").alias(k), F.col("component").alias(f"c{k}"))
    edges = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    larger = stored(connected_components(edges, "a", "b").withColumnRenamed("node", "part").withColumnRenamed("component", "whole"), "dedup-larger")
    parts = component.unionByName(larger.join(component.select(F.col("component").alias("part")).distinct(), "part", "left_anti").select(F.col("part").alias("node"), F.col("part").alias("component")))
    return stored(parts.join(larger, F.col("component") == F.col("part"), "left").select("node", F.coalesce("whole", "component").alias("component")), "dedup-component")


def _result(rows: DataFrame, classes: DataFrame, component: DataFrame) -> DataFrame:
    found = classes.select("node", "first_id")
    least = component.join(found, "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    moved = component.join(least, "component").select("node", "component_id")
    found = found.join(moved, "node", "left").select("node", F.coalesce("component_id", "first_id").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", "node").join(found, "node", "left")
    of = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", of.alias("component_id"), F.col("doc_id").eqNullSafe(of).alias("kept"))


def op9_near_dedup(spark, sf_dir):
    """Components of documents with at least 0.8 of their four-word shingles in common."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)


#: The same for DuckDB: shingles meet on equality, components by reachability.
OP9_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') as k from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from d where len(ws) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2
), l as (
  select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), r as (
  select a, b from l union select r.a, l.b from r join l on r.b = l.a
), m as (
  select a, min(b) as least from r group by a
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(m.least, doc_id)) as component_id, least(doc_id, coalesce(m.least, doc_id)) = doc_id as kept
from d left join n using (doc_id) left join m on m.a = doc_id
"""

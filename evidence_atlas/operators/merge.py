"""Scoring, merging and counting of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from .match import first_rows
from .report import Stage, watched

#: Kinds of evidence that can state where a name comes from.
ORIGIN_KINDS = "gazetteer local_history legend academic official news manual monument".split()


def score(ids: DataFrame, evidence: DataFrame, records: DataFrame, kinds: list[str] = ORIGIN_KINDS) -> DataFrame:
    """``ids`` with origin_level, evidence_level and disputed.

    ids(id[, disputed]); evidence(id, kind, stance, level, extracted_by);
    records(id, relation). The origin is the best supporting citation of an
    origin kind, at most 2. The level is 0 without one, 3 if a person's
    supporting citation says 3 or a record is of the same place, else the
    origin. A disputing citation only marks the record.
    """
    supports = F.col("stance") != "disputes"
    e = evidence.groupBy("id").agg(
        F.max(F.when(supports & F.col("kind").isin(kinds), F.least("level", F.lit(2)))).alias("_origin"),
        F.bool_or(supports & (F.col("extracted_by") == "human") & (F.col("level") >= 3)).alias("_told"),
        F.bool_or(F.col("stance") == "disputes").alias("_disputes"),
    )
    r = records.groupBy("id").agg(F.bool_or(F.col("relation").isin("named_after", "same_place_record")).alias("_struck"))
    rows = ids.join(e, "id", "left").join(r, "id", "left")
    origin = F.coalesce("_origin", F.lit(0))
    level = F.when(origin < 1, 0).when(F.coalesce("_told", F.lit(False)) | F.coalesce("_struck", F.lit(False)), 3).otherwise(origin)
    before = F.coalesce("disputed", F.lit(False)) if "disputed" in ids.columns else F.lit(False)
    out = rows.withColumn("origin_level", origin).withColumn("evidence_level", level).withColumn("disputed", before | F.coalesce("_disputes", F.lit(False)))
    return out.drop("_origin", "_told", "_disputes", "_struck")


def merge_records(records: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One record for each id: the strongest, the earlier one on ties; its evidence first, then the others'.

    records(id, ord, level, ...); evidence(id, ord, pos, ...) with the record's
    ord. A record that beats all before it comes to the front of the evidence,
    any other goes to its end.
    """
    before = Window.partitionBy("id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    marked = records.withColumn("_new", F.coalesce(F.col("level") > F.max("level").over(before), F.lit(True)))
    winner = first_rows(marked.where("_new"), ["id"], F.desc("ord")).drop("_new")
    place = marked.select("id", "ord", F.when(F.col("_new"), -F.col("ord")).otherwise(F.col("ord")).alias("_place"))
    order = Window.partitionBy("id").orderBy("_place", "pos")
    merged = evidence.join(place, ["id", "ord"]).withColumn("merged_pos", F.row_number().over(order)).drop("_place")
    return winner, merged


def best_entry(entries: DataFrame) -> DataFrame:
    """One entry for each place: the longest body, the earlier on ties."""
    return first_rows(entries, ["place_id"], F.desc(F.length("body")), "ord")


def series_dedup(rows: DataFrame, key: str) -> DataFrame:
    return first_rows(rows, [key], "ord")


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows with the rank of the frame they came from."""
    ranked = [f.withColumn("source_rank", F.lit(i)) for i, f in enumerate(frames)]
    out = ranked[0]
    for f in ranked[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def learn_char_map(pairs: DataFrame, min_support: int = 2) -> DataFrame:
    """(old_char, new_char): for each old character the most frequent other one at its place.

    pairs(ord, old, new) of equal length count; ties go to the pair seen first.
    """
    same = pairs.where("length(old) = length(new)")
    chars = same.select("ord", F.posexplode(F.arrays_zip(F.split("old", "").alias("o"), F.split("new", "").alias("n"))).alias("pos", "x")).select(F.struct("ord", "pos").alias("at"), F.col("x.o").alias("old_char"), F.col("x.n").alias("new_char"))
    count = chars.where("old_char <> new_char and old_char <> ''").groupBy("old_char", "new_char").agg(F.count("*").alias("n"), F.min("at").alias("at")).where(F.col("n") >= min_support)
    return first_rows(count, ["old_char"], F.desc("n"), "at").select("old_char", "new_char")


def count_listed(rows: DataFrame, column: str, name: str) -> DataFrame:
    """(name, n): rows by the distinct values of an array column."""
    return rows.select(F.explode(F.array_distinct(column)).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def prefecture_rollup(rows: DataFrame) -> DataFrame:
    code = F.coalesce("pref_code", F.lit("00")).alias("pref_code")
    return rows.groupBy(code).agg(F.count("*").alias("total"), F.count_if(F.col("evidence_level") >= 2).alias("documented"), F.count_if(F.col("evidence_level") >= 3).alias("level3"))


def count_by_relation(records: DataFrame) -> DataFrame:
    """(relation, n): places by their strongest relation; those without one are left out."""
    best = records.groupBy("id").agg(X.record_relation(F.collect_set("relation")).alias("relation"))
    return best.where("relation is not null").groupBy("relation").agg(F.count("*").alias("n"))


def rescore_linked(places: DataFrame, evidence: DataFrame, records: DataFrame, stage: Stage | None = None) -> DataFrame:
    """``places`` (id, evidence_level, ...) that have records, scored again with them, and ``raised``.

    records(id, relation) are link_records' rows by place. ``stage`` counts
    places_with_records and raised.
    """
    struck = places.withColumnRenamed("evidence_level", "level_before").join(records.select("id").distinct(), "id", "left_semi")
    out = score(struck, evidence, records).withColumn("raised", F.col("evidence_level") > F.col("level_before"))
    return watched(out, stage, places_with_records=F.lit(1), raised=F.col("raised"))

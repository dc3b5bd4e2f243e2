"""Reading a built dataset: filters, lists, facets, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocabulary as V
from ..sources.publish import Build
from .match import first_rows


def facet_filter(rows: DataFrame, query: str = "", levels=(), hazards=(), statuses=(), prefectures=(), elements=(), disputed=False, in_zone=False, with_record=False) -> DataFrame:
    """Rows that meet every facet; within a facet any value will do, an empty one is no filter."""
    out = rows
    if query:
        key = X.comparison_key(F.lit(query))
        out = out.where(F.contains(X.comparison_key(F.concat_ws(" ", "name", "reading", "municipality")), key))
    for values, column in ((levels, "evidence_level"), (statuses, "status"), (prefectures, "pref_code")):
        if values:
            out = out.where(F.col(column).isin(list(values)))
    for values, column in ((hazards, "hazards"), (elements, "elements")):
        if values:
            out = out.where(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values])))
    for on, column in ((disputed, "disputed"), (in_zone, "in_zone"), (with_record, "has_record")):
        if on:
            out = out.where(F.col(column))
    return out


def result_list(rows: DataFrame, n: int = 300, collation: str | None = None) -> DataFrame:
    """The first n by level, then name (in a collation if given), then id."""
    name = F.collate("name", collation) if collation else F.col("name")
    return rows.orderBy(F.desc("evidence_level"), name, "id").limit(n)


def codes_in_bounds(rows: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    return rows.where(F.col("lat").between(south, north) & F.col("lon").between(west, east)).select("pref_code").distinct().orderBy("pref_code")


def visible_areas(areas: DataFrame, rows: DataFrame) -> DataFrame:
    return areas.join(rows.select("area_key"), "area_key", "left_semi")


def find_by_id(frames: list[DataFrame], id_) -> DataFrame:
    """The row of an id in the first frame that has it."""
    ranked = [f.where(F.col("id") == id_).withColumn("_rank", F.lit(i)) for i, f in enumerate(frames)]
    out = ranked[0]
    for f in ranked[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return first_rows(out, ["id"], "_rank").drop("_rank")


def top_elements(elements: DataFrame, counts: DataFrame, n: int = 24) -> DataFrame:
    return elements.join(counts, "element_id").where("n > 0").orderBy(F.desc("n"), "element_ord").limit(n)


def facet_counts(counts: dict[str, DataFrame]) -> DataFrame:
    """(facet, value, n) from (value, n) counts by facet; values without rows are left out."""
    out = None
    for facet, rows in counts.items():
        one = rows.where("n > 0").select(F.lit(facet).alias("facet"), F.col("value").cast("string").alias("value"), F.col("n").cast("long").alias("n"))
        out = one if out is None else out.union(one)
    return out


def glossary_search(elements: DataFrame, query: str, fields: list[str]) -> DataFrame:
    text = X.strip_spaces(F.lower(F.concat_ws(" ", *fields)))
    return elements.where(F.contains(text, X.strip_spaces(F.lower(F.lit(query))))).orderBy(F.desc("specificity"), "element_ord")


def evidence_by_stance(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("id").agg(F.count_if(F.col("stance") != "disputes").alias("supports"), F.count_if(F.col("stance") == "disputes").alias("disputes"))


def write_partitions(rows: DataFrame, path: str, key: str = "pref_code") -> None:
    """A folder for each code (null: 00), each written by few tasks; what ``load_partition`` reads."""
    rows.withColumn(key, F.coalesce(F.col(key), F.lit("00"))).repartition(key, F.pmod(F.xxhash64(*rows.columns), F.lit(8))).write.partitionBy(key).parquet(path)


def load_partition(spark: SparkSession, path: str, codes: list[str], schema: str, key: str = "pref_code") -> DataFrame:
    """Only the partitions of the given codes; a missing one has no rows."""
    return spark.read.schema(schema).parquet(path).where(F.col(key).isin(codes))


def validate_dataset(rows: DataFrame, defaults: dict[str, Column], enums: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """Rows with defaults for missing values, and (column, violations) of values outside their list."""
    fixed = rows.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
    bad = F.array(*[F.struct(F.lit(c).alias("column"), (~F.col(c).isin(v)).cast("int").alias("bad")) for c, v in enums.items()])
    return fixed, fixed.select(F.explode(bad).alias("x")).groupBy("x.column").agg(F.coalesce(F.sum("x.bad"), F.lit(0)).alias("violations"))


# exports


def point_feature(lat, lon, properties: dict[str, Column], digits: int = 6) -> Column:
    """A GeoJSON point feature; null without a location, nulls kept."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, digits), F.round(lat, digits)).alias("coordinates"))
    body = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties"))
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.to_json(body, {"ignoreNullFields": "false"}))


def polygon_feature(rings, properties: dict[str, Column]) -> Column:
    coordinates = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["lon"], p["lat"])))
    geometry = F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates"))
    body = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties"))
    return F.to_json(body, {"ignoreNullFields": "false"})


def feature_collections(build: Build, name: str, features: DataFrame, key: str = "pref_code") -> None:
    """One collection for each code (null: 00), features(ord, feature, key) in order; a large code makes several files."""
    build.collection(name, features, key)


def export_dictionary(build: Build, elements: DataFrame, sources: DataFrame, level_labels: dict[int, str], hazard_labels: dict[str, str] = V.HAZARDS) -> None:
    """The documents ``elements`` (dictionary in its order, with the labels of hazards and levels) and ``sources``."""
    labels = {"hazardLabels": hazard_labels, "evidenceLevelLabels": {str(k): v for k, v in level_labels.items()}}
    build.document("elements", elements, "elements", ["element_ord"], labels)
    build.document("sources", sources, "sources", ["source_ord"])


def stats_document(build: Build, totals: DataFrame, rollups: dict[str, tuple[DataFrame, str]]) -> None:
    """The document ``stats``: the columns of the one row of ``totals``, and each rollup as an object by its key column.

    A rollup with one more column gives numbers, with several objects. It has
    a row for each label (level, hazard, prefecture, element), not for each
    record, so it may be one value.
    """
    fields = {c: totals.select(F.col(f"`{c}`").cast("string")) for c in totals.columns}
    for name, (rows, key) in rollups.items():
        rest = [c for c in rows.columns if c != key]
        value = F.col(rest[0]) if len(rest) == 1 else F.struct(*rest)
        entry = F.struct(F.coalesce(F.col(key).cast("string"), F.lit("00")).alias("key"), value.alias("value"))
        fields[name] = rows.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))))
    build.object("stats", fields)


def detail_documents(records: DataFrame, candidates: DataFrame, level_labels: dict[int, str]) -> DataFrame:
    """(id, document) of all records, and of candidates that have a disaster record."""
    both = records.unionByName(candidates.where(F.size("records") > 0), allowMissingColumns=True)
    label = F.coalesce(*[F.when(F.col("evidence_level") == k, F.lit(v)) for k, v in level_labels.items()])
    whole = both.withColumn("level_label", label).withColumn("hazard_labels", X.hazard_labels("hazards"))
    return whole.select("id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("document"))


def stale_keys(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    return previous.select(*keys).distinct().join(current.select(*keys), keys, "left_anti")


def size_guard(features: DataFrame, limit: int = 8 * 2**20) -> DataFrame:
    """(bytes, over_limit) of all features."""
    return features.agg(F.coalesce(F.sum(F.octet_length("feature")), F.lit(0)).alias("bytes")).withColumn("over_limit", F.col("bytes") > limit)


def dataset_meta(rows: DataFrame, built_at: str, attribution: list[str] = ()) -> DataFrame:
    """One row: builtAt, the sorted distinct names of the datasets (few, whatever the rows), attribution, and n."""
    said = F.array(*map(F.lit, attribution)) if attribution else F.array().cast("array<string>")
    return rows.agg(F.sort_array(F.collect_set("dataset")).alias("datasets"), F.count("*").alias("n")).select(F.lit(built_at).alias("builtAt"), "datasets", said.alias("attribution"), "n")


def meta_document(build: Build, meta: DataFrame) -> None:
    """The document ``meta`` of a row of ``dataset_meta``."""
    field = lambda c: F.to_json(F.col(c)) if c in ("datasets", "attribution") else F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    build.object("meta", {c: meta.select(field(c)) for c in meta.columns})


def detail_files(build: Build, documents: DataFrame, buckets: int = 64) -> None:
    """The documents of ``detail_documents``, to be asked for by id."""
    build.records("details", documents, "id", "document", buckets)

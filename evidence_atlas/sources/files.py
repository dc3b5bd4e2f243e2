"""Scans of folders: delimited files, JSON documents and whole texts, checked against the columns they should have.

Every scan keeps what it could not read in ``_corrupt`` and says where a row
came from in ``_file`` and ``_modified``. A folder that does not exist (yet)
gives no rows. Folders named ``key=value`` below the path become columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from . import tables as S

CORRUPT, FILE, MODIFIED = "_corrupt", "_file", "_modified"


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def present(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder, or anything that the pattern names?"""
    p, fs = _path(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def _origin(rows: DataFrame) -> DataFrame:
    return rows.withColumns({FILE: F.col("_metadata.file_path"), MODIFIED: F.col("_metadata.file_modification_time")})


def _nothing(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], f"{schema}, {CORRUPT} string, {FILE} string, {MODIFIED} timestamp")


def scan_csv(spark: SparkSession, path: str, columns: dict[str, str], partitions: list[str] = (), multi_line: bool = False) -> DataFrame:
    """Rows of header CSV files as text: ``columns`` (header -> name), then the partition columns, then the origin.

    Columns are found by their header, in whatever order; a missing one is an
    error, and so is a file whose header differs from the first one's. Lines
    of too few or too many values keep what they have and stand whole in
    _corrupt. Only ``multi_line`` reads quoted line breaks; files cannot be
    split then.
    """
    names = [*columns.values(), *partitions]
    if not present(spark, path):
        return _nothing(spark, ", ".join(f"`{n}` string" for n in names))
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    header = [c for c in spark.read.csv(path, **options).columns if c not in partitions]
    if missing := [c for c in columns if c not in header]:
        raise ValueError(f"{path} lacks {', '.join(missing)}; it has {', '.join(header)}")
    schema = ", ".join(f"`{c}` string" for c in [*header, *partitions, CORRUPT])
    # with pruned columns a line of too many values would pass for a whole one
    rows = _origin(spark.read.option("columnPruning", False).csv(path, schema=schema, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options))
    return rows.select(*[F.col(f"`{c}`").alias(n) for c, n in columns.items()], *partitions, CORRUPT, FILE, MODIFIED)


def scan_json(spark: SparkSession, path: str, schema: str, partitions: list[str] = (), lines: bool = False) -> DataFrame:
    """Rows of JSON files: a document or an array of them to a file, or (``lines``) one to a line.

    ``schema`` names the fields that count; one of type variant takes what it
    finds. Documents that are no JSON, or have another type where the schema
    asks for one, stand in _corrupt.
    """
    whole = ", ".join([schema, *(f"`{p}` string" for p in partitions)])
    if not present(spark, path):
        return _nothing(spark, whole)
    rows = spark.read.json(path, schema=f"{whole}, {CORRUPT} string", multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return _origin(rows)


def scan_texts(spark: SparkSession, path: str) -> DataFrame:
    """(document, text, bytes, _file, _modified): every file below the path whole, named by its place there (by its full name if the path is a pattern). An empty file has no row."""
    if not present(spark, path):
        return spark.createDataFrame([], f"document string, text string, bytes long, {FILE} string, {MODIFIED} timestamp")
    rows = _origin(spark.read.text(path, wholetext=True, recursiveFileLookup=True).withColumn("bytes", F.col("_metadata.file_size")))
    base = _path(spark, path)[0].toUri().getRawPath().rstrip("/") + "/"
    at = F.locate(base, FILE)
    below = F.when(at > 0, F.substr(FILE, at + len(base))).otherwise(F.col(FILE))
    place = F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))
    return rows.select(place.alias("document"), F.col("value").alias("text"), "bytes", FILE, MODIFIED)


def scan_report(rows: DataFrame, column: str) -> DataFrame:
    """(_file, rows, filled, corrupt) of a scan: its rows, those with a value in ``column``, those not read whole."""
    return rows.groupBy(FILE).agg(F.count("*").alias("rows"), F.count(column).alias("filled"), F.count(CORRUPT).alias("corrupt"))


# what the files hold


def scan_addresses(spark: SparkSession, path: str, columns: dict[str, str], partitions: list[str] = (), multi_line: bool = False) -> DataFrame:
    """Addresses whose ``lat`` and ``lon`` (two of the names) parse and lie within bounds."""
    return S.address_rows(scan_csv(spark, path, columns, partitions, multi_line))


def scan_modern_index(spark: SparkSession, path: str, columns: dict[str, str], partitions: list[str] = (), multi_line: bool = False) -> DataFrame:
    """Index entries: blank texts null, coordinates that do not parse null."""
    raw = scan_csv(spark, path, columns, partitions, multi_line)
    origin = raw.select(*[c for c in raw.columns if c not in (CORRUPT, FILE)], F.struct(CORRUPT, FILE).alias("_origin"))
    return S.modern_index(origin).select("*", f"_origin.{CORRUPT}", f"_origin.{FILE}").drop("_origin")


def scan_monuments(spark: SparkSession, path: str, properties: dict[str, str]) -> DataFrame:
    """Point features of every FeatureCollection below the path; a broken file gives none."""
    return S.monuments(scan_json(spark, path, "features variant"), "features", properties, "$")


def scan_pages(spark: SparkSession, path: str, keep: dict[str, str], blocks: str, lines: bool = True) -> DataFrame:
    """Text blocks of page files. ``keep`` (field -> type) names a page; field ``blocks`` holds its blocks, as an array or as JSON text."""
    schema = ", ".join(f"`{c}` {t}" for c, t in keep.items())
    pages = scan_json(spark, path, f"{schema}, `{blocks}` variant", lines=lines)
    inner = F.when(F.schema_of_variant(blocks) == "STRING", F.try_parse_json(F.try_variant_get(blocks, "$", "string"))).otherwise(F.col(blocks))
    return S.ocr_blocks(pages.withColumn(blocks, inner), blocks, list(keep))


def scan_documents(spark: SparkSession, path: str, bibliography: DataFrame) -> DataFrame:
    """Each row of ``bibliography`` (document and more) with its text, freed of lines that hold a page number only; ``missing`` without a file.

    Files that the bibliography does not name are not read into the result.
    """
    texts = scan_texts(spark, path).select("document", X.strip_page_numbers("text").alias("text"), F.lit(True).alias("_there"))
    return bibliography.join(texts, "document", "left").withColumn("missing", F.col("_there").isNull()).drop("_there")


#: Fields of a dictionary element and of a source in their files, the names they get, their types, and which must be there.
ELEMENT = {"id": ("element_id", "string"), "label": ("label", "string"), "surfaces": ("surfaces", "array<string>"), "readings": ("readings", "array<string>"), "meaning": ("meaning", "string"), "hazard_types": ("hazards", "array<string>"), "specificity": ("specificity", "double"), "substitution_of": ("substitution_of", "string"), "source_ids": ("source_ids", "array<string>"), "note": ("note", "string")}
SOURCE = {"id": ("source_id", "string"), "type": ("type", "string"), "title": ("title", "string"), "author": ("author", "string"), "year": ("year", "int"), "publisher": ("publisher", "string"), "url": ("url", "string"), "doi": ("doi", "string"), "license": ("license", "string"), "accessed": ("accessed", "string"), "note": ("note", "string")}
#: The kinds of source there are.
SOURCE_TYPES = "book paper web gov db pdf monument news map".split()


def _listed(spark: SparkSession, path: str, key: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """(ord, fields ...) of the items of a JSON file that is an array, or an object with the array under ``key``."""
    if not present(spark, path):
        return spark.createDataFrame([], "ord int, " + ", ".join(f"{n} {t}" for n, t in fields.values()))
    whole = F.try_parse_json(F.col("text"))
    items = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.try_variant_get(whole, f"$.{key}", "array<variant>"))
    each = spark.read.text(path, wholetext=True).select(F.col("value").alias("text")).select(F.posexplode(items).alias("ord", "item")).where(S.is_object())
    typed = [F.coalesce(S.field(f, t), F.array().cast(t)).alias(n) if t.startswith("array") else S.field(f, t).alias(n) for f, (n, t) in fields.items()]
    return each.select("ord", *typed)


def _problem(*checks: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(said)) for bad, said in checks])


def load_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of a dictionary file in its order, with ``problem`` for what breaks its rules; a missing file has none."""
    rows = _listed(spark, path, "elements", ELEMENT).withColumnRenamed("ord", "element_ord")
    absent = F.col("element_id").isNull() | F.col("label").isNull() | F.col("meaning").isNull()
    return rows.withColumn("problem", _problem((absent, "id, label or meaning is missing"), (F.col("specificity").isNull() | ~F.col("specificity").between(0, 1), "specificity is not between 0 and 1")))


def load_sources(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a bibliography file in its order, with ``problem`` for what breaks its rules; a missing file has none."""
    rows = _listed(spark, path, "sources", SOURCE).withColumnRenamed("ord", "source_ord")
    absent = F.col("source_id").isNull() | F.col("title").isNull()
    return rows.withColumn("problem", _problem((absent, "id or title is missing"), (F.col("type").isNull() | ~F.col("type").isin(SOURCE_TYPES), "no known type")))

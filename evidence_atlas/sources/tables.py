"""Scans: from files and payloads to typed rows, tolerant of bad items."""

from __future__ import annotations

import html
import re
import tempfile
from functools import lru_cache
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def _blank(c: str) -> Column:
    return F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))


def address_rows(raw: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows whose coordinates parse and lie within bounds."""
    typed = raw.withColumn(lat, X.tolerant_double(lat)).withColumn(lon, X.tolerant_double(lon))
    return typed.where(X.in_bounds(lat, lon))


def modern_index(raw: DataFrame) -> DataFrame:
    """Blank texts are null, coordinates are tolerant."""
    texts = {c: _blank(c) for c, t in raw.dtypes if t == "string" and c not in ("lat", "lon")}
    return raw.withColumns(texts).withColumns({c: X.tolerant_double(c) for c in ("lat", "lon")})


def assemble_places(places: DataFrame, parents: DataFrame, aliases: DataFrame, attributes: DataFrame, levels: list[str], sources: list[str] | None = None, reading_kind: str = "reading") -> DataFrame:
    """One row for each place: attribute name, the last parent of each level, readings[] and old_forms[].

    places(place_id, name, attribute_id, source); parents(place_id, ord, level,
    parent); aliases(place_id, ord, kind, alias); attributes(attribute_id, attribute).
    """
    kept = places.where(F.col("source").isin(sources)) if sources else places
    up = parents.groupBy("place_id").agg(*[F.max_by(F.when(F.col("level") == v, F.col("parent")), F.when(F.col("level") == v, F.col("ord"))).alias(v) for v in levels])
    ordered = lambda on: F.transform(F.array_sort(F.collect_list(F.when(on, F.struct("ord", "alias")))), lambda x: x["alias"])
    said = aliases.groupBy("place_id").agg(ordered(F.col("kind") == reading_kind).alias("readings"), ordered(F.col("kind") != reading_kind).alias("old_forms"))
    none = F.array().cast("array<string>")
    out = kept.join(attributes, "attribute_id", "left").join(up, "place_id", "left").join(said, "place_id", "left")
    return out.withColumn("readings", F.coalesce("readings", none)).withColumn("old_forms", F.coalesce("old_forms", none))


def exploded(rows: DataFrame, payload: str, path: str, keep: list[str]) -> DataFrame:
    """(keep, pos, item): the items of an array in a JSON payload (text or variant); what is no JSON or no array gives none."""
    parsed = F.col(payload) if dict(rows.dtypes)[payload] == "variant" else F.try_parse_json(payload)
    items = F.try_variant_get(parsed, path, "array<variant>")
    return rows.select(*keep, F.posexplode(items).alias("pos", "item"))


def field(name: str, kind: str = "string", item: str = "item") -> Column:
    return F.try_variant_get(item, f"$['{name}']", kind)


def is_object(item: str = "item") -> Column:
    return F.startswith(F.schema_of_variant(item), F.lit("OBJECT"))


def monuments(rows: DataFrame, payload: str, properties: dict[str, str], path: str = "$.features") -> DataFrame:
    """Features with two coordinates or more; properties trimmed, blank ones null."""
    items = exploded(rows, payload, path, [])
    at = F.try_variant_get("item", "$.geometry.coordinates", "array<double>")
    props = [F.nullif(F.regexp_replace(F.try_variant_get("item", f"$.properties['{p}']", "string"), r"(?U)^\s+|\s+$", ""), F.lit("")).alias(n) for p, n in properties.items()]
    return items.withColumn("_at", at).where(F.size("_at") >= 2).select(*props, F.element_at("_at", 2).alias("lat"), F.element_at("_at", 1).alias("lon"))


def ocr_blocks(rows: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Blocks of a page payload: items with a text and four numbers; width and height from the corners."""
    items = exploded(rows, payload, "$", keep)
    n = {c: F.try_variant_get("item", f"$.{c}", "string").try_cast("double") for c in ("xmin", "ymin", "xmax", "ymax")}
    out = items.select(*keep, F.col("pos").alias("block_ord"), field("contenttext").alias("text"), *[c.alias(k) for k, c in n.items()])
    whole = out.where("text is not null and text <> '' and xmin is not null and ymin is not null and xmax is not null and ymax is not null")
    return whole.select(*keep, "block_ord", "text", F.col("xmin").alias("x"), F.col("ymin").alias("y"), (F.col("xmax") - F.col("xmin")).alias("width"), (F.col("ymax") - F.col("ymin")).alias("height"))


def article_extracts(rows: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """The first page of a payload that is not missing and has an extract."""
    from ..operators.match import first_rows

    items = exploded(rows, payload, "$.query.pages", keep)
    out = items.select(*keep, "pos", field("title").alias("title"), field("extract").alias("text"), field("missing", "boolean").alias("missing"))
    return first_rows(out.where("coalesce(missing, false) = false and trim(coalesce(text, '')) <> ''"), keep, "pos").select(*keep, "title", "text")


def geocoder_hits(rows: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Hits of an array payload that have two coordinates; a blank code is null."""
    items = exploded(rows, payload, "$", keep)
    at = F.try_variant_get("item", "$.geometry.coordinates", "array<double>")
    out = items.select(*keep, "pos", F.try_variant_get("item", "$.properties.title", "string").alias("title"), F.nullif(F.try_variant_get("item", "$.properties.addressCode", "string"), F.lit("")).alias("code"), at.alias("_at"))
    return out.where(F.size("_at") >= 2).select(*keep, "pos", "title", "code", F.element_at("_at", 2).alias("lat"), F.element_at("_at", 1).alias("lon"))


def dictionary_tables(spark: SparkSession, elements: list[dict]) -> DataFrame:
    """Elements in dictionary order, with defaults for what is missing."""
    schema = "element_id string, element_ord int, label string, surfaces array<string>, readings array<string>, hazards array<string>, specificity double"
    rows = [(e["id"], i, e.get("label", e["id"]), e.get("surfaces", []), e.get("readings", []), e.get("hazards", []), float(e.get("specificity", 0.0))) for i, e in enumerate(elements)]
    return spark.createDataFrame(rows, schema)


def open_cache(spark: SparkSession, name: str, path: str, buckets: int = 64) -> str:
    """The table of extractions at ``path``, bucketed and sorted by key; made if it is not there, else opened as it is."""
    spark.sql(f"create table if not exists {name} (key string, payload string, written_at timestamp) using parquet clustered by (key) sorted by (key) into {int(buckets)} buckets location '{path}'")
    return name


def write_cache(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append extractions (key, payload, written_at); earlier ones of a key stay until the table is written anew, but count no more."""
    rows.select("key", "payload", F.col("written_at").cast("timestamp").alias("written_at")).write.insertInto(name)


def extraction_lookup(items: DataFrame, cache: DataFrame) -> DataFrame:
    """``items`` with key and the ``payload`` of their extraction; null: still to be asked for.

    items(item_id, source_id, signature, prompt); cache(key, payload,
    written_at), the last write of a key counts. Only a payload that is a JSON
    object is a hit. Over a table of ``open_cache`` both the choice of the
    last write and the join use its buckets: only the items are shuffled.
    """
    last = cache.groupBy("key").agg(F.max_by("payload", "written_at").alias("payload"))
    good = last.where(F.startswith(F.schema_of_variant(F.try_parse_json("payload")), F.lit("OBJECT")))
    return items.withColumn("key", X.cache_key("source_id", "signature", "prompt")).join(good, "key", "left")


def flatten_findings(payloads: DataFrame, payload: str, path: str, fields: dict[str, str], keep: list[str]) -> DataFrame:
    """One row for each finding; items that are no objects go."""
    items = exploded(payloads, payload, path, keep).where(is_object())
    return items.select(*keep, "pos", *[field(n, t).alias(n) for n, t in fields.items()])


#: Elements of a page that are not shown, those that break a line, and the character references met most.
HIDDEN = "script style noscript svg head".split()
BREAKS = "p div br li tr table h1 h2 h3 h4 h5 h6 section article dt dd".split()
REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "#39": "'", "copy": "©", "middot": "·", "amp": "&"}
#: A reference beyond those, or one that comes to light when ``&amp;`` is decoded.
_OTHER_REFERENCE = f"&(?!(?:{'|'.join(REFERENCES)});)|&amp;[#A-Za-z]"


@lru_cache
def _decoded_twice(unended: bool):
    """References decoded twice; without ``unended`` only those that end in a semicolon."""

    @F.pandas_udf("string")
    def udf(c: pd.Series) -> pd.Series:
        ended = lambda s: re.sub(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], s)
        once = html.unescape if unended else ended
        return c.map(lambda s: once(once(s)), na_action="ignore")

    return udf


def html_to_text(c, unended: bool = True) -> Column:
    """Visible text: hidden elements and comments gone, blocks on lines of their own, references decoded twice.

    Texts with any but the commonest references go to Python by batch; for
    all others it gets nulls. Without ``unended`` a reference that lacks its
    semicolon stays as it stands.
    """
    t = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", "")
    for tag in HIDDEN:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    t = F.regexp_replace(t, rf"(?i)</?(?:{'|'.join(BREAKS)})\b[^>]*>", "\n")
    bare = F.regexp_replace(t, r"<[^>]*>", "")
    t = bare
    for name, sign in REFERENCES.items():
        t = F.replace(t, F.lit(f"&{name};"), F.lit(sign))
    t = F.coalesce(_decoded_twice(unended)(F.when(F.rlike(bare, F.lit(_OTHER_REFERENCE)), bare)), t)
    lines = F.transform(F.split(F.regexp_replace(t, "[ \t　]+", " "), "\n"), lambda s: F.regexp_replace(s, r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only a local master may do without one and use its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")

"""Writing a dataset: framed JSON files by key, published together, stale ones removed.

A root folder holds numbered builds. A build is complete, and what readers
see, once its manifest has been written (last, by Spark's own commit); a
build that broke off is never read. Publishing removes the builds before it
and with them every file that the new one no longer has.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import _path

#: What stands around the features of a collection.
COLLECTION = ('{"type":"FeatureCollection","features":[', "]}")

MANIFEST = "collection string, key string, file string, bytes long"


def framed(rows: DataFrame, key: str, item: str, order: list[str], frame: tuple[str, str] = COLLECTION, tasks: int | None = None) -> DataFrame:
    """(key, value): lines that make one JSON document for each key, or several valid ones where a key is large.

    Rows are ranged by key and ``order`` over the tasks, so a key with a third
    of all rows is dealt to many; each task streams its stretch and puts the
    frame around each key's part of it. Nothing larger than a batch of items
    is ever held. A null key is 00.
    """
    named = rows.select(F.coalesce(F.col(key).cast("string"), F.lit("00")).alias(key), F.col(item).cast("string").alias("_item"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]).where("_item is not null")
    by = [key, *(f"_o{i}" for i in range(len(order)))]
    dealt = (named.repartitionByRange(tasks, *by) if tasks else named.repartitionByRange(*by)).sortWithinPartitions(*by).select(key, "_item")
    head, foot = frame

    def lines(batches):
        held, now, n = None, None, 0  # the last line waits: only the next row tells whether it ends its document
        for batch in batches:
            keys, out = [], []
            for k, item in zip(batch[key], batch["_item"], strict=True):
                if held is not None:
                    keys.append(now)
                    out.append(held + ("," if k == now else foot))
                held = item if k == now else head + "\n" + item
                now = k
            if out:
                yield pd.DataFrame({key: keys, "_line": range(n, n + len(out)), "value": out})
                n += len(out)
        if held is not None:
            yield pd.DataFrame({key: [now], "_line": [n], "value": [held + foot]})

    # the order of lines is stated again, so that the writer has nothing to sort
    return dealt.mapInPandas(lines, f"`{key}` string, _line long, value string").sortWithinPartitions(key, "_line").select(key, "value")


def _builds(spark: SparkSession, root: str) -> list[int]:
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[6:]) for n in names if n.startswith("build-") and n[6:].isdigit())


def _complete(spark: SparkSession, root: str, number: int) -> bool:
    p, fs = _path(spark, f"{root}/build-{number}/manifest/_SUCCESS")
    return fs.exists(p)


def current_build(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest complete build."""
    done = [n for n in _builds(spark, root) if _complete(spark, root, n)]
    return f"{root}/build-{done[-1]}" if done else None


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(collection, key, file, bytes) of every file that readers see."""
    at = current_build(spark, root)
    return spark.read.schema(MANIFEST).parquet(f"{at}/manifest") if at else spark.createDataFrame([], MANIFEST)


class Build:
    """One build of a dataset: write its collections, then ``publish`` them together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before = current_build(spark, self.root)
        self.number = max(_builds(spark, self.root), default=0) + 1
        self.path = f"{self.root}/build-{self.number}"
        self.collections: list[str] = []

    def collection(self, name: str, features: DataFrame, key: str = "pref_code", item: str = "feature", order: list[str] = ("ord",), tasks: int | None = None) -> None:
        """A GeoJSON collection for each key, its features in order."""
        self._write(name, framed(features, key, item, list(order), COLLECTION, tasks), key)

    def document(self, name: str, rows: DataFrame, field: str, order: list[str], more: dict | None = None) -> None:
        """One JSON object: ``field`` holds the rows as objects in order, ``more`` what stands beside them."""
        rest = json.dumps(more or {}, ensure_ascii=False)[1:-1]
        frame = (f'{{"{field}":[', "]" + (f",{rest}" if rest else "") + "}")
        item = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
        self._one(name, rows.select(item.alias("_json"), *order), order, frame)

    def object(self, name: str, fields: dict[str, DataFrame]) -> None:
        """One JSON object of the given fields; each is a table of one row and one column that holds JSON."""
        parts = None
        for i, (field, rows) in enumerate(fields.items()):
            one = rows.select(F.concat(F.lit(json.dumps(field, ensure_ascii=False) + ":"), F.col(rows.columns[0])).alias("_json"), F.lit(i).alias("ord"))
            parts = one if parts is None else parts.union(one)
        self._one(name, parts, ["ord"], ("{", "}"))

    def _one(self, name: str, items: DataFrame, order: list[str], frame: tuple[str, str]) -> None:
        if items.isEmpty():
            items = items.sparkSession.createDataFrame([("all", "".join(frame))], "key string, value string")
            return self._write(name, items, "key")
        return self._write(name, framed(items.withColumn("key", F.lit("all")), "key", "_json", order, frame, 1), "key")

    def records(self, name: str, rows: DataFrame, id_: str, document: str, buckets: int = 64) -> None:
        """Documents to be asked for by id: a line each, in a folder by the id's bucket."""
        keyed = rows.select(bucket(F.col(id_), buckets).alias("key"), F.col(id_).cast("string").alias("id"), F.col(document).alias("document"))
        self._write(name, keyed.repartition("key", F.pmod(F.xxhash64("id"), F.lit(8))).select("key", F.to_json(F.struct("id", "document")).alias("value")), "key")

    def _write(self, name: str, lines: DataFrame, key: str) -> None:
        lines.withColumnRenamed(key, "key").write.partitionBy("key").text(f"{self.path}/{name}")
        self.collections.append(name)

    def publish(self, keep: int = 0) -> DataFrame:
        """Make this build the one that is read, and remove all before it but ``keep``: (collection, key) no longer there."""
        spark = self.spark
        rows = spark.createDataFrame([], MANIFEST)
        for name in self.collections:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(f"{self.path}/{name}")
            key = F.url_decode(F.regexp_extract("path", "/key=([^/]*)/[^/]*$", 1))
            rows = rows.union(found.select(F.lit(name), key, F.substring_index("path", f"/build-{self.number}/", -1), F.col("length")))
        old = spark.read.schema(MANIFEST).parquet(f"{self.before}/manifest").select("collection", "key").distinct() if self.before else rows.select("collection", "key").where("false")
        # which keys go is settled and stored before their files do
        current = rows.select("collection", "key").distinct()
        old.join(current, ["collection", "key"], "left_anti").write.parquet(f"{self.path}/stale")
        rows.coalesce(1).write.parquet(f"{self.path}/manifest")
        for number in [n for n in _builds(spark, self.root) if n < self.number][: -keep or None]:
            p, fs = _path(spark, f"{self.root}/build-{number}")
            fs.delete(p, True)
        return spark.read.schema("collection string, key string").parquet(f"{self.path}/stale")


def bucket(id_, buckets: int = 64):
    return F.lpad(F.pmod(F.xxhash64(id_.cast("string")), F.lit(buckets)).cast("string"), 4, "0")


def read_items(spark: SparkSession, root: str, name: str, frame: tuple[str, str] = COLLECTION, keys: list[str] | None = None) -> DataFrame:
    """(key, item) of the published documents, line by line: large ones are split among tasks. Only the folders of ``keys`` are read."""
    at = current_build(spark, root)
    if not at or not _path(spark, f"{at}/{name}")[1].exists(_path(spark, f"{at}/{name}")[0]):
        return spark.createDataFrame([], "key string, item string")
    rows = spark.read.schema("value string, key string").text(f"{at}/{name}")
    rows = rows.where(F.col("key").isin(keys)) if keys is not None else rows
    head, foot = frame
    # an item's line ends with a comma or with the whole of what ends a document
    ends = F.when(F.endswith("value", F.lit(",")), F.lit(1)).otherwise(F.lit(len(foot)))
    bare = F.substr("value", F.lit(1), F.length("value") - ends)
    return rows.where(F.col("value") != head).select("key", bare.alias("item"))


def read_records(spark: SparkSession, root: str, name: str, ids: list | None = None, buckets: int = 64) -> DataFrame:
    """(id, document) of the ids that were published (all of them without ``ids``); only the buckets of these are read."""
    at = current_build(spark, root)
    if not at:
        return spark.createDataFrame([], "id string, document string")
    rows = spark.read.schema("id string, document string, key string").json(f"{at}/{name}")
    if ids is None:
        return rows.select("id", "document")
    texts = [str(i) for i in ids]
    of = [r.b for r in spark.createDataFrame([(t,) for t in texts], "i string").select(bucket(F.col("i"), buckets).alias("b")).distinct().collect()] if texts else []
    return rows.where(F.col("key").isin(of) & F.col("id").isin(texts)).select("id", "document")


Writer = Callable[[Build], None]


def publish(spark: SparkSession, root: str, *writers: Writer, keep: int = 0) -> DataFrame:
    """Write a build by the given functions and publish it: (collection, key) that are gone."""
    build = Build(spark, root)
    for write in writers:
        write(build)
    return build.publish(keep)

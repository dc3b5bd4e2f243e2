"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-casing of A-Z only, as the contracts ask; other letters stay.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: str) -> str:
    if text.isascii():
        return text.lower()
    return text.translate(_LOWER)


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over an array of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


class WordHasher(dict):
    """word (UTF-8) -> 64-bit hash; forgets everything when it holds too many words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a local master, as in tests, may do without one: a local folder is
    then used. A cluster without one is refused, since its machines share none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python by the thousand: ten thousand of them, Spark's default, take hundreds of MB a task.

    A number that the session has been given is left alone.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, "1000")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(spark))


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def release(*done: DataFrame) -> None:
    """Delete what ``stored`` wrote for tables that nothing will read again."""
    for df in done:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))

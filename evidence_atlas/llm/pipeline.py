"""Five stages that clean a corpus: each works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``.

In every stage repeated rows are judged like any others, no text is cut short
however long it is, an empty table gives an empty one, and columns beside
doc_id, text, lang and source pass through whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import bpe_round_trip
from .common import stored, table
from .decontaminate import find_contamination
from .near_dedup import near_duplicates
from .pii import sanitise
from .quality import score_quality


def _packed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others in one struct, so that no operator meets a name of its own."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*names, F.struct(F.lit(0).alias("_"), *rest).alias("_row"))


def _unpacked(rows: DataFrame, docs: DataFrame, *names: str, **new) -> DataFrame:
    """The columns of ``docs`` again, with new values for some; n_chars is the length of the text as it is now."""
    if "text" in new and "n_chars" in docs.columns:
        new["n_chars"] = F.length(F.coalesce(new["text"], F.lit(""))).cast(dict(docs.dtypes)["n_chars"])
    return rows.select(*[new.get(c, F.col(c) if c in names else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their site do not put at more than even odds of low quality or toxicity.

    A null text is an empty one; null hosts and languages are sites like
    others; a document at exactly even odds stays, and so do all if no label
    can be used.
    """
    names = ("doc_id", "text", "lang", "source")
    scored = score_quality(_packed(docs, *names), table(spark, sf_dir, "labels"))
    return _unpacked(scored.where(~F.coalesce("rejected", F.lit(False))), docs, *names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the smallest doc_id.

    Rows that repeat a kept doc_id are one document; of different texts under
    one id the smallest stays. Rows without an id stay, and so do empty texts.
    """
    found = near_duplicates(docs, n=5).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    rows = _packed(docs, "doc_id", "text")
    same = Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text"), F.asc_nulls_last("_row"))
    one = rows.join(found, F.col("doc_id") == F.col("_kept"), "left_semi").withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")
    return _unpacked(one.unionByName(rows.where("doc_id is null")), docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents (a twentieth of the words or more stand in the benchmark); shorter matches are cut out.

    A null text has no words and stays null.
    """
    found = find_contamination(_packed(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    text = F.when(F.col("n_hit") > 0, F.col("clean_text")).otherwise(F.col("text"))
    return _unpacked(found.where("not contaminated"), docs, "doc_id", "text", text=text)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked, and terms that disclose it generalised; a null text stays null."""
    out = sanitise(_packed(docs, "doc_id", "text"))
    text = F.when(F.size("spans") > 0, F.col("sanitised_text")).otherwise(F.col("text"))
    return _unpacked(out, docs, "doc_id", "text", text=text)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Subword ids of every document, and digests of ids and decoded text; a null text has no ids."""
    out = bpe_round_trip(docs, ids=True)
    return out.select("doc_id", "lang", "source", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("pii", pii),
    ("bpe encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier, approximate candidates and subword merges are beyond
#: SQL; the stages are tested against brute force instead.
ORACLE_SQL = None

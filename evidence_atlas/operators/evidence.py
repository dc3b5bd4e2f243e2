"""From findings and passages to evidence and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocabulary as V
from .holding import holding
from .match import first_rows


def build_records(findings: DataFrame, sources: DataFrame, words: list[str] = V.DISASTER_WORDS, known: list[str] | None = None) -> DataFrame:
    """Disaster records of findings with the reason for refusal (null: kept).

    findings(finding_id, source_id, relation, name, quote, hazards, method);
    sources(source_id, text). A record needs one of the two relations, a name
    and a quote of eight characters that stands in its source; one read from
    an entry's text must name a natural disaster.
    """
    rows = findings.join(sources, "source_id", "left")
    natural = (F.col("method") != "entry_text") | X.is_natural_disaster("quote", "hazards", words)
    reason = (
        F.when(~F.coalesce(F.col("relation").isin(V.RELATIONS[:2]), F.lit(False)), "relation")
        .when(F.coalesce("name", F.lit("")) == "", "no_name")
        .when(F.length(F.coalesce("quote", F.lit(""))) < 8, "short_quote")
        .when(~X.verify_quote("quote", "text"), "not_verbatim")
        .when(~natural, "not_natural")
    )
    listed = F.filter("hazards", lambda h: h.isin(known or list(V.HAZARDS)))
    return rows.select("finding_id", "source_id", "relation", "name", "quote", listed.alias("hazards"), reason.alias("reason"))


def prose_evidence(findings: DataFrame, sources: DataFrame, disaster: list[str] = V.DISASTER_WORDS, landform: list[str] = V.LANDFORM_WORDS) -> DataFrame:
    """One evidence row for each place: its findings' highest level (at most 2), the first on ties.

    findings(finding_id, ord, source_id, place_id, name, kind, stance, quote);
    sources(source_id, text, default_municipality).
    """
    rows = findings.join(sources, "source_id").where(X.finding_reason("name", "quote", "text").isNull())
    rows = rows.withColumn("level", X.level_for("kind", "quote", disaster, landform)).where("level is not null")
    stance = F.when(F.col("stance") == "disputes", "disputes").otherwise("supports")
    rows = rows.withColumn("stance", stance).withColumn("verified", F.lit(True))
    return first_rows(rows, ["place_id"], F.desc("level"), "ord").drop("text")


def monument_mentions(monuments: DataFrame, findings: DataFrame, keywords=None) -> DataFrame:
    """One mention for each monument and name, the first: hazards from its kind and name, date from its label."""
    rows = findings.join(monuments, "monument_id")
    kept = rows.where(X.finding_reason("place_name", "quote", "text", "role").isNull())
    first = first_rows(kept, ["monument_id", "place_name"], "ord")
    args = (keywords,) if keywords else ()
    hazards = X.hazards_from_text(F.concat_ws(" ", "kind", "label"), *args)
    return first.withColumn("hazards", hazards).withColumn("date_text", X.date_in_label("label"))


def gazetteer_evidence(findings: DataFrame, disaster: list[str] = V.DISASTER_WORDS, landform: list[str] = V.LANDFORM_WORDS) -> DataFrame:
    """``findings`` with level and disposition: toponym, mention or dropped.

    findings(finding_id, place_id, kind, stance, quote, body, n_records). A
    finding whose origin is told and verified makes a toponym, unless it only
    disputes; one that fails leaves its records as loose mentions, if any.
    """
    level = X.level_for("kind", "quote", disaster, landform)
    told = level.isNotNull() & (F.length(F.coalesce("quote", F.lit(""))) >= 8) & X.verify_quote("quote", "body") & F.col("place_id").isNotNull()
    where = F.when(told & (F.col("stance") == "disputes"), "dropped").when(told, "toponym").when(F.col("n_records") > 0, "mention").otherwise("dropped")
    return findings.withColumn("level", level).withColumn("disposition", where)


def local_history_evidence(entries: DataFrame, claim: Column) -> DataFrame:
    """One row for each id: its entries' claim of the highest level, the first on ties; verified in the text."""
    rows = entries.withColumn("claim", claim).where("claim is not null")
    rows = rows.where(X.verify_quote("claim.quote", "text"))
    return first_rows(rows.withColumn("level", F.col("claim.level")), ["id"], F.desc("level"), "ord").drop("text")


def curated_evidence(seeds: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeds with each quote verified against its source, and warnings for sources that are missing.

    seeds(id, evidence: array<struct<quote, claim, verify_against>>).
    """
    cited = seeds.select("id", F.posexplode("evidence").alias("pos", "e")).select("id", "pos", "e.quote", X.collapse_folded("e.claim", True).alias("claim"), F.col("e.verify_against").alias("source_id"))
    found = cited.join(sources.select("source_id", "text", F.lit(True).alias("there")), "source_id", "left")
    verified = F.coalesce("there", F.lit(False)) & X.verify_quote("quote", "text")
    rows = found.withColumn("verified", verified)
    item = F.struct("pos", "quote", "claim", "source_id", "verified")
    merged = rows.groupBy("id").agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    return merged, rows.where("source_id is not null and there is null").select("id", "pos", "source_id")


def split_sentences(docs: DataFrame, stop: str = "。") -> DataFrame:
    return docs.select("doc_id", F.posexplode(X.sentences("text", stop)).alias("sent_ord", "sentence"))


def chunk_text(docs: DataFrame, size: int = 9000, overlap: int = 400) -> DataFrame:
    return docs.select("doc_id", F.posexplode(X.chunks("text", size, overlap)).alias("chunk_ord", "chunk"))


def verified_quotes(quotes: DataFrame, sources: DataFrame) -> DataFrame:
    """(quote_id, source_id) of quotes(quote_id, quote) that stand in sources(source_id, text), white space aside.

    Each text is run once through all quotes (``holding``); of the texts only
    ids go on, with the quotes found, to the quotes' own ids.
    """
    q = quotes.select("quote_id", X.strip_spaces(F.coalesce("quote", F.lit(""))).alias("q")).where("q <> ''")
    s = sources.select("source_id", X.strip_spaces(F.coalesce("text", F.lit(""))).alias("t"))
    return holding(s, "t", q, "q").select("source_id", "q").join(q, "q").select("quote_id", "source_id")

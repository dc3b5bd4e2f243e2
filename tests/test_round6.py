"""Cases of the sixth round: each failed before its finding was mended."""

import duckdb
from pyspark.sql import functions as F

from evidence_atlas.operators import geo as G
from evidence_atlas.plans import catalog


def test_corroborate_deals_out_its_pairs(spark, tmp_path, monkeypatch):
    """the query's pairs stood in one task, as its tables are small as files; the largest task now stays bounded."""
    spark.range(1500).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(6000).select(F.col("id").alias("s_suppkey"), F.lit(0).alias("s_nationkey"), F.lit("s").alias("s_name")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    most, made, meet = 512, [], G._meet

    def counted(*a):
        out = meet(*a)
        made.append([r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()])
        return out

    monkeypatch.setattr(G, "TASK_PAIRS", most)
    monkeypatch.setattr(G, "_meet", counted)
    got = catalog.QUERIES["corroborate"](spark, str(tmp_path)).toPandas()
    large = [counts for counts in made if sum(counts) > 8 * most]
    assert large and all(max(counts) < 0.3 * sum(counts) for counts in large)
    with duckdb.connect() as db:
        for t in ("customer", "supplier"):
            db.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
        want = db.sql(catalog.ORACLES["corroborate"]).df()
    key = lambda t: sorted(t[["c_custkey", "ids"]].itertuples(index=False, name=None))
    assert key(got) == key(want) and len(got) == 1000


def test_codec_merges_many_as_one_by_one():
    """op5: words are cut together; each gets the ids that it gets alone."""
    import random

    from evidence_atlas.llm import bpe

    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        codec = bpe.BytePairCodec(f.read())
    dice = random.Random(5)
    texts = ["", " ", " the", " " + "a" * 300, " don't", " 漢字かな", " été2024!!", " aaaaaaa"]
    texts += ["".join(dice.choice("aaabnthe é'1.s漢\t") for _ in range(dice.randrange(60))) for _ in range(3000)]
    assert codec.pack_many(texts) == [codec._plain(t) for t in texts]
    assert codec.pack_many([]) == []


def test_lm_score_learns_words_by_batch():
    """op5: a memory smaller than a batch's words gives the same ids."""
    from evidence_atlas.llm import bpe, lm_score

    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        spec = f.read()
    texts = [[f"w{i}x{j}".encode() for j in range(40)] for i in range(5)]
    small, large = lm_score.Subwords(spec, limit=50), lm_score.Subwords(spec)
    for t in (texts[:2], texts[1:]):
        small.learn(t)
        large.learn(t)
        assert all((small.ids(w) == large.ids(w)).all() for w in t)
        assert all((small.ids(w) == lm_score.Subwords(spec).ids(w)).all() for w in t)

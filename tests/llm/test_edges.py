"""Odd rows: nulls anywhere, empty and very long texts, ties, repeats, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from evidence_atlas.llm import ann, bpe, chat, decontaminate, html_extract, lm_score, near_dedup, pii, quality, substring_dedup

LONG = "lorem " * 20_000 + "x" * 100_000 + " a@b.org then +1 (017) 555-7713, card 4111111111111111"
ROWS = [
    (1, "same text for two of them that goes on a bit", "en", "s", 5),
    (2, "same text for two of them that goes on a bit", "en", "s", 5),
    (2, "same text for two of them that goes on a bit", "en", "s", 5),
    (3, None, None, None, None),
    (4, "", "de", "s", 0),
    (5, " \n\t", "de", "s", 0),
    (None, "no id here at all", "en", None, 1),
    (None, None, None, None, None),
    (6, LONG, "fr", "t", len(LONG)),
    (7, "word", "fr", "t", 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "spans sanitised_text n_tokens ids_sha256 token_ids kept component_id n_words n_hit contaminated clean_text p_low rejected score copy term doc node rep words key start end _n".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({c: F.lit("own") for c in CLASH})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "no id here at all"), (None, "word"), (2, None), (3, ""), (1, "no id here at all")], "item_id long, text string")


def test_pii(docs, none):
    out = pii.sanitise(docs).collect()
    assert len(out) == len(ROWS)
    long = next(r for r in out if r.doc_id == 6)
    assert [s.kind for s in long.spans] == ["email", "card", "phone"] and long.sanitised_text.endswith("[EMAIL] then [PHONE], card [CARD]")
    assert pii.sanitise(none).count() == 0


def test_quality(docs, none, labels):
    out = quality.score_quality(docs, labels).collect()
    assert len(out) == len(ROWS) and all(r.rejected in (True, False) for r in out)
    assert not any(r.rejected for r in quality.score_quality(docs, labels.where("false")).collect())
    assert quality.score_quality(none, labels).count() == 0


def test_bpe(docs, none):
    out = bpe.bpe_round_trip(docs, ids=True).collect()
    assert len(out) == len(ROWS) and all(r.decoded_text == (r.text or "") for r in out)
    assert next(r for r in out if r.doc_id == 3).n_tokens == 0
    assert bpe.bpe_round_trip(none).count() == 0


def test_ann(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0, 2.0]), (3, [1.0, 2.0]), (7, [1.0, 2.0, 3.0]), (120, [2.0, 1.0]), (140, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = [tuple(r) for r in ann.nearest(v, v.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 3, 5.0), (0, 2, 5, 5.0), (0, 3, 120, 4.0), (120, 1, 0, 4.0), (120, 2, 3, 4.0), (120, 3, 5, 4.0)]
    assert ann.nearest(v.where("false"), v.where("false")).count() == 0


def test_lm(docs, none):
    out = lm_score.score_documents(docs).collect()
    assert len(out) == len(ROWS) and all(r.score < 0 for r in out)
    assert next(r for r in out if r.doc_id == 4).n_tokens == 1
    assert lm_score.score_documents(none).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 0, "user", "y"), (2, 0, "assistant", "z" * 100_000)]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("spans", F.lit(1))
    out = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.format_best_branches(chat.reply_chain(c), "conv_id")).collect()}
    assert out[1] == [("user", ""), ("user", ""), ("", "x")] and out[None] == [("user", "y")] and out[2] == [("assistant", "z" * 100_000)]
    assert chat.format_best_branches(chat.reply_chain(c.where("false")), "conv_id").count() == 0


def test_html(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (3, "http://a/", "<p" * 2000), (4, "http://a/", "<div>" * 3000 + "deep"), (5, "http://a/", "<article><p>" + "y " * 100_000), (5, "http://a/", "<article><p>" + "y " * 100_000)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("slot", F.lit(1))
    out = html_extract.extract_pages(p).collect()
    assert len(out) == len(rows) and {len(r.text) for r in out if r.page_id == 5} == {199_999}
    assert html_extract.extract_pages(p.where("false")).count() == 0


def test_substring(docs, none):
    out = substring_dedup.repeated_passages(docs)
    assert out.count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    more = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame([(10, text), (11, text), (11, text), (12, "before " + text), (None, text)], "doc_id long, text string"))
    got = {(r.doc_id, r.start, r.end, r.source_id) for r in substring_dedup.repeated_passages(more).collect()}
    assert got == {(11, 0, 60, 10), (12, 1, 61, 10)}
    assert substring_dedup.repeated_passages(none).count() == 0


def test_near_dedup(docs, none):
    out = near_dedup.near_duplicates(docs).collect()
    assert len(out) == len(ROWS)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.component_id, r.kept))
    assert by[1] == [(1, True)] and by[2] == [(1, False)] * 2 and by[4] == [(4, True)] and by[3] == [(3, True)]
    assert by[None] == [(None, True)] * 2
    assert near_dedup.near_duplicates(none).count() == 0


def test_decontaminate(docs, none, items):
    out = decontaminate.find_contamination(docs, items).collect()
    assert len(out) == len(ROWS)
    hit = {r.text: (r.n_hit, list(r.item_ids), r.clean_text) for r in out}
    assert hit["no id here at all"] == (5, ["1"], "") and hit["word"] == (1, [], "") and hit[None] == (0, [], "")
    assert not any(r.n_hit for r in decontaminate.find_contamination(docs, items.where("false")).collect())
    assert decontaminate.find_contamination(none, items).count() == 0


def test_stages(spark, docs, none, labels, items, tmp_path):
    from evidence_atlas.llm import pipeline as corpus_pipeline

    for name, table in (("labels", labels.where("doc_id = 1")), ("benchmark", items), ("documents", docs)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    now, empty = docs, none
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        path = f"{tmp_path}/out{i}"
        stage(spark, now, str(tmp_path)).write.parquet(path)
        now = spark.read.parquet(path)
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0
        if i < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == before.columns and now.count() <= before.count()
            empty = empty.where("false")
    assert {r.doc_id for r in now.collect()} >= {3, 4, 5, 6}


def test_pipeline_by_force(spark, data):
    from evidence_atlas.llm import pipeline as corpus_pipeline
    from test_exact import components_by_force

    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = corpus_pipeline.near_dedup(spark, docs, data)
    want = {d for d, (_, c) in components_by_force(docs.collect(), 5).items() if d == c}
    assert {r.doc_id for r in kept.collect()} == want
    clean = corpus_pipeline.decontaminate(spark, docs, data)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    rows = docs.collect()
    bad = {r.doc_id for r, b in zip(rows, decontaminate.brute_force([r.text for r in rows], items), strict=True) if b[4]}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows} - bad

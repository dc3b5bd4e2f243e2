"""Cases of the seventh round: each failed before its finding was mended."""

import numpy as np
from pyspark.sql import functions as F


def _spec():
    from evidence_atlas.llm import bpe

    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        return f.read()


def test_codec_packs_words_as_one_by_one():
    """words are cut by bytes, letters and what follows them without a pattern; each gets the ids that it gets alone."""
    from evidence_atlas.llm import bpe

    codec = bpe.BytePairCodec(_spec())
    words = ["it's", "don't,", "'s", "''s", "x'", "o'.", "...", "a" * 100 + "." * 60, "a\x00", "a.\x00", "\x00", "é,", "été2024!!", "漢字かな。", "1.5", "word", "word.", "a　b", " ", "$a", "a$b$"]
    assert codec.pack_words([w.encode() for w in words]) == [codec._plain(" " + w) for w in words]
    assert codec.pack_words([]) == []


def test_lm_texts_are_cut_once(spark, monkeypatch):
    """one cutting of the texts serves counts, training and scoring; the words come back from the ids."""
    from evidence_atlas.llm import lm_score as L

    texts = ["The cat sat", None, "  \t ", "naïve café, it's 漢字　かな", "x" * 300 + " 1.5 ..."]
    rows = spark.createDataFrame([(str(i), t or "", i == 0) for i, t in enumerate(texts)], "doc_id string, _text string, held_out boolean")
    spec = spark.sparkContext.broadcast(_spec())
    seen = L.cut_texts(rows, spec)
    pieces = L.codec_of(spec.value).pieces
    for r in seen.where("ids is not null").collect():
        s = np.frombuffer(bytes(r.ids), "<u2").tolist()
        assert b"".join(pieces[i] for i in s[1:-1]).split(b" ")[1:] == L.words_of(texts[int(r.doc_id)] or "") and (r.dealt is None) == r.held_out
    assert {bytes(r.w): r.n for r in seen.where("w is not null").groupBy("w").agg(F.sum("n").alias("n")).collect()} == {w: 1 for t in texts[1:] for w in L.words_of(t or "")}
    made, cut = [], L.cut_texts
    monkeypatch.setattr(L, "cut_texts", lambda *a: made.append(a) or cut(*a))
    assert L.score_documents(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_text").alias("text"))).count() == 5 and len(made) == 1


def test_lm_later_windows_ask_only_for_what_they_score(monkeypatch):
    """F1: a window makes queries from its first scored place on; results are those of whole windows; large scores do not overflow."""
    from evidence_atlas.llm import lm_score as L

    r = np.random.default_rng(1)
    x, y = r.integers(0, 50, (6, L.WINDOW)), r.integers(0, L.CLASSES, (6, L.WINDOW))
    on = np.zeros(x.shape, bool)
    on[:, L.OVERLAP : 30] = True
    start = r.random(L.CLASSES)
    asked, attended = [], L.attended
    monkeypatch.setattr(L, "attended", lambda q, *a: asked.append(q.shape[1]) or attended(q, *a))
    for size in (1, 40):
        model = L.Attention(size * L.Attention.fresh(np.zeros(L.CLASSES)))
        whole = L.Attention(size * L.Attention.fresh(np.zeros(L.CLASSES)).astype(float))
        for got, want in zip(model.log_places(x, y, on, start), whole.log_class(x, y, start)):
            assert np.isfinite(got).all() and np.allclose(got, want[on], rtol=1e-3, atol=1e-3 * size**2)
    assert asked[::2] == [L.WINDOW - L.OVERLAP] * 2


def test_chance_places_are_compared_around_them(spark, monkeypatch):
    """a pair that shares one phrase sends what stands around it, not two whole texts; a passage beside it is found."""
    import random

    from evidence_atlas.llm import substring_dedup as S

    dice = random.Random(11)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    phrase, passage = fresh(12), fresh(60)
    texts = [fresh(2000) + phrase + fresh(2000) for _ in range(6)] + [fresh(900) + phrase + passage + fresh(30), fresh(30) + phrase + passage + fresh(900)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    asked, compared = [], S._compared
    monkeypatch.setattr(S, "_compared", lambda t, pairs: asked.append(pairs.where("centre < 0").select("doc", "other").collect()) or compared(t, pairs))
    got = {tuple(r)[:4] for r in S.repeated_passages(docs).collect()}
    assert got == {(7, 30, 102, 6)}
    assert all(set(r) == {6, 7} for rows in asked for r in rows)


def test_words_over_and_over_are_one_place(spark):
    """texts that repeat one shingle share no passage of fifty words, or one that other texts of the signature hide."""
    from evidence_atlas.llm import substring_dedup as S

    def text(i, *more):
        return " ".join([f"a{i}x{k}" for k in range(70)] + ["and"] * 30 + list(more) + [f"b{i}x{k}" for k in range(70)])

    tail = [f"t{k}" for k in range(40)]
    docs = spark.createDataFrame([(i, text(i, *(tail if i in (8, 14) else []))) for i in range(20)], "doc_id long, text string")
    assert {tuple(r)[:4] for r in S.repeated_passages(docs).collect()} == {(14, 70, 140, 8)}

"""Lexical search, quality rules and whitening against brute force and on odd rows."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from evidence_atlas.llm import lexical_search, quality_rules, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rank_by_force(docs, items, k=10):
    """Rows (item, rank, id, score) from the definition, every row a document and an item of its own."""
    bags = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        rows = []
        for d, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * N) // L
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms if t in b)
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(rows)[:k])]
    return out


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def test_search_random(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "ÀB", "x.y", "A-b", "日本"]
    docs = [(i if i % 9 else 7, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 5, 5, 40])))) for i in range(400)]
    docs += [(1000 + i, "w1 w2 w3 same text") for i in range(60)] + [(None, "w1 w2 w3 same text"), (5, None), (6, ""), (8, " .,; ")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 8])))) for i in range(25)] + [(0, "w1 same"), (None, "w2"), (30, None), (31, "unknownterm"), (32, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("own")).repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("own"))
    got = lexical_search.ranked_search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(got.collect()) == plain(rank_by_force(docs, items))


def test_search_in_blocks(spark, monkeypatch):
    """Several item blocks and several shards a task give the same rows."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcdefghij", k=rng.randint(1, 30)))) for i in range(300)]
    items = [(i, " ".join(rng.choices("abcdefghij", k=3))) for i in range(7)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "ITEMS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        assert plain(lexical_search.ranked_search(d, q).collect()) == plain(rank_by_force(docs, items))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_strata_bounds():
    """A search that starts from a good score visits less and finds the same."""
    docs, m = np.arange(6, dtype=object), np.array([10, 10, 50, 50, 50, 900])
    packed = [np.array(x, np.int32).tobytes() for x in ([0], [0, 1], [1], [0], [0], [0, 1])]
    tfs = [np.array(x, np.int32).tobytes() for x in ([1], [2, 1], [4], [1], [1], [9, 9])]
    index = lexical_search.StratifiedIndex(docs, m, packed, tfs, np.array([5, 7]))
    full = index.search(np.array([0, 1]), 6, [], lambda d: (d is None, d))
    assert len(full) == 6 and full == sorted(full, key=lambda r: r[:2])
    assert index.search(np.array([0, 1]), 2, [], lambda d: (d is None, d)) == full[:2]
    kept = [(-(10**12), (False, -2), -2), (-(10**12), (False, -1), -1)]
    assert index.search(np.array([0, 1]), 2, kept, lambda d: (d is None, d)) == kept


def test_search_empty(spark):
    d, q = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r)[:3] for r in lexical_search.ranked_search(d, q).collect()] == [(1, 1, 1)]
    assert lexical_search.ranked_search(d.where("false"), q).count() == 0
    assert lexical_search.ranked_search(d, q.where("false")).count() == 0
    long = spark.createDataFrame([(1, "a " * 300_000 + "x" * 100_000), (2, "b")], "doc_id long, text string")
    assert [(r.doc_id, r["rank"]) for r in lexical_search.ranked_search(long, q).collect()] == [(1, 1)]


def test_search_sql(spark, data):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    want = db.sql(lexical_search.OP11_SQL)
    names = [c for c in want.columns]
    got = lexical_search.op11_lexical(spark, data).select(*names).collect()
    assert plain(got) == plain(want.fetchall())


def rules_by_force(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def fertility_by_force(text):
    """Measures from one pass over the whole text with its words parted by single spaces."""
    import base64

    import public_tokenizers as P
    import sentencepiece
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain_ = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    words = WORD.findall(text)
    joined = " ".join(words)
    ids = pieces.encode(joined)
    share = np.array(list(collections.Counter(ids).values())) / len(ids)
    lettered = [w for w in words if quality_rules.script_of(w)]
    chars = sum(map(len, lettered))
    tokens = len(plain_.encode_ordinary(" " + " ".join(lettered)))
    return len(plain_.encode_ordinary(" " + joined)), len(ids), chars / tokens, chars / len(pieces.encode(" ".join(lettered))), sum(map(pieces.IsByte, ids)) / len(ids), -(share * np.log2(share)).sum()


ODD = ["", None, " \n\t ", "a", "one two three four five " * 3, "x y z w v\n" * 4, "a\nb\na\n\n \nb\na", "#$% <b> | & *", "日本語 の テキスト です から 十 語 いる 語 語 語", "nb sp one two　three", "🙂 " * 12, "z" * 50_000, "tok " * 60_000]


def test_rules_counts(spark, data):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    rows += [(10_000 + i, t, None) for i, t in enumerate(ODD)] + [(None, "no id", "en"), (3, "again three", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"kept": F.lit("own"), "group": F.lit("own"), "n_words": F.lit(-1)})
    out = quality_rules.quality_rules(docs).collect()
    assert len(out) == len(rows)
    want = collections.Counter((i, *rules_by_force(t)) for i, t, _ in rows)
    assert want == collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert all(r.kept == (not r.base_failed and not r.outside) and r.group == "own" for r in out)
    texts = {i: t for i, t, _ in rows}
    for r in out[:150]:
        if r.doc_id is not None and r.doc_id != 3 and r.script:
            assert (r.n_tokens, r.n_pieces, r.chars_per_token, r.chars_per_piece, r.byte_share, r.entropy) == pytest.approx(fertility_by_force(texts[r.doc_id])), r
    assert quality_rules.quality_rules(docs.where("false")).count() == 0


def test_rules_forget(monkeypatch):
    """A cache far too small for the words changes nothing."""
    import public_tokenizers as P

    a, b = (open(p, "rb").read() for p in quality_rules.default_vocabularies())
    texts = [" ".join(f"word{i * j % 701}" for j in range(60)) for i in range(1, 40)]
    wide = quality_rules.WordMeter(a, b, P.PATTERN).measure_all(texts)
    monkeypatch.setattr(quality_rules, "BLOCK", 500)
    assert quality_rules.WordMeter(a, b, P.PATTERN, 50).measure_all(texts) == wide


def test_rules_bands(spark):
    """Texts of another fertility than their language's go; the language's own stay, in a second script too."""
    rng = random.Random(5)
    good = ["the house was near the water and people went there often with their children".split(), "это был дом возле воды и люди часто ходили туда вместе с детьми".split()]
    rows = [(i, " ".join(rng.choices(good[i % 2], k=40)), "en" if i % 2 == 0 else "ru") for i in range(400)]
    noise = ["".join(rng.choices("qxzjkvw", k=9)) for _ in range(300)]
    rows += [(1000 + i, " ".join(rng.sample(noise, 40)), "en") for i in range(5)]
    rows += [(2000 + i, " ".join("".join(rng.choices("ᚠᚢᚦᚨᚱᚲ", k=6)) for _ in range(40)), "en") for i in range(5)]
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not [out[i].outside for i in range(400) if out[i].outside]
    assert all("chars_per_piece" in out[i].outside and not out[i].kept for i in range(1000, 1005))
    assert {out[i].script for i in range(2000, 2005)} == {"RUNIC"} and all("byte_share" in out[i].outside for i in range(2000, 2005))
    none = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), lang=None, least=10**6)
    assert none.where("size(outside) > 0").count() == 0


def whitened_by_force(vectors):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, S = len(fit), fit.sum(axis=0)
    c = np.array((fit * n - S), np.float64) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    dev = [sum(int(n * a - s) ** 2 for a, s in zip(r, S)) for r in x.tolist()]
    return n, dev, e[::-1], q[:, ::-1], np.array(x * n - S, np.float64) / n


def check_whitening(rows, got):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, dev, e, q, centred = whitened_by_force([v for _, v in good])
    assert sorted(r.vec_id for r in got) == sorted(i for i, _ in good)
    by = {r.vec_id: r for r in got}
    k = min(16, len(e))
    y = centred @ q[:, :k] / np.sqrt(e[:k])
    z = np.array([by[i].whitened for i, _ in good])
    sign = np.sign((y * z).sum(axis=0))
    assert np.abs(y * sign - z).max() < 1e-8
    for (i, _), d in zip(good, dev):
        assert by[i].n == n and by[i].deviation == d and by[i].identity_error < 1e-8
        assert by[i].explained == pytest.approx((e[:k] / e.sum()).tolist(), rel=1e-10)


def test_whiten_tables(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check_whitening(rows, whitening.whiten(table.withColumn("n", F.lit("own"))).collect())
    out = whitening.op13_whiten(spark, data)
    assert out.count() == 16 * len(rows) and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whiten_many_tasks(spark, monkeypatch):
    """Sums of many tasks are added up by tasks."""
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 3)))]
    monkeypatch.setattr(whitening, "FEW", 1)
    monkeypatch.setattr(whitening, "BLOCK", 5)
    check_whitening(rows, whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(9)).collect())


def test_whiten_random(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 9)) * [9, 5, 3, 2, 1, 1.5, 0.7, 0.3, 0.2]
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[3].tolist()) for i in range(400)]
    rows += [(5000, None), (5001, [1.0] * 8 + [None]), (5002, [float("nan")] * 9), (5003, [float("inf")] + [0.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    check_whitening(rows, whitening.whiten(table).collect())


def test_whiten_ties_and_ranks(spark):
    """Equal deviations, fewer dimensions than entries, one vector, other lengths, none at all."""
    square = [(k, [float(a), float(b), 5.0]) for k, (a, b) in enumerate([(1, 0), (-1, 0), (0, 1), (0, -1)])]
    t = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.whiten(t(square + [(9, [1.0, 2.0])])).collect()
    assert len(out) == 4 and all(r.whitened[2] is None and r.explained == pytest.approx([0.5, 0.5, 0.0]) and r.identity_error < 1e-12 for r in out)
    z = np.array([r.whitened[:2] for r in out])
    assert np.abs(z.T @ z / 4 - np.eye(2)).max() < 1e-12
    one = whitening.whiten(t([(1, [3.0, 4.0]), (1, [3.0, 4.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, [None, None], [None, None])] * 2
    assert whitening.whiten(t([(1, None)])).count() == 0 and whitening.whiten(t([(1, [])])).count() == 0
    huge = whitening.whiten(t([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.5])])).collect()
    assert len(huge) == 3 and all(r.deviation is None or r.deviation >= 0 for r in huge)


def test_repeated_words():
    rng = np.random.default_rng(1)
    for n in (0, 4, 5, 9, 200):
        ids = rng.integers(0, 3, n)
        assert quality_rules.repeated_words(ids) == rules_by_force(" ".join(map(str, ids)))[4]


LM_TEXTS = ["the cat sat on the mat and the dog ran", "a dog and a cat met on the road", "the sea is wide and the road is long", "cats and dogs sleep on mats"]


def test_lm_long_words(spark):
    """An unknown word costs more the longer it is, however long; thousands of characters are no free pass."""
    from evidence_atlas.llm import lm_score

    rng = random.Random(6)
    junk = "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=3000))
    held = [i for i in range(1000, 1200) if zlib_mod(i) == 2][:4]
    train = [i for i in range(1000, 1200) if zlib_mod(i) != 2]
    rows = [(i, LM_TEXTS[k % 4]) for k, i in enumerate(train)] + [(h, t) for h, t in zip(held, ["the cat", "the cat zqxw", "the cat " + junk[:300], "the cat " + junk])]
    out = {r.doc_id: r.score for r in lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    scores = [out[h] for h in held]
    assert scores == sorted(scores, reverse=True) and scores[0] - scores[1] > 1 and scores[2] < scores[1] - 50 and scores[3] < 5 * scores[2]


def zlib_mod(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 7


def lm_word_by_loops(flat, v, ids):
    """Log probabilities of the words of one short text: the forward pass written with plain loops."""
    from evidence_atlas.llm import lm_score as L

    p = {k: x.astype(float) for k, x in L.Attention(flat).p.items()}
    dot = lambda vec, m: [sum(a * m[i][j] for i, a in enumerate(vec)) for j in range(len(m[0]))]
    hidden = [[p["E"][v.slot[s]][d] + p["P"][i][d] for d in range(L.WIDTH)] for i, s in enumerate(ids[:-1])]
    q, k, val = ([dot(h, p[m]) for h in hidden] for m in "QKV")
    words, word = [], None
    for i in range(len(hidden)):
        weight = [math.exp(sum(a * b for a, b in zip(q[i], k[j])) / math.sqrt(L.WIDTH)) for j in range(i + 1)]
        z = [sum(w * val[j][d] for j, w in enumerate(weight)) / sum(weight) for d in range(L.WIDTH)]
        g = [a + b for a, b in zip(hidden[i], dot(z, p["O"]))]
        e = [math.exp(a + b) for a, b in zip(dot(g, p["U"]), p["b"])]
        target = ids[i + 1]
        here = math.log(e[v.cls[target]] / sum(e)) + v.within[target]
        start = math.log(sum(a * b for a, b in zip(e, v.start_share)) / sum(e))
        if v.starts[target]:
            if word is not None:
                words.append(word + start)
            word = here - start
        else:
            word += here
    return [*words, word]  # nothing starts after the end sign


def test_lm_score_by_loops(spark):
    """score of a held-out text is the mixture of the word's share and the attention model, by loops."""
    from evidence_atlas.llm import bpe, lm_score

    train = [i for i in range(50) if zlib_mod(i) != 2]
    held = [i for i in range(50, 90) if zlib_mod(i) == 2][:2]
    asked = ["the dog sat on a wide blorp", "unseen wordstuff the end"]
    rows = [(i, LM_TEXTS[k % 4]) for k, i in enumerate(train)] + list(zip(held, asked))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in lm_score.score_documents(docs).collect()}
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        text = f.read()
    spec = spark.sparkContext.broadcast(text)
    flat, v = lm_score.train_model(docs.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("_text")), spec, "_text", "doc_id")
    count = collections.Counter(w for k, _ in enumerate(train) for w in [*LM_TEXTS[k % 4].split(), None])
    total = sum(count.values())
    for i, t in zip(held, asked):
        words = [*t.split(), None]
        logs = lm_word_by_loops(flat, v, lm_score.Subwords(text).ids(t.split()).tolist())
        assert len(logs) == len(words)
        want = sum(math.log10(lm_score.WORDS * count[w] / total + (1 - lm_score.WORDS) * math.exp(x)) for w, x in zip(words, logs))
        assert out[i].score == pytest.approx(want, rel=1e-4)


def test_html_class_words_in_an_article():
    """Parts of an article keep their text whatever their class; menus of links, repeated bars and comments go."""
    from evidence_atlas.llm import html_extract as X

    page = '<body><nav>menu</nav><article class="post"><h1>Title</h1><h2 class="section-header">Part</h2><p class="share">We share bread.</p><div class="search-results">Results of the search.</div><p class="social">Social life.</p><blockquote class="comment">A remark.</blockquote><p>Last words.</p><div class="related"><a href="/x">Other story one</a> <a href="/y">Other story two</a></div><div class="ad">Buy now</div><section class="comments"><h3>Replies</h3><div class="comment">First!</div><div class="comment">Second!</div></section></article></body>'
    assert X.main_text(X.parse(page), set()) == "Title\nPart\nWe share bread.\nResults of the search.\nSocial life.\nA remark.\nLast words."
    root = X.parse(page)
    bar = next(b for b in X.blocks(root) if b.text == "Social life.")
    assert "Social life." not in X.main_text(root, {(bar.slot, X._hash(bar.text))}).split("\n")
    two = '<article><p>Text of it.</p><div class="comment">One says.</div><div class="comment">Another says.</div></article>'
    assert X.main_text(X.parse(two), set()) == "Text of it."


def test_decontaminate_periodic_text():
    """One word over and over: linear, and the same as before."""
    import time

    from evidence_atlas.llm import decontaminate

    words = [b"na"] * 200_000
    automaton = decontaminate.ItemAutomaton([("a", [b"na"] * 4000), ("b", [b"na"] * 14 + [b"end"])], 13)
    start = time.time()
    spans, found = automaton.hits(words)
    assert spans == [[0, 200_000]] and found == {"a", "b"} and time.time() - start < 30
    assert automaton.hits([b"na"] * 12)[0] == [] and automaton.hits([b"na"] * 13 + [b"end"])[0] == [[0, 14]]


@pytest.mark.parametrize("changes", [(12, 25, 38), (9, 19, 29, 39)])
def test_substring_among_phrases(spark, changes):
    """A passage with a few words changed is found though other documents hold its surviving phrases one by one."""
    from evidence_atlas.llm import substring_dedup

    passage = [f"p{i}" for i in range(50)]
    changed = [f"x{i}" if i in changes else w for i, w in enumerate(passage)]
    fill = lambda tag, n: [f"{tag}{i}" for i in range(n)]
    kept = [passage[i : i + 5] for i in range(46) if not set(range(i, i + 5)) & set(changes)]
    rows = [(10, fill("a", 60) + passage + fill("b", 60)), (90, fill("c", 60) + changed + fill("d", 60))]
    rows += [(i, [w for k, phrase in enumerate(kept) for w in [*phrase, *fill(f"f{i}q{k}z", 20)]]) for i in (5, 50, 95)]
    docs = spark.createDataFrame([(i, " ".join(ws)) for i, ws in rows], "doc_id long, text string")
    got = [(r.doc_id, r.source_id) for r in substring_dedup.repeated_passages(docs).collect()]
    assert (90, 10) in got

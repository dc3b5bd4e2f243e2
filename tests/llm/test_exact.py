"""Corpus operators against brute force, other libraries and round trips."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from evidence_atlas.llm import ann, bpe, chat, decontaminate, html_extract, lm_score, near_dedup, pii, quality, substring_dedup
from evidence_atlas.llm.common import words_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def check_spans(rows, out):
    got = collections.defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    for r in rows:
        for o in got[r.doc_id]:
            assert [(s.kind, s.start, s.end) for s in o.spans if s.kind != "term"] == base_spans(r.text or ""), r
            if not o.spans:
                assert o.sanitised_text == (r.text or "")


def test_pii_base(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    check_spans(docs.collect(), pii.sanitise(docs).collect())


def test_pii_random(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice("a1.@+ -()5x9%é😀") for _ in range(r.randint(0, 60)))) for i in range(1500)]
    rows += [(9001, "1.2.3.4.5.6.7.8 0001.002.3.255 256.1.1.1 4111 1111 1111 1111 a@b.c.d%x@e.f a.b@c.d@e.f"), (9002, None), (9003, ""), (9005, "1." * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_spans(docs.collect(), pii.sanitise(docs).collect())


def test_pii_terms(spark):
    who = "Zorbinak lives near and writes from bob@x.org about the weather today"
    rows = [(1, who), (2, "once more " + who), (3, "the weather today is fine"), *[(i, f"the weather today number{i} lives near") for i in range(4, 200)]]
    out = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    named = lambda d: {rows[d - 1][1][s.start : s.end] for s in out[d].spans if s.kind == "term"}
    assert "Zorbinak" in named(1) and "Zorbinak" in named(2)
    assert "weather" not in named(1)
    assert "[TERM]" in out[1].sanitised_text and "[EMAIL]" in out[1].sanitised_text and "Zorbinak" not in out[1].sanitised_text
    assert not out[3].spans


def test_pii_counts_ids_once(spark):
    """Repeated rows, rows that share an id and rows without one count as the ids they have."""
    who = "Zorbinak lives near and writes from bob@x.org today"
    rest = [(i, f"the weather today number{i} lives near") for i in range(4, 100)]
    named = lambda rows: {(o.doc_id, o.text[s.start : s.end]) for o in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect() for s in o.spans if s.kind == "term"}
    plain = named([(1, who), (2, "once " + who), *rest])
    assert plain >= {(1, "Zorbinak"), (2, "Zorbinak")}
    assert named([(1, who)] * 9 + [(2, "once " + who), *rest, *rest]) == plain
    assert named([(1, who), (1, "Zorbinak alone"), (2, "once " + who), (None, who), (None, "Zorbinak"), (None, "Zorbinak"), *rest]) == plain
    assert not named([(1, who)] * 9 + rest) and not named([(None, who)] * 9 + rest)


def test_pii_short_terms(spark):
    who = "Li 7x9 lives near and writes from bob@x.org today"
    rows = [(1, who), (2, "once " + who), *[(i, f"the weather today number{i} lives near and writes from once") for i in range(4, 100)]]
    out = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {rows[0][1][s.start : s.end] for s in out[1].spans if s.kind == "term"} == {"Li", "7x9"}


def test_pii_query(spark, data):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{data}/documents.parquet'")
    got = pii.op1_pii(spark, data).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = con.sql(pii.OP1_SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == len(want) and all((got[c] == want[c]).all() for c in got.columns)


def test_bpe_like_the_library(data):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    with open(path, encoding="utf-8") as f:
        codec = bpe.BytePairCodec(f.read())
    library = Tokenizer.from_file(path)
    r = random.Random(1)
    signs = "ab 'sSt\t\n\x1c\x1f\x85\xa0　​0١²½éß中😀́ﬁǅªⅣ"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 12))) for _ in range(3000)] + ["a<|endoftext|>b", "<|endoftext|>", "", "a" * 5000]
    texts += [x[0] for x in duckdb.connect().sql(f"select text from '{data}/documents.parquet'").fetchall()]
    for t in texts:
        packed, want = codec.encode(t), library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == want, t
        assert codec.decode(packed) == library.decode(want, skip_special_tokens=False)


def test_bpe_query(spark, data):
    out = {r.doc_id: r for r in bpe.op3_bpe(spark, data).collect()}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        assert out[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_quality_on_labels(spark, data):
    out = quality.op2_quality(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().merge(out, on="doc_id")
    clean = labels[(labels.quality == 1) & (labels.toxic == 0)]
    assert clean.rejected.mean() < 0.03
    assert labels[labels.toxic == 1].rejected.mean() > 0.7
    assert labels[labels.quality == 0].rejected.mean() > 0.8


def test_quality_on_held_out_labels(spark):
    """A fifth of the labels is kept from training and from the sites."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.score_quality(docs, labels.where("pmod(xxhash64(doc_id), 5) <> 0")).select("doc_id", "rejected")
    held = labels.where("pmod(xxhash64(doc_id), 5) = 0").join(out, "doc_id").toPandas()
    assert len(held) > 50
    assert held[(held.quality == 1) & (held.toxic == 0)].rejected.mean() < 0.03
    assert held[held.quality == 0].rejected.mean() > 0.8


def test_quality_words_are_cut_alike(spark):
    """Words beyond ASCII keep their case in training as in scoring."""
    rows = [(i, ("ÁRBOL viejo " if i % 2 else "árbol nuevo ") + f"w{i} uno dos tres") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, low int, toxic int"))
    at = len(quality.STYLE) * 3
    assert model.features("ÁRBOL")[at + 2] > 0 and model.features("árbol")[at + 3] > 0 and not model.features("arbol")[at : at + 4].any()


def test_site_rates_by_force(spark):
    """Path and host rates of labelled sites against the formulas in plain Python; a site that all call low counts more the more it has."""
    r = random.Random(2)
    sites = [(f"h{h}", f"p{p}", n, r.randint(0, n) if h else n, r.randint(0, n)) for h in range(6) for p in range(4) for n in [r.choice([1, 2, 30, 400])]]

    def shrunk(groups):  # key -> (n, k, parent's rate)
        extra = sum(n * (k / n - m) ** 2 - m * (1 - m) for n, k, m in groups.values())
        room = sum((n - 1) * m * (1 - m) for n, _, m in groups.values())
        strength = 1 / min(max(extra / room, 1e-4), 0.99) - 1
        return {g: (k + strength * m) / (n + strength) for g, (n, k, m) in groups.items()}

    top, rates = quality.site_rates(spark.createDataFrame(sites, "_host string, _path string, n long, toxic long, low long"))
    got = {(x._host, x._path): x.asDict() for x in rates.collect()}
    assert len(got) == len(sites)
    for t, at in (("toxic", 3), ("low", 4)):
        total = sum(s[2] for s in sites)
        mean = (sum(s[at] for s in sites) + 0.5) / (total + 1)
        assert top[t] == pytest.approx(mean)
        hosts = shrunk({h: (sum(s[2] for s in sites if s[0] == h), sum(s[at] for s in sites if s[0] == h), mean) for h in {s[0] for s in sites}})
        paths = shrunk({s[:2]: (s[2], s[at], hosts[s[0]]) for s in sites})
        for s in sites:
            assert got[s[:2]][f"_host_{t}"] == pytest.approx(hosts[s[0]]) and got[s[:2]][f"_path_{t}"] == pytest.approx(paths[s[:2]])


def test_site_labels_move_documents(spark):
    """The same text is judged by its site's labels too."""
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        bad = i % 2
        text = " ".join([r.choice(["fine", "plain", "calm"])] * 3 + ["junk"] * (bad and r.random() < 0.5) + [f"w{i}"])
        rows.append((i, text, "en", "spam" if bad else "good"))
        labels.append((i, 1 - bad, 0))
    rows += [(900, "plain words here", "en", "spam"), (901, "plain words here", "en", "good"), (902, "plain words here", "en", "new")]
    out = {x.doc_id: x for x in quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert out[900].p_low > out[902].p_low > out[901].p_low and out[900].host_rate > 0.9 > 0.1 > out[901].host_rate


def test_shrinkage(spark):
    sites = spark.createDataFrame([("big", 1000, 900.0), ("small", 1, 1.0), ("calm", 1000, 100.0)], "_host string, n long, low double")
    from pyspark.sql import functions as F

    rate = {r._host: r.rate for r in quality.shrunk_rates(sites, ["_host"], "low", F.lit(0.5)).collect()}
    assert rate["big"] > 0.85 and rate["calm"] < 0.15 and 0.4 < rate["small"] < 0.9


@pytest.mark.parametrize("n, dim, copies", [(600, 8, 1), (900, 3, 1), (600, 4, 50)])
def test_ann_exact(n, dim, copies):
    r = np.random.default_rng(n + dim)
    x = np.concatenate([r.normal(size=(n // copies, dim)).astype(np.float32)] * copies)
    ids = r.permutation(n)
    found, score = ann.Search(ann.unpack(ann.pack(ann.build_tree(ids, x))), ids[:40], x[:40], 20, 1.0).run()
    for i in range(40):
        every, other = ann.inner(np.repeat(x[i : i + 1], n, 0), x), ids != ids[i]
        best = np.lexsort((ids[other], -every[other]))[:20]
        assert (ids[other][best] == found[i]).all() and (every[other][best] == score[i]).all()


def test_ann_query(spark, data):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{data}/embeddings.parquet'")
    got = ann.op4_ann(spark, data).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    want = con.sql(ann.OP4_SQL).df().sort_values(["query_id", "rank"]).reset_index(drop=True)
    assert len(got) == len(want) and all((got[c] == want[c]).all() for c in got.columns)


def test_lm_windows_score_each_place_once():
    for n in [1, 2, 11, 12, 13, 47, 48, 49, 84, 85, 500]:
        starts, begin = lm_score.windows(n)
        seen = [s + j for s, b in zip(starts, begin) for j in range(b, lm_score.WINDOW) if s + j < n]
        assert sorted(seen) == list(range(n))


def test_lm_gradient():
    r = np.random.default_rng(0)
    flat = lm_score.Attention.fresh(np.zeros(lm_score.CLASSES)).astype(np.float64)
    x, y = r.integers(0, 50, (2, lm_score.WINDOW)), r.integers(0, lm_score.CLASSES, (2, lm_score.WINDOW))
    on = np.ones(x.shape, bool)
    model = lm_score.Attention(flat)
    start = np.zeros(lm_score.CLASSES)
    loss = lambda: -lm_score.Attention(flat).log_class(x, y, start)[0].mean()
    g = model.gradient(x, y, on)
    at = np.argsort(-np.abs(g))[[0, 5, 50, 500]]
    for i in at:
        keep = flat[i]
        flat[i] = keep + 1e-4
        up = loss()
        flat[i] = keep - 1e-4
        down = loss()
        flat[i] = keep
        assert abs((up - down) / 2e-4 - g[i]) < 1e-2 * abs(g[i]) + 1e-6


def test_lm_trains_on_every_place(spark):
    for n in [2, 3, 48, 49, 50, 97, 98, 384, 385, 1000]:
        s = np.arange(n) + 7
        got = [np.frombuffer(w, "<u2").tolist() for w in lm_score.training_windows(s)]
        assert [p for w in got for p in zip(w, w[1:])] == list(zip(s[:-1].tolist(), s[1:].tolist()))
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    for text in ["alpha beta", "gamma delta of a", "one more short text", "the sea"]:
        flat, v = lm_score.train_model(spark.createDataFrame([(text,)], "text string"), spec)
        assert (flat != lm_score.Attention.fresh(v.bias)).any(), text


def test_lm_parts(spark, monkeypatch):
    import pandas as pd

    pdf = pd.DataFrame({"part": [0] * 25 + [1] * 3, "win": [b"a"] * 28})
    assert [(g, len(w)) for g, w in lm_score._parts(iter([pdf[:7], pdf[7:]]), 10)] == [(0, 10), (0, 10), (0, 5), (1, 3)]
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    dealt, deal = [], lm_score.in_parts
    monkeypatch.setattr(lm_score, "PART", 20)
    monkeypatch.setattr(lm_score, "in_parts", lambda win, n: dealt.append(deal(win, n)) or dealt[-1])
    lm_score.train_model(spark.createDataFrame([(i, "one text in many copies") for i in range(600)], "doc_id long, text string"), spec, doc_id="doc_id")
    sizes = [r["count"] for r in dealt[0].groupBy("turn", "part").count().collect()]
    assert sum(sizes) == 600 and len(sizes) == 30 and max(sizes) < 3 * 20


def test_lm_base(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: r for r in lm_score.op5_lm_score(spark, data).collect()}
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    count = collections.Counter()
    for r in rows:
        if not held[r.doc_id]:
            count.update([*words(r.text or ""), None])
    total, distinct = sum(count.values()), len(count)
    for r in rows:
        tokens, o = [*words(r.text or ""), None], out[r.doc_id]
        base = sum(np.log10((count[w] + 1) / (total + distinct + 1)) for w in tokens)
        assert o.base_score == pytest.approx(base, rel=1e-9) and o.held_out == held[r.doc_id] and o.train_tokens == total
        assert (o.n_tokens, o.n_known) == (len(tokens), sum(count[w] > 0 for w in tokens)) and o.score < 0


def test_chat_oracle_and_escapes(spark, data):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{data}/conversations.parquet'")
    got = chat.op6_chat(spark, data).toPandas()
    want = con.sql(chat.OP6_SQL).df()
    columns = sorted(got.columns)
    assert sorted(map(tuple, got[columns].values.tolist())) == sorted(map(tuple, want[columns].values.tolist()))
    r = random.Random(1)
    rows = [(i, j, r.choice(["user", "assistant", "a\nb", "\\n<", None]), "".join(r.choice("\\<[ln s]|>\nturend/é") for _ in range(r.randint(0, 30))) + r.choice(["", "<|turn|>", "<|end|>\n", "\\<|turn|>"])) for i in range(60) for j in range(r.randint(1, 12))]
    out = chat.read_back(chat.format_best_branches(chat.reply_chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "conv_id")).collect()
    said = collections.defaultdict(list)
    for c, _, role, text in rows:
        said[c].append((role or "", text))
    assert len(out) == len(said)
    for o in out:
        assert [(t.role, t.text) for t in o.turns] == said[o.conv_id]


def test_reply_trees(spark):
    rows = [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 3, None), (2, 7, 99, 1.0), (3, 1, 2, 1.0), (3, 2, 1, 1.0)]
    tree = spark.createDataFrame(rows, "tree_id int, node_id int, parent_id int, score double")
    got = [tuple(r) for r in chat.best_paths(tree, keep=2).orderBy("tree_id", "branch", "rise").collect()]
    assert got == [(1, 1, 0, 4), (1, 1, 1, 2), (1, 1, 2, 1), (1, 2, 0, 5), (1, 2, 1, 3), (1, 2, 2, 1), (2, 1, 0, 7)]


def test_html_articles(spark, data):
    import html

    def article(page):
        body = re.search("<article>(.*?)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("<(?:/?p|/?h1)>", body)]
        return "\n".join(p for p in parts if p)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for r in html_extract.op7_html(spark, data).collect():
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


def test_html_wrapper(spark):
    page = '<body><div id="top"><p>Welcome to our site</p></div><div id="x"><p>{0} is told &amp; kept</p><p>and  {0}\nmore</p></div><div class="comments"><p>no {0}</p></div><form>f</form><div id="bottom"><p>All rights reserved</p></div>'
    rows = [(i, "http://a.org/", page.format(f"story{i}")) for i in range(5)] + [(9, None, None), (10, "odd", "<main><p>x<div>y</main>z")]
    out = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert out[3] == "story3 is told & kept\nand story3 more"
    assert out[9] == "" and out[10] == "x\ny"


def test_html_without_marks(spark, data):
    """The same pages with their article tags made plain divisions give the same texts: slots alone decide."""
    pages = spark.read.parquet(f"{data}/pages.parquet")
    from pyspark.sql import functions as F

    want = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    bare = pages.withColumn("html", F.regexp_replace("html", "<(/?)article>", "<$1div>"))
    got = {r.page_id: r.text for r in html_extract.extract_pages(bare).collect()}
    assert sum(got[k] == v for k, v in want.items()) >= 0.98 * len(want)


def test_html_slots_inside_articles(spark):
    page = "<body><div class='story'>teaser {0}</div><article><h1>Head {0}</h1><p class='alert'>Important body {0}</p><p class='notice'>Please support us</p><p>Text {0} <label>kept {0}</label></p><p>Share this article</p><div class='ad'>buy {0}</div><div class='comments'>no {0}</div></article></body>"
    other = "<body><div class='story'>teaser {0}</div><div><p>A long body that no element marks, page {0}, with a good deal more to say than the card above it has</p></div></body>"
    rows = [(i, "http://a.org/", page.format(f"n{i}")) for i in range(6)] + [(6, "http://a.org/", page.format("n1"))] * 9 + [(10 + i, "http://b.org/", other.format(f"n{i}")) for i in range(6)]
    out = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "'own' as text", "'own' as slot")).collect()}
    assert out[2] == "teaser n2\nHead n2\nImportant body n2\nText n2 kept n2" and out[6] == out[1]
    assert "A long body that no element marks, page n3" in out[13]


def test_html_deep_pages(spark):
    page = "<body><div><p>Welcome to our site</p></div>" + "<div>" * 600 + "<b>" * 700 + "<p>story{0} is told</p><div class='comments'><p>no {0}</p></div>" + "</div>" * 600 + "<div><p>All rights reserved</p></div>"
    rows = [(i, "http://a.org/", page.format(i)) for i in range(5)] + [(9, "http://b.org/", "<i>" * 300 + "<article><p>in</p></article><nav>menu</nav><p>out")]
    out = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert out[3] == "story3 is told" and out[9] == "in"
    shape = html_extract.skeleton(html_extract.parse(rows[0][2]))
    assert html_extract.flat(html_extract.unflat(html_extract.flat(shape))) == html_extract.flat(shape)


def test_tree_matching():
    a = ("a", (("b", ()), ("c", (("d", ()),)), ("e", ())))
    b = ("a", (("c", (("d", ()),)), ("x", ()), ("e", ())))
    assert html_extract.weigh(a, b, {}) == 4
    out = {}
    html_extract.align(a, b, {}, html_extract.numbered(b), out)
    assert out == {(): 0, (1,): 1, (1, 0): 2, (2,): 4}


def test_compact_windows():
    r = np.random.default_rng(0)
    for k in range(150):
        n, t = int(r.integers(1, 60)), int(r.integers(1, 12))
        h = r.integers(0, 20 if k % 2 else 1000, n).astype(np.uint64)
        want = []
        for c in range(n):
            a = b = c
            while a and h[a - 1] > h[c]:
                a -= 1
            while b < n - 1 and h[b + 1] >= h[c]:
                b += 1
            if b - a + 1 >= t:
                want.append((a, c, b))
        assert sorted(substring_dedup.compact_windows(h, t)) == sorted(want)


def test_repeated_passages(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()
    seen, want = {}, collections.defaultdict(set)
    for d in rows:
        w = words_of(d.text or "")
        for i in range(len(w) - 49):
            if seen.setdefault(tuple(w[i : i + 50]), d.doc_id) != d.doc_id:
                want[d.doc_id].update(range(i, i + 50))
    got = collections.defaultdict(set)
    for r in substring_dedup.op8_substring_dedup(spark, data).collect():
        assert r.source_id < r.doc_id and r.end - r.start >= 50
        got[r.doc_id].update(range(r.start, r.end))
    assert all(x <= got[d] for d, x in want.items())


def test_passages_in_mixed_groups(spark, monkeypatch):
    """Texts of a family share a phrase; two in the middle share a passage around it."""
    monkeypatch.setattr(substring_dedup, "HASHES", 2)
    r, rows = random.Random(4), []
    for f in range(12):
        fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
        phrase, tail = fresh(30), fresh(22)
        rows += [(100 * f + i, " ".join(fresh(60) + phrase + (tail if i in (5, 9) else []) + fresh(60))) for i in range(14)]
    got = {(x.doc_id, x.source_id, x.start, x.end) for x in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(100 * f + 9, 100 * f + 5, 60, 112) for f in range(12)}


def test_stretches_of_many_texts():
    """Texts laid end to end have the windows that each has by itself, and every start of a stretch is in one."""
    r = np.random.default_rng(5)
    hs = [r.integers(0, 50 if k % 2 else 2**60, int(n)).astype(np.uint64) for k, n in enumerate(r.integers(0, 40, 60))]
    for function in (0, 3):
        text, sig, centre, first, last = substring_dedup.stretches(hs, 7, function)
        for i, h in enumerate(hs):
            alone = substring_dedup.stretches([h], 7, function)
            assert sorted(zip(*[c[text == i].tolist() for c in (sig, centre, first, last)])) == sorted(zip(*[c.tolist() for c in alone[1:]]))
            starts = sorted(s for a, b in zip(alone[3], alone[4]) for s in range(a, b + 1))
            assert starts == list(range(max(0, len(h) - 6)))


def test_phrases_of_many_texts_are_given_up(spark):
    """A phrase that all texts have makes no passage; two of them share one beside it."""
    r = random.Random(3)
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    phrase, more = fresh(35), fresh(40)
    texts = [fresh(60) + phrase + (more if i in (120, 140) else []) + fresh(60) for i in range(150)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(x.doc_id, x.source_id, x.start, x.end) for x in substring_dedup.repeated_passages(docs).collect()}
    assert got == {(140, 120, 60, 135)}


def test_near_passages(spark):
    """50-word passages with one or two words changed, against comparing all pairs."""
    r, rows = random.Random(8), []
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    for k in range(80):
        passage = fresh(50)
        other = list(passage)
        for i in r.choice([[25], [15, 33]]):
            other[i] = "changed"
        rows += [(2 * k, " ".join(fresh(40) + passage + fresh(40))), (2 * k + 1, " ".join(fresh(40) + other + fresh(40)))]
    hasher = substring_dedup.WordHasher()
    arrays = [hasher.array(words_of(t)) for _, t in rows]
    want = {(d, s, e, d - 1) for d in range(1, 160, 2) for s, e, *_ in substring_dedup.common_passages(arrays[d], substring_dedup.indexed(arrays[d - 1]))}
    got = {(x.doc_id, x.start, x.end, x.source_id) for x in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) == 80 and got == want


def components_by_force(rows, n, threshold=0.8):
    sets = {}
    for d in rows:
        w = words_of(d.text or "")
        sets[d.doc_id] = frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    at = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            at[x].append(k)
    common = collections.Counter((a, b) for ks in at.values() for i, b in enumerate(ks) for a in ks[:i])
    for (a, b), c in common.items():
        if 100 * c >= round(100 * threshold) * (len(sets[a]) + len(sets[b]) - c):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_near_duplicates(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").collect()
    want = components_by_force(rows, 4)
    got = {r.doc_id: r for r in near_dedup.op9_near_dedup(spark, data).collect()}
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicate_family(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_by_force(docs.collect(), 5)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_duplicates(docs, n=5).collect()}
    assert got == want


def test_near_duplicates_beyond_a_chain(spark):
    """Drifting families: what hangs together by a chain may be far from the pivot, and be all that another text is near."""
    r, rows = random.Random(9), []
    for family in range(12):
        words = [f"{family}w{i}" for i in range(500)]
        texts = [words[i : i + 203] for i in range(0, 121, 10)] + [words[140:343]]
        rows += [" ".join(t) for t in texts]
        rows += [" ".join(w if r.random() > 0.04 else f"x{r.randrange(10**9)}" for w in r.choice(texts)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(r.sample(rows, len(rows)))], "doc_id long, text string")
    want = components_by_force(docs.collect(), 4)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_duplicates(docs).collect()} == want


def test_open_pairs_by_force(spark):
    """All pairs of a bucket that may still be linked are found by their differences, whatever the pivot."""
    from pyspark.sql import functions as F

    for seed in range(4):
        r = random.Random(seed)
        pool = list(range(60))
        base = set(r.sample(pool, 40))
        sets = {bytes([i]): frozenset(base ^ set(r.sample(pool[:18], r.randint(0, 9)))) for i in range(40)}
        rows = spark.createDataFrame([(k, sorted(v), len(v), b"") for k, v in sets.items()], "node binary, items array<long>, size long, registers binary")
        a, linked = bytes([0]), lambda x, y: 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])
        together = {k for k in sets if linked(a, k) and r.random() < 0.7}
        cells = spark.createDataFrame([(a, k, a if k in together else k) for k in sets if k != a], "a binary, node binary, component binary")
        found, pairs, _ = near_dedup.open_pairs(cells, rows, 80)
        got = {(bytes(x.a), bytes(x.b)) for x in found.collect()}
        assert got == {(a, k) for k in sets if k != a and linked(a, k) and k not in together}
        made = {(bytes(x.a), bytes(x.b)) for x in pairs.collect()}
        want = {(x, y) for x in sets for y in sets if a < x < y and linked(x, y) and not (linked(a, x) and linked(a, y))}
        assert want <= made and len(want) > 20
        alive = {bytes(x.node) for x in near_dedup.supported(rows.where(F.lit(True)), 80).collect()}
        assert {k for k in sets if any(linked(k, o) for o in sets if o != k)} <= alive


def test_sketches():
    r = np.random.default_rng(2)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[400:2400])
    k = near_dedup.sketch([a, b, np.union1d(a, b)])
    assert (np.maximum(k[0], k[1]) == k[2]).all()
    many = near_dedup.sketch([a, b], registers=1024)
    est = near_dedup.joint_estimate(many[:1], many[1:], np.array([float(len(a))]), np.array([float(len(b))]))[0]
    assert abs(est - 1600 / 2400) < 0.06


def test_decontamination(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    want = decontaminate.brute_force([r.text for r in rows], items)
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.op10_decontaminate(spark, data).collect()}
    assert [got[r.doc_id] for r in rows] == want


def test_automaton_random():
    r = random.Random(0)
    for k in range(800):
        signs, window = "abc" if k % 2 else "abcde", r.randint(2, 5)
        items = [(r.choice([i, None]) if r.random() < 0.1 else i, " ".join(r.choice(signs) for _ in range(r.randint(0, 10)))) for i in range(r.randint(0, 5))]
        texts = [" ".join(r.choice(signs) for _ in range(r.randint(0, 25))) for _ in range(4)]
        a = decontaminate.ItemAutomaton([(i, decontaminate.words_of(x)) for i, x in items], window)
        for t, want in zip(texts, decontaminate.brute_force(texts, items, window), strict=True):
            spans, found = a.hits(decontaminate.words_of(t))
            ids = ",".join(sorted(map(str, found)))
            n = sum(y - x for x, y in spans)
            assert (len(t.split()), n, len(found), hashlib.sha256(ids.encode()).hexdigest(), n > 0 and 20 * n >= len(t.split())) == want


def test_automata_in_shards(spark, data, monkeypatch):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    get = lambda: {r.doc_id: (r.n_hit, tuple(r.item_ids), r.clean_text) for r in decontaminate.find_contamination(docs, items).collect()}
    whole = get()
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 300)
    assert get() == whole


def test_clean_text_by_force():
    """Mixed case, odd signs and repeats: the hit words go, all else stays in its place."""
    r = random.Random(11)
    words = ["The", "QUICK", "brown", "Fox", "jumps", "över", "É", "42nd", "lazy-dog", "x.Y", "a"]
    for _ in range(400):
        window = r.randint(2, 4)
        text = "".join(r.choice(words) + r.choice([" ", ", ", "\n", " - ", "  "]) for _ in range(r.randint(0, 25)))
        items = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 6)))) for i in range(4)]
        spans, _ = decontaminate.ItemAutomaton([(i, decontaminate.words_of(x)) for i, x in items], window).hits(decontaminate.words_of(text))
        low = text.lower()  # no letter here changes its length or is outside A-Z but for these
        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))]
        assert len(low) == len(text)
        hit = set()
        for _, item in items:
            ws = decontaminate.words_of(item)
            n = min(len(ws), window)
            mine = decontaminate.words_of(text)
            for i in range(len(ws) - n + 1 if n else 0):
                for j in range(len(mine) - n + 1):
                    if mine[j : j + n] == ws[i : i + n]:
                        hit |= set(range(j, j + n))
        got = decontaminate.remove_spans(text, spans)
        assert decontaminate.words_of(got) == [w for j, w in enumerate(decontaminate.words_of(text)) if j not in hit]
        if not hit:
            assert got == text
        elif len(hit) == len(places):
            assert got.strip() == "" or not decontaminate.words_of(got)
        else:
            kept = [text[a:b] for j, (a, b) in enumerate(places) if j not in hit]
            assert [m[0] for m in re.finditer(r"\w+", got)] == [m[0] for k in kept for m in re.finditer(r"\w+", k)]
    assert decontaminate.remove_spans("The Quick BROWN fox Jumps over the Lazy dog", [[3, 4]]) == "The Quick BROWN Jumps over the Lazy dog"
    assert decontaminate.remove_spans("ALL CAPS TEXT HERE", [[1, 4]]) == "ALL"


def test_ann_relaxed(data):
    """A factor above one compares less and keeps at least 0.9 of the exact neighbours of the test table."""
    rows = duckdb.connect().sql("select vec_id, embedding from '/root/testdata/sf0.1/embeddings.parquet' order by vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    tree, asked = ann.build_tree(ids, x), ids % 50 == 0
    got = {}
    for factor in (1.0, ann.RELAXED):
        search = ann.Search(tree, ids[asked], x[asked], 20, factor)
        got[factor] = (search.run()[0], search.compared)
    exact, relaxed = got[1.0][0], got[ann.RELAXED][0]
    recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(exact, relaxed)])
    assert recall >= 0.9 and got[ann.RELAXED][1] < got[1.0][1]
    for i in np.nonzero(asked)[0][:20]:
        every, other = ann.inner(np.repeat(x[i : i + 1], len(x), 0), x), ids != ids[i]
        best = np.lexsort((ids[other], -every[other]))[:20]
        assert (ids[other][best] == exact[np.nonzero(ids[asked] == ids[i])[0][0]]).all()


def test_passing_loses_no_partner(spark):
    rows = spark.range(5000).selectExpr("cast(cast(id as string) as binary) as k", "id", "id as _x")
    names = spark.range(0, 5000, 7).selectExpr("cast(cast(id as string) as binary) as n")
    got = near_dedup.passing(rows, "k", names, "n")
    ids = {r.id for r in got.collect()}
    assert got.columns == rows.columns and ids >= set(range(0, 5000, 7)) and len(ids) < 750
    assert near_dedup.passing(rows, "k", names.where("false"), "n").isEmpty()
    assert near_dedup.passing(rows.where("false"), "k", names, "n").isEmpty()

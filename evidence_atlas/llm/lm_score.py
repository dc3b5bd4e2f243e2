"""Language-model scores: causal self-attention in numpy over subword ids."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec_of, default_vocabulary
from .common import release, small_batches, stored, text_or_empty, words_of

#: Words whose training counts every task holds (the rest are joined).
FREQUENT = 200_000
#: Size of the model: width, classes, subwords with an embedding of their own, window, overlap.
WIDTH, CLASSES, OWN, WINDOW, OVERLAP = 16, 64, 8192, 48, 12
#: Windows that a copy of the model is trained on (about); rounds after which
#: the copies are averaged; and passes over a copy's windows.
PART, ROUNDS, PASSES = 4096, 3, 1
#: Share of the word model in a word's probability; the attention model has the rest.
WORDS = 0.75

_LOG10 = 1 / np.log(10)


class Subwords(dict):
    """word (UTF-8) -> its subword ids as bytes; forgets everything when it holds too many words."""

    def __init__(self, spec: str, limit: int = 300_000):
        super().__init__()
        self.codec, self.limit = codec_of(spec), limit
        self.codec.limit = 20_000  # words are remembered here already
        self.end = len(self.codec.pieces)

    def learn(self, texts: Iterable[list[bytes]]) -> None:
        """Cut the new words of some texts together."""
        new = set().union(*texts).difference(self)
        if len(self) + len(new) > self.limit and self:
            self.clear()
            new = set().union(*texts)
        words = list(new)
        self.update(zip(words, self.codec.pack_words(words)))

    def __missing__(self, word: str | bytes) -> bytes:
        return self.codec._plain(" " + (word if isinstance(word, str) else word.decode("utf-8", "surrogatepass")))

    def ids(self, words: list[bytes]) -> np.ndarray:
        """The ids of a text, with the end sign before and after it."""
        return np.frombuffer(self.packed(words), "<u4").astype(np.int64)

    def packed(self, words: list[bytes]) -> bytes:
        edge = np.array([self.end], "<u4").tobytes()
        return b"".join([edge, *map(self.__getitem__, words), edge])


def windows(n: int, size: int = WINDOW, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows over n inputs, and from which place in a window on to score.

    Every input is scored once: the first window whole, a later one from
    where the one before it ended.
    """
    starts = np.arange(0, max(1, n - overlap), size - overlap)
    begin = np.full(len(starts), overlap)
    begin[0] = 0
    return starts, begin


class Attention:
    """One layer of causal self-attention over embedded subwords, with a class softmax.

    A subword's probability is that of its class given the window before it
    times its share of its class in the training corpus, so probabilities sum
    to one over the vocabulary. A word's probability is that of its subwords
    and of a word's start after them, given that a word starts before them.
    """

    SHAPES = {"E": (OWN + CLASSES, WIDTH), "P": (WINDOW, WIDTH), "Q": (WIDTH, WIDTH), "K": (WIDTH, WIDTH), "V": (WIDTH, WIDTH), "O": (WIDTH, WIDTH), "U": (WIDTH, CLASSES), "b": (CLASSES,)}

    def __init__(self, flat: np.ndarray):
        self.p, at = {}, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            self.p[name] = flat[at : at + size].reshape(shape)
            at += size
        self.flat = flat
        self.seen = np.tril(np.ones((WINDOW, WINDOW), flat.dtype))
        self._tables: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def fresh(cls, bias: np.ndarray, seed: int = 7) -> np.ndarray:
        r = np.random.default_rng(seed)
        parts = [bias.astype(np.float32) if k == "b" else (r.standard_normal(s) * (0.02 if k in "UO" else s[-1] ** -0.5)).astype(np.float32).ravel() for k, s in cls.SHAPES.items()]
        return np.concatenate([x.ravel() for x in parts])

    def into(self) -> np.ndarray:
        """Queries (scaled), keys and values, side by side."""
        return np.concatenate([self.p["Q"] * self.flat.dtype.type(WIDTH**-0.5), self.p["K"], self.p["V"]], 1)

    def log_class(self, x: np.ndarray, target: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probabilities of each target class, and of a word's start."""
        lp, ls = self.log_places(x, target, np.ones(x.shape, bool), start)
        return lp.reshape(x.shape), ls.reshape(x.shape)

    def log_places(self, x: np.ndarray, target: np.ndarray, on: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``log_class`` of the places that are on, in order; no queries are made before the first column that has one."""
        p, skip = self.p, int(on.any(0).argmax())
        if self._tables is None:  # what an id and a place add to queries, keys and values, and a one that sums weights up
            self._tables = tuple(np.column_stack([p[k] @ self.into(), np.full(len(p[k]), k == "P", self.flat.dtype)]) for k in "EP")
        of_id, of_place = self._tables
        f = of_id.take(x, 0)
        f += of_place
        a = attended(f[:, skip:, :WIDTH], f[:, :, WIDTH : 2 * WIDTH], self.seen[skip:])
        z = (a @ f[:, :, 2 * WIDTH :])[on[:, skip:]]
        z = z[:, :WIDTH] / z[:, WIDTH:]
        g = p["E"].take(x[on], 0)
        g += p["P"].take(np.nonzero(on)[1], 0)
        g += z @ p["O"]
        y = logits(g, p["U"], p["b"])
        picked = y.ravel().take(np.arange(0, y.size, CLASSES) + target[on])
        e = np.exp(y, out=y)
        total, begun = (e @ np.stack([np.ones_like(start, e.dtype), start.astype(e.dtype)], 1)).T
        return picked - np.log(total), np.log(begun / total + e.dtype.type(1e-9))

    def gradient(self, x: np.ndarray, target: np.ndarray, on: np.ndarray, some: int = 16) -> np.ndarray:
        """Gradient of the mean loss; ``some`` windows at a time, so that what is at work stays in the processor's cache."""
        p, kind = self.p, self.flat.dtype.type
        into, unit = self.into(), kind(1 / max(1.0, on.sum()))
        out = {k: np.zeros_like(p[k]) for k in "EPOUb"}
        to_into = np.zeros_like(into)
        dhs = np.empty((*x.shape, WIDTH), self.flat.dtype)
        for i in range(0, len(x), some):
            part, n = x[i : i + some], len(x[i : i + some])
            flat = lambda m: m.reshape(n * x.shape[1], -1)  # noqa: E731, B023
            h = p["E"].take(part, 0)
            h += p["P"]
            f = np.empty((*part.shape, 3 * WIDTH + 1), h.dtype)
            f[..., -1] = 1
            np.matmul(h, into, out=f[..., :-1])
            q, k, v = f[..., :WIDTH], f[..., WIDTH : 2 * WIDTH], f[..., 2 * WIDTH : -1]
            a = attended(q, k, self.seen)
            z = a @ f[..., 2 * WIDTH :]
            share = 1 / z[..., WIDTH:]
            a *= share
            z = z[..., :WIDTH] * share
            g = flat(h) + flat(z) @ p["O"]
            d = logits(g, p["U"], p["b"])
            np.exp(d, out=d)
            weight = on[i : i + some].reshape(-1) * unit
            d *= (weight / (d @ np.ones(CLASSES, d.dtype)))[:, None]
            d.ravel()[np.arange(0, d.size, CLASSES) + target[i : i + some].ravel()] -= weight
            out["U"] += g.T @ d
            out["b"] += np.ones(len(d), d.dtype) @ d
            dg = d @ p["U"].T
            out["O"] += flat(z).T @ dg
            dz = (dg @ p["O"].T).reshape(z.shape)
            da = dz @ v.transpose(0, 2, 1)
            da -= np.einsum("nwd,nwd->nw", dz, z)[..., None]  # the sum of da * a
            da *= a
            back = np.empty((*part.shape, 3 * WIDTH), h.dtype)  # what comes back by queries, keys and values
            np.matmul(da, k, out=back[..., :WIDTH])
            np.matmul(da.transpose(0, 2, 1), q, out=back[..., WIDTH : 2 * WIDTH])
            np.matmul(a.transpose(0, 2, 1), dz, out=back[..., 2 * WIDTH :])
            to_into += flat(h).T @ flat(back)
            dh = dhs[i : i + some]
            np.matmul(back, into.T, out=dh)
            dh += dg.reshape(dh.shape)
            out["P"] += dh.sum(0)
        out["Q"], out["K"], out["V"] = np.split(to_into, 3, 1)
        out["Q"] = out["Q"] * kind(WIDTH**-0.5)
        order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
        at = x.ravel()[order]
        first = np.nonzero(np.append(True, at[1:] != at[:-1]))[0]
        out["E"][at[first]] = np.add.reduceat(dhs.reshape(-1, WIDTH).take(order, 0), first, 0)
        return np.concatenate([out[k].ravel() for k in self.SHAPES])


def attended(q: np.ndarray, k: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Weights, not yet divided by their sums, of the keys that each query sees."""
    s = q @ k.transpose(0, 2, 1)
    if not (s.max(initial=0) < 60 and s.min(initial=0) > -60):  # else no exponential overflows, nor vanishes
        s = np.where(seen > 0, s, -np.inf)
        s -= s.max(-1, keepdims=True)
    np.exp(s, out=s)
    s *= seen
    return s


def logits(g: np.ndarray, u: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of the classes, within the range of exponentials."""
    y = g @ u
    y += b
    if not (y.max(initial=0) < 60 and y.min(initial=0) > -60):
        y -= y.max(-1, keepdims=True)
    return y


def train_copy(flat: np.ndarray, x: np.ndarray, target: np.ndarray, on: np.ndarray, seed: int, rate: float = 0.01, repeats: int = 1, batch: int = 64) -> np.ndarray:
    """Passes of Adam over the windows, each in a seeded order."""
    flat = flat.copy()
    model = Attention(flat)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    r = np.random.default_rng(seed)
    order = np.concatenate([r.permutation(len(x)) for _ in range(repeats)])
    for t, i in enumerate(range(0, len(order), batch), 1):
        pick = order[i : i + batch]
        g = model.gradient(x[pick], target[pick], on[pick])
        m *= np.float32(0.9)
        m += np.float32(0.1) * g
        v *= np.float32(0.99)
        np.multiply(g, g, out=g)
        g *= np.float32(0.01)
        v += g
        size = np.sqrt(v, out=g)
        size *= np.float32((1 - 0.99**t) ** -0.5)
        size += np.float32(1e-8)
        np.divide(m, size, out=size)
        size *= np.float32(rate / (1 - 0.9**t))
        flat -= size
    return flat


def cluster(first: np.ndarray, second: np.ndarray, count: np.ndarray, top: int, classes: int, seed: int = 3) -> np.ndarray:
    """Classes of the ``top`` most frequent subwords by what stands before and after them."""
    m = np.zeros((top, top))
    m[first, second] = count
    rows, cols = m.sum(1, keepdims=True) + 1, m.sum(0, keepdims=True) + 1
    pmi = np.log1p(np.maximum(m * m.sum() / (rows * cols), 0))
    r = np.random.default_rng(seed)
    both = np.concatenate([pmi, pmi.T], 1)
    basis, _ = np.linalg.qr(both @ (both.T @ (both @ r.standard_normal((2 * top, 32)))))
    x = both @ (both.T @ basis)
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    weight = np.sqrt(rows[:, 0] + cols[0])
    centre = x[np.argsort(-weight, kind="stable")[:classes]].copy()
    for _ in range(20):
        of = (x @ centre.T).argmax(1)
        centre = np.zeros_like(centre)
        np.add.at(centre, of, x * weight[:, None])
        centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-9
    return of


class Vocabulary:
    """Subword counts of the whole training corpus, classes, and places in the embedding."""

    TOP, RARE = 2048, 7

    def __init__(self, counts: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], pieces: list[bytes]):
        size = len(counts)
        order = np.lexsort((np.arange(size), -counts))
        self.order = order
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        cls = np.array([min(3, len(p)) + 3 * p.startswith(b" ") for p in pieces] + [0])
        cls = np.where(np.arange(size) == size - 1, CLASSES - 1, cls)
        top = order[: self.TOP]
        cls[top] = np.where(top == size - 1, CLASSES - 1, self.RARE + cluster(*pairs, self.TOP, CLASSES - self.RARE - 1))
        self.cls = cls
        smooth = counts + 0.1
        total = np.bincount(cls, smooth, CLASSES)
        self.within = (np.log(smooth) - np.log(total[cls])).astype(np.float64)
        self.bias = np.log(np.maximum(total, 1e-3) / total.sum())
        self.slot = np.where(rank < OWN, rank, OWN + cls)
        self.starts = np.array([p.startswith(b" ") for p in pieces] + [True])
        self.start_share = (np.bincount(cls, smooth * self.starts, CLASSES) / np.maximum(total, 1e-9)).astype(np.float32)


def cut(v: Vocabulary, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, target classes, which places count, and the text of each window."""
    at, begin, of, lens, base = [], [], [], [], 0
    for i, s in enumerate(ids):
        starts, b = windows(len(s) - 1)
        at.append(starts + base)
        begin.append(b)
        of.append(np.full(len(starts), i))
        lens.append(np.minimum(len(s) - 1 - starts, WINDOW))
        base += len(s)
    flat = np.concatenate([*ids, np.zeros(WINDOW + 1, np.int64)])
    where = np.concatenate(at)[:, None] + np.arange(WINDOW)
    place = np.arange(WINDOW)[None, :]
    on = (place >= np.concatenate(begin)[:, None]) & (place < np.concatenate(lens)[:, None])
    return v.slot[flat[where]], v.cls[flat[where + 1]], on, np.concatenate(of)


def score_words(model: Attention, v: Vocabulary, ids: list[np.ndarray], chunk: int = 16) -> list[np.ndarray]:
    """Natural log probability of every word of each text, and of its end sign.

    Overlapping windows score each subword once, in the order of the text.
    First windows of texts go apart from later ones, which only look back at
    what they have in common with the one before.
    """
    x, target, on, _ = cut(v, ids)
    lp, ls = np.empty(x.shape, np.float32), np.empty(x.shape, np.float32)
    for some in (np.nonzero(on[:, 0])[0], np.nonzero(~on[:, 0])[0]):
        for i in range(0, len(some), chunk):
            rows = some[i : i + chunk]
            at, here = on[rows], np.nonzero(on[rows])
            where = rows[here[0]], here[1]
            lp[where], ls[where] = model.log_places(x[rows], target[rows], at, v.start_share)
    lp, ls = lp[on].astype(np.float64), ls[on].astype(np.float64)
    flat = np.concatenate([s[1:] for s in ids])
    lp += v.within[flat]
    first = np.nonzero(v.starts[flat])[0]
    word = np.add.reduceat(lp, first) - ls[first]
    after = np.append(first[1:], 0)
    word += np.where(flat[first] == len(v.starts) - 1, 0.0, ls[after])
    sizes = [int(v.starts[s[1:]].sum()) for s in ids]
    return np.split(word, np.cumsum(sizes)[:-1])


def training_windows(s: np.ndarray) -> list[bytes]:
    """Windows to train on: every id after the first is the target of one place of one window."""
    s = s.astype("<u2")
    return [s[start : start + WINDOW + 1].tobytes() for start in range(0, len(s) - 1, WINDOW)]


def _held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def _parts(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """The windows of rows sorted by part, part by part, at most ``most`` at a time."""
    part, kept = None, []
    for pdf in batches:
        for g, w in zip(pdf["part"], pdf["win"], strict=True):
            if kept and (g != part or len(kept) >= most):
                yield part, kept
                kept = []
            part = g
            kept.append(w)
    if kept:
        yield part, kept


def _fitter(state, turn: int):
    """Train a copy of the model on each part; one row: how many windows, and the mean of the copies."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flat, v = state.value
        total, n, least = np.zeros(len(flat)), 0, None
        for part, wins in _parts(batches, 2 * PART):
            lens = np.array([len(w) // 2 for w in wins])
            full = np.frombuffer(b"".join([w.ljust(2 * WINDOW + 2, b"\0") for w in wins]), "<u2").reshape(-1, WINDOW + 1)
            on = np.arange(WINDOW)[None, :] < (lens - 1)[:, None]
            got = train_copy(flat, v.slot[full[:, :-1]], v.cls[full[:, 1:]], on, turn, 0.01 / (1 + turn), PASSES)
            total += len(wins) * got.astype(float)
            n += len(wins)
            least = part if least is None else min(least, part)
        if n:
            yield pd.DataFrame([(least, n, (total / n).astype("<f4").tobytes())], columns=["part", "n", "flat"])

    return fit


def _mean(rows) -> tuple[int, np.ndarray]:
    """Windows and weighted mean of (n, flat) rows."""
    total, n = 0.0, 0
    for k, flat in rows:
        total = total + k * np.frombuffer(flat, "<f4").astype(float)
        n += k
    return n, (total / n).astype(np.float32)


def _average(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("part")
    n, flat = _mean(zip(pdf["n"], pdf["flat"]))
    return pd.DataFrame([(int(pdf["part"].min()), n, flat.astype("<f4").tobytes())], columns=["part", "n", "flat"])


def in_parts(win: DataFrame, n: int) -> DataFrame:
    """win(h, win) with the round and the part that each window is trained in: about PART windows in each."""
    parts = max(1, -(-n // (ROUNDS * PART)))
    return win.withColumns({"turn": F.pmod("h", F.lit(ROUNDS)).cast("int"), "part": F.pmod(F.shiftright("h", 20), F.lit(parts)).cast("int")})


def cut_texts(rows: DataFrame, spec, label: str = "lm-texts") -> DataFrame:
    """Texts of rows(doc_id, _text, held_out), cut once: stored rows of three kinds.

    (doc_id, held_out, ids, dealt) for each text: its subword ids (two bytes
    each) and, if it is learned from, the hashes that deal out its windows; (w, n) and (id, n) for words and subwords of texts
    that are learned from, summed up in part.
    """
    from collections import Counter
    from itertools import chain

    import xxhash

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        subwords, words = Subwords(spec.value), Counter()
        counts = np.zeros(subwords.end + 1, np.int64)
        digest = xxhash.xxh64_intdigest
        for pdf in batches:
            texts = [words_of(t) for t in pdf["_text"]]
            subwords.learn(texts)
            learned = ~pdf["held_out"].to_numpy(bool)
            words.update(chain.from_iterable(t for t, on in zip(texts, learned) if on))
            every, dealt = [], []
            for name, text, on in zip(pdf["doc_id"], texts, learned, strict=True):
                s = np.frombuffer(subwords.packed(text), "<u4").astype("<u2")
                every.append(s.tobytes())
                if on:
                    np.add.at(counts, s[1:], 1)
                    dealt.append([digest(w, digest(f"{i} {name}")) - 2**63 for i, w in enumerate(training_windows(s))])
                else:
                    dealt.append(None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "ids": every, "dealt": dealt, "w": None, "id": -1, "n": 0})
            if len(words) > 300_000:
                yield counted(words)
                words.clear()
        yield counted(words)
        some = np.nonzero(counts)[0]
        yield pd.DataFrame({"doc_id": None, "held_out": None, "ids": None, "dealt": None, "w": None, "id": some, "n": counts[some]})

    def counted(words) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": None, "held_out": None, "ids": None, "dealt": None, "w": list(words), "id": -1, "n": list(words.values())})

    return stored(rows.select("doc_id", "_text", "held_out").mapInPandas(gather, "doc_id string, held_out boolean, ids binary, dealt array<long>, w binary, id int, n long"), label, "zstd")


def train_model(docs: DataFrame, spec, text: str = "text", doc_id: str | None = None) -> tuple[np.ndarray, Vocabulary]:
    """Train on the whole text of every document of ``docs``: subword counts, bigrams and attention.

    A window is dealt to a round and a part by its document's id, its place
    and its ids, so copies of a text are spread. The number of parts grows with the windows.
    """
    rows = docs.select((F.col(doc_id) if doc_id else F.lit(None)).cast("string").alias("doc_id"), text_or_empty(text).alias("_text"), F.lit(False).alias("held_out"))
    return train_on(cut_texts(rows, spec), spec)


def train_on(seen: DataFrame, spec) -> tuple[np.ndarray, Vocabulary]:
    """``train_model`` on texts as ``cut_texts`` stored them."""
    spark = seen.sparkSession
    size = len(codec_of(spec.value).pieces) + 1
    counts = np.zeros(size, np.int64)
    for r in seen.where("id >= 0").groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most one row for each subword
        counts[r.id] = r.n
    texts = seen.where("dealt is not null").select("ids", "dealt")
    order = np.lexsort((np.arange(size), -counts))[: Vocabulary.TOP]
    place = np.full(1 << 16, -1, np.int32)
    place[order] = np.arange(len(order))

    def bigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = Vocabulary.TOP
        total = np.zeros(top * top, np.int64)
        for pdf in batches:
            p = place[np.frombuffer(b"\xff\xff".join(pdf["ids"]), "<u2")]  # between texts what is no subword
            on = np.nonzero((p[:-1] >= 0) & (p[1:] >= 0))[0]
            np.add.at(total, p[on] * top + p[on + 1], 1)
        some = np.nonzero(total)[0]
        yield pd.DataFrame({"pair": some, "n": total[some]})

    pairs = texts.select("ids").mapInPandas(bigrams, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most TOP squared rows
    at = pairs["pair"].to_numpy(np.int64)
    v = Vocabulary(counts, (at // Vocabulary.TOP, at % Vocabulary.TOP, pairs["n"].to_numpy(float)), codec_of(spec.value).pieces)
    flat = Attention.fresh(v.bias)
    n = texts.agg(F.coalesce(F.sum(F.size("dealt")), F.lit(0)).alias("n")).first().n
    win = texts.select("ids", F.posexplode("dealt").alias("at", "h")).select("h", F.substring("ids", F.col("at") * (2 * WINDOW) + 1, F.lit(2 * WINDOW + 2)).alias("win"))
    dealt = in_parts(win, n)
    wide = max(1, min(-(-n // (ROUNDS * PART)), 8 * spark.sparkContext.defaultParallelism))
    for turn in range(ROUNDS if n else 0):
        state = spark.sparkContext.broadcast((flat, v))
        # a number of its own, else small parts are put together in one task
        part = dealt.where(F.col("turn") == turn).select("part", "h", "win").repartition(wide, "part").sortWithinPartitions("part", "h", "win")
        means = part.mapInPandas(_fitter(state, turn), "part int, n long, flat binary")
        got = means.groupBy(F.pmod("part", F.lit(16)).alias("some")).applyInPandas(_average, "part int, n long, flat binary").collect()  # 16 models
        if got:
            flat = _mean((r.n, r.flat) for r in sorted(got, key=lambda r: r.part))[1]
        state.unpersist()
    return flat, v


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Documents with crc32(doc_id) mod 7 = 2 are held out (a null id never is);
    the others are learned from. base_score is an add-one unigram model over
    words and the end sign. score is the log10 probability of the same words
    and the end sign under a mixture: WORDS of the word's share of the training
    corpus, the rest from the attention model over the word's subwords. Null texts are empty and
    hold the end sign only. Without training documents every count is 0 and
    the model knows nothing (its classes are then one frequency class each).
    Repeated rows are learned from and scored each; an empty table gives an
    empty result; other columns are not read.

    Texts are read and cut once: what follows works on the stored ids, from
    which the words are put together again. Word counts are grouped on the
    word over all training texts. The FREQUENT
    most frequent are held by every task, the occurrences of the others are
    joined on the word, so that no frequent word is a hot key.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_or_empty(text).alias("_text"), _held_out(doc_id).alias("held_out"))
    seen = cut_texts(rows, spec)
    counts = stored(seen.where("w is not null").groupBy("w").agg(F.sum("n").alias("c")), "lm-counts")
    n_train = seen.where("dealt is not null").count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] + n_train, sums["v"] + (n_train > 0)
    frequent = spark.sparkContext.broadcast({bytes(r.w): r.c for r in counts.orderBy(F.desc("c"), "w").limit(FREQUENT).toLocalIterator()})
    model = spark.sparkContext.broadcast(train_on(seen, spec))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = codec_of(spec.value).pieces
        flat, v = model.value
        net, known = Attention(flat), frequent.value
        norm = np.log10(total + distinct + 1)
        unit = max(1, total) / WORDS  # from a share back to the count
        share = {w: WORDS * c / total for w, c in known.items()}
        end_share = np.log(WORDS * n_train / total) if n_train else -np.inf
        for pdf in batches:
            out, part, size = [], [], 0

            def finish(part):
                for s, got in zip(part, score_words(net, v, part), strict=True):
                    ws = b"".join(map(pieces.__getitem__, s[1:-1].tolist())).split(b" ")[1:]
                    mine = np.array([share.get(w, 0.0) for w in ws])
                    other = np.log(1 - WORDS) + got  # stays a logarithm: the share of a long word is below any double
                    known_ = np.nonzero(mine > 0)[0]
                    both = _LOG10 * float(np.logaddexp(np.log(mine[known_]), other[known_]).sum())
                    base = float(np.log10(mine[mine > 0] * unit + 1).sum()) + float(np.log10(n_train + 1)) - norm * (len(ws) + 1)
                    score = both + _LOG10 * float(np.logaddexp(end_share, other[-1]))
                    rare = [{"w": ws[i], "s": float(other[i])} for i in np.nonzero(mine == 0)[0]]
                    yield len(ws) + 1, len(ws) - len(rare) + (n_train > 0), base, score, rare

            for ids in pdf["ids"]:
                part.append(np.frombuffer(ids, "<u2").astype(np.int64))
                size += len(part[-1])
                if size > 200_000:
                    out += finish(part)
                    part, size = [], 0
            if part:
                out += finish(part)
            frame = pd.DataFrame(out, columns=["n_tokens", "known", "base", "score", "rare"])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"]}).reset_index(drop=True).join(frame)

    kind = dict(docs.dtypes)[doc_id]
    scored = stored(
        seen.where("ids is not null").select("doc_id", "held_out", "ids")
        .mapInPandas(run, "doc_id string, held_out boolean, n_tokens long, known long, base double, score double, rare array<struct<w:binary,s:double>>").withColumn("row", F.monotonically_increasing_id()),
        "lm-scored",
    )
    release(seen)
    c = F.coalesce("c", F.lit(0))
    share = F.ln(WORDS * F.col("c") / max(1, total))
    high, low = F.greatest(share, "s"), F.least(share, "s")
    both = F.when(c > 0, high + F.log1p(F.exp(low - high))).otherwise(F.col("s"))  # the sum of both shares, in logarithms
    rare = (
        scored.select("row", F.explode("rare").alias("x")).select("row", "x.w", "x.s").join(counts, "w", "left").groupBy("row")
        .agg(F.count("c").alias("more"), F.sum(F.log10(c + 1)).alias("worth"), (F.sum(both) * _LOG10).alias("rare_score"))
    )
    return scored.join(rare, "row", "left").select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("worth", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


def op5_lm_score(spark, sf_dir):
    """Unigram and attention scores of every document."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

"""Quality rules: plain counts of a text, and how public vocabularies cut it (tokeniser fertility)."""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mix64, small_batches, stored

#: Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20

#: Words remembered by one Python worker before it forgets those met once.
CACHE = 500_000
#: Bytes of text that a worker cuts into words at once (a longer text on its own).
BLOCK = 4_000_000

#: Measure -> (step of its histogram, least spread of a band as a share of the median, least spread).
MEASURES = {
    "chars_per_token": (0.01, 0.05, 0.02),
    "chars_per_piece": (0.01, 0.05, 0.02),
    "byte_share": (0.002, 0.0, 0.01),
    "entropy": (0.02, 0.05, 0.02),
}
#: A band reaches so many times its spread (the distance of the quartiles) beyond the quartiles.
REACH = 4.0
#: Documents that a group must have for a band of its own.
LEAST_DOCS = 50

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, n_tokens long, n_pieces long, chars_per_token double, chars_per_piece double, byte_share double, entropy double"


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Positions inside a window of ids that the text holds twice or more.

    A hash finds windows that may be equal; those are then ranked exactly,
    one place of the window after the other.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            h = mix64(h + ids[k : n + k].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    maybe = np.sort(order[np.concatenate([[False], same]) | np.concatenate([same, [False]])])
    rank = ids[maybe].astype(np.int64)
    for k in range(1, window):
        _, rank = np.unique(rank << 32 | ids[maybe + k].astype(np.int64), return_inverse=True)
    _, rank, times = np.unique(rank, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = maybe[times[rank] > 1]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def script_of(word: str) -> str:
    """First word of the Unicode name of the first letter (LATIN, CJK, HANGUL ...); empty without letters."""
    letter = word[:1]
    if letter.isascii() and letter.isalpha():
        return "LATIN"
    letter = next((c for c in word if c.isalpha()), "")
    return unicodedata.name(letter, "").split(" ")[0].split("-")[0] if letter else ""


class WordMeter:
    """Counts of words under two vocabularies, each word measured once.

    Neither vocabulary joins what white space parts, so the tokens of a text
    whose words are parted by single spaces are those of its words.
    """

    def __init__(self, ranks: bytes, pieces: bytes, pattern: str, limit: int = CACHE):
        import sentencepiece
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bytes_ = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.lengths = np.zeros(max(merges.values()) + 1, np.int64)
        self.lengths[list(merges.values())] = [len(m) for m in merges]
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.fallback = np.array([self.pieces.IsByte(i) for i in range(self.pieces.GetPieceSize())])
        self.limit = limit
        self.scripts: dict[str, int] = {"": 0}
        self.known: dict[bytes, int] = {}
        self.packed: list[bytes] = []
        #: characters, symbols, tokens, pieces, byte pieces and script of each word; texts it was met in
        self.rows, self.met = np.zeros((1024, 6), np.int64), np.zeros(1024, np.int64)

    def forget(self) -> None:
        """Keep the words met in most texts, at most half of the limit."""
        n = len(self.known)
        met = self.met[:n]
        least = max(2, int(np.partition(met, n - self.limit // 2)[n - self.limit // 2]) + 1)
        keep = np.nonzero(met >= least)[0]
        words = list(self.known)
        self.known = {words[i]: k for k, i in enumerate(keep.tolist())}
        self.packed = [self.packed[i] for i in keep.tolist()]
        self.rows, self.met = self.rows[keep], met[keep] // 2

    def learn(self, words: list[bytes]) -> None:
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")
        cut = self.pieces.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.fromiter(chain.from_iterable(cut), np.int32, int(sizes.sum()))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        fallen = np.concatenate([[0], np.cumsum(self.fallback[flat])])
        # one call for all words, as a call has its price; tokens end where words end
        upto_words = np.cumsum([len(w) + 1 for w in words])
        ends = np.cumsum(self.lengths[self.bytes_.encode_ordinary(" " + " ".join(texts))])
        tokens = np.diff(np.searchsorted(ends, upto_words, side="right"), prepend=0)
        first, scripts = len(self.known), self.scripts
        made = np.array([(len(t), len(w) - len(w.translate(None, SYMBOLS)), scripts.setdefault(script_of(t), len(scripts))) for w, t in zip(words, texts, strict=True)], np.int64)
        made = np.column_stack([made[:, :2], tokens, sizes, fallen[upto[1:]] - fallen[upto[:-1]], made[:, 2]])
        if first + len(words) > len(self.rows):
            more = max(len(words), len(self.rows))
            self.rows = np.concatenate([self.rows, np.zeros((more, 6), np.int64)])
            self.met = np.concatenate([self.met, np.zeros(more, np.int64)])
        self.rows[first : first + len(words)] = made
        raw, at = flat.tobytes(), (4 * upto).tolist()
        self.packed += [raw[a:b] for a, b in pairwise(at)]
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def measure_all(self, texts) -> list[tuple]:
        out, raws, size = [], [], 0
        for text in texts:
            raws.append((text or "").encode("utf-8", "surrogatepass"))
            size += len(raws[-1])
            if size > BLOCK:
                out += self._block(raws)
                raws, size = [], 0
        return out + self._block(raws)

    def _block(self, raws: list[bytes]) -> list[tuple]:
        if len(self.known) >= self.limit:
            self.forget()
        known = self.known
        each = [raw.split() for raw in raws]  # between ASCII white space
        new = {}
        for words in each:
            new.update(dict.fromkeys(w for w in words if w not in known))
        if new:
            self.learn(list(new))
        return [self._counts(raw, words) for raw, words in zip(raws, each, strict=True)]

    def _counts(self, raw: bytes, words: list[bytes]) -> tuple:
        if not words:
            return (0, 0, 0, 0, 0, "", 0, 0, None, None, None, None)
        known = self.known
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.met[ids] += 1
        rows = self.rows[ids]
        chars, symbols, tokens, pieces, fallen = (int(x) for x in rows[:, :5].sum(axis=0))
        lettered = rows[rows[:, 5] != self.scripts[""]].sum(axis=0)
        lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else [raw]
        seen = np.bincount(rows[:, 5], minlength=len(self.scripts)).tolist()
        script = min(((-n, name) for n, name in zip(seen, self.scripts, strict=True) if n and name), default=(0, ""))[1]
        each = np.frombuffer(b"".join(map(self.packed.__getitem__, ids.tolist())), np.int32)
        share = np.unique(each, return_counts=True)[1] / max(len(each), 1)
        entropy = float(-(share * np.log2(share)).sum())
        fertility = (float(lettered[0] / lettered[2]), float(lettered[0] / lettered[3])) if script else (None, None)
        return (len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(ids), script, tokens, pieces, *fertility, fallen / max(pieces, 1), abs(entropy))


_METERS: dict[int, WordMeter] = {}


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def measured(docs: DataFrame, text: str = "text", vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` and a struct _m of FIELDS.

    Null text has no words; a text without words has null measures. The two
    vocabulary files (ranks of a byte-level one, model of a piece one with
    byte fallback; a MB or two whatever the corpus) are read by the driver.
    """
    import public_tokenizers

    small_batches(docs.sparkSession)
    ranks, pieces = vocabularies or default_vocabularies()
    with open(ranks, "rb") as a, open(pieces, "rb") as b:
        spec = docs.sparkSession.sparkContext.broadcast((a.read(), b.read(), public_tokenizers.PATTERN))

    @F.pandas_udf(FIELDS)
    def measure(texts: pd.Series) -> pd.DataFrame:
        key = id(spec.value)
        if key not in _METERS:
            _METERS.clear()
            _METERS[key] = WordMeter(*spec.value)
        meter = _METERS[key]
        return pd.DataFrame(meter.measure_all(texts), columns=[x.split()[0] for x in FIELDS.split(", ")])

    return docs.withColumn("_m", measure(F.col(text).cast("string")))


def _groups(lang) -> list:
    """The groups whose band may judge a document, the narrowest first.

    All have documents of like length only (by powers of two of the words),
    since entropy grows with the length and shares scatter in short texts.
    """
    size = F.floor(F.log2(F.greatest(F.col("_m.n_words"), F.lit(1)))).cast("string")
    named = F.when(F.coalesce(F.trim(lang.cast("string")), F.lit("")) != "", lang.cast("string"))
    parts = [("lang", F.concat_ws("\x1f", F.lit("lang"), named, "_m.script", size), named.isNotNull()), ("script", F.concat_ws("\x1f", F.lit("script"), "_m.script", size), F.lit(True)), ("all", F.concat_ws("\x1f", F.lit("all"), size), F.lit(True))]
    return [F.when(on, key) for _, key, on in parts]


def fertility_bands(rows: DataFrame, lang: str | None = "lang", reach: float = REACH, least: int = LEAST_DOCS) -> DataFrame:
    """(group, measure, docs, low, high): the bands of every group of language or script and length.

    Quartiles come from counts over a fixed grid, so they are exact to the
    grid's step, the same in every run, and merge before the shuffle. A band
    goes ``reach`` spreads beyond the quartiles; groups of fewer than
    ``least`` documents have none.
    """
    language = F.col(lang) if lang else F.lit(None)
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.floor(F.col(f"_m.{m}") / step).cast("long").alias("cell"), F.lit(step).alias("step"), F.lit(share).alias("share"), F.lit(floor).alias("floor")) for m, (step, share, floor) in MEASURES.items()])
    each = rows.where("_m.n_words > 0").select(F.explode(F.array_compact(F.array(*_groups(language)))).alias("group"), cells.alias("c"))
    counts = each.select("group", F.explode("c").alias("c")).groupBy("group", "c.measure", "c.cell", "c.step", "c.share", "c.floor").agg(F.count("*").alias("n"))
    w = Window.partitionBy("group", "measure")
    ranked = counts.withColumns({"upto": F.sum("n").over(w.orderBy("cell")), "docs": F.sum("n").over(w)})
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("docs"), F.col("cell") * F.col("step")))
    quarters = ranked.groupBy("group", "measure", "docs", "step", "share", "floor").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), (at(0.75)).alias("q3"))
    spread = F.greatest(F.col("q3") + F.col("step") - F.col("q1"), F.col("share") * F.col("q2"), "floor")
    return quarters.where(F.col("docs") >= least).select("group", "measure", "docs", (F.col("q1") - reach * spread).alias("low"), (F.col("q3") + F.col("step") + reach * spread).alias("high"))


def quality_rules(docs: DataFrame, text: str = "text", lang: str | None = "lang", reach: float = REACH, least: int = LEAST_DOCS, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """The columns of ``docs`` but its text, the counts and measures of FIELDS, base_failed, outside and kept.

    base_failed: fewer than ten words, or more than a fifth of them in
    repeated five-word windows. outside lists the measures (characters per
    token of the byte-level and of the piece vocabulary over words with a
    letter, share of byte fallback and token entropy in bits over all) beyond the band of the document's
    language, script and length; where that group has too few documents, of
    its script and length, else of its length, and without any the method
    rejects nothing. kept is false if either holds.

    Every document is measured once, on its whole text, and what was found is
    written without the text; join the text back by id where it is needed.
    Null and empty texts fail the base rule; ties, repeated rows and columns
    of clashing names (replaced) are harmless; an empty table gives one.
    """
    made = [x.split()[0] for x in FIELDS.split(", ")]
    own = [c for c in docs.columns if c not in (*made, text, "_m", "_k", "base_failed", "outside", "kept")]
    tag = [F.col(lang).alias("_lang")] if lang else []
    rows = stored(measured(docs.select(*[F.col(f"`{c}`") for c in own], F.col(text).alias("_text"), *tag), "_text", vocabularies).drop("_text"), "rules")
    language = F.col("_lang") if lang else F.lit(None)
    band = F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high"))))
    bands = stored(fertility_bands(rows, "_lang" if lang else None, reach, least).groupBy("group").agg(band.alias("bands")), "bands")
    asked = rows.select("*", *[g.alias(f"_g{i}") for i, g in enumerate(_groups(language))])
    for i in range(3):
        asked = asked.join(bands.select(F.col("group").alias(f"_g{i}"), F.col("bands").alias(f"_b{i}")), f"_g{i}", "left")
    asked = asked.withColumn("_b", F.coalesce("_b0", "_b1", "_b2"))
    beyond = [F.when((F.col(f"_m.{m}") < F.col("_b")[m]["low"]) | (F.col(f"_m.{m}") > F.col("_b")[m]["high"]), F.lit(m)) for m in MEASURES]
    failed = (F.col("_m.n_words") < LEAST_WORDS) | (100 * F.col("_m.n_repeat_words") > MOST_REPEATED * F.col("_m.n_words"))
    out = asked.select(*[F.col(f"`{c}`") for c in own], *[F.col(f"_m.{c}").alias(c) for c in made], failed.alias("base_failed"), F.array_compact(F.array(*beyond)).alias("outside"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))


def op12_quality_rules(spark, sf_dir):
    """Counts, base rule and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "script", "outside", *MEASURES)

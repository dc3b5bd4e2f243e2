"""Document quality by hierarchical empirical Bayes over classifier, path and host evidence."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq, itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, small_batches, stored, text_or_empty

#: Words that may enter the classifier for each label, by strength of association.
LEXICON = 400
#: Documents of a label in which such a word must stand, and its least G statistic.
LEAST_DOCS, LEAST_G = 3, 15.0
#: Labelled documents that the classifier is fitted on (about; those whose ids have the lowest hashes).
FIT_ROWS = 20_000

TARGETS = ("toxic", "low")

#: What each byte is: upper case, lower case (all beyond ASCII too), digit, white space or sign.
_KIND = bytes(ord("U" if 65 <= b <= 90 else "l" if 97 <= b <= 122 or b >= 128 else "d" if 48 <= b <= 57 else " " if b in b" \t\n\v\f\r" else "s") for b in range(256))
#: Words of the lexicon: runs of letters, with A-Z in lower case; beyond ASCII anything is a letter.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LONE = re.compile(rb"(?<![^ ])s+(?![^ ])")
_ENDS = set(b".!?:;,")
STYLE = ["upper", "sign", "digit", "repeat", "lone", "short", "distinct", "log_words", "longest_run", "ends", "doubled", "length"]


def words_of(raw: bytes) -> set[bytes]:
    return set(raw.translate(_LETTERS).split())


def style(raw: bytes) -> list[float]:
    """How a text (UTF-8) is written: shares between 0 and 1 and logs of its lengths."""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STYLE)
    kinds = raw.translate(_KIND)
    upper, lower, digits = kinds.count(b"U"), kinds.count(b"l"), kinds.count(b"d")
    same = sum(map(eq, words, words[1:]))
    run = longest = 1
    if same:
        for a, b in zip(words, words[1:]):
            run = run + 1 if a == b else 1
            longest = max(longest, run)
    return [
        upper / max(1, upper + lower),
        kinds.count(b"s") / len(raw),
        digits / len(raw),
        same / n,
        len(_LONE.findall(kinds)) / n,  # words of signs only
        float(n < 20),
        len(set(words)) / n,
        float(np.log1p(n)) / 10,
        min(longest, 20) / 20,
        sum(map(_ENDS.__contains__, map(itemgetter(-1), words))) / n,
        min(1.0, kinds.count(b"ss") / n),  # signs in a row
        min(1.0, len(raw) / n / 20),
    ]


@dataclass
class Model:
    """Words of either label and the logistic weights of both."""

    words: dict[bytes, int] = field(default_factory=dict)
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    rates: dict[str, float] = field(default_factory=dict)

    def features(self, text: str) -> np.ndarray:
        """Style, its squares and roots, and counts of strong words, one column for each label's direction."""
        raw = text.encode("utf-8", "surrogatepass")
        s = np.array(style(raw))
        hits = np.zeros(4)
        for w in self.words.keys() & words_of(raw):
            hits[self.words[w]] += 1
        return np.concatenate([s, s * s, np.sqrt(s), np.minimum(hits, 5) / 5, hits > 0, [1.0]])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def strong_words(counts: DataFrame, target: str, n: int, k: int, limit: int = LEXICON) -> list[tuple[str, bool]]:
    """Words whose presence goes with the label (True) or against it, over all labelled documents.

    ``counts`` has for each word w the documents that have it and those of the
    label; n and k are the documents and those of the label. Association is
    the G statistic of the 2 x 2 table; only the ``limit`` strongest words
    come to the driver.
    """
    if not k or k == n:
        return []
    a, b = F.col("docs").cast("double"), F.col(target).cast("double")
    cells = [(b, a * k / n), (a - b, a * (n - k) / n), (k - b, (n - a) * k / n), (n - k - a + b, (n - a) * (n - k) / n)]
    g = sum((F.when(o > 0, 2 * o * F.ln(o / e)).otherwise(0.0) for o, e in cells), F.lit(0.0))
    for_it = b * n > a * k
    enough = F.when(for_it, b).otherwise(a - b) >= LEAST_DOCS
    best = counts.where(enough).select("w", for_it.alias("pro"), g.alias("g")).where(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "w").limit(limit)
    return [(r.w, r.pro) for r in best.collect()]


def usable_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, low, toxic), one row an id: the better quality, toxic if any row says so."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg((1 - F.max("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic"))
    return marks.where("low is not null and toxic is not null")


def train(docs: DataFrame, marks: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """Fit both classifiers, low quality and toxic, on about ``fit_rows`` labelled documents.

    These are the ones whose ids have the lowest hashes, all of them while
    there are fewer: a set of bounded size, which every task can hold. Word
    statistics are grouped on the word; only the strongest words, and the
    features of the chosen documents, reach the driver. The words are cut by
    the same bytes in training and in scoring.
    """
    spark = docs.sparkSession
    n_marks = marks.count()
    lowest = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, fit_rows / max(1, n_marks)))
    chosen = stored(marks.where(lowest), "quality-marks")
    # at most about fit_rows rows of three numbers, whatever the tables hold
    few = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("_text")).join(F.broadcast(chosen), "doc_id")
    labelled = stored(few, "quality-labelled")
    total = labelled.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TARGETS]).first()

    @F.pandas_udf("array<binary>")
    def distinct_words(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(words_of(t.encode("utf-8", "surrogatepass"))) for t in texts], dtype=object)

    seen = labelled.select(*TARGETS, F.explode(distinct_words("_text")).alias("w"))
    counts = stored(seen.groupBy("w").agg(F.count("*").alias("docs"), *[F.sum(t).alias(t) for t in TARGETS]).where(F.col("docs") >= LEAST_DOCS), "quality-words")
    model = Model()
    for first, target in enumerate(TARGETS):
        for w, pro in strong_words(counts, target, total["n"], total[target]):
            model.words.setdefault(bytes(w), 2 * first + (not pro))
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.features(t) for t in texts])

    rows = labelled.select(*TARGETS, features("_text").alias("f")).toPandas()
    for target in TARGETS:
        y = rows[target].to_numpy(float)
        if len(y) and 0 < y.sum() < len(y):
            model.weights[target] = fit_logistic(np.array(rows["f"].to_list()), y)
        elif total["n"]:
            model.rates[target] = total[target] / total["n"]
    release(chosen, labelled, counts)
    return model


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with _low and _toxic: the classifier's probabilities (null where it could not be fitted)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("low double, toxic double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for texts in batches:
            x = np.array([m.features(t) for t in texts]).reshape(len(texts), -1)
            out = {}
            for target in TARGETS:
                w = m.weights.get(target)
                out[target] = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) if w is not None and len(texts) else np.full(len(texts), m.rates.get(target, 0.0))
            yield pd.DataFrame(out)

    # else a filter on the posterior would be moved below it and score every text twice
    run = run.asNondeterministic()
    return docs.withColumn("_c", run(text_or_empty(text))).withColumn("_low", F.col("_c.low")).withColumn("_toxic", F.col("_c.toxic")).drop("_c")


def _logit(p):
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.ln(q / (1 - q))


def shrunk_rates(sites: DataFrame, keys: list[str], value: str, parent: Column) -> DataFrame:
    """(keys, rate): the mean of ``value`` of each group, shrunk toward its parent's rate.

    ``sites`` has n rows and the sum of ``value`` for each site. The groups'
    means are taken to spread around their parents' rates as a Beta
    distribution, whose strength is estimated by moments over all groups: the
    spread of the means beyond what groups of their sizes would show. Few rows
    leave a group near its parent, many let it speak for itself.
    """
    by = sites.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(value).alias("sum"), F.min(parent).alias("up"))
    mean, noise = F.col("sum") / F.col("n"), F.col("up") * (1 - F.col("up"))
    spread = by.agg(
        F.sum(F.col("n") * F.pow(mean - F.col("up"), 2) - noise).alias("extra"),
        F.sum(F.col("n") * noise - noise).alias("room"),
    ).first()
    extra, room = spread["extra"] or 0.0, spread["room"] or 0.0
    share = min(max(extra / room, 1e-4), 0.99) if room > 0 else 1e-4
    strength = 1 / share - 1
    return by.select(*keys, ((F.col("sum") + strength * F.col("up")) / (F.col("n") + strength)).alias("rate"))


def site_rates(sites: DataFrame) -> tuple[dict[str, float], DataFrame]:
    """Global rates, and (_host, _path, _host_t, _path_t) for both labels t.

    ``sites`` has for each host and path the labelled documents n and those of
    either label. A path's rate is shrunk toward its host's, a host's toward
    the global one. Sites without labels have no row.
    """
    total = sites.agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    top = {t: float(((total[t] or 0) + 0.5) / ((total["n"] or 0) + 1)) for t in TARGETS}
    hosts = paths = None
    for t in TARGETS:
        host = shrunk_rates(sites, ["_host"], t, F.lit(top[t])).withColumnRenamed("rate", f"_host_{t}")
        path = shrunk_rates(sites.join(host, "_host"), ["_host", "_path"], t, F.col(f"_host_{t}")).withColumnRenamed("rate", f"_path_{t}")
        hosts = host if hosts is None else hosts.join(host, "_host")
        paths = path if paths is None else paths.join(path, ["_host", "_path"])
    return top, paths.join(hosts, "_host")


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", limit: float = 0.5, keep_text: bool = True) -> DataFrame:
    """Every column of ``docs`` (without the text unless ``keep_text``) plus p_low, p_toxic, host_rate, path_rate and rejected.

    The classifier gives each document its odds of low quality and of
    toxicity. The labels of all labelled documents are summed by host and by
    path within the host (a path stands for any finer key of the site); a
    path's rate is shrunk toward its host's, a host's toward the global rate,
    with strengths estimated from the data, so that a sparse site says little.
    The posterior odds of a document are the classifier's, times the ratio of
    its path's odds to the global ones: labels speak for the site, the text
    for the document, and neither counts twice. A path without labels has its
    host's rate, a host without labels the global one. rejected: the
    posterior of either label is above ``limit``.

    Null hosts and paths are keys like others; null texts are empty texts, for
    which the site speaks beside the classifier; labels without an id or with
    a null, and ids without documents, are ignored; repeated labels count once
    (the better quality, toxic if any says so). Without usable labels nothing
    is rejected. Whole texts are scored, however long; repeated rows are each
    scored; a posterior of exactly ``limit`` is not rejected. An empty table
    gives an empty result. Columns with the names of the added ones are
    replaced.
    """
    made = ["p_low", "p_toxic", "host_rate", "path_rate", "rejected"]
    kept = [c for c in docs.columns if c not in made and (keep_text or c != text)]
    small_batches(docs.sparkSession)
    marks = stored(usable_labels(labels), "quality-labels")
    model = train(docs, marks, doc_id, text)
    if not model.weights:
        null = F.lit(None).cast("double")
        return docs.select(*[F.col(f"`{c}`") for c in kept], *[null.alias(c) for c in made[:-1]], F.lit(False).alias("rejected"))
    site = {"_host": F.coalesce(F.col(host).cast("string"), F.lit("")), "_path": F.coalesce(F.col(path).cast("string"), F.lit(""))}
    of = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(k) for k, c in site.items()]).join(marks, "doc_id")
    sites = stored(of.groupBy("_host", "_path").agg(F.count("*").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]), "quality-sites")
    top, rates = site_rates(sites)
    rates = stored(rates, "quality-rates")
    release(sites, marks)
    hosts = rates.groupBy("_host").agg(*[F.min(f"_host_{t}").alias(f"_up_{t}") for t in TARGETS])
    scored = classify(docs, model, text).withColumns(site).select(*[F.col(f"`{c}`") for c in kept], "_host", "_path", "_low", "_toxic")
    out = scored.join(rates.select("_host", "_path", *[f"_path_{t}" for t in TARGETS]), ["_host", "_path"], "left").join(hosts, "_host", "left")
    up = {t: F.coalesce(F.col(f"_up_{t}"), F.lit(top[t])) for t in TARGETS}
    own = {t: F.coalesce(F.col(f"_path_{t}"), up[t]) for t in TARGETS}
    post = {t: 1 / (1 + F.exp(-(_logit(F.col(f"_{t}")) + _logit(own[t]) - _logit(F.lit(top[t]))))) for t in TARGETS}
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        post["low"].alias("p_low"),
        post["toxic"].alias("p_toxic"),
        up["low"].alias("host_rate"),
        own["low"].alias("path_rate"),
        ((post["low"] > limit) | (post["toxic"] > limit)).alias("rejected"),
    )


def op2_quality(spark, sf_dir):
    """Posterior of low quality and of toxicity of every document, and whether it is rejected."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels, keep_text=False).select("doc_id", "p_low", "p_toxic", "host_rate", "path_rate", "rejected")

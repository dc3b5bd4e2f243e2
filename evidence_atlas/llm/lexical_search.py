"""Ranked lexical search over a length-stratified index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ASCII_LOWER, ASCII_UPPER, release, small_batches, stored, table

#: Items searched for in one pass over the documents, and bytes of their texts; more items take more passes.
ITEMS, ITEM_BYTES = 4096, 8_000_000
#: Documents of neighbouring strata that a task indexes at once.
SHARD = 16_384

#: A-Z become a-z; every other ASCII character but a-z and 0-9 parts terms.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The stated items, streamed to the driver, in blocks of bounded number and size: (item, distinct terms)."""
    block, size = [], 0
    for row in items.select(F.col(item).alias("i"), F.col(text).cast("string").alias("t")).toLocalIterator():
        block.append((row.i, list(dict.fromkeys(terms_of(row.t)))))
        size += len(row.t or "")
        if len(block) >= ITEMS or size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def postings(docs: DataFrame, id_: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tfs): number of terms of every document that has any, and its numbered terms with their tf."""
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n long, terms binary, tfs binary")
    def cut(texts: pd.Series) -> pd.DataFrame:
        known, rows = spec.value, []
        for t in texts:
            words = terms_of(t)
            ids = np.fromiter(map(known.get, words, repeat(-1)), np.int32, len(words))
            terms, tfs = np.unique(ids[ids >= 0], return_counts=True)
            rows.append((len(words), terms.tobytes(), tfs.astype(np.int32).tobytes()))
        return pd.DataFrame(rows, columns=["n", "terms", "tfs"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_).alias("doc"), cut(F.col(text).cast("string")).alias("p")).where("p.n > 0").select("doc", "p.*")


def document_frequencies(rows: DataFrame, size: int) -> list[int]:
    """Documents holding each numbered term; summed by task before the shuffle."""

    def part(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            if len(batch):
                total += np.bincount(np.frombuffer(b"".join(batch["terms"]), np.int32), minlength=size)
        at = np.nonzero(total)[0]
        if len(at):
            yield pd.DataFrame({"term": at, "df": total[at]})

    out = [0] * size
    for r in rows.select("terms").mapInPandas(part, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r.term] = r.df
    return out


class StratifiedIndex:
    """Postings of some documents by term, stratum (equal m) and tf.

    Documents are numbered by (m, id). The impact of a tf within a stratum is
    worked out once, however many documents have it; the greatest one of a
    term in a stratum bounds what the term can add there.
    """

    def __init__(self, docs: np.ndarray, m: np.ndarray, terms: list[bytes], tfs: list[bytes], weights: np.ndarray):
        self.docs, self.weights = docs, weights
        edges = np.concatenate([[0], np.nonzero(np.diff(m))[0] + 1, [len(m)]])
        self.edges, self.m = edges, m[edges[:-1]]
        count = np.array([len(t) // 4 for t in terms])
        doc = np.repeat(np.arange(len(docs)), count)
        term, tf = np.frombuffer(b"".join(terms), np.int32).astype(np.int64), np.frombuffer(b"".join(tfs), np.int32).astype(np.int64)
        stratum = np.searchsorted(edges, doc, side="right") - 1
        order = np.lexsort((doc, tf, stratum, term))
        self.doc, term, stratum, tf = doc[order], term[order], stratum[order], tf[order]
        new = np.ones(len(term), bool)
        new[1:] = (np.diff(term) != 0) | (np.diff(stratum) != 0) | (np.diff(tf) != 0)
        run = np.cumsum(new) - 1
        head = np.nonzero(new)[0]
        once = (1_000_000_000 * tf[head]) // (1000 * tf[head] + 8 * self.m[stratum[head]])
        self.impact = once[run] if len(run) else np.zeros(0, np.int64)
        # cells: one for each term and stratum, with the bounds of its postings
        cell = np.ones(len(term), bool)
        cell[1:] = (np.diff(term) != 0) | (np.diff(stratum) != 0)
        self.start = np.nonzero(cell)[0]
        self.end = np.append(self.start[1:], len(term))
        self.cell_stratum, self.cell_best = stratum[self.start], self.impact[self.end - 1] if len(term) else np.zeros(0, np.int64)
        self.of_term = np.searchsorted(term[self.start], np.arange(len(weights) + 1))

    def search(self, terms: np.ndarray, k: int, found: list[tuple], order_of) -> list[tuple]:
        """The k best (-score, order, id) of ``found`` and these documents.

        Strata are visited by falling bound, in waves that hold more
        documents each time, until the next bound is below the score of the
        k-th document found (an equal one may still hold a smaller id).
        """
        cells = np.concatenate([np.arange(self.of_term[t], self.of_term[t + 1]) for t in terms.tolist()]) if len(terms) else np.zeros(0, np.int64)
        if not len(cells):
            return found
        weight = np.repeat(self.weights[terms], self.of_term[terms + 1] - self.of_term[terms])
        bound = np.zeros(len(self.m), np.int64)
        np.add.at(bound, self.cell_stratum[cells], weight * self.cell_best[cells])
        order = np.argsort(-bound, kind="stable")
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        by = np.argsort(turn[self.cell_stratum[cells]], kind="stable")
        cells, weight = cells[by], weight[by]
        at = np.searchsorted(turn[self.cell_stratum[cells]], np.arange(len(order) + 1))
        upto = np.cumsum(np.diff(self.edges)[order])
        done, wave = 0, 16 * k
        while done < len(order):
            floor = -found[-1][0] if len(found) >= k else 1
            last = int(np.searchsorted(upto, (upto[done - 1] if done else 0) + wave)) + 1
            last = min(last, int(np.searchsorted(-bound[order], -floor, side="right")))
            if last <= done:
                break
            c, w = cells[at[done] : at[last]], weight[at[done] : at[last]]
            sizes = self.end[c] - self.start[c]
            rows = np.repeat(self.end[c] - np.cumsum(sizes), sizes) + np.arange(int(sizes.sum()))
            scores = np.zeros(len(self.docs), np.int64)
            np.add.at(scores, self.doc[rows], np.repeat(w, sizes) * self.impact[rows])
            good = np.nonzero(scores >= floor)[0]
            if len(good) > k:  # those above the k-th score, and all that equal it
                good = good[scores[good] >= np.partition(scores[good], len(good) - k)[len(good) - k]]
            found = sorted(found + [(-int(scores[g]), order_of(self.docs[g]), self.docs[g]) for g in good.tolist()], key=lambda r: r[:2])[:k]
            done, wave = last, 4 * wave
        return found


def search_block(rows: DataFrame, block: list[tuple], numbers: list[np.ndarray], weights: np.ndarray, k: int, id_type: str) -> DataFrame:
    """(item_no, doc, score): for every item of the block the k best documents of each task."""
    spec = rows.sparkSession.sparkContext.broadcast((numbers, weights))
    order_of = lambda d: (d is None, d)

    def find(batches):
        numbers, weights = spec.value
        best: list[list[tuple]] = [[] for _ in numbers]

        def index(parts):
            held = pd.concat(parts, ignore_index=True)
            shard = StratifiedIndex(held["doc"].astype(object).where(held["doc"].notna(), None).to_numpy(), held["m"].to_numpy(np.int64), held["terms"].tolist(), held["tfs"].tolist(), weights)
            for i, terms in enumerate(numbers):
                best[i] = shard.search(terms, k, best[i], order_of)

        parts, size = [], 0
        for batch in batches:
            parts.append(batch)
            size += len(batch)
            if size >= SHARD:
                index(parts)
                parts, size = [], 0
        if size:
            index(parts)
        out = [(i, d, -s) for i, rows in enumerate(best) for s, _, d in rows]
        if out:
            frame = pd.DataFrame(out, columns=["item_no", "doc", "score"])
            frame["doc"] = pd.array(frame["doc"], dtype="Int64") if id_type in ("bigint", "int", "smallint", "tinyint") else frame["doc"]
            yield frame

    return rows.mapInPandas(find, f"item_no int, doc {id_type}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, id_: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """(item, rank, id, score): the k best documents of every row of ``items``, of all rows of ``docs``.

    Documents are ranged by their normaliser m, so that a stratum lies in one
    task or a few neighbouring ones and a frequent m is split; each task
    indexes its documents for the terms of the items, visits its strata by
    bound, and gives k rows an item. Items are taken in blocks of bounded
    size; each block is one pass over the texts.

    Null or empty texts have no terms: such documents count nowhere and such
    items find nothing. Every row counts as a document and as an item of its
    own, repeated ids included; equal scores go by id, a null id last. Empty
    tables give no rows.
    """
    spark = docs.sparkSession
    id_type, item_type = dict(docs.dtypes)[id_], dict(items.dtypes)[item]
    out, counts = None, None
    for block in item_blocks(items, item, item_text):
        vocabulary: dict[bytes, int] = {}
        numbers = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in terms], np.int64) for _, terms in block]
        rows = stored(postings(docs, id_, text, vocabulary), "postings")
        if counts is None:
            counts = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).collect()[0]
        if not counts.docs or not vocabulary:
            release(rows)
            continue
        weights = np.array([math.floor(1000 * math.log((2 * counts.docs + 2) / (2 * df + 1))) for df in document_frequencies(rows, len(vocabulary))], np.int64)
        strata = rows.where("length(terms) > 0").withColumn("m", F.expr(f"100 - 90 + (90 * n * {counts.docs}L) div {counts.terms}L")).drop("n")
        parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(counts.docs / SHARD) * 4))
        ranged = strata.repartitionByRange(parts, "m", "doc").sortWithinPartitions("m", "doc")
        near = search_block(ranged, block, numbers, weights, k, id_type)
        w = Window.partitionBy("item_no").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        top = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"item_no int, _item {item_type}")
        part = top.join(names, "item_no").select(F.col("_item").alias(item), "rank", F.col("doc").alias(id_), "score")
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], f"`{item}` {item_type}, rank int, `{id_}` {id_type}, score long")


#: The same ranking from the definition.
OP11_SQL = f"""with t as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from documents),
  tf as (select doc_id, term, count(*)::bigint as tf from t group by all), n as (select doc_id, sum(tf)::bigint as n from tf group by all),
  total as (select count(*)::bigint as docs, sum(n)::bigint as terms from n), m as (select doc_id, 10 + (90 * n * docs) // terms as m from n, total),
  q as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark),
  w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from tf, total where term in (select term from q) group by term, docs),
  s as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score from q join w using (term) join tf using (term) join m using (doc_id) group by all)
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from s where score > 0 qualify rank <= 10"""


def op11_lexical(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))

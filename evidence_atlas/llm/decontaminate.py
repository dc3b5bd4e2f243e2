"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, small_batches, text_or_empty

#: Fixed value: a word is a run of letters and digits; beyond ASCII, of anything.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: The same by bytes: what is no part of a word is a space, A-Z are in lower case.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of a text, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


#: Consecutive words of an item that make a window.
WINDOW = 13

#: Words of items that one automaton holds at most (about 300 MB of Python);
#: more items go to further automata, which meet the documents one after another.
SHARD_WORDS = 400_000


class ItemAutomaton:
    """Generalised suffix automaton over word ids of many items.

    Each state knows its suffix link and length, the longest short item (of
    fewer than ``window`` words) that ends there, and, on demand, the items
    in which its strings occur.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set] = [set()]
        self.shortest = window
        for item, words in items:
            if not words:
                continue
            self.shortest = min(self.shortest, len(words))
            last = 0
            for w in words:
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
                while len(ends) < len(self.link):
                    ends.append(set())
                if item is not None:
                    ends[last].add(item)
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        for s in reversed(order):  # what a state has, its suffixes have too
            if self.link[s] > 0:
                ends[self.link[s]] |= ends[s]
        self.items = ends
        #: lengths of whole short items that end at the state, longest first, with their ids
        self.whole: list[list[tuple[int, set]]] = [[] for _ in self.link]
        for item, words in items:
            if 0 < len(words) < window:
                s = 0
                for w in words:
                    s = self.next[s][self.ids[w]]
                if found := next((x for x in self.whole[s] if x[0] == len(words)), None):
                    found[1].add(item)
                else:
                    self.whole[s].append((len(words), {item}))
        #: nearest state on the suffix path, itself included, at which a short item ends
        self.short_at = [-1] * len(self.link)
        for s in order:
            self.short_at[s] = s if self.whole[s] else (self.short_at[self.link[s]] if s else -1)
        #: last state of the suffix path, from here on, that still has a window's length
        self.widest = list(range(len(self.link)))
        for s in order:
            if s and self.length[self.link[s]] >= window:
                self.widest[s] = self.widest[self.link[s]]

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        made = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = made
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        cur = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return cur

    def scan(self, words: list[int], base: int, spans: list[list[int]], found: set) -> None:
        """Follow known words; add hit spans (merged, end exclusive) and item ids."""
        state = size = 0
        nexts, link, length, window, short_at = self.next, self.link, self.length, self.window, self.short_at
        for i, c in enumerate(words):
            while state and c not in nexts[state]:
                state = link[state]
                size = length[state]
            state = nexts[state].get(c, 0)
            size = size + 1 if state else 0
            reach = 0
            if size >= window:
                reach = size
                found |= self.items[self.widest[state]]
            s = short_at[state]
            while s > 0:
                for n, ids in self.whole[s]:
                    if n <= size:
                        reach = max(reach, n)
                        found |= ids
                s = short_at[link[s]]
            if reach:
                start, end = base + i + 1 - reach, base + i + 1
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, end])

    def hits(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Spans of hit word positions and the ids of items with occurring windows."""
        spans: list[list[int]] = []
        found: set = set()
        known = list(map(self.ids.get, words))
        least, n, i = self.shortest, len(known), 0
        if None not in known:
            self.scan(known, 0, spans, found)
        else:
            # only a run of known words at least as long as the shortest window can hold one
            while i + least <= n:
                j = i + least - 1
                while j >= i and known[j] is not None:
                    j -= 1
                if j >= i:
                    i = j + 1
                    continue
                j = i + least
                while j < n and known[j] is not None:
                    j += 1
                self.scan(known[i:j], i, spans, found)
                i = j + 1
        found.discard(None)
        return spans, found


def _shards(benchmark: DataFrame, window: int):
    """Automata over all items, each of at most SHARD_WORDS words (one item at least)."""
    batch, size = [], 0
    rows = benchmark.select(F.col("item_id"), text_or_empty().alias("text")).distinct()
    for row in rows.toLocalIterator():
        words = words_of(row.text)
        if batch and size + len(words) > SHARD_WORDS:
            yield ItemAutomaton(batch, window)
            batch, size = [], 0
        batch.append((row.item_id, words))
        size += len(words)
    yield ItemAutomaton(batch, window)


def merge_spans(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def remove_spans(text: str, spans: list[list[int]]) -> str:
    """The text without the hit words; what stands before and after is joined by a space."""
    if not spans:
        return text
    at = [m.span() for m in WORD.finditer(lower_ascii(text))]  # lower-casing moves nothing
    parts, start = [], 0
    for a, b in spans:
        parts.append(text[start : at[a][0]].rstrip())
        start = at[b - 1][1]
    return " ".join(p for p in (*parts, text[start:].lstrip()) if p)


def _scanner(held, state: str, clean: bool):
    """A function of texts and of what earlier automata found."""

    @F.pandas_udf(state)
    def scan(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        a, rows = held.value, []
        for t, old_spans, old_items in zip(texts, before["spans"], before["item_ids"], strict=True):
            words = words_of(t)
            spans, found = a.hits(words)
            if len(old_spans):
                spans = merge_spans([*([int(x), int(y)] for x, y in old_spans), *spans])
            row = (len(words), sum(y - x for x, y in spans), spans, sorted({*map(str, found), *old_items}))
            rows.append((*row, remove_spans(t, spans)) if clean else row)
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "spans", "item_ids", "clean_text"][: 5 if clean else 4])

    # else a filter on what it finds would be moved below it and scan every text twice
    return scan.asNondeterministic()


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, max_share: float = 0.05, clean: bool = True) -> DataFrame:
    """Every column of ``docs`` plus what the benchmark has in common with its text.

    Adds n_words, n_hit, spans (array of hit word positions, end exclusive),
    item_ids (sorted as strings), contaminated (share of hit words at least
    ``max_share``) and, with ``clean``, clean_text (the text without the hit spans). Lower-casing
    is of A-Z only. Nulls have no words: a null text is never contaminated, a
    null item is never found; an item without an id counts as hit but is not
    listed. An item of fewer than ``window`` words is one window. An empty
    benchmark hits nothing. Repeated items count once, repeated rows are each
    judged. Columns with the names of the added ones are replaced.

    The documents are scanned once for each automaton, with no shuffle. One
    automaton holds SHARD_WORDS words of items, so what is broadcast and what
    a worker holds is bounded however long the benchmark is.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = ["n_words", "n_hit", "spans", "item_ids", "contaminated"] + ["clean_text"] * clean
    kept = [c for c in docs.columns if c not in made]
    state = "n_words long, n_hit long, spans array<array<int>>, item_ids array<string>" + ", clean_text string" * clean
    out = docs
    for k, automaton in enumerate(_shards(benchmark, window)):
        held = spark.sparkContext.broadcast(automaton)
        scan = _scanner(held, state, clean)
        nothing = F.struct(F.array().cast("array<array<int>>").alias("spans"), F.array().cast("array<string>").alias("item_ids"))
        before = F.struct("_hits.spans", "_hits.item_ids") if k else nothing
        out = out.withColumn("_hits", scan(text_or_empty(text), before))
    n_words, n_hit = F.col("_hits.n_words"), F.col("_hits.n_hit")
    added = {"contaminated": (n_hit > 0) & (n_hit >= F.lit(max_share) * n_words - 1e-9)}
    return out.select(*[F.col(f"`{c}`") for c in kept], *[added.get(c, F.col(f"_hits.{c}")).alias(c) for c in made])


def op10_decontaminate(spark, sf_dir):
    """Hit words and items of every document; contaminated from a share of a twentieth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, benchmark, clean=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def brute_force(texts: list[str], items: list[tuple[object, str]], window: int = WINDOW) -> list[tuple]:
    """The same by comparing windows as tuples; for tests."""
    wins: dict[tuple, set] = {}
    for item, text in items:
        words = WORD.findall(lower_ascii(text or ""))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            wins.setdefault(tuple(words[i : i + window]), set()).add(item)
    sizes = sorted({len(w) for w in wins})
    out = []
    for text in texts:
        words, hit, found = WORD.findall(lower_ascii(text or "")), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (got := wins.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= got
        found.discard(None)
        ids = sorted(map(str, found))
        out.append((len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return out


#: The same for DuckDB: windows as joined words.
OP10_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), g as (
  select distinct item_id, least(len(ws), 13) as n, array_to_string(list_slice(ws, i, i + least(len(ws), 13) - 1), ' ') as k
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) as i from b where len(ws) > 0)
), w as (
  select doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') as k
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, (select distinct n from g) where len(ws) >= n)
), h as (
  select doc_id, i, n, item_id from w join g using (n, k)
), p as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from h) group by doc_id
), t as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, item_id::varchar as id from h where item_id is not null) group by doc_id
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join p using (doc_id) left join t using (doc_id)
"""

"""Byte-level BPE encoding and decoding with a published vocabulary."""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty

#: Fixed value: how the published vocabulary cuts a text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens remembered by one Python worker before it forgets them all.
CACHE = 400_000

_NO_RANK = 1 << 62

#: What is printed in ASCII and neither letter nor digit: one piece, however many of them stand together.
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes take
    the code points from 256 up, in order.
    """
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(rest)) for b in range(256)]


class BytePairCodec:
    """Encode and decode with merge ranks; built from a tokenizer file's text."""

    def __init__(self, spec: str):
        import regex

        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        ids = self.vocab
        #: left id << 32 | right id -> rank; the ids that the ranks make
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        alphabet = byte_alphabet()
        self.byte_ids = [ids.get(c) for c in alphabet]
        back = {c: b for b, c in enumerate(alphabet)}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.pieces: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.pieces[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        self.cut = regex.compile(PRE_TOKENS)
        specials = sorted(self.special, key=len, reverse=True)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.cache: dict[str, bytes] = {}
        self.limit = CACHE
        self._pairs: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply merges in rank order over a doubly linked list of symbols.

        The heap holds rank << 32 | position, so that ties of rank go to the
        left. An entry is stale when the pair that now starts at its position
        has another rank (a rank names one pair), and is then skipped.
        """
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, made, push, pop = self.ranks.get, self.made, heapq.heappush, heapq.heappop
        heap = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            if (rank := rank_of(left << 32 | right)) is not None:
                heap.append(rank << 32 | i - 1)
            left = right
        if not heap:
            return symbols
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        symbols.append(-1)
        while heap:
            entry = pop(heap)
            i = entry & 0xFFFFFFFF
            left, j = symbols[i], after[i]
            if left < 0 or j >= n or rank_of(left << 32 | symbols[j]) != entry >> 32:
                continue
            merged = symbols[i] = made[entry >> 32]
            symbols[j] = -1
            k = after[i] = after[j]
            before[k] = i
            if k < n and (rank := rank_of(merged << 32 | symbols[k])) is not None:
                push(heap, rank << 32 | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(symbols[h] << 32 | merged)) is not None:
                push(heap, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def merge_many(self, rows: np.ndarray) -> np.ndarray:
        """``merge`` for rows of symbols (filled up with -1) at once: each turn merges the first pair of least rank of every row."""
        if self._pairs is None:
            keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
            order = np.argsort(keys)
            self._pairs = np.append(keys[order], np.iinfo(np.int64).max), np.append(np.fromiter(self.ranks.values(), np.int64, len(keys))[order], _NO_RANK), np.array(self.made, np.int64)
        keys, values, made = self._pairs

        def rank(a, b):
            key = a << 32 | np.maximum(b, 0)
            at = np.searchsorted(keys, key)
            return np.where((keys[at] == key) & (a >= 0) & (b >= 0), values[at], _NO_RANK)

        out = rows
        at = np.arange(len(rows))
        rows = np.column_stack([rows, np.full(len(rows), -1)])
        ranks = np.column_stack([rank(rows[:, :-1], rows[:, 1:]), np.full(len(rows), _NO_RANK)])
        while len(rows):
            i = ranks.argmin(1)
            every = np.arange(len(rows))
            least = ranks[every, i]
            done = least == _NO_RANK
            if done.any():
                out[at[done]] = rows[done, :-1]
                left = ~done
                rows, ranks, at, i, least = rows[left], ranks[left], at[left], i[left], least[left]
                every = every[: len(rows)]
                if not len(rows):
                    break
            after = np.arange(rows.shape[1] - 1) > i[:, None]
            rows[:, :-1] = np.where(after, rows[:, 1:], rows[:, :-1])
            ranks[:, :-1] = np.where(after, ranks[:, 1:], ranks[:, :-1])
            rows[every, i] = made[least]
            ranks[every, i] = rank(rows[every, i], rows[every, i + 1])
            h = np.maximum(i - 1, 0)
            ranks[every, h] = np.where(i > 0, rank(rows[every, h], rows[every, i]), ranks[every, h])
        return out

    def pack_many(self, texts: list[str]) -> list[bytes]:
        """``_plain`` of many texts; short pieces of about one length are merged together, and nothing is remembered."""
        parts = [(t,) if t.isascii() and t[:1] == " " and t[1:].isalpha() else self.cut.findall(t) for t in texts]
        return self._joined([[p.encode("utf-8", "surrogatepass") for p in ps] for ps in parts])

    def pack_words(self, words: list[bytes]) -> list[bytes]:
        """``pack_many`` of words (UTF-8, without white space of ASCII) that follow a space."""
        parts, mixed = [], []
        for i, w in enumerate(words):
            if w.isalpha():  # letters of ASCII
                parts.append((b" " + w,))
                continue
            head = w.rstrip(_SIGNS)
            if head.isalpha():
                parts.append((b" " + head, w[len(head) :]))
            else:
                parts.append(None)
                mixed.append(i)
        for i in mixed:
            parts[i] = [p.encode("utf-8", "surrogatepass") for p in self.cut.findall(" " + words[i].decode("utf-8", "surrogatepass"))]
        return self._joined(parts)

    def _joined(self, parts: list) -> list[bytes]:
        """The ids of each text, given its pieces."""
        widths: dict[int, list[bytes]] = {}
        got: dict[bytes, bytes] = {}
        for p in set(chain.from_iterable(parts)):
            widths.setdefault(-(-len(p) // 4) * 4 if len(p) <= 48 else 0, []).append(p)
        for p in widths.pop(0, []):
            got[p] = self._packed(p.decode("utf-8", "surrogatepass")) if p else b""
        table = np.array([-1 if i is None else i for i in self.byte_ids], np.int32)
        for width, every in widths.items():
            for s in range(0, len(every), 8192):
                some = every[s : s + 8192]
                flat = np.array(some, f"S{width}").view(np.uint8).reshape(-1, width)
                lens = np.fromiter(map(len, some), np.int64, len(some))
                merged = self.merge_many(np.where(np.arange(width) < lens[:, None], table[flat], -1))
                on = merged >= 0
                packed, ends = merged[on].astype("<u4").tobytes(), (np.cumsum(on.sum(1)) * 4).tolist()
                got.update(zip(some, map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        return [got[ps[0]] if len(ps) == 1 else b"".join([got[p] for p in ps]) for ps in parts]

    def piece_ids(self, piece: str) -> list[int]:
        return self.merge([self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")])

    def _packed(self, piece: str) -> bytes:
        got = np.array(self.piece_ids(piece), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            self.cache[piece] = got
        return got

    def _plain(self, text: str) -> bytes:
        get, packed = self.cache.get, self._packed
        return b"".join([get(p) or packed(p) for p in self.cut.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for k, part in enumerate(self.cut_special.split(text)):
            out.append(np.array([self.special[part]], "<u4").tobytes() if k % 2 else self._plain(part))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, BytePairCodec] = {}


def codec_of(spec: str) -> BytePairCodec:
    """One codec for each vocabulary and Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = BytePairCodec(spec)
    return _CODECS[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_round_trip(docs: DataFrame, vocabulary: str | None = None, text: str = "text", ids: bool = False) -> DataFrame:
    """Every column of ``docs`` plus the encoding and decoding of its text.

    Adds n_tokens, ids_sha256, decoded_sha256 and, with ``ids``, the binary
    column token_ids (little-endian unsigned 32-bit) and decoded_text. Columns
    of the same names in ``docs`` are replaced. Null text counts as empty: no
    ids and the digests of nothing. Rows are encoded on their own, so ties,
    repeated rows, very long texts and empty tables need no care. The vocabulary file is read
    once by the driver (a few MB, whatever the corpus) and shipped with the
    function as a broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids binary, decoded_text string" if ids else "")

    @F.pandas_udf(kind)
    def encode(texts: pd.Series) -> pd.DataFrame:
        codec = codec_of(spec.value)
        rows = []
        for t in texts:
            packed = codec.encode(t)
            decoded = codec.decode(packed)
            row = (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            rows.append((*row, packed, decoded) if ids else row)
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "token_ids", "decoded_text"]
        return pd.DataFrame(rows, columns=names[: 5 if ids else 3])

    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids", "decoded_text"] * ids
    kept = [c for c in docs.columns if c not in made]
    out = docs.withColumn("_bpe", encode(text_or_empty(text)))
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"_bpe.{c}").alias(c) for c in made])


def op3_bpe(spark, sf_dir):
    """doc_id, n_tokens and the digests of ids and decoded text of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return bpe_round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")

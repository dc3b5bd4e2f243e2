"""Which of many words does a text hold? Dictionaries of any size against columns of any length."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words up to which each is looked for by an expression of its own.
FEW = 200
#: Words, and their characters, of one automaton; a larger dictionary makes several, one pass over the texts each.
AUTOMATON_WORDS, AUTOMATON_CHARACTERS = 500_000, 8_000_000

#: The automaton of the last dictionary that this Python worker has used.
_KEPT: dict[str, object] = {}


def word_blocks(words: DataFrame, word: str) -> Iterator[list[str]]:
    """Distinct non-empty words, streamed to the driver in blocks of bounded size."""
    block, size = [], 0
    for (w,) in words.select(word).where(F.col(word) != "").distinct().toLocalIterator():
        block.append(w)
        size += len(w)
        if len(block) >= AUTOMATON_WORDS or size >= AUTOMATON_CHARACTERS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _automaton(key: str, words: list[str]):
    """An Aho-Corasick automaton over the words, built once a worker and dictionary."""
    if key not in _KEPT:
        import ahocorasick

        made = ahocorasick.Automaton()
        for w in words:
            made.add_word(w, w)
        made.make_automaton()
        _KEPT.clear()
        _KEPT[key] = made
    return _KEPT[key]


def held(spark, block: list[str], text) -> Column:
    """array<string>: the words of a block that the text holds, each once; none for a null text.

    A few words are looked for one by one inside the JVM. More of them are
    broadcast (their size is bounded by the block) and found in a single run
    over the text, whatever their number, by batches of texts.
    """
    column = F.col(text) if isinstance(text, str) else text
    if len(block) <= FEW:
        return F.filter(F.array(*map(F.lit, block)), lambda w: F.coalesce(F.contains(column, w), F.lit(False)))
    key, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

    @F.pandas_udf("array<string>")
    def find(texts: pd.Series) -> pd.Series:
        automaton = _automaton(key, sent.value)
        return pd.Series([list({w for _, w in automaton.iter(t)}) if t else [] for t in texts], dtype=object)

    return find(column)


def holding(texts: DataFrame, text: str, words: DataFrame, word: str) -> DataFrame:
    """(columns of ``texts``, word): a row for each distinct word of ``words`` that ``text`` holds.

    The dictionary is never joined with the texts: each block of it is one
    pass over them. Null texts and empty words hold and are held by nothing;
    repeated rows of ``texts`` keep their number. No words, no rows.
    """
    out = None
    for block in word_blocks(words, word):
        one = texts.select("*", F.explode(held(texts.sparkSession, block, text)).alias(word))
        out = one if out is None else out.union(one)
    return out if out is not None else texts.select("*", F.lit("").alias(word)).where("false")

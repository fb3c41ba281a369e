"""Repetition inside a single document: the share of its words that lie in passages the text already had.

A passage is ``length`` or more consecutive words that began earlier in the same text; its first occurrence does not
count and occurrences may overlap. Documents are judged by a short-circuit cascade. Every rule but the last is a bound
that a document with the wanted share cannot miss, so a rule only ever drops documents that the last, exact, rule would
drop too. The order of the rules is set by their cost and rejection, measured on a bounded sample.

Defined results: null, empty and blank texts have no words, share 0, and are returned only if ``least`` is 0. Repeated
rows are judged row by row. Extra columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm import words

#: Texts on which cost and selectivity of the rules are measured, and the longest of them; the order of the rules alone depends
#: on it, never a result.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000


def _needed(n: np.ndarray, least: float) -> np.ndarray:
    """The smallest number of repeated words that reaches the share ``least`` of ``n`` words."""
    k = np.ceil(least * n - 1e-9).astype(np.int64)
    k += (k < least * n) & (k / np.maximum(n, 1) < least)
    return k


def repeats(w: words.Words, some: np.ndarray, n: int) -> np.ndarray:
    """How many of the ``n``-grams of each text in ``some`` are a second or later occurrence."""
    sizes = np.diff(w.first)[some]
    count = np.maximum(sizes - n + 1, 0)
    local = np.repeat(np.arange(len(some), dtype=np.uint64), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(w.first[some], count)
    g = (w.key if n == 1 else words.grams(w.key, n))[at] if len(at) else np.empty(0, np.uint64)
    packed = np.sort((local << np.uint64(40)) | (g >> np.uint64(24)))
    different = np.ones(len(packed), bool)
    different[1:] = packed[1:] != packed[:-1]
    distinct = np.bincount((packed[different] >> np.uint64(40)).astype(np.int64), minlength=len(some))
    return count - distinct


def covered(w: words.Words, some: np.ndarray, length: int) -> np.ndarray:
    """How many words of each text in ``some`` lie in a repeated passage of ``length`` or more words."""
    out = np.zeros(len(some), np.int64)
    sizes = np.diff(w.first)[some]
    count = np.maximum(sizes - length + 1, 0)
    if not count.sum():
        return out
    text = np.repeat(np.arange(len(some)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(w.first[some], count)
    g = words.grams(w.key, length)[at]
    order = np.lexsort((at, g, text))
    again = np.zeros(len(at), bool)
    again[order[1:]] = (g[order[1:]] == g[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    step = np.zeros(len(w.key) + 1, np.int64)
    np.add.at(step, at[again], 1)
    np.add.at(step, at[again] + length, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return inside[w.first[some + 1]] - inside[w.first[some]]


def rules(length: int, least: float) -> dict[str, Callable[[words.Words, np.ndarray], np.ndarray]]:
    """Bounds by name; each says which of the texts can still reach the share ``least``.

    A passage that is repeated has all its words, and all its n-grams for n up to ``length``, from an earlier place: ``c``
    words in such passages hold at least ``c * (length - n + 1) / length`` repeated n-grams.
    """

    def enough(w: words.Words, some: np.ndarray) -> np.ndarray:
        return np.diff(w.first)[some] > length

    def by(n: int) -> Callable[[words.Words, np.ndarray], np.ndarray]:
        def rule(w: words.Words, some: np.ndarray) -> np.ndarray:
            size = np.diff(w.first)[some]
            return repeats(w, some, n) * length >= _needed(size, least) * (length - n + 1)

        return rule

    return {"enough words": enough} | {f"repeated {n}-grams": by(n) for n in (1, 2, 4) if n < length}


def plan(texts: list[str | None], length: int, least: float) -> list[str]:
    """Names of the rules, the most rejection for its cost first."""
    w = words.split(texts)
    everything = np.arange(len(texts))
    gain = {}
    for name, rule in rules(length, least).items():
        began = time.perf_counter()
        kept = rule(w, everything)
        gain[name] = (1 - kept.mean() if len(kept) else 0) / max(time.perf_counter() - began, 1e-6)
    return sorted(gain, key=lambda name: -gain[name])


def _sample(df: DataFrame, text_col: str, seed: int = 5) -> list[str]:
    """About ``SAMPLE_ROWS`` texts from all over the table; at most twice as many, none longer than ``SAMPLE_CHARS``."""
    rows = df.count()
    some = df.select(text_col).sample(min(1.0, SAMPLE_ROWS / max(rows, 1)), seed).where(F.length(text_col) <= SAMPLE_CHARS)
    return [r[0] for r in some.limit(2 * SAMPLE_ROWS).collect()]


def share(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 8, least: float = 0.0) -> DataFrame:
    """``(id, n_words, n_repeated, share)`` of every document whose share of repeated words is at least ``least``.

    One pass without a shuffle. With ``least`` 0 every document is returned and no bound is asked.
    """
    narrow = df.select(id_col, text_col)
    order = plan(_sample(narrow, text_col), length, least) if least > 0 else []
    id_type = narrow.schema[0].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = rules(length, least)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in words.steps(texts):
                w = words.split(texts[a:b])
                some = np.arange(b - a)
                for name in order:
                    if len(some):
                        some = some[asked[name](w, some)]
                n = np.diff(w.first)[some]
                c = covered(w, some, length)
                s = c / np.maximum(n, 1)
                hit = s >= least
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a + some[hit])), pa.array(n[hit]), pa.array(c[hit]), pa.array(s[hit])], [id_col, "n_words", "n_repeated", "share"])

    return narrow.mapInArrow(judge, f"{id_col} {id_type}, n_words bigint, n_repeated bigint, share double")

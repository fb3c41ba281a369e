"""Packed vectors for the operators here: repeated rows dropped, and only the keys that are asked for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.packed import changes, codes, from_binary, grouped, to_binary, unit, usable, whole_groups  # noqa: F401

DIM = 64
#: Keys remembered by a task to drop repeated rows before the shuffle (a power of two), and texts that it numbers.
SLOTS = 1 << 18
NAMES = 1 << 18
#: Most bits of a filter of keys: 16 MB on the driver and in every executor.
MOST_BITS = 1 << 27


def mixed(x: np.ndarray) -> np.ndarray:
    """Whole numbers spread over all of 64 bits, different for different ones."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def mixed_rows(raw: np.ndarray) -> np.ndarray:
    """A number for each row of single-precision numbers, equal for equal rows."""
    return (raw.view(np.uint32).astype(np.uint64) * (2 * np.arange(raw.shape[1], dtype=np.uint64) + 1)).sum(1) * np.uint64(0x9E3779B97F4A7C15)


class Sent:
    """Which keys a task has sent already: a table with one key a slot. A key that another has pushed out counts as new, so
    nothing is held back wrongly, a key that repeats often is sent about once, and memory is bounded."""

    def __init__(self) -> None:
        self.held, self.full, self.names = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, bool), {}

    def _numbers(self, columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        """A number for each row of one column of whole numbers, or of one of text and one of whole numbers; and for which
        rows it is exact."""
        key = columns[-1].to_numpy().astype(np.int64)
        if len(columns) == 1:
            return key, np.ones(len(key), bool)
        encoded = columns[0].dictionary_encode()
        code = np.array([self.names.setdefault(n, len(self.names)) for n in encoded.dictionary.to_pylist()], np.int64)
        code = code[np.asarray(encoded.indices)] if len(code) else np.empty(0, np.int64)
        if len(self.names) > NAMES:  # numbers given so far end here; what was sent may be sent again
            self.names, self.full = {}, np.zeros(SLOTS, bool)
            return key, np.zeros(len(key), bool)
        return (code << 44) | (key & ((1 << 44) - 1)), (key >= 0) & (key < 1 << 44)

    def new(self, columns: list[pa.Array]) -> np.ndarray:
        """The rows that are not known to have been sent, in order."""
        key, exact = self._numbers(columns)
        first = np.zeros(len(key), bool)
        first[np.unique(key, return_index=True)[1]] = True
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        fresh = ~exact | (first & ~(self.full[slot] & (self.held[slot] == key)))
        put = slot[exact & first]
        self.held[put], self.full[put] = key[exact & first], True
        return np.flatnonzero(fresh)


class Bloom:
    """A filter of the keys of a table: it lets every one of them pass, and of the others few as long as the keys are not many
    more than ``MOST_BITS`` / 10. Its size is bounded, whatever the table. Built with native aggregates."""

    def __init__(self, keys: DataFrame, columns: list[str]) -> None:
        self.bits = min(MOST_BITS, max(1 << 16, 1 << (10 * keys.count()).bit_length()))
        h = F.xxhash64(*columns)
        places = F.array(h.bitwiseAND(F.lit(self.bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(self.bits - 1)))
        one = keys.select(F.explode(places).alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
        words = one.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.word = np.zeros(self.bits // 64, np.uint64)
        self.word[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)

    def passes(self, h: np.ndarray) -> np.ndarray:
        """For hashes (by ``xxhash64`` of the same columns in the same types) whether the key may be among the keys."""
        h = h.view(np.uint64)
        out = np.ones(len(h), bool)
        for p in (h & np.uint64(self.bits - 1), (h >> np.uint64(32)) & np.uint64(self.bits - 1)):
            out &= (self.word[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def pack(df: DataFrame, keys: list[str], vector_col: str = "embedding", dim: int = DIM, among: Bloom | None = None) -> DataFrame:
    """``keys`` (whole numbers, or text and whole numbers) and ``vec`` (the numbers as bytes) of the rows with a usable vector
    and no null among ``keys``.

    ``among``: only rows that pass this filter; what passes by chance must be dropped by what follows. Most repeated rows are
    dropped before any shuffle; the rest must be dropped by what follows.
    """
    narrow = df.select(*keys, F.col(vector_col).cast("array<float>").alias("vec")).dropna(subset=keys)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    if among is not None:
        narrow = narrow.withColumn("hash", F.xxhash64(*keys))
    shared = None if among is None else df.sparkSession.sparkContext.broadcast(among)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent()
        for batch in batches:
            if shared is not None:
                batch = batch.filter(pa.array(shared.value.passes(batch.column(len(keys) + 1).to_numpy())))
            at, rows = usable(batch.column(len(keys)), dim)
            columns = [batch.column(k).take(pa.array(at)) if len(at) < batch.num_rows else batch.column(k) for k in range(len(keys))]
            new = sent.new(columns)
            if len(new) < len(at):
                columns, rows = [c.take(pa.array(new)) for c in columns], rows[new]
            yield pa.RecordBatch.from_arrays([*columns, to_binary(rows)], [*keys, "vec"])

    return narrow.mapInArrow(run, f"{kinds}, vec binary")

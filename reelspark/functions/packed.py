"""Vectors as packed bytes in Arrow batches: which are usable, how they travel, and how tasks see whole groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a list column, and those vectors as float32 rows.

    Usable: not null, exactly ``dim`` finite numbers, not all zero.
    """
    offsets = np.asarray(column.offsets)
    values = column.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)  # a null becomes NaN
    if not len(flat):
        return np.empty(0, np.int64), np.empty((0, dim), np.float32)
    right = np.diff(offsets) == dim
    if column.null_count == 0 and right.all():
        at, rows = np.arange(len(column)), flat[offsets[0] : offsets[-1]].reshape(-1, dim)
    else:
        at = np.flatnonzero(right & np.asarray(column.is_valid()))
        rows = flat[offsets[at][:, None] + np.arange(dim)]
    # sums of squares of single-precision numbers neither overflow nor vanish in double precision
    size = np.einsum("ij,ij->i", rows, rows, dtype=np.float64)
    good = (size > 0) & (size < np.inf)
    return (at, rows) if good.all() else (at[good], rows[good])


def to_binary(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as one binary value each."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def from_binary(column: pa.Array | pa.ChunkedArray, dim: int, kind: type = np.float32) -> np.ndarray:
    """The rows of :func:`to_binary`; the column must have no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if not len(column):
        return np.empty((0, dim), kind)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[first : first + len(column) * dim * np.dtype(kind).itemsize].view(kind).reshape(len(column), dim)


def unit(rows: np.ndarray, kind: type = np.float64) -> np.ndarray:
    """Rows scaled to length one, safe for very small and very large numbers; lengths are worked out in double precision."""
    if kind == np.float32 and rows.dtype == np.float32:
        size = np.sqrt(np.einsum("ij,ij->i", rows, rows, dtype=np.float64))
        if len(rows) and size.min() > 1e-30 and size.max() < 1e30:
            return rows / size.astype(np.float32)[:, None]
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    rows /= np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return rows.astype(kind, copy=False)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the row before it in any of ``columns``; the first row does."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A number for each value of a column without nulls, equal for equal values."""
    encoded = column.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.unify_dictionaries().combine_chunks()
        if isinstance(encoded, pa.ChunkedArray):
            return np.concatenate([np.asarray(c.indices) for c in encoded.chunks]) if encoded.num_chunks else np.empty(0, np.int32)
    return np.asarray(encoded.indices)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches in which equal ``keys`` stand together; a group is never cut.

    Memory holds a batch and one group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = changes(*(codes(batch.column(k)) for k in keys))
        if held:
            new[0] = any(batch.column(k)[0] != held[-1].column(k)[-1] for k in keys)
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
            continue
        last = int(starts[-1])
        done = [*held, batch.slice(0, last)]
        if sum(b.num_rows for b in done):
            yield pa.Table.from_batches(done)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def grouped(df: DataFrame, keys: list[str], then: list[str]) -> DataFrame:
    """Rows of one group in one task, groups one after the other, each in the order of ``then``."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *then)


def packed(df: DataFrame, vector: str, dim: int, out: str = "vec") -> DataFrame:
    """``df`` with the usable vectors of ``vector`` as bytes in ``out``, in its place; rows without one are left out."""
    kept = [c for c in df.columns if c != vector]
    narrow = df.select(*kept, F.col(vector).cast("array<float>").alias(vector))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in narrow.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = usable(batch.column(len(kept)), dim)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(at)) for k in range(len(kept))), to_binary(rows)], [*kept, out])

    return narrow.mapInArrow(run, f"{kinds}{out} binary")


def normalised(df: DataFrame, vector: str, dim: int, out: str = "vec", norm: str = "norm") -> DataFrame:
    """``df`` with the usable vectors of ``vector`` scaled to length one, in its place, and their lengths; rows without one are
    left out. One pass in Arrow batches."""
    kept = [c for c in df.columns if c != vector]
    narrow = df.select(*kept, F.col(vector).cast("array<float>").alias(vector))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in narrow.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = usable(batch.column(len(kept)), dim)
            length = np.sqrt(np.einsum("ij,ij->i", rows, rows, dtype=np.float64))
            scaled = (rows / length[:, None]).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * dim), pa.array(scaled))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(at)) for k in range(len(kept))), pa.array(length), lists], [*kept, norm, out])

    return narrow.mapInArrow(run, f"{kinds}{norm} double, {out} array<double>")

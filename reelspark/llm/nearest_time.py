"""Records of two tables paired by nearest time within an entity.

The time line of an entity is cut into windows; a window and its entity make one trie. Points near a window's border are
given to the neighbouring window too, so a window answers alone, and an entity may be any part of the table. Before that,
points of an entity with the same time are made one, the one with the smallest number. Many windows are answered in one task
with x-fast tries: predecessor and successor of every query are found by binary search on the length of time prefixes, and the
nearer one within the tolerance is taken. Times are cut into microseconds for the tries only; which point is nearer is
decided with the times themselves.

Defined results: queries or points with a null entity, a null or not finite time, or a null number are left out; a tie goes
to the smaller number; a query that repeats is answered each time; a query with nothing within the tolerance is left out.
Empty tables give an empty result. Times must lie within 30,000 years of zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm import vectors
from reelspark.llm.trie import XFastTrie

#: Seconds in a window, and queries and points that meet in one task, on average.
WINDOW = 512.0
TASK_ROWS = 100_000
BITS = 30  # microseconds of a window with its borders


def _answers(points: pa.Table, queries: pa.Table, tolerance: float, window: float, passed: list[str]) -> pa.Table:
    """For each query the number of its nearest point, for all windows of one task."""
    names = [*passed, "number", "gap"]
    if not points.num_rows or not queries.num_rows:
        return pa.table({c: pa.array([], queries.schema.field(c).type) for c in passed} | {"number": pa.array([], pa.int64()), "gap": pa.array([], pa.float64())})
    n = points.num_rows
    both = vectors.codes(pa.chunked_array([*points.column("entity").chunks, *queries.column("entity").chunks]))
    slot = np.concatenate([points.column("slot").to_numpy(), queries.column("slot").to_numpy()])
    _, entity = np.unique(np.stack([both, slot]), axis=1, return_inverse=True)
    entity = entity.ravel().astype(np.int64)
    time = np.concatenate([points.column("time").to_numpy(), queries.column("time").to_numpy()])
    number = points.column("number").to_numpy()
    key = np.clip(np.floor((time - slot * window + tolerance) * 1e6), 0, (1 << BITS) - 1).astype(np.int64)
    order = np.lexsort((number, time[:n], key[:n], entity[:n]))
    e, k, t, number = entity[order], key[:n][order], time[:n][order], number[order]
    # points of one microsecond share a leaf: where it begins and ends
    first = np.flatnonzero(vectors.changes(e, k))
    last = np.append(first[1:], n) - 1
    at, before, behind = XFastTrie(e[first], k[first], BITS).around(entity[n:], key[n:])
    asked = time[n:]
    best = np.full(len(asked), -1)
    gap = np.full(len(asked), np.inf)

    def offer(place: np.ndarray) -> None:
        """Take the points at ``place`` (-1: none) where they are nearer, or as near with a smaller number."""
        p = np.maximum(place, 0)
        d = np.where(place >= 0, np.abs(t[p] - asked), np.inf)
        take = (d < gap) | ((d == gap) & (place >= 0) & (number[p] < number[np.maximum(best, 0)]))
        best[take], gap[take] = place[take], d[take]

    offer(np.where(before >= 0, last[np.maximum(before, 0)], -1))
    offer(np.where(behind >= 0, first[np.maximum(behind, 0)], -1))
    here = at >= 0
    for step in range(int((last - first)[at[here]].max(initial=-1)) + 1):
        place = first[np.maximum(at, 0)] + step
        offer(np.where(here & (place <= last[np.maximum(at, 0)]), place, -1))
    good = (best >= 0) & (gap <= tolerance)
    return pa.table([*(queries.column(c).filter(pa.array(good)) for c in passed), pa.array(number[best[good]]), pa.array(gap[good])], names)


def nearest(queries: DataFrame, points: DataFrame, entity: str, query_time: Column, point_time: Column, number: Column, keep: list[str], tolerance: float, window: float = WINDOW, rows: int | None = None) -> DataFrame:
    """``entity``, the ``keep`` columns of ``queries``, ``number`` of the nearest point and ``gap`` to it in time.

    ``rows``: about how many rows both tables have, if known; else they are counted.
    """
    if not 0 <= tolerance <= window or (window + 2 * tolerance) * 1e6 >= 1 << BITS:
        raise ValueError("the tolerance must not exceed the window, nor both the bits of a trie")
    total = queries.count() + points.count() if rows is None else rows
    tasks = max(1, -(-total // TASK_ROWS))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e12)
    passed = [entity, *keep]
    q = queries.select(F.col(entity).alias("entity"), query_time.cast("double").alias("time"), *(F.col(c).alias(f"q{i}") for i, c in enumerate(passed))).where(F.col("entity").isNotNull() & finite(F.col("time")))
    p = points.select(F.col(entity).alias("entity"), point_time.cast("double").alias("time"), number.cast("bigint").alias("number")).where(F.col("entity").isNotNull() & F.col("number").isNotNull() & finite(F.col("time")))
    p = p.groupBy("entity", "time").agg(F.min("number").alias("number"))
    q = q.withColumn("slot", F.floor(F.col("time") / window))
    reach = F.sequence(F.floor((F.col("time") - tolerance) / window), F.floor((F.col("time") + tolerance) / window))
    p = p.withColumn("slot", F.explode(reach))
    task = F.pmod(F.xxhash64("entity", "slot"), F.lit(tasks))
    held = [f"q{i}" for i in range(len(passed))]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in q.select(*held).schema) + ", number bigint, gap double"
    found = p.withColumn("task", task).groupBy("task").cogroup(q.withColumn("task", task).groupBy("task")).applyInArrow(lambda a, b: _answers(a, b, tolerance, window, held), schema)
    return found.select(*(F.col(h).alias(c) for h, c in zip(held, passed, strict=True)), "number", "gap")

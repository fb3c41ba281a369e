"""Runs of near-identical consecutive keyframes, each collapsed into one row.

The keyframes of a video in frame order are cut into chunks of frame ranges. Each chunk encodes its runs locally. The first
and the last run of a chunk stay open: a summary of runs is associative, so summaries of neighbouring chunks are merged,
many at a time and level by level, joining a chunk's last run with the next chunk's first where they are compatible. No task
holds more than a chunk, or the open runs of ``FAN`` chunks, so a video may be any part of the table. Vectors of frames that are
no keyframes are held back by a filter of bounded size before the shuffle.

Defined results: keyframes without a usable vector (null, wrong length, not finite, all zero, or absent) are passed over,
their neighbours are compared with each other; repeated keyframes and frames count once; null video or frame is left out;
``duration`` is the time from first to last keyframe, null if either has no finite ``pts_time`` (of several the smallest
holds). Extra columns are dropped; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm import vectors
from reelspark.runtime import cut

#: Frame numbers in a chunk, and chunks whose summaries are merged at once.
CHUNK = 4096
FAN = 256
SUMMARY = "video_id string, chunk bigint, first_frame bigint, last_frame bigint, n_keyframes bigint, first_time double, last_time double, opens boolean, closes boolean, first_vec binary, last_vec binary"
NAMES = [x.split()[0] for x in SUMMARY.split(", ")]


def _optional(rows: np.ndarray, at: np.ndarray, there: np.ndarray) -> pa.Array:
    """The rows at ``at`` as bytes, null where not ``there``."""
    index = np.full(len(at), -1)
    index[there] = np.arange(there.sum())
    return vectors.to_binary(rows[at[there]]).take(pa.array(index, mask=~there))


def encode(batches: Iterator[pa.RecordBatch], least: float, dim: int) -> Iterator[pa.RecordBatch]:
    """Runs of each chunk. Rows are sorted by video, chunk, frame and kind: 0 for a vector, 1 for a keyframe."""
    for table in vectors.whole_groups(batches, ["video_id", "chunk"]):
        group = np.cumsum(vectors.changes(vectors.codes(table.column("video_id")), table.column("chunk").to_numpy()))
        frame, kind = table.column("frame_idx").to_numpy(), table.column("kind").to_numpy()
        key = np.flatnonzero(kind == 1)
        key = key[key > 0]
        key = key[(kind[key - 1] == 0) & (frame[key - 1] == frame[key]) & (group[key - 1] == group[key])]
        if not len(key):
            continue
        raw = np.ascontiguousarray(vectors.from_binary(table.column("vec").combine_chunks().take(pa.array(key - 1)), dim))
        x = vectors.unit(raw)
        new = vectors.changes(group[key])
        joined = np.zeros(len(key), bool)
        joined[1:] = ~new[1:] & (np.einsum("ij,ij->i", x[1:], x[:-1]) >= least)
        head = np.flatnonzero(~joined)
        tail = np.append(head[1:], len(key)) - 1
        last = np.append(new[1:], True)
        time = table.column("pts_time").combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [
                table.column("video_id").combine_chunks().take(pa.array(key[head])),
                table.column("chunk").combine_chunks().take(pa.array(key[head])),
                pa.array(frame[key[head]]),
                pa.array(frame[key[tail]]),
                pa.array(tail - head + 1),
                time.take(pa.array(key[head])),
                time.take(pa.array(key[tail])),
                pa.array(new[head]),
                pa.array(last[tail]),
                _optional(raw, head, new[head]),
                _optional(raw, tail, last[tail]),
            ],
            NAMES,
        )


def merge(batches: Iterator[pa.RecordBatch], least: float, dim: int) -> Iterator[pa.RecordBatch]:
    """Joins open runs of neighbouring chunks of a group (video and ``above``); rows are sorted by chunk and frame."""
    for table in vectors.whole_groups(batches, ["video_id", "above"]):
        table = table.combine_chunks()
        group = np.cumsum(vectors.changes(vectors.codes(table.column("video_id")), table.column("above").to_numpy()))
        opens, closes = (table.column(c).to_numpy() for c in ("opens", "closes"))
        n = len(group)
        meet = np.flatnonzero((group[1:] == group[:-1]) & closes[:-1] & opens[1:])
        joined = np.zeros(n, bool)
        if len(meet):
            a = vectors.unit(vectors.from_binary(table.column("last_vec").take(pa.array(meet)), dim))
            b = vectors.unit(vectors.from_binary(table.column("first_vec").take(pa.array(meet + 1)), dim))
            joined[meet + 1] = np.einsum("ij,ij->i", a, b) >= least
        head = np.flatnonzero(~joined)
        tail = np.append(head[1:], n) - 1
        new = vectors.changes(group)
        opens, closes = new[head], np.append(new[1:], True)[tail]
        pick = lambda c, at: table.column(c).combine_chunks().take(pa.array(at))
        where = lambda c, at, there: table.column(c).combine_chunks().take(pa.array(at, mask=~there))
        total = np.add.reduceat(table.column("n_keyframes").to_numpy(), head)
        columns = [pick("video_id", head), pick("above", head), pick("first_frame", head), pick("last_frame", tail), pa.array(total), pick("first_time", head), pick("last_time", tail), pa.array(opens), pa.array(closes), where("first_vec", head, opens), where("last_vec", tail, closes)]
        yield pa.RecordBatch.from_arrays(columns, NAMES)


def collapse(keyframes: DataFrame, frames: DataFrame, least: float = 0.98, vector_col: str = "embedding", dim: int = vectors.DIM) -> DataFrame:
    """``(video_id, first_frame, last_frame, n_keyframes, duration)`` of every run, those of one keyframe included.

    ``keyframes``: ``video_id, frame_idx, pts_time``; ``frames``: ``video_id, frame_idx`` and the vectors.
    """
    time = F.col("pts_time").cast("double")
    keys = keyframes.select("video_id", F.col("frame_idx").cast("bigint").alias("frame_idx"), F.when(~F.isnan(time), time).alias("pts_time")).dropna(subset=["video_id", "frame_idx"])
    keys = keys.groupBy("video_id", "frame_idx").agg(F.min("pts_time").alias("pts_time"))
    among = vectors.Bloom(keyframes.select("video_id", F.col("frame_idx").cast("bigint").alias("frame_idx")).dropna(), ["video_id", "frame_idx"])
    packed = vectors.pack(frames.select("video_id", F.col("frame_idx").cast("bigint").alias("frame_idx"), vector_col), ["video_id", "frame_idx"], vector_col, dim, among)
    rows = packed.select("video_id", "frame_idx", F.lit(0).alias("kind"), "vec", F.lit(None).cast("double").alias("pts_time")).unionByName(keys.select("video_id", "frame_idx", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("vec"), "pts_time"))
    rows = rows.withColumn("chunk", F.floor(F.col("frame_idx") / CHUNK))
    found = cut(vectors.grouped(rows, ["video_id", "chunk"], ["frame_idx", "kind"]).mapInArrow(lambda b: encode(b, least, dim), SUMMARY), "runs")
    reach = found.agg((F.max("chunk") - F.min("chunk") + 1).alias("n")).first().n or 0
    done = []
    while True:
        is_open = F.col("opens") | F.col("closes")
        done.append(found.where(~is_open))
        top = reach <= FAN
        up = found.where(is_open).withColumn("above", F.lit(0).cast("bigint") if top else F.floor(F.col("chunk") / FAN))
        found = vectors.grouped(up, ["video_id", "above"], ["chunk", "first_frame"]).mapInArrow(lambda b: merge(b, least, dim), SUMMARY)
        if top:
            done.append(found)
            break
        found, reach = cut(found, "runs"), reach // FAN + 2
    every = reduce(DataFrame.unionByName, done)
    return every.select("video_id", "first_frame", "last_frame", "n_keyframes", (F.col("last_time") - F.col("first_time")).alias("duration"))

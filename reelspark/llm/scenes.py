"""The vector of every scene: the mean of the unit vectors of its distinct frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm import vectors

#: Frame numbers in a chunk. Scenes are cut at chunk borders, so neither a long video nor a long scene meets in one task.
CHUNK = 4096


def _sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Of each scene in each chunk the number of frames and the sum of their unit vectors.

    Rows are sorted by video, chunk, kind and frame; kind 0 is a frame, 1 a scene from ``frame_idx`` to ``to_frame``.
    """
    for table in vectors.whole_groups(batches, ["video_id", "chunk"]):
        chunk = table.column("chunk").to_numpy()
        group = np.cumsum(vectors.changes(vectors.codes(table.column("video_id")), chunk))
        place = group * np.int64(CHUNK) + table.column("frame_idx").to_numpy() - chunk * CHUNK
        kind = table.column("kind").to_numpy()
        scene = np.flatnonzero(kind == 1)
        frame = np.flatnonzero(kind == 0)
        frame = frame[vectors.changes(place[frame])]
        if not len(scene) or not len(frame):
            continue
        x = vectors.unit(vectors.from_binary(table.column("vec").combine_chunks().take(pa.array(frame)), dim))
        total = np.concatenate([np.zeros((1, dim)), np.cumsum(x, axis=0)])
        to = place[scene] + table.column("to_frame").combine_chunks().take(pa.array(scene)).to_numpy() - table.column("frame_idx").combine_chunks().take(pa.array(scene)).to_numpy()
        a, b = np.searchsorted(place[frame], place[scene]), np.searchsorted(place[frame], to, "right")
        some = b > a
        key = table.column("scene_key").combine_chunks().take(pa.array(scene[some]))
        yield pa.RecordBatch.from_arrays([key, pa.array((b - a)[some]), vectors.to_binary((total[b] - total[a])[some])], ["scene_key", "n_frames", "vec"])


def _whole(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Scenes put together from their chunks; the vector has length one. Opposite frames that cancel leave no vector."""
    for table in vectors.whole_groups(batches, ["scene_key"]):
        key = table.column("scene_key").to_numpy()
        head = np.flatnonzero(vectors.changes(key))
        total = np.add.reduceat(vectors.from_binary(table.column("vec"), dim, np.float64), head)
        n = np.add.reduceat(table.column("n_frames").to_numpy(), head)
        good = np.abs(total).max(1) > 1e-12 * n
        yield pa.RecordBatch.from_arrays([pa.array(key[head][good]), pa.array(n[good]), vectors.to_binary(vectors.unit(total[good], np.float32))], ["scene_key", "n_frames", "vec"])


def scene_vectors(scenes: DataFrame, frames: DataFrame, vector_col: str = "embedding", dim: int = vectors.DIM) -> DataFrame:
    """``(scene_key, n_frames, vec)`` with ``vec`` of length one in single precision; scenes without a usable frame or with an inverted range are
    left out, as are rows with a null key, video or bound. Repeated scenes and frames count once."""
    long = lambda c: F.col(c).cast("bigint").alias(c)
    reach = frames.groupBy("video_id").agg(F.min("frame_idx").cast("bigint").alias("low"), F.max("frame_idx").cast("bigint").alias("high"))
    ranges = scenes.select(long("scene_key"), "video_id", long("start_frame"), long("end_frame")).dropna().where("start_frame <= end_frame").dropDuplicates(["scene_key"])
    # a scene may end far beyond its video, so it is first cut to the frames there are
    ranges = ranges.join(reach, "video_id").select("scene_key", "video_id", F.greatest("start_frame", "low").alias("a"), F.least("end_frame", "high").alias("b")).where("a <= b")
    parts = ranges.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("a") / CHUNK), F.floor(F.col("b") / CHUNK))))
    first = F.col("chunk") * CHUNK
    parts = parts.select("video_id", "chunk", F.greatest("a", first).alias("frame_idx"), F.lit(1).alias("kind"), "scene_key", F.least("b", first + (CHUNK - 1)).alias("to_frame"), F.lit(None).cast("binary").alias("vec"))
    packed = vectors.pack(frames.select("video_id", long("frame_idx"), vector_col), ["video_id", "frame_idx"], vector_col, dim)
    nothing = F.lit(None).cast("bigint")
    rows = packed.select("video_id", F.floor(F.col("frame_idx") / CHUNK).alias("chunk"), "frame_idx", F.lit(0).alias("kind"), nothing.alias("scene_key"), nothing.alias("to_frame"), "vec").unionByName(parts)
    schema = "scene_key bigint, n_frames bigint, vec binary"
    sums = vectors.grouped(rows, ["video_id", "chunk"], ["kind", "frame_idx"]).mapInArrow(lambda b: _sums(b, dim), schema)
    return vectors.grouped(sums, ["scene_key"], []).mapInArrow(lambda b: _whole(b, dim), schema)

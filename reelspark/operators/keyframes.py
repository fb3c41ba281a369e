"""Keyframe selection: contiguous average-linkage clustering of each scene's frames, and frame/time maps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import packed, paths, vectors
from reelspark.operators import catalog
from reelspark.operators import scenes as ranges

#: Scenes shorter than this give one frame; scenes longer than ``LONG`` are cut into blocks, each giving one.
SHORT, LONG, BLOCK = 5, 512, 256


def silhouette(distance: np.ndarray, label: np.ndarray) -> float:
    """Mean silhouette of labels 0 to k-1 over a distance matrix; a point alone in its cluster, or with all distances zero,
    counts 0. Needs 2 to n-1 clusters."""
    n, k = len(label), int(label.max()) + 1
    if not 2 <= k < n:
        raise ValueError("the number of clusters must be between 2 and n - 1")
    member = np.zeros((n, k))
    member[np.arange(n), label] = 1
    size = member.sum(0)
    total = distance @ member
    own = size[label]
    a = total[np.arange(n), label] / np.maximum(own - 1, 1)
    mean = total / size
    mean[np.arange(n), label] = np.inf
    b = mean.min(1)
    most = np.maximum(a, b)
    s = np.where((own > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1), 0.0)
    return float(s.mean())


def nearest_to_mean(x: np.ndarray) -> int:
    """Place of the row nearest to the mean of all; the first of equals."""
    return int(((x - x.mean(0)) ** 2).sum(1).argmin())


def contiguous_clusters(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Label of each row, and the silhouette (minus infinity if none could be scored), after merging neighbours in time only, by least mean distance, at the best silhouette.

    Clusterings of at most sqrt(n) + 1 clusters are scored, down to two; the larger number wins ties. Each row is its own
    cluster if none could be scored. Sums over blocks of the distances come from one table, so a merge renews two means only.
    """
    n = len(x)
    if n < 2:
        return np.arange(n), -np.inf
    square = (x**2).sum(1)
    distance = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * x @ x.T, 0))
    np.fill_diagonal(distance, 0)
    area = np.zeros((n + 1, n + 1))
    area[1:, 1:] = distance.cumsum(0).cumsum(1)

    def linkage(a: int, b: int, c: int) -> float:
        """Mean distance between rows ``a`` to ``b - 1`` and ``b`` to ``c - 1``, from the sums over all leading rows."""
        return (area[b, c] - area[a, c] - area[b, b] + area[a, b]) / ((b - a) * (c - b))

    edge = list(range(n + 1))
    near = [linkage(i, i + 1, i + 2) for i in range(n - 1)]
    best, best_label = -np.inf, np.arange(n)
    most = int(np.sqrt(n)) + 1
    while len(near) > 1:
        k = near.index(min(near))
        del edge[k + 1], near[k]
        if k > 0:
            near[k - 1] = linkage(edge[k - 1], edge[k], edge[k + 1])
        if k < len(near):
            near[k] = linkage(edge[k], edge[k + 1], edge[k + 2])
        clusters = len(edge) - 1
        if clusters <= most and clusters < n:
            label = np.searchsorted(edge, np.arange(n), "right") - 1
            score = silhouette(distance, label)
            if score > best:
                best, best_label = score, label
    return best_label, float(best)


def select_in_scene(x: np.ndarray, half: bool = False) -> list[int]:
    """Places of the keyframes among a scene's vectors in time order. ``half``: arithmetic in half precision."""
    x = x.astype(np.float16 if half else np.float64)
    n = len(x)
    if not n:
        return []
    if n < SHORT:
        return [nearest_to_mean(x)]
    if n > LONG:
        return [a + nearest_to_mean(x[a : a + BLOCK]) for a in range(0, n, BLOCK)]
    label, _ = contiguous_clusters(x.astype(np.float64))
    return [int(np.flatnonzero(label == c)[0]) + nearest_to_mean(x[label == c]) for c in range(label.max() + 1)]


def select(scenes: DataFrame, frames: DataFrame, dim: int = 64, half: bool = False) -> DataFrame:
    """``video_id, frame_idx``: the keyframes of every video, each once.

    ``scenes``: ``video_id, start_frame, end_frame``; ``frames``: ``video_id, frame_idx, embedding``, of which unusable vectors
    are passed over. A scene of more than 512 frame numbers is cut into blocks of 256, each giving one keyframe, so no group that goes
    to Python is larger than a scene of 512.
    """
    unique = scenes.select("video_id", "start_frame", "end_frame").dropna().distinct()
    usable = packed.packed(frames.select("video_id", F.col("frame_idx").cast("bigint").alias("frame_idx"), "embedding").dropna(subset=["video_id", "frame_idx"]), "embedding", dim)
    inside = ranges.frames_of(unique, usable.dropDuplicates(["video_id", "frame_idx"]), bounds=True)
    first = F.greatest("low_frame", F.lit(0))
    long = F.col("high_frame") - first + 1 > LONG
    cut = inside.withColumn("block", F.when(long, F.floor((F.col("frame_idx") - first) / BLOCK)).otherwise(-1))

    groups = ["video_id", "start_frame", "end_frame", "block"]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in packed.whole_groups(batches, groups):
            table = table.combine_chunks()
            starts = np.flatnonzero(packed.changes(packed.codes(table.column("video_id")), *(table.column(g).to_numpy() for g in groups[1:])))
            x, block, picked = packed.from_binary(table.column("vec"), dim), table.column("block").to_numpy(), []
            for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
                one = x[a:b]
                picked += [a + i for i in (select_in_scene(one, half) if block[a] < 0 else [nearest_to_mean(one.astype(np.float16 if half else np.float64))])]
            at = pa.array(picked, pa.int64())
            yield pa.RecordBatch.from_arrays([table.column(c).combine_chunks().take(at) for c in ("video_id", "frame_idx")], ["video_id", "frame_idx"])

    return packed.grouped(cut.select(*groups, "frame_idx", "vec"), groups, ["frame_idx"]).mapInArrow(choose, "video_id string, frame_idx bigint").distinct()


def clusters(frames: DataFrame, group: str, frame: str = "frame_idx", vector: str = "embedding", dim: int = 64) -> DataFrame:
    """``group, frame, label, score, is_keyframe``: the usable frames of each group with the label of their contiguous cluster, the
    silhouette of the clustering (null if none could be scored) and whether the frame is nearest to the mean of its cluster.

    A group is a scene: it is clustered whole, so its distances must fit into one task. Rows that repeat group and frame count once.
    """
    rows = packed.packed(frames.select(group, F.col(frame).cast("bigint").alias(frame), vector).dropna(subset=[group, frame]), vector, dim)
    kind = rows.schema[group].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in packed.whole_groups(batches, [group]):
            table = table.combine_chunks()
            table = table.take(pa.array(np.flatnonzero(packed.changes(packed.codes(table.column(group)), table.column(frame).to_numpy()))))
            starts = np.flatnonzero(packed.changes(packed.codes(table.column(group))))
            x, n = packed.from_binary(table.column("vec"), dim).astype(np.float64), table.num_rows
            label, score, chosen = np.zeros(n, np.int64), np.full(n, np.nan), np.zeros(n, bool)
            for a, b in zip(starts, [*starts[1:], n], strict=True):
                label[a:b], score[a:b] = contiguous_clusters(x[a:b])
                for c in range(label[a:b].max() + 1):
                    own = a + np.flatnonzero(label[a:b] == c)
                    chosen[own[nearest_to_mean(x[own])]] = True
            done = pa.array(score, mask=~np.isfinite(score))
            yield pa.RecordBatch.from_arrays([table.column(group).combine_chunks(), table.column(frame).combine_chunks(), pa.array(label), done, pa.array(chosen)], [group, frame, "label", "score", "is_keyframe"])

    return packed.grouped(rows, [group], [frame]).mapInArrow(run, f"{group} {kind}, {frame} bigint, label bigint, score double, is_keyframe boolean")


def blocks(frames: DataFrame, group: str, frame: str, vector: str, dim: int, block: int = BLOCK) -> DataFrame:
    """``group, block, frame``: of every block of frame numbers the frame nearest to the block's mean."""
    cut = frames.withColumn("block", F.floor(F.col(frame) / block))
    return vectors.nearest_to_centroid(cut, [group, "block"], vector, frame, dim)


def time_map(keyframes: DataFrame, rates: DataFrame) -> DataFrame:
    """``video_id, id, name, pts_time, fps, frame_idx``: keyframes numbered from 0 by frame; no time where ``fps`` is not positive.

    ``rates``: ``video_id, fps``, each video once; a video without a rate has 0.
    """
    rows = keyframes.select("video_id", "frame_idx").dropna().distinct()
    numbered = catalog.ranked(rows, "video_id", ["frame_idx"], F.floor(F.col("frame_idx") / catalog.CHUNK), "ordinal")
    timed = numbered.join(rates.select("video_id", "fps"), "video_id", "left").withColumn("fps", F.coalesce("fps", F.lit(0.0)))
    return timed.select("video_id", F.col("ordinal").cast("int").alias("id"), paths.ordinal_name(F.col("ordinal"), ".webp").alias("name"), at_time(F.col("frame_idx"), F.col("fps")).alias("pts_time"), "fps", "frame_idx")


def at_time(frame: Column, fps: Column) -> Column:
    """Seconds at a frame, null without a rate."""
    return F.when(fps > 0, frame / fps)

"""Scene ranges from content scores, their clean-up, and frames by scene."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Content score at which a scene ends, and frames that a scene has at least.
THRESHOLD, LEAST_LENGTH = 27.0, 15


def inclusive(start: Column, end: Column, frame_count: Column) -> tuple[Column, Column]:
    """A half-open range from a detector as an inclusive one, not negative, not inverted, inside the video if its length is
    known."""
    a = F.greatest(F.lit(0), start)
    b = F.greatest(a, end - 1)
    return a, F.when(frame_count > 0, F.least(b, frame_count - 1)).otherwise(b)


def islands(scores: DataFrame, entity: str, frame: str = "frame_idx", score: str = "score", threshold: float = THRESHOLD) -> DataFrame:
    """``entity, scene_id, start_frame, end_frame``: a new scene begins at every score of ``threshold`` or more.

    Frames bear consecutive numbers. The cuts alone are put in order; first and last frame of an entity are partial aggregates, so
    the frames of a long video never meet in one task.
    """
    number = F.col(frame).cast("bigint")
    span = scores.groupBy(entity).agg(F.min(number).alias("first"), F.max(number).alias("last"))
    starts = span.select(entity, F.col("first").alias("start_frame")).unionByName(scores.where(F.col(score) >= threshold).select(entity, number.alias("start_frame"))).distinct()
    w = Window.partitionBy(entity).orderBy("start_frame")
    scenes = starts.select(entity, (F.row_number().over(w) - 1).cast("bigint").alias("scene_id"), "start_frame", (F.lead("start_frame").over(w) - 1).alias("end_frame"))
    return scenes.join(span, entity).select(entity, "scene_id", "start_frame", F.coalesce("end_frame", "last").alias("end_frame"))


def detect(scores: DataFrame, entity: str, frame: str = "frame_idx", score: str = "score", threshold: float = THRESHOLD, least: int = LEAST_LENGTH) -> DataFrame:
    """Scene ranges with a least length: a cut closer than ``least`` frames to the last one is passed over.

    Which cuts count depends on those before, so the cuts (not the frames) of a video are read in order. A video without a
    cut is one scene.
    """
    span = scores.groupBy(entity).agg(F.min(frame).cast("bigint").alias("first"), F.max(frame).cast("bigint").alias("last"))
    cuts = scores.where(F.col(score) >= threshold).select(entity, F.col(frame).cast("bigint").alias("cut"))
    rows = span.join(cuts, entity, "left")
    kind = scores.schema[entity].dataType.simpleString()

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, begin, last, n = None, 0, 0, 0
        for batch in batches:
            out = []
            for key, first, end, cut in batch.itertuples(index=False):
                if key != now:
                    if now is not None:
                        out.append((now, n, begin, last))
                    now, begin, last, n = key, first, end, 0
                if not pd.isna(cut) and cut - begin >= least:
                    out.append((now, n, begin, int(cut) - 1))
                    begin, n = int(cut), n + 1
            yield pd.DataFrame(out, columns=[entity, "scene_id", "start_frame", "end_frame"])
        if now is not None:
            yield pd.DataFrame([(now, n, begin, last)], columns=[entity, "scene_id", "start_frame", "end_frame"])

    ordered = rows.select(entity, "first", "last", "cut").dropna(subset=[entity]).repartition(entity).sortWithinPartitions(entity, "cut")
    return ordered.mapInPandas(follow, f"{entity} {kind}, scene_id bigint, start_frame bigint, end_frame bigint")


def whole_video(scenes: DataFrame, videos: DataFrame, entity: str = "video_id", count: str = "frame_count") -> DataFrame:
    """``scenes``, and one range over the whole video for videos without any whose length is known."""
    missing = videos.where(F.col(count) > 0).join(scenes.select(entity).distinct(), entity, "left_anti")
    return scenes.select(entity, "scene_id", "start_frame", "end_frame").unionByName(missing.select(entity, F.lit(0).cast("bigint").alias("scene_id"), F.lit(0).cast("bigint").alias("start_frame"), (F.col(count) - 1).cast("bigint").alias("end_frame")))


def frames_of(scenes: DataFrame, frames: DataFrame, entity: str = "video_id", frame: str = "frame_idx", chunk: int = 4096, bounds: bool = False) -> DataFrame:
    """Each frame with each scene whose range holds it, both ends included.

    Scenes are cut to the frames of their video and then into chunks of frame numbers, so the join is an equality of video
    and chunk and neither a long video nor a long scene meets in one task. Inverted ranges hold nothing.
    """
    reach = frames.groupBy(entity).agg(F.min(frame).cast("bigint").alias("low"), F.max(frame).cast("bigint").alias("high"))
    cut = scenes.join(reach, entity).where("start_frame <= end_frame").withColumn("a", F.greatest("start_frame", "low")).withColumn("b", F.least("end_frame", "high")).where("a <= b")
    parts = cut.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("a") / chunk), F.floor(F.col("b") / chunk)))).drop("low", "high")
    inside = F.col(frame).between(F.col("a"), F.col("b"))
    return parts.join(frames.withColumn("chunk", F.floor(F.col(frame) / chunk)), [entity, "chunk"]).where(inside).withColumnsRenamed({"a": "low_frame", "b": "high_frame"}).drop("chunk", *(() if bounds else ("low_frame", "high_frame")))

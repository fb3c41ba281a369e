"""Speech segments: filtering, alignment with the keyframes shown during them, and transcript records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import values

#: Seconds of a bucket in the interval join.
BUCKET = 64.0
#: Seconds of a transcript in one row.
CHUNK_SECONDS = 3600.0
#: Characters, mean log probability and probability of silence at which a segment is kept.
LEAST_CHARS, LEAST_LOGPROB, MOST_SILENCE = 3, -1.2, 0.65


def spoken(text: Column, avg_logprob: Column, no_speech_prob: Column) -> Column:
    """Whether a recognised segment is kept: long enough, and neither improbable nor probably silent where that is known."""
    return (F.length(values.strip(text)) >= LEAST_CHARS) & F.coalesce(avg_logprob >= LEAST_LOGPROB, F.lit(True)) & F.coalesce(no_speech_prob <= MOST_SILENCE, F.lit(True))


def interval_join(segments: DataFrame, points: DataFrame, entity: str = "video_id", key: str = "seg_no", bucket: float = BUCKET) -> DataFrame:
    """Every segment with ``imgs``, the frames whose time lies in it, both ends included, in order of time and frame.

    ``segments``: entity, key, ``start`` and ``end`` and whatever else; ``points``: entity, ``pts_time``, ``frame_idx``. Both
    sides meet by entity and bucket of time, so a long video is spread over many tasks. A segment is first cut to the times
    that its video has. A null or inverted range, and a null time, match nothing.
    """
    time = F.col("pts_time").cast("double")
    p = points.select(entity, time.alias("pts_time"), "frame_idx").where(time.isNotNull() & ~F.isnan(time) & (F.abs(time) < float("inf")))
    reach = p.groupBy(entity).agg(F.min("pts_time").alias("low"), F.max("pts_time").alias("high"))
    known = F.col("start").isNotNull() & F.col("end").isNotNull() & ~F.isnan("start") & ~F.isnan("end")
    ranges = segments.select(entity, key, "start", "end").where(known).distinct().join(reach, entity).select(entity, key, "start", "end", F.greatest("start", "low").alias("a"), F.least("end", "high").alias("b")).where("a <= b")
    pieces = ranges.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("a") / bucket), F.floor(F.col("b") / bucket))))
    near = pieces.join(p.withColumn("bucket", F.floor(F.col("pts_time") / bucket)), [entity, "bucket"]).where("pts_time between start and end")
    held = near.groupBy(entity, key, "start", "end").agg(F.transform(F.array_sort(F.collect_list(F.struct("pts_time", "frame_idx"))), lambda x: x["frame_idx"]).alias("imgs"))
    s, h = segments.alias("s"), held.alias("h")
    same = (F.col(f"s.{entity}") == F.col(f"h.{entity}")) & (F.col(f"s.{key}") == F.col(f"h.{key}")) & (F.col("s.start") == F.col("h.start")) & (F.col("s.end") == F.col("h.end"))
    empty = F.array().cast(held.schema["imgs"].dataType)
    return s.join(h, same, "left").select("s.*", F.coalesce("h.imgs", empty).alias("imgs"))


def csv_rows(segments: DataFrame) -> DataFrame:
    """``start``, ``end`` with three exact decimals as text, and ``text``, as the speech file has them."""
    return segments.withColumns({"start": values.three_decimals("start"), "end": values.three_decimals("end")})


def transcripts(aligned: DataFrame, entity: str = "video_id", chunk_seconds: float = CHUNK_SECONDS) -> DataFrame:
    """``entity, chunk, segments``: the transcript of each video as arrays of records in order of start, one row for each
    ``chunk_seconds`` of start time, numbered by them; records without a start (null or not a number) stand in a row without one.

    A long video has many rows, so none grows with it.
    """
    record = F.struct("start", "end", "text", "imgs")
    return aligned.groupBy(entity, F.floor(F.when(~F.isnan("start"), F.col("start")) / chunk_seconds).alias("chunk")).agg(F.array_sort(F.collect_list(record)).alias("segments"))

"""Sinks: vectors, ranges, maps, transcripts, predictions and manifests, in columnar and in legacy text forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions import paths
from reelspark.operators import manifests, ocr, transcripts


def embeddings(df: DataFrame, path: str, by: str = "collection", mode: str = "errorifexists") -> None:
    """Vectors as Parquet by collection; their order is in the frame column. A table without rows is an error."""
    if df.isEmpty():
        raise ValueError("there is no vector to write")
    df.write.mode(mode).partitionBy(by).parquet(path)


def file_lists(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A list of paths for each collection, in order."""
    df.repartition("collection").sortWithinPartitions("collection", "rel_path").select("collection", "rel_path").write.mode(mode).partitionBy("collection").text(path)


def ranges(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Scene ranges as text, two numbers a line, by video, in order."""
    rows = df.repartition("video_id").sortWithinPartitions("video_id", "start_frame")
    rows.select("video_id", F.concat_ws(" ", "start_frame", "end_frame").alias("value")).write.mode(mode).partitionBy("video_id").text(path)


def indices(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keyframe numbers as text, one a line, by video, each once and in order."""
    rows = df.select("video_id", "frame_idx").distinct().repartition("video_id").sortWithinPartitions("video_id", "frame_idx")
    rows.select("video_id", F.col("frame_idx").cast("string").alias("value")).write.mode(mode).partitionBy("video_id").text(path)


def keyframe_maps(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Maps as CSV by video; a missing time is empty."""
    rows = df.repartition("video_id").sortWithinPartitions("video_id", "id")
    rows.select("video_id", "id", "pts_time", "fps", "frame_idx").write.mode(mode).partitionBy("video_id").csv(path, header=True, nullValue="")


def speech_csv(segments: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Segments as CSV by video, times with three decimals."""
    rows = segments.repartition("video_id").sortWithinPartitions("video_id", "start")
    transcripts.csv_rows(rows).select("video_id", "start", "end", "text").write.mode(mode).partitionBy("video_id").csv(path, header=True)


def speech_json(aligned: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Aligned segments as JSON lines by video, times in full precision."""
    rows = aligned.repartition("video_id").sortWithinPartitions("video_id", "start")
    rows.select("video_id", "start", "end", "text", "imgs").write.mode(mode).partitionBy("video_id").json(path)


def predictions(records: DataFrame, path: str, by_group: bool = True, mode: str = "errorifexists") -> None:
    """Prediction records three ways: JSON lines with all 15 fields, CSV with the 13 plain ones, and, if ``by_group``, a folder for
    each group with its records of 11 fields as a JSON array in order of image ids (several arrays, one a line, for a group of more
    than ``ocr.GROUP_CHUNK``)."""
    records.write.mode(mode).json(f"{path}/predictions", ignoreNullFields=False)
    records.select(*ocr.ROW_FIELDS).write.mode(mode).csv(f"{path}/ocr_predictions", header=True, escape='"', emptyValue="")
    if by_group:
        groups = ocr.grouped(ocr.group_records(records), "group_id", "image_id", list(ocr.GROUP_FIELDS))
        named = groups.select(paths.group_file(F.col("group_id")).alias("file"), "chunk", F.col("records").alias("value"))
        named.repartition("file").sortWithinPartitions("file", "chunk").select("file", "value").write.mode(mode).partitionBy("file").text(f"{path}/groups")


def keyframe_manifest(found: DataFrame, prepared: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The keyframe manifest as CSV, in order of group and image over its files."""
    manifests.keyframe_manifest(found, prepared).write.mode(mode).csv(path, header=True, escape='"', emptyValue="")


def speech_maps(aligned: DataFrame, path: str, chunk_seconds: float = transcripts.CHUNK_SECONDS, mode: str = "errorifexists") -> None:
    """Transcripts as JSON arrays by video, one a line for each ``chunk_seconds``, in order of time."""
    rows = transcripts.transcripts(aligned, chunk_seconds=chunk_seconds).repartition("video_id").sortWithinPartitions("video_id", "chunk")
    rows.select("video_id", F.to_json("segments", {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).partitionBy("video_id").text(path)

"""Sources: directory trees, file lists, legacy text and array files, manifests and maps, all as DataFrames."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import paths, values

#: Fixed value: keys of a JSON manifest that may hold its rows, first first.
ROW_KEYS = ("keyframes", "frames", "selected_keyframes", "items", "data", "results")


def tree(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("mp4",), depth: int | None = None, any_case: bool = False) -> DataFrame:
    """``rel_path, size, modified`` of the files below ``root`` with one of ``suffixes``; a missing root is an error.

    Contents are not read. ``depth`` 1: only files in ``root`` itself.
    """
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    bare = base.split("://", 1)[-1]
    rel = F.regexp_extract(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), rf"^.*?\Q{bare}\E/(.*)$", 1)
    ending = F.regexp_extract(rel, r"[^/]\.([^./]+)$", 1)
    out = files.select(rel.alias("rel_path"), "size", "modified").where((F.lower(ending) if any_case else ending).isin(*suffixes))
    return out if depth is None else out.where(F.size(paths.parts(F.col("rel_path"))) <= depth)


def videos(spark: SparkSession, root: str) -> DataFrame:
    """The catalog of videos below ``root``, in order of path parts."""
    rel = F.col("rel_path")
    return tree(spark, root).select(rel, paths.collection(rel).alias("collection"), paths.in_collection(rel).alias("rel_in_collection"), "size").orderBy(paths.parts(rel))


def images(spark: SparkSession, root: str) -> DataFrame:
    """Every image below ``root``: its folder is the group, its stem the image."""
    rel = F.col("rel_path")
    found = tree(spark, root, paths.IMAGE_SUFFIXES, any_case=True)
    return found.select(F.regexp_replace(rel, "/?[^/]*$", "").alias("group_id"), paths.stem(rel).alias("image_id"), rel.alias("path"))


def subfolders(spark: SparkSession, root: str, lists: DataFrame | None = None, requested: list[str] | None = None) -> DataFrame:
    """Collection names: those requested, else all folders right below ``root``, empty ones too, and the names of file lists
    (column ``name``). One level is listed, on the driver; a missing root has no folders."""
    if requested:
        return spark.createDataFrame([(n,) for n in sorted(set(requested))], "name string")
    system, where = _place(spark, root)
    found = [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()] if system.exists(where) else []
    names = spark.createDataFrame([(n,) for n in found], "name string")
    if lists is not None:
        names = names.unionByName(lists.select(F.regexp_replace("name", "^files_list_|[.]txt$", "").alias("name")))
    return names.distinct().orderBy("name")


def _place(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it knows it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    system, where = _place(spark, path)
    return bool(system.exists(where))


def list_entry(entry: Column, ending: str | None = None) -> Column:
    """An entry of a file list without byte-order mark, blanks and quotes; with another suffix if that differs but for case."""
    text = F.regexp_replace(values.strip(F.regexp_replace(entry, "^\ufeff", "")), r"^[\"']+|[\"']+$", "")
    if ending is None:
        return text
    same = paths.suffix(text) == ending.lstrip(".").lower()
    return F.when(same | (text == ""), text).otherwise(paths.replace_suffix(text, ending))


def file_list(spark: SparkSession, path: str, base: str | None = None, ending: str | None = None, fallback: str | None = None) -> DataFrame:
    """Paths of a file list: one a line, blank lines and ``#`` comments left out, below ``base`` unless absolute.

    Without the list the videos below ``fallback`` are taken if that is given; else it is an error.
    """
    if fallback is None or exists(spark, path):
        rows = spark.read.text(path).select(F.col("value").alias("entry"))
    else:
        rows = tree(spark, fallback, paths.VIDEO_SUFFIXES, any_case=True).select(F.col("rel_path").alias("entry"))
    entry = list_entry(F.col("entry"), ending)
    out = rows.where(~F.ltrim(F.regexp_replace("entry", "^\ufeff", "")).startswith("#")).select(entry.alias("path")).where("path <> ''")
    return out if base is None else out.select(F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit(f"{base.rstrip('/')}/"), "path")).alias("path"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest as text columns: CSV with header, JSON lines, or JSON: a list, or an object with a list under a known key.

    Rows that are no objects are left out. Malformed JSON is an error when it is read, as is a JSON file of another shape; another
    suffix is an error at once. Values that are lists or objects come as JSON text. An empty manifest has no columns.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "csv":
        rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
        return rows.toDF(*(c.lstrip("\ufeff") for c in rows.columns))
    if kind == "jsonl":
        return objects(spark.read.text(path).where(F.trim("value") != ""))
    if kind == "json":
        return objects(listed_rows(spark.read.text(path, wholetext=True)))
    raise ValueError(f"no such kind of manifest: {kind}")


def _shape(text: Column) -> Column:
    """``OBJECT<...>``, ``ARRAY<...>`` or a plain type; malformed JSON is an error."""
    return F.schema_of_variant(F.parse_json(text))


def listed_rows(texts: DataFrame) -> DataFrame:
    """``value``: the rows of whole JSON texts (column ``value``), each a list or an object with a list under a known key."""
    inner = F.coalesce(*(F.when(_shape(F.get_json_object("value", f"$.{k}")).startswith("ARRAY"), F.get_json_object("value", f"$.{k}")) for k in ROW_KEYS))
    shape = _shape(F.col("value"))
    rows = F.when(shape.startswith("ARRAY"), F.col("value")).when(shape.startswith("OBJECT"), inner)
    checked = F.coalesce(rows, F.raise_error(F.lit("a JSON manifest must be a list, or hold one under a known key")).cast("string"))
    return texts.select(F.explode(F.from_json(checked, "array<string>")).alias("value"))


def objects(texts: DataFrame) -> DataFrame:
    """JSON texts (column ``value``) as a table: the objects among them, a text column for each key that any has."""
    held = texts.where(_shape(F.col("value")).startswith("OBJECT")).select(F.from_json("value", "map<string,string>").alias("row"))
    # the different keys of a manifest are its columns, which are few
    names = [r.name for r in held.select(F.explode(F.map_keys("row")).alias("name")).distinct().orderBy("name").collect()]
    return held.select(*(F.try_element_at("row", F.lit(n)).alias(n) for n in names))


def keyframe_map(spark: SparkSession, path: str) -> DataFrame:
    """``id, pts_time, fps, frame_idx`` of a map file; an empty time is null. Rows are in order of time and frame."""
    rows = spark.read.schema("id int, pts_time double, fps double, frame_idx bigint").csv(path, header=True)
    return rows.orderBy("pts_time", "frame_idx")


def map_rows(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a map file as text, and ``map_id``, the first id column there is; rows with a blank id are left out."""
    rows = spark.read.csv(path, header=True)
    there = values.aliased(rows.columns, "map")
    if not there:
        raise ValueError(f"no id column in {path}")
    return rows.withColumn("map_id", F.trim(there[0])).where("map_id <> ''")


def image_ids(spark: SparkSession, path: str) -> DataFrame:
    """``row, id`` of a map file in its order; a file without a column ``id`` is an error, whatever other ids it has."""
    rows = spark.read.csv(path, header=True)
    if "id" not in rows.columns:
        raise ValueError(f"no column id in {path}")
    return rows.select(F.monotonically_increasing_id().alias("row"), "id")


def whole_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``value`` of each line of a text file of whole numbers, in order; nothing for an empty file."""
    return spark.read.text(path).select(F.nullif(F.trim("value"), F.lit("")).cast("bigint").alias("value")).where("value is not null").orderBy("value")


def scene_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``path, scene_id, start_frame, end_frame`` from text files of two numbers a line."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("at", "line")).where(F.trim("line") != "")
    pair = F.split(F.trim("line"), r"\s+")
    return rows.select("path", F.col("at").cast("bigint").alias("scene_id"), F.get(pair, F.lit(0)).cast("bigint").alias("start_frame"), F.get(pair, F.lit(1)).cast("bigint").alias("end_frame"))


def array_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, frame_idx, embedding`` from array files of one vector a row; a row's number is its frame."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in batch.itertuples(index=False):
                x = np.load(io.BytesIO(content), allow_pickle=False)
                x = x.reshape(1, -1) if x.ndim == 1 and x.size else x
                for a in range(0, len(x), 10_000):
                    part = x[a : a + 10_000].astype(np.float32)
                    yield pd.DataFrame({"path": name, "frame_idx": np.arange(a, a + len(part)), "embedding": list(part)})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy").load(path).where("length > 0")
    return files.select("path", "content").mapInPandas(load, "path string, frame_idx bigint, embedding array<float>")


def probes(df: DataFrame, raw: str = "probe") -> DataFrame:
    """``df`` with the fields of the first stream of a probe's JSON text; all null if it has none or is malformed."""
    schema = "streams array<struct<codec_name:string,width:int,height:int,nb_frames:string,avg_frame_rate:string,r_frame_rate:string>>"
    stream = F.get(F.from_json(raw, schema)["streams"], F.lit(0))
    return df.select("*", *(stream[c].alias(c) for c in ("codec_name", "width", "height", "nb_frames", "avg_frame_rate", "r_frame_rate")))

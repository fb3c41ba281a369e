"""The jobs as a whole: videos to keyframes, keyframes to text, and speech to aligned transcripts.

What decodes, encodes, detects and recognises is given by the caller as functions from tables to tables, usually made with
:mod:`reelspark.backends`; the rest is here. Results are kept in a :class:`Store`, so that a job that is run again does only what
is not done.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import backends
from reelspark.functions import paths, values
from reelspark.operators import catalog, keyframes, manifests, ocr, scenes, transcripts
from reelspark.runtime import cut
from reelspark.sources import readers, sinks

Step = Callable[[DataFrame], DataFrame]


class Store:
    """Tables of results by entity, in a folder that all executors share.

    Every write adds files of its own and then a list of the entities that it has done, so a run that breaks off leaves nothing that is
    read, and an entity that is done again is read as it was done last. Nothing is rewritten.
    """

    def __init__(self, spark: SparkSession, path: str, entity: str = "video_id") -> None:
        self.spark, self.path, self.entity = spark, path.rstrip("/"), entity

    def done(self, name: str) -> DataFrame:
        """``entity, run``: what is done of a table, by its last run; without what was put away since."""
        where = f"{self.path}/done/{name}"
        if not readers.exists(self.spark, where):
            return self.spark.createDataFrame([], f"{self.entity} string, run bigint, kept boolean").select(self.entity, "run")
        last = self.spark.read.parquet(where).groupBy(self.entity).agg(F.max(F.struct("run", "kept")).alias("last"))
        return last.where("last.kept").select(self.entity, "last.run")

    def read(self, name: str) -> DataFrame:
        """A table as it was written last; it must have been written."""
        rows = self.spark.read.option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}").withColumn("run", F.col("run").cast("bigint"))
        return rows.join(self.done(name), [self.entity, "run"], "left_semi").drop("run")

    def write(self, name: str, rows: DataFrame, entities: DataFrame) -> None:
        """Adds ``rows`` of ``entities``, all of which count as done, also those without a row."""
        run = time.time_ns()
        rows.write.parquet(f"{self.path}/{name}/run={run}")
        self._note(name, entities, run, True)

    def put_away(self, name: str, entities: DataFrame) -> None:
        """Marks what is there of ``entities`` as not to be read again; the files can be removed when no run needs them."""
        self._note(name, entities, time.time_ns(), False)

    def _note(self, name: str, entities: DataFrame, run: int, kept: bool) -> None:
        entities.select(self.entity).distinct().select(self.entity, F.lit(run).alias("run"), F.lit(kept).alias("kept")).write.mode("append").parquet(f"{self.path}/done/{name}")

    def pending(self, name: str, entities: DataFrame, overwrite: bool = False) -> DataFrame:
        """Those of ``entities`` that are not done."""
        return catalog.pending(entities, self.done(name), [self.entity], overwrite)

    def require(self, name: str, entities: DataFrame, step: str, flag: str) -> None:
        """An error if any of ``entities`` is not done: it needs ``step``, which ``flag`` leaves out."""
        if not catalog.missing(entities, self.done(name), [self.entity]).isEmpty():
            raise FileNotFoundError(f"{name} is missing for some {self.entity}: run {step}, without {flag}")


@dataclass
class KeyframeOptions:
    """What a run of :func:`extract_keyframes` does. The values given are fixed ones: the usual thresholds."""

    content_threshold: float = scenes.THRESHOLD
    min_scene_len: int = scenes.LEAST_LENGTH
    sample_every: int = 1
    limit_videos: int | None = None
    num_shards: int = 1
    shard_index: int = 0
    overwrite: bool = False
    skip_encode: bool = False
    skip_scene_boundary: bool = False
    skip_clustering: bool = False
    skip_save_keyframes: bool = False
    clean_frames_embedding: bool = False
    dim: int = 64


def sampled(frames: DataFrame, every: int = 1, frame: str = "frame_idx") -> DataFrame:
    """Frames whose number is a multiple of ``every``."""
    return frames if every <= 1 else frames.where(F.col(frame) % every == 0)


def extract_keyframes(spark: SparkSession, videos: DataFrame, store: Store, encode: Step, score: Step, save: Step | None = None, options: KeyframeOptions | None = None) -> DataFrame:
    """Videos to vectors, scenes, keyframes and their map; returns the map of the videos taken.

    ``videos``: ``video_id, rel_path, fps, frame_count`` and whatever else the steps need. ``encode`` gives ``video_id, frame_idx,
    embedding``; ``score`` gives ``video_id, frame_idx, score``, the change of content from the frame before; ``save`` stores the
    images of ``video_id, frame_idx, name`` and gives rows with ``status``, of which any but ``ok`` is an error.
    """
    o = options or KeyframeOptions()
    order = [paths.parts(F.col("rel_path")), "video_id"]
    if o.num_shards > 1:
        videos = catalog.shard(videos, order, o.num_shards, o.shard_index, o.limit_videos).drop("position")
    elif o.limit_videos:
        videos = videos.orderBy(*order).limit(o.limit_videos)
    videos = cut(videos, "videos")
    ids = videos.select("video_id")
    if not o.skip_encode:
        new = cut(store.pending("embeddings", videos, o.overwrite), "pending")
        store.write("embeddings", sampled(encode(new), o.sample_every).select("video_id", F.col("frame_idx").cast("bigint").alias("frame_idx"), "embedding"), new)
    if not o.skip_scene_boundary:
        new = cut(store.pending("scenes", videos, o.overwrite), "pending")
        found = scenes.detect(score(new), "video_id", threshold=o.content_threshold, least=o.min_scene_len)
        count = new.select("video_id", F.col("frame_count").cast("bigint").alias("_n"))
        a, b = scenes.inclusive(F.col("start_frame"), F.col("end_frame") + 1, F.col("_n"))
        clean = found.join(count, "video_id", "left").select("video_id", "scene_id", a.alias("start_frame"), b.alias("end_frame"))
        store.write("scenes", scenes.whole_video(clean, new.select("video_id", F.col("frame_count").cast("bigint").alias("frame_count"))), new)
    if not o.skip_clustering:
        new = cut(store.pending("keyframes", videos, o.overwrite), "pending")
        store.require("embeddings", new, "encode", "skip_encode")
        store.require("scenes", new, "scene_boundary", "skip_scene_boundary")
        mine = new.select("video_id")
        chosen = keyframes.select(store.read("scenes").join(mine, "video_id", "left_semi"), store.read("embeddings").join(mine, "video_id", "left_semi"), o.dim)
        store.write("keyframes", chosen, new)
        if o.clean_frames_embedding:
            store.put_away("embeddings", ids)
    if not o.skip_save_keyframes:
        store.require("keyframes", ids, "clustering", "skip_clustering")
        new = cut(store.pending("maps", videos, o.overwrite), "pending")
        rows = cut(keyframes.time_map(store.read("keyframes").join(new.select("video_id"), "video_id", "left_semi"), new.select("video_id", "fps")), "maps")
        if save is not None:
            catalog.require(save(rows.join(new.drop("fps"), "video_id")), F.col("status") == "ok", "a keyframe could not be saved").write.format("noop").mode("overwrite").save()
        store.write("maps", rows, new)
    return store.read("maps").join(ids, "video_id", "left_semi")


def discover_keyframes(spark: SparkSession, root: str, manifest: str | None = None, layout: str = "auto", map_root: str | None = None, subfolders: list[str] | None = None, lists: DataFrame | None = None, limit: int | None = None, ignore_flag: bool = False, allow_missing_map: bool = False, default_root: bool = False) -> DataFrame:
    """``group_id, image_id, path, map_id, subfolder, source, seq``: the keyframe images to be read, each once, in order.

    A manifest goes before the layouts. ``recursive``: every image below ``root``; ``kf-embedding``: folders ``subfolder/video`` of
    images with a map ``map_root/subfolder/video.csv`` each. ``auto`` takes the second if there is a ``map_root`` and ``root`` is not the
    default place of raw images. Paths are seen from ``root``. Nothing found is an error.
    """
    if manifest is not None:
        rows = readers.manifest(spark, manifest)
        listing = readers.images(spark, root).select("path")
        found = manifests.items(rows.withColumn("_row", F.monotonically_increasing_id()), ignore_flag, "_row", root)
        asked = manifests.candidates(found.withColumn("asked", F.col("path")), [""], "asked").withColumn("candidate", F.regexp_replace("candidate", f"^(?:\\Q{root.rstrip('/')}\\E)?/+", ""))
        first = catalog.first_existing(asked.select("seq", F.col("candidate").alias("path"), "priority"), listing, ["seq"])
        there = found.drop("path").join(first.where("path is not null"), "seq")
        items = there.select("group_id", "image_id", "path", "map_id", F.lit("").alias("subfolder"), F.lit("manifest").alias("source"), F.format_string("%020d", "seq").alias("seq"))
    elif manifests.layout_of(layout, default_root, map_root is not None and readers.exists(spark, map_root)) == "recursive":
        items = manifests.from_tree(readers.tree(spark, root, paths.IMAGE_SUFFIXES, any_case=True))
    else:
        if map_root is None:
            raise ValueError("this layout needs a folder of maps")
        part = F.split("rel_path", "/")
        names = readers.subfolders(spark, root, lists, subfolders).select(F.col("name").alias("subfolder"))
        images = readers.tree(spark, root, paths.IMAGE_SUFFIXES, any_case=True).where(F.size(part) == 3).select(F.get(part, F.lit(0)).alias("subfolder"), F.get(part, F.lit(1)).alias("video_id"), F.col("rel_path").alias("path")).join(names, "subfolder", "left_semi")
        items = manifests.from_maps(images, map_files(spark, map_root).join(names, "subfolder", "left_semi"), allow_missing_map)
    return manifests.some(manifests.discover(items, limit))


def map_files(spark: SparkSession, root: str) -> DataFrame:
    """``subfolder, video_id, map_id, row`` of all map files ``subfolder/video.csv`` below ``root``; the id is the first id column that a
    file has, and rows without one are left out."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root, wholetext=True).withColumn("path", F.input_file_name())
    lines = F.split(F.regexp_replace("value", "^\\ufeff", ""), r"\r?\n")
    split = lambda line: F.transform(F.split(line, ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    names = text.select("path", lines.alias("lines")).withColumn("names", split(F.get("lines", F.lit(0))))
    at = F.coalesce(*(F.nullif(F.array_position("names", n), F.lit(0)) for n in values.ALIASES["map"]))
    rows = names.select("path", F.coalesce(at, F.raise_error(F.lit("a map has no id column")).cast("bigint")).alias("at"), F.posexplode("lines").alias("row", "line")).where("row > 0")
    place = F.split("path", "/")
    found = rows.select(F.element_at(place, -2).alias("subfolder"), paths.stem(F.col("path")).alias("video_id"), F.get(split(F.col("line")), (F.col("at") - 1).cast("int")).alias("map_id"), "row")
    return found.where(F.trim("map_id") != "")


def read_text(items: DataFrame, recognise: Step, out: str, prepare: Step | None = None, models: tuple[str, ...] = ("default",), threshold: float | None = ocr.CONFIDENCE, dedupe: bool = True, by_group: bool = True, overwrite: bool = False) -> dict[str, DataFrame]:
    """Keyframes to recognised text; returns the prediction records of each model that was run.

    ``items``: from :func:`discover_keyframes`. ``prepare`` gives ``group_id, image_id, path`` of prepared images. ``recognise`` takes the
    items with ``preprocessed_path`` and ``model`` and gives ``group_id, image_id, lines, latency_ms``, a row for each item, lines being
    structs with ``text`` and ``confidence``; an item without a row is an error. Models whose predictions are there are passed over
    unless ``overwrite``. The manifest of keyframes is written too.
    """
    spark = items.sparkSession
    keys = ["group_id", "image_id"]
    items = cut(items, "items")
    nothing = spark.createDataFrame([], "group_id string, image_id string, path string")
    prepared = nothing if prepare is None else cut(prepare(items).select(*keys, "path"), "prepared")
    mode = "overwrite" if overwrite else "errorifexists"
    whole = items.join(prepared.withColumnRenamed("path", "preprocessed_path"), keys, "left").withColumn("preprocessed_path", F.coalesce("preprocessed_path", F.lit("")))
    done = {}
    for model in values_of(models):
        root = paths.model_root(out, model, len(values_of(models)))
        if not overwrite and readers.exists(spark, f"{root}/predictions"):
            continue
        read = recognise(whole.withColumn("model", F.lit(model))).select(*keys, "lines", "latency_ms")
        both = manifests.strict_join(whole.withColumn("original_path", F.col("path")), read, keys, "an item was not recognised")
        records = cut(ocr.predictions(both, threshold, dedupe), "records")
        sinks.predictions(records, root, by_group, mode)
        done[model] = records
    if not readers.exists(spark, f"{out}/selected_keyframes") or overwrite:
        sinks.keyframe_manifest(items, prepared, f"{out}/selected_keyframes", mode)
    return done


def values_of(models: tuple[str, ...]) -> list[str]:
    """Names in lower case with underscores, each once, in order."""
    return list(dict.fromkeys(m.strip().lower().replace(" ", "_") for m in models if m.strip()))


def transcribe(videos: DataFrame, recognise: Step, maps: DataFrame, out: str, extract: Step | None = None, overwrite: bool = False) -> DataFrame:
    """Videos to speech segments and transcripts aligned with keyframes; returns the aligned segments.

    ``extract`` gives the sound of each video as rows with ``status``; those that failed are left out, and none left is an error.
    ``recognise`` gives ``video_id, seg_no, start, end, text, avg_logprob, no_speech_prob``. ``maps``: ``video_id, pts_time, frame_idx``. A
    video without a map has segments but no transcript.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    heard = videos if extract is None else backends.succeeded(cut(extract(videos), "sound"), some=True)
    raw = recognise(heard)
    kept = raw.where(transcripts.spoken(F.col("text"), F.col("avg_logprob"), F.col("no_speech_prob")))
    segments = cut(kept.select("video_id", "seg_no", "start", "end", values.strip(F.col("text")).alias("text")), "segments")
    sinks.speech_csv(segments, f"{out}/asr_segments", mode)
    known = segments.join(maps.select("video_id").distinct(), "video_id", "left_semi")
    aligned = cut(transcripts.interval_join(known, maps), "aligned")
    sinks.speech_maps(aligned, f"{out}/asr_transcript", mode=mode)
    return aligned


def encode_images(images: DataFrame, store: Store, encoder: Callable[[], Callable], dim: int, column: str = "values", size: int = 128, overwrite: bool = False, half: bool = True) -> DataFrame:
    """Keyframe images to vectors of length one; returns those of the groups taken.

    ``images``: the store's entity, ``image_id`` and ``column``, arrays of numbers of one length, usually from
    :func:`reelspark.media.normalised_columns`. Groups that are done are passed over unless ``overwrite``.
    """
    groups = cut(store.pending("image_vectors", images.select(store.entity).distinct(), overwrite), "pending")
    rows = images.join(groups, store.entity, "left_semi").select(store.entity, "image_id", column)
    store.write("image_vectors", backends.run_batches(rows, encoder, column, dim, size=size, half=half), groups)
    return store.read("image_vectors").join(images.select(store.entity).distinct(), store.entity, "left_semi")


def resize_videos(videos: DataFrame, store: Store, chain: tuple[str, ...] = ("resize_hardware", "resize"), registry: backends.Registry | None = None, overwrite: bool = False) -> DataFrame:
    """Videos (the store's entity, ``path``, ``out``) at another size by the first backend that does it; returns a row with ``status``
    and ``error`` for each video tried. Those that fail count as not done and are tried again by the next run."""
    new = cut(store.pending("resized", videos, overwrite), "pending")
    tried = cut(backends.run(new, list(chain), "written string", [store.entity], registry), "tried")
    done = tried.where("status = 'ok'")
    store.write("resized", done.select(store.entity, "written", "backend"), done)
    return tried

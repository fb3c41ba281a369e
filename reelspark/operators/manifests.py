"""Manifests of keyframe images: reading any alias, keep-first, image look-up and strict joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import paths, values
from reelspark.operators import catalog

#: Fixed value: columns of the keyframe manifest, in order.
COLUMNS = ("group_id", "image_id", "video_id", "frame_id", "map_id", "subfolder", "original_path", "preprocessed_path")


def normal_group(value: Column) -> Column:
    """A group id trimmed, with forward slashes, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.trim(value), r"\\", "/"), "^/+|/+$", "")


def normal_image(value: Column) -> Column:
    """An image id trimmed, without folders and image suffix."""
    name = F.element_at(F.split(F.trim(value), "/"), -1)
    return F.regexp_replace(name, rf"(?i)\.({'|'.join(paths.IMAGE_SUFFIXES)})$", "")


def group_of(path: Column, root: str | None) -> Column:
    """The folder of an image as seen from ``root``; the folder's own name for a path that is not below it. Relative paths are
    taken to be below it."""
    folder = F.regexp_replace(path, "/?[^/]*$", "")
    own = F.element_at(F.split(folder, "/"), -1)
    if root is None:
        return normal_group(F.when(path.startswith("/"), own).otherwise(folder))
    base = f"{root.rstrip('/')}/"
    below = F.when(path.startswith(base), F.substring(folder, len(base) + 1, 1 << 30))
    return normal_group(F.coalesce(below, F.when(~path.startswith("/"), folder), own))


def items(manifest: DataFrame, ignore_flag: bool = False, order: str | None = None, root: str | None = None) -> DataFrame:
    """``group_id, image_id, path, map_id, seq`` from a manifest with any of the known column names.

    Rows whose flag says no are dropped unless ``ignore_flag``; so are rows without path or without an id that can be told. A
    missing image is the stem of the path; a missing group its folder as seen from ``root``, or the folder's own name where the
    path is not below ``root``. ``order``: a column with the manifest's order.
    """
    there = manifest.columns
    path = values.first_present(values.aliased(there, "path"))
    folder = group_of(path, root)
    group = F.coalesce(F.nullif(normal_group(values.first_present(values.aliased(there, "group"))), F.lit("")), folder)
    image = F.coalesce(F.nullif(normal_image(values.first_present(values.aliased(there, "image"))), F.lit("")), paths.stem(path))
    flags = values.aliased(there, "selected")
    rows = manifest if ignore_flag or not flags else manifest.where(values.selected(flags))
    seq = F.col(order) if order else F.monotonically_increasing_id()
    found = rows.select(group.alias("group_id"), image.alias("image_id"), path.alias("path"), values.first_present(values.aliased(there, "map")).alias("map_id"), seq.alias("seq"))
    return found.where("path <> '' and group_id <> '' and image_id <> ''")


def discover(found: DataFrame, limit: int | None = None) -> DataFrame:
    """The first item of each group and image in order of discovery, sorted; the first ``limit``."""
    first = catalog.first_of_each(found, ["group_id", "image_id"], ["seq"]).orderBy("group_id", "image_id")
    return first if limit is None else first.limit(limit)


def from_tree(images: DataFrame) -> DataFrame:
    """Items of every image of a tree: ``images`` has ``rel_path``, seen from the root."""
    path = F.col("rel_path")
    suffix = F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))
    return images.where(suffix.isin(*paths.IMAGE_SUFFIXES)).select(normal_group(F.regexp_replace(path, "/?[^/]*$", "")).alias("group_id"), paths.stem(path).alias("image_id"), path.alias("path"), F.lit("").alias("map_id"), F.lit("").alias("subfolder"), F.lit("recursive").alias("source"), path.alias("seq"))


def from_maps(images: DataFrame, maps: DataFrame, allow_missing_map: bool = False) -> DataFrame:
    """Items of the layout in which each video has a folder of images and a map that names the frames in it.

    ``images``: ``subfolder, video_id, path``; ``maps``: ``subfolder, video_id, map_id`` and ``row``, the order in the map. A map row
    without an image is an error when it is read; so is a video without a map, unless ``allow_missing_map``, when all its images
    are items.
    """
    keys = ["subfolder", "video_id"]
    key = lambda df: df.withColumn("video_id", F.to_json(F.struct(*keys)))
    named = frame_images(key(maps).select("video_id", "map_id"), key(images).select("video_id", "path"))
    rows = key(maps.where(F.trim("map_id") != "")).groupBy("video_id", "map_id").agg(F.min("row").alias("row"), F.first("subfolder").alias("subfolder"))
    video = F.get_json_object("video_id", "$.video_id")
    item = lambda source, seq: [normal_group(video).alias("group_id"), paths.stem(F.col("path")).alias("image_id"), "path", F.col("map_id"), "subfolder", F.lit(source).alias("source"), seq.alias("seq")]
    found = named.join(rows, ["video_id", "map_id"]).select(*item("kf_embedding", F.to_json(F.struct("subfolder", "video_id", F.format_string("%012d", "row").alias("row")))))
    # the mark comes from the join, so that the check below is not made before it
    mapped = images.where(paths.suffix(F.col("path")).isin(*paths.IMAGE_SUFFIXES)).join(maps.select(*keys).distinct().withColumn("_mapped", F.lit(True)), keys, "left")
    if not allow_missing_map:
        mapped = catalog.require(mapped, F.col("_mapped"), "a video has no map")
    bare = key(mapped.where("_mapped is null")).withColumn("map_id", F.lit(""))
    return found.unionByName(bare.select(*item("directory", F.to_json(F.struct("subfolder", "video_id", "path")))))


def layout_of(layout: str, default_root: bool, maps_there: bool) -> str:
    """``recursive`` or ``kf-embedding`` for a layout that may be ``auto``; another is an error."""
    if layout == "auto":
        layout = "kf-embedding" if maps_there and not default_root else "recursive"
    if layout not in ("recursive", "kf-embedding"):
        raise ValueError(f"no such layout: {layout}")
    return layout


def some(found: DataFrame) -> DataFrame:
    """``found``; an error if it is empty."""
    if found.isEmpty():
        raise FileNotFoundError("there are no selected keyframe images")
    return found


def candidates(rows: DataFrame, bases: list[str], path: str = "path") -> DataFrame:
    """``rows`` with each place where a path may be, and its ``priority``: as it is if absolute, else below each base; without
    a suffix with each image suffix in turn."""
    bare = ~F.col(path).rlike(r"[^/]\.[^./]+$")
    below = F.array(*(F.concat(F.lit(f"{b.rstrip('/')}/"), F.col(path)) for b in bases))
    placed = F.when(F.col(path).startswith("/"), F.array(path)).otherwise(below)
    with_suffix = lambda s: F.transform(placed, lambda p: F.concat(p, F.lit(f".{s}")))
    tried = F.flatten(F.array(*(with_suffix(s) for s in paths.IMAGE_SUFFIXES)))
    return rows.withColumn("_all", F.when(bare, F.concat(placed, tried)).otherwise(placed)).select(*rows.columns, F.posexplode("_all").alias("priority", "candidate")).drop("_all")


def frame_images(map_rows: DataFrame, listing: DataFrame, strict: bool = True) -> DataFrame:
    """``video_id, map_id, path``: the image of each map row: the padded id before the raw one, webp before other suffixes.

    ``listing``: ``video_id, path``. ``strict``: a map row without an image is an error when it is read.
    """
    images = listing.select("video_id", "path", paths.stem(F.col("path")).alias("stem"), paths.suffix(F.col("path")).alias("suffix")).where(F.col("suffix").isin(*paths.IMAGE_SUFFIXES))
    raw = normal_image(F.col("map_id"))
    stems = F.array_distinct(F.array(paths.frame_stem(F.col("map_id")), raw))
    asked = map_rows.select("video_id", "map_id").where(F.trim("map_id") != "").distinct().select("video_id", "map_id", F.posexplode(stems).alias("at", "stem"))
    rank = F.struct("at", (F.col("suffix") != "webp").alias("later"), "suffix", "path")
    best = asked.join(images, ["video_id", "stem"]).groupBy("video_id", "map_id").agg(F.min_by("path", rank).alias("path"))
    out = map_rows.select("video_id", "map_id").where(F.trim("map_id") != "").distinct().join(best, ["video_id", "map_id"], "left")
    return catalog.require(out, F.col("path").isNotNull(), "a map row has no image") if strict else out.where("path is not null")


def keyframe_manifest(found: DataFrame, prepared: DataFrame) -> DataFrame:
    """Items with their prepared paths, empty where there is none, in the manifest's columns and in order of group and image, the order
    of :func:`discover`."""
    keys = ["group_id", "image_id"]
    joined = found.join(prepared.select(*keys, F.col("path").alias("_prepared")), keys, "left")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    held = {c: blank(c) for c in found.columns}
    fields = {"video_id": blank("group_id"), "frame_id": blank("image_id"), "original_path": blank("path"), "preprocessed_path": blank("_prepared")}
    return joined.select(*((fields.get(c) if c in fields else held.get(c, F.lit(""))).alias(c) for c in COLUMNS)).orderBy("group_id", "image_id")


def strict_join(left: DataFrame, right: DataFrame, keys: list[str], message: str) -> DataFrame:
    """An inner join in which a left row without a right one is an error when it is read."""
    joined = left.join(right.withColumn("_there", F.lit(True)), keys, "left")
    return catalog.require(joined, F.col("_there"), message).drop("_there")

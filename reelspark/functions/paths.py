"""Path expressions: collections, suffixes, derived artefact paths and file names. Null paths stay null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The artefacts of a video, the folder of each and its suffix (empty: none). A brace stands for the collection,
#: which is then left out of the path below.
ARTEFACTS = {
    "embedding_path": ("dataraw/embeddings", ".npy"),
    "scene_path": ("ProcessedData/scence_boundary", ".txt"),
    "indices_path": ("dataraw/embeddings/keyframes_indices_B32_{}", ".txt"),
    "keyframe_dir": ("ProcessedData/data/keyframes", ""),
    "map_path": ("ProcessedData/data/map_keyframes", ".csv"),
}
#: File suffixes of videos and images.
VIDEO_SUFFIXES = ("mp4", "mkv", "avi", "mov", "webm", "m4v")
IMAGE_SUFFIXES = ("bmp", "jpeg", "jpg", "png", "tif", "tiff", "webp")


def parts(path: Column) -> Column:
    """The parts of a path; sorting by them puts ``a/b`` before ``a-b``, as sorting by path objects does."""
    return F.split(path, "/")


def collection(path: Column) -> Column:
    """First part of a relative path, ``root`` if it has one part only."""
    return F.when(F.size(parts(path)) > 1, F.get(parts(path), F.lit(0))).when(path.isNotNull(), F.lit("root"))


def in_collection(path: Column) -> Column:
    """A relative path without its collection."""
    p = parts(path)
    return F.when(F.size(p) > 1, F.array_join(F.slice(p, 2, F.size(p)), "/")).otherwise(path)


def replace_suffix(path: Column, suffix: str | None) -> Column:
    """Another last suffix; none for ``""``, no change for None. A leading dot is part of the name, not a suffix."""
    if suffix is None:
        return path
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", ""), F.lit(suffix))


def stem(path: Column) -> Column:
    """File name without folders and without its last suffix."""
    return F.regexp_replace(F.element_at(parts(path), -1), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    """Last suffix in lower case without the dot, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))


def artefacts(path: Column) -> list[Column]:
    """The derived paths of a video, one column each."""
    out = []
    for name, (folder, ending) in ARTEFACTS.items():
        own = "{}" in folder
        begin = F.concat(F.lit(folder.format("")), collection(path)) if own else F.lit(folder)
        below = replace_suffix(in_collection(path) if own else path, ending)
        out.append(F.concat(begin, F.lit("/"), below).alias(name))
    return out


def mirrored(path: Column, base: str, to: str, ending: str | None = None) -> Column:
    """A path below ``base`` moved to the same place below ``to``; null if it is not below ``base``."""
    below = path.startswith(f"{base.rstrip('/')}/")
    return F.when(below, replace_suffix(F.concat(F.lit(f"{to.rstrip('/')}/"), F.substring(path, len(base.rstrip("/")) + 2, 1 << 30)), ending))


def ordinal_name(number: Column, suffix: str = "") -> Column:
    """Six digits at least; longer numbers are not cut."""
    return F.when(number.isNotNull(), F.format_string(f"%06d{suffix}", number.cast("bigint")))


def frame_stem(raw: Column) -> Column:
    """File stem for a map id: whole numbers, written as integers or not, become six digits; other text is kept trimmed."""
    text = F.trim(raw)
    number = text.try_cast("double")
    whole = text.try_cast("bigint")
    return F.coalesce(ordinal_name(whole), F.when((number == F.floor(number)) & (F.abs(number) < 1e15), ordinal_name(number)), text)


def group_file(group: Column) -> Column:
    """A group id as one file name."""
    return F.regexp_replace(group, r"[\\/]", "__")


def image_path(group: Column, image: Column, image_format: str, root: str = "preprocessed", strict_reference: bool = False) -> Column:
    """Where a preprocessed image goes. ``strict_reference``: every format but png is written as jpg."""
    ending = "jpg" if (strict_reference and image_format != "png") or image_format == "jpeg" else image_format
    return F.concat(F.lit(f"{root}/"), group, F.lit("/"), image, F.lit(f".{ending}"))


def model_root(root: str, model: str, models: int) -> str:
    """The output folder of a model: its own if there are several."""
    return f"{root}/{model}" if models > 1 else root

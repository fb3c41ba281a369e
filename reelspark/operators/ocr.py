"""Recognised text: boxes from detector results, reading order, line clean-up and prediction records."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from reelspark.functions import geometry, values
from reelspark.functions.vectors import let
from reelspark.operators import catalog, manifests

#: Keys of a detector result that may hold boxes and scores, first first.
BOX_KEYS = ("dt_polys", "det_polys", "rec_polys", "polys", "dt_boxes", "det_boxes", "rec_boxes", "boxes")
SCORE_KEYS = ("dt_scores", "det_scores", "scores", "confidence")
#: Least confidence of a line, and pixels that two boxes of one line differ at most (or half the middle height).
CONFIDENCE, LEAST_LINE = 0.7, 10.0
#: Fields of a record in the file of its group, and of a row of the table of predictions, in order.
GROUP_FIELDS = ("idx", "image_id", "frame_id", "map_id", "subfolder", "path", "preprocessed_path", "text", "text_joined", "latency_ms", "all_lines")
ROW_FIELDS = ("group_id", "image_id", "video_id", "frame_id", "idx", "map_id", "subfolder", "path", "original_path", "preprocessed_path", "text", "line_count", "latency_ms")
#: Records of a group in one row of its file.
GROUP_CHUNK = 10_000
POINT = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
BOX = StructType([StructField("box", ArrayType(POINT)), StructField("det_confidence", DoubleType())])


def _number(x: object) -> float | None:
    try:
        return None if isinstance(x, bool) else float(x)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None


def as_quad(value: object) -> list[tuple[float, float]] | None:
    """Four points from four pairs, eight numbers, or four numbers as left, top, right, bottom."""
    if not isinstance(value, list):
        return None
    if len(value) == 4 and all(isinstance(p, list) and len(p) == 2 for p in value):
        flat = [_number(c) for p in value for c in p]
    elif len(value) in (4, 8):
        flat = [_number(c) for c in value]
        if len(value) == 4 and None not in flat:
            a, b, c, d = flat
            flat = [a, b, c, b, c, d, a, d]
    else:
        return None
    return None if None in flat else list(zip(flat[::2], flat[1::2], strict=True))


def boxes_of(result: object) -> list[tuple[list[tuple[float, float]], float | None]]:
    """Boxes and confidences anywhere in a nested detector result, depth first."""
    if isinstance(result, dict):
        if isinstance(result.get("res"), dict):
            result = result["res"]
        scores = next((result[k] for k in SCORE_KEYS if k in result), None)
        for key in BOX_KEYS:
            found = _listed(result.get(key), scores)
            if found:
                return found
        return [box for inner in result.values() for box in boxes_of(inner)]
    if isinstance(result, list):
        return _listed(result, None) or [box for inner in result for box in boxes_of(inner)]
    return []


def _listed(value: object, scores: object) -> list[tuple[list[tuple[float, float]], float | None]]:
    if not isinstance(value, list) or not value:
        return []

    def score(i: int) -> float | None:
        if isinstance(scores, list):
            return _number(scores[i]) if i < len(scores) else None
        return _number(scores)

    single = as_quad(value)
    if single:
        return [(single, score(0))]
    quads = [(as_quad(v), score(i)) for i, v in enumerate(value)]
    return [(q, s) for q, s in quads if q]


@F.pandas_udf(ArrayType(BOX))
def detector_boxes(raw: pd.Series) -> pd.Series:
    """Boxes of a detector result as JSON text; none for null or malformed text. A tree walk has no built-in form."""

    def one(text: str | None) -> list[dict]:
        try:
            return [{"box": [{"x": x, "y": y} for x, y in q], "det_confidence": s} for q, s in boxes_of(json.loads(text or "null"))]
        except ValueError:
            return []

    return raw.map(one)


def usable_boxes(boxes: Column, width: Column, height: Column, least: float = 3.0) -> Column:
    """Boxes moved into the image, without small ones, the first of those that are equal after rounding."""
    clipped = F.transform(boxes, lambda b: F.struct(geometry.clip(b["box"], width, height).alias("box"), b["det_confidence"].alias("det_confidence")))
    large = F.filter(clipped, lambda b: geometry.large_enough(b["box"], least))
    keyed = F.transform(large, lambda b: F.struct(geometry.rounded_key(b["box"]).alias("key"), b.alias("b")))
    return let(keyed, lambda k: first_of_equal(k, lambda x: x["key"], lambda x: x["b"]))


def first_of_equal(items: Column, key: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
    """Values of the elements whose key stands at no earlier place, in order.

    Keys are sorted with their places, so it takes n log n steps for n elements.
    """
    placed = F.sort_array(F.transform(items, lambda x, i: F.struct(key(x).alias("key"), i.alias("i"))))
    first = let(placed, lambda s: F.filter(s, lambda x, i: (i == 0) | ~x["key"].eqNullSafe(F.get(s, i - 1)["key"])))
    order = F.sort_array(F.transform(first, lambda x: x["i"]))
    return let(items, lambda all_: F.transform(order, lambda i: value(F.get(all_, i))))


def in_reading_order(boxes: Column) -> Column:
    """An array of boxes (structs with ``box``) in reading order: by line from the top, within a line from the left.

    Boxes sorted by top and left are taken in turn, each put before those at the end that are of its line and further right.
    Whether two are of one line depends on them alone and is not transitive, so no sort key exists; but it is one fold.
    """
    measured = F.transform(boxes, lambda b, i: let(geometry.clockwise(b["box"]), lambda c: F.struct(F.get(c, F.lit(0))["y"].alias("y"), F.get(c, F.lit(0))["x"].alias("x"), i.alias("i"), geometry.box_size(b["box"])[1].alias("h"))))
    return F.transform(let(measured, fold_in_order), lambda e: F.get(boxes, e["i"]))


def fold_in_order(measured: Column) -> Column:
    """An array of structs ``y, x, i, h`` (top, left, place, height) in reading order."""

    def insert(done: Column, e: Column, near: Column) -> Column:
        passes = F.transform(F.reverse(done), lambda d: (F.abs(e["y"] - d["y"]) < near) & (e["x"] < d["x"]))
        first = F.array_position(passes, F.lit(False))
        k = F.when(first > 0, first - 1).otherwise(F.size(done)).cast("int")
        return F.concat(F.slice(done, F.lit(1), F.size(done) - k), F.array(e), F.slice(done, F.size(done) - k + 1, k))

    near = F.greatest(F.lit(LEAST_LINE), 0.5 * upper_median(F.transform(measured, lambda e: e["h"])))
    return let(near, lambda n: F.aggregate(F.array_sort(measured), F.filter(measured, lambda e: F.lit(False)), lambda done, e: insert(done, e, n)))


def pages(rows: DataFrame, page: str, seq: str, box: str, width: Column, height: Column, least: float = 3.0) -> DataFrame:
    """``page, boxes``: of a table with a box in each row the usable boxes of each page in reading order.

    What concerns one box is compiled column code before the boxes of a page are brought together; of boxes that are equal
    after rounding the first by ``seq`` stays.
    """
    # one shuffle: a page's boxes end in one row, and both groupings below keep to this partitioning
    measured = geometry.measure(rows.select(page, seq, F.col(box).alias("box")).repartition(page), "box", width, height)
    corner = F.get("corners", F.lit(0))
    m = F.struct(corner["y"].alias("y"), corner["x"].alias("x"), F.col(seq).alias("i"), F.col("box_height").alias("h"), "box")
    # small boxes are left out by their order being null: a filter would be pushed down with all that its columns come from
    order = F.when(F.least("box_width", "box_height") >= least, F.col(seq))
    once = measured.groupBy(page, "box_key").agg(F.min_by(m, order).alias("m")).where("m is not null").select(page, "m")
    # the place stands before the height, so that equal corners stay in the order of the page
    listed = once.groupBy(page).agg(F.collect_list("m").alias("m"))
    return listed.select(page, F.transform(fold_in_order(F.col("m")), lambda e: e["box"]).alias("boxes"))


def upper_median(numbers: Column) -> Column:
    """The middle of a list, the upper one of two."""
    return F.get(F.array_sort(numbers), F.floor(F.size(numbers) / 2).cast("int"))


def recognised(boxes: Column, texts: Column) -> Column:
    """Lines of boxes and recognised texts by place, as many as there are of both."""
    n = F.least(F.size(boxes), F.size(texts))
    return F.transform(F.slice(boxes, 1, n), lambda b, i: F.struct(F.get(texts, i)["text"].alias("text"), F.get(texts, i)["confidence"].alias("confidence"), b["det_confidence"].alias("det_confidence"), b["box"].alias("box"), i.alias("line_index")))


def cleaned_lines(lines: Column) -> Column:
    """All lines with cleaned text, without empty ones."""
    clean = F.transform(lines, lambda x: x.withField("text", values.clean_text(x["text"])))
    return F.filter(clean, lambda x: F.coalesce(x["text"] != "", F.lit(False)))


def accepted_lines(lines: Column, threshold: float | None = CONFIDENCE, dedupe: bool = True, fold: Callable[[Column], Column] = F.lower, clean: bool = True) -> Column:
    """Cleaned lines that are sure enough (or of unknown confidence), the first of those equal but for case.

    A line that is not sure enough does not stand in the way of a later equal one. ``fold`` makes keys of texts; lower case
    differs from full case folding for a few letters (a sharp s is not two letters). ``clean`` False: the lines are cleaned.
    """
    cleaned = cleaned_lines(lines) if clean else lines
    sure = cleaned if threshold is None else F.filter(cleaned, lambda x: x["confidence"].isNull() | (x["confidence"] >= threshold))
    if not dedupe:
        return sure
    keyed = F.transform(sure, lambda x: F.struct(fold(x["text"]).alias("key"), x.alias("line")))
    return let(keyed, lambda k: first_of_equal(k, lambda x: x["key"], lambda x: x["line"]))


def predictions(items: DataFrame, threshold: float | None = CONFIDENCE, dedupe: bool = True) -> DataFrame:
    """The prediction record of every image: 15 fields. ``items``: ``group_id, image_id, map_id, subfolder, path,
    original_path, preprocessed_path, latency_ms`` and ``lines``."""
    kept = F.transform(accepted_lines(F.col("lines"), threshold, dedupe), lambda x: x["text"])
    with_lines = items.withColumn("text_lines", kept).withColumn("all_lines", cleaned_lines(F.col("lines")))
    return with_lines.select("group_id", "image_id", F.col("group_id").alias("video_id"), F.col("image_id").alias("frame_id"), F.col("image_id").alias("idx"), "map_id", "subfolder", "path", "original_path", "preprocessed_path", "text_lines", F.array_join("text_lines", "\n").alias("text"), F.size("text_lines").alias("line_count"), "latency_ms", "all_lines")


def group_records(records: DataFrame) -> DataFrame:
    """``group_id`` and the 11 fields of each of its records in a group's file, from prediction records."""
    field = {"idx": "image_id", "frame_id": "image_id", "path": "original_path", "text": "text_lines", "text_joined": "text"}
    return records.select("group_id", *(F.col(field.get(name, name)).alias(name) for name in GROUP_FIELDS))


def grouped(records: DataFrame, group: str, image: str, fields: list[str], chunk: int = GROUP_CHUNK) -> DataFrame:
    """``group, chunk, records``: JSON arrays of the records of a group in order of normalised image id, ``chunk`` of them in each
    row (the last may have fewer), numbered from 0. Equal image ids are in order of the whole record.

    Records are numbered by image id across the tasks, so a group may hold any part of the table.
    """
    rows = records.select(group, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("r"), manifests.normal_image(F.col(image)).alias("_order"))
    placed = catalog.numbered(rows, [group, "_order", "r"], "_at")
    first = placed.groupBy(group).agg(F.min("_at").alias("_first"))
    parted = placed.join(first, group).withColumn("chunk", F.floor((F.col("_at") - F.col("_first")) / chunk))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_at", "r"))), lambda x: x["r"])
    return parted.groupBy(group, "chunk").agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("records"))


def first_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n_lines, n_kept, text``: cleaned lines of a text, the first of each, in one row expression without a shuffle."""
    split = F.transform(F.split(F.coalesce(text_col, F.lit("")), "\n"), lambda t: F.struct(t.alias("text"), F.lit(None).cast("double").alias("confidence")))
    lines = df.select(id_col, cleaned_lines(split).alias("_lines"))
    kept = lines.select(id_col, F.size("_lines").cast("bigint").alias("n_lines"), F.transform(accepted_lines(F.col("_lines"), None, clean=False), lambda x: x["text"]).alias("_kept"))
    return kept.select(id_col, "n_lines", F.size("_kept").cast("bigint").alias("n_kept"), F.array_join("_kept", "\n").alias("text"))

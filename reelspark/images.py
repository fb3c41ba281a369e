"""Operations on images in numpy, and tables of images through them.

An image is an array of height, width and three colours of eight bits; in tables it is ``pixels`` (its bytes), ``width`` and
``height``. Interpolation is linear, where image libraries offer finer kinds; a backend may take their place. A task holds an Arrow
batch of images at a time, so ``spark.sql.execution.arrow.maxRecordsPerBatch`` bounds its memory.
"""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark import media
from reelspark.functions import packed

#: Shares of red, green and blue in grey, and the kernel that smooths for sharpening.
GREY = (0.299, 0.587, 0.114)
SMOOTH = ((1, 1, 1), (1, 5, 1), (1, 1, 1))
IMAGE = "pixels binary, width int, height int"


@dataclass
class Preparation:
    """How an image is made ready for recognition; fixed values: the usual settings. What is None is taken from ``general``."""

    most_side: int | None = 1920
    least_side: int | None = 720
    grey: bool = False
    autocontrast: bool | None = True
    cutoff: float | None = 1.0
    contrast: float | None = 1.08
    sharpness: float | None = 1.12

    def over(self, general: Preparation) -> Preparation:
        """These settings, those of ``general`` where they are None."""
        return Preparation(**{k: getattr(general, k) if v is None else v for k, v in self.__dict__.items()})


#: Pixels put around a crop, its height, and how it is made ready.
PADDING, CROP_HEIGHT = 4, 48
CROP = Preparation(None, None, False, True, 0.5, 1.12, 1.18)


def sampled(x: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Colours at fractional places (arrays of one shape), by linear interpolation; beyond the edge those of the edge."""
    h, w = x.shape[:2]
    r, c = np.clip(rows, 0, h - 1), np.clip(columns, 0, w - 1)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
    a, b = (r - r0)[..., None], (c - c0)[..., None]
    y = x.astype(np.float64)
    return (y[r0, c0] * (1 - b) + y[r0, c1] * b) * (1 - a) + (y[r1, c0] * (1 - b) + y[r1, c1] * b) * a


def eight_bits(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


def resized(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """An image of another size; points lie at the middles of pixels."""
    h, w = x.shape[:2]
    if (h, w) == (height, width):
        return x
    r, c = np.meshgrid((np.arange(height) + 0.5) * h / height - 0.5, (np.arange(width) + 0.5) * w / width - 0.5, indexing="ij")
    return eight_bits(sampled(x, r, c))


def size_for_text(width: int, height: int, most: int | None, least: int | None) -> tuple[int, int]:
    """Width and height for recognition: see :func:`reelspark.functions.values.ocr_size`. No bound where one is None or not positive."""
    longest, shortest = max(width, height), min(width, height)
    scale, top = 1.0, most / longest if most and most > 0 else float("inf")
    if top < 1:
        scale = top
    if least and 0 < shortest < least:
        scale = max(scale, min(least / shortest, top))
    return max(1, round(width * scale)), max(1, round(height * scale))


def grey(x: np.ndarray) -> np.ndarray:
    """The lightness of an image in all three colours."""
    return np.repeat(eight_bits(x @ np.array(GREY))[..., None], 3, axis=2)


def autocontrast(x: np.ndarray, cutoff: float = 0.0) -> np.ndarray:
    """Each colour stretched over the whole range, ``cutoff`` percent of its darkest and of its lightest points left aside."""
    out = np.empty_like(x)
    for c in range(3):
        values = np.sort(x[..., c], axis=None)
        skip = int(len(values) * cutoff / 100)
        low, high = int(values[min(skip, len(values) - 1)]), int(values[max(len(values) - 1 - skip, 0)])
        out[..., c] = x[..., c] if high <= low else eight_bits((x[..., c].astype(np.float64) - low) * 255 / (high - low))
    return out


def contrast(x: np.ndarray, factor: float) -> np.ndarray:
    """Away from the mean lightness, or towards it below 1."""
    middle = np.floor((x @ np.array(GREY)).mean() + 0.5)
    return eight_bits(middle + (x - middle) * factor)


def sharpness(x: np.ndarray, factor: float) -> np.ndarray:
    """Away from the smoothed image, or towards it below 1; points at the edge stay."""
    if min(x.shape[:2]) < 3:
        return x
    y, h, w = x.astype(np.float64), *x.shape[:2]
    smooth = y.copy()
    smooth[1:-1, 1:-1] = sum(SMOOTH[a][b] * y[a : h - 2 + a, b : w - 2 + b] for a in range(3) for b in range(3)) / sum(map(sum, SMOOTH))
    return eight_bits(smooth + (y - smooth) * factor)


def prepared(x: np.ndarray, p: Preparation) -> np.ndarray:
    """An image made ready: size, grey, stretched, contrast, sharpness, in this order."""
    width, height = size_for_text(x.shape[1], x.shape[0], p.most_side, p.least_side)
    x = resized(x, height, width)
    x = grey(x) if p.grey else x
    x = autocontrast(x, p.cutoff or 0.0) if p.autocontrast else x
    x = contrast(x, p.contrast) if p.contrast not in (None, 1.0) else x
    return sharpness(x, p.sharpness) if p.sharpness not in (None, 1.0) else x


def rectified(x: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """What lies in four corners (top left, top right, bottom right, bottom left), upright; turned if much higher than wide."""
    side = lambda a, b: float(np.hypot(*(corners[a] - corners[b])))
    width, height = max(1, int(max(side(0, 1), side(2, 3)))), max(1, int(max(side(0, 3), side(1, 2))))
    to = np.array([[0, 0], [width, 0], [width, height], [0, height]], float)
    # the eight numbers of the projection from the crop to the image
    rows = [r for (u, v), (a, b) in zip(to, corners, strict=True) for r in ([u, v, 1, 0, 0, 0, -u * a, -v * a], [0, 0, 0, u, v, 1, -u * b, -v * b])]
    m = np.append(np.linalg.lstsq(np.array(rows), np.asarray(corners, float).ravel(), rcond=None)[0], 1.0).reshape(3, 3)
    v, u = np.meshgrid(np.arange(height), np.arange(width), indexing="ij")
    a, b, c = np.tensordot(m, np.stack([u, v, np.ones_like(u)]).astype(float), 1)
    crop = eight_bits(sampled(x, b / c, a / c))
    return np.rot90(crop) if crop.shape[0] / crop.shape[1] >= 1.5 else crop


def prepared_crop(x: np.ndarray, p: Preparation = CROP, padding: int = PADDING, height: int = CROP_HEIGHT) -> np.ndarray:
    """A crop made ready for a recogniser of lines: edges repeated around it, of one height, then as :func:`prepared`."""
    x = np.pad(x, ((padding, padding), (padding, padding), (0, 0)), "edge") if padding > 0 else x
    if height > 0:
        x = resized(x, height, max(1, round(x.shape[1] * height / x.shape[0])))
    return prepared(x, Preparation(None, None, p.grey, p.autocontrast, p.cutoff, p.contrast, p.sharpness))


def hue_saturation_value(x: np.ndarray) -> np.ndarray:
    """Hue from 0 to 180, saturation and value from 0 to 255."""
    y = x.astype(np.float64)
    top, low = y.max(-1), y.min(-1)
    spread = np.where(top > low, top - low, 1)
    r, g, b = (y[..., i] for i in range(3))
    hue = np.where(top == r, (g - b) / spread % 6, np.where(top == g, (b - r) / spread + 2, (r - g) / spread + 4)) * 30
    return np.stack([np.where(top > low, hue, 0), np.where(top > 0, (top - low) * 255 / np.where(top > 0, top, 1), 0), top], axis=-1)


# --- tables of images ---------------------------------------------------------------------------------------------------


def _image(row: dict) -> np.ndarray:
    return np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], 3)


def through(df: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``df`` with its images (``pixels, width, height``) through ``work``; a row without an image stays as it is."""
    names = df.columns
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            out: dict[str, list] = {"pixels": [], "width": [], "height": []}
            for p, w, h in zip(*(columns[c].to_pylist() for c in out), strict=True):
                made = None if p is None else np.ascontiguousarray(work(_image({"pixels": p, "width": w, "height": h})))
                out["pixels"].append(None if made is None else made.tobytes())
                out["width"].append(w if made is None else made.shape[1])
                out["height"].append(h if made is None else made.shape[0])
            columns |= {"pixels": pa.array(out["pixels"], pa.binary()), "width": pa.array(out["width"], pa.int32()), "height": pa.array(out["height"], pa.int32())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return df.withColumns({"width": F.col("width").cast("int"), "height": F.col("height").cast("int")}).mapInArrow(run, ", ".join(f"{f.name} {'int' if f.name in ('width', 'height') else f.dataType.simpleString()}" for f in schema.fields))


def at_height(df: DataFrame, height: int = 540) -> DataFrame:
    """Images at another height, the width in proportion, its fraction cut off."""
    return through(df, lambda x: resized(x, height, max(1, int(x.shape[1] * (height / x.shape[0])))))


def ready(df: DataFrame, preparation: Preparation | None = None) -> DataFrame:
    """Images made ready for recognition."""
    p = preparation or Preparation()
    return through(df, lambda x: prepared(x, p))


def crops(df: DataFrame, keys: list[str], corners: str = "corners") -> DataFrame:
    """``keys, line_index, pixels, width, height``: of each image what lies in each of its boxes, made ready for a recogniser of lines.

    ``corners``: an array of arrays of four points (structs ``x, y``), clockwise from the top left. Crops without area are left out.
    """
    narrow = df.select(*keys, "pixels", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), F.transform(corners, lambda b: F.flatten(F.transform(b, lambda p: F.array(p["x"], p["y"])))).alias("boxes"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[: len(keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, made = [], []
            for i, row in enumerate(batch.select(["pixels", "width", "height", "boxes"]).to_pylist()):
                for k, box in enumerate(row["boxes"] or [] if row["pixels"] is not None else []):
                    crop = rectified(_image(row), np.array(box, float).reshape(4, 2))
                    if crop.size:
                        at.append(i)
                        made.append((k, np.ascontiguousarray(prepared_crop(crop))))
            columns = [batch.column(k).take(pa.array(at, pa.int64())) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([k for k, _ in made], pa.int32()), pa.array([x.tobytes() for _, x in made], pa.binary()), pa.array([x.shape[1] for _, x in made], pa.int32()), pa.array([x.shape[0] for _, x in made], pa.int32())], [*keys, "line_index", "pixels", "width", "height"])

    return narrow.mapInArrow(run, f"{kinds}, line_index int, {IMAGE}")


def content_scores(frames: DataFrame, entity: str = "video_id", frame: str = "frame_idx") -> DataFrame:
    """``entity, frame, score``: how much each frame differs from the one before in hue, saturation and value, on average; 0 for the
    first of an entity and for one of another size than that before it.

    Frames are sorted by entity and number; a task keeps one frame beside its batch.
    """
    narrow = frames.select(entity, F.col(frame).cast("bigint").alias(frame), "pixels", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height")).dropna()
    kind = narrow.schema[entity].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_of, last = None, None
        for batch in batches:
            scores = []
            for row in batch.to_pylist():
                now = hue_saturation_value(_image(row))
                same = last is not None and row[entity] == last_of and now.shape == last.shape
                scores.append(float(np.abs(now - last).mean((0, 1)).mean()) if same else 0.0)
                last_of, last = row[entity], now
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], [entity, frame, "score"])

    return packed.grouped(narrow, [entity], [frame]).mapInArrow(run, f"{entity} {kind}, {frame} bigint, score double")


def decoded(videos: DataFrame, decoders: list[str | None], side: int = 224, every: int = 1, program: str = "ffmpeg", at_once: int = 64) -> DataFrame:
    """``video_id, attempt, frame_idx, pixels, width, height, error``: frames of each video, with the shorter side ``side``.

    ``videos``: ``video_id, path, width, height``. ``decoders`` are tried in order (None is the program's own choice). Frames come as
    they are decoded, ``at_once`` of them in memory; an attempt that breaks off ends in a row with ``error`` and without pixels, and
    the next follows. :func:`whole_attempts` keeps the attempt that did not.
    """
    narrow = videos.select("video_id", "path", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"))
    kind = narrow.schema["video_id"].dataType.simpleString()
    names = ["video_id", "attempt", "frame_idx", "pixels", "width", "height", "error"]

    def rows(key: pa.Scalar, attempt: int, first: int, frames: list[bytes], width: int, height: int, error: str | None) -> pa.RecordBatch:
        n = len(frames) + (error is not None)
        put = lambda values, kind: pa.array([*values, *([None] * (n - len(frames)))], kind)
        return pa.RecordBatch.from_arrays([pa.array([key] * n, key.type), pa.array([attempt] * n, pa.int32()), put(range(first * every, (first + len(frames)) * every, every), pa.int64()), put(frames, pa.binary()), put([width] * len(frames), pa.int32()), put([height] * len(frames), pa.int32()), pa.array([*([None] * len(frames)), *([error] if error is not None else [])], pa.string())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                scale = side / max(1, min(row["width"] or 0, row["height"] or 0))
                width, height = (side if x == min(row["width"] or 0, row["height"] or 0) else 2 * round((x or 0) * scale / 2) for x in (row["width"], row["height"]))
                for attempt, decoder in enumerate(decoders):
                    size, n, error = width * height * 3, 0, None
                    command = [program, *media.decode_command(row["path"], side, decoder, every)[1:]]
                    try:
                        with subprocess.Popen(command, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL) as work:
                            while content := work.stdout.read(size * at_once):
                                whole = len(content) // size
                                yield rows(batch.column(0)[i], attempt, n, [content[k * size : (k + 1) * size] for k in range(whole)], width, height, None)
                                n += whole
                                if len(content) % size:
                                    error = "the last frame is not whole"
                        error = error or (f"the program ended with {work.returncode}" if work.returncode else None if n else "no frame came")
                    except OSError as e:
                        error = str(e)
                    if error is None:
                        break
                    yield rows(batch.column(0)[i], attempt, n, [], width, height, f"{decoder or program}: {error}")

    return narrow.mapInArrow(run, f"video_id {kind}, attempt int, frame_idx bigint, {IMAGE}, error string")


def whole_attempts(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of :func:`decoded` (a written table, as it is read twice) the frames of attempts that did not break off, and the errors of the
    others."""
    errors = frames.where("error is not null").select("video_id", "attempt", "error")
    good = frames.where("error is null").join(errors, ["video_id", "attempt"], "left_anti")
    return good.select("video_id", "frame_idx", "pixels", "width", "height"), errors

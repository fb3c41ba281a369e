"""Frames and pixels: what a decoder, an encoder or a recogniser needs around it, and the backends that call external programs.

Codecs, image libraries and models are no part of this package. Where an external program or library is missing, its backend says so
in the row's error and the next of the chain is tried. Commands are built by plain functions, so they can be looked at without
running them. Images are arrays of height, width and colour, eight bits each.
"""

from __future__ import annotations

import json
import shutil
import struct
import subprocess
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark import backends
from reelspark.functions.vectors import let

#: Mean and standard deviation of the colours in the training data of the usual image encoders.
MEAN = (0.48145466, 0.4578275, 0.40821073)
DEVIATION = (0.26862954, 0.26130258, 0.27577711)
#: Fields asked of a probe, seconds that a program may take, quality of stored frames.
PROBE_FIELDS = ("codec_name", "width", "height", "nb_frames", "avg_frame_rate", "r_frame_rate")
PATIENCE, WEBP_QUALITY = 3600, 80
#: How videos are encoded after resizing.
VIDEO_OPTIONS = {
    "c:v": "hevc_nvenc",
    "preset": "p3",
    "tune": "hq",
    "rc": "vbr",
    "cq": "22",
    "spatial_aq": "1",
    "temporal_aq": "1",
    "rc-lookahead": "32",
    "surfaces": "64",
    "bf": "3",
    "b_ref_mode": "middle",
    "c:a": "copy",
    "movflags": "+faststart",
}


def normalised(pixels: np.ndarray, mean: tuple[float, ...] = MEAN, deviation: tuple[float, ...] = DEVIATION) -> np.ndarray:
    """A batch of images (n, height, width, colour) as numbers around zero, colours first, in single precision."""
    scaled = pixels.astype(np.float32) / np.float32(255)
    return np.ascontiguousarray(((scaled - np.float32(mean)) / np.float32(deviation)).transpose(0, 3, 1, 2))


def normalised_columns(df: DataFrame, pixels: str, height: int, width: int, out: str = "values") -> DataFrame:
    """``df`` with ``out``, an array of the normalised numbers of the image in the binary column ``pixels``, in Arrow batches.

    A null image, or one of another size, has none.
    """
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in df.schema.fields)}, {out} array<float>"
    size = height * width * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(pixels))
            there = [i for i, v in enumerate(column) if v.is_valid and len(v.as_buffer()) == size]
            values, valid = np.zeros((len(there), size), np.float32), np.zeros(len(column), bool)
            valid[there] = True
            if there:
                raw = np.stack([np.frombuffer(column[i].as_buffer(), np.uint8) for i in there]).reshape(-1, height, width, 3)
                values = normalised(raw).reshape(len(there), -1)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(valid, size, 0))]).astype(np.int32), mask=np.append(~valid, False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def full_crops(boxes: Column, crops: Column) -> tuple[Column, Column]:
    """Boxes and crops by place without those whose crop is null or without area; as many as there are of both. ``crops``: structs with
    ``width`` and ``height`` at least."""
    n = F.least(F.size(boxes), F.size(crops))
    pairs = F.transform(F.slice(boxes, 1, n), lambda b, i: F.struct(b.alias("box"), F.get(crops, i).alias("crop")))
    full = F.filter(pairs, lambda p: F.coalesce((p["crop"]["width"] > 0) & (p["crop"]["height"] > 0), F.lit(False)))
    return let(full, lambda f: F.transform(f, lambda p: p["box"])), let(full, lambda f: F.transform(f, lambda p: p["crop"]))


def png(pixels: np.ndarray) -> bytes:
    """An image (height, width, 3) as a PNG file, without any library."""
    height, width, _ = pixels.shape
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = np.concatenate([np.zeros((height, 1), np.uint8), np.ascontiguousarray(pixels, np.uint8).reshape(height, -1)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows.tobytes(), 6)) + part(b"IEND", b"")


def encoded(pixels: np.ndarray, kind: str, quality: int = WEBP_QUALITY) -> bytes:
    """An image as a file of a kind: PNG always, others if a library that knows them is there."""
    if kind == "png":
        return png(pixels)
    try:
        import io

        from PIL import Image
    except ImportError as e:
        raise RuntimeError(f"no library here writes {kind}") from e
    out = io.BytesIO()
    Image.fromarray(pixels).save(out, {"jpg": "JPEG", "jpeg": "JPEG", "webp": "WEBP"}[kind], quality=quality)
    return out.getvalue()


def put(path: str, content: bytes) -> None:
    """A file in any file system that Arrow knows (a path without a scheme is local), written under another name first, so that none
    is ever half there."""
    from pyarrow import fs

    system, where = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    system.create_dir(where.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(f"{where}.part") as out:
        out.write(content)
    system.move(f"{where}.part", where)


class ImageWriter:
    """A sink for rows of ``path, pixels, width, height``: the bytes of an image to a file of the kind its suffix names. Failures are
    rows with an error, and the number of images in flight is bounded by a batch."""

    name = "images"

    def __init__(self, quality: int = WEBP_QUALITY) -> None:
        self.quality = quality

    def __call__(self, row: dict) -> list[dict]:
        raw = np.frombuffer(row["pixels"], np.uint8).reshape(int(row["height"]), int(row["width"]), 3)
        content = encoded(raw, row["path"].rsplit(".", 1)[-1].lower(), self.quality)
        put(row["path"], content)
        return [{"size": len(content)}]


def write_images(df: DataFrame, quality: int = WEBP_QUALITY, strict: bool = True) -> DataFrame:
    """``path, size, backend, status, error`` of images written; with ``strict`` a failure is an error when it is read."""
    from reelspark.operators import catalog

    registry = {"images": lambda: ImageWriter(quality)}
    done = backends.run(df.select("path", "pixels", "width", "height"), ["images"], "size bigint", ["path"], registry)
    return catalog.require(done, F.col("status") == "ok", "an image could not be written") if strict else done


def probe_command(path: str) -> list[str]:
    """How the first video stream of a file is probed, as JSON."""
    return ["ffprobe", "-v", "error", "-select_streams", "v:0", "-show_entries", f"stream={','.join(PROBE_FIELDS)}", "-of", "json", path]


def audio_command(path: str, out: str) -> list[str]:
    """How the sound of a video becomes a mono file of 16,000 samples a second, as recognisers take it."""
    return ["ffmpeg", "-y", "-loglevel", "error", "-i", path, "-vn", "-ac", "1", "-ar", "16000", "-c:a", "pcm_s16le", out]


def decode_command(path: str, side: int, decoder: str | None = None, every: int = 1) -> list[str]:
    """How the frames of a video come as raw colours, the shorter side ``side``, every ``every``-th of them."""
    choose = f"select=not(mod(n\\,{every}))," if every > 1 else ""
    scale = f"{choose}scale='if(gt(iw,ih),-2,{side})':'if(gt(iw,ih),{side},-2)'"
    return ["ffmpeg", "-loglevel", "error", *(["-c:v", decoder] if decoder else []), "-i", path, "-vf", scale, "-vsync", "0", "-f", "rawvideo", "-pix_fmt", "rgb24", "-"]


def resize_command(path: str, out: str, height: int, bitrate: str, hardware: bool) -> list[str]:
    """How a video is resized to a height; ``hardware``: decoded by the graphics card too."""
    given = ["-hwaccel", "cuda", "-hwaccel_output_format", "cuda"] if hardware else []
    scale = f"scale_cuda=-2:{height}" if hardware else f"hwupload_cuda,scale_cuda=-2:{height}"
    rate = {"b:v": bitrate, "maxrate": bitrate, "bufsize": f"{int(bitrate.removesuffix('M')) * 2}M"}
    options = [x for k, v in (VIDEO_OPTIONS | rate).items() for x in (f"-{k}", v)]
    return ["ffmpeg", "-hide_banner", "-loglevel", "error", *given, "-i", path, "-vf", scale, *options, "-y", out]


def decoders(listing: str) -> set[str]:
    """Names of decoders in what the program lists: lines of six flags, a name and a description."""
    rows = (line.split() for line in listing.splitlines())
    return {r[1] for r in rows if len(r) > 1 and len(r[0]) == 6 and r[0][0] in "VAS" and r[1] != "="}


def hardware_decoder(codec: str, there: set[str]) -> str | None:
    """The hardware decoder of a codec, if the program has it."""
    name = backends.HARDWARE_DECODERS.get(codec)
    return name if name in there else None


def run_program(command: list[str], patience: float = PATIENCE) -> bytes:
    """What a program writes; an error if it is missing, fails or takes too long."""
    if shutil.which(command[0]) is None:
        raise RuntimeError(f"{command[0]} is not there")
    done = subprocess.run(command, capture_output=True, timeout=patience, check=False)
    if done.returncode:
        raise RuntimeError(f"{command[0]} ended with {done.returncode}: {done.stderr[-500:].decode(errors='replace')}")
    return done.stdout


class Prober:
    """The probe of a video as JSON text."""

    name = "ffprobe"

    def __call__(self, row: dict) -> list[dict]:
        return [{"probe": json.dumps(json.loads(run_program(probe_command(row["path"])) or b"{}"))}]


class VideoResizer:
    """A resized video; ``hardware``: see :func:`resize_command`. Chained twice, hardware first, a failure is tried in software."""

    def __init__(self, height: int = 480, bitrate: str = "1M", hardware: bool = True) -> None:
        self.height, self.bitrate, self.hardware = height, bitrate, hardware
        self.name = "resize_hardware" if hardware else "resize"

    def __call__(self, row: dict) -> list[dict]:
        run_program(resize_command(row["path"], row["out"], self.height, self.bitrate, self.hardware))
        return [{"written": row["out"]}]


class AudioExtractor:
    """The sound of a video as a file."""

    name = "audio"

    def __call__(self, row: dict) -> list[dict]:
        run_program(audio_command(row["path"], row["out"]))
        return [{"written": row["out"]}]


backends.register("ffprobe", Prober)
backends.register("resize_hardware", VideoResizer)
backends.register("resize", lambda: VideoResizer(hardware=False))
backends.register("audio", AudioExtractor)

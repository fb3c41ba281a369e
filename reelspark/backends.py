"""Decoders, encoders and recognisers as pluggable backends that run inside Arrow-batched tasks.

Codec and model libraries are no part of this package. A backend is made once in a task by its factory and turns batches into
batches; a row that fails gives a row with status and error instead of ending the job. Chains of backends are tried in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Hardware decoders by codec.
HARDWARE_DECODERS = {
    "av1": "av1_cuvid",
    "h264": "h264_cuvid",
    "hevc": "hevc_cuvid",
    "mjpeg": "mjpeg_cuvid",
    "mpeg1video": "mpeg1_cuvid",
    "mpeg2video": "mpeg2_cuvid",
    "mpeg4": "mpeg4_cuvid",
    "vc1": "vc1_cuvid",
    "vp8": "vp8_cuvid",
    "vp9": "vp9_cuvid",
}


class Backend(Protocol):
    """Turns one row, as a dict, into rows."""

    name: str

    def __call__(self, row: dict) -> list[dict]: ...


Registry = dict[str, Callable[[], Backend]]
REGISTRY: Registry = {}


def register(name: str, factory: Callable[[], Backend]) -> None:
    REGISTRY[name] = factory


def chain_for(codec: str, registry: Registry | None = None) -> list[str]:
    """Names of decoders to try for a codec: hardware, software, then the others; AV1 goes to one decoder that knows it and stops."""
    there = REGISTRY if registry is None else registry
    wanted = ["ffmpeg_hardware", "ffmpeg", "pyav"] if codec == "av1" else ["ffmpeg_hardware", "ffmpeg", "opencv", "pyav"]
    return [n for n in wanted if n in there and (n != "ffmpeg_hardware" or codec in HARDWARE_DECODERS)]


def run(df: DataFrame, names: list[str], schema: str, keep: list[str], registry: Registry | None = None) -> DataFrame:
    """``keep`` columns, ``schema`` columns, and ``backend, status, error``: each row through the first backend that does it.

    A row for which all fail gives one row with status ``failed`` and the last error; partial results of a failure are dropped.
    Rows come one by one, as a backend takes a video or an image at a time; those that take many at once are for
    :func:`run_batches`.
    """
    factories = [(n, (REGISTRY if registry is None else registry)[n]) for n in names]
    if not factories:
        raise ValueError("no backend is registered for this")
    fields = [c.strip().split()[0] for c in _split(schema)]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [(n, f()) for n, f in factories]
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                error = None
                for name, backend in made:
                    try:
                        found = backend(row)
                        out += [{**{k: row[k] for k in keep}, **{f: r.get(f) for f in fields}, "backend": name, "status": "ok", "error": None} for r in found]
                        break
                    except Exception as e:
                        error = f"{name}: {e}"
                else:
                    out.append({**{k: row[k] for k in keep}, **dict.fromkeys(fields), "backend": None, "status": "failed", "error": error})
            yield pd.DataFrame(out, columns=[*keep, *fields, "backend", "status", "error"])

    return df.mapInPandas(work, f"{kinds}, {schema}, backend string, status string, error string")


def run_batches(df: DataFrame, encoder: Callable[[], Callable[[np.ndarray], np.ndarray]], column: str, dim: int, out: str = "embedding", size: int = 128, half: bool = True) -> DataFrame:
    """``df`` without ``column`` and with ``out``: rows of numbers (``column``, all of one length) through a model, ``size`` at a
    time, and scaled to length one. The model is made once in a task. ``half``: rounded to half precision, as stored vectors are.

    Null rows have no vector.
    """
    kept = [f for f in df.schema.fields if f.name != column]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), f"{out} array<float>"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder()
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(column))
            there = np.flatnonzero(np.asarray(values.is_valid()))
            rows = values.take(pa.array(there)).flatten().to_numpy(zero_copy_only=False).reshape(len(there), -1) if len(there) else np.empty((0, 1))
            made = [np.asarray(model(rows[a : a + size]), np.float32) for a in range(0, len(rows), size)]
            x = np.concatenate(made) if made else np.empty((0, dim), np.float32)
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
            x = x.astype(np.float16).astype(np.float32) if half else x
            valid = np.zeros(len(values), bool)
            valid[there] = True
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(valid, dim, 0))]).astype(np.int32), mask=np.append(~valid, False))
            vectors = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x).ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)) for f in kept), vectors], [*(f.name for f in kept), out])

    return df.mapInArrow(work, schema)


def succeeded(done: DataFrame, some: bool = False) -> DataFrame:
    """The rows of :func:`run` that a backend did, without ``status`` and ``error``; ``some``: an error if there is none."""
    good = done.where("status = 'ok'").drop("status", "error")
    if some and good.isEmpty():
        raise RuntimeError("no backend did any row")
    return good


def _split(schema: str) -> list[str]:
    """Fields of a schema string; commas inside brackets do not separate."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:i])
            start = i + 1
    return [*out, schema[start:]]


class StubEncoder:
    """A vector of length one from the hash of a row's key: the same everywhere, for tests and dry runs."""

    name = "stub"

    def __init__(self, key: str = "path", dim: int = 64) -> None:
        self.key, self.dim = key, dim

    def __call__(self, row: dict) -> list[dict]:
        seed = int.from_bytes(hashlib.sha256(str(row[self.key]).encode()).digest()[:8], "big")
        x = np.random.default_rng(seed).normal(size=self.dim)
        return [{"embedding": (x / np.linalg.norm(x)).astype(np.float32).tolist()}]


register("stub", StubEncoder)

"""Filling containers of fixed capacity with texts, measured in tokens of a public tokenizer.

First-fit decreasing with a tournament tree of the containers' room, run independently in randomised groups of documents.
A text is split only if it alone exceeds the capacity: into full containers and one rest, which is packed like an item.

Defined results: null texts and texts without a token need no room and are not packed. Ties in size go by id. An id that
occurs twice is packed twice, told apart by nothing but its rows. A document falls into a group by its id and its place in
the table, so that an id that repeats, or none, does not fill one group. Extra columns are dropped; an empty table packs nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents in one group, on average: enough that first-fit decreasing fills well, few enough for one task.
GROUP_DOCS = 8192
#: A rank file of a byte-level tokenizer in the image; its path is a parameter and may name any other rank file.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that family of tokenizers cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_loaded: dict = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once in a process."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _loaded[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def sizes(df: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(id, n_tokens)`` of every row; a null text has none."""
    narrow = df.select(id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            n = [len(enc.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], [id_col, "n_tokens"])

    return narrow.mapInArrow(count, f"{id_col} {narrow.schema[0].dataType.simpleString()}, n_tokens bigint")


def first_fit(items: list[int], capacity: int) -> list[int]:
    """The container of each item, taken in the given order, none larger than ``capacity``.

    A tournament tree holds at every node the most room below it, so the leftmost container with room enough is found by
    one descent.
    """
    leaves = 1 << max(0, len(items) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    out = []
    for size in items:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        out.append(node - leaves)
        room[node] -= size
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left > right else right
    return out


def pack_group(ids: list, tokens: np.ndarray, capacity: int) -> tuple[list, list[int], list[int], list[int], list[int]]:
    """Columns id, piece, n_pieces, container and tokens of one group's items for one capacity."""
    order = np.lexsort((np.arange(len(ids)), -tokens))
    full = tokens // capacity
    rest = tokens - full * capacity
    pieces = full + (rest > 0)
    out_id, out_piece, out_n, out_bin, out_tokens = [], [], [], [], []
    next_bin = 0
    for i in order[full[order] > 0]:
        whole = int(full[i])
        out_id += [ids[i]] * whole
        out_piece += range(whole)
        out_n += [int(pieces[i])] * whole
        out_bin += range(next_bin, next_bin + whole)
        out_tokens += [capacity] * whole
        next_bin += whole
    left = np.flatnonzero(rest > 0)
    left = left[np.argsort(-rest[left], kind="stable")]
    for i, b in zip(left, first_fit(rest[left].tolist(), capacity), strict=True):
        out_id.append(ids[i])
        out_piece.append(int(full[i]))
        out_n.append(int(pieces[i]))
        out_bin.append(next_bin + b)
        out_tokens.append(int(rest[i]))
    return out_id, out_piece, out_n, out_bin, out_tokens


def pack(df: DataFrame, capacities: dict[str, int], id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, rows: int | None = None, seed: int = 7) -> DataFrame:
    """``(size_name, capacity, group_no, container, id, piece, n_pieces, n_tokens)``: where every piece of every text goes.

    ``rows``: how many rows ``df`` has, if known; else they are counted. Groups follow from it and hold ``GROUP_DOCS``
    documents each on average, whatever the size of the table. ``capacities`` must be positive.
    """
    if any(c <= 0 for c in capacities.values()):
        raise ValueError("capacities must be positive")
    groups = max(1, -(-(df.count() if rows is None else rows) // GROUP_DOCS))
    counted = sizes(df, id_col, text_col, tokenizer).where("n_tokens > 0")
    grouped = counted.withColumn("group_no", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.monotonically_increasing_id()), F.lit(groups)))
    id_type = counted.schema[0].dataType.simpleString()
    names = ["size_name", "capacity", "group_no", "container", id_col, "piece", "n_pieces", "n_tokens"]

    def fill(data: pa.Table) -> pa.Table:
        data = data.sort_by(id_col)
        ids, tokens = data.column(id_col).to_pylist(), data.column("n_tokens").to_numpy()
        group = data.column("group_no")[0].as_py()
        parts = []
        for name, capacity in capacities.items():
            i, piece, n, b, t = pack_group(ids, tokens, capacity)
            k = len(i)
            parts.append(pa.table([pa.array([name] * k, pa.string()), pa.array([capacity] * k, pa.int64()), pa.array([group] * k, pa.int64()), pa.array(b, pa.int64()), pa.array(i, data.schema.field(id_col).type), pa.array(piece, pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.int64())], names))
        return pa.concat_tables(parts)

    return grouped.groupBy("group_no").applyInArrow(fill, f"size_name string, capacity bigint, group_no bigint, container bigint, {id_col} {id_type}, piece bigint, n_pieces bigint, n_tokens bigint")


def filling(packed: DataFrame) -> DataFrame:
    """``(size_name, capacity, n_containers, n_tokens, fill)`` of the containers of :func:`pack`."""
    per = packed.groupBy("size_name", "capacity", "group_no", "container").agg(F.sum("n_tokens").alias("held"))
    return per.groupBy("size_name", "capacity").agg(F.count("*").alias("n_containers"), F.sum("held").alias("n_tokens"), (F.sum("held") / F.sum("capacity")).alias("fill"))

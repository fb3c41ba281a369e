"""A varied subset of each group of records, of a given size, by cluster features.

The records of a group are spread over parts by hash, and each part is summed up in a cluster-feature tree (features are
count, sum and sum of squares) whose threshold rises until its leaf entries are few enough. The entries of the parts are put into
trees again, two levels deep, which leaves one bounded set for each group. An entry stands for a region of about equal radius,
however many records it holds. The agglomeration by Ward linkage that follows counts every entry as one: weighed by their records,
frequent regions would be cut finer than rare ones, and the subset is to cover the variety without crowding there. It is cut at
as many groups as records are wanted, and each group gives the record nearest its centre. Parts and orders come from hashes
and keys, so the subset does not depend on how the table is partitioned.

Where more than ``FINAL`` records are wanted the cut makes coarse cells first; each gets its part of the number, in proportion
to its features, and is then treated as a group of its own, so no task sees more than ``ENTRIES`` features at once. Records
of a large group are spread over many tasks; the features are sent to each.

Defined results: records without a usable vector are never chosen; repeated records count once; exactly the wanted number
of different records comes out, all if there are fewer, none for a null, zero or negative number or for a group without
a request; equal vectors may be chosen more than once only if there are too few different ones. Ties go to the smaller
record. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelspark.llm import vectors
from reelspark.runtime import cut

#: Leaf entries of a tree, most wanted records that one agglomeration is cut at, and merges of summaries side by side in one group.
ENTRIES = 1024
FINAL = 512
MERGES = 64
#: Wanted records for each coarse cell, and records that meet in one task when the nearest to the centres are sought.
CELL = 256
SPREAD = 20_000
CHUNK = 4096


class Features:
    """Cluster features: how many records, their sum, and the sum of their squares."""

    def __init__(self, n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> None:
        self.n, self.total, self.squares = n, total, squares

    @classmethod
    def of(cls, x: np.ndarray) -> Features:
        return cls(np.ones(len(x)), x, (x**2).sum(1))

    def plus(self, other: Features) -> Features:
        return Features(np.concatenate([self.n, other.n]), np.concatenate([self.total, other.total]), np.concatenate([self.squares, other.squares]))

    def centres(self) -> np.ndarray:
        return self.total / self.n[:, None]

    def merged(self, to: np.ndarray) -> Features:
        """One feature for each value of ``to``."""
        _, to = np.unique(to, return_inverse=True)
        total = np.zeros((to.max() + 1, self.total.shape[1]))
        np.add.at(total, to, self.total)
        return Features(np.bincount(to, self.n), total, np.bincount(to, self.squares))

    def bounded(self, most: int) -> Features:
        """At most ``most`` features; equal records are always one."""
        now = self
        if len(now.n) > 1:
            mark = (now.centres() @ np.random.default_rng(9).normal(size=now.total.shape[1])).round(12)
            same = np.unique(mark, return_inverse=True)[1].ravel()
            now = now.merged(same) if same.max() + 1 < len(same) else now
        while len(now.n) > most:
            now, _ = now.condensed(most)
        return now

    def radius(self, other: Features | None = None) -> np.ndarray:
        """Mean square distance from the centre of the records of each feature, or of each together with that of ``other``."""
        n, total, squares = (self.n, self.total, self.squares) if other is None else (self.n + other.n, self.total + other.total, self.squares + other.squares)
        return np.maximum(squares / n - ((total / n[:, None]) ** 2).sum(1), 0)

    def take(self, at: np.ndarray) -> Features:
        return Features(self.n[at], self.total[at], self.squares[at])

    def condensed(self, most: int) -> tuple[Features, float]:
        """Fewer features, towards ``most``, and the largest radius that was made: of all pairs of nearest features those whose
        union is smallest are made one."""
        c = self.centres().astype(np.float32)
        half = 0.5 * (c**2).sum(1)
        near, far = np.empty(len(c), np.int64), np.empty(len(c))
        for a in range(0, len(c), 1024):
            d = half - c[a : a + 1024] @ c.T
            own = np.arange(len(d))
            d[own, a + own] = np.inf
            near[a : a + 1024] = d.argmin(1)
            far[a : a + 1024] = d[own, near[a : a + 1024]] + half[a : a + 1024]
        radius = self.radius(self.take(near))
        # those with the smallest radius join their nearest, if that is nearer to its own nearest, so that no ring closes
        one = np.arange(len(c))
        joins = np.flatnonzero((far > far[near]) | ((far == far[near]) & (one > near)))
        pick = joins[np.argsort(radius[joins], kind="stable")[: max(1, min(len(c) - most, len(c) // 4))]]
        one[pick] = near[pick]
        while (one[one] != one).any():
            one = one[one]
        return self.merged(one), float(radius[pick].max())


class Tree:
    """A cluster-feature tree: leaf entries below nodes, the nodes holding the sums of their entries.

    What is put in goes down by the nearest node to the nearest entry and is absorbed there if the union's radius stays within the
    threshold; else it becomes an entry. When there are more than twice ``most`` entries the threshold is raised until
    ``most`` are left, and the nodes are split anew, about as many as each has entries.
    """

    def __init__(self, most: int, entries: Features) -> None:
        self.most, self.threshold, self.entries = most, 0.0, entries
        self._renew()

    def _renew(self) -> None:
        now = self.entries
        if len(now.n) > 2 * self.most:
            now = now.bounded(len(now.n))  # equal records are one
            while len(now.n) > self.most:
                now, made = now.condensed(self.most)
                self.threshold = max(self.threshold, made)
        self.entries = now
        c = now.centres()
        nodes = c[:: max(1, int(np.sqrt(len(c))))]
        for _ in range(2):
            node = (0.5 * (nodes**2).sum(1) - c @ nodes.T).argmin(1)
            used, node = np.unique(node, return_inverse=True)
            nodes = Features(now.n, now.total, now.squares).merged(node).centres()
        self.node, self.nodes = node, nodes

    def put(self, new: Features) -> None:
        c = new.centres()
        node = (0.5 * (self.nodes**2).sum(1) - c @ self.nodes.T).argmin(1)
        entry, centre = np.zeros(len(c), np.int64), self.entries.centres()
        order, held = np.argsort(node, kind="stable"), np.argsort(self.node, kind="stable")
        begins = np.searchsorted(self.node[held], np.arange(len(self.nodes) + 1))
        for k in np.unique(node):
            mine, there = order[np.searchsorted(node[order], k) : np.searchsorted(node[order], k, "right")], held[begins[k] : begins[k + 1]]
            entry[mine] = there[(0.5 * (centre[there] ** 2).sum(1) - c[mine] @ centre[there].T).argmin(1)]
        fits = new.radius(self.entries.take(entry)) <= self.threshold
        into = np.append(entry[fits], np.arange(len(centre)))
        whole = new.take(np.flatnonzero(fits)).plus(self.entries).merged(into)
        if (bad := whole.radius() > np.maximum(self.threshold, self.entries.radius())).any():  # each fits, but not all of them
            fits &= ~bad[entry]
            whole = new.take(np.flatnonzero(fits)).plus(self.entries).merged(np.append(entry[fits], np.arange(len(centre))))
        self.entries = whole.plus(new.take(np.flatnonzero(~fits)))
        self.node = np.append(self.node, node[~fits])
        if len(self.entries.n) > 2 * self.most:
            self._renew()


def ward(x: np.ndarray, k: int) -> np.ndarray:
    """The group of each row when Ward linkage of ``x`` is cut at ``k`` groups, by chains of nearest neighbours."""
    n = len(x)
    if k >= n:
        return np.arange(n)
    g = x @ x.T
    d = np.maximum(np.diag(g)[:, None] + np.diag(g)[None, :] - 2 * g, 0)
    np.fill_diagonal(d, np.inf)
    size = np.ones(n)
    alive = np.ones(n, bool)
    merges, chain = [], []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.argmax(alive))]
        while True:
            here = chain[-1]
            to = int(d[here].argmin())
            if len(chain) > 1 and d[here, chain[-2]] <= d[here, to]:
                to = chain[-2]
                break
            chain.append(to)
        a, b = chain.pop(), chain.pop()
        merges.append((d[a, b], a, b))
        s = size[a] + size[b]
        new = ((size[a] + size) * d[a] + (size[b] + size) * d[b] - size * d[a, b]) / (s + size)
        new[~alive] = np.inf
        new[[a, b]] = np.inf
        d[a], d[:, a] = new, new
        d[b], d[:, b] = np.inf, np.inf
        alive[b] = False
        size[a] = s
    group = np.arange(n)

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for _, a, b in sorted(merges, key=lambda m: m[0])[: n - k]:
        a, b = top(a), top(b)
        group[max(a, b)] = min(a, b)
    return np.unique([top(i) for i in range(n)], return_inverse=True)[1]


def shares(wanted: int, weight: np.ndarray, most: np.ndarray) -> np.ndarray:
    """``wanted`` cut into whole parts in proportion to ``weight``, none above ``most``; all of ``most`` if that is less."""
    most = most.astype(np.int64)
    wanted = min(int(wanted), int(most.sum()))
    full = most == 0
    while True:
        free = ~full & (weight > 0) if (~full & (weight > 0)).any() else ~full
        part = np.where(free, weight if weight[free].any() else 1.0, 0.0)
        ideal = np.where(full, most, part / max(part.sum(), 1e-300) * (wanted - most[full].sum()))
        over = ~full & (ideal >= most)
        if not over.any():
            break
        full |= over
    out = np.floor(ideal + 1e-9).astype(np.int64)
    rest = np.where(out < most, ideal - out, -1)
    out[np.argsort(-rest, kind="stable")[: wanted - out.sum()]] += 1
    return out


def _summary(batches: Iterator[pa.RecordBatch], dim: int, summed: bool) -> Iterator[pa.RecordBatch]:
    """At most ``ENTRIES`` features for each group and salt, from a tree. Rows are sorted by group and salt; ``summed``: they are
    features already, else records. Memory holds one tree."""
    held: dict[tuple, Tree] = {}

    def out(name: tuple) -> pa.RecordBatch:
        f = held.pop(name).entries.bounded(ENTRIES)
        k = len(f.n)
        return pa.RecordBatch.from_arrays([pa.array([name[0]] * k), pa.array([name[1]] * k, pa.int64()), pa.array(f.n), pa.array(f.squares), vectors.to_binary(f.total)], ["group", "salt", "n", "squares", "total"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if summed:
            rows = Features(batch.column(2).to_numpy(), vectors.from_binary(batch.column(4), dim, np.float64), batch.column(3).to_numpy())
        else:
            rows = Features.of(vectors.unit(vectors.from_binary(batch.column(2), dim)))
        starts = np.flatnonzero(vectors.changes(vectors.codes(batch.column(0)), batch.column(1).to_numpy()))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            name = (batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
            for other in [n for n in held if n != name]:  # groups stand together, so the one before is complete
                yield out(other)
            for c in range(a, b, ENTRIES):
                new = rows.take(np.arange(c, min(c + ENTRIES, b)))
                if name in held:
                    held[name].put(new)
                else:
                    held[name] = Tree(ENTRIES, new)
    for name in list(held):
        yield out(name)


def _cut(group: pa.Table, dim: int) -> pa.Table:
    """Labels of one group's features: the group that Ward linkage puts each in, its centre, and how many are wanted of it.

    ``deeper``: the label is a coarse cell, to be treated as a group itself.
    """
    f = Features(group.column("n").to_numpy(), vectors.from_binary(group.column("total"), dim, np.float64), group.column("squares").to_numpy()).bounded(ENTRIES)
    wanted, there = int(group.column("wanted")[0].as_py()), int(round(f.n.sum()))
    c = f.centres()
    deeper = FINAL < wanted < there
    if wanted >= there:
        label, quota = np.zeros(len(c), np.int64), np.array([there])
    elif deeper:
        label = ward(c, min(len(c), -(-wanted // CELL)))
        quota = shares(wanted, np.bincount(label).astype(float), np.bincount(label, f.n).round())
    elif wanted <= len(c):
        label = ward(c, wanted)
        quota = np.ones(label.max() + 1, np.int64)
    else:
        label = np.arange(len(c))
        quota = 1 + shares(wanted - len(c), np.ones(len(c)), f.n.round() - 1)
    if deeper and label.max() == 0:  # one place only: nothing to tell the records apart by
        deeper = False
    centre = f.merged(label).centres()
    k = len(c)
    name = group.column("group")[0].as_py()
    return pa.table([pa.array([name] * k), vectors.to_binary(c), pa.array(label), vectors.to_binary(centre[label]), pa.array(quota[label]), pa.array([deeper] * k)], ["group", "entry", "label", "centre", "quota", "deeper"])


def _nearest(records: pa.Table, entries: pa.Table, dim: int, names: list[str]) -> pa.Table:
    """Of one part of a group: every record with its label; where the label is final, without its vector and with whether it
    is near enough to be chosen."""
    if not records.num_rows or not entries.num_rows:
        return pa.table({n: pa.array([], records.schema.field(n).type) for n in names[:3]} | {"vec": pa.array([], pa.binary()), "label": pa.array([], pa.int64()), "quota": pa.array([], pa.int64()), "deeper": pa.array([], pa.bool_()), "distance": pa.array([], pa.float64()), "first": pa.array([], pa.bool_()), "part": pa.array([], pa.int64())})
    c = vectors.from_binary(entries.column("entry"), dim, np.float64)
    centre = vectors.from_binary(entries.column("centre"), dim, np.float64)
    half = 0.5 * (c**2).sum(1)
    at, distance = [], []
    for a in range(0, records.num_rows, 2048):
        x = vectors.unit(vectors.from_binary(records.column("vec").slice(a, 2048), dim))
        near = (half - x @ c.T).argmin(1)
        at.append(near)
        distance.append(((x - centre[near]) ** 2).sum(1))
    at, distance = np.concatenate(at), np.concatenate(distance)
    label, quota = entries.column("label").to_numpy()[at], entries.column("quota").to_numpy()[at]
    deeper = bool(entries.column("deeper")[0].as_py())
    first = np.ones(len(at), bool)
    if not deeper:
        who = records.select(names[1:3]).to_pandas()
        order = np.lexsort((who[names[2]].to_numpy(), who[names[1]].to_numpy(), distance, label))
        rank = np.arange(len(order)) - np.searchsorted(label[order], label[order])
        first[order] = rank < quota[order]
    vec = records.column("vec") if deeper else pa.nulls(len(at), pa.binary())
    return pa.table([*records.select(names[:3]).columns, vec, pa.array(label), pa.array(quota), pa.array(np.full(len(at), deeper)), pa.array(distance), pa.array(first), records.column("part")], [*names[:3], "vec", "label", "quota", "deeper", "distance", "first", "part"])


def _again(labels: pa.Table) -> pa.Table:
    """How many of the records missing in a group each of its labels gives, in proportion to what was wanted of it."""
    more = shares(labels.column("missing")[0].as_py(), labels.column("quota").to_numpy().astype(float), labels.column("free").to_numpy())
    return pa.table([*labels.select(["path", "label"]).columns, pa.array(more)], ["path", "label", "more"])


def _keyframe_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted records that have a vector. Rows are sorted by video, chunk, frame and kind: 0 a vector, 1 a wanted record."""
    for table in vectors.whole_groups(batches, ["video_id", "chunk"]):
        group = np.cumsum(vectors.changes(vectors.codes(table.column("video_id")), table.column("chunk").to_numpy()))
        frame, kind = table.column("frame_idx").to_numpy(), table.column("kind").to_numpy()
        key = np.flatnonzero(kind == 1)
        key = key[key > 0]
        key = key[(kind[key - 1] == 0) & (frame[key - 1] == frame[key]) & (group[key - 1] == group[key])]
        at = pa.array(key)
        yield pa.RecordBatch.from_arrays([table.column(c).combine_chunks().take(at if c != "vec" else pa.array(key - 1)) for c in ("video_id", "frame_idx", "vec")], ["video_id", "frame_idx", "vec"])


def records_of(indices: DataFrame, frames: DataFrame, vector_col: str = "embedding", dim: int = vectors.DIM) -> DataFrame:
    """``(video_id, frame_idx, vec)`` of the different frames of ``indices`` that have a usable vector in ``frames``."""
    frame = F.col("frame_idx").cast("bigint").alias("frame_idx")
    keys = indices.select("video_id", frame).dropna()
    packed = vectors.pack(frames.select("video_id", frame, vector_col), ["video_id", "frame_idx"], vector_col, dim, vectors.Bloom(keys, ["video_id", "frame_idx"]))
    rows = packed.select("video_id", "frame_idx", F.lit(0).alias("kind"), "vec").unionByName(keys.distinct().select("video_id", "frame_idx", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("vec")))
    rows = rows.withColumn("chunk", F.floor(F.col("frame_idx") / CHUNK))
    return vectors.grouped(rows, ["video_id", "chunk"], ["frame_idx", "kind"]).mapInArrow(_keyframe_vectors, "video_id string, frame_idx bigint, vec binary")


def choose(records: DataFrame, request: DataFrame, dim: int = vectors.DIM) -> DataFrame:
    """``(group, video_id, frame_idx)``: the records of :func:`marked`."""
    return marked(records, request, dim).drop("filled")


def marked(records: DataFrame, request: DataFrame, dim: int = vectors.DIM) -> DataFrame:
    """``(group, video_id, frame_idx, filled)``: the records chosen, and which fill up for labels with too few records.

    ``records``: ``group, video_id, frame_idx, vec``, each record once; ``request``: ``group, wanted``, each group once (of
    several the largest number holds).
    """
    ask = request.select("group", F.col("wanted").cast("bigint").alias("wanted")).where("wanted > 0 and group is not null").groupBy("group").agg(F.max("wanted").alias("wanted"))
    whole = cut(records.select("group", "video_id", "frame_idx", "vec").join(F.broadcast(ask) if _small(ask) else ask, "group", "left_semi"), "records")
    now, asked, chosen, final = whole.withColumn("root", F.col("group")), ask, [], []
    names = ["group", "video_id", "frame_idx"]
    cf = "group string, salt bigint, n double, squares double, total binary"
    while True:
        # records are spread by hash and summed up in a fixed order, so that the outcome does not depend on how they are partitioned
        spread = cut(now.groupBy("group").agg(F.ceil(F.count("*") / SPREAD).alias("spread")), "spread")
        parts = now.join(spread, "group").withColumn("part", F.pmod(F.xxhash64("video_id", "frame_idx"), F.col("spread"))).drop("spread")
        first = vectors.grouped(parts, ["group", "part"], ["video_id", "frame_idx"]).select("group", F.col("part").alias("salt"), "vec").mapInArrow(lambda b: _summary(b, dim, False), cf)
        second = vectors.grouped(first.withColumn("part", F.col("salt")).withColumn("salt", F.pmod("salt", F.lit(MERGES))), ["group", "salt"], ["part", "n", "squares", "total"]).drop("part").mapInArrow(lambda b: _summary(b, dim, True), cf)
        last = vectors.grouped(second.withColumn("part", F.col("salt")).withColumn("salt", F.lit(0).cast("bigint")), ["group", "salt"], ["part", "n", "squares", "total"]).drop("part").mapInArrow(lambda b: _summary(b, dim, True), cf)
        entries = cut(last.join(asked, "group").groupBy("group").applyInArrow(lambda g: _cut(g, dim), "group string, entry binary, label bigint, centre binary, quota bigint, deeper boolean"), "entries")
        copies = entries.join(spread, "group").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("spread") - 1))).drop("spread")
        near = parts.groupBy("group", "part").cogroup(copies.groupBy("group", "part")).applyInArrow(lambda r, e: _nearest(r, e, dim, names), "group string, video_id string, frame_idx bigint, vec binary, label bigint, quota bigint, deeper boolean, distance double, first boolean, part bigint")
        near = cut(near, "near")
        rank = F.row_number().over(Window.partitionBy("group", "label").orderBy("distance", "video_id", "frame_idx"))
        chosen.append(near.where("not deeper and first").withColumn("rank", rank).where("rank <= quota").select(F.substring_index("group", "\x00", 1).alias("group"), "video_id", "frame_idx"))
        final.append(near.where("not deeper").select(F.substring_index("group", "\x00", 1).alias("group"), F.col("group").alias("path"), "label", "part", "quota", "video_id", "frame_idx", "distance"))
        deeper = entries.where("deeper")
        if not deeper.limit(1).count():
            break
        under = F.concat_ws("\x00", "group", F.col("label").cast("string"))
        asked = deeper.select(under.alias("group"), F.col("quota").alias("wanted")).distinct()
        now = near.where("deeper").select(under.alias("group"), "video_id", "frame_idx", "vec")
    picked = cut(reduce(DataFrame.unionByName, chosen), "picked")
    # a centre may lose all its records to its neighbours' centres; what is missing is then wanted of the group's other labels
    have = picked.groupBy("group").agg(F.count("*").alias("have"))
    there = whole.groupBy("group").agg(F.count("*").alias("there"))
    short = there.join(ask, "group").join(have, "group", "left").select("group", (F.least("there", "wanted") - F.coalesce("have", F.lit(0))).alias("missing")).where("missing > 0")
    picked, short = picked.withColumn("filled", F.lit(False)), cut(short, "short")
    if short.limit(1).count():
        rest = reduce(DataFrame.unionByName, final).join(short, "group").join(picked, names, "left_anti")
        labels = rest.groupBy("group", "path", "label").agg(F.count("*").alias("free"), F.max("quota").alias("quota"), F.max("missing").alias("missing"))
        given = cut(labels.groupBy("group").applyInArrow(_again, "path string, label bigint, more bigint").where("more > 0"), "given")
        rank = F.row_number().over(Window.partitionBy("path", "label", "part").orderBy("distance", "video_id", "frame_idx"))
        last = F.row_number().over(Window.partitionBy("path", "label").orderBy("distance", "video_id", "frame_idx"))
        next_ones = rest.join(given, ["path", "label"]).withColumn("rank", rank).where("rank <= more").withColumn("rank", last).where("rank <= more")
        picked = picked.unionByName(next_ones.select(*names, F.lit(True).alias("filled")))
    return picked


def _small(ask: DataFrame) -> bool:
    """Whether a request is small enough to be sent to every task."""
    return ask.limit(10_001).count() <= 10_000

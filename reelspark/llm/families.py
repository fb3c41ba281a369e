"""Families of similar records, by parallel pivot clustering and an exact comparison of the clusters.

Records with exactly equal vectors are first made one. A k-means tree, fitted on a bounded sample, gives every record a leaf;
all that the tree decides is which records meet first, not which are compared. Within a leaf pivots are chosen in rounds: a
record whose hash is the smallest among its similar neighbours not yet absorbed becomes a pivot and absorbs them; afterwards
every member goes to its most similar pivot. A leaf of more than ``BLOCK_ROWS`` records is cut into blocks.

A cluster is then known by its pivot, its centre and the angle from the centre to its farthest member. All clusters are compared
with all others, in pairs of blocks. Where the angle of two centres is above both radii and the angle of ``least`` together, no
members can be similar; where the pivots are similar, the clusters are tied; in all other cases the members themselves are
compared. So no link is missed, and none depends on the tree, its sample or the size of a leaf. Families are the connected
components of the ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelspark.llm import vectors
from reelspark.llm.components import components
from reelspark.llm.tree import Tree, sample_size
from reelspark.runtime import cut

LEAF_ROWS = 256
BLOCK_ROWS = 2048
#: Clusters of one block when all are compared with all, and the least number of blocks, so that there is work for many tasks.
CLUSTERS = 131_072
BLOCKS = 8
#: Clusters of either side that are compared in one step.
TILE = (512, 4096)
#: Undecided records of a family among which pivots are sought in one round, and records that meet the pivots in one task.
PREFIX = 1024
PART_ROWS = 20_000
#: Radians by which bounds are widened for rounding.
SLACK = 1e-3


def order_of(ids: np.ndarray) -> np.ndarray:
    """The hash that orders records."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pivots(ids: np.ndarray, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The place of each record's pivot and the similarity to it, for unit vectors ``x``."""
    n = len(ids)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((ids, order_of(ids)))] = np.arange(n)
    similar = np.empty((n, n), bool)
    for a in range(0, n, 512):
        similar[a : a + 512] = x[a : a + 512] @ x.T >= least
    np.fill_diagonal(similar, True)
    pivot = np.full(n, -1)
    lone = similar.sum(1) == 1
    pivot[lone] = np.flatnonzero(lone)
    left = np.flatnonzero(~lone)
    chosen = []
    while len(left):
        near = similar[np.ix_(left, left)]
        smallest = np.where(near, rank[left][None, :], n).min(1)
        new = left[smallest == rank[left]]
        chosen.append(new)
        left = left[~near[:, np.searchsorted(left, new)].any(1)]
    if chosen:
        all_pivots = np.sort(np.concatenate(chosen))
        members = np.flatnonzero(~lone)
        sims = x[members] @ x[all_pivots].T
        pivot[members] = all_pivots[sims.argmax(1)]
        pivot[all_pivots] = all_pivots
    return pivot, np.einsum("ij,ij->i", x, x[pivot])


def merge(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``group`` (a number for each record) after the groups of ``a`` and ``b`` are made one, pair by pair."""
    n = len(group)
    pair = np.unique(np.stack([group[a], group[b]]), axis=1)
    pair = pair[:, pair[0] != pair[1]]
    while pair.shape[1]:
        to = np.arange(n)
        np.minimum.at(to, pair[0], pair[1])
        np.minimum.at(to, pair[1], pair[0])
        while (to[to] != to).any():
            to = to[to]
        group = to[group]
        pair = np.unique(to[pair], axis=1)
        pair = pair[:, pair[0] != pair[1]]
    return group


def clusters(x: np.ndarray, pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places of the pivots, and of their clusters the centres in single precision, the radii as angles, and the sizes."""
    at, inverse = np.unique(pivot, return_inverse=True)
    total = np.zeros((len(at), x.shape[1]))
    np.add.at(total, inverse, x)
    centre = vectors.unit(total, np.float32)
    radius, size = np.zeros(len(at)), np.bincount(inverse)
    np.maximum.at(radius, inverse, np.arccos(np.clip(np.einsum("ij,ij->i", x, centre[inverse].astype(np.float64)), -1, 1)))
    return at, centre, np.where(size > 1, radius, 0.0), size


def meet(rows: pa.Table, least: float, dim: int, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the clusters of two blocks (``side`` 0 and 1; of one block with itself if there is only side 0) the ties, and the
    pairs whose members must be compared, as two columns of ids, the larger cluster first, and whether they are such a pair.

    ``basis``: directions by which most pairs are told apart, see :func:`shortened`."""
    ids, size, radius = (rows.column(c).to_numpy() for c in ("id", "n", "radius"))
    x = vectors.from_binary(rows.column("vec"), dim)
    centre = x.copy()
    many = np.flatnonzero(size > 1)
    if len(many):
        centre[many] = vectors.from_binary(rows.column("centre").take(pa.array(many)), dim)
    side = rows.column("side").to_numpy()
    one = len(rows) and side.max() == 0
    home, others = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if one else 1))
    short = shortened(centre, basis)
    angle = np.arccos(least) + SLACK
    group, left = np.arange(len(ids)), []
    for a in range(0, len(home), TILE[0]):
        at = home[a : a + TILE[0]]
        reach = np.minimum(np.pi, angle + radius[at])
        far = np.cos(reach).astype(np.float32) - np.float32(1e-5)
        for b in range(0, len(others), TILE[1]):
            to = others[b : b + TILE[1]]
            if one and to[-1] <= at[0]:
                continue
            hit = short[at] @ short[to].T >= far[:, None]
            wide = np.flatnonzero(size[to] > 1)
            if len(wide):
                hit[:, wide] = short[at] @ short[to[wide]].T >= np.cos(np.minimum(np.pi, reach[:, None] + radius[to[wide]])) - 1e-5
            many = np.count_nonzero(hit)
            if not many:
                continue
            if many > 4096:  # most are of one family by then
                hit &= group[at][:, None] != group[to][None, :]
            r, c = np.divmod(places(hit), len(to))
            r, c = at[r], to[c]
            if one:
                r, c = r[r < c], c[r < c]
            for k in range(0, len(r), 65_536):
                p, q = r[k : k + 65_536], c[k : k + 65_536]
                new = group[p] != group[q]
                p, q = p[new], q[new]
                near = np.einsum("ij,ij->i", centre[p], centre[q]) >= np.cos(np.minimum(np.pi, angle + radius[p] + radius[q])) - 1e-5
                p, q = p[near], q[near]
                sure = np.einsum("ij,ij->i", x[p].astype(np.float64), x[q].astype(np.float64)) >= least
                if sure.any():
                    group = merge(group, p[sure], q[sure])
                some = ~sure & ((size[p] > 1) | (size[q] > 1))
                left.append(np.stack([p[some], q[some]]))
    p, q = np.concatenate(left, axis=1) if left else np.empty((2, 0), np.int64)
    p, q = p[group[p] != group[q]], q[group[p] != group[q]]
    p, q = np.where(size[p] >= size[q], p, q), np.where(size[p] >= size[q], q, p)
    tied = np.flatnonzero(group != np.arange(len(ids)))
    return np.concatenate([ids[tied], ids[p]]), np.concatenate([ids[group[tied]], ids[q]]), np.arange(len(tied) + len(p)) >= len(tied)


def places(hit: np.ndarray) -> np.ndarray:
    """Places of the true values in ``hit``, read row by row; eight are looked at at once, as few are true."""
    flat = hit.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    some = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return some[flat[some]]


def directions(sample: np.ndarray, least: float) -> np.ndarray:
    """Orthogonal directions of which the first few tell most pairs apart: as many of the strongest of the sample as leave hardly
    a pair open when what is beyond them is only known by its length, or all."""
    dim = sample.shape[1]
    if len(sample) < 2:
        return np.eye(dim, dtype=np.float32)
    some = sample[:2000]
    strong = np.linalg.eigh(some.T @ some)[1][:, ::-1].astype(np.float32)
    true = (some @ some.T >= least).mean()
    for k in (8, 16, 24, 32, 48):
        short = shortened(some.astype(np.float32), strong[:, :k])
        if k < dim and (short @ short.T >= np.cos(np.arccos(least) + SLACK)).mean() < true + 1e-3:
            return strong[:, :k]
    return strong


def shortened(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Rows whose products are never less than those of the unit vectors ``x``: what they have along ``basis``, and the
    length of the rest."""
    along = x @ basis
    if basis.shape[1] == x.shape[1]:
        return along
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", along, along, dtype=np.float64))).astype(np.float32) + np.float32(1e-6)
    return np.concatenate([along, rest[:, None]], axis=1)


def compare(home: pa.Table, visitors: pa.Table, least: float, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The visitors that have a similar record in the cluster ``home``, each with that cluster's pivot, as two columns of ids."""
    if not home.num_rows or not visitors.num_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x = vectors.from_binary(home.column("vec"), dim).astype(np.float64)
    out = []
    for k in range(0, visitors.num_rows, 512):
        y = vectors.from_binary(visitors.column("vec").slice(k, 512), dim).astype(np.float64)
        out.append((y @ x.T >= least).any(1))
    own = visitors.column("id").to_numpy()[np.concatenate(out)]
    return own, np.full(len(own), home.column("cell")[0].as_py())


class Families:
    """Families among ``records`` (``id`` bigint without nulls or repeats, ``vec`` unit vectors in single precision,
    which gives similarities to about 1e-7).

    ``members``: ``(id, root)`` of every record but the smallest of each family, ``root`` being that smallest id. Records
    without a similar one are in no row.
    """

    def __init__(self, records: DataFrame, least: float, dim: int = vectors.DIM, seed: int = 5) -> None:
        self.least, self.dim = least, dim
        self.records = cut(records.select("id", "vec"), "records")
        copies = self.records.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("n"))
        distinct = cut(copies, "distinct")
        rows = distinct.count()
        wanted = sample_size(rows, LEAF_ROWS)
        some = distinct.select("id", "vec").sample(min(1.0, wanted / max(rows, 1)), seed).toArrow()
        sample = vectors.from_binary(some.column("vec"), dim).astype(np.float64)
        self.tree, self.basis = Tree(sample, seed), directions(sample, least)
        self._count(distinct)
        self.pivots = self._local(distinct)
        links = self._linked()
        if distinct.where("n > 1").limit(1).count():
            first = distinct.where("n > 1").select("vec", F.col("id").alias("b"))
            links = links.unionByName(self.records.join(first, "vec").select(F.col("id").alias("a"), "b").where("a <> b"))
        self.members = components(links)

    def _count(self, distinct: DataFrame) -> None:
        """Sets ``blocks``, the blocks of each leaf."""
        tree, dim = self.tree, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros(tree.leaves, np.int64)
            for batch in batches:
                count += np.bincount(tree.assign(vectors.from_binary(batch.column(0), dim)), minlength=tree.leaves)
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["leaf", "n"])

        # at most one number for each leaf
        found = distinct.select("vec").mapInArrow(run, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n")).toPandas()
        rows_in = np.zeros(tree.leaves, np.int64)
        rows_in[found.leaf.to_numpy()] = found.n.to_numpy()
        self.blocks = np.maximum(1, -(-rows_in // BLOCK_ROWS))

    def _local(self, distinct: DataFrame) -> DataFrame:
        """``(id, vec, pivot, centre, radius, n)``: each record with its pivot; a pivot also with the centre (null if it is
        alone), the radius and the size of its cluster."""
        tree, blocks, least, dim = self.tree, self.blocks, self.least, self.dim
        begin = np.concatenate([[0], np.cumsum(blocks)])

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_numpy()
                leaf = tree.assign(vectors.from_binary(batch.column(1), dim))
                cell = begin[leaf] + (order_of(ids) >> np.uint64(20)).astype(np.int64) % blocks[leaf]
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], ["cell", "id", "vec"])

        def choose(home: pa.Table) -> pa.Table:
            ids = home.column("id").to_numpy()
            x = vectors.from_binary(home.column("vec"), dim).astype(np.float64)
            pivot, _ = pivots(ids, x, least)
            at, centre, radius, size = clusters(x, pivot)
            place = np.full(len(ids), -1)
            place[at] = np.arange(len(at))
            here = pa.array(place, mask=place < 0)
            centres = vectors.to_binary(centre).take(pa.array(place, mask=(place < 0) | (size[place] == 1)))
            return pa.table([home.column("id"), home.column("vec"), pa.array(ids[pivot]), centres, pa.array(radius).take(here), pa.array(size).take(here)], ["id", "vec", "pivot", "centre", "radius", "n"])

        placed = distinct.select("id", "vec").mapInArrow(place, "cell bigint, id bigint, vec binary")
        return cut(placed.groupBy("cell").applyInArrow(choose, "id bigint, vec binary, pivot bigint, centre binary, radius double, n bigint"), "pivots")

    def _linked(self) -> DataFrame:
        """``(a, b)``: the ties of all members with their pivots and of all clusters with each other."""
        least, dim, basis = self.least, self.dim, self.basis
        heads = self.pivots.where("n is not null").select("id", "vec", "centre", "radius", "n")
        blocks = max(BLOCKS, -(-heads.count() // CLUSTERS))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 4096):
                    batch = whole.slice(at, 4096)
                    own = (order_of(batch.column(0).to_numpy()) >> np.uint64(20)).astype(np.int64) % blocks
                    for other in range(blocks):
                        cell = np.minimum(own, other) * blocks + np.maximum(own, other)
                        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array((own > other).astype(np.int64)), *batch.columns], ["cell", "side", *batch.schema.names])

        def tie(rows: pa.Table) -> pa.Table:
            first, last = divmod(rows.column("cell")[0].as_py(), blocks)
            if first != last and len(set(rows.column("side").unique().to_pylist())) < 2:  # the other block is empty
                rows = rows.slice(0, 0)
            return pa.table([pa.array(z) for z in meet(rows, least, dim, basis)], ["a", "b", "open"])

        def look(home: pa.Table, visitors: pa.Table) -> pa.Table:
            return pa.table([pa.array(z) for z in compare(home, visitors, least, dim)], ["a", "b"])

        sent = heads.mapInArrow(send, "cell bigint, side bigint, id bigint, vec binary, centre binary, radius double, n bigint")
        met = cut(sent.groupBy("cell").applyInArrow(tie, "a bigint, b bigint, open boolean"), "met")
        links = self.pivots.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).unionByName(met.where("not open").select("a", "b"))
        members = self.pivots.select("pivot", "id", "vec")
        pairs = met.where("open").select("a", "b")
        home = members.join(pairs.select(F.col("a").alias("pivot")).distinct(), "pivot", "left_semi").select(F.col("pivot").alias("cell"), "id", "vec")
        visitors = members.join(pairs.select("a", F.col("b").alias("pivot")), "pivot").select(F.col("a").alias("cell"), F.col("id").alias("id"), F.col("vec").alias("vec"))
        return links.unionByName(home.groupBy("cell").cogroup(visitors.groupBy("cell")).applyInArrow(look, "a bigint, b bigint"))

    def _family(self) -> DataFrame:
        """``(root, id, vec)`` of every record of a family of two or more."""
        roots = self.members.select("root").distinct()
        return cut(self.members.unionByName(roots.select(F.col("root").alias("id"), "root")).join(self.records, "id").select("root", "id", "vec"), "families")

    def _nearest(self, rows: DataFrame, points: DataFrame, floor: float) -> DataFrame:
        """``(root, id, vec, pivot, similarity)``: each record of ``rows`` (the same columns) with the most similar of ``points``
        (``root, id, vec``) of its family if that is similar by ``floor`` and more similar than the pivot it has."""
        dim = self.dim
        parts = rows.groupBy("root").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
        names = ["root", "id", "vec", "pivot", "similarity"]

        def closer(mine: pa.Table, there: pa.Table) -> pa.Table:
            mine = mine.select(names)
            if not mine.num_rows or not there.num_rows:
                return mine
            ids = there.column("id").to_numpy()
            order = np.argsort(ids)
            y, ids = vectors.from_binary(there.column("vec"), dim)[order].astype(np.float64), ids[order]
            pivot, has = mine.column("pivot").to_pandas().fillna(-1).to_numpy(np.int64), ~np.asarray(mine.column("pivot").is_null())
            sim = mine.column("similarity").to_numpy(zero_copy_only=False).copy()
            for a in range(0, mine.num_rows, 1024):
                x = vectors.from_binary(mine.column("vec").slice(a, 1024), dim).astype(np.float64)
                for b in range(0, len(ids), 8192):
                    s = x @ y[b : b + 8192].T
                    best = s.argmax(1)
                    s = s[np.arange(len(s)), best]
                    now = slice(a, a + len(s))
                    better = (s >= floor) & (~has[now] | (s > sim[now]))
                    pivot[now], sim[now], has[now] = np.where(better, ids[b + best], pivot[now]), np.where(better, s, sim[now]), has[now] | better
            return pa.table([mine.column("root"), mine.column("id"), mine.column("vec"), pa.array(pivot, mask=~has), pa.array(sim, mask=~has)], names)

        salted = rows.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        copies = points.join(parts, "root").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).select("root", "part", "id", "vec")
        return salted.groupBy("root", "part").cogroup(copies.groupBy("root", "part")).applyInArrow(closer, "root bigint, id bigint, vec binary, pivot bigint, similarity double")

    def _medoids(self, rows: DataFrame) -> DataFrame:
        """``(root, id, vec)``: of each cluster (``root, pivot``) the record most similar to the mean, ties to the smaller id."""
        dim = self.dim

        def middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, m = vectors.from_binary(batch.column(3), dim), vectors.from_binary(batch.column(4), dim, np.float64)
                sim = np.einsum("ij,ij->i", x, m) / np.maximum(np.linalg.norm(m, axis=1), 1e-300)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sim)], ["root", "pivot", "id", "vec", "near"])

        means = self._means(rows.select(F.col("pivot").alias("root"), "vec")).select(F.col("root").alias("pivot"), "mean")
        near = rows.select("root", "pivot", "id", "vec").join(means, "pivot").select("root", "pivot", "id", "vec", "mean").mapInArrow(middle, "root bigint, pivot bigint, id bigint, vec binary, near double")
        best = near.groupBy("root", "pivot").agg(F.min_by(F.struct("id", "vec"), F.struct((-F.col("near")).alias("far"), "id")).alias("m"))
        return best.select("root", "m.id", "m.vec")

    def clusters(self, rounds: int = 2) -> DataFrame:
        """``(family, cluster, size, id, similarity)``: every record of a family of two or more with the cluster it is in, known by
        its medoid, the size of that, and the similarity to the medoid.

        Pivots of all of a family, wherever the tree put its records: in rounds the undecided records that come first by hash
        are taken, the local minima among them become pivots, and these absorb all that is similar. Every record then goes to the
        closest pivot, medoids are worked out, and records go to the closest medoid, ``rounds`` times. Pivots are not similar
        to each other, so there are few for the space that a family takes up, however many records it has.
        """
        least, dim = self.least, self.dim

        def pick(rows: pa.Table) -> pa.Table:
            ids = rows.column("id").to_numpy()
            rows, ids = rows.take(pa.array(np.argsort(ids))), np.sort(ids)
            chosen, _ = pivots(ids, vectors.from_binary(rows.column("vec"), dim).astype(np.float64), least)
            return rows.select(["root", "id", "vec"]).take(pa.array(np.unique(chosen)))

        now = self._family().select("root", "id", "vec", F.lit(None).cast("bigint").alias("pivot"), F.lit(None).cast("double").alias("similarity"))
        while True:
            left = now.where("pivot is null")
            first = left.withColumn("n", F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("id"), "id"))).where(F.col("n") <= PREFIX)
            new = cut(first.select("root", "id", "vec").groupBy("root").applyInArrow(pick, "root bigint, id bigint, vec binary"), "new")
            if not new.limit(1).count():
                break
            now = cut(self._nearest(now, new, least), "clusters", instead_of=now)
        for _ in range(rounds):
            medoids = cut(self._medoids(now), "medoids")
            now = cut(self._nearest(now.select("root", "id", "vec", F.lit(None).cast("bigint").alias("pivot"), F.lit(None).cast("double").alias("similarity")), medoids, -1.0), "clusters")
        size = now.groupBy("pivot").agg(F.count("*").alias("size"))
        return now.join(size, "pivot").select(F.col("root").alias("family"), F.col("pivot").alias("cluster"), "size", "id", "similarity")

    def _means(self, rows: DataFrame) -> DataFrame:
        """``(root, mean, n)``: of the vectors of each ``root`` the sum in double precision, and how many they are."""
        dim = self.dim

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                root, inverse = np.unique(batch.column(0).to_numpy(), return_inverse=True)
                total = np.zeros((len(root), dim))
                np.add.at(total, inverse, vectors.from_binary(batch.column(1), dim, np.float32 if batch.num_columns == 2 else np.float64))
                n = np.bincount(inverse) if batch.num_columns == 2 else np.bincount(inverse, batch.column(2).to_numpy()).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(root), vectors.to_binary(total), pa.array(n.astype(np.int64))], ["root", "vec", "n"])

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in vectors.whole_groups(batches, ["root"]):
                for batch in add(whole.combine_chunks().to_batches(max_chunksize=whole.num_rows)):
                    yield batch

        sums = "root bigint, vec binary, n bigint"
        partly = rows.select("root", "vec").mapInArrow(add, sums)
        return vectors.grouped(partly, ["root"], []).mapInArrow(finish, sums).select("root", F.col("vec").alias("mean"), "n")

    def described(self, typical: int = 3) -> DataFrame:
        """``(family, size, id, rank, similarity)``: of each family of two or more its size and the ``typical`` records most
        similar to the mean of its vectors (by five decimals of the cosine; ties to the smaller id)."""
        dim, family = self.dim, self._family()

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, m = vectors.from_binary(batch.column(2), dim), vectors.from_binary(batch.column(3), dim, np.float64)
                sim = np.einsum("ij,ij->i", x, m) / np.maximum(np.linalg.norm(m, axis=1), 1e-300)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), batch.column(1), pa.array(sim)], ["family", "size", "id", "similarity"])

        scored = family.join(self._means(family), "root").select("root", "id", "vec", "mean", "n").mapInArrow(score, "family bigint, size bigint, id bigint, similarity double")
        rank = F.row_number().over(Window.partitionBy("family").orderBy(F.round("similarity", 5).desc(), "id"))
        return scored.withColumn("rank", rank).where(F.col("rank") <= typical).select("family", "size", "id", "rank", "similarity")

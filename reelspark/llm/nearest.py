"""The k most similar vectors of every query vector, by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample and holds every row. A query visits leaves in best-bin-first order; how many is
calibrated: for a bounded number of sample vectors the exact answers are found by comparing them with all rows, and visits
are widened until the answers found reach the wanted recall. Similarity is the cosine; ties go to the smaller id.

Where leaves hold more rows than ``DEEP_ROWS``, because the table is larger than the largest tree is made for or because many
vectors lie close together, they get trees of their own, fitted in tasks and kept as a table. A query then takes, of all lowest
leaves below the leaves it visits, the nearest, as many as calibration says, so its work does not grow with the table.

Defined results: rows with an unusable vector (null, wrong length, not finite, all zero) are neither queries nor answers; a
query whose id has no usable vector gets no row; rows that repeat an id count once, and a vector is never its own answer,
but other ids with an equal vector are. Of exactly equal vectors each task keeps the first k+1 ids before the shuffle, more
cannot be among the answers of any query. With fewer than k+1 vectors all others are returned. Empty tables give an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from reelspark.llm import tree as tree_of
from reelspark.llm import vectors
from reelspark.llm.tree import Tree, sample_size
from reelspark.runtime import cut

#: Vectors whose exact answers set the number of visits, and the share of their answers that must be found.
CALIBRATION = 128
RECALL = 0.997
#: Visits of a leaf that meet in one task, and rows of equal vectors that a task holds back, or of one leaf that it takes through a tree.
VISITORS = 65_536
HOT_ROWS = 65_536
#: Ids up to which queries are sought by a broadcast of their ids (2 MB); more are sought with a filter of bounded size.
FEW_QUERIES = 200_000


def best(sims: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``sims`` the places of the ``k`` largest, ties to the smaller of ``ids``; as row and column numbers.

    A similarity of minus infinity is no answer.
    """
    k = min(k, sims.shape[1])
    if not k or not len(sims):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = -np.partition(-sims, k - 1, axis=1)[:, k - 1]
    r, c = np.nonzero((sims >= edge[:, None]) & (sims > -np.inf))
    order = np.lexsort((ids[c], -sims[r, c], r))
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    return r[rank < k], c[rank < k]


class Search:
    """A fitted and calibrated tree over ``packed`` (columns ``id`` and ``vec``, from :func:`vectors.pack`); ``some``: a
    sample of it."""

    def __init__(self, packed: DataFrame, some: pa.Table, k: int, dim: int = vectors.DIM, recall: float = RECALL, seed: int = 11) -> None:
        self.packed, self.k, self.dim, self.recall = packed, k, dim, recall
        ids, pick = np.unique(some.column("id").to_numpy(), return_index=True)
        sample = vectors.unit(vectors.from_binary(some.column("vec"), dim)[pick]) if len(ids) else np.empty((0, dim))
        order = np.random.default_rng(seed).permutation(len(ids))
        apart = order[: min(CALIBRATION, len(ids) // 4)]  # not used for the tree, so that recall is not overrated
        self.tree = Tree(sample[order[len(apart) :]], seed)
        truth = self._calibrate(ids[apart], sample[apart])
        self.deep = self.rows_in > tree_of.DEEP_ROWS
        self.cells = self.visits
        if self.deep.any():
            self.below = self._below(seed)
            self._calibrate_below(sample[apart], truth)

    def _calibrate(self, ids: np.ndarray, queries: np.ndarray) -> pa.Table:
        """Sets ``rows_in`` (rows of each leaf) and ``visits``; one pass over all rows. Returns the exact answers."""
        tree, k, dim = self.tree, self.k, self.dim
        names = ["q", "id", "leaf", "sim", "n", "vec"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros(tree.leaves, np.int64)
            q32 = queries.astype(np.float32)
            parts, floor = [], np.full(len(ids), -2, np.float32)  # less is no answer any more
            for batch in batches:
                raw = vectors.from_binary(batch.column(1), dim)
                x = vectors.unit(raw, np.float32)
                leaf = tree.assign(x)
                count += np.bincount(leaf, minlength=tree.leaves)
                own = batch.column(0).to_numpy()
                sims = q32 @ x.T
                r, c = best(sims, own, k + 1) if not parts else np.nonzero(sims >= floor[:, None])
                other = own[c] != ids[r]
                r, c = r[other], c[other]
                parts.append((r, own[c], leaf[c], sims[r, c].astype(np.float64), raw[c]))
                if len(parts) == 1 or sum(len(p[0]) for p in parts) > 20 * k * max(len(ids), 1):
                    parts = [_keep(parts, k)]
                    full = np.flatnonzero(np.bincount(parts[0][0], minlength=len(ids)) == k)
                    floor[full] = parts[0][3][np.searchsorted(parts[0][0], full, "right") - 1]
            if parts:
                r, own, leaf, sim, raw = _keep(parts, k)
                yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(own), pa.array(leaf), pa.array(sim), pa.array(np.ones(len(r), np.int64)), vectors.to_binary(raw)], names)
                full = np.flatnonzero(count)
                none = np.full(len(full), -1)
                yield pa.RecordBatch.from_arrays([pa.array(none), pa.array(none), pa.array(full), pa.array(np.zeros(len(full))), pa.array(count[full]), pa.nulls(len(full), pa.binary())], names)

        seen = self.packed.mapInArrow(run, "q bigint, id bigint, leaf bigint, sim double, n bigint, vec binary")
        once = seen.groupBy("q", "id", "leaf", "vec").agg(F.max("sim").alias("sim"), F.sum("n").alias("n"))
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "id"))
        # at most CALIBRATION * k answers and MAX_LEAVES counts reach the driver
        found = once.withColumn("rank", rank).where((F.col("rank") <= k) | (F.col("q") < 0)).select("q", "leaf", "n", "vec").toArrow()
        q, leaf, n = (found.column(c).to_numpy() for c in ("q", "leaf", "n"))
        self.rows_in = np.zeros(tree.leaves, np.int64)
        self.rows_in[leaf[q < 0]] = n[q < 0]
        truth = found.filter(pa.array(q >= 0))
        q, leaf = q[q >= 0], leaf[q >= 0]
        place, most = np.full(len(q), -1), 128
        while (left := np.flatnonzero(place < 0)).size:
            of, inverse = np.unique(q[left], return_inverse=True)
            hit = tree.visit(queries[of], most)[0][inverse] == leaf[left][:, None]
            place[left] = np.where(hit.any(1), hit.argmax(1), -1)
            most *= 4
        self.visits = max(min(4, tree.leaves), self._needed(place))
        return truth

    def _needed(self, rank: np.ndarray) -> int:
        """How many must be visited so that the share ``recall`` of answers with these ranks is found."""
        return int(np.sort(rank)[max(0, min(len(rank), int(np.ceil(self.recall * len(rank)))) - 1)]) + 1 if len(rank) else 1

    def _below(self, seed: int) -> DataFrame:
        """``(leaf, tree)``: for each leaf that holds too many rows a tree of its own, fitted in a task on a bounded sample."""
        tree, dim, deep = self.tree, self.dim, self.deep
        share = np.array([min(1.0, sample_size(int(n)) / max(n, 1)) for n in self.rows_in])

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chance = (vectors.mixed(batch.column(0).to_numpy()) >> np.uint64(11)).astype(np.float64) / (1 << 53)
                x = vectors.unit(vectors.from_binary(batch.column(1), dim), np.float32)
                leaf = tree.assign(x)
                at = pa.array(np.flatnonzero(deep[leaf] & (chance < share[leaf])))
                yield pa.RecordBatch.from_arrays([pa.array(leaf).take(at), batch.column(0).take(at), vectors.to_binary(x).take(at)], ["leaf", "id", "vec"])

        def fit(rows: pa.Table) -> pa.Table:
            _, pick = np.unique(rows.column("id").to_numpy(), return_index=True)
            own = Tree(vectors.from_binary(rows.column("vec"), dim)[pick], seed)
            return pa.table([rows.column("leaf").slice(0, 1), pa.array([pickle.dumps(own)])], ["leaf", "tree"])

        return cut(self.packed.mapInArrow(some, "leaf bigint, id bigint, vec binary").groupBy("leaf").applyInArrow(fit, "leaf bigint, tree binary"), "trees")

    def _with_trees(self, df: DataFrame, salts: np.ndarray, work: Callable[[pa.Table, Tree], pa.Table], schema: str) -> DataFrame:
        """``work`` on the rows of each deep leaf (columns ``leaf`` and ``id`` or ``q`` first), spread over ``salts`` tasks a leaf, with the tree of the leaf."""
        spark = df.sparkSession
        key = df.columns[1]
        wide = spark.createDataFrame([(int(i), int(salts[i])) for i in np.flatnonzero(self.deep)], "leaf bigint, salts bigint")  # MAX_LEAVES rows at most
        copies = self.below.join(F.broadcast(wide), "leaf").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))).select("leaf", "salt", "tree")
        salted = df.join(F.broadcast(wide), "leaf").withColumn("salt", F.pmod(F.xxhash64(key), F.col("salts"))).drop("salts")
        none = to_arrow_schema(spark.createDataFrame([], schema).schema).empty_table()

        def both(rows: pa.Table, own: pa.Table) -> pa.Table:
            return work(rows, pickle.loads(own.column("tree")[0].as_py())) if rows.num_rows and own.num_rows else none

        return salted.groupBy("leaf", "salt").cogroup(copies.groupBy("leaf", "salt")).applyInArrow(both, schema)

    def _calibrate_below(self, queries: np.ndarray, truth: pa.Table) -> None:
        """Sets ``cells``: of the lowest leaves below all leaves visited, how many are visited, the nearest first."""
        spark, tree, dim, deep = self.packed.sparkSession, self.tree, self.dim, self.deep
        leaves, paid = tree.visit(queries, self.visits)
        q, leaf = truth.column("q").to_numpy(), truth.column("leaf").to_numpy()
        reached = (leaves[q] == leaf[:, None]).any(1)
        q, leaf, vec = q[reached], leaf[reached], vectors.from_binary(truth.column("vec"), dim)[reached]
        cost = np.where(deep[leaf], np.inf, (paid[q] + np.where(leaves[q] == leaf[:, None], 0, np.inf)).min(1))

        def price(rows: pa.Table, own: Tree) -> pa.Table:
            x = vectors.unit(vectors.from_binary(rows.column("vec"), dim), np.float32)
            c = own.leaf_centres()[own.assign(x)].astype(np.float64)
            of = queries[rows.column("q").to_numpy()]
            return pa.table([rows.column("i"), pa.array(0.5 * (c**2).sum(1) - np.einsum("ij,ij->i", c, of))], ["i", "cost"])

        one = np.ones(len(deep), np.int64)
        at = np.flatnonzero(deep[leaf])
        asked = pa.table([pa.array(leaf[at]), pa.array(q[at]), pa.array(at), vectors.to_binary(vec[at])], ["leaf", "q", "i", "vec"])
        got = self._with_trees(spark.createDataFrame(asked), one, price, "i bigint, cost double").toArrow()
        cost[got.column("i").to_numpy()] = got.column("cost").to_numpy()

        def nearer(rows: pa.Table, own: Tree) -> pa.Table:
            c = own.leaf_centres().astype(np.float64)
            mine = rows.column("q").to_numpy()
            all_costs = 0.5 * (c**2).sum(1) - queries[mine] @ c.T
            i = [np.flatnonzero(q == m) for m in mine]
            n = [(all_costs[j][None, :] < cost[k][:, None] - 1e-12).sum(1) for j, k in enumerate(i)]
            return pa.table([pa.array(np.concatenate([np.empty(0, np.int64), *i])), pa.array(np.concatenate([np.empty(0, np.int64), *n]))], ["i", "n"])

        r, c = np.nonzero((leaves >= 0) & deep[np.maximum(leaves, 0)])
        pairs = pa.table([pa.array(leaves[r, c]), pa.array(r)], ["leaf", "q"])
        rank = ((paid[q] < cost[:, None]) & ~deep[np.maximum(leaves[q], 0)] & (leaves[q] >= 0)).sum(1)
        more = self._with_trees(spark.createDataFrame(pairs), one, nearer, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
        np.add.at(rank, more.column("i").to_numpy(), more.column("n").to_numpy())
        self.cells = max(8, self._needed(rank))

    def _placed(self) -> DataFrame:
        """``(leaf, id, vec)`` of all rows; of equal vectors a batch keeps the first k + 1 ids, as no query has more as answers."""
        tree, k, dim = self.tree, self.k, self.dim

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hot: list[pa.RecordBatch] = []
            for batch in batches:
                raw = np.asarray(vectors.from_binary(batch.column(1), dim))
                order, rank = _copies(raw, batch.column(0).to_numpy())
                often = np.zeros(len(raw), bool)  # vectors with more copies than can be answers wait for the rest of the task
                groups = np.cumsum(rank == 0) - 1
                often[order] = (np.bincount(groups) > k)[groups] if len(order) else False
                order = order[rank <= k]
                hot.append(batch.take(pa.array(order[often[order]])))
                order = order[~often[order]]
                if sum(h.num_rows for h in hot) > HOT_ROWS:
                    hot = [_few(hot, k, dim)]
                    if hot[0].num_rows > HOT_ROWS // 2:
                        yield from leaves(hot.pop())
                yield from leaves(batch.take(pa.array(order)) if len(order) < batch.num_rows else batch)
            if hot:
                yield from leaves(_few(hot, k, dim))

        def leaves(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows:
                leaf = tree.assign(vectors.unit(vectors.from_binary(batch.column(1), dim), np.float32))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "id", "vec"])

        return self.packed.mapInArrow(place, "leaf bigint, id bigint, vec binary")

    def _asked(self, queries: DataFrame) -> DataFrame:
        """``(leaf, id, cost, vec)``: each query with the leaves that it visits."""
        tree, dim, visits = self.tree, self.dim, self.visits

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for a in range(0, whole.num_rows, 512):
                    batch = whole.slice(a, 512)
                    found, paid = tree.visit(vectors.unit(vectors.from_binary(batch.column(1), dim), np.float32), visits)
                    row, column = np.nonzero(found >= 0)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays([pa.array(found[row, column]), batch.column(0).take(at), pa.array(paid[row, column]), batch.column(1).take(at)], ["leaf", "id", "cost", "vec"])

        return queries.mapInArrow(ask, "leaf bigint, id bigint, cost float, vec binary")

    def _salts(self, queries: DataFrame) -> np.ndarray:
        """Into how many tasks the visitors of each leaf are split, from a sixteenth of the queries."""
        tree, dim, visits = self.tree, self.dim, self.visits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros(tree.leaves, np.int64)
            for whole in batches:
                for a in range(0, whole.num_rows, 512):
                    found, _ = tree.visit(vectors.unit(vectors.from_binary(whole.column(0).slice(a, 512), dim), np.float32), visits)
                    count += np.bincount(found[found >= 0], minlength=tree.leaves)
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["leaf", "n"])

        few = queries.where(F.pmod(F.xxhash64("id"), F.lit(16)) == 0).select("vec")
        # at most one number for each leaf
        found = few.mapInArrow(run, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n")).toArrow()
        n = np.zeros(tree.leaves, np.int64)
        n[found.column("leaf").to_numpy()] = found.column("n").to_numpy()
        return np.maximum(1, -(-16 * n // VISITORS))

    def answers(self, queries: DataFrame) -> DataFrame:
        """``(id, other, rank, similarity)`` for ``queries`` (columns ``id`` and ``vec``), ``rank`` from 1 to ``k``."""
        k, dim = self.k, self.dim
        queries = cut(queries.select("id", "vec").dropDuplicates(["id"]), "queries")
        rows, asked, salts = self._placed(), self._asked(queries), self._salts(queries)
        if self.deep.any():
            rows, asked = self._lowest(rows, asked, queries, salts)
        else:
            rows, asked = rows.withColumn("part", F.lit(0).cast("bigint")), asked.select("leaf", F.lit(0).cast("bigint").alias("part"), "id", "vec")

        def compare(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
            ids, pick = np.unique(rows.column("id").to_numpy(), return_index=True)
            x = vectors.unit(vectors.from_binary(rows.column("vec"), dim)[pick]) if len(ids) else np.empty((0, dim))
            q, y = asked.column("id").to_numpy(), asked.column("vec")
            out = []
            for a in range(0, len(q) if len(ids) else 0, 1024):
                own = q[a : a + 1024]
                at = vectors.unit(vectors.from_binary(y.slice(a, 1024), dim))
                for b in range(0, len(ids), 16_384):
                    sims = at @ x[b : b + 16_384].T
                    sims[own[:, None] == ids[None, b : b + 16_384]] = -np.inf
                    r, c = best(sims, ids[b : b + 16_384], k)
                    out.append((own[r], ids[b + c], sims[r, c]))
            a, b, s = (np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            return pa.table([pa.array(a), pa.array(b), pa.array(s)], ["id", "other", "similarity"])

        keys = ["leaf", "part"]
        if (salts > 1).any():
            wide = queries.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(salts)], "leaf bigint, salts bigint")  # MAX_LEAVES rows at most
            keys = [*keys, "salt"]
            rows = rows.join(F.broadcast(wide), "leaf").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))).drop("salts")
            asked = asked.join(F.broadcast(wide), "leaf").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts"))).drop("salts")
        near = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(compare, "id bigint, other bigint, similarity double")
        rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))
        return near.withColumn("rank", rank).where(F.col("rank") <= k).select("id", "other", "rank", "similarity")

    def _lowest(self, rows: DataFrame, asked: DataFrame, queries: DataFrame, salts: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """Rows and visits by lowest leaf, ``part`` being its number below ``leaf``: of all that lie below the leaves visited
        a query visits the ``cells`` nearest."""
        dim, cells, deep = self.dim, self.cells, F.col("leaf").isin([int(i) for i in np.flatnonzero(self.deep)]) if self.deep.sum() < 1000 else F.lit(True)

        def put(data: pa.Table, own: Tree) -> pa.Table:
            part = own.assign(vectors.unit(vectors.from_binary(data.column("vec"), dim), np.float32))
            return pa.table([data.column("leaf"), pa.array(part), data.column("id"), data.column("vec")], ["leaf", "part", "id", "vec"])

        def rank(data: pa.Table, own: Tree) -> pa.Table:
            centre = own.leaf_centres()
            half = 0.5 * (centre.astype(np.float64) ** 2).sum(1)
            most = min(cells, len(centre))
            ids, leaf, out = data.column("id").to_numpy(), data.column("leaf")[0].as_py(), []
            for a in range(0, data.num_rows, 1024):
                cost = half - vectors.unit(vectors.from_binary(data.column("vec").slice(a, 1024), dim)) @ centre.T
                part = np.argpartition(cost, most - 1, axis=1)[:, :most]
                out.append((np.repeat(ids[a : a + 1024], most), part.ravel(), np.take_along_axis(cost, part, 1).ravel()))
            i, part, cost = (np.concatenate(z) for z in zip(*out, strict=True))
            return pa.table([pa.array(np.full(len(i), leaf)), pa.array(part), pa.array(i), pa.array(cost.astype(np.float32))], ["leaf", "part", "id", "cost"])

        spread = np.maximum(1, -(-self.rows_in // HOT_ROWS))
        wide = rows.sparkSession.createDataFrame([(int(i),) for i in np.flatnonzero(~self.deep)], "leaf bigint")  # MAX_LEAVES rows at most
        flat = lambda df: df.join(F.broadcast(wide), "leaf", "left_semi").withColumn("part", F.lit(0).cast("bigint"))
        low = self._with_trees(rows.where(deep), spread, put, "leaf bigint, part bigint, id bigint, vec binary").unionByName(flat(rows).select("leaf", "part", "id", "vec"))
        seen = self._with_trees(asked.where(deep), salts, rank, "leaf bigint, part bigint, id bigint, cost float").unionByName(flat(asked).select("leaf", "part", "id", "cost"))
        first = F.row_number().over(Window.partitionBy("id").orderBy("cost", "leaf", "part"))
        return low, seen.withColumn("rank", first).where(F.col("rank") <= cells).select("leaf", "part", "id").join(queries, "id").select("leaf", "part", "id", "vec")


def _copies(raw: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows, those that repeat vector and id once, with equal vectors together in order of ids; and the place of each among
    its equals."""
    order = np.lexsort((ids, vectors.mixed_rows(raw)))
    held = raw[order].view(np.uint64)
    same = vectors.changes(*held.T)
    order = order[same | vectors.changes(ids[order])]
    new = vectors.changes(*raw[order].view(np.uint64).T)
    return order, np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.empty(0, np.int64)


def _few(batches: list[pa.RecordBatch], k: int, dim: int) -> pa.RecordBatch:
    """Of equal vectors among ``batches`` those with the first k + 1 ids."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    order, rank = _copies(np.ascontiguousarray(vectors.from_binary(rows.column("vec"), dim)), rows.column("id").to_numpy())
    taken = rows.take(pa.array(order[rank <= k])).combine_chunks()
    return taken.to_batches()[0] if taken.num_rows else batches[0].slice(0, 0)


def _keep(parts: list[tuple], k: int) -> tuple:
    """The ``k`` best answers of each query among ``parts``; an id that repeats counts once."""
    r, own, leaf, sim, raw = (np.concatenate(z) for z in zip(*parts, strict=True))
    order = np.lexsort((own, -sim, r))
    order = order[vectors.changes(r[order], own[order])]  # the same id has the same similarity, so copies stand together
    order = order[np.arange(len(order)) - np.searchsorted(r[order], r[order]) < k]
    return r[order], own[order], leaf[order], sim[order], raw[order]


def most_similar(df: DataFrame, queries: DataFrame | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = vectors.DIM, recall: float = RECALL) -> DataFrame:
    """``(id, other, rank, similarity)`` for every usable vector of ``df``, or for those whose ids are in ``queries``."""
    narrow = df.select(F.col(id_col).cast("bigint").alias("id"), vector_col)
    packed = vectors.pack(narrow, ["id"], vector_col, dim)
    rows = df.count()
    some = vectors.pack(narrow.sample(min(1.0, sample_size(rows) / max(rows, 1)), 11), ["id"], vector_col, dim)
    search = Search(packed, some.toArrow(), k, dim, recall)  # a bounded sample, see sample_size
    asked = packed
    if queries is not None:
        ids = queries.select(F.col(id_col).cast("bigint").alias("id")).dropna()
        if ids.limit(FEW_QUERIES + 1).count() <= FEW_QUERIES:
            asked = vectors.pack(narrow.join(F.broadcast(ids.distinct()), "id", "left_semi"), ["id"], vector_col, dim)
        else:
            asked = vectors.pack(narrow, ["id"], vector_col, dim, vectors.Bloom(ids, ["id"])).join(ids, "id", "left_semi")
    return search.answers(asked)

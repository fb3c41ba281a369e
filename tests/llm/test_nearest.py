"""Most similar vectors against brute force."""

import heapq

import numpy as np
import pytest

from reelspark.llm import nearest, tree, vectors
from reelspark.llm.tree import Tree


def made(n, seed=0, groups=40):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, 64))
    return centre[r.integers(groups, size=n) * (r.random(n) > 0.3)] + 0.5 * r.normal(size=(n, 64))


def brute(x, ids, k):
    x = vectors.unit(x)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    return {int(ids[i]): [int(ids[j]) for j in np.lexsort((ids, -s[i]))[:k] if j != i] for i in range(len(x))}


def test_usable_and_round_trip():
    import pyarrow as pa

    column = pa.array([None, [1.0, 2.0], [0.0, 0.0], [1.0, float("nan")], [1.0, None], [1.0, 2.0, 3.0], [3.0, -1.0], [float("inf"), 1.0]], pa.list_(pa.float32()))
    at, rows = vectors.usable(column, 2)
    assert at.tolist() == [1, 6] and rows.tolist() == [[1, 2], [3, -1]]
    assert vectors.from_binary(vectors.to_binary(rows), 2).tolist() == rows.tolist()
    assert vectors.from_binary(vectors.to_binary(rows).slice(1), 2).tolist() == [[3, -1]]
    assert np.allclose(np.linalg.norm(vectors.unit(np.array([[1e-30, 1e-30], [1e30, 3e30]], np.float32)), axis=1), 1)


def test_tree_visits_every_leaf_once():
    x = vectors.unit(made(2000)).astype(np.float32)
    tree = Tree(x)
    found, cost = tree.visit(x[:3], 10**6)
    assert all(sorted(f) == list(range(tree.leaves)) for f in found.tolist()) and tree.leaves > 20
    assert np.isfinite(cost).all()
    plain = []
    for v in x[:40]:  # one queue, one vector
        queue, out = [(0.0, 0)], []
        while len(out) < 7:
            node = heapq.heappop(queue)[1]
            if tree.first[node] == tree.last[node]:
                out.append(int(tree.leaf[node]))
            for child in range(tree.first[node], tree.last[node]):
                heapq.heappush(queue, (float(tree.half[child] - v @ tree.centre[child]), child))
        plain.append(out)
    assert (tree.visit(x[:40], 7)[0] == plain).mean() > 0.99
    assert set(tree.assign(x)) <= set(range(tree.leaves))


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_recall(spark, n):
    x = made(n).astype(np.float32)
    rows = [(i * 3, [float(v) for v in x[i]], "a") for i in range(n)]
    dirt = [(100001, None, "a"), (100004, [0.0] * 64, "a"), (100007, [1.0] * 63, "b"), (None, [1.0] * 64, "c")]
    df = spark.createDataFrame(rows + rows[: n // 3] + dirt, "vec_id long, embedding array<float>, id string")
    got = {}
    for r in nearest.most_similar(df).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.other)
    want = brute(x, np.arange(n) * 3, 10)
    found = sum(len(set(got.get(i, ())) & set(v)) for i, v in want.items())
    assert set(got) == {i for i, v in want.items() if v}
    assert all(len(set(v)) == len(v) and i not in v for i, v in got.items())
    assert found >= 0.9 * sum(len(v) for v in want.values())
    if n < 100:
        assert got == {i: v for i, v in want.items() if v}


def test_hot_copies(spark):
    x = made(400, 3).astype(np.float32)
    rows = [(i, [float(v) for v in x[0 if i < 200 else i]]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    asked = spark.createDataFrame([(0,), (150,), (300,), (777,)], "vec_id long")
    got = {}
    for r in nearest.most_similar(df, asked, k=5).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.other)
    assert got[0] == [1, 2, 3, 4, 5] and got[150] == [0, 1, 2, 3, 4] and len(got[300]) == 5 and 777 not in got


def test_leaves_stay_small_at_any_size():
    assert all(300 < tree.rows_of_lowest_leaf(10**k) < 700 for k in range(6, 11))


def test_trees_below_leaves(spark, monkeypatch):
    """The state of a table of thousands of millions of rows: few leaves on the driver, trees below them in tasks."""
    monkeypatch.setattr(tree, "MAX_LEAVES", 6)
    monkeypatch.setattr(tree, "DEEP_ROWS", 300)
    monkeypatch.setattr(nearest, "VISITORS", 256)
    x = made(4000, 7).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(4000)], "vec_id long, embedding array<float>").repartition(4)
    packed = vectors.pack(df.withColumnRenamed("vec_id", "id"), ["id"])
    search = nearest.Search(packed, packed.sample(0.05, 3).toArrow(), 10)
    assert search.deep.any() and search.below.count() == search.deep.sum() and (search._salts(packed) > 1).any()
    got = {}
    for r in search.answers(packed.where("id % 7 = 0")).collect():
        got.setdefault(r.id, []).append(r.other)
    want = brute(x, np.arange(4000), 10)
    assert set(got) == {i for i in range(4000) if i % 7 == 0}
    assert sum(len(set(v) & set(want[i])) for i, v in got.items()) >= 0.9 * 10 * len(got)


def test_filter_of_keys_lets_all_keys_pass(spark):
    df = spark.range(20000).selectExpr("concat('v', id % 7) as video_id", "id as frame_idx", "xxhash64(concat('v', id % 7), id) as h")
    bloom = vectors.Bloom(df.where("frame_idx % 10 = 0"), ["video_id", "frame_idx"])
    rows = df.toPandas()
    passed = bloom.passes(rows.h.to_numpy())
    assert passed[rows.frame_idx % 10 == 0].all() and passed.mean() < 0.16


def test_sent_keeps_the_first_of_each_key():
    import pyarrow as pa

    sent = vectors.Sent()
    a = [pa.array(["x", "x", "y", "x"]), pa.array([1, 2, 1, 1])]
    assert sent.new(a).tolist() == [0, 1, 2] and sent.new(a).tolist() == []
    assert sent.new([pa.array(["y", "z"]), pa.array([2, -5])]).tolist() == [0, 1]
    assert vectors.Sent().new([pa.array([5, -1, 5])]).tolist() == [0, 1]

"""The varied subset: exact size, coverage, and Ward linkage against a plain version."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelspark.llm import variety, vectors


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = min(((len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


def test_ward_equals_plain():
    r = np.random.default_rng(0)
    for n, k in ((1, 1), (5, 2), (40, 7), (40, 39), (30, 1)):
        x = r.normal(size=(n, 3))
        got = variety.ward(x, k)
        assert {frozenset(np.flatnonzero(got == g)) for g in set(got)} == plain_ward(x, k)


def test_shares():
    assert variety.shares(10, np.array([1.0, 1, 2]), np.array([9, 1, 9])).tolist() == [3, 1, 6]
    assert variety.shares(99, np.array([1.0, 1]), np.array([2, 3])).tolist() == [2, 3]
    assert variety.shares(1, np.ones(3), np.ones(3)).sum() == 1


def test_features_keep_sums():
    x = np.random.default_rng(1).normal(size=(500, 4))
    f = variety.Features.of(x).bounded(30)
    assert len(f.n) == 30 and f.n.sum() == 500 and np.allclose(f.total.sum(0), x.sum(0)) and np.isclose(f.squares.sum(), (x**2).sum())
    assert len(variety.Features.of(np.ones((50, 4))).bounded(10).n) == 1


@pytest.mark.parametrize("small", [False, True])
def test_chosen(spark, monkeypatch, small):
    if small:
        for name, value in (("ENTRIES", 40), ("FINAL", 12), ("CELL", 6), ("SPREAD", 60)):
            monkeypatch.setattr(variety, name, value)
    r = np.random.default_rng(2)
    centre = r.normal(size=(12, 8)) * 3
    frames, keys = [], []
    for i in range(900):
        v = "K00_a" if i < 500 else "K01_b" if i < 700 else "K02_c" if i < 720 else "K03_d"
        near = 0 if r.random() < 0.7 else int(r.integers(12))
        x = centre[near] + 0.2 * r.normal(size=8)
        if v == "K03_d":
            x = centre[1]
        frames.append((v, i, None if i % 50 == 49 else [float(z) for z in x], near))
        keys.append((v, i))
    fr = spark.createDataFrame(frames + frames[:60], "video_id string, frame_idx int, embedding array<float>, label int")
    kf = spark.createDataFrame(keys + keys[:99] + [("K00_a", 5000), (None, 1), ("K00_a", None)], "video_id string, frame_idx bigint").repartition(3)
    ask = spark.createDataFrame([("K00", 30), ("K01", 12), ("K02", 99), ("K03", 15), ("K09", 5), ("K04", None), (None, 3)], "group string, wanted int")
    records = variety.records_of(kf, fr, dim=8).withColumn("group", F.substring("video_id", 1, 3))
    got = [tuple(x) for x in variety.choose(records, ask, dim=8).collect()]
    count = {g: sum(x[0] == g for x in got) for g in ("K00", "K01", "K02", "K03", "K09")}
    assert len(set(got)) == len(got) and count == {"K00": 30, "K01": 12, "K02": 20, "K03": 15, "K09": 0}
    kind = {f[1]: f[3] for f in frames}
    assert all(f % 50 != 49 for _, _, f in got)
    assert len({kind[f] for g, _, f in got if g == "K00"}) == 12  # every kind of record, rare ones too
    if not small:
        assert len({kind[f] for g, _, f in got if g == "K01"}) >= 10
    assert variety.choose(records.limit(0), ask, dim=8).count() == 0 and variety.choose(records, ask.limit(0), dim=8).count() == 0


def test_tree_keeps_sums_and_bounds():
    r = np.random.default_rng(4)
    centre = r.normal(size=(30, 8)) * 4
    x = centre[r.integers(30, size=6000)] + 0.1 * r.normal(size=(6000, 8))
    tree = variety.Tree(100, variety.Features.of(x[:100]))
    for a in range(100, 6000, 100):
        tree.put(variety.Features.of(x[a : a + 100]))
        assert len(tree.entries.n) <= 200 and len(tree.node) == len(tree.entries.n)
    f = tree.entries
    assert f.n.sum() == 6000 and np.allclose(f.total.sum(0), x.sum(0)) and np.isclose(f.squares.sum(), (x**2).sum())
    assert 0 < tree.threshold < 0.2 and np.quantile(f.radius(), 0.9) <= tree.threshold and f.radius().max() < 0.4
    near = np.linalg.norm(f.centres()[:, None] - centre, axis=2).min(0)
    assert (near < 0.5).all()  # every place has entries


def covered(x, chosen):
    """Mean and largest distance of the rows of ``x`` from the nearest chosen one."""
    d = np.sqrt(np.maximum(0, 2 - 2 * (x @ x[chosen].T).max(1)))
    return d.mean(), d.max()


def test_covers_more_than_chance_whatever_the_partitioning(spark):
    r = np.random.default_rng(9)
    centre = r.normal(size=(60, 16))
    kind = np.where(r.random(3000) < 0.6, 0, r.integers(60, size=3000))  # one scene in more than half of the records
    x = vectors.unit(centre[kind] + 0.25 * r.normal(size=(3000, 16)))
    rows = [("g", "v", i, v.astype(np.float32).tobytes()) for i, v in enumerate(x)]
    records = spark.createDataFrame(rows, "group string, video_id string, frame_idx bigint, vec binary")
    ask = spark.createDataFrame([("g", 120)], "group string, wanted int")
    got = [sorted(c.frame_idx for c in variety.choose(records.repartition(n), ask, dim=16).collect()) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 120
    chance = [covered(x, r.choice(3000, 120, replace=False)) for _ in range(5)]
    mean, most = covered(x, got[0])
    assert most < min(c[1] for c in chance) and mean < 0.9 * np.mean([c[0] for c in chance])
    assert (kind[got[0]] == 0).mean() < 0.35 and len(set(kind[got[0]])) == 60


def test_missing_records_come_from_all_labels(spark, monkeypatch):
    """A label with fewer records than wanted of it: the others give the rest alike, however frequent they are."""
    real, dirs = variety._cut, np.eye(8)[:3]

    def wanting(group, dim):
        out = real(group, dim)
        label = (vectors.from_binary(out.column("entry"), dim, np.float64) @ dirs.T).argmax(1)
        new = {"label": pa.array(label), "centre": vectors.to_binary(dirs[label]), "quota": pa.array(np.array([1, 11, 1])[label])}
        return pa.table([new.get(n, out.column(n)) for n in out.column_names], out.column_names)

    monkeypatch.setattr(variety, "_cut", wanting)
    r = np.random.default_rng(3)
    kind = [0] * 400 + [1] + [2] * 30
    x = dirs[kind] + 0.02 * r.normal(size=(len(kind), 8))
    rows = [("g", "v", i, v.astype(np.float32).tobytes()) for i, v in enumerate(x)]
    records = spark.createDataFrame(rows, "group string, video_id string, frame_idx bigint, vec binary")
    got = [c.frame_idx for c in variety.choose(records, spark.createDataFrame([("g", 13)], "group string, wanted int"), dim=8).collect()]
    assert len(set(got)) == 13 and [sum(kind[i] == k for i in got) for k in range(3)] == [6, 1, 6]
    unit = vectors.unit(x)
    for k in (0, 2):
        near = sorted((i for i in range(len(kind)) if kind[i] == k), key=lambda i: ((unit[i] - dirs[k]) ** 2).sum())
        assert set(near[:6]) <= set(got)


def test_a_task_keeps_as_many_features_as_a_merge():
    x = np.random.default_rng(5).normal(size=(900, 8)).astype(np.float32)
    rows = pa.RecordBatch.from_arrays([pa.array(["g"] * 900), pa.array([0] * 900), vectors.to_binary(x)], ["group", "salt", "vec"])
    assert sum(b.num_rows for b in variety._summary(iter([rows, rows.slice(0, 0), rows]), 8, False)) == 900

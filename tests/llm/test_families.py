"""Scene vectors and families against plain versions."""

import numpy as np
import pytest

from reelspark.llm import families, scenes, vectors
from reelspark.llm.components import components


def chains(x, least):
    root = list(range(len(x)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.where(np.triu(x @ x.T, 1) >= least)):
        a, b = sorted((top(i), top(j)))
        root[b] = a
    return [top(i) for i in range(len(x))]


def test_components(spark):
    r = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (180, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    df = spark.createDataFrame(links, "a long, b long")
    got = {x.id: x.root for x in components(df).collect()}
    assert got == {i: top(i) for i in root if top(i) != i}
    assert components(df.limit(0)).count() == 0


def test_scene_vectors(spark, monkeypatch):
    monkeypatch.setattr(scenes, "CHUNK", 16)
    r = np.random.default_rng(1)
    frames, want = {}, {}
    for v in range(3):
        for f in range(0, 120, 3):
            frames[f"v{v}", f] = [float(z) for z in r.normal(size=4)] if r.random() > 0.1 else [0.0] * 4
    rows = [(v, f, x, 1) for (v, f), x in frames.items()]
    cuts = [(k, f"v{k % 4}", int(a), int(a + d)) for k, (a, d) in enumerate(zip(r.integers(-5, 110, 40), r.integers(-3, 60, 40)))] + [(90, "v1", 0, 10**12), (91, "v1", 5, None), (None, "v1", 5, 9)]
    for k, v, a, b in cuts:
        if k is not None and b is not None:
            inside = [np.float32(x) for (w, f), x in frames.items() if w == v and a <= f <= b and any(x)]
            if inside:
                want[k] = (len(inside), vectors.unit(vectors.unit(np.array(inside)).mean(0)[None])[0])
    s = spark.createDataFrame(cuts + cuts[:9], "scene_key long, video_id string, start_frame long, end_frame long")
    f = spark.createDataFrame(rows + rows[:50], "video_id string, frame_idx int, embedding array<float>, scene_key int")
    got = {x.scene_key: (x.n_frames, np.frombuffer(x.vec, np.float32)) for x in scenes.scene_vectors(s, f, dim=4).collect()}
    assert set(got) == set(want)
    for k, (n, x) in want.items():
        assert got[k][0] == n and np.allclose(got[k][1], x, atol=1e-6)


@pytest.mark.parametrize("block", [2048, 24])
def test_families_equal_chains(spark, monkeypatch, block):
    monkeypatch.setattr(families, "BLOCK_ROWS", block)
    r = np.random.default_rng(4)
    parts = []
    for _ in range(60):
        x = r.normal(size=64)
        for _ in range(r.integers(1, 9)):
            parts.append(x)
            x = x + 0.4 * r.normal(size=64)
    hot = r.normal(size=64)
    parts += [hot + 0.08 * r.normal(size=64) for _ in range(150)] + [hot] * 20 + [hot * 1.0]
    x = vectors.unit(np.array(parts)[r.permutation(len(parts))])
    df = spark.createDataFrame([(3 * i + 1, v.astype(np.float32).tobytes()) for i, v in enumerate(x)], "id long, vec binary")
    found = families.Families(df, 0.89)
    want = {3 * i + 1: 3 * t + 1 for i, t in enumerate(chains(x, 0.89)) if t != i}
    assert {m.id: m.root for m in found.members.collect()} == want
    if block == 2048:
        size = {}
        for m in found.described(2).collect():
            size.setdefault(m.family, m.size)
        assert size == {t: 1 + list(want.values()).count(t) for t in set(want.values())}
        rows = found.clusters().toPandas()
        vec = dict(zip((3 * np.arange(len(x)) + 1).tolist(), x))
        assert set(rows.id) == set(want) | set(want.values()) and rows.id.is_unique
        assert all(want.get(r.id, r.id) == r.family == want.get(r.cluster, r.cluster) for r in rows.itertuples())
        assert rows.groupby("cluster").id.count().to_dict() == rows.set_index("cluster")["size"].to_dict()
        medoids = {f: sorted(set(g.cluster)) for f, g in rows.groupby("family")}
        for r in rows.itertuples():  # the closest medoid of the family
            sims = [float(vec[r.id] @ vec[m]) for m in medoids[r.family]]
            assert abs(r.similarity - max(sims)) < 1e-5
        assert len(rows[rows.family == rows.family.mode()[0]].cluster.unique()) < 6 and (rows.similarity > 0.7).all()


def test_shortened_products_are_bounds():
    r = np.random.default_rng(3)
    x = vectors.unit(r.normal(size=(400, 64)) + 1.0).astype(np.float32)
    basis = families.directions(x.astype(np.float64), 0.89)
    short = families.shortened(x, basis)
    assert basis.shape[1] < 64 and (short @ short.T >= x @ x.T - 1e-6).all()


def test_places():
    r = np.random.default_rng(2)
    for shape in ((0, 5), (3, 5), (16, 8), (40, 64)):
        hit = r.random(shape) < 0.1
        assert families.places(hit).tolist() == np.flatnonzero(hit).tolist()


def test_no_records(spark):
    df = spark.createDataFrame([], "id long, vec binary")
    assert families.Families(df, 0.89).members.count() == 0
    one = spark.createDataFrame([(1, np.eye(64, dtype=np.float32)[0].tobytes())], "id long, vec binary")
    found = families.Families(one, 0.89)
    assert found.members.count() == 0 and found.described().count() == 0 and found.clusters().count() == 0


def test_far_links_are_met(spark, monkeypatch):
    """Pairs just above the threshold among many records without one, in a tree of many leaves."""
    monkeypatch.setattr(families, "LEAF_ROWS", 16)
    r = np.random.default_rng(8)
    x = vectors.unit(r.normal(size=(3000, 64)))
    for i in range(0, 60, 2):
        away = r.normal(size=64)
        away -= away @ x[i] * x[i]
        x[i + 1] = 0.893 * x[i] + np.sqrt(1 - 0.893**2) * away / np.linalg.norm(away)
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "id long, vec binary")
    assert {(m.root, m.id) for m in families.Families(df, 0.89).members.collect()} == {(i, i + 1) for i in range(0, 60, 2)}


def test_stood_for_members_link_clouds(spark, monkeypatch):
    """Two dense clouds in an over-full leaf, linked only by one member of each that is very similar to its own pivot."""
    monkeypatch.setattr(families, "BLOCK_ROWS", 24)
    monkeypatch.setattr(families, "sample_size", lambda *_: 8)  # one leaf, cut into blocks
    r = np.random.default_rng(6)

    def at(degrees):
        return np.r_[np.cos(np.radians(degrees)), np.sin(np.radians(degrees)), np.zeros(62)]

    cloud = [at(d) + 0.002 * r.normal(size=64) for d in (0, 45) for _ in range(200)]
    x = vectors.unit(np.array([*cloud, at(10), at(35)])).astype(np.float32)
    ids = np.arange(1, 5000)
    last = ids[np.argsort(families.order_of(ids))[-2:]]  # of all these the last to become pivots
    ids = [*np.setdiff1d(ids, last)[:400].tolist(), *last.tolist()]
    df = spark.createDataFrame([(i, v.tobytes()) for i, v in zip(ids, x)], "id long, vec binary")
    assert {m.id: m.root for m in families.Families(df, 0.89).members.collect()} == {i: min(ids) for i in ids if i != min(ids)}

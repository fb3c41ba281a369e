"""Nearest times and the trie against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import nearest_time
from reelspark.llm.trie import Table, XFastTrie


def test_table():
    keys = np.unique(np.random.default_rng(0).integers(0, 10**6, 3000))
    t = Table(keys)
    asked = np.arange(-5, 10**6, 7)
    place = {int(k): i for i, k in enumerate(keys)}
    assert t.find(asked).tolist() == [place.get(int(a), -1) for a in asked]
    assert Table(keys[:0]).find(asked).max() == -1


def test_trie_equals_search():
    r = np.random.default_rng(1)
    pairs = np.unique(np.stack([r.integers(0, 5, 400), r.integers(0, 1 << 10, 400)]), axis=1)
    e, k = pairs
    q, x = r.integers(0, 7, 2000), r.integers(0, 1 << 10, 2000)
    at, before, behind = XFastTrie(e, k, 10).around(q, x)
    for i in range(2000):
        mine = [int(v) for v, w in zip(k, e) if w == q[i]]
        assert (k[at[i]] if at[i] >= 0 else None) == (x[i] if x[i] in mine else None)
        assert (k[before[i]] if before[i] >= 0 else None) == max((v for v in mine if v < x[i]), default=None)
        assert (k[behind[i]] if behind[i] >= 0 else None) == min((v for v in mine if v > x[i]), default=None)


@pytest.mark.parametrize("window", [512.0, 2.0, 3.7])
def test_nearest_equals_plain(spark, window):
    r = random.Random(7)
    times = lambda: r.choice([r.uniform(-20, 20), r.randint(-15, 15) / 2, 5.0 + r.random() * 1e-6, None, float("nan"), float("inf")])
    points = [(r.choice("abc"), times(), r.choice([None, *range(30)]), 1.0) for _ in range(300)] + [(None, 1.0, 1, 1.0), ("d", 100.0, 4, 1.0)]
    queries = [(r.choice("abcz"), i, times()) for i in range(400)] + [(None, 900, 1.0), ("d", 901, 101.9), ("d", 902, 102.1)]
    want = set()
    for e, i, t in queries:
        if e and t is not None and math.isfinite(t):
            near = [(abs(p - t), n) for f, p, n, _ in points if f == e and p is not None and math.isfinite(p) and n is not None]
            if near and min(near)[0] <= 2.0:
                want.add((e, i, min(near)[1], min(near)[0]))
    p = spark.createDataFrame(points, "v string, t double, number int, gap double")
    q = spark.createDataFrame(queries, "v string, i int, t double")
    found = nearest_time.nearest(q, p, "v", F.col("t"), F.col("t"), F.col("number"), ["i"], 2.0, window)
    assert {tuple(x) for x in found.collect()} == want
    for a, b in ((q.limit(0), p), (q, p.limit(0))):
        assert nearest_time.nearest(a, b, "v", F.col("t"), F.col("t"), F.col("number"), ["i"], 2.0, window).count() == 0

"""Runs against a plain loop."""

import numpy as np

from reelspark.llm import runs, vectors


def test_runs_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(runs, "CHUNK", 7)
    monkeypatch.setattr(runs, "FAN", 3)
    r = np.random.default_rng(2)
    frames, keys, want = [], [], []
    for v in range(6):
        x, seq = r.normal(size=8), []
        for i in range([1, 5, 200, 60, 0, 33][v]):
            if r.random() < 0.25:
                x = r.normal(size=8)
            y = x + 0.01 * r.normal(size=8)
            f = i * 2
            bad = r.random() < 0.1
            frames.append((f"v{v}", f, None if bad else [float(z) for z in y]))
            if r.random() < 0.8:
                keys.append((f"v{v}", f, None if f % 10 == 4 else float("nan") if f % 10 == 6 else f / 2, 5))
                if not bad:
                    seq.append((f, np.float32(y)))
        heads = [k for k in range(len(seq)) if not k or vectors.unit(seq[k][1][None])[0] @ vectors.unit(seq[k - 1][1][None])[0] < 0.98]
        for a, b in zip(heads, [*heads[1:], len(seq)]):
            lo, hi = seq[a][0], seq[b - 1][0]
            want.append((f"v{v}", lo, hi, b - a, None if {lo % 10, hi % 10} & {4, 6} else (hi - lo) / 2))
    fr = spark.createDataFrame(frames + frames[:40] + [(None, 1, [1.0] * 8), ("v1", None, [1.0] * 8)], "video_id string, frame_idx int, embedding array<float>")
    kf = spark.createDataFrame(keys + keys[:30] + [("v9", 3, 1.0, 1), (None, 3, 1.0, 1), ("v1", None, 1.0, 1)], "video_id string, frame_idx bigint, pts_time double, chunk int")
    got = sorted(tuple(x) for x in runs.collapse(kf, fr, dim=8).collect())
    assert got == sorted(want)
    assert runs.collapse(kf.limit(0), fr, dim=8).count() == 0 and runs.collapse(kf, fr.limit(0), dim=8).count() == 0

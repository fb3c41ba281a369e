"""Operators against cases worked out by hand, and against plain versions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark import backends
from reelspark.operators import catalog, keyframes, manifests, ocr, scenes, transcripts
from reelspark.streaming import incremental


def test_spoken(spark):
    rows = [("ab", None, None), ("abc", -1.2, None), ("abc", -1.21, None), ("abc", None, 0.65), ("abc", None, 0.66), ("  ab  ", None, None)]
    df = spark.createDataFrame(rows, "text string, lp double, ns double")
    assert [r[0] for r in df.select(transcripts.spoken(F.col("text"), F.col("lp"), F.col("ns"))).collect()] == [False, True, False, True, False, False]


def test_interval_join(spark):
    points = spark.createDataFrame([("v", float(i), 25 * i) for i in range(4)] + [("v", None, 7), ("v", float("nan"), 8), ("w", 1.0, 1), ("v", 300.0, 9000)], "video_id string, pts_time double, frame_idx long")
    rows = [("v", 0, 1.0, 2.0), ("v", 1, 2.5, 2.6), ("v", 2, 0.0, 0.0), ("v", 3, 3.0, 1.0), ("v", 4, None, 1.0), ("x", 0, 0.0, 9.0), ("v", 5, 2.0, 1e12), ("v", 6, float("nan"), 1.0), ("v", 7, 70.0, 400.0)]
    segments = spark.createDataFrame(rows, "video_id string, seg_no int, start double, end double").withColumn("text", F.lit("t"))
    got = {(r.video_id, r.seg_no): r.imgs for r in transcripts.interval_join(segments, points).collect()}
    assert got == {("v", 0): [25, 50], ("v", 1): [], ("v", 2): [0], ("v", 3): [], ("v", 4): [], ("x", 0): [], ("v", 5): [50, 75, 9000], ("v", 6): [], ("v", 7): [9000]}
    rows = transcripts.transcripts(transcripts.interval_join(segments, points), chunk_seconds=10.0).collect()
    assert {(r.video_id, r.chunk): len(r.segments) for r in rows} == {("v", None): 2, ("v", 0): 5, ("v", 7): 1, ("x", 0): 1}


def test_scene_ranges(spark):
    df = spark.createDataFrame([(0, 30, 40), (30, 31, 40), (-3, 5, 40), (9, 9, 40), (30, 99, 40), (30, 99, None)], "a long, b long, n long")
    got = [tuple(r) for r in df.select(*scenes.inclusive(F.col("a"), F.col("b"), F.col("n"))).collect()]
    assert got == [(0, 29), (30, 30), (0, 4), (9, 9), (30, 39), (30, 98)]


def plain_scenes(scores, threshold, least):
    out, begin = [], 0
    for i, s in enumerate(scores):
        if s is not None and s >= threshold and i - begin >= least:
            out.append((begin, i - 1))
            begin = i
    return [*out, (begin, len(scores) - 1)]


def test_detect(spark):
    r = np.random.default_rng(0)
    tables = {v: [float(x) for x in r.integers(0, 40, n)] for v, n in (("a", 200), ("b", 1), ("c", 37), ("d", 90))}
    rows = [(v, i, s) for v, x in tables.items() for i, s in enumerate(x)]
    df = spark.createDataFrame(rows, "v string, frame_idx int, score double").repartition(3)
    for least in (0, 15):
        got = {}
        for x in scenes.detect(df, "v", least=max(least, 1)).orderBy("v", "scene_id").collect():
            got.setdefault(x.v, []).append((x.start_frame, x.end_frame))
        assert got == {v: plain_scenes(x, 27, max(least, 1)) for v, x in tables.items()}
    islands = {}
    for x in scenes.islands(df, "v").orderBy("v", "scene_id").collect():
        islands.setdefault(x.v, []).append((x.start_frame, x.end_frame))
    assert islands == {v: plain_scenes(x, 27, 1) for v, x in tables.items()}
    videos = spark.createDataFrame([("a", 200), ("z", 40), ("y", 0), ("x", None)], "video_id string, frame_count long")
    none = spark.createDataFrame([("a", 0, 0, 9)], "video_id string, scene_id long, start_frame long, end_frame long")
    assert {tuple(x) for x in scenes.whole_video(none, videos).collect()} == {("a", 0, 0, 9), ("z", 0, 0, 39)}


def test_frames_of(spark):
    ranges = spark.createDataFrame([("v", 0, 5), ("v", 4, 10**12), ("v", 9, 3), ("w", 0, 9), ("v", -4, 1)], "video_id string, start_frame long, end_frame long")
    frames = spark.createDataFrame([("v", i) for i in range(0, 12, 2)], "video_id string, frame_idx int")
    got = sorted((r.start_frame, r.frame_idx) for r in scenes.frames_of(ranges, frames, chunk=4).collect())
    assert got == sorted([(0, 0), (0, 2), (0, 4), (4, 4), (4, 6), (4, 8), (4, 10), (-4, 0)])


def plain_select(x):
    """The clustering as it is defined, step by step."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    groups, best, chosen = [[i] for i in range(n)], -np.inf, [[i] for i in range(n)]
    while len(groups) > 2:
        near = [d[np.ix_(a, b)].mean() for a, b in zip(groups, groups[1:])]
        k = min(range(len(near)), key=lambda i: (round(near[i], 12), i))
        groups = [*groups[:k], groups[k] + groups[k + 1], *groups[k + 2 :]]
        if len(groups) <= int(np.sqrt(n)) + 1:
            s = []
            for g in groups:
                for i in g:
                    a = d[i, [j for j in g if j != i]].mean() if len(g) > 1 else None
                    b = min(d[i, h].mean() for h in groups if h is not g)
                    s.append(0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
            if np.mean(s) > best + 1e-12:
                best, chosen = np.mean(s), list(groups)
    return [g[keyframes.nearest_to_mean(x[g])] for g in chosen]


def test_clustering():
    assert keyframes.select_in_scene(np.array([[0], [0.1], [0.2], [10], [10.1], [10.2]])) == [1, 4]
    assert keyframes.select_in_scene(np.ones((5, 2))) == [0, 3, 4]
    assert len(keyframes.select_in_scene(np.random.default_rng(0).normal(size=(4, 3)))) == 1
    assert len(keyframes.select_in_scene(np.random.default_rng(0).normal(size=(513, 3)))) == 3
    assert keyframes.select_in_scene(np.empty((0, 3))) == []
    r = np.random.default_rng(1)
    for n in (5, 8, 17, 40):
        x = np.cumsum(r.normal(size=(n, 4)) * (r.random((n, 1)) < 0.2) * 5 + 0.1 * r.normal(size=(n, 4)), axis=0)
        assert keyframes.select_in_scene(x) == plain_select(x)


def test_select(spark):
    r = np.random.default_rng(3)
    frames = [("v", i, [float(z) for z in r.normal(size=4)]) for i in range(700)] + [("v", 5, None), ("w", 1, [0.0] * 4)]
    f = spark.createDataFrame(frames, "video_id string, frame_idx int, embedding array<float>")
    s = spark.createDataFrame([("v", 0, 29), ("v", 30, 33), ("v", 100, 699), ("v", 40, 35), ("w", 0, 5), ("z", 0, 5), (None, 0, 1)], "video_id string, start_frame long, end_frame long")
    got = [x.frame_idx for x in keyframes.select(s, f, dim=4).orderBy("frame_idx").collect()]
    x = np.array([v[2] for v in frames[:700]], np.float32).astype(float)
    want = keyframes.select_in_scene(x[:30]) + [30 + keyframes.nearest_to_mean(x[30:34])] + [a + keyframes.nearest_to_mean(x[a : min(a + 256, 700)]) for a in (100, 356, 612)]
    assert got == sorted(want)


def test_time_map(spark):
    k = spark.createDataFrame([("v", 50), ("v", 0), ("v", 50), ("w", 3)], "video_id string, frame_idx long")
    rates = spark.createDataFrame([("v", 25.0), ("w", 0.0)], "video_id string, fps double")
    got = sorted(tuple(x) for x in keyframes.time_map(k, rates).collect())
    assert got == [("v", 0, "000000.webp", 0.0, 25.0, 0), ("v", 1, "000001.webp", 2.0, 25.0, 50), ("w", 0, "000000.webp", None, 0.0, 3)]
    unknown = keyframes.time_map(k, rates.where("video_id = 'v'")).where("video_id = 'w'").first()
    assert (unknown.pts_time, unknown.fps, unknown.frame_idx) == (None, 0.0, 3)  # a video without a probe keeps its keyframes


def test_places_of_a_long_video(spark):
    r = np.random.default_rng(4)
    rows = [("hot", int(i)) for i in r.choice(100_000, 3000, replace=False)] + [("cold", i) for i in (5, 3, 99)]
    df = spark.createDataFrame(rows, "v string, i long").repartition(5)
    got = catalog.ranked(df, "v", ["i"], F.floor(F.col("i") / 1000), "n").collect()
    for v in ("hot", "cold"):
        assert [x.i for x in sorted((x for x in got if x.v == v), key=lambda x: x.n)] == sorted(i for w, i in rows if w == v)
        assert sorted(x.n for x in got if x.v == v) == list(range(sum(w == v for w, _ in rows)))
    everything = catalog.numbered(df, ["v", "i"]).collect()
    assert [(x.v, x.i) for x in sorted(everything, key=lambda x: x.position)] == sorted(rows) and catalog.numbered(df.limit(0), ["v"]).count() == 0


def test_cluster_labels(spark):
    x = [0.0, 0.1, 0.2, 10.0, 10.1, 10.2]
    rows = [("s", i, [v, 0.0]) for i, v in enumerate(x)] + [("t", 0, [1.0, 0.0]), ("u", 0, [1.0, 1.0]), ("u", 3, [1.0, 1.0]), ("s", 9, None), ("s", 2, [0.2, 0.0])]
    df = spark.createDataFrame(rows, "scene string, frame_idx int, embedding array<float>")
    got = {(r.scene, r.frame_idx): (r.label, r.score and round(r.score, 5), r.is_keyframe) for r in keyframes.clusters(df.where("scene <> 's' or frame_idx > 0"), "scene", dim=2).collect()}
    assert got[("t", 0)] == (0, None, True) and [got[("u", i)][0] for i in (0, 3)] == [0, 1]
    assert [got[("s", i)][0] for i in range(1, 6)] == [0, 0, 1, 1, 1] and got[("s", 4)][2] and got[("s", 1)][1] > 0.97
    assert keyframes.clusters(df.limit(0), "scene", dim=2).count() == 0


def test_planning(spark):
    df = spark.createDataFrame([(f"f{i}",) for i in range(7)], "p string").repartition(3)
    assert [r.p for r in catalog.shard(df, ["p"], 2, 0, 5).collect()] == ["f0", "f2", "f4"]
    assert [r.p for r in catalog.shard(df, ["p"], 2, 1, 5).collect()] == ["f1", "f3"]
    with pytest.raises(ValueError):
        catalog.shard(df, ["p"], 2, 2)
    two = spark.createDataFrame([(c, i) for c in "ab" for i in range(5)], "c string, i int")
    assert catalog.limit_per_group(two, "c", ["i"], 3).count() == 6
    done = spark.createDataFrame([("f1", 3), ("f2", 0)], "p string, size int")
    assert catalog.pending(df, done, ["p"], size="size").count() == 6 and catalog.pending(df, done, ["p"]).count() == 5 and catalog.pending(df, done, ["p"], True).count() == 7
    first = spark.createDataFrame([("k", 2, "x"), ("k", 1, "y"), ("j", None, "z")], "k string, seq int, v string")
    assert {tuple(r) for r in catalog.first_of_each(first, ["k"], ["seq"]).collect()} == {("k", 1, "y"), ("j", None, "z")}
    tried = spark.createDataFrame([("a", 1, "p1"), ("a", 0, "p0"), ("b", 0, "q")], "k string, priority int, path string")
    there = spark.createDataFrame([("p1",), ("p0",)], "path string")
    assert {tuple(r) for r in catalog.first_existing(tried, there, ["k"]).collect()} == {("a", "p0"), ("b", None)}
    assert {tuple(r) for r in catalog.fallback(tried.select("k").distinct(), tried.where("priority = 1"), tried.where("priority = 0"), ["k"], "path").collect()} == {("a", "p1"), ("b", "q")}
    with pytest.raises(Exception, match="too large"):
        catalog.require(two, F.col("i") < 4, "too large").collect()
    none = spark.createDataFrame([], "c string, i int")
    assert {tuple(r) for r in catalog.ratio(none, two, "c").collect()} == {("a", 0, 5, 0.0), ("b", 0, 5, 0.0)}
    assert catalog.missing(df, done, ["p"]).count() == 5


def plain_order(boxes):
    """Left, top and height of boxes in reading order, by exchanges of neighbours."""
    near = max(10.0, 0.5 * sorted(b[2] for b in boxes)[len(boxes) // 2]) if boxes else 10.0
    out = sorted(boxes, key=lambda b: (b[1], b[0]))
    for i in range(1, len(out)):
        while i and abs(out[i][1] - out[i - 1][1]) < near and out[i][0] < out[i - 1][0]:
            out[i - 1], out[i] = out[i], out[i - 1]
            i -= 1
    return [b[:2] for b in out]


def test_reading_order(spark):
    r = np.random.default_rng(5)
    pages = [[(100.0, 5.0, 20.0), (10.0, 9.0, 20.0), (50.0, 30.0, 20.0)], []] + [[tuple(float(x) for x in r.integers(1, (60, 60, 45))) for _ in range(r.integers(1, 10))] for _ in range(40)]
    assert plain_order(pages[0]) == [(10, 9), (100, 5), (50, 30)]
    rows = [(i, [([(x, y), (x + 70, y), (x + 70, y + h), (x, y + h)],) for x, y, h in p]) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "i int, b array<struct<box:array<struct<x:double,y:double>>>>")
    got = df.select("i", ocr.in_reading_order(F.col("b")).alias("b")).orderBy("i").collect()
    assert [[tuple(b.box[0]) for b in row.b] for row in got] == [plain_order(p) for p in pages]
    each = df.select("i", F.posexplode("b").alias("seq", "b")).select("i", "seq", "b.box")
    found = {row.i: [tuple(b[0]) for b in row.boxes] for row in ocr.pages(each, "i", "seq", "box", F.lit(1000), F.lit(1000), least=0.0).collect()}
    for i, p in enumerate(pages):
        if len({b[:2] for b in p}) == len(p) > 0:
            assert found[i] == plain_order(p)


def test_boxes_of():
    quad = [[0, 0], [9, 0], [9, 9], [0, 9]]
    flat = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    assert ocr.boxes_of({"res": {"dt_polys": [quad], "scores": [0.5]}}) == [(flat, 0.5)]
    assert ocr.boxes_of({"x": {"boxes": [[0, 0, 9, 9], "no"], "confidence": 0.3}}) == [(flat, 0.3)]
    assert ocr.boxes_of({"dt_polys": [], "boxes": quad, "dt_scores": [0.1, 0.2]}) == [(flat, 0.1)]
    assert ocr.boxes_of([{"a": 1}, [{"polys": [quad, quad], "scores": [0.9]}]]) == [(flat, 0.9), (flat, None)]
    assert ocr.boxes_of([quad] * 4) == [(flat, None)] * 4
    assert ocr.boxes_of(None) == ocr.boxes_of("x") == []


def test_lines(spark):
    rows = [("Abc", 0.9), ("abc", 0.95), ("x", 0.5), ("X", 0.8), ("  ", 0.9), (None, None), ("n", None)]
    df = spark.createDataFrame([(rows,)], "lines array<struct<text:string,confidence:double>>")
    got = df.select(ocr.accepted_lines(F.col("lines")).alias("a"), ocr.cleaned_lines(F.col("lines")).alias("b"), ocr.accepted_lines(F.col("lines"), dedupe=False).alias("c")).first()
    assert [x.text for x in got.a] == ["Abc", "X", "n"] and len(got.b) == 5 and [x.text for x in got.c] == ["Abc", "abc", "X", "n"]
    text = spark.createDataFrame([(1, "a\nA\n\nb "), (2, None), (3, "")], "id int, t string")
    assert [tuple(r) for r in ocr.first_lines(text, "id", "t").orderBy("id").collect()] == [(1, 3, 2, "a\nb"), (2, 0, 0, ""), (3, 0, 0, "")]


def test_usable_boxes_and_detector(spark):
    quad = [[0, 0], [9, 0], [9, 9], [0, 9]]
    raw = json.dumps({"polys": [[[50, 20], [60, 20], [60, 30], [50, 30]], quad, [[0.2, 0], [9, 0], [9, 9], [0, 9]], [[1, 1], [2, 1], [2, 2], [1, 2]]]})
    df = spark.createDataFrame([(raw,), ("{",), (None,)], "raw string").select(ocr.usable_boxes(ocr.detector_boxes("raw"), F.lit(100), F.lit(50)).alias("b"))
    got = [r[0] for r in df.select(ocr.in_reading_order(F.col("b"))).collect()]
    assert [[(p.x, p.y) for p in b.box][0] for b in got[0]] == [(0, 0), (50, 20)] and got[1] == got[2] == []
    lines = spark.createDataFrame([([1, 2],)], "x array<int>").select(ocr.recognised(F.array(*[F.struct(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))).alias("box"), F.lit(0.5).alias("det_confidence"))] * 3), F.array(*[F.struct(F.lit("t").alias("text"), F.lit(0.9).alias("confidence"))] * 2)).alias("l"))
    assert [x.line_index for x in lines.first().l] == [0, 1]
    items = lines.select(*(F.lit(c).alias(c) for c in ("group_id", "image_id", "map_id", "subfolder", "path", "original_path", "preprocessed_path")), F.lit(1.5).alias("latency_ms"), F.col("l").alias("lines"))
    record = ocr.predictions(items).first()
    assert len(record) == 15 and record.text == "t" and record.line_count == 1 and len(record.all_lines) == 2
    grouped = ocr.grouped(ocr.predictions(items), "group_id", "image_id", ["image_id", "text"]).first()
    assert json.loads(grouped.records) == [{"image_id": "image_id", "text": "t"}]
    many = spark.createDataFrame([("g", f"{i:03}.png", i) for i in range(23)] + [("h", "1", 0), ("h", "1", 1)], "group_id string, image_id string, n int").repartition(4)
    parts = ocr.grouped(many, "group_id", "image_id", ["image_id", "n"], chunk=10).orderBy("group_id", "chunk").collect()
    assert [(p.group_id, p.chunk, len(json.loads(p.records))) for p in parts] == [("g", 0, 10), ("g", 1, 10), ("g", 2, 3), ("h", 0, 2)]
    assert [x["n"] for p in parts[:3] for x in json.loads(p.records)] == list(range(23))


def test_manifests(spark):
    rows = [("a/1.webp", "yes", None, "3"), ("a/1.webp", None, "", "4"), ("b/2", "no", None, None), ("c/3.png", "maybe", " g\\h ", None), (None, None, "x", None)]
    found = manifests.items(spark.createDataFrame(rows, "path string, keep string, folder string, frame_idx string").coalesce(1))
    got = [tuple(r)[:4] for r in manifests.discover(found).collect()]
    assert got == [("a", "1", "a/1.webp", "3"), ("g/h", "3", "c/3.png", "")]
    assert manifests.discover(found, 1).count() == 1
    spots = manifests.candidates(spark.createDataFrame([("x",), ("/y.png",)], "path string"), ["m", "n/"])
    assert [r.candidate for r in spots.where("path = '/y.png'").collect()] == ["/y.png"]
    assert [r.candidate for r in spots.where("path = 'x'").orderBy("priority").limit(4).collect()] == ["m/x", "n/x", "m/x.bmp", "n/x.bmp"]
    maps = spark.createDataFrame([("v", "7"), ("v", "8.0"), ("v", " "), ("v", "k.jpg")], "video_id string, map_id string")
    listing = spark.createDataFrame([("v", "v/000007.jpg"), ("v", "v/000007.webp"), ("v", "v/7.webp"), ("v", "v/000008.png"), ("v", "v/k.png"), ("v", "v/9.txt")], "video_id string, path string")
    assert {r.map_id: r.path for r in manifests.frame_images(maps, listing).collect()} == {"7": "v/000007.webp", "8.0": "v/000008.png", "k.jpg": "v/k.png"}
    with pytest.raises(Exception, match="no image"):
        manifests.frame_images(maps, listing.where("path not like '%8%'")).collect()
    prepared = spark.createDataFrame([("a", "1", "p/1.jpg")], "group_id string, image_id string, path string")
    assert [tuple(r) for r in manifests.keyframe_manifest(found.where("map_id = '3'"), prepared).collect()] == [("a", "1", "a", "1", "3", "", "a/1.webp", "p/1.jpg")]
    with pytest.raises(Exception, match="gone"):
        manifests.strict_join(found.select("group_id", "image_id"), prepared, ["group_id", "image_id"], "gone").collect()


def test_items_below_a_root(spark):
    rows = spark.createDataFrame([("/data/kf/a/b/1.webp",), ("/else/c/2.webp",), ("d/3.webp",)], "path string").coalesce(1)
    assert [(r.group_id, r.image_id) for r in manifests.items(rows, root="/data/kf/").orderBy("seq").collect()] == [("a/b", "1"), ("c", "2"), ("d", "3")]
    assert manifests.layout_of("auto", True, True) == manifests.layout_of("auto", False, False) == "recursive" and manifests.layout_of("auto", False, True) == "kf-embedding"
    with pytest.raises(ValueError):
        manifests.layout_of("flat", False, False)
    maps = spark.createDataFrame([("k", "v", "7", 1)], "subfolder string, video_id string, map_id string, row int")
    images = spark.createDataFrame([("k", "v", "k/v/000007.webp"), ("k", "w", "k/w/a.png")], "subfolder string, video_id string, path string")
    with pytest.raises(Exception, match="no map"):
        manifests.from_maps(images, maps).collect()
    assert {(r.group_id, r.image_id, r.source) for r in manifests.from_maps(images, maps, True).collect()} == {("v", "000007", "kf_embedding"), ("w", "a", "directory")}


def test_stream_takes_up_what_is_new(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    df = spark.createDataFrame([(i, i * 0.5) for i in range(50)], "i int, x double")
    df.where("i < 20").write.parquet(source)
    stream = lambda: incremental.files(spark, source, df.schema, per_batch=1).where("i % 2 = 0")
    incremental.run_available(stream(), out, state)
    assert spark.read.parquet(out).count() == 10
    df.where("i >= 20").write.mode("append").parquet(source)
    incremental.run_available(stream(), out, state)
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == {tuple(r) for r in df.where("i % 2 = 0").collect()}
    seen = []
    query = incremental.each_batch(stream(), lambda batch, n: seen.append(batch.count()), f"{state}2")
    query.awaitTermination()
    assert sum(seen) == 25
    assert incremental.wait_for(lambda: True, 1) and not incremental.wait_for(lambda: False, 0.01, 0.005)


def test_backends(spark):
    class Fails:
        name = "bad"

        def __call__(self, row):
            if row["path"] == "b":
                raise RuntimeError("no such codec")
            return [{"n": 1}, {"n": 2}]

    class Works:
        name = "good"

        def __call__(self, row):
            if row["path"] == "c":
                raise RuntimeError("empty")
            return [{"n": 3}]

    there = {"bad": Fails, "good": Works}
    df = spark.createDataFrame([("a",), ("b",)], "path string")
    got = sorted(tuple(r) for r in backends.run(df, ["bad", "good"], "n int", ["path"], there).collect())
    assert got == [("a", 1, "bad", "ok", None), ("a", 2, "bad", "ok", None), ("b", 3, "good", "ok", None)]
    failed = backends.run(spark.createDataFrame([("c",)], "path string"), ["good"], "n int", ["path"], there).first()
    assert failed.status == "failed" and "empty" in failed.error
    registry = dict.fromkeys(("ffmpeg_hardware", "ffmpeg", "opencv", "pyav"))
    assert backends.chain_for("av1", registry) == ["ffmpeg_hardware", "ffmpeg", "pyav"] and backends.chain_for("x", registry) == ["ffmpeg", "opencv", "pyav"]
    stub = backends.run(df, ["stub"], "embedding array<float>", ["path"]).collect()
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 for r in stub)

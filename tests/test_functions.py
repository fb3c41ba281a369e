"""Expressions against cases worked out by hand from their definitions."""

import math

import pytest
from pyspark.sql import functions as F

from reelspark.functions import geometry, paths, values, vectors


def ask(spark, value, *columns, kind="string"):
    if kind == QUAD:
        value = [(float(x), float(y)) for x, y in value]
    row = spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


X = F.col("x")
QUAD = "array<struct<x:double,y:double>>"


@pytest.mark.parametrize("path, want", [("a.mp4", ("root", "a.mp4")), ("K16/a.mp4", ("K16", "a.mp4")), ("K16/x/a.mp4", ("K16", "x/a.mp4")), (None, (None, None))])
def test_collection(spark, path, want):
    assert ask(spark, path, paths.collection(X), paths.in_collection(X)) == want


@pytest.mark.parametrize("path, suffix, want", [("x/a.b.mp4", ".npy", "x/a.b.npy"), ("x/a.b.mp4", "", "x/a.b"), ("x/a.b.mp4", None, "x/a.b.mp4"), ("d.e/a", ".npy", "d.e/a.npy"), ("x/.hidden", "", "x/.hidden")])
def test_suffix(spark, path, suffix, want):
    assert ask(spark, path, paths.replace_suffix(X, suffix)) == want


def test_paths(spark):
    assert ask(spark, "K16/x/a.mp4", *paths.artefacts(X)) == ("dataraw/embeddings/K16/x/a.npy", "ProcessedData/scence_boundary/K16/x/a.txt", "dataraw/embeddings/keyframes_indices_B32_K16/x/a.txt", "ProcessedData/data/keyframes/K16/x/a", "ProcessedData/data/map_keyframes/K16/x/a.csv")
    assert ask(spark, "in/K1/a.mp4", paths.mirrored(X, "in", "out", ".npy")) == "out/K1/a.npy"
    assert ask(spark, "other/a.mp4", paths.mirrored(X, "in", "out")) is None
    assert ask(spark, r"a\b/c", paths.group_file(X)) == "a__b__c"
    assert ask(spark, "g", paths.image_path(X, F.lit("i"), "webp"), paths.image_path(X, F.lit("i"), "webp", strict_reference=True), paths.image_path(X, F.lit("i"), "png")) == ("preprocessed/g/i.webp", "preprocessed/g/i.jpg", "preprocessed/g/i.png")
    assert paths.model_root("out", "m", 1) == "out" and paths.model_root("out", "m", 2) == "out/m"


@pytest.mark.parametrize("raw, want", [("7", "000007"), ("7.0", "000007"), ("1234567", "1234567"), ("1e3", "001000"), (" frame ", "frame"), ("2.5", "2.5"), (None, None)])
def test_frame_stem(spark, raw, want):
    assert ask(spark, raw, paths.frame_stem(X)) == want


@pytest.mark.parametrize("raw, want", [(" Keep ", True), ("N", False), ("maybe", None), (None, None), ("1", True), ("discard", False)])
def test_flag(spark, raw, want):
    assert ask(spark, raw, values.parse_flag(X)) is want


def test_selected(spark):
    assert ask(spark, "maybe", values.selected([X, F.lit("no")])) is False
    assert ask(spark, "maybe", values.selected([X])) is True
    assert ask(spark, " ", values.first_present([X, F.lit(None), F.lit(" b ")])) == "b"


@pytest.mark.parametrize("raw, want", [("30000/1001", 30000 / 1001), ("25", 25.0), ("0/0", 0.0), ("5/0", 0.0), (None, 0.0), ("", 0.0)])
def test_frame_rate(spark, raw, want):
    assert ask(spark, raw, values.frame_rate(X)) == want


def test_frame_rate_malformed(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ask(spark, "x", values.frame_rate(X))


def test_video_fps(spark):
    fps = lambda codec, decoder: ask(spark, codec, values.video_fps(X, F.lit(decoder), F.lit("0/0"), F.lit("24/1")))
    assert (fps("h264", 30.0), fps("AV1", 30.0), fps("h264", 0.0), fps(None, 30.0)) == (30.0, 24.0, 24.0, 30.0)
    assert ask(spark, "12a", values.frame_count(X)) is None and ask(spark, "12", values.frame_count(X)) == 12


@pytest.mark.parametrize("w, h, model, ocr", [(1920, 1080, (224, 126), (1920, 1080)), (1080, 1920, (126, 224), (1080, 1920)), (100, 50, (100, 50), (1440, 720)), (500, 1, (224, 1), (1920, 4)), (640, 360, None, (1280, 720)), (3840, 2160, None, (1920, 1080)), (3000, 300, None, (1920, 192)), (1280, 720, None, (1280, 720)), (1001, 333, None, (1920, 639)), (5, 1, None, (1920, 384))])
def test_sizes(spark, w, h, model, ocr):
    a, b = F.lit(w), F.lit(h)
    assert ask(spark, 1, *values.ocr_size(a, b), kind="int") == ocr
    if model:
        assert ask(spark, 1, *values.model_size(a, b, 224), kind="int") == model


def test_text(spark):
    assert ask(spark, "a\x0bb 　c\n", values.clean_text(X)) == "a b c"
    assert ask(spark, "　 a\tb ", values.strip(X)) == "a\tb"
    assert ask(spark, "Straße", values.casefold(X)) == "strasse"
    assert [ask(spark, v, values.three_decimals(X), kind="double") for v in (1.0005, 0.0625, 2.0625, None)] == ["1.000", "0.062", "2.062", None]
    assert ask(spark, "1M", values.double_bitrate(X)) == "2M"
    assert ask(spark, "PP OCR", values.model_name(X, {"pp_ocr": "hybrid"})) == "hybrid"
    assert ask(spark, ["A b", "a_b", " ", "C"], values.model_names(X, {"c": "a_b"}), kind="array<string>") == ["a_b"]
    assert ask(spark, "1_000", values.to_float(X)) is None
    assert (values.workers("speech", 4, 20), values.workers("resize", 8), values.workers("save", 2)) == (2, 6, 1)


def test_boxes(spark):
    corners = lambda box: [(p.x, p.y) for p in ask(spark, box, geometry.clockwise(X), kind=QUAD)]
    assert corners([(10, 10), (10, 20), (40, 20), (40, 10)]) == [(10, 10), (40, 10), (40, 20), (10, 20)]
    assert corners([(1, 0), (2, 1), (1, 2), (0, 1)]) == [(1, 0), (1, 0), (2, 1), (1, 2)]
    box = [(10.0, 10.0), (40.0, 10.0), (40.0, 80.0), (10.0, 80.0)]
    for bind in (geometry.let, geometry.plain):
        assert ask(spark, box, *geometry.box_size(X, bind), geometry.large_enough(X, bind=bind), kind=QUAD) == (30, 70, True)
        assert ask(spark, box, *geometry.crop_size(X, bind), kind=QUAD) == (30, 70, True)
    assert [(p.x, p.y) for p in ask(spark, [(-5.0, 3.0), (500.0, 3.0), (500.0, 99.0), (0.0, 99.0)], geometry.clip(X, F.lit(100), F.lit(50)), kind=QUAD)] == [(0, 3), (99, 3), (99, 49), (0, 49)]
    assert ask(spark, [(0.5, 1.5), (2.5, 0.0), (1.0, 1.0), (3.5, 0.0)], geometry.rounded_key(X), kind=QUAD) == "0,2,2,0,1,1,4,0"
    assert ask(spark, [1.0, 2.0, 3.0, 4.0], F.size(geometry.from_numbers(X)), kind="array<double>") == 4
    assert ask(spark, [1.0, 2.0, 3.0], geometry.from_numbers(X), kind="array<double>") is None


def test_vectors(spark):
    kind = "array<float>"
    assert ask(spark, [3.0, 4.0], vectors.norm(X), vectors.normalise(X), kind=kind) == (5.0, [0.6, 0.8])
    assert [ask(spark, v, vectors.usable(X, 2), kind=kind) for v in ([1.0, 0.0], [0.0, 0.0], [1.0], None, [1.0, None], [1.0, math.nan], [math.inf, 1.0], [1e-40, 0.0])] == [True, False, False, False, False, False, False, True]
    df = spark.createDataFrame([("a", i, [float(v), 0.0]) for i, v in enumerate((0, 1, 5, 1))] + [("b", 9, [1.0, 1.0])], "k string, i int, v array<float>")
    got = {r.k: r.i for r in vectors.nearest_to_centroid(df, ["k"], "v", "i", 2).collect()}
    assert got == {"a": 1, "b": 9}


def test_nearest_to_centroid_leaves_out_unusable_and_repeated(spark):
    rows = [("a", 1, None), ("a", 2, [1.0]), ("a", 3, [float("nan"), 1.0]), ("a", 4, [0.0, 0.0]), ("a", 5, [1.0, 1.0]), ("a", 6, [2.0, 1.0]), ("a", 7, [6.0, 1.0]), ("a", 7, [6.0, 1.0])]
    df = spark.createDataFrame(rows, "k string, i long, v array<float>")
    assert [tuple(r) for r in vectors.nearest_to_centroid(df, ["k"], "v", "i", 2).collect()] == [("a", 6, 1.0)]

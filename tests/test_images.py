"""Operations on images against values worked out by hand, and decoding through a stand-in program."""

import stat

import numpy as np
from pyspark.sql import functions as F

from reelspark import images
from reelspark.runtime import cut


def made(seed=0, h=12, w=20):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def test_sizes():
    for given, want in (((640, 360), (1280, 720)), ((3840, 2160), (1920, 1080)), ((3000, 300), (1920, 192)), ((1280, 720), (1280, 720)), ((1001, 333), (1920, 639)), ((5, 1), (1920, 384))):
        assert images.size_for_text(*given, 1920, 720) == want
    assert images.size_for_text(5, 1, None, None) == (5, 1)
    flat = np.full((4, 6, 3), 77, np.uint8)
    assert (images.resized(flat, 9, 3) == 77).all() and images.resized(flat, 9, 3).shape == (9, 3, 3)
    ramp = np.repeat(np.arange(4, dtype=np.uint8)[None, :, None] * 10, 3, 2).repeat(2, 0)
    assert images.resized(ramp, 2, 2)[0, :, 0].tolist() == [5, 25]


def test_tones():
    x = np.array([[[10, 10, 10], [110, 10, 10], [210, 10, 20]]], np.uint8)
    assert images.autocontrast(x)[0, :, 0].tolist() == [0, 128, 255] and images.autocontrast(x)[0, :, 1].tolist() == [10, 10, 10]
    assert images.grey(np.array([[[255, 0, 0]]], np.uint8)).tolist() == [[[76, 76, 76]]]
    y = made()
    assert (images.contrast(y, 1.0) == y).all() and images.contrast(y, 0.0).std() == 0
    assert (images.sharpness(y, 1.0) == y).all() and (images.sharpness(y, 2.0)[0] == y[0]).all()
    spot = np.zeros((3, 3, 3), np.uint8)
    spot[1, 1] = 130
    assert images.sharpness(spot, 0.0)[1, 1, 0] == 50
    assert images.CROP.over(images.Preparation()).most_side == 1920 and images.Preparation(sharpness=None).over(images.CROP).sharpness == 1.18
    assert images.prepared(np.full((720, 900, 3), 9, np.uint8), images.Preparation()).shape == (720, 900, 3)


def test_crops(spark):
    x = made(1, 30, 40)
    upright = images.rectified(x, np.array([[5, 4], [25, 4], [25, 14], [5, 14]], float))
    assert (upright == x[4:14, 5:25]).all()
    turned = images.rectified(x, np.array([[5, 4], [10, 4], [10, 24], [5, 24]], float))
    assert (turned == np.rot90(x[4:24, 5:10])).all()
    assert images.rectified(x, np.zeros((4, 2))).shape == (1, 1, 3)
    assert images.prepared_crop(upright).shape == (48, round(28 * 48 / 18), 3)
    box = [(5.0, 4.0), (25.0, 4.0), (25.0, 14.0), (5.0, 14.0)]
    df = spark.createDataFrame([("a", x.tobytes(), 40, 30, [box, box]), ("b", None, 1, 1, [box]), ("c", x.tobytes(), 40, 30, None)], "k string, pixels binary, width int, height int, corners array<array<struct<x:double,y:double>>>")
    got = images.crops(df, ["k"]).collect()
    assert [(r.k, r.line_index, r.height) for r in got] == [("a", 0, 48), ("a", 1, 48)]
    assert got[0].pixels == images.prepared_crop(upright).tobytes()
    small = images.at_height(df.drop("corners"), 15).orderBy("k").collect()
    assert [(r.width, r.height, r.pixels is None) for r in small] == [(20, 15, False), (1, 1, True), (20, 15, False)]
    assert images.ready(df.drop("corners").where("k = 'a'"), images.Preparation(None, 60)).first().height == 60


def test_content_scores(spark):
    red, blue = (np.broadcast_to(np.array(c, np.uint8), (4, 4, 3)).tobytes() for c in ((200, 0, 0), (0, 0, 200)))
    rows = [("v", i, blue if i == 3 else red, 4, 4) for i in range(5)] + [("w", 0, blue, 4, 4), ("w", 1, blue[:12], 2, 2)]
    df = spark.createDataFrame(rows, "video_id string, frame_idx int, pixels binary, width int, height int").repartition(3)
    got = {(r.video_id, r.frame_idx): r.score for r in images.content_scores(df).collect()}
    assert got == {("v", 0): 0, ("v", 1): 0, ("v", 2): 0, ("v", 3): 40, ("v", 4): 40, ("w", 0): 0, ("w", 1): 0}
    assert images.hue_saturation_value(np.array([[[0, 255, 0], [9, 9, 9]]], np.uint8)).tolist() == [[[60, 255, 255], [0, 0, 9]]]


def test_decoding(spark, tmp_path):
    program = tmp_path / "decode"
    # three frames of 4 by 2; with the decoder "bad" one frame and a half and then failure
    program.write_text('#!/bin/sh\ncase "$*" in *bad*) head -c 36 /dev/zero; exit 1;; *gone*) exit 0;; *) head -c 72 /dev/zero;; esac\n')
    program.chmod(program.stat().st_mode | stat.S_IEXEC)
    vids = spark.createDataFrame([("a", "a.mp4", 400, 200), ("b", "gone.mp4", 200, 400)], "video_id string, path string, width int, height int")
    frames = cut(images.decoded(vids, ["bad", None], side=2, every=5, program=str(program), at_once=2), "frames")
    good, errors = images.whole_attempts(frames)
    assert sorted((r.video_id, r.frame_idx, len(r.pixels), r.width, r.height) for r in good.collect()) == [("a", i, 24, 4, 2) for i in (0, 5, 10)]
    assert {(r.video_id, r.attempt) for r in errors.collect()} == {("a", 0), ("b", 0), ("b", 1)}
    missing = images.decoded(vids, [None], program="no-such-program-here").select(F.col("error").isNotNull().alias("e")).collect()
    assert [r.e for r in missing] == [True, True]

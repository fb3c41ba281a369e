"""Whole jobs on small trees and tables, and what surrounds pixels and programs."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark import backends, media, pipelines


def test_store(spark, tmp_path):
    store = pipelines.Store(spark, f"file://{tmp_path}/s")
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "video_id string")
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "video_id string, n int")
    assert store.pending("t", ids("a", "b")).count() == 2
    store.write("t", rows(("a", 1), ("a", 2)), ids("a", "b"))  # b is done and has no row
    assert store.pending("t", ids("a", "b", "c")).collect()[0].video_id == "c" and store.pending("t", ids("a"), True).count() == 1
    store.write("t", rows(("a", 3)), ids("a"))
    assert [tuple(r) for r in store.read("t").collect()] == [("a", 3)]
    rows(("c", 9)).write.parquet(f"file://{tmp_path}/s/t/run=12")  # a run that broke off
    assert store.read("t").count() == 1 and store.pending("t", ids("c")).count() == 1
    store.put_away("t", ids("a"))
    assert store.read("t").count() == 0 and store.pending("t", ids("a")).count() == 1
    with pytest.raises(FileNotFoundError, match="skip_x"):
        store.require("t", ids("a"), "x", "skip_x")


def test_extract_keyframes(spark, tmp_path):
    r = np.random.default_rng(0)
    vids = spark.createDataFrame([(f"v{i}", f"k/v{i}.mp4", 25.0, 60) for i in range(4)], "video_id string, rel_path string, fps double, frame_count int")
    frames = spark.createDataFrame([(f"v{i}", f, [float(x) for x in r.normal(size=8) + (5 if f >= 30 else 0)]) for i in range(4) for f in range(60)], "video_id string, frame_idx int, embedding array<float>")
    score = frames.select("video_id", "frame_idx", F.when(F.col("frame_idx").isin(30, 35), 40.0).otherwise(1.0).alias("score"))
    of = lambda t: lambda new: t.join(new.select("video_id"), "video_id", "left_semi")
    store = pipelines.Store(spark, f"file://{tmp_path}/s")
    saved = lambda rows: rows.withColumn("status", F.lit("ok"))
    options = lambda **kw: pipelines.KeyframeOptions(dim=8, **kw)
    got = pipelines.extract_keyframes(spark, vids, store, of(frames), of(score), saved, options(num_shards=2, shard_index=1, limit_videos=3))
    assert {x.video_id for x in got.collect()} == {"v1"}
    got = pipelines.extract_keyframes(spark, vids, store, of(frames), of(score), saved, options(clean_frames_embedding=True))
    assert {x.video_id for x in got.collect()} == {"v0", "v1", "v2", "v3"} and all(x.pts_time == x.frame_idx / 25 for x in got.collect())
    found = sorted((x.start_frame, x.end_frame) for x in store.read("scenes").where("video_id = 'v2'").collect())
    assert found == [(0, 29), (30, 59)]  # the cut at 35 is too near
    assert store.read("embeddings").count() == 0
    with pytest.raises(FileNotFoundError, match="skip_encode"):
        pipelines.extract_keyframes(spark, vids, store, of(frames), of(score), None, options(skip_encode=True, overwrite=True))
    with pytest.raises(Exception, match="could not be saved"):
        pipelines.extract_keyframes(spark, vids, store, of(frames), of(score), lambda rows: rows.withColumn("status", F.lit("failed")), options(overwrite=True))


def test_discover_keyframes(spark, tmp_path):
    for name in ("K1/v/000000.webp", "K1/v/000001.jpg", "K1/w/x.png", "K2/u/000003.webp", "K2/u/note.txt"):
        p = tmp_path / "kf" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    for name, text in (("K1/v.csv", "keyframe_id,x\n1,a\n0,b\n"), ("K2/u.csv", "id,pts_time\n3,0.5\n ,1\n")):
        p = tmp_path / "maps" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    root, maps = f"{tmp_path}/kf", f"{tmp_path}/maps"
    key = lambda df: [(r.group_id, r.image_id, r.map_id) for r in df.collect()]
    assert key(pipelines.discover_keyframes(spark, root)) == [("K1/v", "000000", ""), ("K1/v", "000001", ""), ("K1/w", "x", ""), ("K2/u", "000003", "")]
    assert key(pipelines.discover_keyframes(spark, root, map_root=maps, allow_missing_map=True)) == [("u", "000003", "3"), ("v", "000000", "0"), ("v", "000001", "1"), ("w", "x", "")]
    assert key(pipelines.discover_keyframes(spark, root, map_root=maps, subfolders=["K2"])) == [("u", "000003", "3")]
    assert len(key(pipelines.discover_keyframes(spark, root, map_root=maps, default_root=True, limit=2))) == 2
    with pytest.raises(Exception, match="no map"):
        pipelines.discover_keyframes(spark, root, map_root=maps).collect()
    (tmp_path / "m.csv").write_text(f"path,selected,group_id\nK1/v/000000,yes,\n{root}/K2/u/000003.webp,yes,G\nK1/w/x.png,no,\nK9/none.png,yes,\n")
    assert [(r.group_id, r.image_id, r.path) for r in pipelines.discover_keyframes(spark, root, manifest=f"{tmp_path}/m.csv").collect()] == [("G", "000003", "K2/u/000003.webp"), ("K1/v", "000000", "K1/v/000000.webp")]
    with pytest.raises(FileNotFoundError):
        pipelines.discover_keyframes(spark, f"{tmp_path}/maps")


def test_read_text_and_transcribe(spark, tmp_path):
    items = spark.createDataFrame([("g", "1", "g/1.webp", "7", "", "m", "0"), ("g", "2", "g/2.webp", "8", "", "m", "1")], "group_id string, image_id string, path string, map_id string, subfolder string, source string, seq string")
    line = F.array(F.struct(F.lit(" Hi ").alias("text"), F.lit(0.9).alias("confidence")), F.struct(F.lit("low").alias("text"), F.lit(0.1).alias("confidence")))
    read = lambda asked: asked.select("group_id", "image_id", line.alias("lines"), F.lit(2.0).alias("latency_ms"))
    prepare = lambda x: x.where("image_id = '1'").select("group_id", "image_id", F.lit("prep/1.jpg").alias("path"))
    out = f"file://{tmp_path}/o"
    done = pipelines.read_text(items, read, out, prepare, models=("A b", "c"))
    assert set(done) == {"a_b", "c"} and {(r.image_id, r.text, r.preprocessed_path) for r in done["c"].collect()} == {("1", "Hi", "prep/1.jpg"), ("2", "Hi", "")}
    assert (tmp_path / "o/a_b/predictions").is_dir() and (tmp_path / "o/selected_keyframes").is_dir()
    assert pipelines.read_text(items, read, out, models=("A b", "c")) == {}
    with pytest.raises(Exception, match="not recognised"):
        pipelines.read_text(items, lambda asked: read(asked).where("image_id = '1'"), f"{out}2")
    vids = spark.createDataFrame([("v",), ("w",)], "video_id string")
    heard = spark.createDataFrame([("v", 0, 0.0, 2.0, " hello ", None, None), ("v", 1, 3.0, 4.0, "no", None, None), ("w", 0, 0.0, 1.0, "hello", -2.0, None), ("w", 1, 0.0, 1.0, "there", None, 0.1)], "video_id string, seg_no int, start double, end double, text string, avg_logprob double, no_speech_prob double")
    maps = spark.createDataFrame([("v", 1.0, 25), ("v", 9.0, 225)], "video_id string, pts_time double, frame_idx long")
    got = pipelines.transcribe(vids, lambda v: heard, maps, f"file://{tmp_path}/a").collect()
    assert [(r.video_id, r.text, r.imgs) for r in got] == [("v", "hello", [25])]
    assert (tmp_path / "a/asr_segments/video_id=w").is_dir() and not (tmp_path / "a/asr_transcript/video_id=w").exists()


def test_pixels_and_files(spark, tmp_path):
    x = np.random.default_rng(1).integers(0, 256, (3, 4, 5, 3), dtype=np.uint8)
    want = ((x / 255.0 - np.array(media.MEAN)) / np.array(media.DEVIATION)).transpose(0, 3, 1, 2)
    assert np.allclose(media.normalised(x), want, atol=1e-5)
    rows = [(i, x[i].tobytes()) for i in range(3)] + [(8, None), (9, b"abc")]
    got = {r.i: r["values"] for r in media.normalised_columns(spark.createDataFrame(rows, "i int, p binary"), "p", 4, 5).collect()}
    assert got[8] is None and got[9] is None and np.allclose(got[1], want[1].ravel(), atol=1e-5)
    content = media.png(x[0])
    at, parts = 8, {}
    while at < len(content):
        n, kind = struct.unpack(">I4s", content[at : at + 8])
        parts[kind] = content[at + 8 : at + 8 + n]
        assert struct.unpack(">I", content[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + parts[kind])
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(parts[b"IDAT"]), np.uint8).reshape(4, 16)
    assert (raw[:, 1:].reshape(4, 5, 3) == x[0]).all() and struct.unpack(">II", parts[b"IHDR"][:8]) == (5, 4)
    df = spark.createDataFrame([(f"{tmp_path}/a/b.png", x[0].tobytes(), 5, 4), (f"{tmp_path}/c.tga", x[0].tobytes(), 5, 4)], "path string, pixels binary, width int, height int")
    done = {r.path[-5:]: r.status for r in media.write_images(df, strict=False).collect()}
    assert done == {"b.png": "ok", "c.tga": "failed"} and (tmp_path / "a/b.png").read_bytes() == content
    with pytest.raises(Exception, match="could not be written"):
        media.write_images(df).collect()


def test_programs():
    assert media.probe_command("x.mp4")[-1] == "x.mp4" and "-vn" in media.audio_command("a", "b")
    command = media.resize_command("a.mp4", "b.mp4", 480, "3M", False)
    assert command[command.index("-bufsize") + 1] == "6M" and "hwupload_cuda,scale_cuda=-2:480" in command and "-hwaccel" not in command
    assert "-hwaccel" in media.resize_command("a", "b", 480, "1M", True)
    assert "select=not(mod(n\\,3))" in media.decode_command("a", 224, "h264_cuvid", 3)[8]
    there = media.decoders(" V....D h264_cuvid  x\n V..... = Video\n A....D aac  y\nno line")
    assert there == {"h264_cuvid", "aac"} and media.hardware_decoder("h264", there) == "h264_cuvid" and media.hardware_decoder("vp9", there) is None
    with pytest.raises(RuntimeError, match="not there"):
        media.run_program(["no-such-program-here"])
    with pytest.raises(RuntimeError, match="ended with"):
        media.run_program(["sh", "-c", "exit 3"])


def test_batches_and_successes(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(7)] + [(9, None)], "i int, x array<float>")
    got = {r.i: r.v for r in backends.run_batches(df, lambda: lambda x: np.stack([x[:, 1], x[:, 0], 0 * x[:, 0]], 1), "x", 3, "v", size=2).collect()}
    assert got[9] is None and np.allclose(got[3], np.array([1, 3, 0]) / np.sqrt(10), atol=1e-3) and len(got) == 8
    failed = spark.createDataFrame([("a", "failed", "e"), ("b", "ok", None)], "path string, status string, error string")
    assert [r.path for r in backends.succeeded(failed).collect()] == ["b"]
    with pytest.raises(RuntimeError):
        backends.succeeded(failed.where("path = 'a'"), some=True)


def test_encode_images_and_resize(spark, tmp_path):
    store = pipelines.Store(spark, f"file://{tmp_path}/s", "group_id")
    images = spark.createDataFrame([("g", "1", [3.0, 4.0]), ("g", "2", None), ("h", "1", [0.0, 2.0])], "group_id string, image_id string, values array<float>")
    got = {(r.group_id, r.image_id): r.embedding for r in pipelines.encode_images(images, store, lambda: lambda x: x, 2).collect()}
    assert np.allclose(got["g", "1"], [0.6, 0.8], atol=1e-3) and got["g", "2"] is None and got["h", "1"] == [0, 1]

    def broken():
        raise AssertionError("nothing is left to do")

    assert pipelines.encode_images(images, store, lambda: lambda x: broken(), 2).count() == 3

    class Resizer:
        name = "r"

        def __call__(self, row):
            if row["path"] == "bad":
                raise ValueError("no")
            return [{"written": row["out"]}]

    vids = spark.createDataFrame([("a", "ok", "o/a"), ("b", "bad", "o/b")], "group_id string, path string, out string")
    run = lambda: {(r.group_id, r.status, r.written) for r in pipelines.resize_videos(vids, store, ("r",), {"r": Resizer}).collect()}
    assert run() == {("a", "ok", "o/a"), ("b", "failed", None)} and run() == {("b", "failed", None)}

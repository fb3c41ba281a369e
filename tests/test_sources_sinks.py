"""Readers and writers on small trees, and round trips through the legacy forms."""

import json

import numpy as np
import pytest

from reelspark.operators import ocr
from reelspark.sources import readers, sinks


@pytest.fixture
def root(tmp_path):
    for name in ("K1/a.mp4", "K1/x/b.MP4", "K1-2/c.mp4", "d.mp4", "K2/e.txt", "K2/f.mkv"):
        p = tmp_path / "videos" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    return tmp_path


def test_tree(spark, root):
    base = f"{root}/videos"
    assert {r.rel_path for r in readers.tree(spark, base).collect()} == {"K1/a.mp4", "K1-2/c.mp4", "d.mp4"}
    assert [r.rel_path for r in readers.tree(spark, base, depth=1).collect()] == ["d.mp4"]
    assert [(r.rel_path, r.collection) for r in readers.videos(spark, base).collect()] == [("K1/a.mp4", "K1"), ("K1-2/c.mp4", "K1-2"), ("d.mp4", "root")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.tree(spark, f"{root}/nowhere").collect()
    assert [r.name for r in readers.subfolders(spark, base).collect()] == ["K1", "K1-2", "K2"]
    (root / "videos/empty").mkdir()
    assert [r.name for r in readers.subfolders(spark, base).collect()] == ["K1", "K1-2", "K2", "empty"]
    assert readers.subfolders(spark, f"{root}/nowhere").count() == 0
    (root / "videos/empty").rmdir()
    lists = spark.createDataFrame([("files_list_K9.txt",)], "name string")
    assert [r.name for r in readers.subfolders(spark, base, lists).collect()] == ["K1", "K1-2", "K2", "K9"]
    assert [r.name for r in readers.subfolders(spark, base, requested=["b", "a", "b"]).collect()] == ["a", "b"]


def test_file_list(spark, root):
    path = root / "list.txt"
    path.write_text('﻿a/x.MP4\n\n  # note\n "b/y.mp4" \n/abs/z.mp4\n')
    assert [r.path for r in readers.file_list(spark, str(path)).collect()] == ["a/x.MP4", "b/y.mp4", "/abs/z.mp4"]
    assert [r.path for r in readers.file_list(spark, str(path), "base", ".mp4").collect()] == ["base/a/x.MP4", "base/b/y.mp4", "/abs/z.mp4"]
    assert [r.path for r in readers.file_list(spark, str(path), ending="").collect()] == ["a/x", "b/y", "/abs/z"]
    found = readers.file_list(spark, f"{root}/none.txt", fallback=f"{root}/videos")
    assert {r.path for r in found.collect()} == {"K1/a.mp4", "K1/x/b.MP4", "K1-2/c.mp4", "d.mp4", "K2/f.mkv"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.file_list(spark, f"{root}/none.txt")


def test_manifest(spark, tmp_path):
    rows = [{"path": "a.png", "keep": "1"}, {"path": "b.png", "keep": "0"}]
    (tmp_path / "m.csv").write_text("﻿path,keep\na.png,1\nb.png,0\n")
    (tmp_path / "m.jsonl").write_text("\n".join([*map(json.dumps, rows), "[1]", ""]))
    (tmp_path / "list.json").write_text(json.dumps(rows))
    (tmp_path / "inner.json").write_text(json.dumps({"note": 1, "items": rows}))
    for name in ("m.csv", "m.jsonl", "list.json", "inner.json"):
        assert sorted((r.path, r.keep) for r in readers.manifest(spark, f"{tmp_path}/{name}").collect()) == [("a.png", "1"), ("b.png", "0")], name
    with pytest.raises(ValueError):
        readers.manifest(spark, "m.xml")
    (tmp_path / "bad.jsonl").write_text('{"path": "a"}\n{"path": \n')
    (tmp_path / "shape.json").write_text('{"note": {"path": "a"}, "rows": 3}')
    (tmp_path / "mixed.json").write_text('[{"path": "a", "box": [1, 2]}, [{"path": "b"}], 4, null]')
    for name in ("bad.jsonl", "shape.json"):
        with pytest.raises(Exception, match="(?i)malformed|manifest must be"):
            readers.manifest(spark, f"{tmp_path}/{name}").collect()
    assert [(r.path, r.box) for r in readers.manifest(spark, f"{tmp_path}/mixed.json").collect()] == [("a", "[1,2]")]


def test_legacy_files(spark, tmp_path):
    (tmp_path / "map.csv").write_text("id,pts_time,fps,frame_idx\n0,1.5,25.0,30\n1,,0,7\n")
    assert [tuple(r) for r in readers.keyframe_map(spark, f"{tmp_path}/map.csv").collect()] == [(1, None, 0.0, 7), (0, 1.5, 25.0, 30)]
    (tmp_path / "ids.csv").write_text("keyframe_id,x\n7,a\n ,b\n")
    assert [r.map_id for r in readers.map_rows(spark, f"{tmp_path}/ids.csv").collect()] == ["7"]
    with pytest.raises(ValueError):
        readers.image_ids(spark, f"{tmp_path}/ids.csv")
    assert [r.id for r in readers.image_ids(spark, f"{tmp_path}/map.csv").orderBy("row").collect()] == ["0", "1"]
    (tmp_path / "n.txt").write_text("30\n4\n\n")
    assert [r.value for r in readers.whole_numbers(spark, f"{tmp_path}/n.txt").collect()] == [4, 30]
    (tmp_path / "s.txt").write_text("0 9\n10 14\n")
    assert [tuple(r)[1:] for r in readers.scene_ranges(spark, f"{tmp_path}/s.txt").collect()] == [(0, 0, 9), (1, 10, 14)]
    np.save(tmp_path / "e.npy", np.array([[1, 2], [3, 4]], np.float16))
    (tmp_path / "empty.npy").write_bytes(b"")
    assert [(r.frame_idx, r.embedding) for r in readers.array_files(spark, str(tmp_path)).orderBy("frame_idx").collect()] == [(0, [1, 2]), (1, [3, 4])]
    probe = json.dumps({"streams": [{"codec_name": "h264", "width": 9, "nb_frames": "12"}]})
    got = readers.probes(spark.createDataFrame([(probe,), ("{",), ('{"streams":[]}',), (None,)], "probe string")).collect()
    assert [(r.codec_name, r.width, r.nb_frames, r.height) for r in got] == [("h264", 9, "12", None)] + [(None,) * 4] * 3


def test_sinks(spark, tmp_path):
    out = lambda n: f"file://{tmp_path}/{n}"
    frames = spark.createDataFrame([("K1", "v", i, [1.0]) for i in range(5)], "collection string, video_id string, frame_idx long, embedding array<float>")
    sinks.embeddings(frames, out("e"))
    assert spark.read.parquet(out("e")).count() == 5
    with pytest.raises(ValueError):
        sinks.embeddings(frames.limit(0), out("e2"))
    sinks.indices(frames.unionByName(frames), out("i"))
    assert [int(x) for x in (next((tmp_path / "i/video_id=v").glob("part-*"))).read_text().split()] == [0, 1, 2, 3, 4]
    scenes = spark.createDataFrame([("v", 10, 20), ("v", 0, 9)], "video_id string, start_frame long, end_frame long")
    sinks.ranges(scenes, out("r"))
    assert next((tmp_path / "r/video_id=v").glob("part-*")).read_text() == "0 9\n10 20\n"
    maps = spark.createDataFrame([("v", 1, None, 0.0, 7), ("v", 0, 1.5, 25.0, 30)], "video_id string, id int, pts_time double, fps double, frame_idx long")
    sinks.keyframe_maps(maps, out("m"))
    assert next((tmp_path / "m/video_id=v").glob("part-*")).read_text() == "id,pts_time,fps,frame_idx\n0,1.5,25.0,30\n1,,0.0,7\n"
    speech = spark.createDataFrame([("v", 1.0005, 2.0625, "hello, you", [3, 4])], "video_id string, start double, end double, text string, imgs array<long>")
    sinks.speech_csv(speech, out("c"))
    assert next((tmp_path / "c/video_id=v").glob("part-*")).read_text() == 'start,end,text\n1.000,2.062,"hello, you"\n'
    sinks.speech_json(speech, out("j"))
    assert json.loads(next((tmp_path / "j/video_id=v").glob("part-*")).read_text()) == {"start": 1.0005, "end": 2.0625, "text": "hello, you", "imgs": [3, 4]}
    lists = spark.createDataFrame([("K1", "b.mp4"), ("K1", "a.mp4")], "collection string, rel_path string")
    sinks.file_lists(lists, out("l"))
    assert next((tmp_path / "l/collection=K1").glob("part-*")).read_text() == "a.mp4\nb.mp4\n"
    line = "array<struct<text:string,confidence:double>>"
    rows = [("g/h", "2", "7", "", "p2", "o2", "", 1.5, [("t", 0.9)]), ("g/h", "1", "8", "s", "p1", "o1", "q1", None, [("u", None), ("w", 0.1)])]
    read = spark.createDataFrame(rows, f"group_id string, image_id string, map_id string, subfolder string, path string, original_path string, preprocessed_path string, latency_ms double, lines {line}")
    sinks.predictions(ocr.predictions(read), out("p"))
    first, second = json.loads(next((tmp_path / "p/groups/file=g__h").glob("part-*")).read_text())
    assert first == {"idx": "1", "image_id": "1", "frame_id": "1", "map_id": "8", "subfolder": "s", "path": "o1", "preprocessed_path": "q1", "text": ["u"], "text_joined": "u", "latency_ms": None, "all_lines": [{"text": "u", "confidence": None}, {"text": "w", "confidence": 0.1}]}
    assert list(first) == list(ocr.GROUP_FIELDS) and second["image_id"] == "2"
    jsonl = [json.loads(x) for part in (tmp_path / "p/predictions").glob("part-*") for x in part.read_text().splitlines()]
    assert len(jsonl) == 2 and all(len(x) == 15 for x in jsonl)
    assert next(p for p in (tmp_path / "p/ocr_predictions").glob("part-*") if p.stat().st_size).read_text().splitlines()[0] == ",".join(ocr.ROW_FIELDS)
    sinks.speech_maps(speech, out("t"))
    assert json.loads(next((tmp_path / "t/video_id=v").glob("part-*")).read_text()) == [{"start": 1.0005, "end": 2.0625, "text": "hello, you", "imgs": [3, 4]}]
    found = spark.createDataFrame([("g", "1", "g/1.webp", "7")], "group_id string, image_id string, path string, map_id string")
    sinks.keyframe_manifest(found, found.limit(0), out("k"))
    written = [line for part in (tmp_path / "k").glob("part-*") for line in part.read_text().splitlines()]
    assert "g,1,g,1,7,,g/1.webp," in written

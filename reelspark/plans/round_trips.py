"""Queries over sources, sinks, manifests, backends and whole jobs: what is written is read again and compared with SQL over the tables.

Files go to the shared folder and are removed when the application ends.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import backends, images, media, pipelines
from reelspark.functions import geometry, paths, values, vectors
from reelspark.operators import catalog, manifests, ocr, scenes, transcripts
from reelspark.plans.catalog import _CLEAN, _FPS, _MAP, _REPLACED, _SEGMENTS, _STRIP, _USABLE, _VIDEOS, _map, _segments, long, query
from reelspark.runtime import cut, scratch, spread, table
from reelspark.sources import readers, sinks
from reelspark.streaming import incremental


def _folder(spark: SparkSession) -> str:
    """A new folder that ends with the application."""
    return scratch(spark, "trip")


def _videos(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "file_list").select("video_id", "collection", "rel_path").distinct()


def _plant(spark: SparkSession, rows: DataFrame, root: str) -> str:
    """Small files at the paths of ``rel_path`` below ``root``."""

    class Toucher:
        name = "touch"

        def __call__(self, row: dict) -> list[dict]:
            media.put(f"{root}/{row['rel_path']}", b"x")
            return [{"size": 1}]

    done = backends.run(rows.select("rel_path"), ["touch"], "size int", ["rel_path"], {"touch": Toucher})
    catalog.require(done, F.col("status") == "ok", "a file could not be written").write.format("noop").mode("overwrite").save()
    return root


# --- trees and lists ----------------------------------------------------------------------------------------------------


@query(f"""
    select distinct rel_path, case when contains(rel_path, '/') then split_part(rel_path, '/', 1) else 'root' end as collection,
        case when contains(rel_path, '/') then substr(rel_path, strpos(rel_path, '/') + 1) else rel_path end as rel_in_collection from {_VIDEOS} where rel_path like '%.mp4'""")
def video_tree(spark: SparkSession, root: str) -> DataFrame:
    """Videos found below a folder; another case of the suffix is not one."""
    return readers.videos(spark, _plant(spark, _videos(spark, root), _folder(spark))).select("rel_path", "collection", "rel_in_collection")


@query(f"select distinct rel_path from {_VIDEOS} where lower(rel_path) like '%.mp4' and len(string_split(rel_path, '/')) <= 2")
def shallow_tree(spark: SparkSession, root: str) -> DataFrame:
    """Files at most two levels down, whatever the case of their suffix."""
    return readers.tree(spark, _plant(spark, _videos(spark, root), _folder(spark)), depth=2, any_case=True).select("rel_path")


@query(f"""
    select distinct regexp_replace(p, '/?[^/]*$', '') as group_id, regexp_replace(split_part(p, '/', -1), '\\.[^.]*$', '') as image_id, p as path
    from (select {_REPLACED.format("rel_path")} || case when len(rel_path) % 2 = 0 then '.webp' else '.JPG' end as p from {_VIDEOS})""")
def image_tree(spark: SparkSession, root: str) -> DataFrame:
    rel = F.concat(paths.replace_suffix(F.col("rel_path"), ""), F.when(F.length("rel_path") % 2 == 0, F.lit(".webp")).otherwise(F.lit(".JPG")))
    return readers.images(spark, _plant(spark, _videos(spark, root).select(rel.alias("rel_path")).distinct(), _folder(spark)))


@query(f"""
    select distinct split_part(rel_path, '/', 1) as name from {_VIDEOS} where contains(rel_path, '/')
    union select distinct substr(video_id, 1, 3) from asr_segments where video_id is not null""")
def top_folders(spark: SparkSession, root: str) -> DataFrame:
    """Folders below a root, and collections that only file lists name."""
    lists = table(spark, root, "asr_segments").where("video_id is not null").select(F.concat(F.lit("files_list_"), F.substring("video_id", 1, 3), F.lit(".txt")).alias("name"))
    return readers.subfolders(spark, _plant(spark, _videos(spark, root), _folder(spark)), lists)


@query(f"select distinct '/videos/' || case when lower(rel_path) like '%.mp4' then rel_path else {_REPLACED.format('rel_path')} || '.mp4' end as path from {_VIDEOS}")
def list_files(spark: SparkSession, root: str) -> DataFrame:
    """File lists written by collection and read again; a suffix that differs but for case stays."""
    where = _folder(spark)
    sinks.file_lists(_videos(spark, root), where)
    return readers.file_list(spark, where, base="/videos", ending=".mp4").distinct()


@query(f"select distinct '/videos/' || {_REPLACED.format('rel_path')} || '.npy' as path from {_VIDEOS} where lower(rel_path) like '%.mp4'")
def list_fallback(spark: SparkSession, root: str) -> DataFrame:
    """Without a file list the videos themselves are listed."""
    where = _plant(spark, _videos(spark, root), _folder(spark))
    return readers.file_list(spark, f"{where}/no-such-list.txt", base="/videos", ending=".npy", fallback=where)


@query(f"""select rel_path, '/b/' || {_REPLACED.format("rel_path")} || '.txt' as moved, replace({_REPLACED.format("rel_path")}, '/', '__') as file, 'preprocessed/' || collection || '/' || video_id || '.jpg' as image,
    '/out/' || lower(replace(trim(collection), ' ', '_')) as model from {_VIDEOS}""")
def mirrored_paths(spark: SparkSession, root: str) -> DataFrame:
    rel = F.col("rel_path")
    moved = paths.mirrored(F.concat(F.lit("/a/"), rel), "/a", "/b", ".txt")
    image = paths.image_path(F.col("collection"), F.col("video_id"), "webp", strict_reference=True)
    model = F.concat(F.lit(paths.model_root("/out", "", 2)), values.model_name(F.col("collection"), {}))
    return _videos(spark, root).select(rel, moved.alias("moved"), paths.group_file(paths.replace_suffix(rel, "")).alias("file"), image.alias("image"), model.alias("model"))


# --- files of videos ----------------------------------------------------------------------------------------------------


@query(f"select video_id, id, case when not isnan(pts_time) then pts_time end as pts_time, fps, frame_idx from {_MAP}")
def map_files(spark: SparkSession, root: str) -> DataFrame:
    where = _folder(spark)
    sinks.keyframe_maps(_map(spark, root), where)
    return readers.keyframe_map(spark, where).select("video_id", "id", F.nanvl("pts_time", F.lit(None)).alias("pts_time"), "fps", "frame_idx")


@query(f"select video_id, id::varchar as map_id from {_MAP} group by all")
def map_ids(spark: SparkSession, root: str) -> DataFrame:
    """All columns of maps as text, with the first id column there is."""
    where = _folder(spark)
    sinks.keyframe_maps(_map(spark, root), where)
    return readers.map_rows(spark, where).select("video_id", "map_id").distinct()


@query(f"select id::varchar as id, count(*)::bigint as n from {_MAP} group by 1")
def image_id_files(spark: SparkSession, root: str) -> DataFrame:
    where = _folder(spark)
    sinks.keyframe_maps(_map(spark, root), where)
    return readers.image_ids(spark, where).groupBy("id").agg(F.count("*").alias("n"))


@query("select frame_idx as value, count(*)::bigint as n from (select distinct video_id, frame_idx from keyframe_indices) group by frame_idx")
def index_files(spark: SparkSession, root: str) -> DataFrame:
    where = _folder(spark)
    sinks.indices(table(spark, root, "keyframe_indices"), where)
    return readers.whole_numbers(spark, where).groupBy("value").agg(F.count("*").alias("n"))


@query("select distinct video_id, start_frame, end_frame from scenes")
def scene_files(spark: SparkSession, root: str) -> DataFrame:
    where = _folder(spark)
    sinks.ranges(table(spark, root, "scenes").select("video_id", "start_frame", "end_frame").distinct(), where)
    return readers.scene_ranges(spark, where).select(F.regexp_extract("path", "video_id=([^/]+)/", 1).alias("video_id"), "start_frame", "end_frame")


@query("select vec_id, substr(video_id, 1, 3) as collection, frame_idx, len(embedding)::bigint as dim from (select distinct vec_id, video_id, frame_idx, embedding from frame_embeddings)")
def vector_files(spark: SparkSession, root: str) -> DataFrame:
    where = _folder(spark)
    rows = table(spark, root, "frame_embeddings").dropDuplicates(["vec_id"]).withColumn("collection", F.substring("video_id", 1, 3))
    sinks.embeddings(rows, where)
    return spark.read.parquet(where).select("vec_id", "collection", "frame_idx", F.size("embedding").cast("bigint").alias("dim"))


@query(f"select video_id, printf('%.3f', \"start\") as \"start\", printf('%.3f', \"end\") as \"end\", count(*)::bigint as n from {_SEGMENTS} where \"start\" is not null and \"end\" is not null and text <> '' group by 1, 2, 3")
def speech_files(spark: SparkSession, root: str) -> DataFrame:
    where = _folder(spark)
    sinks.speech_csv(_segments(spark, root).where("start is not null and end is not null and text <> ''"), where)
    rows = spark.read.csv(where, header=True, schema="start string, end string, text string, video_id string", multiLine=True, escape='"')
    return rows.groupBy("video_id", "start", "end").agg(F.count("*").alias("n"))


@query(f"""
    select s.video_id, s."start", s."end", count(k.frame_idx)::bigint as n_imgs, coalesce(sum(k.frame_idx), 0)::bigint as imgs from (select *, row_number() over () as r from {_SEGMENTS} where "start" is not null) s
    left join {_MAP} k on s.video_id = k.video_id and not isnan(k.pts_time) and k.pts_time between s."start" and s."end" group by s.r, s.video_id, s."start", s."end" """)
def transcript_files(spark: SparkSession, root: str) -> DataFrame:
    """Transcripts written as JSON arrays by video and read again."""
    where = _folder(spark)
    sinks.speech_maps(transcripts.interval_join(_segments(spark, root).where("start is not null"), _map(spark, root)), where)
    rows = spark.read.text(where).select("video_id", F.explode(F.from_json("value", "array<struct<start:double,end:double,text:string,imgs:array<bigint>>>")).alias("s"))
    return rows.select("video_id", "s.start", "s.end", F.size("s.imgs").cast("bigint").alias("n_imgs"), F.aggregate("s.imgs", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("imgs"))


@query("select video_id, codec_name, width, height, nb_frames, avg_frame_rate, r_frame_rate from video_probe")
def probe_rows(spark: SparkSession, root: str) -> DataFrame:
    """Probes as the JSON text of a probing program, read again; a probe without a stream has no values."""
    fields = ["codec_name", "width", "height", "nb_frames", "avg_frame_rate", "r_frame_rate"]
    stream = F.to_json(F.struct(F.array(F.struct(*fields)).alias("streams")))
    raw = table(spark, root, "video_probe").select("video_id", F.when(F.coalesce(*(F.col(f).cast("string") for f in fields)).isNull(), F.lit("{}")).otherwise(stream).alias("probe"))
    return readers.probes(raw).drop("probe")


# --- manifests ----------------------------------------------------------------------------------------------------------


def _entries(spark: SparkSession, root: str) -> DataFrame:
    """Map rows as entries of a manifest; every seventh is dropped by its flag, and group and image come under several names."""
    i = F.col("id")
    path = F.concat("video_id", F.lit("/"), paths.ordinal_name(i), F.lit(".webp"))
    rows = _map(spark, root).select("video_id", "id").distinct()
    return rows.select(path.alias("path"), F.when(i % 2 == 0, F.col("video_id")).alias("clip_id"), F.when(i % 3 == 0, F.concat(F.lit("f"), i.cast("string"), F.lit(".webp"))).alias("frame"), i.cast("string").alias("id"), F.when(i % 7 == 0, F.lit("no")).otherwise(F.lit("keep")).alias("selected"))


_ITEMS = """
    select video_id as group_id, case when id % 3 = 0 then 'f' || id else printf('%06d', id::bigint) end as image_id, video_id || '/' || printf('%06d', id::bigint) || '.webp' as path, id::varchar as map_id
    from (select distinct video_id, id from keyframe_map) where id % 7 <> 0"""
_FIELDS = ("group_id", "image_id", "path", "map_id")


@query(_ITEMS)
def manifest_csv(spark: SparkSession, root: str) -> DataFrame:
    where = f"{_folder(spark)}/manifest.csv"
    _entries(spark, root).write.csv(where, header=True)
    return manifests.items(readers.manifest(spark, where)).select(*_FIELDS)


@query(_ITEMS)
def manifest_jsonl(spark: SparkSession, root: str) -> DataFrame:
    """JSON lines, among them lists, plain values and blank lines, which are no rows."""
    where = f"{_folder(spark)}/manifest.jsonl"
    rows = _entries(spark, root).select(F.to_json(F.struct("*")).alias("value"))
    other = spark.createDataFrame([('[{"path": "a/b.webp"}]',), ("3",), (" ",), ('"text"',), ("null",)], "value string")
    rows.unionByName(other).write.text(where)
    return manifests.items(readers.manifest(spark, where)).select(*_FIELDS)


@query(_ITEMS)
def manifest_json(spark: SparkSession, root: str) -> DataFrame:
    """An object with its rows under a known key, behind one that holds no list."""
    where = f"{_folder(spark)}/manifest.json"
    rows = _entries(spark, root).agg(F.array_join(F.collect_list(F.to_json(F.struct("*"))), ",\n").alias("all"))
    rows.select(F.concat(F.lit('{"keyframes": 3, "frames": [1, [],\n'), "all", F.lit("]}")).alias("value")).coalesce(1).write.text(where)
    return manifests.items(readers.manifest(spark, where)).select(*_FIELDS)


@query(f"select * from ({_ITEMS}) order by group_id, image_id limit 500")
def discovered_items(spark: SparkSession, root: str) -> DataFrame:
    """Every entry twice, the second with another path: the first stays; then the first 500 in order."""
    rows = _entries(spark, root)
    twice = rows.withColumn("n", F.lit(0)).unionByName(rows.withColumn("path", F.concat(F.lit("later/"), "path")).withColumn("clip_id", F.coalesce("clip_id", F.regexp_extract("path", "later/([^/]+)/", 1))).withColumn("n", F.lit(1)))
    return manifests.discover(manifests.items(twice, order="n"), 500).select(*_FIELDS)


@query("""
    select video_id as group_id, printf('%06d', id::bigint) as image_id, substr(video_id, 1, 3) || '/' || video_id || '/' || printf('%06d', id::bigint) || case when id % 2 = 0 then '.webp' else '.jpg' end as path, id::varchar as map_id, 'kf_embedding' as source
    from (select distinct video_id, id from keyframe_map)
    union all select distinct video_id, 'cover', substr(video_id, 1, 3) || '/' || video_id || '/cover.png', '', 'directory' from scenes where video_id like '%7'
        and video_id not in (select video_id from keyframe_map)
    union all select 'nomap', 'a', 'K00/nomap/a.png', '', 'directory'""")
def mapped_images(spark: SparkSession, root: str) -> DataFrame:
    """Images by the maps of their videos; of a video without a map all images."""
    maps = _map(spark, root).select(F.substring("video_id", 1, 3).alias("subfolder"), "video_id", F.col("id").cast("string").alias("map_id"), F.col("id").alias("row"))
    place = F.concat(F.substring("video_id", 1, 3), F.lit("/"), "video_id", F.lit("/"))
    name = paths.ordinal_name(F.col("map_id").cast("int"))
    images = maps.select("subfolder", "video_id", F.concat(place, name, F.when(F.col("map_id").cast("int") % 2 == 0, F.lit(".webp")).otherwise(F.lit(".jpg"))).alias("path"))
    later = maps.where("map_id % 2 = 0").select("subfolder", "video_id", F.concat(place, name, F.lit(".bmp")).alias("path"))  # webp goes first
    vids = table(spark, root, "scenes").select("video_id").where("video_id like '%7'").distinct().join(maps.select("video_id").distinct(), "video_id", "left_anti")
    covers = vids.select(F.substring("video_id", 1, 3).alias("subfolder"), "video_id", F.concat(place, F.lit("cover.png")).alias("path"))
    bare = spark.createDataFrame([("K00", "nomap", "K00/nomap/a.png"), ("K00", "nomap", "K00/nomap/a.txt")], "subfolder string, video_id string, path string")
    found = manifests.from_maps(images.unionByName(later).unionByName(covers).unionByName(bare), maps, allow_missing_map=True)
    return found.select("group_id", "image_id", "path", "map_id", "source").distinct()


@query(f"select distinct split_part(rel_path, '/', -1) as name, regexp_replace(rel_path, '/?[^/]*$', '') as below, split_part(regexp_replace('/' || rel_path, '/?[^/]*$', ''), '/', -1) as elsewhere from {_VIDEOS}")
def image_groups(spark: SparkSession, root: str) -> DataFrame:
    """The group of an image below a root, and of one elsewhere."""
    rel = F.col("rel_path")
    name = F.element_at(paths.parts(rel), -1)
    return _videos(spark, root).select(name.alias("name"), manifests.group_of(F.concat(F.lit("/data/root/"), rel), "/data/root/").alias("below"), manifests.group_of(F.concat(F.lit("/"), rel), "/data/root").alias("elsewhere")).distinct()


@query("select k.video_id, k.id, p.codec_name from (select distinct video_id, id from keyframe_map) k join video_probe p using (video_id)")
def strict_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Map rows with the probes of their videos; one without a probe would be an error."""
    rows = _map(spark, root).select("video_id", "id").distinct()
    return manifests.strict_join(catalog.require(rows, F.col("id") >= 0, "an id is negative"), table(spark, root, "video_probe").select("video_id", "codec_name"), ["video_id"], "a video has no probe")


@query(f"select v.video_id, case when v.video_id in (select video_id from keyframe_map) then 'nested/' || video_id else 'plain/' || video_id end as path from (select distinct video_id from {_VIDEOS}) v")
def fallback_paths(spark: SparkSession, root: str) -> DataFrame:
    """The path of a map in its own folder, or the usual one."""
    vids = _videos(spark, root).select("video_id").distinct()
    nested = table(spark, root, "keyframe_map").select("video_id").distinct().withColumn("path", F.concat(F.lit("nested/"), "video_id"))
    return catalog.fallback(vids, nested, vids.withColumn("path", F.concat(F.lit("plain/"), "video_id")), ["video_id"], "path")


@query(f"select video_id, rel_path from (select video_id, rel_path, row_number() over (order by string_split(rel_path, '/'), video_id) as n from {_VIDEOS}) where n <= 20 and (n - 1) % 2 = 0")
def limited_shard(spark: SparkSession, root: str) -> DataFrame:
    """The limit is taken before the shards."""
    return catalog.shard(_videos(spark, root).select("video_id", "rel_path"), [paths.parts(F.col("rel_path")), "video_id"], 2, 0, limit=20).drop("position")


@query("select count(*)::bigint as n_rows, count(case when text is null or trim(text) = '' then 1 end)::bigint as blank, count(case when lang = 'en' then 1 end)::bigint as english from documents")
def run_counters(spark: SparkSession, root: str) -> DataFrame:
    """Counts taken while a table is written, without a pass of their own."""
    rows, seen = catalog.counted(table(spark, root, "documents"), f"counters-{uuid.uuid4().hex}", blank=F.coalesce(F.trim("text") == "", F.lit(True)), english=F.col("lang") == "en")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(int(seen.get[k]) for k in ("n_rows", "blank", "english"))], "n_rows bigint, blank bigint, english bigint")


@query("""
    with r as (select distinct video_id, seg_no::bigint as scene_id, floor("start" * 25)::bigint as start_frame, floor("end" * 25)::bigint as end_frame from asr_segments where "start" is not null and "end" is not null and video_id is not null)
    select * from r union all select video_id, 0, 0, n - 1 from (select video_id, case when regexp_matches(nb_frames, '^[0-9]+$') then nb_frames::bigint end as n from video_probe)
        where n > 0 and video_id not in (select video_id from r)""")
def whole_videos(spark: SparkSession, root: str) -> DataFrame:
    """Speech as ranges of frames; a video without any is one range if its length is known."""
    at = lambda c: F.floor(F.col(c) * 25).alias(f"{c}_frame")
    rows = _segments(spark, root).where("start is not null and end is not null and video_id is not null").select("video_id", long("seg_no").alias("scene_id"), at("start"), at("end")).distinct()
    count = table(spark, root, "video_probe").select("video_id", values.frame_count(F.col("nb_frames")).alias("frame_count"))
    return scenes.whole_video(rows, count)


# --- text of images -----------------------------------------------------------------------------------------------------


def _pages(spark: SparkSession, root: str) -> DataFrame:
    """Documents as images of a video, their lines as recognised lines, some of them unsure."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda t, i: F.struct(t.alias("text"), F.when(i % 3 == 0, F.lit(0.9)).when(i % 3 == 1, F.lit(0.5)).alias("confidence")))
    name = F.format_string("%08d", "doc_id")
    path = F.concat("video_id", F.lit("/"), name, F.lit(".webp"))
    return spread(table(spark, root, "documents").where("video_id is not null").select("doc_id", "video_id", "text")).select(F.col("video_id").alias("group_id"), name.alias("image_id"), F.col("doc_id").cast("string").alias("map_id"), F.lit("").alias("subfolder"), path.alias("path"), path.alias("original_path"), F.lit("").alias("preprocessed_path"), F.lit(1.5).alias("latency_ms"), lines.alias("lines"))


_READ = f"""
    lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents where video_id is not null),
    clean as (select doc_id, place, {_CLEAN.format("line")} as line from lines),
    sure as (select *, row_number() over (partition by doc_id, lower(line) order by place) as n from clean where line <> '' and place % 3 <> 2),
    pages as (select d.doc_id, d.video_id, (select count(*) from clean c where c.doc_id = d.doc_id and c.line <> '') as n_all, coalesce((select string_agg(line, chr(10) order by place) from sure s where s.doc_id = d.doc_id and n = 1), '') as text,
        (select count(*) from sure s where s.doc_id = d.doc_id and n = 1) as n_lines from documents d where video_id is not null)"""


@query(f"with {_READ} select video_id as group_id, printf('%08d', doc_id) as image_id, printf('%08d', doc_id) as idx, doc_id::varchar as map_id, n_lines::int as line_count, n_all::bigint as n_all, md5(text) as text_md5 from pages")
def prediction_records(spark: SparkSession, root: str) -> DataFrame:
    return ocr.predictions(_pages(spark, root)).select("group_id", "image_id", "idx", "map_id", "line_count", F.size("all_lines").cast("bigint").alias("n_all"), F.md5("text").alias("text_md5"))


@query(f"with {_READ} select video_id as group_id, printf('%08d', doc_id) as image_id, n_lines::int as line_count, md5(text) as text_md5 from pages")
def prediction_table(spark: SparkSession, root: str) -> DataFrame:
    """The CSV of predictions, written and read again; it has the 13 plain fields in order."""
    where = _folder(spark)
    sinks.predictions(cut(ocr.predictions(_pages(spark, root)), "records"), where, by_group=False)
    rows = spark.read.csv(f"{where}/ocr_predictions", header=True, escape='"', multiLine=True)
    checked = catalog.require(rows, F.lit(tuple(rows.columns) == ocr.ROW_FIELDS), "the fields of the table differ")
    return checked.select("group_id", "image_id", F.col("line_count").cast("int").alias("line_count"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query(f"""
    with {_READ} select video_id as group_id, count(*)::bigint as n_records, md5(string_agg(printf('%08d', doc_id) || ':' || doc_id || ':' || video_id || '/' || printf('%08d', doc_id) || '.webp:' || n_lines || ':' || text || ':' || n_all, chr(10) order by doc_id)) as records_md5
    from pages group by video_id""")
def group_records(spark: SparkSession, root: str) -> DataFrame:
    """The JSON files of groups, written and read again: records in order of image ids, with their 11 fields."""
    where = _folder(spark)
    sinks.predictions(cut(ocr.predictions(_pages(spark, root)), "records"), where)
    line = "struct<text:string,confidence:double>"
    kind = f"array<struct<idx:string,image_id:string,frame_id:string,map_id:string,subfolder:string,path:string,preprocessed_path:string,text:array<string>,text_joined:string,latency_ms:double,all_lines:array<{line}>>>"
    rows = spark.read.text(f"{where}/groups").select(F.col("file").alias("group_id"), F.from_json("value", kind).alias("r"))
    told = F.transform("r", lambda x: F.concat_ws(":", x["frame_id"], x["map_id"], x["path"], F.size(x["text"]).cast("string"), x["text_joined"], F.size(x["all_lines"]).cast("string")))
    return rows.select("group_id", F.size("r").cast("bigint").alias("n_records"), F.md5(F.array_join(told, "\n")).alias("records_md5"))


@query("""
    select l_orderkey, least(count(*), 3)::bigint as n_lines, array_to_string(list_transform(range(1, least(count(*), 3) + 1), lambda i: 't' || i), ',') as texts from lineitem group by l_orderkey""")
def recognised_lines(spark: SparkSession, root: str) -> DataFrame:
    """Boxes of an order and three recognised texts, by place, as many as there are of both."""
    box = F.struct(geometry.rectangle(F.lit(0), F.lit(0), F.col("l_quantity"), F.lit(9)).alias("box"), F.lit(0.8).alias("det_confidence"))
    boxes = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.collect_list(box).alias("boxes"))
    texts = F.array(*(F.struct(F.lit(f"t{i}").alias("text"), F.lit(0.9).alias("confidence")) for i in (1, 2, 3)))
    found = boxes.select("l_orderkey", ocr.recognised(F.col("boxes"), texts).alias("lines"))
    return found.select("l_orderkey", F.size("lines").cast("bigint").alias("n_lines"), F.array_join(F.transform("lines", lambda x: x["text"]), ",").alias("texts"))


@query("""
    select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then a || ',' || b || ',' || c || ',' || b || ',' || c || ',' || d || ',' || a || ',' || d when l_linenumber % 3 = 1 then a || ',' || b || ',' || c || ',' || d || ',' || a || ',' || d || ',' || c || ',' || b else '' end as corners
    from (select l_orderkey, l_linenumber, (l_partkey % 50)::bigint::varchar as a, (l_suppkey % 40)::bigint::varchar as b, (l_partkey % 50 + 10)::bigint::varchar as c, (l_suppkey % 40 + 20)::bigint::varchar as d from lineitem)""")
def box_forms(spark: SparkSession, root: str) -> DataFrame:
    """Corners from four numbers, from eight, and from a number of them that makes no box."""
    a, b = F.col("l_partkey") % 50, F.col("l_suppkey") % 40
    c, d = a + 10, b + 20
    numbers = F.when(F.col("l_linenumber") % 3 == 0, F.array(a, b, c, d)).when(F.col("l_linenumber") % 3 == 1, F.array(a, b, c, d, a, d, c, b)).otherwise(F.array(a, b, c))
    box = geometry.from_numbers(numbers)
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(F.when(box.isNotNull(), geometry.rounded_key(box)), F.lit("")).alias("corners"))


@query("select l_orderkey, count(case when l_linenumber % 4 <> 0 then 1 end)::bigint as n_boxes, count(case when l_linenumber % 4 <> 0 then 1 end)::bigint as n_crops from lineitem group by l_orderkey")
def full_crops(spark: SparkSession, root: str) -> DataFrame:
    """Boxes and crops without those crops that are null or have no area."""
    n = F.col("l_linenumber")
    crop = F.when(n % 8 != 0, F.struct(F.when(n % 4 == 0, 0).otherwise(n).alias("width"), F.lit(5).alias("height")))
    rows = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(n.alias("n"), F.coalesce(crop, F.struct(F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"))).alias("crop"))).alias("r"))
    boxes, crops = media.full_crops(F.transform("r", lambda x: x["n"]), F.transform("r", lambda x: x["crop"]))
    return rows.select("l_orderkey", F.size(boxes).cast("bigint").alias("n_boxes"), F.size(crops).cast("bigint").alias("n_crops"))


@query("""
    select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then null when l_linenumber % 3 = 1 then l_tax else null end as number, case when l_linenumber < 4 then [0.1::double, 0.2, 0.3][l_linenumber] end as score, 0.5::double as shared from lineitem""")
def loose_numbers(spark: SparkSession, root: str) -> DataFrame:
    """Numbers from text that may be none, the score at a place of a list, and the one score for all."""
    n = F.col("l_linenumber")
    text = F.when(n % 3 == 0, F.lit("n/a")).when(n % 3 == 1, F.concat(F.lit(" "), F.col("l_tax").cast("string")))
    scores, none = F.array(F.lit(0.1), F.lit(0.2), F.lit(0.3)), F.lit(None).cast("array<double>")
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", values.to_float(text).alias("number"), values.score_at(scores, F.lit(None).cast("double"), n - 1).alias("score"), values.score_at(none, F.lit(0.5), n - 1).alias("shared"))


@query("select video_id, (len(video_id) * 2) || 'M' as rate, 'vit_h14,small' as models, 6::bigint as resize, 4::bigint as save, 3::bigint as speech from (select distinct video_id from file_list)")
def settings(spark: SparkSession, root: str) -> DataFrame:
    """Doubled bit rates, model names by alias, and workers for each kind of step."""
    names = values.model_names(F.array(F.lit("ViT H14"), F.lit(" small "), F.lit("vit"), F.lit("")), {"vit": "vit_h14"})
    workers = {k: F.lit(values.workers(k, 8, 24.0)).cast("bigint") for k in ("resize", "save", "speech")}
    rows = _videos(spark, root).select("video_id").distinct()
    return rows.select("video_id", values.double_bitrate(F.concat(F.length("video_id").cast("string"), F.lit("M"))).alias("rate"), F.array_join(names, ",").alias("models"), *(v.alias(k) for k, v in workers.items()))


# --- backends -----------------------------------------------------------------------------------------------------------


class _Fussy:
    """Does rows of one collection, fails for the others, after half of the work for some."""

    name = "fussy"

    def __call__(self, row: dict) -> list[dict]:
        if not row["video_id"].startswith("K0"):
            raise ValueError("not mine")
        return [{"n": 1}, {"n": 2}]


class _Picky:
    name = "picky"

    def __call__(self, row: dict) -> list[dict]:
        if row["video_id"].startswith("K1"):
            raise ValueError("not mine either")
        return [{"n": 3}]


_CHAIN = """
    select video_id, n, case when video_id like 'K0%' then 'fussy' when video_id not like 'K1%' then 'picky' end as backend, case when video_id like 'K1%' then 'failed' else 'ok' end as status,
        case when video_id like 'K1%' then 'picky: not mine either' end as error
    from (select distinct video_id, unnest(case when video_id like 'K0%' then [1, 2] when video_id like 'K1%' then [null] else [3] end)::int as n from file_list)"""


def _chained(spark: SparkSession, root: str) -> DataFrame:
    return backends.run(_videos(spark, root).select("video_id").distinct(), ["fussy", "picky"], "n int", ["video_id"], {"fussy": _Fussy, "picky": _Picky})


@query(_CHAIN)
def backend_chain(spark: SparkSession, root: str) -> DataFrame:
    """Each video through the first backend that does it; those that none does are rows with an error."""
    return _chained(spark, root)


@query(f"select video_id, n, backend from ({_CHAIN}) where status = 'ok'")
def backend_successes(spark: SparkSession, root: str) -> DataFrame:
    return backends.succeeded(_chained(spark, root), some=True)


@query("""
    select video_id, case when lower(codec_name) in ('h264', 'hevc', 'av1') then lower(codec_name) || '_cuvid' else '' end as decoder,
        case when lower(codec_name) = 'av1' then 'ffmpeg_hardware,ffmpeg,pyav' when lower(codec_name) in ('h264', 'hevc', 'mpeg4', 'vp9', 'vp8') then 'ffmpeg_hardware,ffmpeg,opencv,pyav' else 'ffmpeg,opencv,pyav' end as chain
    from video_probe""")
def decoder_choice(spark: SparkSession, root: str) -> DataFrame:
    """Which decoders are tried for a video, by its codec and what the program says it has."""
    listing = "Decoders:\n V..... = Video\n ------\n V....D h264_cuvid  Nvidia\n V....D hevc_cuvid  Nvidia\n V....D av1_cuvid  Nvidia\n A....D aac  AAC\n"
    there = media.decoders(listing)
    known = dict.fromkeys(("ffmpeg_hardware", "ffmpeg", "opencv", "pyav"))
    codecs = [r[0] for r in table(spark, root, "video_probe").select(values.codec(F.col("codec_name")).alias("codec")).distinct().collect()]  # the different codecs
    plan = spark.createDataFrame([(c, media.hardware_decoder(c, there) or "", ",".join(backends.chain_for(c, known))) for c in codecs], "codec string, decoder string, chain string")
    return table(spark, root, "video_probe").select("video_id", values.codec(F.col("codec_name")).alias("codec")).join(F.broadcast(plan), "codec").select("video_id", "decoder", "chain")


@query("select vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 4) as before, 1.0::double as after from embeddings")
def batch_encode(spark: SparkSession, root: str) -> DataFrame:
    """A model that takes many rows at once; what it gives is scaled to length one."""
    rows = table(spark, root, "embeddings").select("vec_id", "label", "embedding", F.col("embedding").alias("pixels"))
    done = backends.run_batches(rows, lambda: lambda x: x[:, ::-1] * np.float32(3), "pixels", 64, out="made", size=50, half=False)
    size = lambda c: F.round(F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), 4)
    return done.select("vec_id", "label", size("embedding").alias("before"), size("made").alias("after"))


@query("""
    select s_suppkey, round((s_suppkey % 256 / 255.0::double - 0.48145466) / 0.26862954, 4) as red, round((s_nationkey / 255.0::double - 0.4578275) / 0.26130258, 4) as green, round((7 / 255.0::double - 0.40821073) / 0.27577711, 4) as blue from supplier""")
def pixel_values(spark: SparkSession, root: str) -> DataFrame:
    """Images of two equal points, normalised; colours come first."""
    byte = lambda c: F.unhex(F.lpad(F.hex(c), 2, "0"))
    point = F.concat(byte((F.col("s_suppkey") % 256).cast("bigint")), byte(F.col("s_nationkey").cast("bigint")), byte(F.lit(7).cast("bigint")))
    rows = table(spark, root, "supplier").select("s_suppkey", F.concat(point, point).alias("pixels"))
    at = lambda i: F.round(F.get("values", F.lit(i)).cast("double"), 4)
    return media.normalised_columns(rows, "pixels", 1, 2).select("s_suppkey", at(0).alias("red"), at(3).alias("green"), at(4).alias("blue"))


@query("select n_nationkey || '/' || n_name || '.png' as rel_path, 'images' as backend from nation")
def image_files(spark: SparkSession, root: str) -> DataFrame:
    """Images written as PNG files and found again."""
    where = _folder(spark)
    rel = F.concat(F.col("n_nationkey").cast("string"), F.lit("/"), "n_name", F.lit(".png"))
    rows = table(spark, root, "nation").select(F.concat(F.lit(f"{where}/"), rel).alias("path"), F.unhex(F.repeat(F.lit("0a3040"), 12)).alias("pixels"), F.lit(4).alias("width"), F.lit(3).alias("height"))
    done = media.write_images(rows).select(F.substring("path", len(where) + 2, 1 << 30).alias("rel_path"), "backend")
    kept = cut(done, "written")
    return readers.tree(spark, where, ("png",)).select("rel_path").join(kept, "rel_path")


def _grey_images(spark: SparkSession, root: str) -> DataFrame:
    """A small image of one lightness for each supplier, of many sizes."""
    n = F.col("s_suppkey")
    width, height = (n % 9 + 2).cast("int"), (n % 5 + 1).cast("int")
    pixel = F.repeat(F.lpad(F.hex((n * 37 % 256).cast("bigint")), 2, "0"), 3)
    return table(spark, root, "supplier").select("s_suppkey", "s_nationkey", F.unhex(F.repeat(pixel, (width * height).cast("int"))).alias("pixels"), width.alias("width"), height.alias("height"))


@query("select s_suppkey, trunc((s_suppkey % 9 + 2) * (18.0::double / (s_suppkey % 5 + 1)))::int as width, 18::int as height, (s_suppkey * 37 % 256)::int as first from supplier")
def image_heights(spark: SparkSession, root: str) -> DataFrame:
    """Images at another height, the width in proportion."""
    made = images.at_height(_grey_images(spark, root), 18)
    return made.select("s_suppkey", "width", "height", F.conv(F.hex(F.substring("pixels", 1, 1)), 16, 10).cast("int").alias("first"))


@query("""
    select s_suppkey, greatest(1, round_even(w * s, 0))::int as width, greatest(1, round_even(h * s, 0))::int as height from (
        select *, case when greatest(w, h) > 30 then 30.0::double / greatest(w, h) when least(w, h) < 4 then least(4.0::double / least(w, h), 30.0::double / greatest(w, h)) else 1.0::double end as s
        from (select s_suppkey, (s_suppkey % 9 + 2)::bigint as w, (s_suppkey % 5 + 1)::bigint as h from supplier))""")
def ready_images(spark: SparkSession, root: str) -> DataFrame:
    """Images made ready for recognition: sides within bounds, then tones."""
    return images.ready(_grey_images(spark, root), images.Preparation(30, 4, grey=True)).select("s_suppkey", "width", "height")


@query("select s_suppkey, 0::int as line_index, 48::int as height, greatest(1, round_even((greatest(1, s_suppkey % 9 + 1) + 8) * 48.0::double / (greatest(1, s_suppkey % 5) + 8), 0))::int as width from supplier where greatest(1, s_suppkey % 5)::double / greatest(1, s_suppkey % 9 + 1) < 1.5 union all select s_suppkey, 0, 48, greatest(1, round_even((greatest(1, s_suppkey % 5) + 8) * 48.0::double / (greatest(1, s_suppkey % 9 + 1) + 8), 0))::int from supplier where greatest(1, s_suppkey % 5)::double / greatest(1, s_suppkey % 9 + 1) >= 1.5")
def image_crops(spark: SparkSession, root: str) -> DataFrame:
    """The box around all of an image as a crop for a recogniser of lines: turned if it is high, of one height."""
    rows = _grey_images(spark, root)
    box = F.array(geometry.rectangle(F.lit(0), F.lit(0), F.col("width") - 1, F.col("height") - 1))
    return images.crops(rows.withColumn("corners", box), ["s_suppkey"]).select("s_suppkey", "line_index", "height", "width")


@query("""
    select s_nationkey::int as s_nationkey, s_suppkey, round(case when same then abs(v - before) / 3.0::double else 0 end, 6) as score from (
        select s_nationkey, s_suppkey, s_suppkey * 37 % 256 as v, lag(s_suppkey * 37 % 256) over w as before, coalesce(lag(s_suppkey % 45) over w = s_suppkey % 45, false) as same from supplier window w as (partition by s_nationkey order by s_suppkey))""")
def frame_scores(spark: SparkSession, root: str) -> DataFrame:
    """How much an image differs from the one before it, nations as videos; images of another size are not compared."""
    found = images.content_scores(_grey_images(spark, root), "s_nationkey", "s_suppkey")
    return found.select("s_nationkey", "s_suppkey", F.round("score", 6).alias("score"))


@query("select 'there' as name, true as found union all select 'never', false")
def arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Waiting for a file that is there, and in vain for one that is not."""
    rows = [(name, incremental.wait_for(lambda p=path: readers.exists(spark, p), timeout=0.2, every=0.1)) for name, path in (("there", f"{root}/nation.parquet"), ("never", f"{root}/no-such.parquet"))]
    return spark.createDataFrame(rows, "name string, found boolean")


# --- whole jobs ---------------------------------------------------------------------------------------------------------


def _rated(spark: SparkSession, root: str) -> DataFrame:
    """Videos with rate and length."""
    fps = values.video_fps(F.col("codec_name"), F.lit(None).cast("double"), F.col("avg_frame_rate"), F.col("r_frame_rate"))
    probes = table(spark, root, "video_probe").select("video_id", fps.alias("fps"), values.frame_count(F.col("nb_frames")).alias("frame_count"))
    return _videos(spark, root).select("video_id", "rel_path").dropDuplicates(["video_id"]).join(probes, "video_id", "left")


_JOB = f"""
    with f as (select distinct video_id, frame_idx::bigint as f, embedding::double[] as v from frame_embeddings where {_USABLE.format("embedding", 64)} and video_id in (select video_id from file_list)),
    whole as (select distinct video_id, frame_idx::bigint as f from frame_embeddings where video_id in (select video_id from file_list)),
    p as (select video_id, case when {_FPS.format("avg_frame_rate")} > 0 then {_FPS.format("avg_frame_rate")} else {_FPS.format("r_frame_rate")} end as fps,
        case when regexp_matches(nb_frames, '^[0-9]+$') then nb_frames::bigint end as n from video_probe),
    cuts as (select video_id, min(f) as a from whole group by video_id, f // 600),
    ends as (select video_id, a, coalesce(lead(a) over (partition by video_id order by a) - 1, (select max(f) from whole w where w.video_id = c.video_id)) as b from cuts c),
    s as (select e.video_id, a, greatest(a, case when n > 0 then least(b, n - 1) else b end) as b from ends e left join p using (video_id)),
    reach as (select video_id, min(f) as low, max(f) as high from f group by video_id),
    t as (select video_id, a, b, greatest(a, low) as a2, least(b, high) as b2 from s join reach using (video_id)),
    i as (select t.*, f.f, f.v, case when b2 - a2 + 1 > 512 then (f.f - a2) // 256 else -1 end as block from t join f on f.video_id = t.video_id and f.f between a2 and b2),
    m as (select video_id, a, block, d, avg(v[d]) as m from i, unnest(generate_series(1, 64)) as u(d) group by video_id, a, block, d),
    c as (select video_id, a, block, list(m order by d) as c from m group by video_id, a, block)"""


@query(f"""{_JOB},
    k as (select distinct video_id, f from (select i.video_id, i.f, row_number() over (partition by i.video_id, i.a, i.block order by round(list_distance(i.v, c.c) ** 2, 12), i.f) as n from i join c using (video_id, a, block) where block >= 0) where n = 1)
    select count(*)::bigint as n_blocks_found, count(distinct video_id)::bigint as n_videos, sum(f)::bigint as frames from k""")
def job_keyframes(spark: SparkSession, root: str) -> DataFrame:
    """The whole job over all videos, cut every 600 frames; of its keyframes those of scenes of more than 512 frames, one for each
    block of 256, are counted and summed up."""
    store = pipelines.Store(spark, f"{_folder(spark)}/store")
    frames = table(spark, root, "frame_embeddings").select("video_id", long("frame_idx").alias("frame_idx"), "embedding")
    once = frames.select("video_id", "frame_idx").distinct()
    first = once.groupBy("video_id", F.floor(F.col("frame_idx") / 600).alias("part")).agg(F.min("frame_idx").alias("frame_idx")).withColumn("score", F.lit(30.0))
    scores = once.join(first.drop("part"), ["video_id", "frame_idx"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    vids = _rated(spark, root)
    of = lambda rows: lambda new: rows.join(new.select("video_id"), "video_id", "left_semi")
    found = pipelines.extract_keyframes(spark, vids, store, of(frames), of(scores))
    again = pipelines.extract_keyframes(spark, vids, store, _refuse, _refuse)  # nothing is left to do
    usable = cut(_reach(frames), "reach")
    t = store.read("scenes").join(usable, "video_id").select("video_id", F.greatest("start_frame", "low").alias("a"), F.least("end_frame", "high").alias("b")).where("b - a + 1 > 512")
    inside = again.join(found.select("video_id", "frame_idx"), ["video_id", "frame_idx"]).join(t, "video_id").where("frame_idx between a and b")
    return inside.select("video_id", "frame_idx").distinct().agg(F.count("*").alias("n_blocks_found"), F.countDistinct("video_id").alias("n_videos"), F.sum("frame_idx").alias("frames"))


def _reach(frames: DataFrame) -> DataFrame:
    """First and last usable frame of each video."""
    return frames.where(vectors.usable(F.col("embedding"), 64)).groupBy("video_id").agg(F.min("frame_idx").alias("low"), F.max("frame_idx").alias("high"))


def _refuse(new: DataFrame) -> DataFrame:
    """A step that must have nothing to do."""
    none = catalog.require(new, F.lit(False), "this was done before")
    return none.select("video_id", F.lit(0).cast("bigint").alias("frame_idx"), F.lit(0.0).alias("score"), F.array(F.lit(0.0).cast("float")).alias("embedding"))


@query(f"""
    with {_READ}, items as (select doc_id, video_id, text, n_lines from pages)
    select video_id as group_id, count(*)::bigint as n, sum(n_lines)::bigint as n_lines, md5(string_agg(md5(text), ',' order by doc_id)) as texts from items group by video_id""")
def job_text(spark: SparkSession, root: str) -> DataFrame:
    """The whole job from images to text: discovery by layout, recognition by a stand-in that knows the documents, and all outputs."""
    out = _folder(spark)
    read = _pages(spark, root)
    items = manifests.discover(read.select("group_id", "image_id", "path", "map_id", "subfolder", F.lit("").alias("source"), F.col("path").alias("seq")))
    known = cut(read.select("group_id", "image_id", "lines", "latency_ms"), "known")
    recognise = lambda asked: asked.select("group_id", "image_id").join(known, ["group_id", "image_id"])
    pipelines.read_text(items, recognise, out, models=("Stand In", "stand_in"))
    pipelines.read_text(items, _refuse, out, models=("stand_in",))  # its predictions are there, so it is not asked
    rows = spark.read.json(f"{out}/predictions")
    return rows.groupBy("group_id").agg(F.count("*").alias("n"), F.sum("line_count").alias("n_lines"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("image_id", "text"))), lambda r: F.md5(r["text"])), ",")).alias("texts"))


@query(f"""
    with kept as (select * from {_SEGMENTS} where length({_STRIP.format("text")}) >= 3 and seg_no % 5 <> 0 and video_id not like '%3')
    select s.video_id, s.seg_no, s."start", s."end", count(k.frame_idx)::bigint as n_imgs from kept s left join {_MAP} k on s.video_id = k.video_id and not isnan(k.pts_time) and k.pts_time between s."start" and s."end"
    where s.video_id in (select video_id from keyframe_map) group by s.video_id, s.seg_no, s."start", s."end", s.text""")
def job_speech(spark: SparkSession, root: str) -> DataFrame:
    """The whole job from videos to transcripts: extraction that fails for some, recognition by a stand-in, filter and alignment."""

    class Extractor:
        name = "sound"

        def __call__(self, row: dict) -> list[dict]:
            if row["video_id"].endswith("3"):
                raise ValueError("no sound")
            return [{"wav": f"{row['video_id']}.wav"}]

    vids = table(spark, root, "asr_segments").select("video_id").dropna().distinct()
    extract = lambda v: backends.run(v, ["sound"], "wav string", ["video_id"], {"sound": Extractor})
    silent = F.when(F.col("seg_no") % 5 == 0, F.lit(0.9))
    heard = _segments(spark, root).withColumn("avg_logprob", F.lit(None).cast("double")).withColumn("no_speech_prob", silent)
    aligned = pipelines.transcribe(vids, lambda v: heard.join(v.select("video_id"), "video_id", "left_semi"), _map(spark, root), _folder(spark), extract)
    return aligned.select("video_id", "seg_no", "start", "end", F.size("imgs").cast("bigint").alias("n_imgs"))


@query("select distinct video_id, frame_idx::bigint as frame_idx from frame_embeddings where frame_idx % 48 = 0")
def sampled_frames(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "frame_embeddings").select("video_id", long("frame_idx").alias("frame_idx"))
    return pipelines.sampled(rows, 48).distinct()

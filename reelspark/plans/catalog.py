"""The queries over the project's tables, with the SQL each is checked against.

Each query runs an operator of the library over whole tables. Lists are given as joined text or counts, and numbers are cast,
so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import backends
from reelspark.functions import geometry, packed, paths, values, vectors
from reelspark.operators import catalog, keyframes, manifests, ocr, scenes, transcripts
from reelspark.runtime import scratch, spread, table
from reelspark.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL if SQL can express it."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _segments(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "asr_segments").select("video_id", "seg_no", "start", "end", "text").distinct()


def _map(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "keyframe_map").select("video_id", "id", "pts_time", "fps", "frame_idx").distinct()


_SEGMENTS = """(select distinct video_id, seg_no, "start", "end", text from asr_segments)"""
_MAP = "(select distinct video_id, id, pts_time, fps, frame_idx from keyframe_map)"
_VIDEOS = "(select distinct video_id, collection, rel_path from file_list)"
_FPS = """case when {0} is null or {0} = '' then 0.0 when contains({0}, '/') then case when split_part({0}, '/', 2)::double = 0 then 0.0
    else split_part({0}, '/', 1)::double / split_part({0}, '/', 2)::double end else {0}::double end"""
_USABLE = """coalesce(len({0}) = {1} and len(list_filter({0}, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter({0}, lambda x: x <> 0)) > 0, false)"""
_STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\x{{b}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ''), '[\s\x{{b}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '')"
_CLEAN = r"trim(regexp_replace(regexp_replace({0}, '[\x00-\x08\x0b-\x1f\x7f]', ' ', 'g'), '[\s\x{{b}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"
_REPLACED = r"regexp_replace({0}, '([^/])\.[^./]+$', '\1')"


# --- speech -------------------------------------------------------------------------------------------------------------


@query(f"""
    select s.video_id, s.seg_no, count(k.frame_idx)::bigint as n_imgs,
        coalesce(string_agg(k.frame_idx::varchar, ',' order by k.pts_time, k.frame_idx), '') as imgs
    from {_SEGMENTS} s left join {_MAP} k on s.video_id = k.video_id and not isnan(k.pts_time) and k.pts_time between s."start" and s."end"
    group by s.video_id, s.seg_no, s."start", s."end" """)
def interval_join(spark: SparkSession, root: str) -> DataFrame:
    found = transcripts.interval_join(_segments(spark, root), _map(spark, root))
    return found.select("video_id", "seg_no", F.size("imgs").cast("bigint").alias("n_imgs"), F.array_join(F.transform("imgs", lambda x: x.cast("string")), ",").alias("imgs"))


@query(f"""
    select video_id, seg_no from {_SEGMENTS}
    where length({_STRIP.format("text")}) >= 3
      and (seg_no % 7 = 0 or -(seg_no % 20) / 10.0::double >= -1.2) and (seg_no % 5 = 0 or (seg_no % 11) / 10.0::double <= 0.65)""")
def segment_filter(spark: SparkSession, root: str) -> DataFrame:
    """Segments that are kept, with scores made up from their numbers, some unknown."""
    n = F.col("seg_no")
    logprob = F.when(n % 7 != 0, -(n % 20) / F.lit(10.0))
    silent = F.when(n % 5 != 0, (n % 11) / F.lit(10.0))
    return _segments(spark, root).where(transcripts.spoken(F.col("text"), logprob, silent)).select("video_id", "seg_no")


@query(f"""select video_id, seg_no, printf('%.3f', "start") as "start", printf('%.3f', "end") as "end" from {_SEGMENTS}
    where "start" is not null and "end" is not null""")
def speech_rows(spark: SparkSession, root: str) -> DataFrame:
    return transcripts.csv_rows(_segments(spark, root).where("start is not null and end is not null")).select("video_id", "seg_no", "start", "end")


@query(f"""
    select video_id, coalesce(floor("start" / 60)::bigint, -999) as chunk, count(*)::bigint as n_segments, sum(n)::bigint as n_imgs from (
        select s.video_id, s.seg_no, s."start", count(k.frame_idx) as n
        from {_SEGMENTS} s left join {_MAP} k on s.video_id = k.video_id and not isnan(k.pts_time) and k.pts_time between s."start" and s."end"
        group by s.video_id, s.seg_no, s."start", s."end", s.text) group by all""")
def transcript_records(spark: SparkSession, root: str) -> DataFrame:
    found = transcripts.transcripts(transcripts.interval_join(_segments(spark, root), _map(spark, root)), chunk_seconds=60.0)
    images = F.aggregate("segments", F.lit(0).cast("bigint"), lambda a, s: a + F.size(s["imgs"]))
    return found.select("video_id", F.coalesce("chunk", F.lit(-999)).alias("chunk"), F.size("segments").cast("bigint").alias("n_segments"), images.alias("n_imgs"))


# --- text ---------------------------------------------------------------------------------------------------------------


@query(f"select doc_id, md5({_CLEAN.format('text')}) as clean_md5 from documents")
def clean_text(spark: SparkSession, root: str) -> DataFrame:
    return spread(table(spark, root, "documents").select("doc_id", "text")).select("doc_id", F.md5(values.clean_text(F.col("text"))).alias("clean_md5"))


@query(f"""
    with lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents),
    clean as (select doc_id, place, {_CLEAN.format("line")} as line from lines),
    kept as (select *, row_number() over (partition by doc_id, lower(line) order by place) as n from clean where line <> '')
    select d.doc_id, count(k.line)::bigint as n_lines, count(case when n = 1 then 1 end)::bigint as n_kept,
        md5(coalesce(string_agg(case when n = 1 then line end, chr(10) order by place), '')) as kept_md5
    from documents d left join kept k using (doc_id) group by d.doc_id""")
def line_dedupe(spark: SparkSession, root: str) -> DataFrame:
    return ocr.first_lines(spread(table(spark, root, "documents").select("doc_id", "text")), "doc_id", "text").select("doc_id", "n_lines", "n_kept", F.md5("text").alias("kept_md5"))


@query("""
    select l_orderkey, count(*)::bigint as n_lines, count(case when l_linenumber % 5 = 0 or l_discount * 10 >= 0.7 then 1 end)::bigint as n_sure
    from lineitem group by l_orderkey""")
def confidence_filter(spark: SparkSession, root: str) -> DataFrame:
    """Lines that are sure enough, discounts standing in for confidences, some unknown."""
    line = F.struct(F.col("l_linenumber").cast("string").alias("text"), F.when(F.col("l_linenumber") % 5 != 0, F.col("l_discount") * 10).alias("confidence"))
    grouped = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    return grouped.select("l_orderkey", F.size("lines").cast("bigint").alias("n_lines"), F.size(ocr.accepted_lines(F.col("lines"), dedupe=False)).cast("bigint").alias("n_sure"))


@query(f"""
    select doc_id, case when {_STRIP.format("lang")} <> '' then {_STRIP.format("lang")} when {_STRIP.format("source")} <> '' then {_STRIP.format("source")} else '' end as value
    from documents""")
def first_present(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", values.first_present([F.col("lang"), F.col("source")]).alias("value"))


_FLAG = """case when lower(trim({0})) in ('1', 'true', 'yes', 'y', 'keep', 'kept', 'selected', 'keyframe') then true
    when lower(trim({0})) in ('0', 'false', 'no', 'n', 'drop', 'dropped', 'discard') then false end"""
_WORDS = "[' Keep ', 'N', 'maybe', NULL, 'TRUE', '0', 'discard', '']"


@query(f"""
    select doc_id, coalesce({_FLAG.format("a")}, {_FLAG.format("b")}, true) as kept
    from (select doc_id, {_WORDS}[doc_id % 8 + 1] as a, {_WORDS}[(doc_id // 8) % 8 + 1] as b from documents)""")
def selected_flag(spark: SparkSession, root: str) -> DataFrame:
    """The flag rule over words made up from document numbers."""
    words = F.array(*(F.lit(w) for w in (" Keep ", "N", "maybe", None, "TRUE", "0", "discard", "")))
    a, b = F.get(words, (F.col("doc_id") % 8).cast("int")), F.get(words, (F.floor(F.col("doc_id") / 8) % 8).cast("int"))
    return table(spark, root, "documents").select("doc_id", values.selected([a, b]).alias("kept"))


@query("""
    select distinct lower(trim(source)) as name from documents where source is not null
    union select distinct codec_name from video_probe where codec_name is not null""")
def union_names(spark: SparkSession, root: str) -> DataFrame:
    return catalog.union_names(table(spark, root, "documents").select(F.lower(F.trim("source"))), table(spark, root, "video_probe").select("codec_name"))


# --- catalog ------------------------------------------------------------------------------------------------------------


@query(f"""
    select video_id, rel_path, case when contains(rel_path, '/') then split_part(rel_path, '/', 1) else 'root' end as collection,
        case when contains(rel_path, '/') then substr(rel_path, strpos(rel_path, '/') + 1) else rel_path end as rel_in_collection,
        {_REPLACED.format("rel_path")} || '.npy' as swapped,
        regexp_replace(split_part(rel_path, '/', -1), '(.)\\.[^.]+$', '\\1') as stem, lower(regexp_extract(rel_path, '[^/]\\.([^./]+)$', 1)) as suffix
    from {_VIDEOS}""")
def collection_split(spark: SparkSession, root: str) -> DataFrame:
    rel = F.col("rel_path")
    rows = table(spark, root, "file_list").select("video_id", "rel_path").distinct()
    return rows.select("video_id", rel, paths.collection(rel).alias("collection"), paths.in_collection(rel).alias("rel_in_collection"), paths.replace_suffix(rel, ".npy").alias("swapped"), paths.stem(rel).alias("stem"), paths.suffix(rel).alias("suffix"))


@query(f"""
    select video_id, 'dataraw/embeddings/' || bare || '.npy' as embedding_path, 'ProcessedData/scence_boundary/' || bare || '.txt' as scene_path,
        'dataraw/embeddings/keyframes_indices_B32_' || c || '/' || below || '.txt' as indices_path, 'ProcessedData/data/keyframes/' || bare as keyframe_dir,
        'ProcessedData/data/map_keyframes/' || bare || '.csv' as map_path
    from (select video_id, {_REPLACED.format("rel_path")} as bare, case when contains(rel_path, '/') then split_part(rel_path, '/', 1) else 'root' end as c,
        {_REPLACED.format("case when contains(rel_path, '/') then substr(rel_path, strpos(rel_path, '/') + 1) else rel_path end")} as below from {_VIDEOS})""")
def output_paths(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "file_list").select("video_id", "rel_path").distinct().select("video_id", *paths.artefacts(F.col("rel_path")))


@query(f"""
    select video_id, rel_path, (n - 1)::bigint as position from (
        select *, row_number() over (order by string_split(rel_path, '/'), video_id) as n from {_VIDEOS}) where (n - 1) % 3 = 1""")
def shards(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "file_list").select("video_id", "rel_path").distinct()
    return catalog.shard(rows, [paths.parts(F.col("rel_path")), "video_id"], 3, 1)


@query(f"""select video_id, collection, rel_path from (select *, row_number() over (partition by collection order by rel_path, video_id) as n from {_VIDEOS}) where n <= 5""")
def per_group_limit(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "file_list").select("video_id", "collection", "rel_path").distinct()
    return catalog.limit_per_group(rows, "collection", ["rel_path", "video_id"], 5)


@query("""
    select distinct k.video_id, k.frame_idx from keyframe_indices k where not exists (
        select 1 from frame_embeddings f where f.video_id = k.video_id and f.frame_idx = k.frame_idx and coalesce(len(f.embedding), 0) > 0)""")
def pending_work(spark: SparkSession, root: str) -> DataFrame:
    """Keyframes whose vector is still to be made; an empty one counts as none."""
    frame = F.col("frame_idx").cast("bigint").alias("frame_idx")
    done = table(spark, root, "frame_embeddings").select("video_id", frame, F.coalesce(F.size("embedding"), F.lit(0)).alias("size"))
    return catalog.pending(table(spark, root, "keyframe_indices").select("video_id", frame).distinct(), done, ["video_id", "frame_idx"], size="size")


@query(f"""
    select v.video_id, min(c.path) as path from {_VIDEOS} v left join (
        select video_id, path, row_number() over (partition by video_id order by priority) as n from (
            select video_id, 'map/' || video_id || '.csv' as path, 1 as priority from keyframe_map
            union all select video_id, 'scenes/' || video_id || '.txt', 2 from scenes
            union all select video_id, 'speech/' || video_id || '.csv', 3 from asr_segments)) c on c.video_id = v.video_id and c.n = 1
    group by v.video_id""")
def priority_lookup(spark: SparkSession, root: str) -> DataFrame:
    """The first artefact that a video has, by priority."""
    vids = table(spark, root, "file_list").select("video_id").distinct()
    forms = F.array(*(F.concat(F.lit(a), F.col("video_id"), F.lit(b)) for a, b in (("map/", ".csv"), ("scenes/", ".txt"), ("speech/", ".csv"))))
    asked = vids.select("video_id", F.posexplode(forms).alias("priority", "path"))
    there = [table(spark, root, t).select(F.concat(F.lit(a), F.col("video_id"), F.lit(b)).alias("path")) for t, a, b in (("keyframe_map", "map/", ".csv"), ("scenes", "scenes/", ".txt"), ("asr_segments", "speech/", ".csv"))]
    return catalog.first_existing(asked, there[0].unionByName(there[1]).unionByName(there[2]), ["video_id"])


@query("select distinct video_id, frame_idx from keyframe_indices except select video_id, frame_idx::bigint from frame_embeddings")
def missing_outputs(spark: SparkSession, root: str) -> DataFrame:
    long_frame = lambda t: table(spark, root, t).select("video_id", long("frame_idx").alias("frame_idx"))
    return catalog.missing(long_frame("keyframe_indices"), long_frame("frame_embeddings"), ["video_id", "frame_idx"])


@query("""
    select t.video_id, coalesce(s.n, 0)::bigint as n_selected, t.n::bigint as n_total, round(coalesce(s.n, 0) / t.n * 100, 6) as percent
    from (select video_id, count(*) as n from (select distinct video_id, frame_idx from frame_embeddings) group by video_id) t
    left join (select video_id, count(*) as n from (select distinct video_id, frame_idx from keyframe_indices) group by video_id) s using (video_id)""")
def selected_ratio(spark: SparkSession, root: str) -> DataFrame:
    pair = lambda t: table(spark, root, t).select("video_id", "frame_idx").distinct()
    return catalog.ratio(pair("keyframe_indices"), pair("frame_embeddings"), "video_id").withColumn("percent", F.round("percent", 6))


# --- probes and sizes ---------------------------------------------------------------------------------------------------


@query(f"""
    select video_id, round({_FPS.format("avg_frame_rate")}, 9) as average, round({_FPS.format("r_frame_rate")}, 9) as real,
        lower(coalesce(codec_name, '')) as codec, case when regexp_matches(nb_frames, '^[0-9]+$') then nb_frames::bigint else -1 end as frames,
        round(case when {_FPS.format("avg_frame_rate")} > 0 then {_FPS.format("avg_frame_rate")} else {_FPS.format("r_frame_rate")} end, 9) as fps
    from video_probe""")
def frame_rate(spark: SparkSession, root: str) -> DataFrame:
    a, r = F.col("avg_frame_rate"), F.col("r_frame_rate")
    fps = values.video_fps(F.col("codec_name"), F.lit(None).cast("double"), a, r)
    return table(spark, root, "video_probe").select("video_id", F.round(values.frame_rate(a), 9).alias("average"), F.round(values.frame_rate(r), 9).alias("real"), values.codec(F.col("codec_name")).alias("codec"), F.coalesce(values.frame_count(F.col("nb_frames")), F.lit(-1)).cast("bigint").alias("frames"), F.round(fps, 9).alias("fps"))


@query("""
    select l_orderkey, l_linenumber, greatest(1, trunc(w * least(greatest(w, h), 224) / greatest(w, h)))::bigint as model_width,
        greatest(1, trunc(h * least(greatest(w, h), 224) / greatest(w, h)))::bigint as model_height,
        greatest(1, round_even(w * s, 0))::bigint as ocr_width, greatest(1, round_even(h * s, 0))::bigint as ocr_height, trunc(w * (540.0::double / h))::bigint as width_540
    from (select *, case when greatest(w, h) > 1920 then 1920.0::double / greatest(w, h) when least(w, h) < 720 then least(720.0::double / least(w, h), 1920.0::double / greatest(w, h)) else 1.0::double end as s
        from (select l_orderkey, l_linenumber, (l_partkey % 4000 + 1)::bigint as w, (l_suppkey * 37 % 2500 + 1)::bigint as h from lineitem))""")
def resize_dims(spark: SparkSession, root: str) -> DataFrame:
    """Image sizes made up from line items, resized for models, text recognition and storage."""
    sized = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 4000 + 1).alias("w"), (F.col("l_suppkey") * 37 % 2500 + 1).alias("h"))
    w, h = F.col("w"), F.col("h")
    (mw, mh), (ow, oh) = values.model_size(w, h, 224), values.ocr_size(w, h)
    return sized.select("l_orderkey", "l_linenumber", long(mw).alias("model_width"), long(mh).alias("model_height"), long(ow).alias("ocr_width"), long(oh).alias("ocr_height"), long(values.width_at(w, h, 540)).alias("width_540"))


@query("""
    select video_id, id, case when id % 3 = 1 then printf('%06d', id::bigint) when id % 3 = 2 then 'x' || id else printf('%06d', id::bigint) end as stem
    from (select distinct video_id, id from keyframe_map)""")
def frame_stems(spark: SparkSession, root: str) -> DataFrame:
    """File stems of map ids written as whole numbers, decimals and text."""
    i = F.col("id")
    raw = F.when(i % 3 == 1, i.cast("string")).when(i % 3 == 2, F.concat(F.lit("x"), i.cast("string"))).otherwise(F.concat(F.lit(" "), i.cast("string"), F.lit(".0 ")))
    return table(spark, root, "keyframe_map").select("video_id", "id").distinct().select("video_id", "id", paths.frame_stem(raw).alias("stem"))


# --- keyframes and scenes -----------------------------------------------------------------------------------------------


@query(f"""
    select k.video_id, (row_number() over (partition by k.video_id order by k.frame_idx) - 1)::int as id,
        printf('%06d', row_number() over (partition by k.video_id order by k.frame_idx) - 1) || '.webp' as name,
        round(case when p.fps > 0 then k.frame_idx / p.fps end, 6) as pts_time, round(coalesce(p.fps, 0), 6) as fps, k.frame_idx
    from (select distinct video_id, frame_idx from keyframe_indices) k
    left join (select video_id, case when {_FPS.format("avg_frame_rate")} > 0 then {_FPS.format("avg_frame_rate")} else {_FPS.format("r_frame_rate")} end as fps from video_probe where codec_name is not null) p using (video_id)""")
def map_rows(spark: SparkSession, root: str) -> DataFrame:
    fps = values.video_fps(F.col("codec_name"), F.lit(None).cast("double"), F.col("avg_frame_rate"), F.col("r_frame_rate"))
    rates = table(spark, root, "video_probe").where("codec_name is not null").select("video_id", fps.alias("fps"))
    found = keyframes.time_map(table(spark, root, "keyframe_indices"), rates)
    return found.select("video_id", "id", "name", F.round("pts_time", 6).alias("pts_time"), F.round("fps", 6).alias("fps"), "frame_idx")


@query("""
    select video_id, frame_idx, id from (select *, row_number() over (partition by video_id, frame_idx order by loaded_at, id) as n from keyframe_map) where n = 1""")
def manifest_first(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "keyframe_map").select("video_id", "frame_idx", "loaded_at", "id")
    return catalog.first_of_each(rows, ["video_id", "frame_idx"], ["loaded_at", "id"]).select("video_id", "frame_idx", "id")


@query("""
    with m as (select video_id, frame_idx, id from (select *, row_number() over (partition by video_id, frame_idx order by id) as n from keyframe_map) where n = 1)
    select k.video_id as group_id, printf('%06d', k.frame_idx) as image_id, k.video_id, printf('%06d', k.frame_idx) as frame_id, '' as map_id, '' as subfolder,
        k.video_id || '/' || printf('%06d', k.frame_idx) || '.webp' as original_path,
        case when m.id is null then '' else 'preprocessed/' || k.video_id || '/' || printf('%06d', m.id) || '.jpg' end as preprocessed_path
    from (select distinct video_id, frame_idx from keyframe_indices) k left join m using (video_id, frame_idx)""")
def left_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of chosen keyframes; those in a map count as prepared."""
    name = paths.ordinal_name(F.col("frame_idx"))
    found = table(spark, root, "keyframe_indices").select("video_id", "frame_idx").distinct().select(F.col("video_id").alias("group_id"), name.alias("image_id"), F.concat("video_id", F.lit("/"), name, F.lit(".webp")).alias("path"))
    first = table(spark, root, "keyframe_map").groupBy("video_id", "frame_idx").agg(F.min("id").alias("id"))
    prepared = first.select(F.col("video_id").alias("group_id"), name.alias("image_id"), paths.image_path(F.col("video_id"), paths.ordinal_name(F.col("id")), "jpg").alias("path"))
    return manifests.keyframe_manifest(found, prepared)


@query("""
    with s as (select distinct scene_key, video_id, start_frame, end_frame from scenes),
    f as (select distinct video_id, frame_idx from frame_embeddings)
    select s.scene_key, count(*)::bigint as n_frames, min(f.frame_idx)::bigint as first_frame, max(f.frame_idx)::bigint as last_frame
    from s join f on s.video_id = f.video_id and f.frame_idx between s.start_frame and s.end_frame group by s.scene_key""")
def scene_slice(spark: SparkSession, root: str) -> DataFrame:
    ranges = table(spark, root, "scenes").select("scene_key", "video_id", "start_frame", "end_frame").distinct()
    frames = table(spark, root, "frame_embeddings").select("video_id", "frame_idx").distinct()
    found = scenes.frames_of(ranges, frames).groupBy("scene_key")
    return found.agg(F.count("*").alias("n_frames"), long(F.min("frame_idx")).alias("first_frame"), long(F.max("frame_idx")).alias("last_frame"))


@query("""
    select distinct scene_key, greatest(0, start_frame) as start_frame,
        case when p.n > 0 then least(greatest(greatest(0, start_frame), end_frame), p.n - 1) else greatest(greatest(0, start_frame), end_frame) end as end_frame
    from scenes s left join (select video_id, case when regexp_matches(nb_frames, '^[0-9]+$') then nb_frames::bigint end as n from video_probe) p using (video_id)""")
def scene_clamp(spark: SparkSession, root: str) -> DataFrame:
    """Ranges read as half-open ones of a detector, made inclusive and moved into their videos."""
    count = table(spark, root, "video_probe").select("video_id", values.frame_count(F.col("nb_frames")).alias("n"))
    a, b = scenes.inclusive(F.col("start_frame"), F.col("end_frame") + 1, F.col("n"))
    return table(spark, root, "scenes").join(count, "video_id", "left").select("scene_key", a.alias("start_frame"), b.alias("end_frame")).distinct()


@query("""
    with o as (select user_id, (row_number() over (partition by user_id order by ts, event_id) - 1)::bigint as f, case when value >= 100 then 1 else 0 end as cut from events),
    c as (select *, sum(cut) over (partition by user_id order by f) as s from o),
    g as (select user_id, s, min(f) as start_frame, max(f) as end_frame from c group by user_id, s)
    select user_id, (row_number() over (partition by user_id order by start_frame) - 1)::bigint as scene_id, start_frame, end_frame from g""")
def scene_islands(spark: SparkSession, root: str) -> DataFrame:
    return scenes.islands(_scores(spark, root), "user_id", score="value", threshold=100.0)


@query(f"""
    with e as (select vec_id, label, embedding::double[] as v from embeddings),
    m as (select label, i, avg(v[i]) as m from e, unnest(generate_series(1, 64)) as t(i) group by label, i),
    c as (select label, list(m order by i) as c from m group by label),
    d as (select e.label, e.vec_id, list_sum(list_transform(list_zip(e.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from e join c using (label))
    select label, arg_min(vec_id, d) as vec_id, round(min(d), 6) as distance from d group by label""")
def nearest_centroid(spark: SparkSession, root: str) -> DataFrame:
    found = vectors.nearest_to_centroid(table(spark, root, "embeddings").select("label", "vec_id", "embedding"), ["label"], "embedding", "vec_id", 64)
    return found.withColumn("distance", F.round("distance", 6))


@query("""
    with e as (select vec_id, label, vec_id // 256 as block, embedding::double[] as v from embeddings),
    m as (select label, block, i, avg(v[i]) as m from e, unnest(generate_series(1, 64)) as t(i) group by label, block, i),
    c as (select label, block, list(m order by i) as c from m group by label, block),
    d as (select e.label, e.block, e.vec_id, list_sum(list_transform(list_zip(e.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from e join c using (label, block))
    select label, block::bigint as block, arg_min(vec_id, d) as vec_id, round(min(d), 6) as distance from d group by label, block""")
def segment_blocks(spark: SparkSession, root: str) -> DataFrame:
    return keyframes.blocks(table(spark, root, "embeddings").select("label", "vec_id", "embedding"), "label", "vec_id", "embedding", 64).withColumn("distance", F.round("distance", 6))


@query(f"""
    select distinct vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 4) as norm,
        round(list_sum(list_transform(embedding, lambda x: abs(x::double))) / sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 4) as sum_abs
    from frame_embeddings where {_USABLE.format("embedding", 64)}""")
def l2_norm(spark: SparkSession, root: str) -> DataFrame:
    scaled = packed.normalised(table(spark, root, "frame_embeddings").select("vec_id", "embedding"), "embedding", 64)
    size = F.aggregate("vec", F.lit(0.0), lambda a, x: a + F.abs(x))
    return scaled.groupBy("vec_id").agg(F.max(F.round("norm", 4)).alias("norm"), F.max(F.round(size, 4)).alias("sum_abs"))


# contiguous clustering of the points ``p`` (group g, place i from 1, vector v) as common table expressions: sums of distances over
# leading rows and columns, one merge of neighbours a step, silhouettes, and the edges e of the best clustering of each group
_CLUSTERING = """
    n as (select g, max(i) as n from p group by g),
    sums as (select a.g, a.i, b.i as j, sum(list_distance(a.v, b.v)) over (partition by a.g, a.i order by b.i) as s from p a join p b using (g)),
    line as (select g, i, list_prepend(0.0::double, list(s order by j)) as r from sums group by g, i),
    area as (select g, list_prepend(list_transform(range(0, any_value(len(q))), lambda x: 0.0::double), list(q order by i)) as a from (
        select g, i, list_prepend(0.0::double, list(t order by j)) as q from (select g, i, j, sum(s) over (partition by g, j order by i) as t from sums) group by g, i) group by g),
    steps as (select g, range(0, n + 1) as e from n union all select g, e[:x] || e[x + 2:] from (select g, e, list_position(near, list_min(near)) as x from (
        select steps.g, e, list_transform(range(1, len(e) - 1), lambda x: round((a[e[x + 1] + 1][e[x + 2] + 1] - a[e[x] + 1][e[x + 2] + 1] - a[e[x + 1] + 1][e[x + 1] + 1] + a[e[x] + 1][e[x + 1] + 1])
            / ((e[x + 1] - e[x]) * (e[x + 2] - e[x + 1])), 12)) as near from steps join area using (g) where len(e) > 3))),
    tried as (select g, e, len(e) - 1 as k from steps join n using (g) where len(e) - 1 between 2 and least(floor(sqrt(n)) + 1, n - 1)),
    parts as (select t.g, t.e, t.k, l.i, list_transform(range(1, k + 1), lambda c: r[e[c + 1] + 1] - r[e[c] + 1]) as total, list_sum(list_transform(range(1, k + 1), lambda c: case when e[c] < i and i <= e[c + 1] then c else 0 end))::int as own
        from tried t join line l using (g)),
    near as (select g, e, k, total[own] / greatest(e[own + 1] - e[own] - 1, 1) as a, e[own + 1] - e[own] as size,
        list_min(list_transform(range(1, k + 1), lambda c: case when c <> own then total[c] / (e[c + 1] - e[c]) end)) as b from parts),
    scored as (select g, e, k, avg(case when size > 1 and greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end) as score from near group by g, e, k),
    chosen as (select g, e, score from (select *, row_number() over (partition by g order by round(score, 12) desc, k desc) as place from scored) where place = 1),
    labelled as (select p.g, p.i, p.v, c.score, list_sum(list_transform(e[2:], lambda x: case when x < p.i then 1 else 0 end))::bigint as label from p join chosen c using (g)),
    means as (select g, label, d, avg(v[d]) as m from labelled, unnest(generate_series(1, len(v))) as t(d) group by g, label, d),
    centres as (select g, label, list(m order by d) as c from means group by g, label),
    keys as (select l.g, l.label, arg_min(l.i, (round(list_distance(l.v, c.c) ** 2, 12), l.i)) as i from labelled l join centres c using (g, label) group by l.g, l.label)"""


@query(f"""
    with recursive f as (select distinct video_id, frame_idx::bigint as f, embedding::double[] as v from frame_embeddings where video_id is not null and {_USABLE.format("embedding", 64)}),
    reach as (select video_id, min(f) as low, max(f) as high from f group by video_id),
    s as (select video_id, start_frame, end_frame, greatest(start_frame, low) as a, least(end_frame, high) as b from (select distinct video_id, start_frame, end_frame from scenes where start_frame <= end_frame) join reach using (video_id)),
    inside as (select s.video_id, s.start_frame, s.end_frame, f.f, f.v, case when b - greatest(a, 0) + 1 > 512 then (f.f - greatest(a, 0)) // 256 else -1 end as block from s join f on s.video_id = f.video_id and f.f between a and b),
    g as (select *, dense_rank() over (order by video_id, start_frame, end_frame, block) as g, row_number() over (partition by video_id, start_frame, end_frame, block order by f) as i, count(*) over (partition by video_id, start_frame, end_frame, block) as n from inside),
    p as (select g, i, v from g where block < 0 and n >= 5),
    {_CLUSTERING},
    plain as (select g, d, avg(v[d]) as m from g, unnest(generate_series(1, 64)) as t(d) where block >= 0 or n < 5 group by g, d),
    one as (select g, list(m order by d) as c from plain group by g)
    select distinct video_id, f as frame_idx from g join keys using (g, i)
    union select video_id, f from (select g.video_id, g.f, row_number() over (partition by g.g order by round(list_distance(g.v, one.c) ** 2, 12), g.i) as place from g join one using (g)) where place = 1""")
def keyframe_select(spark: SparkSession, root: str) -> DataFrame:
    """Keyframes of every scene by contiguous clustering; one of a short scene, one of each block of a long one."""
    ranges = table(spark, root, "scenes").select("video_id", "start_frame", "end_frame")
    return keyframes.select(ranges, table(spark, root, "frame_embeddings"))


@query(f"""
    with recursive p as (select label as g, row_number() over (partition by label order by vec_id) as i, vec_id, embedding::double[] as v from embeddings), {_CLUSTERING}
    select p.g as label, vec_id, l.label as cluster, round(l.score, 6) as score, k.i is not null as is_keyframe
    from p join labelled l using (g, i) left join keys k on k.g = p.g and k.i = p.i""")
def cluster_labels(spark: SparkSession, root: str) -> DataFrame:
    """Labels as scenes: the cluster of each vector, the silhouette of the clustering, and the keyframes."""
    found = keyframes.clusters(table(spark, root, "embeddings").withColumnRenamed("label", "scene"), "scene", "vec_id")
    return found.select(F.col("scene").alias("label"), "vec_id", F.col("label").alias("cluster"), F.round("score", 6).alias("score"), "is_keyframe")


def _scores(spark: SparkSession, root: str) -> DataFrame:
    """Events of a user as frames in order of time, their values as content scores."""
    rows = table(spark, root, "events").select("user_id", "ts", "event_id", "value")
    return catalog.ranked(rows, "user_id", ["ts", "event_id"], F.unix_date(F.col("ts").cast("date")), "frame_idx")


@query("""
    with recursive o as (select user_id, (row_number() over (partition by user_id order by ts, event_id) - 1)::bigint as f, value from events),
    last as (select user_id, max(f) as last from o group by user_id),
    c as (select user_id, f from o where value >= 100),
    s as (select user_id, 0::bigint as scene_id, 0::bigint as start_frame from last
        union all select s.user_id, s.scene_id + 1, min(c.f) from s join c on c.user_id = s.user_id and c.f - s.start_frame >= 15 group by s.user_id, s.scene_id)
    select user_id, scene_id, start_frame, coalesce(lead(start_frame) over (partition by user_id order by scene_id) - 1, last) as end_frame from s join last using (user_id)""")
def scene_detect(spark: SparkSession, root: str) -> DataFrame:
    """Scenes of at least 15 frames, from event values as content scores."""
    return scenes.detect(_scores(spark, root), "user_id", score="value", threshold=100.0)


# --- boxes --------------------------------------------------------------------------------------------------------------


def _boxes(spark: SparkSession, root: str) -> DataFrame:
    """Boxes made up from line items: some upright, some turned, some outside the image."""
    x, y = F.col("l_partkey") % 130 - 10, F.col("l_suppkey") * 7 % 90 - 5
    w, h = F.col("l_quantity") + 0.5, F.col("l_linenumber") * 3 + F.col("l_tax") * 10
    turn = F.when(F.col("l_linenumber") % 2 == 0, F.lit(2.0)).otherwise(0.0)
    corner = lambda a, b: geometry.point(a, b)
    box = F.array(corner(x + w, y + turn), corner(x + w - turn, y + h), corner(x, y + h - turn), corner(x + turn, y))
    needed = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax")
    return spread(needed).select("l_orderkey", "l_linenumber", box.alias("box"))


_BOX = """
    select l_orderkey, l_linenumber, least(greatest(x + w, 0), 99) as x1, least(greatest(y + t, 0), 59) as y1, least(greatest(x + w - t, 0), 99) as x2, least(greatest(y + h, 0), 59) as y2,
        least(greatest(x, 0), 99) as x3, least(greatest(y + h - t, 0), 59) as y3, least(greatest(x + t, 0), 99) as x4, least(greatest(y, 0), 59) as y4
    from (select l_orderkey, l_linenumber, (l_partkey % 130 - 10)::double as x, (l_suppkey * 7 % 90 - 5)::double as y, l_quantity + 0.5::double as w,
        l_linenumber * 3 + l_tax * 10 as h, case when l_linenumber % 2 = 0 then 2.0::double else 0.0::double end as t from lineitem)"""
_CORNERS = f"""
    select l_orderkey, l_linenumber, x1, y1, x2, y2, x3, y3, x4, y4, arg_min(i, (x + y, i)) as tl, arg_min(i, (y - x, i)) as tr, arg_min(i, (-(x + y), i)) as br, arg_min(i, (x - y, i)) as bl
    from (select *, unnest([1, 2, 3, 4]) as i, unnest([x1, x2, x3, x4]) as x, unnest([y1, y2, y3, y4]) as y from ({_BOX})) group by all"""


_MEASURED = f"""
    c as (select *, [x1, x2, x3, x4] as xs, [y1, y2, y3, y4] as ys from ({_CORNERS})),
    e as (select *, greatest(sqrt((xs[tl] - xs[tr]) * (xs[tl] - xs[tr]) + (ys[tl] - ys[tr]) * (ys[tl] - ys[tr])), sqrt((xs[bl] - xs[br]) * (xs[bl] - xs[br]) + (ys[bl] - ys[br]) * (ys[bl] - ys[br]))) as width,
        greatest(sqrt((xs[tl] - xs[bl]) * (xs[tl] - xs[bl]) + (ys[tl] - ys[bl]) * (ys[tl] - ys[bl])), sqrt((xs[tr] - xs[br]) * (xs[tr] - xs[br]) + (ys[tr] - ys[br]) * (ys[tr] - ys[br]))) as height,
        array_to_string(list_transform([x1, y1, x2, y2, x3, y3, x4, y4], lambda v: round_even(v, 0)::bigint::varchar), ',') as key from c)"""


@query(f"""
    with {_MEASURED}
    select l_orderkey, l_linenumber, round(xs[tl], 3) as left_x, round(ys[tl], 3) as top_y, round(xs[br], 3) as right_x, round(ys[br], 3) as bottom_y,
        round(width, 6) as width, round(height, 6) as height, width >= 3 and height >= 3 as large,
        key, greatest(1, trunc(width))::bigint as crop_width, greatest(1, trunc(height))::bigint as crop_height, greatest(1, trunc(height)) / greatest(1, trunc(width)) >= 1.5 as turned
    from e""")
def box_geometry(spark: SparkSession, root: str) -> DataFrame:
    m = geometry.measure(_boxes(spark, root), "box", F.lit(100), F.lit(60))
    cw, ch, turned = geometry.crop_of(F.col("box_width"), F.col("box_height"))
    at = lambda i, c: F.round(F.get("corners", F.lit(i))[c], 3)
    width, height = F.col("box_width"), F.col("box_height")
    return m.select("l_orderkey", "l_linenumber", at(0, "x").alias("left_x"), at(0, "y").alias("top_y"), at(2, "x").alias("right_x"), at(2, "y").alias("bottom_y"), F.round(width, 6).alias("width"), F.round(height, 6).alias("height"), geometry.large(width, height, 3.0).alias("large"), F.col("box_key").alias("key"), long(cw).alias("crop_width"), long(ch).alias("crop_height"), turned.alias("turned")).distinct()


@query("""
    select l_orderkey, list_sort(list(l_quantity))[count(*) // 2 + 1] as upper_median, greatest(10.0::double, 0.5::double * list_sort(list(l_quantity))[count(*) // 2 + 1]) as near
    from lineitem group by l_orderkey""")
def upper_median(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "lineitem").groupBy("l_orderkey").agg(ocr.upper_median(F.collect_list("l_quantity")).alias("upper_median"))
    return rows.withColumn("near", F.greatest(F.lit(10.0), 0.5 * F.col("upper_median")))


def _page_boxes(spark: SparkSession, root: str) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "box"))), lambda r: F.struct(r["box"].alias("box"), F.lit(None).cast("double").alias("det_confidence")))
    return _boxes(spark, root).groupBy("l_orderkey").agg(listed.alias("boxes"))


@query(f"""
    with {_MEASURED},
    once as (select l_orderkey, key, arg_min({{'y': ys[tl], 'x': xs[tl], 'i': l_linenumber, 'h': height, 'key': key}}, l_linenumber) as m from e where width >= 3 and height >= 3 group by l_orderkey, key),
    pages as (select l_orderkey, list_sort(list(m)) as ms, greatest(10.0::double, 0.5::double * list_sort(list(m.h))[count(*) // 2 + 1]) as near from once group by l_orderkey)
    select l_orderkey, array_to_string(list_transform(list_reduce(list_transform(ms, lambda m: [m]), lambda done, new:
        done[:len(done) - coalesce(nullif(list_position(list_transform(list_reverse(done), lambda d: abs(new[1].y - d.y) < near and new[1].x < d.x), false), 0) - 1, len(done))] || new
        || done[len(done) - coalesce(nullif(list_position(list_transform(list_reverse(done), lambda d: abs(new[1].y - d.y) < near and new[1].x < d.x), false), 0) - 1, len(done)) + 1:]), lambda m: m.key), ';') as boxes
    from pages""")
def reading_order(spark: SparkSession, root: str) -> DataFrame:
    """Boxes of an order as those of a page, usable ones in reading order."""
    found = ocr.pages(_boxes(spark, root), "l_orderkey", "l_linenumber", "box", F.lit(100), F.lit(60))
    return found.select("l_orderkey", F.array_join(F.transform("boxes", lambda b: geometry.rounded_key(b)), ";").alias("boxes"))


@query("select l_orderkey, count(*)::bigint as n_boxes, 0.9::double as confidence from lineitem group by l_orderkey")
def detector_json(spark: SparkSession, root: str) -> DataFrame:
    """Nested detector results made up from line items as JSON text, and the boxes in them."""
    raw = F.to_json(F.struct(F.struct(F.transform("boxes", lambda b: F.transform(b["box"], lambda p: F.array(p["x"], p["y"]))).alias("dt_polys"), F.lit(0.9).alias("scores")).alias("res")))
    found = _page_boxes(spark, root).select("l_orderkey", ocr.detector_boxes(raw).alias("b"))
    return found.select("l_orderkey", F.size("b").cast("bigint").alias("n_boxes"), F.array_max(F.transform("b", lambda x: x["det_confidence"])).alias("confidence"))


@query(f"select distinct md5(replace(lower({_CLEAN.format('text')}), 'ß', 'ss')) as key from documents")
def casefold_keys(spark: SparkSession, root: str) -> DataFrame:
    """Different keys of texts that are equal but for case."""
    return table(spark, root, "documents").select(F.md5(values.casefold(values.clean_text(F.col("text")))).alias("key")).distinct()


# --- streams and backends -----------------------------------------------------------------------------------------------


@query("""select video_id, count(*)::bigint as n_segments, round(sum("end" - "start"), 3) as seconds from asr_segments where "start" <= "end" and video_id is not null group by video_id""")
def stream_equals_batch(spark: SparkSession, root: str) -> DataFrame:
    """Segments read as a stream of files until all are taken, written, and summed."""
    work = scratch(spark, "stream")
    source = f"{root}/asr_segments.parquet"
    schema = spark.read.parquet(source).schema
    # a table is a folder of files or a single file; a stream reads folders
    single = not _is_folder(spark, source)
    stream = incremental.files(spark, root if single else source, schema, glob="asr_segments.parquet" if single else None)
    incremental.run_available(stream.where("start <= end"), f"{work}/out", f"{work}/state")
    return spark.read.schema(schema).parquet(f"{work}/out").where("video_id is not null").groupBy("video_id").agg(F.count("*").alias("n_segments"), F.round(F.sum(F.col("end") - F.col("start")), 3).alias("seconds"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


@query("select video_id, rel_path, 64::bigint as dim, 'stub' as backend, 'ok' as status from (select distinct video_id, rel_path from file_list)")
def backend_encode(spark: SparkSession, root: str) -> DataFrame:
    """Every video through the stub encoder."""
    rows = table(spark, root, "file_list").select("video_id", "rel_path").distinct().withColumn("path", F.col("rel_path"))
    done = backends.run(rows, ["stub"], "embedding array<float>", ["video_id", "rel_path"])
    return done.select("video_id", "rel_path", F.size("embedding").cast("bigint").alias("dim"), "backend", "status")

"""The queries of the training-data operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import families, leakage, nearest, nearest_time, packing, repetition, runs, scenes, subjects, variety
from reelspark.runtime import table


def _keyframe_of_segment(spark: SparkSession, root: str) -> DataFrame:
    segments = table(spark, root, "asr_segments").select("video_id", "seg_no", "start", "end").distinct()
    middle = (F.col("start") + F.col("end")) / 2
    return nearest_time.nearest(segments, table(spark, root, "keyframe_map"), "video_id", middle, F.col("pts_time"), F.col("frame_idx"), ["seg_no"], tolerance=2.0)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return _keyframe_of_segment(spark, root).select("video_id", "seg_no", F.col("number").alias("frame_idx")).distinct()


def p1_gaps(spark: SparkSession, root: str) -> DataFrame:
    """How far each segment's keyframe is from its middle, in seconds."""
    return _keyframe_of_segment(spark, root).select("video_id", "seg_no", F.col("number").alias("frame_idx"), "gap")


def _runs(spark: SparkSession, root: str) -> DataFrame:
    return runs.collapse(table(spark, root, "keyframe_map"), table(spark, root, "frame_embeddings"))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return _runs(spark, root).where("n_keyframes >= 3").select("video_id", "first_frame", "last_frame")


def p2_runs(spark: SparkSession, root: str) -> DataFrame:
    return _runs(spark, root)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return repetition.share(table(spark, root, "documents"), least=0.30).select("doc_id").distinct()


def p3_share(spark: SparkSession, root: str) -> DataFrame:
    return repetition.share(table(spark, root, "documents"))


def _families(spark: SparkSession, root: str) -> families.Families:
    seen = scenes.scene_vectors(table(spark, root, "scenes"), table(spark, root, "frame_embeddings"))
    return families.Families(seen.select(F.col("scene_key").alias("id"), "vec"), least=0.89)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return _families(spark, root).members.select(F.col("root").alias("scene_key_a"), F.col("id").alias("scene_key_b"))


def p4_families(spark: SparkSession, root: str) -> DataFrame:
    """Size and the three most typical scenes of every family."""
    return _families(spark, root).described().withColumn("similarity", F.round("similarity", 4))


def p4_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Clusters of mutually similar scenes within each family: their medoids and sizes."""
    return _families(spark, root).clusters().select("family", "cluster", "size").distinct()


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    near = nearest.most_similar(table(spark, root, "frame_embeddings"), table(spark, root, "knn_probe"))
    return near.select(F.least("id", "other").alias("vec_id_a"), F.greatest("id", "other").alias("vec_id_b")).distinct()


def p5_nearest(spark: SparkSession, root: str) -> DataFrame:
    """The ten most similar vectors of every vector whose id is divisible by 50, among all rows."""
    frames = table(spark, root, "frame_embeddings")
    return nearest.most_similar(frames, frames.where("vec_id % 50 = 0").select("vec_id"))


def p6_subset(spark: SparkSession, root: str) -> DataFrame:
    """The varied subset of the keyframes of each collection, as many as ``subset_request`` asks for."""
    records = variety.records_of(table(spark, root, "keyframe_indices"), table(spark, root, "frame_embeddings"))
    asked = table(spark, root, "subset_request").select(F.col("collection").alias("group"), F.col("n_keep").alias("wanted"))
    chosen = variety.choose(records.withColumn("group", F.substring("video_id", 1, 3)), asked)
    return chosen.select(F.col("group").alias("collection"), "video_id", "frame_idx")


def p6_counts(spark: SparkSession, root: str) -> DataFrame:
    """How many different frames each collection gives."""
    return p6_subset(spark, root).groupBy("collection").agg(F.countDistinct("video_id", "frame_idx").alias("n_frames"))


def _packed(spark: SparkSession, root: str) -> tuple[DataFrame, dict[str, int]]:
    asked = {r.size_name: r.capacity_tokens for r in table(spark, root, "pack_sizes").collect()}
    return packing.pack(table(spark, root, "documents"), asked), asked


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    packed, asked = _packed(spark, root)
    return packed.where((F.col("capacity") == max(asked.values())) & (F.col("n_pieces") > 1)).select("doc_id").distinct()


def p7_containers(spark: SparkSession, root: str) -> DataFrame:
    return _packed(spark, root)[0]


def p7_filling(spark: SparkSession, root: str) -> DataFrame:
    return packing.filling(_packed(spark, root)[0])


def p7_checks(spark: SparkSession, root: str) -> DataFrame:
    """For each capacity how many documents are packed, how many containers hold too much, and how many documents are split that would fit."""
    packed = _packed(spark, root)[0]
    held = packed.groupBy("size_name", "capacity", "group_no", "container").agg(F.sum("n_tokens").alias("held"))
    over = held.groupBy("size_name", "capacity").agg(F.count_if(F.col("held") > F.col("capacity")).alias("n_over"))
    whole = packed.groupBy("size_name", "doc_id", "capacity").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("pieces"), F.max("n_pieces").alias("n_pieces"))
    wrong = F.count_if((F.col("pieces") != F.col("n_pieces")) | ((F.col("pieces") > 1) & (F.col("n_tokens") <= F.col("capacity"))))
    return whole.groupBy("size_name").agg(F.count("*").alias("n_documents"), wrong.alias("n_split_wrongly")).join(over, "size_name")


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items")).select("doc_id", "item_id").distinct()


def p8_verbatim(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold 15 or more words of an item in a row letter by letter, but for case and the like."""
    found = leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items"))
    return found.where("verbatim_words >= 15").select("doc_id", "item_id").distinct()


def p8_clean(spark: SparkSession, root: str) -> DataFrame:
    """Ids of the documents that may stay in the training text."""
    documents = table(spark, root, "documents")
    return leakage.clean(documents, leakage.leaks(documents, table(spark, root, "eval_items"))).select("doc_id")


def _areas(spark: SparkSession, root: str) -> DataFrame:
    return subjects.areas(table(spark, root, "documents"), table(spark, root, "subject_labels"), table(spark, root, "subject_areas"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return _areas(spark, root).select("doc_id", "subject").distinct()


def p9_composition(spark: SparkSession, root: str) -> DataFrame:
    """Documents and words of each subject area."""
    return _areas(spark, root).groupBy("subject").agg(F.count("*").alias("n_documents"), F.sum("n_words").alias("n_words"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_gaps, p2_found, p2_runs, p3_found, p3_share, p4_found, p4_families, p4_clusters, p5_found, p5_nearest, p6_subset, p6_counts, p7_found, p7_containers, p7_filling, p7_checks, p8_found, p8_verbatim, p8_clean, p9_found, p9_composition)}
_NEAREST = """
    select video_id, seg_no, frame_idx, gap from (
        select s.video_id, s.seg_no, k.frame_idx, abs(k.pts_time - (s."start" + s."end") / 2) as gap,
            row_number() over (partition by s.video_id, s.seg_no, s."start", s."end" order by abs(k.pts_time - (s."start" + s."end") / 2), k.frame_idx) as n
        from (select distinct video_id, seg_no, "start", "end" from asr_segments) s
        join (select distinct video_id, frame_idx, pts_time from keyframe_map where pts_time is not null and not isnan(pts_time)) k using (video_id)
        where abs(k.pts_time - (s."start" + s."end") / 2) <= 2.0) where n = 1"""
_UNIT = """
    unit as (select video_id, frame_idx, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) as u from (
        select distinct video_id, frame_idx::bigint as frame_idx, embedding::double[] as e from frame_embeddings
        where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0))"""
_RUNS = f"""
    with {_UNIT},
    k as (select video_id, frame_idx, min(case when not isnan(pts_time) then pts_time end) as t from keyframe_map where video_id is not null and frame_idx is not null group by video_id, frame_idx),
    seq as (select video_id, frame_idx, t, u, lag(u) over (partition by video_id order by frame_idx) as before from k join unit using (video_id, frame_idx)),
    runs as (select *, sum(case when list_inner_product(u, before) >= 0.98 then 0 else 1 end) over (partition by video_id order by frame_idx) as run from seq)
    select video_id, min(frame_idx) as first_frame, max(frame_idx) as last_frame, count(*)::bigint as n_keyframes, arg_max_null(t, frame_idx) - arg_min_null(t, frame_idx) as duration
    from runs group by video_id, run"""
_SHARES = """
    with w as (select doc_id, regexp_extract_all(lower(nfc_normalize(coalesce(text, ''))), '\\p{L}+') as w from documents),
    g as (select doc_id, unnest(generate_series(1, len(w) - 7)) as i, w from w where len(w) >= 8),
    r as (select doc_id, i, row_number() over (partition by doc_id, array_to_string(w[i:i + 7], ' ') order by i) as n from g),
    c as (select doc_id, count(distinct place) as c from (select doc_id, unnest(generate_series(i, i + 7)) as place from r where n > 1) group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(c, 0)::bigint as n_repeated, coalesce(c, 0) / greatest(len(w), 1) as share from w left join c using (doc_id)"""
SQL: dict[str, str] = {
    "p1_found": f"select distinct video_id, seg_no, frame_idx from ({_NEAREST})",
    "p1_gaps": _NEAREST,
    "p2_found": f"select video_id, first_frame, last_frame from ({_RUNS}) where n_keyframes >= 3",
    "p2_runs": _RUNS,
    "p3_found": f"select doc_id from ({_SHARES}) where share >= 0.3",
    "p3_share": _SHARES,
    # slow beyond small tables: all pairs of scenes, and all pairs within a family
    "p4_found": f"""
        with recursive {_UNIT},
        s as (select distinct scene_key, video_id, start_frame, end_frame from scenes where start_frame <= end_frame),
        m as (select scene_key, i, avg(u[i]) as m from s join unit f on s.video_id = f.video_id and f.frame_idx between s.start_frame and s.end_frame, unnest(generate_series(1, 64)) as t(i) group by scene_key, i),
        v as (select scene_key, list(m order by i) as v from m group by scene_key),
        e as (select a.scene_key as a, b.scene_key as b from v a join v b on a.scene_key <> b.scene_key and list_cosine_similarity(a.v, b.v) >= 0.89),
        r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
        select min(b) as scene_key_a, a as scene_key_b from r group by a having min(b) < a""",
    "p4_families": f"""
        with recursive {_UNIT},
        s as (select distinct scene_key, video_id, start_frame, end_frame from scenes where start_frame <= end_frame),
        m as (select scene_key, i, avg(u[i]) as m from s join unit f on s.video_id = f.video_id and f.frame_idx between s.start_frame and s.end_frame, unnest(generate_series(1, 64)) as t(i) group by scene_key, i),
        v as (select scene_key, list(m order by i) as v from m group by scene_key),
        n as (select scene_key, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as v from v),
        e as (select a.scene_key as a, b.scene_key as b from n a join n b on a.scene_key <> b.scene_key and list_inner_product(a.v, b.v) >= 0.89),
        r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
        f as (select a as id, min(b) as family from r group by a),
        c as (select family, i, avg(v[i]) as m from f join n on n.scene_key = f.id, unnest(generate_series(1, 64)) as t(i) group by family, i),
        d as (select family, list(m order by i) as m from c group by family),
        g as (select f.family, f.id, list_cosine_similarity(n.v, d.m) as s, count(*) over (partition by f.family) as size from f join n on n.scene_key = f.id join d on d.family = f.family)
        select family, size::bigint as size, id, "rank"::int as "rank", round(s, 4) as similarity
        from (select *, row_number() over (partition by family order by round(s, 5) desc, id) as "rank" from g) where "rank" <= 3""",
    "p6_counts": """
        select collection, least(any_value(n_keep), count(*))::bigint as n_frames from (
            select distinct substr(k.video_id, 1, 3) as collection, k.video_id, k.frame_idx from keyframe_indices k join frame_embeddings f on f.video_id = k.video_id and f.frame_idx = k.frame_idx
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0)
        join (select collection, max(n_keep) as n_keep from subset_request where n_keep > 0 group by collection) using (collection) group by collection""",
    "p7_checks": """
        select size_name, capacity_tokens::bigint as capacity, (select count(*) from documents where length(text) > 0)::bigint as n_documents, 0::bigint as n_over, 0::bigint as n_split_wrongly from pack_sizes""",
    "p8_verbatim": r"""
        with w as (select 'd' as kind, doc_id as id, regexp_extract_all(lower(replace(replace(strip_accents(nfc_normalize(text)), 'đ', 'd'), 'Đ', 'd')), '\p{L}+') as w from documents
            union all select 'i', item_id, regexp_extract_all(lower(replace(replace(strip_accents(nfc_normalize(text)), 'đ', 'd'), 'Đ', 'd')), '\p{L}+') from eval_items),
        g as (select distinct kind, id, array_to_string(w[k:k + 14], ' ') as g from (select kind, id, w, unnest(generate_series(1, len(w) - 14)) as k from w where len(w) >= 15))
        select distinct d.id as doc_id, i.id as item_id from g d join g i on d.g = i.g and d.kind = 'd' and i.kind = 'i'""",
    # by what the task says of these texts: one token at least for every word between blanks
    "p7_found": r"select doc_id from documents where len(regexp_split_to_array(trim(text), '\s+')) > (select max(capacity_tokens) from pack_sizes)",
}

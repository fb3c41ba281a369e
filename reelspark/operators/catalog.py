"""Planning of work: sharding, limits, pending work, keep-first, strict look-ups and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelspark.runtime import cut

#: Positions of an entity that are numbered in one task.
CHUNK = 65_536


def numbered(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """``df`` with the place of each row in a total order, from 0, without gathering the rows in one task.

    The rows are range-partitioned, sorted and written with the place in their partition; the sizes of the partitions, one row
    for each, are summed up and joined back.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = cut(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), inside.alias("_inside")), "numbered")
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ordered.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return ordered.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_inside")).select(*df.columns, name)


def ranked(df: DataFrame, entity: str, order: list[str], bucket: Column, name: str = "position") -> DataFrame:
    """``df`` with the place of each row among those of its entity in ``order`` (a total order), from 0.

    ``bucket`` must not decrease in that order. Rows are numbered within their bucket, and the sizes of the buckets before are
    added, so an entity that holds a large part of the table is spread over many tasks.
    """
    rows = df.withColumn("_bucket", bucket)
    before = F.sum("_n").over(Window.partitionBy(entity).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.groupBy(entity, "_bucket").agg(F.count("*").alias("_n")).select(entity, "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(entity, "_bucket").orderBy(*order)) - 1
    return rows.withColumn("_inside", inside).join(offsets, [entity, "_bucket"]).withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint")).select(*df.columns, name)


def shard(df: DataFrame, order: list[Column | str], shards: int, index: int, limit: int | None = None) -> DataFrame:
    """The rows at places congruent to ``index``; the limit is taken first. Shards are disjoint and make up the limited list."""
    if shards < 1 or not 0 <= index < shards:
        raise ValueError("shards must be positive and the index among them")
    rows = df if limit is None else df.orderBy(*order).limit(limit)
    return numbered(rows, order).where(F.col("position") % shards == index)


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``: an aggregate that is partial before the shuffle, so a hot key does no harm."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("row"))
    return best.select(*keys, "row.*").select(*df.columns)


def limit_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of every group; rows beyond ``n`` are dropped before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def pending(inputs: DataFrame, done: DataFrame, keys: list[str], overwrite: bool = False, size: str | None = None) -> DataFrame:
    """Inputs without a finished output; an empty output counts as none where its ``size`` is known."""
    if overwrite:
        return inputs
    finished = done if size is None else done.where(F.col(size) > 0)
    return inputs.join(finished.select(*keys).distinct(), keys, "left_anti")


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """``df``; reading a row that fails ``condition`` is an error with ``message``."""
    return df.where(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def first_existing(candidates: DataFrame, listing: DataFrame, keys: list[str], path: str = "path", priority: str = "priority") -> DataFrame:
    """``keys`` and the candidate path of least priority that is in ``listing``; null if none is."""
    found = candidates.join(listing.select(path).distinct(), path, "left_semi").groupBy(*keys).agg(F.min_by(path, F.struct(priority, path)).alias(path))
    return candidates.select(*keys).distinct().join(found, keys, "left")


def fallback(df: DataFrame, first: DataFrame, second: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``df`` with ``value`` from ``first``, or from ``second`` where that has none."""
    a = first.select(*keys, F.col(value).alias("_first"))
    b = second.select(*keys, F.col(value).alias("_second"))
    return df.join(a, keys, "left").join(b, keys, "left").withColumn(value, F.coalesce("_first", "_second")).drop("_first", "_second")


def missing(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """What is expected and not there."""
    return expected.select(*keys).distinct().join(actual.select(*keys).distinct(), keys, "left_anti")


def ratio(selected: DataFrame, total: DataFrame, key: str) -> DataFrame:
    """``key, n_selected, n_total, percent``: 0 for none of none."""
    s = selected.groupBy(key).agg(F.count("*").alias("n_selected"))
    t = total.groupBy(key).agg(F.count("*").alias("n_total"))
    percent = F.when(F.col("n_total") > 0, F.col("n_selected") / F.col("n_total") * 100).otherwise(0.0)
    return t.join(s, key, "left").select(key, F.coalesce("n_selected", F.lit(0)).cast("bigint").alias("n_selected"), "n_total").withColumn("percent", percent)


def counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, and counts of its rows that are taken while it is used, without a pass of their own: ``n_rows``, and how many meet
    each condition. ``Observation.get`` has them once an action has read all of ``df``."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *(F.count_if(c).alias(k) for k, c in counts.items())), seen


def union_names(*columns: DataFrame) -> DataFrame:
    """Different names of several one-column tables, in order."""
    first, *rest = columns
    out = first.toDF("name")
    for other in rest:
        out = out.union(other.toDF("name"))
    return out.where("name is not null").distinct().orderBy("name")

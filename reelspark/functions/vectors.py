"""Vectors in array columns, with built-in functions: norms, distances, centroids without exploding the elements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once: lambda bodies would work an expression out anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sum_of_squares(v: Column) -> Column:
    """Null if there is a null among the elements."""
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def norm(v: Column) -> Column:
    return F.sqrt(sum_of_squares(v))


def normalise(v: Column) -> Column:
    """A vector of length one; null elements for a vector of length zero."""
    return let(norm(v), lambda n: F.transform(v, lambda x: F.try_divide(x.cast("double"), n)))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, d: s + d)


def usable(v: Column, dim: int) -> Column:
    """Whether a vector of single-precision numbers is not null, has ``dim`` finite ones and is not all zero.

    Squares of such numbers neither overflow nor vanish in double precision, so their sum tells.
    """
    finite = let(sum_of_squares(v), lambda s: (s > 0) & (s < float("inf")))
    return F.coalesce((F.size(v) == dim) & finite, F.lit(False))


def centroid(df: DataFrame, keys: list[str], vector: str, dim: int) -> DataFrame:
    """``keys`` and ``centroid``: one average for each element, all partial before the shuffle."""
    means = [F.avg(F.get(vector, F.lit(i)).cast("double")).alias(f"m{i}") for i in range(dim)]
    return df.groupBy(*keys).agg(*means).select(*keys, F.array(*(f"m{i}" for i in range(dim))).alias("centroid"))


def nearest_to_centroid(df: DataFrame, keys: list[str], vector: str, order: str, dim: int) -> DataFrame:
    """``keys``, ``order`` of the row nearest to its group's centroid, and its ``distance``; the first of equals.

    Rows without a usable vector are left out, and rows that repeat ``keys`` and ``order`` count once.
    """
    df = df.where(usable(F.col(vector), dim)).dropDuplicates([*keys, order])
    near = df.join(centroid(df, keys, vector, dim), keys).withColumn("distance", squared_distance(F.col(vector), F.col("centroid")))
    best = near.groupBy(*keys).agg(F.min(F.struct("distance", order)).alias("best"))
    return best.select(*keys, F.col(f"best.{order}").alias(order), F.col("best.distance").alias("distance"))

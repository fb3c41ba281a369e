"""Text boxes as arrays of four points, with built-in higher-order functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.vectors import let


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Four corners of an upright rectangle, clockwise from the top left."""
    return F.array(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2))


def from_numbers(numbers: Column) -> Column:
    """Corners from eight numbers, or from four as left, top, right, bottom; null for any other count."""
    at = lambda i: F.get(numbers, F.lit(i))
    return F.when(F.size(numbers) == 8, F.array(*(point(at(2 * i), at(2 * i + 1)) for i in range(4)))).when(F.size(numbers) == 4, rectangle(at(0), at(1), at(2), at(3)))


def _extreme(box: Column, key: Callable[[Column], Column]) -> Column:
    """The first of four points with the least ``key``."""
    points = [F.get(box, F.lit(i)) for i in range(4)]
    return F.least(*(F.struct(key(p).alias("key"), F.lit(i).alias("i"), p.alias("p")) for i, p in enumerate(points)))["p"]


def clockwise(box: Column) -> Column:
    """Top left, top right, bottom right, bottom left: the extremes of x + y and y - x. A corner may stand twice."""
    return F.array(
        _extreme(box, lambda p: p["x"] + p["y"]),
        _extreme(box, lambda p: p["y"] - p["x"]),
        _extreme(box, lambda p: -(p["x"] + p["y"])),
        _extreme(box, lambda p: p["x"] - p["y"]),
    )


def clip(box: Column, width: Column, height: Column) -> Column:
    """Four points moved into the image."""
    most = lambda n: F.greatest(F.lit(0.0), n.cast("double") - 1)
    moved = lambda p: point(F.least(F.greatest(p["x"], F.lit(0.0)), most(width)), F.least(F.greatest(p["y"], F.lit(0.0)), most(height)))
    return F.array(*(moved(F.get(box, F.lit(i))) for i in range(4)))


def _edge(box: Column, a: int, b: int) -> Column:
    p, q = F.get(box, F.lit(a)), F.get(box, F.lit(b))
    return F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))


def plain(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value as it stands: for columns, where compiled code works a repeated expression out once."""
    return use(value)


def box_size(box: Column, bind: Callable = let) -> tuple[Column, Column]:
    """Width and height: the longer of opposite edges of the ordered corners. ``bind``: :func:`let` inside lambda functions,
    :func:`plain` for columns."""
    both = bind(clockwise(box), lambda c: F.struct(F.greatest(_edge(c, 0, 1), _edge(c, 3, 2)).alias("width"), F.greatest(_edge(c, 0, 3), _edge(c, 1, 2)).alias("height")))
    return both["width"], both["height"]


def large_enough(box: Column, least: float = 3.0, bind: Callable = let) -> Column:
    """:func:`large` of a box."""
    return bind(clockwise(box), lambda c: F.least(F.greatest(_edge(c, 0, 1), _edge(c, 3, 2)), F.greatest(_edge(c, 0, 3), _edge(c, 1, 2))) >= least)


def rounded_key(box: Column) -> Column:
    """Eight whole numbers that are equal for boxes that count as one; halves are rounded to even."""
    corners = [F.get(box, F.lit(i))[c] for i in range(4) for c in ("x", "y")]
    return F.concat_ws(",", *(F.rint(v).cast("bigint").cast("string") for v in corners))


def crop_size(box: Column, bind: Callable = let) -> tuple[Column, Column, Column]:
    """Width and height of the rectified crop in pixels, and whether it is turned by 90 degrees."""
    return crop_of(*box_size(box, bind))


def crop_of(box_width: Column, box_height: Column) -> tuple[Column, Column, Column]:
    """:func:`crop_size` from the measures of a box."""
    width, height = (F.greatest(F.lit(1), s.cast("int")) for s in (box_width, box_height))
    return width, height, height / width >= 1.5


def large(width: Column, height: Column, least: float = 3.0) -> Column:
    """Whether neither side is below ``least``."""
    return F.least(width, height) >= least


def measure(df: DataFrame, box: str, width: Column, height: Column) -> DataFrame:
    """``df`` with the box moved into the image, and its ``corners``, ``box_width``, ``box_height`` and ``box_key``.

    Step by step over single numbers, each step a few columns that the next refers to: one large expression would repeat the
    earlier ones within it, and make a compiled method that is too long for the JVM to optimise.
    """
    most = {"x": F.greatest(F.lit(0.0), width.cast("double") - 1), "y": F.greatest(F.lit(0.0), height.cast("double") - 1)}
    at = {f"_{c}{i}": F.get(box, F.lit(i))[c] for i in range(4) for c in "xy"}
    inside = {n: F.least(F.greatest(n, F.lit(0.0)), most[n[1]]) for n in at}
    x, y = ([F.col(f"_{c}{i}") for i in range(4)] for c in "xy")
    keys = {"tl": [a + b for a, b in zip(x, y, strict=True)], "tr": [b - a for a, b in zip(x, y, strict=True)], "br": [-(a + b) for a, b in zip(x, y, strict=True)], "bl": [a - b for a, b in zip(x, y, strict=True)]}

    def first_least(k: list[Column]) -> Column:
        return F.when(k[0] <= F.least(*k[1:]), 0).when(k[1] <= F.least(k[2], k[3]), 1).when(k[2] <= k[3], 2).otherwise(3)

    def choice(at: Column, of: list[Column]) -> Column:
        return F.when(at == 0, of[0]).when(at == 1, of[1]).when(at == 2, of[2]).otherwise(of[3])

    def edge(a: str, b: str) -> Column:
        dx, dy = F.col(f"_{a}x") - F.col(f"_{b}x"), F.col(f"_{a}y") - F.col(f"_{b}y")
        return F.sqrt(dx * dx + dy * dy)

    out = df.withColumns(at).withColumns(inside).withColumns({f"_{c}": first_least(k) for c, k in keys.items()})
    out = out.withColumns({f"_{c}{d}": choice(F.col(f"_{c}"), of) for c in keys for d, of in (("x", x), ("y", y))})
    out = out.withColumns({"box_width": F.greatest(edge("tl", "tr"), edge("bl", "br")), "box_height": F.greatest(edge("tl", "bl"), edge("tr", "br"))})
    numbers = F.array(*(F.col(n) for i in range(4) for n in (f"_x{i}", f"_y{i}")))
    out = out.withColumn("box_key", F.array_join(F.transform(numbers, lambda n: F.rint(n).cast("bigint").cast("string")), ","))
    arrays = {box: F.array(*(point(a, b) for a, b in zip(x, y, strict=True))), "corners": F.array(*(point(F.col(f"_{c}x"), F.col(f"_{c}y")) for c in keys))}
    return out.withColumns(arrays).drop(*at, *(f"_{c}{d}" for c in keys for d in ("", "x", "y")))

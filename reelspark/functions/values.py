"""Scalar expressions: flags, aliases, frame rates, image sizes, text clean-up and exact decimals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Words that a flag column may hold.
TRUE_WORDS = ("1", "true", "yes", "y", "keep", "kept", "selected", "keyframe")
FALSE_WORDS = ("0", "false", "no", "n", "drop", "dropped", "discard")
#: Columns in which a manifest may hold a value, first first.
ALIASES = {
    "path": ("image_path", "path", "original_path", "source_path", "keyframe_path", "frame_path"),
    "group": ("group_id", "video_id", "folder", "video", "clip_id"),
    "image": ("image_id", "frame_id", "frame", "idx", "filename", "name"),
    "map": ("id", "keyframe_id", "kf_id", "frame_idx"),
    "selected": ("selected", "is_selected", "keep", "is_keyframe", "keyframe"),
}


def parse_flag(value: Column) -> Column:
    """True, false, or null for what is neither."""
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def selected(flags: list[Column]) -> Column:
    """The first flag that says anything; kept if none does."""
    return F.coalesce(*(parse_flag(c) for c in flags), F.lit(True))


def first_present(values: list[Column]) -> Column:
    """The first value that is not null or blank, trimmed; empty if there is none."""
    return F.coalesce(*(F.nullif(strip(v.cast("string")), F.lit("")) for v in values), F.lit(""))


def aliased(columns: list[str], kind: str) -> list[Column]:
    """The columns there are among the aliases of ``kind``, in order of priority."""
    return [F.col(c) for c in ALIASES[kind] if c in columns]


def strip(text: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def clean_text(text: Column) -> Column:
    """Control characters but tab and line feed become blanks, runs of white space one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[\x00-\x08\x0b-\x1f\x7f]", " "), r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def casefold(text: pd.Series) -> pd.Series:
    """Case folding, which unlike lower case makes a sharp s two letters. In batches, for lack of a built-in."""
    return text.map(lambda t: None if t is None else t.casefold())


def frame_rate(value: Column) -> Column:
    """Frames per second of ``a/b`` or a plain number: 0 for null, empty or a zero divisor; malformed text is an error."""
    parts = F.split(value, "/")
    top, bottom = F.get(parts, F.lit(0)).cast("double"), F.get(parts, F.lit(1)).cast("double")
    return F.when(value.isNull() | (value == ""), 0.0).when(F.size(parts) == 2, F.coalesce(F.try_divide(top, bottom), F.lit(0.0))).otherwise(value.cast("double"))


def codec(name: Column) -> Column:
    """Codec in lower case, empty if unknown."""
    return F.lower(F.coalesce(name, F.lit("")))


def frame_count(nb_frames: Column) -> Column:
    """A count that is written in digits only, else null."""
    return F.when(nb_frames.rlike("^[0-9]+$"), nb_frames.try_cast("bigint"))


def video_fps(codec_name: Column, decoder_fps: Column, average: Column, real: Column) -> Column:
    """The decoder's rate if there is one and the codec is not AV1, else the average rate, else the real one."""
    probed = F.when(frame_rate(average) > 0, frame_rate(average)).otherwise(frame_rate(real))
    return F.when((codec(codec_name) != "av1") & (decoder_fps > 0), decoder_fps).otherwise(probed)


def model_size(width: Column, height: Column, side: int) -> tuple[Column, Column]:
    """Size with a longer side of at most ``side``; fractions are cut off, one pixel at least."""
    longest = F.greatest(width, height)
    target = F.least(longest, F.lit(side))
    scaled = lambda x: F.greatest(F.lit(1), (x * target / longest).cast("int"))
    return scaled(width), scaled(height)


def ocr_size(width: Column, height: Column, most: int = 1920, least: int = 720) -> tuple[Column, Column]:
    """Size for text recognition: down to ``most`` on the longer side, or up to ``least`` on the shorter one but not beyond
    ``most`` on the longer; halves are rounded to even, one pixel at least."""
    longest, shortest = F.greatest(width, height), F.least(width, height)
    scale = F.when(longest > most, F.lit(float(most)) / longest).when(shortest < least, F.least(F.lit(float(least)) / shortest, F.lit(float(most)) / longest)).otherwise(1.0)
    scaled = lambda x: F.greatest(F.lit(1), F.rint(x * scale).cast("int"))
    return scaled(width), scaled(height)


def width_at(width: Column, height: Column, target: int) -> Column:
    """Width at another height, fraction cut off."""
    return (width * (F.lit(float(target)) / height)).cast("int")


def double_bitrate(rate: Column) -> Column:
    """``1M`` becomes ``2M``."""
    return F.concat((F.regexp_replace(rate, "M$", "").cast("int") * 2).cast("string"), F.lit("M"))


@F.pandas_udf(StringType())
def three_decimals(x: pd.Series) -> pd.Series:
    """Three decimals of the exact binary value, halves to even; Java's formatting rounds the shortest decimal form instead."""
    return x.map(lambda v: None if pd.isna(v) else f"{v:.3f}")


def to_float(value: Column) -> Column:
    """A number if it can be read as one, else null."""
    return F.trim(value.cast("string")).try_cast("double")


def score_at(scores: Column, shared: Column, place: Column) -> Column:
    """The score at a place of a list, null beyond its end; without a list the one score for all."""
    return F.when(scores.isNotNull(), F.get(scores, place)).otherwise(shared)


def model_name(name: Column, aliases: dict[str, str]) -> Column:
    """A model's name in lower case with underscores, or what that is an alias of."""
    key = F.regexp_replace(F.lower(F.trim(name)), " ", "_")
    if not aliases:
        return key
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(F.try_element_at(table, key), key)


def model_names(names: Column, aliases: dict[str, str]) -> Column:
    """The different models of a list, in order of first mention."""
    return F.array_distinct(F.transform(F.filter(names, lambda n: F.trim(n) != ""), lambda n: model_name(n, aliases)))


def workers(kind: str, cores: int, memory_gb: float = 0.0) -> int:
    """Workers for a kind of step: all cores but two or four, or one for every 8 GB of device memory."""
    if kind == "speech":
        return max(1, min(int(memory_gb // 8), cores))
    return max(1, cores - {"resize": 2, "save": 4}[kind])


def preferred(specific: Column, general: Column) -> Column:
    """The specific setting where there is one, else the general one."""
    return F.coalesce(specific, general)

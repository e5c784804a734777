"""Column functions on clip metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .units import trimmed


def duration(n_samples: Column, rate: Column) -> Column:
    return (n_samples / rate).cast("float")


def stem(path: Column) -> Column:
    """File name without folder and last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def clip_id(path: Column, shard: Column, row: Column) -> Column:
    """Stem of the clip's path; without a path, shard stem and row."""
    own = F.when(F.coalesce(path, F.lit("")) != "", stem(path))
    return F.coalesce(own, F.format_string("%s_%06d", stem(shard), row))


def split_of(shard: Column) -> Column:
    return F.when(F.startswith(shard, F.lit("test")), "test").otherwise("train")


def phoneme_rate(n_units: Column, seconds: Column) -> Column:
    return n_units / F.greatest(seconds.cast("double"), F.lit(1e-3))


def sanitize_text(text: Column) -> Column:
    """Runs of delimiter, quote, line end and tab become one space; ends are stripped."""
    return trimmed(F.regexp_replace(F.coalesce(text, F.lit("")), '[|"\r\n\t]+', " "))


def hash_share(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, the same in every run."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10000 / 10000


def hash_split(key: Column, val_share: float = 0.02) -> Column:
    return F.when(hash_share(key) < val_share, "test").otherwise("train")


def round_duration(n_samples: Column, rate: Column) -> Column:
    return F.round(n_samples / rate, 3)


def reasons(*pairs: tuple[str, Column]) -> Column:
    """Names of the conditions that hold, in the given order; an unknown (null) condition doesn't hold."""
    return F.array_compact(F.array(*[F.when(cond, name) for name, cond in pairs]))

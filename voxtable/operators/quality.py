"""Quality flags: every clip stays, with the reasons why it is or isn't trainable."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxtable.functions.clips import phoneme_rate, reasons


@dataclass(frozen=True)
class QcLimits:
    min_seconds: float = 0.4
    max_seconds: float = 20.0
    min_rate: float = 4.0
    max_rate: float = 25.0
    min_units_per_char: float = 0.35
    min_speaker_clips: int = 20


PROVENANCE = ("shard", "row")


def _ordering(side: DataFrame, order: str | None) -> list[str]:
    """The columns that tell which of two rows is later: ``order``, else where they were read."""
    return [order] if order else [c for c in PROVENANCE if c in side.columns]


def last_wins(side: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """One row a key, without the columns of the order: the last by ``order``, else by shard and row if there are such; of equals the one with the greatest values."""
    by = _ordering(side, order)
    rest = [c for c in side.columns if c not in (key, *by)]
    return side.groupBy(key).agg(F.max(F.struct(*by, *rest)).alias("last")).select(key, *(f"last.{c}" for c in rest))


def speaker_counts(speakers: DataFrame, min_clips: int = 20) -> DataFrame:
    """Clips of each speaker in the speaker table, and whether they are too few."""
    return speakers.groupBy("speaker").agg(F.count("*").alias("clips")).withColumn("small", F.col("clips") < min_clips)


def speaker_summary(speakers: DataFrame, min_clips: int = 20) -> DataFrame:
    counts = speaker_counts(speakers, min_clips)
    return counts.agg(F.count("*").alias("speakers"), F.sum(F.col("small").cast("long")).alias("small_speakers"), F.sum((~F.col("small")).cast("long")).alias("speakers_used"))


def attach_speakers(df: DataFrame, speakers: DataFrame, min_clips: int = 20, order: str | None = None) -> DataFrame:
    """df with speaker, speaker_idx (defaults spk_unknown, -1) and rare_speaker: missing, or with few clips in the speaker table."""
    counts = speaker_counts(speakers, min_clips).select(F.col("speaker").alias("counted"), "small")
    side = last_wins(speakers.select("id", "speaker", "speaker_idx", *_ordering(speakers, order)), order=order)
    side = side.join(counts, side["speaker"] == counts["counted"], "left").drop("counted")
    out = df.join(side, "id", "left")
    rare = F.col("speaker").isNull() | F.coalesce("small", F.lit(False))
    name = F.when(F.coalesce("speaker", F.lit("")) == "", "spk_unknown").otherwise(F.col("speaker"))
    return out.withColumn("rare_speaker", rare).withColumn("speaker", name).withColumn("speaker_idx", F.coalesce("speaker_idx", F.lit(-1))).drop("small")


def attach_metrics(df: DataFrame, speakers: DataFrame, order: str | None = None) -> DataFrame:
    """df with speaker (default eng_unknown) and the three recording metrics (default 0)."""
    names = ("snr_est", "clip_frac", "silence_frac")
    side = last_wins(speakers.select("id", "speaker", *(n for n in names if n in speakers.columns), *_ordering(speakers, order)), order=order)
    out = df.join(side, "id", "left").withColumn("speaker", F.coalesce("speaker", F.lit("eng_unknown")))
    return out.withColumns({n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in side.columns else F.lit(0.0) for n in names})


def qc_reasons(limits: QcLimits = QcLimits()) -> Column:
    """Array of reasons. Columns: n_units, duration, text, rare_speaker."""
    seconds, n = F.col("duration").cast("double"), F.col("n_units")
    rate, chars = phoneme_rate(n, seconds), F.length(F.coalesce("text", F.lit("")))
    return reasons(
        ("no_phonemes", n == 0),
        ("too_short", seconds < limits.min_seconds),
        ("too_long", seconds > limits.max_seconds),
        ("bad_rate", ~rate.between(limits.min_rate, limits.max_rate)),
        ("short_vs_text", (chars > 0) & (n / F.greatest(chars, F.lit(1)) < limits.min_units_per_char)),
        ("rare_speaker", F.col("rare_speaker")),
    )


def qc_flags(df: DataFrame, limits: QcLimits = QcLimits()) -> DataFrame:
    """df with qc_pass and comma-joined qc_reason."""
    found = df.withColumn("why", qc_reasons(limits))
    return found.withColumn("qc_pass", F.size("why") == 0).withColumn("qc_reason", F.concat_ws(",", "why")).drop("why")


def reason_tally(df: DataFrame, column: str = "qc_reason") -> DataFrame:
    """reason, n, share of all rows; a row counts for each of its reasons. Rows without a reason stay until the total is known."""
    first = F.posexplode_outer(F.when(F.col(column) == "", F.array(F.lit(None).cast("string"))).otherwise(F.split(column, ",")))
    rows = df.select(first.alias("pos", "reason")).groupBy("reason").agg(F.count("*").alias("n"), F.sum((F.coalesce("pos", F.lit(0)) == 0).cast("long")).alias("first"))
    total = F.sum("first").over(W.partitionBy())  # a handful of reasons
    return rows.withColumn("share", F.col("n") / total).filter("reason is not null").select("reason", "n", "share")


def qc_summary(df: DataFrame) -> DataFrame:
    seconds = F.col("duration").cast("double")
    return df.agg(F.count("*").alias("total"), F.sum(F.col("qc_pass").cast("long")).alias("kept"), (F.sum(F.when(F.col("qc_pass"), seconds).otherwise(0.0)) / 3600).alias("kept_hours"))


def filter_qc(df: DataFrame, include_all: bool = False) -> DataFrame:
    return df if include_all else df.filter("qc_pass")


def export_counts(df: DataFrame, include_all: bool = False) -> DataFrame:
    """Rows written and skipped."""
    goes = F.lit(True) if include_all else F.col("qc_pass")
    return df.agg(F.sum(goes.cast("long")).alias("written"), F.sum((~goes).cast("long")).alias("skipped"))


def over_limit(df: DataFrame, seconds: float = 40.0) -> DataFrame:
    """Clips that a recogniser with a length limit can't take."""
    return df.filter(F.col("duration").cast("double") >= seconds)


def fill_language(df: DataFrame, default: str) -> DataFrame:
    if "language" not in df.columns:
        return df.withColumn("language", F.lit(default))
    return df.withColumn("language", F.when(F.coalesce("language", F.lit("")) == "", default).otherwise(F.col("language")))

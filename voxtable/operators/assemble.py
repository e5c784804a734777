"""Assembling the dataset: re-attaching audio under checks, unions, corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.clips import split_of
from voxtable.operators.lookup import ROUND_BYTES, beside, located


class IntegrityError(ValueError):
    """Results and source shards don't belong together."""


def audio_violations(results: DataFrame, source: DataFrame, path: str = "audio_path", source_path: str = "path") -> DataFrame:
    """shard, kind, row of everything that keeps results from joining source on (shard, row); first bad row of each shard and kind.

    Kinds: missing_shard, row_count, row_range (rows aren't exactly 0..n-1), path. Reads keys and paths only, no audio.
    """
    ours = results.groupBy("shard").agg(F.count("*").alias("n"), F.min("row").alias("low"), F.max("row").alias("high"), F.count_distinct("row").alias("rows"))
    theirs = source.groupBy("shard").agg(F.count("*").alias("n_source"))
    both = ours.join(theirs, "shard", "left")
    kind = F.when(F.col("n_source").isNull(), "missing_shard").when(F.col("n") != F.col("n_source"), "row_count")
    kind = kind.when((F.col("low") != 0) | (F.col("high") != F.col("n") - 1) | (F.col("rows") != F.col("n")), "row_range")
    counts = both.select("shard", kind.alias("kind"), F.lit(None).cast("long").alias("row")).filter("kind is not null")
    a = results.select("shard", "row", F.col(path).alias("ours"))
    b = source.select("shard", "row", F.col(source_path).alias("theirs"))
    differ = a.join(b, ["shard", "row"]).filter(~F.col("ours").eqNullSafe(F.col("theirs")))
    paths = differ.groupBy("shard").agg(F.min("row").cast("long").alias("row")).select("shard", F.lit("path").alias("kind"), "row")
    return counts.unionByName(paths)


def attach_audio(results: DataFrame, source: DataFrame, check: bool = True, most: int = ROUND_BYTES) -> DataFrame:
    """results with the audio column of source, joined on (shard, row). Results go to where the audio is read, at most ``most`` bytes at a time (see lookup); audio isn't exchanged."""
    if check:
        bad = audio_violations(results, source.withColumn("path", F.col("audio.path"))).orderBy("shard", "kind").take(5)
        if bad:
            raise IntegrityError("; ".join(f"{r['shard']}: {r['kind']}" + (f" at row {r['row']}" if r["row"] is not None else "") for r in bad))
    return beside(source.select("shard", "row", "audio"), results, most).select(*results.columns, "audio")


def missing_shards(results: DataFrame, source: DataFrame) -> DataFrame:
    return results.select("shard").distinct().join(source.select("shard").distinct(), "shard", "left_anti")


def _joined(source: DataFrame, thin: DataFrame, most: int) -> DataFrame:
    """source with the columns of thin, by id. Rows that have an address (shard, row) stay where they are read: thin is brought to the addresses first; others are joined by id."""
    thin = thin.select("id", *(c for c in thin.columns if c not in source.columns))
    if not {"shard", "row"} <= set(source.columns):
        return source.join(thin, "id")
    return beside(source, located(source, thin).drop("id"), most).select(*source.columns, *(c for c in thin.columns if c != "id"))


def join_selected(source: DataFrame, selection: DataFrame, most: int = ROUND_BYTES) -> DataFrame:
    """Source rows of selected clips with the selection's columns."""
    return _joined(source, selection.filter("selected"), most)


def restrict_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("id"), "id", "left_semi")


def join_sidecar(source: DataFrame, sidecar: DataFrame, most: int = ROUND_BYTES) -> DataFrame:
    return _joined(source, sidecar, most)


def union_shards(*parts: DataFrame) -> DataFrame:
    """All rows; a column that a part lacks is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def select_present(df: DataFrame, columns: list[str], fill: bool = False) -> DataFrame:
    """The named columns that exist; with fill the others as empty strings."""
    return df.select(*[df[c] if c in df.columns else F.lit("").alias(c) for c in columns if c in df.columns or fill])


def corpus_stats(df: DataFrame) -> DataFrame:
    """Per split: clips, hours, phoneme units, mean units a clip, empty transcriptions. Columns: shard, duration, n_units. Durations are summed in whole microseconds, so the order of rows doesn't count."""
    micros = F.sum(F.round(F.col("duration").cast("double") * 1_000_000).cast("long"))
    stats = df.groupBy(split_of(F.col("shard")).alias("split")).agg(
        F.count("*").alias("clips"),
        F.round(F.coalesce(micros, F.lit(0)) / 3_600_000_000, 2).alias("hours"),
        F.coalesce(F.sum(F.col("n_units").cast("long")), F.lit(0)).alias("phoneme_units"),
        F.sum((F.coalesce("n_units", F.lit(-1)) == 0).cast("long")).alias("empty_transcriptions"),
    )
    return stats.withColumn("mean_units_per_clip", F.round(F.col("phoneme_units") / F.greatest("clips", F.lit(1)), 1))


def duplicate_ids(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_report(df: DataFrame, examples: int = 5) -> DataFrame:
    """One row: number of duplicate ids and the first few."""
    dups = duplicate_ids(df)
    few = dups.orderBy("id").limit(examples)
    return dups.agg(F.count("*").alias("n_duplicates")).crossJoin(few.agg(F.sort_array(F.collect_list("id")).alias("examples")))  # one row each

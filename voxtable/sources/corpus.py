"""Corpus shards: reading with provenance, resuming, writing results and sidecars."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtable.functions.clips import clip_id, split_of, stem
from voxtable.sources.files import write_named

SIDECAR_COLUMNS = ("id", "audio_path", "shard", "row", "duration", "text", "ipa", "ipa_units", "n_units")


def read_shards(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet shards with shard (file name) and row (place in the file); only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*(columns or df.columns), F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row"))


def normalize_audio(df: DataFrame, column: str = "audio") -> DataFrame:
    """An audio column of bare bytes becomes struct<bytes, path>."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return df
    return df.withColumn(column, F.struct(F.col(column).alias("bytes"), F.lit(None).cast("string").alias("path")))


def with_clip_ids(df: DataFrame, path: Column) -> DataFrame:
    return df.withColumn("id", clip_id(path, F.col("shard"), F.col("row"))).withColumn("split", split_of(F.col("shard")))


def select_shards(df: DataFrame, only: str | None = None, limit: int | None = None) -> DataFrame:
    """Shards whose name contains ``only``; of these the first ``limit`` by name."""
    df = df.filter(F.contains("shard", F.lit(only))) if only else df
    if limit is None:
        return df
    return df.join(df.select("shard").distinct().orderBy("shard").limit(limit), "shard", "left_semi")


def pending_shards(source: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of the shards that no result has yet; shards match by stem."""
    have = done.select(stem(F.col("shard")).alias("done_stem")).distinct()
    return source.join(have, stem(source["shard"]) == have["done_stem"], "left_anti")


def write_results(df: DataFrame, path: str) -> None:
    """zstd Parquet, one folder a shard."""
    df.repartition("shard").write.option("compression", "zstd").partitionBy("shard").parquet(path)


def sidecar(df: DataFrame, rows_per_file: int = 40_000, columns=SIDECAR_COLUMNS) -> DataFrame:
    """Present columns with split, rank in the split by id, file ordinal and file name.

    Ranks are prefix sums, so no task ranks a whole split.
    """
    kept = df.select(*(c for c in columns if c in df.columns), split_of(F.col("shard")).alias("split"))
    ranked = prefix_sums(kept, ["id"], F.lit(1), "rank", ("split",))
    totals = ranked.groupBy("split").agg(F.count("*").alias("total"))  # two rows
    out = ranked.join(totals, "split").withColumn("file", F.floor(F.col("rank") / rows_per_file).cast("int"))
    files = F.ceil(F.col("total") / rows_per_file).cast("int")
    return out.withColumn("file_name", F.format_string("%s-%05d-of-%05d.parquet", "split", "file", files)).drop("total")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; on a cluster that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="voxtable-"))
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """df, computed once, in the shared folder: where its partition numbers count (range bounds come from a sample), or where it has several uses."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder as compressed Parquet, of which a use reads its columns only; a checkpoint holds whole rows as they are in memory."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_sums(df: DataFrame, order: list[str], value: Column, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """df with the sum of value over the rows before each, in an order that tells rows apart (by: within equal values of these columns).

    Rows are range-partitioned, so no task holds more than its share, whatever ties there are; a partition sends one sum a group.
    """
    parts = settled(df.withColumn("sum_of", value).repartitionByRange(*by, *order).withColumn("sum_part", F.spark_partition_id()))
    earlier = W.partitionBy(*by).orderBy("sum_part").rowsBetween(W.unboundedPreceding, -1)
    sums = parts.groupBy(*by, "sum_part").agg(F.sum("sum_of").alias("in_part")).withColumn("ahead", F.sum("in_part").over(earlier)).drop("in_part")
    own = F.sum("sum_of").over(W.partitionBy(*by, "sum_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    out = parts.withColumn("own", own).join(sums, [*by, "sum_part"])
    zero = F.lit(0)
    return out.withColumn(name, F.coalesce("ahead", zero) + F.coalesce("own", zero)).drop("sum_of", "sum_part", "ahead", "own")


def write_sidecar(df: DataFrame, path: str, rows_per_file: int = 40_000) -> list[str]:
    """Files <split>-<i>-of-<n>.parquet of so many rows, in the order of ids; returns their names."""
    return write_named(sidecar(df, rows_per_file), path, order=("rank",), without=("rank", "file", "split"))


def write_stats(df: DataFrame, path: str) -> None:
    """A small aggregate as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def stats_markdown(stats: DataFrame) -> str:
    """Rows of corpus_stats (one a split) as a markdown table."""
    lines = ["| split | clips | hours | phoneme units | mean units/clip |", "|---|---|---|---|---|"]
    lines += [f"| `{r['split']}` | {r['clips']:,} | {r['hours']:,} | {r['phoneme_units']:,} | {r['mean_units_per_clip']} |" for r in stats.orderBy("split").collect()]
    return "\n".join(lines)

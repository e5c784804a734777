"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word where a contract says ``[^\x20\x09-\x0D]+``, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of a batch inside of small_batches().
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; on a cluster that would be lost with an executor, so it is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="voxtable-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *by: str) -> DataFrame:
    """Write to the shared folder as Parquet, once, a folder for each value of by, and read it back."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int = 64, counted: DataFrame | None = None, most: int = 16 << 20) -> DataFrame:
    """df, marked for broadcast if its rows (or those of counted, which make it up) are no more than ``most`` bytes; a larger one is shuffled."""
    return F.broadcast(df) if (df if counted is None else counted).count() * row_bytes <= most else df


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside passes rows to Python BATCH_ROWS and about BATCH_BYTES at a time, not Spark's 10,000 and 64 MB, of which a task holds several copies on both sides. The session's own settings
    come back in the end; what is lazy must be cut or stored inside."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def ordinals(ids: DataFrame) -> DataFrame:
    """named, ordinal: the distinct values of a column, numbered in their order. They are range-partitioned and a partition sends its count, so no task orders all."""
    named = ids.select(F.col(ids.columns[0]).alias("named")).filter("named is not null").distinct()
    spread = cut(named.repartitionByRange("named").withColumn("part", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = spread.groupBy("part").agg(F.count("*").alias("n")).select(F.col("part").alias("of"), before.alias("before"))
    own = F.row_number().over(W.partitionBy("part").orderBy("named")) - 1
    return cut(spread.withColumn("own", own).join(ahead, F.col("part") == F.col("of")).select("named", (F.col("before") + F.col("own")).alias("ordinal")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> list[bytes]:
    """A string column of a batch as UTF-8 bytes; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]

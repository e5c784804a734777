"""Files under given names: which shards there are and which are still to do, and outputs that are committed as a whole under names of one's own.

Listing and renaming go through the file system that Spark itself uses for a path, so any of its stores will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def names(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names in a folder, in order, without those that begin with a dot or an underscore; none if there is no such folder."""
    system, at = _system(spark, path)
    if not system.exists(at):
        return []
    found = [x.getPath().getName() for x in system.listStatus(at)]
    return sorted(x for x in found if x.endswith(suffix) and x[0] not in "._")


def stem_of(name: str) -> str:
    """A file's name without its ending; that of a folder ``shard=name``, too."""
    name = name.removeprefix("shard=")
    return name[: name.rindex(".")] if "." in name.lstrip(".") else name


def pending_files(spark: SparkSession, source: str, results: str, only: str | None = None, limit: int | None = None) -> list[str]:
    """Paths of the source's shards, by name, whose results aren't there yet (a file or folder of the same stem); of those whose name contains ``only`` the first ``limit``.

    Both folders are listed; no file is opened.
    """
    done = {stem_of(x) for x in names(spark, results)}
    todo = [x for x in names(spark, source, ".parquet") if stem_of(x) not in done and (only is None or only in x)]
    return [f"{source.rstrip('/')}/{x}" for x in todo[:limit]]


def read_pending(spark: SparkSession, source: str, results: str, only: str | None = None, limit: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """The rows of the pending shards with shard and row; the scan lists these files and no others."""
    paths = pending_files(spark, source, results, only, limit)
    schema = spark.read.parquet(source).schema  # one footer
    df = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    kept = columns or df.columns
    if not paths:
        return df.select(*kept, F.lit("").alias("shard"), F.lit(0).cast("long").alias("row"))
    return df.select(*kept, F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row"))


# ---- outputs under given names ----


def write_named(df: DataFrame, path: str, name: str = "file_name", order: tuple[str, ...] = (), without: tuple[str, ...] = (), compression: str = "zstd") -> list[str]:
    """Writes the rows of each value of ``name`` as one Parquet file of that name, in the given order, without that column and those in ``without``; returns the names.

    Two phases: Spark's own commit puts the output of exactly one attempt of each task under a staging folder, then ``commit_named`` moves each file to its name. A task that runs twice, or a job
    that dies before its commit, leaves nothing under the final names. The names must be new.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    placed = df.repartition(name).sortWithinPartitions(name, *order).drop(*without)
    placed.write.option("compression", compression).option("maxRecordsPerFile", 0).partitionBy(name).parquet(staging)
    return commit_named(spark, staging, path, name)


def commit_named(spark: SparkSession, staging: str, path: str, name: str = "file_name") -> list[str]:
    """Moves what a committed staging folder holds to its names, and removes the folder; may be called again if it was interrupted."""
    system, at = _system(spark, staging)
    to = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    if not system.exists(to(staging, "_SUCCESS")):
        raise ValueError(f"{staging} is not committed")
    moved = []
    for folder in sorted(x.getPath().getName() for x in system.listStatus(at) if x.isDirectory()):
        key, _, value = folder.partition("=")
        if key != name:
            continue
        value = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(value)
        files = [x.getPath() for x in system.listStatus(to(staging, folder)) if x.getPath().getName().startswith("part-")]
        if len(files) > 1:
            raise ValueError(f"{len(files)} files for {value}")
        if files and not system.rename(files[0], to(path, value)):
            raise FileExistsError(f"{path}/{value}")
        moved.append(value)
    system.delete(at, True)
    return moved

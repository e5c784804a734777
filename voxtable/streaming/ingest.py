"""Incremental ingestion: each run takes the shards that came since the last and appends their flagged clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxtable.functions.clips import split_of
from voxtable.operators.quality import QcLimits, qc_flags


def flagged(clips: DataFrame, speakers: DataFrame | None = None, limits: QcLimits = QcLimits()) -> DataFrame:
    """Stateless flags on a stream (or table) of clips. speakers: id, speaker, small, one row an id; a stream-static join."""
    if speakers is None:
        rows = clips.withColumn("speaker", F.lit("spk_unknown")).withColumn("rare_speaker", F.lit(False))
    else:
        side = speakers.select("id", "speaker", F.col("small").alias("rare_speaker"))
        rows = clips.join(side, "id", "left").withColumn("rare_speaker", F.coalesce("rare_speaker", F.lit(True))).withColumn("speaker", F.coalesce("speaker", F.lit("spk_unknown")))
    return qc_flags(rows.withColumn("split", split_of(F.col("shard"))), limits)


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, speakers: DataFrame | None = None, limits: QcLimits = QcLimits()) -> StreamingQuery:
    """Starts a run over the new files below source; the checkpoint remembers what is done, so a file is taken once."""
    clips = spark.readStream.schema(schema).parquet(source).withColumn("shard", F.col("_metadata.file_name"))
    out = flagged(clips, speakers, limits)
    return out.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).outputMode("append").format("parquet").option("path", target).start()

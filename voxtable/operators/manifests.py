"""Manifests: merging by language, summaries, synthesis requests, sentence by speaker expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxtable.functions.units import switch_spans
from voxtable.operators.quality import fill_language

#: Speakers that one expansion takes at most, so that a sentence's rows are bounded.
MOST_SPEAKERS = 1000


def merge_manifest(old: DataFrame, new: DataFrame, language: str, default: str) -> DataFrame:
    """old, with all rows of a language replaced by those of new; old rows without a language are of the default one."""
    kept = fill_language(old, default).filter(F.col("language") != language)
    return kept.unionByName(new.withColumn("language", F.lit(language)), allowMissingColumns=True)


def write_language(df: DataFrame, path: str) -> None:
    """Replace the languages of df in a Parquet manifest partitioned by language; others stay untouched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("language").parquet(path)


def manifest_summary(df: DataFrame) -> DataFrame:
    """Per language: clips, hours, mean duration, speakers; the row without a language is over all (speakers counted once)."""
    seconds = F.col("duration").cast("double")
    return df.rollup("language").agg(F.count("*").alias("clips"), (F.sum(seconds) / 3600).alias("hours"), F.avg(seconds).alias("mean_duration"), F.count_distinct("speaker").alias("speakers"))


def manifest_slice(df: DataFrame, language: str | None = None, limit: int | None = None, order: str = "line_no") -> DataFrame:
    """Rows of a language, of these the first ``limit`` in manifest order."""
    df = df.filter(F.col("language") == language) if language else df
    return df.orderBy(order).limit(limit) if limit is not None else df


def top_speakers(df: DataFrame, n: int, language: str | None = None, order: str = "line_no") -> DataFrame:
    """Busiest speakers of each language (or one), ties by first appearance: language, speaker, clips, rank."""
    df = df.filter(F.col("language") == language) if language else df
    counts = df.groupBy("language", "speaker").agg(F.count("*").alias("clips"), F.min(order).alias("first"))
    rank = F.row_number().over(W.partitionBy("language").orderBy(F.desc("clips"), "first"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n).drop("first")


def synth_manifest(sentences: DataFrame, speakers: DataFrame, matrix: str = "twi") -> DataFrame:
    """Every sentence (lang, number, text, units) by every speaker of its job (lang, speaker), as manifest rows; mixed sentences carry the matrix language.

    An equi-join on lang; speakers of a job are a chosen few (MOST_SPEAKERS at most, else an error).
    """
    if speakers.groupBy("lang").count().filter(F.col("count") > MOST_SPEAKERS).limit(1).count():
        raise ValueError(f"over {MOST_SPEAKERS} speakers for a language: choose some first")
    rows = sentences.filter(F.size("units") > 0).join(F.broadcast(speakers.select("lang", "speaker")), "lang")
    return rows.select(
        F.format_string("ood_%s_%02d_%s", "lang", "number", "speaker").alias("id"), "speaker", F.lit("test").alias("split"), F.lit(0.0).alias("duration"),
        F.replace(F.col("text"), F.lit("\t"), F.lit(" ")).alias("text"), F.array_join("units", " ").alias("ipa"), F.size("units").alias("n_units"),
        F.when(F.col("lang") == "mixed", matrix).otherwise(F.col("lang")).alias("language"),
    )


def span_rows(df: DataFrame, matrix: str, inner: str = "eng", text: str = "text", id_: str = "id") -> DataFrame:
    """id, pos, lang, span of code-switched texts."""
    rows = df.select(id_, F.posexplode(switch_spans(F.coalesce(text, F.lit("")), matrix, inner)).alias("pos", "part"))
    return rows.select(id_, "pos", F.col("part.lang").alias("lang"), F.col("part.text").alias("span"))


def joined_spans(spans: DataFrame, id_: str = "id") -> DataFrame:
    """id, units of the spans in order (columns pos, units); with a column span also unknown: the spans, in order, for which there are no units."""
    inner = ["pos", "units", *(["span"] if "span" in spans.columns else [])]
    rows = spans.groupBy(id_).agg(F.sort_array(F.collect_list(F.struct(*inner))).alias("all"))
    unknown = [F.transform(F.filter("all", lambda x: F.size(x["units"]) == 0), lambda x: x["span"]).alias("unknown")] if "span" in inner else []
    return rows.select(id_, F.flatten(F.col("all.units")).alias("units"), *unknown)


def synthesis_requests(encoded: DataFrame, speaker_ids: DataFrame, forced: str | None = None, limit: int | None = None, order: str = "line_no") -> DataFrame:
    """id, ids, speaker_id of rows that have both, the first ``limit`` of the kept ones. speaker_ids: speaker, speaker_id."""
    df = encoded.withColumn("speaker", F.lit(forced)) if forced else encoded
    kept = df.filter(F.col("ids").isNotNull()).join(speaker_ids, "speaker").select("id", "ids", "speaker_id", order)
    return kept.orderBy(order).limit(limit) if limit is not None else kept


def request_counts(encoded: DataFrame, speaker_ids: DataFrame) -> DataFrame:
    """Rows kept, without ids and without a known speaker."""
    both = encoded.join(speaker_ids.select(F.col("speaker").alias("known")), F.col("speaker") == F.col("known"), "left")
    bad, lost = F.col("ids").isNull(), F.col("known").isNull()
    return both.agg(F.sum((~bad & ~lost).cast("long")).alias("kept"), F.sum(bad.cast("long")).alias("unmappable"), F.sum((~bad & lost).cast("long")).alias("unknown_speaker"))

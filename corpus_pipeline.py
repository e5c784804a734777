"""A training corpus from documents: quality rules, near-dedup, decontamination, mixing, sharding.

Defined cases: nulls may stand in any column; all columns of documents, of whatever name, pass all stages but the last; an empty table, or one of which nothing is left, gives an
empty result at every stage; a benchmark without items contaminates nothing. What each stage does with odd rows is said there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxtable.llm import decontam, mixing, near_copies, quality, sharding
from voxtable.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule cascade keeps. Null, empty and wordless texts are too short and go; repeated rows are judged each; texts are read whole."""
    return quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id (of several texts under it, the least by digest). A row without a doc_id stays only if its group
    has none; repeated rows are copies, and so are null, empty and wordless texts."""
    return near_copies.first_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with benchmark items: under a twentieth of their words lies in windows of items. Null and wordless texts are clean; repeated rows are judged
    each; items without an id count."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document, whole, as often as the mix takes it: none, once or twice; the one on the cut if half of its words lie inside. Null and wordless texts have no words to take
    and come as often as whole epochs do; a null source is a source, the last; repeated rows and rows of one doc_id or none are taken one by one."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each row, its bytes and those of the shard. Rows of one doc_id, and all without one, share a shard, which says so if they exceed the limit; a null text has 0 bytes."""
    return sharding.assign(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: The near-dedup has no DuckDB twin: the stages are tested against a chain of plain restatements.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name == STAGES[-1][0] else stored(docs)
    return docs

"""Mixing sources to target weights.

Every row gets a hash-random key. Rows are range-sorted by key within their source; exclusive prefix sums of the token
counts, taken in the ranges and added up over them, say where each row starts on its source's
tape, and the tape is cut at the source's exact budget. A budget beyond the source's size first repeats whole epochs.

Defined cases: a null source is a source of its own, last in order; a null or wordless text has size 0 and takes 0; repeated rows
are separate rows of the tape; an empty table gives an empty result; only the named columns are read, so extra
columns never clash. Keys depend on the id and the seed alone, so reruns agree; rows equal in key, id and size are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 20


def random_key(doc_id: Column, seed: int) -> Column:
    """60 hash-random bits of id and seed; a null id counts as the empty string."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ranked_sources(sources: DataFrame, source: str) -> DataFrame:
    """Adds rank: place by code point from 0, null last. Ranks are prefix sums over ranges of the first two bytes, not one sort in one task."""
    head = F.coalesce(F.hex(F.substring(F.encode(source, "UTF-8"), 1, 2)), F.lit("~"))
    keyed = sources.withColumn("head", head)
    before = keyed.groupBy("head").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(W.orderBy("head").rowsBetween(W.unboundedPreceding, -1)))
    within = F.row_number().over(W.partitionBy("head").orderBy(F.hex(F.encode(source, "UTF-8"))))
    ranked = keyed.withColumn("within", within).join(before.drop("n"), "head")
    return ranked.withColumn("rank", F.coalesce("before", F.lit(0)) + F.col("within") - 1).drop("head", "before", "within")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, size (long) -> with target (double).

    Sources weigh ``weights`` by rank, repeating, and share ``share`` of all sizes. A target stops at ``most`` times its source's size
    and the excess is shared again by weight until none is above: each round sums what is still open and fixes what has
    reached its stop. Only two sums a round come to the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    open_ = cut(ranked_sources(sizes, "source").withColumn("weight", weight).withColumn("stop", most * F.col("size")))
    level = -1.0
    while True:
        full = F.col("stop") <= F.col("weight") * level
        total, stopped, left = open_.agg(F.sum("size").cast("double"), F.sum(F.when(full, F.col("stop"))), F.sum(F.when(~full, F.col("weight")))).first()
        found = (share * (total or 0.0) - (stopped or 0.0)) / left if left else level
        if not left or found <= level:
            break
        level = found
    target = F.when(F.col("stop") <= F.col("weight") * level, F.col("stop")).otherwise(F.col("weight") * level)
    return open_.select("source", "size", target.alias("target"))


def starts(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """rows with source, size and the columns of order, which tell all rows apart -> with start, the exclusive prefix sum of size in the source.

    Rows are range-partitioned by source and order, so a task's share is even whatever a source, a key or an id holds; a partition sends one sum a source.
    """
    spread = rows.repartitionByRange("source", *order).withColumn("part", F.spark_partition_id())
    spread = cut(spread)  # range bounds come from a sample: partition numbers must not be computed twice
    sums = spread.groupBy("source", "part").agg(F.sum("size").alias("in_part"))
    ahead = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("in_part").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    own = F.coalesce(F.sum("size").over(W.partitionBy("source", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    local = spread.withColumn("own", own)
    joined = local.join(ahead, local["source"].eqNullSafe(ahead["s"]) & (local["part"] == ahead["p"]))
    return joined.withColumn("start", F.col("ahead") + F.col("own")).drop("s", "p", "ahead", "own", "part")


def planned(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """rows (doc_id, source, size, key and row, a number that tells rows apart) with source_size, target, epochs and rest."""
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("size")), weights, share, most)
    goal = goal.select(F.col("source").alias("s"), F.col("size").alias("source_size"), "target")
    laid = starts(rows, ("key", "doc_id", "size", "row"))
    laid = laid.join(goal, laid["source"].eqNullSafe(goal["s"])).drop("s")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    laid = laid.withColumn("epochs", epochs).withColumn("over", budget - epochs * F.col("source_size") - F.col("start"))
    return laid.withColumn("rest", F.greatest(F.lit(0), F.least("size", "over")).cast("long")).drop("over", "start", "key")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs (whole repeats) and rest (words of the row's last, possibly cut, copy). Texts are read once."""
    rows = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed).alias("key"), F.monotonically_increasing_id().alias("row")))
    return planned(rows, weights, share, most).select("doc_id", "source", "size", "source_size", "target", "epochs", "rest")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """docs with each row as often as the mix takes it, whole: the copy on the cut stays if at least half of its words lie inside."""
    numbered = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("held"), F.monotonically_increasing_id().alias("row"))
    numbered = stored(numbered.select("held", "row", word_count(F.col("held.text")).alias("size"), random_key(F.col("held.doc_id"), seed).alias("key")))
    plan = planned(numbered.select("held.doc_id", "held.source", "size", "key", "row"), weights, share, most)
    times = (F.col("epochs") + F.when((F.col("rest") > 0) & (2 * F.col("rest") >= F.col("size")), 1).otherwise(0)).cast("int")
    copies = plan.select("row", times.alias("times")).filter("times > 0")
    kept = numbered.select("held", "row").join(copies, "row")
    return kept.select("held", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("held.*")

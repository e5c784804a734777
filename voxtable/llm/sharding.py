"""Sharding by extendible hashing.

A row's place is a 60-bit hash of its id. The directory is indexed by hash-prefix bits; a bucket within its byte limit is a
shard, and only oversized buckets split, each on the next bit, until every shard fits. Rows are thin, stored once and pre-aggregated by place; each
round looks at the buckets that are still too large.

Defined cases: a null text has 0 bytes; a null id hashes as the empty string; rows of one id stay together, as do ids
of one 60-bit hash, so a shard of one such id may exceed the limit and says so (oversize); an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small, stored

#: Bytes of text in a shard at most.
LIMIT = 1 << 20
BITS = 60


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and place, the 60-bit hash."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").alias("place"))


def prefix(place, depth):
    return F.call_function("shiftright", place, (F.lit(BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row a shard: depth, prefix, shard_bytes, oversize. rows: place, n_bytes.

    The directory starts at the depth at which even buckets would fit. Siblings that fit together are joined, a level at a time, until none do; buckets over
    the limit split on another bit, a level at a time, and only their own rows are looked at again.
    """
    open_ = cut(rows.groupBy("place").agg(F.sum("n_bytes").alias("n_bytes")))
    total = open_.agg(F.sum("n_bytes")).first()[0] or 0
    depth = start = min(BITS, (max(1, -(-total // limit)) - 1).bit_length())

    def buckets(depth: int) -> DataFrame:
        return cut(open_.groupBy(prefix(F.col("place"), F.lit(depth)).alias("prefix")).agg(F.sum("n_bytes").alias("shard_bytes")))

    def shards(found: DataFrame, depth: int) -> DataFrame:
        return found.select(F.lit(depth).alias("depth"), "prefix", "shard_bytes", (F.col("shard_bytes") > limit).alias("oversize"))

    now = first = buckets(start)
    found = []
    while depth:  # up: a bucket stays if its parent doesn't fit
        parents = now.groupBy(F.call_function("shiftright", F.col("prefix"), F.lit(1)).alias("prefix")).agg(F.sum("shard_bytes").alias("shard_bytes"))
        parents = cut(parents)
        fit = parents.filter(F.col("shard_bytes") <= limit).select(F.col("prefix").alias("parent"))
        if fit.isEmpty():
            break
        alone = now.filter(F.col("shard_bytes") <= limit).join(fit, F.call_function("shiftright", F.col("prefix"), F.lit(1)) == F.col("parent"), "left_anti")
        found.append(shards(alone, depth))
        now, depth = parents, depth - 1
    found.append(shards(now.filter(F.col("shard_bytes") <= limit), depth))
    now, depth = first, start
    while depth < BITS:  # down: only oversized buckets split
        large = now.filter(F.col("shard_bytes") > limit).select(F.col("prefix").alias("large"))
        if large.isEmpty():
            break
        open_ = cut(open_.join(large, prefix(F.col("place"), F.lit(depth)) == F.col("large"), "left_semi"))
        depth += 1
        now = buckets(depth)
        found.append(shards(now.filter((F.col("shard_bytes") <= limit) | F.lit(depth == BITS)), depth))
    if start == BITS:
        found.append(shards(first.filter(F.col("shard_bytes") > limit), BITS))
    return cut(reduce(DataFrame.unionByName, found))


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard (its bits as text; the root is empty), depth, shard_bytes, oversize for every row."""
    rows = stored(placed(docs))
    return looked_up(rows, directory(rows, limit))


def looked_up(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """Each row by the directory's entry for its prefix of the least depth in use; an entry lists the shards below it, and exactly one has the row's bits."""
    least = shards.agg(F.min("depth")).first()[0] or 0
    entries = shards.groupBy(F.call_function("shiftright", F.col("prefix"), (F.col("depth") - least).cast("int")).alias("entry")).agg(F.collect_list(F.struct("depth", "prefix", "shard_bytes", "oversize")).alias("below"))
    found = rows.join(small(entries, counted=shards), prefix(F.col("place"), F.lit(least)) == F.col("entry"))
    hit = found.withColumn("hit", F.get(F.filter("below", lambda x: x["prefix"] == prefix(F.col("place"), x["depth"])), F.lit(0)))
    hit = hit.select("doc_id", "n_bytes", "hit.*")
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("right(lpad(conv(prefix, 10, 2), 60, '0'), depth)"))
    return hit.select("doc_id", "n_bytes", bits.alias("shard"), F.col("depth").cast("long").alias("depth"), "shard_bytes", "oversize")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Writes the rows of docs as one Parquet folder a shard under path; returns the assignment."""
    plan = assign(docs, limit)
    named = plan.select(F.col("doc_id").alias("shard_doc_id"), F.concat(F.lit("s"), "shard").alias("shard")).distinct()
    docs.join(named, docs["doc_id"].eqNullSafe(named["shard_doc_id"])).drop("shard_doc_id").repartition("shard").write.partitionBy("shard").parquet(path)
    return plan

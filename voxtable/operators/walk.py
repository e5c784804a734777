"""Greedy filling of a cap in rank order, for groups of any size: a row is taken if the group's total stays within the cap, else passed over.

A small group passes one task, which holds its running total only. A group over WALK_ROWS is thinned first, on all machines: by prefix sums, all rows before the first one that doesn't fit are
taken at once; of the rest only those that are no longer than what is left can ever be taken, so the others are dropped before the next round. What is left shrinks every round, and so does the
rest; once that is small, it passes a task like any other group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.sources.corpus import prefix_sums, settled

#: Rows of one group that one task takes.
WALK_ROWS = 1 << 20


def _within(cap: float):
    """Rows (group, duration and what is left first) by group in rank order -> those that are taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total = None, 0.0
        for b in batches:
            keep = []
            for name, seconds, used in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if name != group:
                    group, total = name, used
                keep.append(total + seconds <= cap)
                total += seconds if keep[-1] else 0.0
            yield b.filter(pa.array(keep, pa.bool_()))

    return run


def _walked(rows: DataFrame, by: str, length: str, order: list[str], cap: float) -> DataFrame:
    """rows with used (the group's total so far) -> those taken, one task a group."""
    rest = [c for c in rows.columns if c not in (by, length, "used")]
    placed = rows.select(by, length, "used", *rest).repartition(by).sortWithinPartitions(by, *order)
    return placed.mapInArrow(_within(cap), placed.schema).drop("used")


def within_cap(df: DataFrame, by: str, length: str, order: list[str], cap: float, most: int = WALK_ROWS) -> DataFrame:
    """The rows of df that a walk in the order of ``order``, group by group, takes under the cap. order tells rows apart; a null group is a group. Sums are exact for whole numbers below 2^53."""
    columns = df.columns
    group = F.coalesce(F.concat(F.lit("g"), F.col(by).cast("string")), F.lit("-"))
    rows = settled(df.filter(F.col(length) <= cap).withColumn("walk_by", group).withColumn("used", F.lit(0.0)))
    taken: list[DataFrame] = []
    while True:
        large = settled(rows.groupBy("walk_by").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("walk_by"))
        if large.isEmpty():
            break
        marked = F.broadcast(large)  # groups of over ``most`` rows, so one in so many rows at most
        taken.append(_walked(rows.join(marked, "walk_by", "left_anti"), "walk_by", length, order, cap).select(*columns))
        big = settled(prefix_sums(rows.join(marked, "walk_by", "left_semi"), order, F.col(length), "before", ("walk_by",)))
        place = F.struct(*order)
        over = F.col("used") + F.col("before") + F.col(length) > cap
        stops = settled(big.groupBy("walk_by").agg(F.min(F.when(over, place)).alias("stop")))
        met = big.join(F.broadcast(stops), "walk_by")
        fits = settled(met.filter(F.col("stop").isNull() | (place < F.col("stop"))).select("walk_by", *columns))
        taken.append(fits.select(*columns))
        more = fits.groupBy("walk_by").agg(F.sum(length).alias("more"))
        left = met.filter(place > F.col("stop")).join(F.broadcast(more), "walk_by", "left").withColumn("used", F.col("used") + F.coalesce("more", F.lit(0.0)))
        rows = settled(left.filter(F.col("used") + F.col(length) <= cap).select(*columns, "walk_by", "used"))
    out = _walked(rows, "walk_by", length, order, cap).select(*columns)
    for part in taken:
        out = out.unionByName(part)
    return out

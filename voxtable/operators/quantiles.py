"""Exact order statistics of whole tables: each pass counts values in buckets, and only the buckets that hold a wanted rank are looked at again.

A pass brings a count, the least and the greatest value of each bucket to the driver, BUCKETS rows an open interval at most. Buckets are equal parts of the interval between the least and greatest value
that are left, which is monotone in floating point, so no value is ever counted on the wrong side. An interval of one value, or of KEPT values at most, which are then read, ends the search.
No rows are shuffled or sorted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.sources.corpus import settled

BUCKETS = 4096
#: Values that are read to the driver when an interval has no more than these.
KEPT = 10_000


def quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]], buckets: int = BUCKETS, kept: int = KEPT) -> dict[tuple[str, float], float | None]:
    """(name, p) -> the value at p of the column that a name stands for, interpolated between its two neighbours; None without values. Nulls don't count, NaN is the greatest value."""
    thin = settled(df.select(*(c.cast("double").alias(name) for name, (c, _) in wanted.items())))
    values = {name: F.when(~F.isnan(name), F.col(name)) for name in wanted}
    first = thin.agg(*(f(x).alias(f"{tag}_{name}") for name, x in values.items() for tag, f in (("n", F.count), ("low", F.min), ("high", F.max))), *(F.count(name).alias(f"all_{name}") for name in wanted)).first()
    ranks: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, float, float], tuple[int, int, set[int]]] = {}  # interval -> values below it, in it, and wanted ranks

    def settle(name: str, low: float, high: float, below: int, n: int, wants: set[int]) -> None:
        if low == high:
            ranks.update({(name, r): low for r in wants})
        elif n <= kept:
            got = sorted(x[0] for x in thin.filter(F.col(name).between(low, high)).select(name).collect())  # at most ``kept`` values
            ranks.update({(name, r): got[r - below] for r in wants})
        else:
            open_[name, low, high] = (below, n, wants)

    for name, (_, ps) in wanted.items():
        n, total = first[f"n_{name}"], first[f"all_{name}"]
        at = {r for p in ps for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1)))} if total else set()
        ranks.update({(name, r): math.nan for r in at if r >= n})
        if at := {r for r in at if r < n}:
            settle(name, first[f"low_{name}"], first[f"high_{name}"], 0, n, at)
    while open_:
        now, open_ = list(open_.items()), {}
        parts = []
        for k, ((name, low, high), _) in enumerate(now):
            x, width = F.col(name), high / 2 - low / 2
            place = F.least(F.floor((x / 2 - low / 2) / width * buckets).cast("int"), F.lit(buckets - 1))
            parts.append(F.when(x.between(low, high) & ~F.isnan(x), F.struct(F.lit(k).alias("k"), place.alias("place"), x.alias("x"))))
        rows = thin.select(F.explode(F.array_compact(F.array(*parts))).alias("at")).groupBy("at.k", "at.place").agg(F.count("*").alias("n"), F.min("at.x").alias("low"), F.max("at.x").alias("high"))
        found: dict[int, list] = {}
        for r in sorted(rows.collect(), key=lambda r: (r["k"], r["place"])):
            found.setdefault(r["k"], []).append(r)
        for k, ((name, _, _), (below, _, wants)) in enumerate(now):
            for r in found[k]:
                inside = {w for w in wants if below <= w < below + r["n"]}
                if inside:
                    settle(name, r["low"], r["high"], below, r["n"], inside)
                below += r["n"]
    out: dict[tuple[str, float], float | None] = {}
    for name, (_, ps) in wanted.items():
        for p in ps:
            at = p * (first[f"all_{name}"] - 1)
            low, high = (ranks.get((name, f(at))) for f in (math.floor, math.ceil))
            out[name, p] = None if low is None else low if low == high else low + (at - math.floor(at)) * (high - low)
    return out


def number(value: float | None) -> Column:
    return F.lit(value).cast("double")

"""Batches for pluggable models: length-sorted and capped by padded size, or of a fixed number of rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def length_at(n_samples: Column, rate: Column, target: int = 16_000) -> Column:
    """Samples after resampling, half to even."""
    return F.bround(n_samples * target / rate).cast("long")


def batch_numbers(lengths: np.ndarray, budget: int, max_rows: int) -> np.ndarray:
    """Batch of each of the ascending lengths: one closes when a further row would pad it over the budget, or at max_rows."""
    out = np.zeros(len(lengths), np.int64)
    first = batch = 0
    for i, longest in enumerate(lengths.tolist()):
        rows = i - first
        if rows and ((rows + 1) * longest > budget or rows >= max_rows):
            first, batch = i, batch + 1
        out[i] = batch
    return out


def padded_batches(df: DataFrame, budget: int, max_rows: int, by: tuple[str, ...] = ("shard", "rate"), length: str = "length", id_: str = "id") -> DataFrame:
    """by, id, length, batch (number within by). Only keys and lengths travel; a group is one shard at one rate, ties of length go by id."""
    thin = df.select(*by, F.col(id_).alias("id"), F.col(length).cast("long").alias("length"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in thin.schema), "batch long"])

    def form(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "id"], kind="stable")
        return group.assign(batch=batch_numbers(group["length"].to_numpy(), budget, max_rows))

    return thin.groupBy(*by).applyInPandas(form, schema)


def batch_report(batches: DataFrame, by: tuple[str, ...] = ("shard", "rate")) -> DataFrame:
    """Rows, longest and padded size of each batch."""
    return batches.groupBy(*by, "batch").agg(F.count("*").alias("rows"), F.max("length").alias("longest"), (F.count("*") * F.max("length")).alias("padded"))


def fixed_batches(df: DataFrame, n: int = 64, by: str = "shard", length: str = "length", id_: str = "id") -> DataFrame:
    """by, id, length, batch of n rows in length order within a shard."""
    order = W.partitionBy(by).orderBy(length, id_)
    return df.select(by, id_, length, F.floor((F.row_number().over(order) - 1) / n).cast("long").alias("batch"))


def mixed_rates(df: DataFrame, by: tuple[str, ...] = ("shard", "batch"), rate: str = "rate") -> DataFrame:
    """Batches that hold several sample rates; there must be none."""
    return df.groupBy(*by).agg(F.count_distinct(rate).alias("rates")).filter("rates > 1")

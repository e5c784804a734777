"""Bringing thin rows to heavy ones: metadata goes to the tasks that read the audio, in rounds of bounded size; audio is never exchanged.

Source rows are addressed by (shard, row). The bytes of metadata are summed up by shard; shards are packed into rounds of at most ``most`` bytes. A round is one broadcast join
with the rows of its shards. Where the shards are files (``corpus.read_shards``), the round's filter on the shard's name prunes the others before they are opened, so that all rounds
together read the audio once. A shard whose own metadata is over the bound is cut by row ranges.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtable.sources.corpus import settled, shared_dir, stored

#: Bytes of metadata that one round sends to all tasks.
ROUND_BYTES = 64 << 20
#: Of so many rounds each may look through all metadata; of more each reads its own from files in order.
FEW_ROUNDS = 4
_ROW_BYTES = 48


def value_bytes(column: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in memory; 0 for null."""
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType):
        own = lambda x: value_bytes(x, kind.elementType) + 8
        size = F.aggregate(column, F.lit(0).cast("long"), lambda n, x: n + own(x)) if isinstance(kind.elementType, T.StringType | T.BinaryType | T.ArrayType | T.StructType) else 8 * F.size(column)
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(column[f.name], f.dataType) for f in kind), F.lit(0).cast("long"))
    elif isinstance(kind, T.MapType):
        size = value_bytes(F.map_keys(column), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(column), T.ArrayType(kind.valueType))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long"))


def row_bytes(df: DataFrame) -> Column:
    return sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(_ROW_BYTES).cast("long"))


#: What one round takes: whole shards, or the rows of one shard from a first to before a last (None: all).
Round = list[tuple[str, int | None, int | None]]


def rounds(thin: DataFrame, most: int = ROUND_BYTES) -> list[Round]:
    """Shards packed by name into rounds of at most ``most`` bytes; only one figure a shard comes to the driver, which lists the files anyway."""
    sizes = thin.filter("shard is not null").groupBy("shard").agg(F.sum(row_bytes(thin)).alias("bytes"), F.min("row").alias("low"), F.max("row").alias("high"))
    out: list[Round] = []
    room = 0
    for shard, size, low, high in sorted(map(tuple, sizes.collect())):
        if size > most and low is not None and high > low:
            parts = min(math.ceil(size / most), high - low + 1)
            step = math.ceil((high - low + 1) / parts)
            out += [[(shard, at, at + step)] for at in range(low, high + 1, step)]
            room = 0
        elif size > room:
            out.append([(shard, None, None)])
            room = most - size
        else:
            out[-1].append((shard, None, None))
            room -= size
    return out


def _of(part: Round) -> Column:
    """Rows of a round. Names stand as literals, so that a scan of files prunes by them."""
    names = F.col("shard").isin([shard for shard, _, _ in part])
    return names if part[0][1] is None else names & (F.col("row") >= part[0][1]) & (F.col("row") < part[0][2])


def looked_up(source: DataFrame, thin: DataFrame, most: int = ROUND_BYTES) -> Iterator[DataFrame]:
    """The joins on (shard, row), one a round: the source's rows of the round's shards with their metadata. Each is to be used up before the next, so that one round is held at a time."""
    thin = by_shard(thin)
    parts = rounds(thin, most)
    if len(parts) <= FEW_ROUNDS:
        thin = settled(thin)
    for part in parts:
        yield source.filter(_of(part)).join(F.broadcast(thin.filter(_of(part))), ["shard", "row"])  # at most ``most`` bytes, as counted


def by_shard(thin: DataFrame) -> DataFrame:
    """thin, written once in the order of shard and row, so that a round reads the files and row groups that hold its shards and no others; a scan of all of it for every round would be quadratic."""
    return stored(thin.repartitionByRange("shard", "row").sortWithinPartitions("shard", "row"))


def beside(source: DataFrame, thin: DataFrame, most: int = ROUND_BYTES) -> DataFrame:
    """source joined with thin on (shard, row). Metadata within the bound is one broadcast join, evaluated when asked for; for more, the rounds are written one after the other
    into the shared folder, once."""
    parts = looked_up(source, thin, most)
    first = next(parts, None)
    if first is None:
        return source.join(F.broadcast(thin.limit(0)), ["shard", "row"])
    second = next(parts, None)
    if second is None:
        return first
    path = f"{shared_dir(source.sparkSession)}/beside-{uuid.uuid4().hex}"
    for part in (first, second, *parts):
        part.write.mode("append").parquet(path)
    return source.sparkSession.read.schema(first.schema).parquet(path)


def write_beside(source: DataFrame, thin: DataFrame, path: str, most: int = ROUND_BYTES) -> None:
    """The same, straight to where it shall stand; nothing is written twice."""
    source.limit(0).join(thin.limit(0), ["shard", "row"]).write.option("compression", "zstd").parquet(path)  # the schema, should no row be left
    for part in looked_up(source, thin, most):
        part.write.mode("append").option("compression", "zstd").parquet(path)


def located(source: DataFrame, thin: DataFrame, key: str = "id") -> DataFrame:
    """thin with shard and row of the source rows that have its key; only keys and addresses of the source are read and moved."""
    return source.select(key, "shard", "row").join(thin.drop("shard", "row"), key)

r"""Prefix trie of conversations by range minima over sorted LCPs.

A conversation is the sequence of its turns' digests (16 bytes each), so sorting the concatenated digests as bytes puts all conversations that share their first d turns
side by side. Over the distinct sequences in that order, a row's LCP is the number of turns shared with the row before. A depth-d prefix is a candidate at the first row that has
it (those with LCP < d <= length); its members are the rows up to the next LCP below d, and its parent begins at the last LCP below d - 1. Every candidate finds both bounds by
itself, by binary search over a sparse table of range minima; there is no stack and no order among candidates. Members, leaves and saved tokens are differences of prefix sums
over the interval, the least id is a second sparse table.

The order is cut into range partitions (blocks); a block knows of the others only the LCP at its first row and its least LCP, two numbers a block, over which a second table finds
the blocks where an interval begins and ends. A prefix that is open at a block's end gets what the next blocks hold of it (their spine) by a sum on (block, depth).
Tables of open prefixes have at most a row a block and depth.

Copies are collapsed before: rows are range-partitioned by sequence and id, so copies in any number are split; a run of copies that lies in one partition is hashed there, one
that passes a border goes on as packed lists of 65,536 ids, and its SHA-256, which is sequential by nature, reads those.

Defined cases: rows are ordered by turn, null first, ties by digest of role and text; null role or text is empty; repeated rows are turns of their own; rows without a conv_id
belong to no conversation; an empty table has no nodes, not even a root; extra columns aren't read. A conversation is one row of 24 bytes a turn; a block is held by its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, small, stored, word_count

#: Conversations are rebuilt on the first turns of the one whose id ends their group of so many; of so few turns at most.
GROUP, HEAD = 20, 4
#: Ids in one packed list.
PACK = 1 << 16
_DIGEST = 16
_NODE = (
    "kind int, block int, depth long, conv long, n long, words long, children long, leaves long, saved long, ends string,"
    " parent_conv long, parent_block int, parent_depth long, parent_kind int, owner int, ends_in int"
)
_CLOSED, _OPEN, _SPINE = 0, 1, 2


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, key (its turns' digests, joined) and words (of each turn) of each conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest.alias("digest"), word_count(text).alias("words")).alias("told"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("told")).alias("told"))


def rebuilt(turns: DataFrame, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """conv_id, key, words of each conversation c after it took the first h turns of conversation c - c % group for its own first h; h = crc32(c) % head."""
    own = sequences(turns)
    heads = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("head_id"), F.slice("told", 1, head - 1).alias("lent"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("head_id"), "left").withColumn("h", h)
    none = F.slice("told", 1, 0)
    told = both.withColumn("told", F.concat(F.coalesce(F.slice("lent", F.lit(1), F.col("h")), none), F.slice("told", F.col("h") + 1, F.greatest(F.size("told"), F.lit(1)))))
    return told.select("conv_id", F.unhex(F.array_join(F.transform("told", lambda x: F.hex(x["digest"])), "")).alias("key"), F.transform("told", lambda x: x["words"]).alias("words"))


# ---- copies ----

_RUN = "sid binary, at long, n long, ids binary, ends string, key binary, words array<long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (sid, conv_id): a run of one sid that surely lies here whole is hashed; the first run, the last one and long ones go on as packed ids."""
    out: list[tuple] = []
    run, ids, packed = None, [], True  # (sid, key, words) of the run, its ids not yet packed, whether it goes on packed

    def flush(final: bool) -> None:
        if ids:
            text = b",".join(ids)
            out.append((run[0], int(ids[0]), len(ids), None if final else text, hashlib.sha256(text).hexdigest() if final else None, run[1], run[2]))
            ids.clear()

    schema = pa.schema([("sid", pa.binary()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("ends", pa.string()), ("key", pa.binary()), ("words", pa.list_(pa.int64()))])
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("sid", "conv_id", "key", "words")]
        for sid, conv, key, words in zip(*columns, strict=True):
            if run is None or run[0] != sid:
                if run is not None:
                    flush(final=not packed)
                    packed = False
                run = (sid, key, words)
            elif len(ids) >= PACK:
                packed = True
                flush(final=False)
            ids.append(b"%d" % conv)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
            out.clear()
    if run is not None:
        flush(final=False)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed ids by (sid, at): one row a sid, hashed as they pass."""
    schema = pa.schema([("key", pa.binary()), ("conv", pa.int64()), ("n", pa.int64()), ("words", pa.list_(pa.int64())), ("ends", pa.string())])
    run, first, n, sha, out = None, 0, 0, None, []

    def flush() -> None:
        out.append({"key": run["key"], "conv": first, "n": n, "words": run["words"], "ends": sha.hexdigest()})

    for batch in batches:
        for x in batch.to_pylist():
            if run is None or run["sid"] != x["sid"]:
                if run is not None:
                    flush()
                run, first, n, sha = x, x["at"], 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(x["ids"])
            n += x["n"]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    if run is not None:
        flush()
        yield pa.RecordBatch.from_pylist(out, schema)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """key, conv (least id), n, words, ends (SHA-256 of the ids in ascending order, comma-joined) of each distinct sequence of conv_id, key, words."""
    rows = stored(convs.withColumn("sid", F.unhex(F.md5("key"))))  # sampled for its range bounds, so computed before
    runs = stored(rows.repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id").mapInArrow(_runs, _RUN))
    packed = runs.filter("ids is not null").repartition("sid").sortWithinPartitions("sid", "at")
    whole = runs.filter("ids is null").select("key", F.col("at").alias("conv"), "n", "words", "ends")
    return whole.unionByName(packed.mapInArrow(_unpacked, "key binary, conv long, n long, words array<long>, ends string"))


# ---- one block of the sorted order ----


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with alike."""
    n, step = min(len(a), len(b)) // _DIGEST, _DIGEST
    return next((i for i in range(n) if a[i * step : i * step + step] != b[i * step : i * step + step]), n)


def lcps(keys: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
    """Length and LCP with the row before (first: that of the first row), in turns."""
    lens = np.array([len(k) // _DIGEST for k in keys], np.int64)
    flat = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    at, out = np.cumsum(lens) - lens, np.zeros(len(keys), np.int64)
    rows, depth = np.arange(1, len(keys)), 0
    while len(rows):
        rows = rows[(lens[rows] > depth) & (lens[rows - 1] > depth)]
        rows = rows[(flat[at[rows] + depth] == flat[at[rows - 1] + depth]).all(1)]
        depth += 1
        out[rows] = depth
    out[:1] = first
    return lens, out


class RangeMinima:
    """Sparse table: minima of all stretches whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - half], last[half:]))

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum of each [start, end), none of them empty."""
        level = np.frexp((end - start).astype(float))[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][start[at]], self.levels[k][end[at] - (1 << int(k))])
        return out

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from start on with a value under depth, n if there is none; each by its own binary search."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            on = np.flatnonzero(at + (1 << k) <= self.n)
            on = on[self.levels[k][at[on]] >= depth[on]]
            at[on] += 1 << k
        return at

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to start with a value under depth, -1 if there is none; each by its own binary search."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            on = np.flatnonzero(at + 1 >= 1 << k)
            on = on[self.levels[k][at[on] + 1 - (1 << k)] >= depth[on]]
            at[on] -= 1 << k
        return at


def block_nodes(b: int, keys: list[bytes], conv: np.ndarray, n: np.ndarray, words: np.ndarray, ends: list[str], firsts: np.ndarray, least: RangeMinima) -> dict[str, np.ndarray]:
    """What block b knows of its nodes: those that end in it (closed), those open at its end, and its part in those that earlier blocks opened (spine).

    firsts: each block's LCP at its first row (-1 for the first block, where the root begins, too); least: the least LCP of each block.
    """
    size = len(keys)
    lens, lcp = lcps(keys, int(firsts[b]))
    onward = int(firsts[b + 1]) if b + 1 < len(firsts) else -1
    minima, ids = RangeMinima(lcp), RangeMinima(conv)
    after = np.append(lcp[1:], onward)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    members, leaves, texts = sums(n), sums(after < lens), np.cumsum(lens) - lens

    count = lens - lcp
    begin = np.cumsum(count) - count
    row = np.repeat(np.arange(size), count)
    depth = np.arange(len(row)) - begin[row] + lcp[row] + 1
    end = minima.right(row + 1, depth)
    is_open = (end == size) & (depth <= onward)
    node_n = members[end] - members[row]
    last = np.where(depth > 0, words[texts[row] + np.maximum(depth, 1) - 1] if len(words) else 0, 0)
    own = np.where(is_open, 0, (node_n - 1) * last)
    saved = sums(own)  # nodes stand by row and depth: a subtree is one stretch of them
    node_end = np.append(begin, len(row))[end]

    # a parent: the node one turn shorter, of the same row or of the last row with an LCP below
    up = minima.left(row, depth - 1)
    parent = np.where(up >= 0, begin[up] + depth - 1 - lcp[up] - 1, -1)
    has = depth > 0
    inside = has & (up >= 0)
    children = np.bincount(parent[inside], minlength=len(row))
    least_id = ids.least(row, end)
    open_parent = inside & is_open[parent]
    known = inside & ~open_parent
    closed = {
        "kind": np.where(is_open, _OPEN, _CLOSED), "block": np.full(len(row), b), "depth": depth, "conv": least_id, "n": node_n, "words": last, "children": children,
        "leaves": leaves[end] - leaves[row], "saved": saved[node_end] - saved[np.arange(len(row))],
        "ends": np.where(lens[row] == depth, np.array(ends, object)[row], None),
        "parent_conv": np.where(known, least_id[parent], -1), "parent_block": np.full(len(row), b), "parent_depth": depth - 1,
        "parent_kind": np.where(~has, 0, np.where(known, 1, np.where(open_parent, _OPEN + 2, _SPINE + 2))),
        "owner": np.full(len(row), b), "ends_in": least.right(np.full(len(row), b + 1), depth),
    }

    spine = np.arange(int(firsts[b]) + 1)
    to = minima.right(np.ones(len(spine), np.int64), spine)
    zero = np.zeros(len(spine), np.int64)
    part = {
        "kind": zero + _SPINE, "block": zero + b, "depth": spine, "conv": ids.least(zero, to), "n": members[to], "words": zero,
        "children": np.bincount(depth[has & (up < 0)] - 1, minlength=len(spine))[: len(spine)], "leaves": leaves[to], "saved": saved[np.append(begin, len(row))[to]],
        "ends": np.full(len(spine), None, object), "parent_conv": zero - 1, "parent_block": zero, "parent_depth": zero, "parent_kind": zero,
        "owner": least.left(zero + b - 1, spine), "ends_in": zero,
    }
    return {k: np.concatenate([closed[k], part[k]]) for k in closed}


# ---- the trie ----


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last key of a block and its least LCP but for the first row's."""
    first, last, least, block = None, b"", 1 << 40, 0
    for batch in batches:
        keys = batch.column("key").to_pylist()
        if keys:
            block = batch.column("block")[0].as_py()
            found = lcps(keys if first is None else [last, *keys], 1 << 40)[1]
            first, last, least = keys[0] if first is None else first, keys[-1], min(least, int(found.min()))
    if first is not None:
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "first": pa.array([first], pa.binary()), "last": pa.array([last], pa.binary()), "least": pa.array([least], pa.int64())})


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        met = [-1 if a is None else shared_turns(a, b) for a, b in zip(batch.column("before").to_pylist(), batch.column("first").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"block": batch.column("block"), "met": pa.array(met, pa.int64()), "least": batch.column("least")})


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of conv_id, key, words: conv (least member), depth, parent_conv, n, children, leaves, saved, ends (null where no member ends)."""
    spark = convs.sparkSession
    rows = stored(distinct_sequences(convs))
    rows = cut(rows.repartitionByRange("key").sortWithinPartitions("key").withColumn("block", F.spark_partition_id()))
    borders = rows.select("block", "key").mapInArrow(_borders, "block int, first binary, last binary, least long")
    before = borders.withColumn("before", F.lag("last").over(W.orderBy("block")))  # a row a block
    met = sorted(map(tuple, before.select("block", "before", "first", "least").mapInArrow(_meet, "block int, met long, least long").collect()))  # three numbers a block
    place = {block: i for i, (block, _, _) in enumerate(met)}
    firsts = np.array([x[1] for x in met], np.int64)
    least = RangeMinima(np.minimum(firsts, np.array([x[2] for x in met], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [x for x in batches if x.num_rows]
        if not got:
            return
        held = pa.Table.from_batches(got).combine_chunks()
        words = held.column("words").combine_chunks()
        words = (words.chunk(0) if isinstance(words, pa.ChunkedArray) else words).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        made = block_nodes(
            place[held.column("block")[0].as_py()], held.column("key").to_pylist(), held.column("conv").to_numpy().astype(np.int64), held.column("n").to_numpy().astype(np.int64), words,
            held.column("ends").to_pylist(), firsts, least)
        kinds = {"kind": pa.int32(), "block": pa.int32(), "ends": pa.string(), "parent_block": pa.int32(), "parent_kind": pa.int32(), "owner": pa.int32(), "ends_in": pa.int32()}
        for at in range(0, len(made["kind"]), 1 << 15):
            yield pa.RecordBatch.from_pydict({k: pa.array(v[at : at + (1 << 15)], kinds.get(k, pa.int64()), from_pandas=True) for k, v in made.items()})

    parts = stored(rows.mapInArrow(run, _NODE))
    opened = cut(_opened(parts, len(met)))
    # where a parent spans blocks: by (block, depth) the id of what was open there
    spine = parts.filter(F.col("kind") == _SPINE).select("block", "depth", "owner").join(small(opened.select("owner", "depth", "conv"), 40, opened), ["owner", "depth"])
    above = spine.select("block", "depth", F.lit(_SPINE).alias("as"), "conv").unionByName(opened.select(F.col("owner").alias("block"), "depth", F.lit(_OPEN).alias("as"), "conv"))
    above = cut(above.select(F.col("block").alias("parent_block"), F.col("depth").alias("parent_depth"), (F.col("as") + 2).alias("parent_kind"), F.col("conv").alias("found")))
    columns = ["conv", "depth", "n", "children", "leaves", "saved", "ends", "parent_conv", "parent_block", "parent_depth", "parent_kind"]
    nodes = parts.filter(F.col("kind") == _CLOSED).select(columns).unionByName(opened.select(columns))
    out = nodes.join(small(above), ["parent_block", "parent_depth", "parent_kind"], "left")
    parent = F.when(F.col("parent_kind") == 1, F.col("parent_conv")).otherwise(F.col("found"))
    return out.select("conv", "depth", parent.alias("parent_conv"), "n", "children", "leaves", "saved", "ends")


def _opened(parts: DataFrame, blocks: int) -> DataFrame:
    """Nodes that pass the end of the block where they begin (owner), whole: the sum of their parts, and in saved the open nodes below them."""
    alone = [F.max(F.when(F.col("kind") == _OPEN, F.col(c))).alias(c) for c in ("words", "ends", "parent_conv", "parent_block", "parent_depth", "parent_kind", "ends_in")]
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    whole = parts.filter(F.col("kind") != _CLOSED).groupBy("owner", "depth").agg(F.min("conv").alias("conv"), *sums, *alone)
    own = whole.withColumn("own", (F.col("n") - 1) * F.col("words"))
    own = own.withColumn("below", F.sum("own").over(W.partitionBy("owner").orderBy(F.desc("depth"))))
    per_block = parts.sparkSession.range(blocks).select(F.col("id").cast("int").alias("at")).join(own.groupBy(F.col("owner").alias("at")).agg(F.sum("own").alias("in_block")), "at", "left")
    upto = per_block.select("at", F.sum(F.coalesce("in_block", F.lit(0))).over(W.orderBy("at")).alias("upto"))  # a row a block
    start, stop = upto.select(F.col("at").alias("owner"), F.col("upto").alias("upto_owner")), upto.select((F.col("at") + 1).alias("ends_in"), F.col("upto").alias("upto_end"))
    out = own.join(start, "owner").join(stop, "ends_in")
    return out.withColumn("saved", F.col("saved") + F.col("below") + F.col("upto_end") - F.col("upto_owner")).drop("own", "below", "upto_owner", "upto_end", "words")

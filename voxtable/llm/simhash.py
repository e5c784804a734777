r"""SimHash near-dedup with BK-trees.

A text's fingerprint has a bit set if over half of its word shingles' XXH64 hashes have it. Fingerprints that differ in at most ``radius``
bits are linked; the groups are the connected components, named by their smallest doc_id.

Equal fingerprints are one node, so copies never make pairs. Nodes meet in shards: the 64 bits are cut into radius + 2 blocks, and two
nodes within the radius agree on at least two blocks whole, so every pair of blocks with its bits is one shard (and no linked pair
is lost). In a shard a BK-tree holds the fingerprints: children are keyed by their Hamming distance to the parent,
and a search follows only the edges within the radius of its own distance. A shard over SHARD nodes is dealt out over several trees; each tree
is sent to the tasks of all chunks that search it, so no task holds more than two chunks. A shard yields a spanning forest
of its links, at most one edge a node. Components come from star contraction, whose edges never exceed the forest's.

Defined cases: a null, empty or wordless text has fingerprint zero and links like any other; repeated rows and copies share their component; a null
doc_id takes part but names no component (null if all of a component are null); an empty table gives an empty result; very long
texts are hashed in pieces; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, partitions, utf8

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints in one tree at most.
SHARD = 4000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PIECE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(_LOWER).split()  # bytes split at exactly the six spaces of the contract
    n = max(1, len(words) - shingle + 1) if words else 0
    if not n:
        return 0
    line = memoryview(b" ".join(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        hashes = np.array([digest(line[a : b - 1], SEED) for a, b in zip(starts[at : min(n, at + _PIECE)], last[at : at + _PIECE], strict=True)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


class BKTree:
    """Fingerprints; the children of a node are keyed by their distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        node, new = 0, len(self.values) - 1
        while node != new:
            d = (self.values[node] ^ value).bit_count()
            node = self.children[node].setdefault(d, new)

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Places of the fingerprints at most radius away."""
        work = [0] if self.values else []
        while work:
            node = work.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                yield node
            work += [c for k, c in self.children[node].items() if d - radius <= k <= d + radius]


def forest(fps: list[int], queries: list[bool], radius: int) -> Iterator[tuple[int, int]]:
    """Edges that connect what links connect. Fingerprints that aren't queries make up the tree; queries search it only (all trees' own
    members also search each other)."""
    tree, parent = BKTree(), list(range(len(fps)))
    place: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in sorted(range(len(fps)), key=queries.__getitem__):
        for node in tree.within(fps[i], radius):
            a, b = root(i), root(place[node])
            if a != b:
                parent[a] = b
                yield fps[i], fps[place[node]]
        if not queries[i]:
            tree.add(fps[i])
            place.append(i)


def masks(radius: int = RADIUS) -> list[int]:
    """The bits of every pair of radius + 2 blocks."""
    n = radius + 2
    edges = [round(64 * k / n) for k in range(n + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(block, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, fp, query) sorted by shard; a shard may run on into the next batch."""
        left = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]

        def of(shard: np.ndarray, fp: np.ndarray, query: np.ndarray) -> pa.RecordBatch:
            found = []
            edge = np.flatnonzero(np.diff(shard)) + 1
            first, last = np.r_[0, edge], np.r_[edge, len(shard)]
            for a, b in zip(first[last - first > 1], last[last - first > 1], strict=True):
                found += forest([x & (1 << 64) - 1 for x in fp[a:b].tolist()], query[a:b].tolist(), radius)
            return pa.RecordBatch.from_arrays([pa.array([_signed(x[k]) for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            now = [np.concatenate([x, y.to_numpy(zero_copy_only=False)]) for x, y in zip(left, batch.columns, strict=True)]
            if not len(now[0]):
                continue
            cut_at = int(np.searchsorted(now[0], now[0][-1]))
            yield of(*(x[:cut_at] for x in now)) if cut_at else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])
            left = [x[cut_at:] for x in now]
        if len(left[0]):
            yield of(*left)

    return run


def links(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """a, b: edges that connect all distinct fingerprints (column fp) within the radius."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(masks(radius))])
    dealt = nodes.select("fp", F.explode(keys).alias("shard"))
    large = cut(dealt.groupBy("shard").count().filter(F.col("count") > shard).select(F.col("shard").alias("s"), F.ceil(F.col("count") / shard).cast("int").alias("n")))
    rows = dealt.select("shard", "fp", F.lit(False).alias("query"))
    if not large.isEmpty():
        split = dealt.join(large, dealt["shard"] == large["s"])
        mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("n")).cast("int")
        split = split.withColumn("mine", mine).withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        # chunk i's tree is searched by the chunks after it
        low, high = F.least("mine", "tree"), F.greatest("mine", "tree")
        split = split.select(F.xxhash64("shard", low, high).alias("shard"), "fp", (F.col("mine") > F.col("tree")).alias("query"))
        rows = rows.join(large, rows["shard"] == large["s"], "left_anti").unionByName(split)
    sorted_ = rows.repartition(partitions(nodes.sparkSession), "shard").sortWithinPartitions("shard")
    return sorted_.mapInArrow(_links(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """a, b -> node, root (the least node of its component) for every node on an edge: alternating large and small stars until nothing moves."""
    now, last = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.col("k")).alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        moved = large.join(small, F.col("u") == F.col("k"))
        new = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
        now = cut(new.filter("u <> v").distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id and root (a fingerprint that names the component) of every row."""
    rows = cut(fingerprints(docs))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    root = components(links(nodes.select("fp"), radius))
    named = nodes.join(root, nodes["fp"] == root["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    label = named.join(least, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id", "root")
    return rows.join(label, rows["fp"] == label["f"]).select("doc_id", "fp", "component_id", "root")


def _marked(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), id and fp of every row."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t) for t in utf8(b.column(0).field(text))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["row", "fp"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())])).select("row", F.col("row.doc_id").alias("id"), "fp")


def first_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """docs with one row of each group, that of its smallest doc_id (rows without an id stay). An id may name several texts, so the row is
    told by its id and fingerprint, which is computed again rather than stored with the texts."""
    named = docs.filter("doc_id is not null")
    first = near_duplicates(named, radius).filter(F.col("doc_id") == F.col("component_id"))
    first = first.groupBy("root").agg(F.min("doc_id").alias("kept_id"), F.min("fp").alias("kept_fp"))
    rows = _marked(named)
    kept = rows.join(first, (rows["id"] == first["kept_id"]) & (rows["fp"] == first["kept_fp"]), "left_semi").dropDuplicates(["id", "fp"])
    return kept.select("row.*").unionByName(docs.filter("doc_id is null"))

r"""SimHash near-dedup at a wide radius: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked, groups are
the connected components, and one document of each stays.

At that similarity two SimHashes differ in some 15 % of their bits, so no run of bits that could shard a large corpus is equal. Hence fingerprints have BITS bits here, and
the shards are MinHash bands: BANDS bands of ROWS minima each; a pair at similarity s shares one with probability
1 - (1 - s^ROWS)^BANDS (0.9996 at 0.8, more above). As in ``simhash``, a shard's fingerprints form a BK-tree (children keyed by their Hamming distance to the
parent, edges followed within RADIUS only), and equal sets are one node. RADIUS lies two deviations above the distance expected at 0.8.

What a tree finds are candidates. Of a tree's candidates the shortest spanning forest is compared exactly, on whole texts; since all shards order
pairs alike, their forests mostly agree. A shard over SHARD nodes is dealt out over several trees, each of which searches itself only at first. Shards in which a comparison failed, or
which were dealt out, are searched again, as far as what is linked by then leaves several components in them. Odd sketches, whose distance is never more than the difference of two sets,
tell which nodes still have a possible partner outside of their component; these nodes meet once more, with their sets of shingles, and are compared where they meet. So a tree sends
nodes or a forest of links, never pairs by the square of its nodes; no pair within the radius is left undecided, nodes that links connect already are never compared, and no shard is capped.

Defined cases: words are what bytes between the six ASCII spaces are, ASCII letters folded; a text under five words is one shingle; null, empty and wordless texts
are copies of each other; a row without an id takes part like any other and stays only if its group has no id at all; an id may name several
texts; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, small, small_batches, stored, utf8
from .simhash import _LOWER, SEED, BKTree, components

SHINGLE = 5
SIMILARITY = 0.8
BITS, RADIUS = 512, 94
BANDS, ROWS = 20, 5
#: Fingerprints in one tree and bytes of what travels with them, about: nodes are dealt out by hash.
SHARD, SET_BYTES = 1000, 32 << 20
#: Shingles that are put through all permutations at a time, and texts whose shingles a task holds.
_PIECE, _CACHED = 1 << 9, 64
_RANDOM = np.random.default_rng(SEED)
_TIMES = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64, endpoint=False) | np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64, endpoint=False)
_LANES = _RANDOM.integers(0, 1 << 64, BITS // 64, np.uint64, endpoint=False)


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finisher: a bijection whose result has no pattern of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes."""
    words = text.translate(_LOWER).split()
    digest = xxhash.xxh64_intdigest
    known = {w: digest(w, SEED) for w in set(words)}
    hashes = np.array([known[w] for w in words], np.uint64)
    size = min(shingle, len(words))
    n = len(words) - size + 1 if words else 0
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mixed(out + hashes[k : k + n])
    return np.unique(out)


def bands(found: np.ndarray) -> np.ndarray:
    """The hash of each band of MinHash minima, as longs."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _PIECE):
        piece = found[at : at + _PIECE]
        np.minimum(least, (_TIMES[:, None] * piece + _PLUS[:, None]).min(1), out=least)
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = _mixed(out + column)
    return out.view(np.int64)


def fingerprint(found: np.ndarray) -> bytes:
    """BITS bits, each set if over half of the shingles have it."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(found), _PIECE):
        lanes = _mixed(found[at : at + _PIECE, None] ^ _LANES)
        counts += np.unpackbits(lanes.view(np.uint8), axis=1).sum(0, dtype=np.uint16)
    return np.packbits(2 * counts > len(found)).tobytes()


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def odd_bits(size: int) -> int:
    """Bits of the odd sketch of a set: a power of two, 8 to 16 an element."""
    return 1 << max(9, (8 * size - 1).bit_length())


def odd_sketch(found: np.ndarray) -> bytes:
    """Of each bit, whether an odd number of shingles falls on it: each shingle that only one of two sets has changes one bit, so sketches differ in no more bits than the sets in shingles."""
    bits = odd_bits(len(found))
    return np.packbits(np.bincount((_mixed(found) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def possible(a: int, a_size: int, b: int, b_size: int, similarity: float = SIMILARITY) -> bool:
    """Whether two sets may be similar, by their odd sketches (as numbers) and sizes. False is certain."""
    if min(a_size, b_size) < similarity * max(a_size, b_size):
        return False
    if a_size > b_size:
        a, a_size, b, b_size = b, b_size, a, a_size
    least, bits = odd_bits(a_size), odd_bits(b_size)
    while bits > least:  # a sketch of half the bits is the halves' exclusive or
        bits //= 2
        b = b >> bits ^ b & (1 << bits) - 1
    both = min(a_size, (a_size + b_size - (a ^ b).bit_count()) // 2)
    return both >= similarity * (a_size + b_size - both)


def _signed(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, met, fps = [], [], []
            for text in utf8(b.column(2)):
                found = shingles(text, shingle)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                met.append(bands(found))
                fps.append(fingerprint(found))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.uint64()).view(pa.int64()), pa.array(met, pa.list_(pa.int64())), pa.array(fps, pa.binary())], ["id", "digest", "node", "bands", "fp"])

    return run


def _compared(shingle: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lru_cache(_CACHED)(lambda text: shingles(text, shingle))
        for b in batches:
            alike = [similar(found(x), found(y), similarity) for x, y in zip(utf8(b.column(2)), utf8(b.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(alike, pa.bool_())], ["a", "b", "alike"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, _CACHED) for b in batches for at in range(0, b.num_rows, _CACHED)):
            found = [shingles(text, shingle) for text in utf8(b.column(1))]
            columns = [pa.array([len(x) for x in found], pa.int64()), pa.array([odd_sketch(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["node", "size", "odd", "found"])

    return run


def near(fps: list[bytes], query: list[bool], radius: int = RADIUS) -> Iterator[tuple[int, int, int]]:
    """distance, i, j: the pairs of a tree within the radius, by their places; fingerprints that are queries don't meet each other."""
    values = [int.from_bytes(x) for x in fps]
    tree, place = BKTree(), []
    for i in sorted(range(len(values)), key=query.__getitem__):
        for at in tree.within(values[i], radius):
            yield (values[i] ^ values[place[at]]).bit_count(), i, place[at]
        if not query[i]:
            tree.add(values[i])
            place.append(i)


def _finder(names: list[int]):
    """find and join of components, which have these names at first."""
    parent = {r: r for r in names}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    def join(x: int, y: int) -> None:
        parent[find(x)] = find(y)

    return find, join


def candidates(nodes: list[int], fps: list[bytes]) -> Iterator[tuple[int, int]]:
    """The shortest spanning forest of the pairs of a tree within the radius."""
    # distance, then an order of the pairs that all shards share, then the places: one number, so that many fit
    pairs = sorted(d << 64 | ((nodes[i] ^ nodes[j]) & 0xFFFFFFFF) << 32 | i << 16 | j for d, i, j in near(fps, [False] * len(fps)))
    find, join = _finder(nodes)
    for pair in pairs:
        a, b = nodes[pair >> 16 & 0xFFFF], nodes[pair & 0xFFFF]
        if find(a) != find(b):
            join(a, b)
            yield min(a, b), max(a, b)


def undecided(similarity: float):
    def run(nodes: list[int], roots: list[int], fps: list[bytes], sizes: list[int], odds: list[bytes], query: list[bool]) -> Iterator[tuple[int]]:
        """The nodes of a tree that may be similar to another of a different component."""
        sketch, out = [int.from_bytes(x, "little") for x in odds], set()
        for _, i, j in near(fps, query):
            if roots[i] != roots[j] and not (i in out and j in out) and possible(sketch[i], sizes[i], sketch[j], sizes[j], similarity):
                out |= {i, j}
        return ((nodes[i],) for i in out)

    return run


def links(similarity: float):
    def run(nodes: list[int], roots: list[int], fps: list[bytes], sets: list[bytes], query: list[bool]) -> Iterator[tuple[int, int]]:
        """Links between a tree's components, compared exactly: a spanning forest."""
        found = [np.frombuffer(x, np.uint64) for x in sets]
        sketch = [int.from_bytes(odd_sketch(x), "little") for x in found]
        find, join = _finder(roots)
        for _, i, j in near(fps, query):
            if find(roots[i]) != find(roots[j]) and possible(sketch[i], len(found[i]), sketch[j], len(found[j]), similarity) and similar(found[i], found[j], similarity):
                join(roots[i], roots[j])
                yield nodes[i], nodes[j]

    return run


def _searched(of, names: list[str]):
    """of: a function of a shard's columns, which returns rows of longs; they follow the shard's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, bucket, ...) sorted by shard; a shard may run on into the next batch."""
        open_: list[list] = []

        def told(rows: list[list]) -> pa.RecordBatch:
            found = []
            if len(rows) > 1:
                _, bucket, *columns = map(list, zip(*rows, strict=True))
                found = [(bucket[0], *x) for x in of(*columns)]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(len(names))], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_ and open_[0][0] != row[0]:
                    yield told(open_)
                    open_ = []
                open_.append(row)
        yield told(open_)

    return run


def _search(rows: DataFrame, of, *names: str) -> DataFrame:
    rows = rows.repartition(partitions(rows.sparkSession), "shard").sortWithinPartitions("shard")
    return rows.mapInArrow(_searched(of, ["bucket", *names]), ", ".join(f"{x} long" for x in ["bucket", *names]))


def large(members: DataFrame) -> DataFrame:
    """of, n: the buckets of several trees and their number."""
    return members.groupBy(F.col("bucket").alias("of")).agg(F.ceil(F.count("*") / SHARD).cast("int").alias("n")).filter("n > 1")


def proposed(members: DataFrame) -> DataFrame:
    """bucket, a, b: what the trees of the buckets propose, each for itself. members: bucket, node, fp."""
    several = large(members)
    rows = members.join(several, members["bucket"] == several["of"], "left")
    # which nodes are together differs between buckets
    tree = F.pmod(F.xxhash64("bucket", "node", F.lit(7)), F.coalesce("n", F.lit(1)))
    return _search(rows.select(F.xxhash64("bucket", tree).alias("shard"), "bucket", "node", "fp"), candidates, "a", "b")


def facing(members: DataFrame, *columns: str, load: Column) -> DataFrame:
    """Each member of a bucket of several components meets all of other components: shard, bucket, node, root, columns, query. Those outside of the bucket's largest component are dealt
    out over trees, which its other members and each other search; members of the largest don't meet, so as long as few are outside of it no row is copied to many trees. load: bytes of a row."""
    by = members.groupBy(F.col("bucket").alias("of"), "root").agg(F.count("*").alias("n"), F.sum(load).alias("b"))
    by = by.groupBy("of").agg(F.max(F.struct("n", "root", "b")).alias("main"), F.sum("n").alias("n"), F.sum("b").alias("b")).filter("n > main.n")
    trees = lambda n, b: F.ceil(F.greatest(n / SHARD, b / SET_BYTES)).cast("int")
    by = by.select("of", F.col("main.root").alias("main"), trees(F.col("n") - F.col("main.n"), F.col("b") - F.col("main.b")).alias("outer"), trees(F.col("main.n"), F.col("main.b")).alias("inner"))
    rows, of = members.join(by, members["bucket"] == by["of"]), F.xxhash64("node", F.lit(7))
    inside = F.col("root") == F.col("main")
    mine = F.when(inside, F.col("outer") + F.pmod(of, F.col("inner"))).otherwise(F.pmod(of, F.col("outer"))).cast("int")
    last = F.col("outer") + F.when(inside, 0).otherwise(F.col("inner")) - 1
    rows = rows.withColumn("mine", mine).withColumn("tree", F.explode(F.sequence(F.lit(0), last)))
    split = F.xxhash64("bucket", F.least("mine", "tree"), F.greatest("mine", "tree"))
    return rows.select(split.alias("shard"), "bucket", "node", "root", *columns, (F.col("mine") > F.col("tree")).alias("query"))


def labels(rows: DataFrame, docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """node, root: the component of every node that is similar to another. rows: node, bands, fp and digest of docs. Only texts that are compared travel with their pairs, a forest of each
    tree; what that leaves undecided is compared as sets in the trees."""
    dealt = rows.select("node", F.posexplode("bands").alias("band", "hash")).select("node", F.xxhash64("band", "hash").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high").select(F.col("bucket").alias("of"))
    met = dealt.join(shared, dealt["bucket"] == shared["of"]).select("bucket", "node").distinct()
    shown = rows.groupBy("node").agg(F.min(F.struct("digest", "fp")).alias("shown")).select(F.col("node").alias("n"), "shown.*")
    met = cut(met.join(shown, met["node"] == shown["n"]).select("bucket", "node", "digest", "fp"))
    texts = docs.select(digest(F.col("text")).alias("of"), "text")

    def known(ends: DataFrame) -> DataFrame:
        """node, text; ends: node, digest."""
        ends = cut(ends)
        wanted = texts.join(small(ends.select(F.col("digest").alias("want"))), F.col("of") == F.col("want"), "left_semi").groupBy("of").agg(F.first("text").alias("text"))
        return wanted.join(ends, wanted["of"] == ends["digest"]).select("node", "text")

    found = cut(proposed(met))
    pairs = cut(found.select("a", "b").distinct())
    ends = cut(known(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(met.select("node", "digest").distinct(), "node")))
    both = pairs.join(ends.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").join(ends.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    new = cut(both.select("a", "b", "a_text", "b_text").mapInArrow(_compared(shingle, similarity), "a long, b long, alike boolean"))
    root = cut(components(new.filter("alike").select("a", "b")))

    again = found.join(new.filter("not alike"), ["a", "b"], "left_semi").select(F.col("bucket").alias("of")).unionByName(large(met).select("of")).distinct()
    open_ = met.join(again, F.col("bucket") == F.col("of")).join(root, "node", "left")
    open_ = cut(open_.select("bucket", "node", F.coalesce("root", "node").alias("root"), "digest", "fp"))
    several = open_.groupBy(F.col("bucket").alias("of")).agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("of")
    open_ = cut(open_.join(several, F.col("bucket") == F.col("of"), "left_semi"))
    if open_.isEmpty():
        return root
    sets = cut(known(open_.select("node", "digest").distinct()).mapInArrow(_sets(shingle), "node long, size long, odd binary, found binary"))
    rows = open_.select("bucket", "node", "root", "fp").join(sets.select("node", "size", "odd"), "node")
    left = cut(_search(facing(rows, "fp", "size", "odd", load=F.length("odd")), undecided(similarity), "node").distinct())
    rows = open_.select("bucket", "node", "root", "fp").join(left, ["bucket", "node"]).join(sets.select("node", "found"), "node")
    return merged(root, _search(facing(rows, "fp", "found", load=F.length("found")), links(similarity), "a", "b").select("a", "b").distinct())


def merged(root: DataFrame, links: DataFrame) -> DataFrame:
    """node, root after further links: these are taken between the components known so far."""
    of = lambda side: root.select(F.col("node").alias(f"{side}_node"), F.col("root").alias(f"{side}_root"))
    between = links.join(of("a"), F.col("a") == F.col("a_node"), "left").join(of("b"), F.col("b") == F.col("b_node"), "left")
    between = between.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    new = components(between).select(F.col("node").alias("old"), F.col("root").alias("new"))
    return cut(root.select("node", "root").join(new, F.col("root") == F.col("old"), "full").select(F.coalesce("node", "old").alias("node"), F.coalesce("new", "root").alias("root")))


def digest(text: Column) -> Column:
    """128 bits that tell texts apart; null and empty are one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def grouped(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """id, digest (of the text) and root (a node that names the group) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("id"), digest(F.col("text")).alias("digest"), "text")
    with small_batches(docs.sparkSession):
        rows = stored(rows.mapInArrow(_signed(shingle), f"id {kind}, digest binary, node long, bands array<long>, fp binary"))
        root = labels(rows, docs, shingle, similarity).withColumnRenamed("node", "n")
    return rows.join(root, rows["node"] == root["n"], "left").select("id", "digest", F.coalesce("root", "node").alias("root"))


def first_documents(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group, that of its smallest doc_id. An id may name several texts, so the row is told by its id and text; of rows that agree in both, the least by all columns
    (those that have an order) stays, so reruns agree."""
    first = grouped(docs, shingle, similarity).groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "digest")).alias("kept"))
    named = lambda id_: F.coalesce(F.concat(F.lit("i"), id_.cast("string")), F.lit("-"))
    told = lambda id_, text: F.unhex(F.md5(F.concat(named(id_).cast("binary"), text)))
    first = first.select(told(F.col("kept.id"), F.col("kept.digest")).alias("kept_key"))
    ordered = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and not re.search(r"\b(map|variant|interval)\b", kind)]  # id and text agree
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.struct(*(docs[c] for c in ordered)).alias("by"), told(F.col("doc_id"), digest(F.col("text"))).alias("key"))
    kept = rows.join(first, rows["key"] == first["kept_key"], "left_semi")
    return kept.groupBy("key").agg(F.min_by("row", "by").alias("row")).select("row.*")

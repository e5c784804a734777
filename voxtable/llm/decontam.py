r"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and items become their words (``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z) with one space around each,
so an occurrence of a window of words is an occurrence of its bytes. The windows are searched with block shift tables that skip
impossible positions, suffix-hash buckets that select the windows ending in the block at hand, and direct
comparison.

The windows travel to the tasks in blocks of at most BLOCK_BYTES. One block is one pass over the documents without a shuffle. A larger benchmark is a
series of bounded broadcasts, searched against suspects alone: a first pass looks the hashes of a document's windows up in one Bloom filter of all the benchmark's
windows (FILTER_BITS at most), which misses none and lets few others pass. More windows than the filter is made for let more documents pass, and cost time only.

Defined cases: null or wordless texts have no words and no hits; a null or wordless item has no window; repeated windows of several items count
for each; items without an id hit like others and count as one item, which has no id to list; an empty benchmark contaminates nothing; repeated document rows are judged each; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, small, stored, utf8

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: Bits of the filter a window, probes of a window, and the most bits (64 MiB), whose parts of 64 KiB are made in tasks.
BITS_EACH, PROBES, FILTER_BITS, PART_BITS = 32, 8, 1 << 29, 1 << 19
#: A window is hashed by its first REACH bytes, a text in segments, so a text of any length takes little memory.
REACH, SEGMENT = 4096, 1 << 16
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def spaced(text: bytes) -> bytes:
    """The words of a text with a space before and after each; empty without words."""
    words = text.translate(_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))] if words else []


class WuManber:
    """Tables for patterns of similar length: shift by block, and the patterns by the hash of their suffix block."""

    def __init__(self, patterns: list[bytes]):
        self.length = m = min(map(len, patterns))
        self.block = b = max(1, min(16, m // 3))
        self.most = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.ending: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for i in range(m - b + 1):
                s = p[i : i + b]
                d = m - b - i
                if self.shift.get(s, self.most) > d:
                    self.shift[s] = d
            self.ending.setdefault(p[m - b : m], []).append(p)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(position, pattern) of every occurrence, overlaps included."""
        b, m, shift, ending, most = self.block, self.length, self.shift.get, self.ending, self.most
        at, end = m - b, len(text) - b
        while at <= end:
            block = text[at : at + b]
            d = shift(block, most)
            if d:
                at += d
                continue
            start = at - m + b
            for p in ending[block]:
                if text.startswith(p, start):
                    yield start, p
            at += 1


def searchers(patterns: list[bytes]) -> list[WuManber]:
    """One searcher a class of lengths (powers of two), so that a short pattern doesn't shorten the shifts of long ones."""
    by: dict[int, list[bytes]] = {}
    for p in dict.fromkeys(patterns):
        by.setdefault(len(p).bit_length(), []).append(p)
    return [WuManber(x) for x in by.values()]


def _powers(base: int) -> np.ndarray:
    out = np.full(SEGMENT + REACH + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_ODD = 0x9E3779B97F4A7C15  # any odd number has an inverse modulo 2^64
_UP, _DOWN = _powers(_ODD), _powers(pow(_ODD, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on every other."""
    for by in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(by)
    return h ^ (h >> np.uint64(33))


def window_hashes(line: bytes, widths: list[int]) -> Iterator[np.ndarray]:
    """Hashes of all windows of so many words of a spaced line, in order for one width, by sums of bytes times powers modulo 2^64: equal windows have equal hashes."""
    data = np.frombuffer(line, np.uint8)
    gaps = np.flatnonzero(data == 32)
    for a in range(0, len(line), SEGMENT):
        low, high = np.searchsorted(gaps, [a, a + SEGMENT])
        piece = data[a : a + SEGMENT + REACH]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece * _UP[: len(piece)], dtype=np.uint64)])
        for w in widths:
            n = min(high, len(gaps) - w) - low
            if n > 0:
                start = gaps[low : low + n] - a
                end = np.minimum(gaps[low + w : low + w + n] + 1 - a, start + REACH)
                yield _mixed((sums[end] - sums[start]) * _DOWN[start])


def is_suspect(line: bytes, widths: list[int], bits: np.ndarray) -> bool:
    """Whether the filter knows a window of the line; true for every line in which a window occurs."""
    last = np.uint64(8 * len(bits) - 1)
    for h in window_hashes(line, widths):
        step = (h >> np.uint64(32)) | np.uint64(1)
        for j in range(PROBES):
            at = (h + np.uint64(j) * step) & last
            known = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
            h, step = h[known], step[known]
            if not len(h):
                break
        if len(h):
            return True
    return False


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for b in batches:
        of, at = b.column(0).to_numpy(), b.column(1).to_numpy()
        for part in np.unique(of):
            parts.setdefault(int(part), np.zeros(PART_BITS, bool))[at[of == part]] = True
    for part, on in parts.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])


def filter_bits(found: DataFrame, windows_in_all: int) -> np.ndarray:
    """The Bloom filter of all windows: tasks set the bits of their parts, and the parts, FILTER_BITS together at most, come to the driver."""
    size = PART_BITS
    while size < min(FILTER_BITS, BITS_EACH * windows_in_all):
        size *= 2
    step = F.shiftrightunsigned("hash", 32).bitwiseOR(F.lit(1))
    probes = F.array(*((F.col("hash").bitwiseAND(F.lit(size - 1)) + j * step).bitwiseAND(F.lit(size - 1)) for j in range(PROBES)))
    places = found.select(F.explode(probes).alias("place"))
    places = places.select(F.floor(F.col("place") / PART_BITS).cast("long").alias("part"), (F.col("place") % PART_BITS).cast("long").alias("at"))
    out = np.zeros(size // 8, np.uint8)
    for r in places.repartition("part").mapInArrow(_packed, "part long, bits binary").collect():
        out[r["part"] * PART_BITS // 8 : (r["part"] + 1) * PART_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, found, hashes = [], [], []
        for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
            line = spaced(t)
            said = windows(line.split())
            ids += [i] * len(said)
            found += said
            hashes += [np.zeros(0, np.uint64), *window_hashes(line, [min(WINDOW, line.count(b" ") - 1)])] if said else []
        told = np.concatenate([np.zeros(0, np.uint64), *hashes]).view(np.int64)
        costs = pa.array([len(x) + 64 for x in found], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary()), costs, pa.array(told)], ["item_id", "window", "cost", "hash"])


def in_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Windows with their items and blocks, and the number of blocks of at most about ``most`` bytes each; a hash of the window deals them out. Several are a folder each."""
    found = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_items, "item_id string, window binary, cost long, hash long")
    found = cut(found.distinct())
    total = found.agg(F.sum("cost")).first()[0] or 0
    n = -(-2 * total // most) if total > most else min(total, 1)  # twice as many as even blocks need
    found = found.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(max(n, 1))))
    return (stored(found.repartition("block"), "block") if n > 1 else found), n


def one_block(found: DataFrame, k: int) -> dict[bytes, list[str | None]]:
    block: dict[bytes, list[str | None]] = {}
    for r in found.filter(F.col("block") == k).select("item_id", "window").toLocalIterator():
        block.setdefault(bytes(r["window"]), []).append(r["item_id"])
    return block


def _sifted(rows: DataFrame, bits, widths: list[int], text: str, suspects: bool) -> DataFrame:
    """The suspects of rows; or the others, with the hits, items and n_words that a search would give them. Which a row is follows from its text alone."""
    inside, names = rows.schema[0].dataType.names.index(text), [*rows.columns, "hits", "items", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = [spaced(t) for t in utf8(b.column(0).field(inside))]
            wanted = pa.array([is_suspect(x, widths, bits.value) == suspects for x in lines], pa.bool_())
            if suspects:
                yield b.filter(wanted)
            else:
                none, n_words = [[]] * len(lines), [max(0, x.count(b" ") - 1) for x in lines]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(none, pa.list_(pa.int32())), pa.array(none, pa.list_(pa.string())), pa.array(n_words, pa.int64())], names).filter(wanted)

    told = [] if suspects else [*T.StructType.fromDDL(_FOUND), T.StructField("n_words", T.LongType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema, *told]))


_FOUND = "hits array<int>, items array<string>"


def _search(rows: DataFrame, block: dict[bytes, list[str | None]], text: str, kept: bool) -> DataFrame:
    """rows with hits (places of hit words), items and n_words, as one block has them. Not kept: only rows with hits, without their first column."""
    sent = rows.sparkSession.sparkContext.broadcast(block)
    inside, names = rows.schema[0].dataType.names.index(text), [*rows.columns, "hits", "items", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items_of = sent.value
        tables = searchers(list(items_of))
        widths = {p: p.count(b" ") - 1 for p in items_of}
        for b in batches:
            n_words, hits, items = [], [], []
            for t in utf8(b.column(0).field(inside)):
                line = spaced(t)
                n_words.append(max(0, line.count(b" ") - 1))
                found = [x for s in tables for x in s.find(line)]
                hits.append([])
                items.append([])
                if found:
                    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                    marked = np.zeros(n_words[-1] + 1, np.int32)
                    for at, p in found:
                        first = int(np.searchsorted(gaps, at))
                        marked[first] += 1
                        marked[first + widths[p]] -= 1
                    hits[-1] = np.flatnonzero(np.cumsum(marked) > 0)
                    items[-1] = sorted({i for _, p in found for i in items_of[p]}, key=lambda i: (i is None, i))
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64())], names)
            yield out if kept else out.filter(pa.array([len(x) > 0 for x in hits], pa.bool_())).select(names[1:])

    fields = [*rows.schema, *T.StructType.fromDDL(_FOUND), T.StructField("n_words", T.LongType())]
    return rows.mapInArrow(run, T.StructType(fields if kept else fields[1:]))


def searched(docs: DataFrame, benchmark: DataFrame, columns: list[str], most: int = BLOCK_BYTES) -> DataFrame:
    """row (the columns), hits, items, n_words and contaminated of every row. One block is one pass without a shuffle. Of several, each reads the numbered
    suspects and leaves thin rows of its hits only, so that one block at a time is in memory; hits meet their rows in the end. docs is read twice then, and must give the same texts both times."""
    rows = docs.select(F.struct(*(docs[c] for c in columns)).alias("row"))
    found, n = in_blocks(benchmark, most)
    if n < 2:
        out = _search(rows, one_block(found, 0) if n else {}, "text", True)
    else:
        told = found.agg(F.count("*").alias("n"), F.collect_set(F.size(F.split(F.col("window").cast("string"), " ")) - 2).alias("widths")).first()
        bits, widths = docs.sparkSession.sparkContext.broadcast(filter_bits(found, told["n"])), sorted(told["widths"])
        suspects = stored(_sifted(rows, bits, widths, "text", True).withColumn("row_number", F.monotonically_increasing_id()))
        hits = [cut(_search(suspects, one_block(found, k), "text", False)) for k in range(n - 1)]
        others = reduce(DataFrame.unionByName, hits).groupBy("row_number").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("more_hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("more_items"))
        out = _search(suspects, one_block(found, n - 1), "text", True).join(small(cut(others), 256), "row_number", "left")
        out = out.withColumn("hits", F.array_union("hits", F.coalesce("more_hits", F.array().cast("array<int>"))))
        out = out.withColumn("items", F.array_sort(F.array_union("items", F.coalesce("more_items", F.array().cast("array<string>")))))
        out = out.select("row", "hits", "items", "n_words").unionByName(_sifted(rows, bits, widths, "text", False))
    return out.withColumn("contaminated", (F.size("hits") > 0) & (20 * F.size("hits").cast("long") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, most: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated of every row."""
    found = searched(docs, benchmark, ["doc_id", "text"], most)
    return found.select("row.doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "contaminated")


def clean_documents(docs: DataFrame, benchmark: DataFrame, most: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that aren't contaminated, whole and with their columns."""
    return searched(docs, benchmark, docs.columns, most).filter(~F.col("contaminated")).select("row.*")

r"""Suffix-array dedup: repeated byte strings by a run-length compressed index.

A byte goes if it is covered by a ``length``-byte string that also starts in a document with a smaller doc_id.

1. Documents are packed, compressed, into packs of about PACK bytes, UNIT of them a row, and stored: later steps read them again, and text moves twice only.
   A step opens the packs of a row one by one, so memory follows a pack; messages are a row's, so there are UNIT times fewer of them.
2. Anchors: in every window of ``length`` bytes the ``GRAM``-byte substring of least hash. Equal windows have equal anchors at equal places,
   so windows need to meet by anchor alone. Each row sends 32 bits an anchor of a pack to the anchor's bucket, which answers with one bit: is it in
   two documents? A message is a row's share of a bucket, so there are never more messages than anchors, however many rows and buckets there are.
3. For each anchor in two documents a pack sends its context once (all windows around it) with the least doc_id.
4. A bucket takes the contexts that agree with another one on half of their reach, by least document. Of the first half of them it builds a run-length index:
   the Burrows-Wheeler transform as runs, suffix samples at both ends of each run, and for each stretch of rows that share ``length`` bytes the least document. The other
   contexts stream backwards through it: an LF step where the row's run has the symbol, else a jump to the next run that has it, whose sampled suffix says how much still matches.
   That gives their matching statistics, and from ``length`` matched bytes on the stretch of the window and with it its least document. A context
   whose windows are all known by then needs no index. What is left is indexed in turn, at most INDEXED contexts at a time, so an index grows with what is new, not with
   what is repeated. Contexts that are alone need none: all but their first document repeat them.
5. The answer, a bit a window, goes back to the packs, which mark covered bytes.

Work and memory of a task follow a pack or a bucket; buckets grow in number with spark.sql.shuffle.partitions. A passage in any
share of the documents meets as one context a pack.

Defined cases: null and empty texts have no bytes; texts under ``length`` bytes lose nothing; rows with equal ids don't dedup each other; a null id is
greater than all others; ids that aren't whole numbers (text, above all) go by their order; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ordinals, partitions, stored, utf8

LENGTH = 50
GRAM = 20
PACK = 4 << 20
#: Packs in a row of the stored table.
UNIT = 4
_PIECE = 1 << 20
#: Contexts in one index at most.
INDEXED = 16_000
_NO_ID = np.iinfo(np.int64).max
_PACKS = "unit long, packs array<struct<ids: binary, sizes: binary, packed: binary>>"


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq, zip_ = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
    kind = pa.list_(pa.struct([("ids", pa.binary()), ("sizes", pa.binary()), ("packed", pa.binary())]))
    ids, texts, size, packs = [], [], 0, []

    def close() -> None:
        nonlocal ids, texts, size
        packs.append({"ids": np.array(ids, np.int64).tobytes(), "sizes": np.array([len(t) for t in texts], np.int64).tobytes(), "packed": zip_.compress(b"".join(texts))})
        ids, texts, size = [], [], 0

    def row() -> pa.RecordBatch:
        nonlocal seq, packs
        out = pa.RecordBatch.from_arrays([pa.array([part << 32 | seq], pa.int64()), pa.array([packs], kind)], ["unit", "packs"])
        seq, packs = seq + 1, []
        return out

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
            if size and size + len(t) > PACK:
                close()
                if len(packs) == UNIT:
                    yield row()
            ids.append(_NO_ID if i is None else i)
            texts.append(t)
            size += len(t)
    if ids:
        close()
    if packs:
        yield row()


class Pack:
    """The documents of a pack as one buffer, with its anchors."""

    def __init__(self, ids: bytes, sizes: bytes, packed: bytes, length: int):
        self.ids, self.sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.bytes = zstandard.ZstdDecompressor().decompress(packed, int(self.sizes.sum())) if self.sizes.sum() else b""
        self.buffer = np.frombuffer(self.bytes, np.uint8)
        self.at, self.hash = anchors(self.buffer, self.starts, self.ends, length)
        self.doc = np.searchsorted(self.ends, self.at, "right")

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes by bucket and low bits: their order's inverse, bucket, low 31 bits, whether in two documents."""
        low, bucket = (self.hash & np.uint64((1 << 31) - 1)).astype(np.int64), ((self.hash >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
        keys, back = np.unique(bucket << 31 | low, return_inverse=True)
        least, most = np.full(len(keys), len(self.ids)), np.full(len(keys), -1)
        np.minimum.at(least, back, self.doc)
        np.maximum.at(most, back, self.doc)
        return back, keys >> 31, keys & (1 << 31) - 1, least != most


def _slide(h: np.ndarray, width: int, op) -> np.ndarray:
    """op over every run of width values."""
    out, have = h, 1
    while 2 * have <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    n = len(h) - width + 1
    return op(out[:n], out[width - have : width - have + n])


def gram_hashes(buffer: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash, never 0, of the gram starting at each byte."""
    n = len(buffer) - gram + 1
    padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
    words = np.empty(len(buffer) + 8, np.uint64)
    for o in range(8):
        view = padded[o : o + 8 * ((len(padded) - o) // 8)].view("<u8")
        words[o::8] = view[: len(words[o::8])]
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    for o in [*range(8, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
        h ^= h >> np.uint64(29)
        h += words[o : o + n]
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return (h ^ h >> np.uint64(29)) | np.uint64(1 << 63)


def anchors(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the least gram (every one, if several tie) of all windows inside a document; in pieces, so memory doesn't follow the text."""
    width, n = length - gram + 1, len(buffer)
    open_ = np.ones(max(0, n - length + 1), bool)  # windows that don't cross an end
    for a, e in zip(starts.tolist(), ends.tolist(), strict=True):
        open_[max(a, e - length + 1) : e] = False
    found, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for s in range(0, len(open_), _PIECE):
        e = min(len(open_), s + _PIECE)
        h = gram_hashes(buffer[s : e + length - 1], gram)
        least = np.where(open_[s:e], _slide(h, width, np.minimum), np.uint64(0))
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == h)
        found.append(chosen + s)
        hashes.append(h[chosen])
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(hashes)[first]


def _mixed(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct row (rows of 64-bit words) and the number of each row's group, exactly."""
    h = _mixed(rows)
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    if not np.array_equal(rows[first[back]], rows):  # two rows of one hash
        _, first, back = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        back = back.reshape(-1)
    return first, back


def contexts(pack: Pack, which: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """Bytes around the given anchors that their windows cover, padded to whole words; the last two used bytes say how many are missing left and where they end."""
    reach, width = length - gram, 2 * length - gram
    at, doc = pack.at[which], pack.doc[which]
    padded = np.concatenate([np.zeros(reach, np.uint8), pack.buffer, np.zeros(length, np.uint8)])
    out = np.zeros((len(at), -(-(width + 2) // 8) * 8), np.uint8)
    left = np.maximum(0, pack.starts[doc] - (at - reach))
    right = np.minimum(width, pack.ends[doc] - (at - reach))
    out[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
    edge, k = np.flatnonzero((left > 0) | (right < width)), np.arange(width)
    out[edge, :width] *= (k >= left[edge, None]) & (k < right[edge, None])
    out[:, width], out[:, width + 1] = left, right
    return out


class RunLengthIndex:
    """Burrows-Wheeler transform of many short texts as runs, with suffix samples at both ends of each run and the least id of each stretch of rows that share ``length`` symbols.

    Texts are rows of symbols 1..256, 0 from their end on. A suffix is (text, column); suffixes that are equal to their text's end are in text order. The order of all
    suffixes is made by prefix doubling and not kept.
    """

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, least: np.ndarray, length: int):
        m, w = symbols.shape
        self.sizes, self.length = sizes, length
        #: The texts; what lies behind an end matches nothing.
        self.symbols = np.concatenate([symbols, np.zeros((m, w + 1), symbols.dtype)], 1)
        wide = self.symbols[:, : w + 1].astype(np.int64)

        def ahead(x: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros_like(x)
            out[:, :-by] = x[:, by:] if by < x.shape[1] else 0
            return out

        def ranked(key: np.ndarray) -> np.ndarray:
            return np.unique(key, return_inverse=True)[1].reshape(key.shape)  # 0: the empty suffix

        # the first ``depth`` symbols as digits of one number, as many as fit
        alphabet, digit = np.unique(wide, return_inverse=True)
        base = len(alphabet) + int(alphabet[0] != 0)
        digit = (digit.reshape(wide.shape) + (alphabet[0] != 0)).astype(np.uint64)
        key, depth = digit, 1
        while base ** (depth + 1) < 1 << 64 and depth < length:
            key, depth = key * np.uint64(base) + ahead(digit, depth), depth + 1
        rank = ranked(key)
        while depth < w or depth <= length:
            if depth <= length < 2 * depth:
                part, rest = rank, length - depth  # two ranks that together are the first ``length`` symbols
            rank = ranked(rank * (rank.max() + 1) + ahead(rank, depth))
            depth *= 2
        text, column = np.nonzero(np.arange(w + 1)[None, :] <= sizes[:, None])
        order = np.argsort(rank[text, column], kind="stable")
        text, column = text[order], column[order]
        before = np.where(column > 0, wide[text, np.maximum(column - 1, 0)], 0)
        self.starts = np.r_[0, np.flatnonzero(np.diff(before)) + 1]
        self.ends = np.r_[self.starts[1:], len(before)]
        #: The run of each row, plainly: an index is small, and a search a step costs more.
        self.run_of = np.repeat(np.arange(len(self.starts), dtype=np.int32), self.ends - self.starts)
        self.heads = before[self.starts]
        self.first_sample = np.stack([text[self.starts], column[self.starts]])
        self.last_sample = np.stack([text[self.ends - 1], column[self.ends - 1]])
        # LF of each run's first row: rows of smaller symbols, then of the same symbol in runs before
        by_head = np.argsort(self.heads, kind="stable")
        long = (self.ends - self.starts)[by_head]
        self.landing = np.empty(len(self.starts), np.int64)
        self.landing[by_head] = np.cumsum(long) - long
        self.by_head = self.heads[by_head] * len(self.starts) + by_head
        first, second = part[text, column], ahead(part, rest)[text, column] if rest else part[text, column]
        stretches = np.r_[0, np.flatnonzero((np.diff(first) != 0) | (np.diff(second) != 0)) + 1]
        self.least = np.minimum.reduceat(least[text], stretches)
        self.stretch_of = np.repeat(np.arange(len(stretches), dtype=np.int32), np.diff(np.r_[stretches, len(before)]))

    def lf(self, rows: np.ndarray, run: np.ndarray | None = None) -> np.ndarray:
        run = self.run_of[rows] if run is None else run
        return self.landing[run] + rows - self.starts[run]

    def first_of(self, rows: np.ndarray) -> np.ndarray:
        """Least id of the texts that have the first ``length`` symbols of these rows' suffixes."""
        return self.least[self.stretch_of[rows]]

    def own(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The indexed texts, backwards in step from their ends: (texts, column, least id of the window there)."""
        rows = np.arange(len(self.sizes))  # the empty suffixes come first, in text order
        texts = np.arange(len(self.sizes))
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            going = self.sizes[texts] >= back
            texts, rows = texts[going], self.lf(rows[going])
            if back >= self.length:
                yield texts, self.sizes[texts] - back, self.first_of(rows)

    def stream(self, symbols: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics of other texts, backwards in step: (texts, column, longest match from there, a row whose suffix has it)."""
        texts = np.arange(len(sizes))
        rows, match = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for back in range(1, int(sizes.max(initial=0)) + 1):
            going = sizes[texts] >= back
            texts, rows, match = texts[going], rows[going], match[going]
            column = sizes[texts] - back
            symbol = symbols[texts, column].astype(np.int64)
            run = self.run_of[rows]
            lost = np.flatnonzero(self.heads[run] != symbol)
            if len(lost):
                n = len(self.starts)
                at = np.searchsorted(self.by_head, symbol[lost] * n + run[lost])
                below, above = self.by_head[np.minimum(at, n - 1)], self.by_head[np.maximum(at - 1, 0)]
                some_below, some_above = (at < n) & (below // n == symbol[lost]), (at > 0) & (above // n == symbol[lost])
                below, above = below % n, above % n
                of, here = texts[lost], column[lost] + 1
                down = np.where(some_below, self.common(symbols, of, here, self.first_sample[:, below], np.where(some_below, match[lost], 0)), -1)
                up = np.where(some_above, self.common(symbols, of, here, self.last_sample[:, above], np.where(some_above, match[lost], 0)), -1)
                to_below = down >= up
                run[lost] = np.where(to_below, below, above)
                rows[lost] = np.where(to_below, self.starts[below], self.ends[above] - 1)
                match[lost] = np.maximum(down, up)
            rows, match = self.lf(rows, run), match + 1
            rows[match == 0] = 0  # no text has the symbol
            yield texts, column, match, rows

    def common(self, symbols: np.ndarray, texts: np.ndarray, columns: np.ndarray, sample: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How much, up to ``most``, the texts from these columns on have in common with the sampled suffixes."""
        out, left = np.zeros(len(texts), np.int64), np.flatnonzero(most > 0)
        k = 0
        while len(left):
            left = left[symbols[texts[left], columns[left] + k] == self.symbols[sample[0, left], sample[1, left] + k]]
            k += 1
            out[left] = k
            left = left[most[left] > k]
        return out


def _matched(unique: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray, length: int, width: int) -> np.ndarray:
    """Bits of the windows that a context with a smaller least document has too. Contexts come by least document."""
    columns = np.arange(width)[None, :] + left[:, None]
    symbols = np.where(columns < right[:, None], np.take_along_axis(unique, np.minimum(columns, width - 1), 1).astype(np.int16) + 1, 0).astype(np.int16)
    sizes, marks = right - left, np.zeros(len(unique), np.uint64)
    all_ = _windows(left, right, length, width)

    def mark(texts: np.ndarray, column: np.ndarray, known: np.ndarray) -> None:
        hit = known < least[texts]
        marks[texts[hit]] |= np.uint64(1) << (column[hit] + left[texts[hit]]).astype(np.uint64)

    waiting = np.arange(len(unique))
    while len(waiting):
        n = min(INDEXED, -(-len(waiting) // 2) if len(waiting) == len(unique) else len(waiting))
        now, waiting = waiting[:n], waiting[n:]
        index = RunLengthIndex(symbols[now], sizes[now], least[now], length)
        for texts, column, known in index.own():
            mark(now[texts], column, known)
        for texts, column, match, rows in index.stream(symbols[waiting], sizes[waiting]):
            met = match >= length
            mark(waiting[texts[met]], column[met], index.first_of(rows[met]))
        waiting = waiting[marks[waiting] != all_[waiting]]
    return marks


def _windows(left: np.ndarray, right: np.ndarray, length: int, width: int) -> np.ndarray:
    """A bit for each window of ``length`` bytes between left and right."""
    window = np.arange(width - length + 1, dtype=np.uint64)
    bits = np.where((window >= left[:, None].astype(np.uint64)) & (window + np.uint64(length) <= right[:, None].astype(np.uint64)), np.uint64(1) << window, np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1) if len(bits) else np.zeros(0, np.uint64)


def first_documents(rows: np.ndarray, ids: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """For the contexts (bytes) and their ids, a bit for each window that also starts in a smaller document."""
    reach, width = length - gram, 2 * length - gram
    first, back = grouped(rows.view("<u8"))
    least = np.full(len(first), _NO_ID)
    np.minimum.at(least, back, ids)
    unique = rows[first]
    left, right = unique[:, width].astype(np.int64), unique[:, width + 1].astype(np.int64)
    # a window reaches at least so far on both sides of the anchor, for one of these pairs: contexts that share none of them share no window
    several = np.arange(len(unique))
    for steps in (2, 4, 8):
        marked = np.zeros(len(several), bool)
        edges = [-(-k * (reach + 1) // steps) for k in range(steps + 1)]
        for a, b in zip(edges, edges[1:], strict=False):
            size = a + gram + reach + 1 - b
            part = np.zeros((len(several), -(-size // 8) * 8), np.uint8)
            part[:, :size] = unique[several, reach - a : reach - a + size]
            _, of = grouped(part.view("<u8"))
            marked |= np.bincount(of)[of] > 1
        several = several[marked]
    marks = np.zeros(len(unique), np.uint64)
    # contexts of one anchor stay together; anchors are dealt out over indexes of about INDEXED contexts
    anchor = np.zeros((len(several), -(-gram // 8) * 8), np.uint8)
    anchor[:, :gram] = unique[several, reach : reach + gram]
    piece = _mixed(anchor.view("<u8")) % np.uint64(len(several) // INDEXED + 1)
    for k in range(len(several) // INDEXED + 1):
        own = several[piece == k]
        own = own[np.argsort(least[own], kind="stable")]
        if len(own):
            marks[own] = _matched(unique[own], left[own], right[own], least[own], length, width)
    every = _windows(left, right, length, width)
    return np.where(ids > least[back], every[back], marks[back])


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    edge = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip(np.r_[0, edge], np.r_[edge, len(bucket)], strict=True) if len(bucket) else ():
        yield int(bucket[a]), slice(int(a), int(b))


def _rows(unit: int, blobs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([unit] * len(blobs), pa.int64()), pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["unit", "bucket", "blob"])


def _sent(unit: int, blobs: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    """One message a bucket: what the unit's packs have for it, in their order."""
    by: dict[int, list[bytes]] = {}
    for k, x in blobs:
        by.setdefault(k, []).append(x)
    return _rows(unit, [(k, b"".join(by[k])) for k in sorted(by)])


class _Answers:
    """What the buckets told a unit, as arrays, taken in the order in which its packs asked."""

    def __init__(self, told, read):
        self.by = {x["bucket"]: read(np.frombuffer(x["blob"], np.uint8)) for x in told or ()}
        self.at = dict.fromkeys(self.by, 0)

    def next(self, bucket: int, size: int) -> np.ndarray:
        at = self.at[bucket]
        self.at[bucket] = at + size
        return self.by[bucket][at : at + size]


def _frames(blob: bytes) -> Iterator[bytes]:
    """Contents of the compressed frames of a message, each after its length."""
    unzip, at = zstandard.ZstdDecompressor(), 0
    while at < len(blob):
        size = int.from_bytes(blob[at : at + 4], "little")
        yield unzip.decompress(blob[at + 4 : at + 4 + size])
        at += 4 + size


_BLOBS = "unit long, bucket int, blob binary"


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans (array<struct<start, end>>, bytes, maximal removed runs) and kept (binary) of every row."""
    if not GRAM + 8 <= length <= 80:
        raise ValueError("length must be between 28 and 80")
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        order = ordinals(docs.select("doc_id"))
        numbered = docs.select("doc_id", "text").join(order, F.col("doc_id") == F.col("named"), "left").select(F.col("ordinal").alias("doc_id"), "text")
        return removals(numbered, length).join(order, F.col("doc_id") == F.col("ordinal"), "left").select(F.col("named").alias("doc_id"), "n_bytes", "spans", "kept")
    n = partitions(docs.sparkSession)
    packs = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packs, _PACKS))

    def opened(b: pa.RecordBatch, i: int) -> Iterator[Pack]:
        for x in b.column("packs")[i]:
            yield Pack(*(x[c].as_py() for c in ("ids", "sizes", "packed")), length)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked(p: Pack) -> Iterator[tuple[int, bytes]]:
            _, bucket, low, two = p.grams(n)
            sent = (low | two.astype(np.int64) << 31).astype(np.uint32)
            for k, s in _by_bucket(bucket):
                yield k, sent[s].tobytes()

        for b in batches:
            for i, unit in enumerate(b.column("unit").to_pylist()):
                yield _sent(unit, (x for p in opened(b, i) for x in asked(p)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, buckets, blobs = [], [], []
        for b in batches:
            for into, c in zip((units, buckets, blobs), b.columns, strict=True):
                into += c.to_pylist()
        for k in sorted(set(buckets)):
            own = [i for i, x in enumerate(buckets) if x == k]
            sent = np.concatenate([np.frombuffer(blobs[i], np.uint32) for i in own])
            _, back, count = np.unique(sent & np.uint32((1 << 31) - 1), return_inverse=True, return_counts=True)
            two = np.bincount(back, sent >> np.uint32(31)) > 0
            shared = ((count > 1) | two)[back]
            at = 0
            for i in own:
                size = len(blobs[i]) // 4
                yield _rows(units[i], [(k, np.packbits(shared[at : at + size]).tobytes())])
                at += size

    def bits_of(b: pa.RecordBatch, i: int) -> _Answers:
        return _Answers(b.column("bits")[i].as_py(), np.unpackbits)

    def entries(p: Pack, bits: _Answers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shared anchors of a pack and their distinct contexts: places in p.at, context number of each, contexts, bucket and least id of each context (by bucket)."""
        back, bucket, _, _ = p.grams(n)
        shared = np.zeros(len(bucket), bool)
        for k, s in _by_bucket(bucket):
            shared[s] = bits.next(k, s.stop - s.start)
        which = np.flatnonzero(shared[back]) if len(back) else np.zeros(0, np.int64)
        rows = contexts(p, which, length)
        first, group = grouped(rows.view("<u8"))
        least = np.full(len(first), _NO_ID)
        np.minimum.at(least, group, p.ids[p.doc[which]])
        of = bucket[back[which[first]]] if len(which) else np.zeros(0, np.int64)
        order = np.argsort(of, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return which, place[group], rows[first[order]], of[order], least[order]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)

        def sent(p: Pack, bits: _Answers) -> Iterator[tuple[int, bytes]]:
            _, _, rows, bucket, least = entries(p, bits)
            for k, s in _by_bucket(bucket):
                frame = zip_.compress(least[s].tobytes() + rows[s].T.tobytes())
                yield k, len(frame).to_bytes(4, "little") + frame

        for b in batches:
            for i, unit in enumerate(b.column("unit").to_pylist()):
                bits = bits_of(b, i)
                yield _sent(unit, (x for p in opened(b, i) for x in sent(p, bits)))

    size = 8 + -(-(2 * length - GRAM + 2) // 8) * 8

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[tuple[int, bytes]]] = {}
        for b in batches:
            for unit, k, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                by.setdefault(k, []).append((unit, blob))
        for k in sorted(by):
            sent = [(unit, list(_frames(x))) for unit, x in by.pop(k)]
            got = [x for _, frames in sent for x in frames]
            counts = [len(x) // size for x in got]
            ids = np.concatenate([np.frombuffer(x[: 8 * c], np.int64) for x, c in zip(got, counts, strict=True)])
            rows = np.concatenate([np.frombuffer(x[8 * c :], np.uint8).reshape(size - 8, c).T for x, c in zip(got, counts, strict=True)])
            marks = first_documents(np.ascontiguousarray(rows), ids, length)
            at = 0
            for unit, frames in sent:
                c = sum(len(x) // size for x in frames)
                yield _rows(unit, [(k, marks[at : at + c].tobytes())])
                at += c

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for b in batches:
            for i in range(b.num_rows):
                bits, answers = bits_of(b, i), _Answers(b.column("marks")[i].as_py(), lambda x: x.view(np.uint64))
                for p in opened(b, i):
                    yield marked(p, bits, answers, span)

    def marked(p: Pack, bits: _Answers, answers: _Answers, span: pa.DataType) -> pa.RecordBatch:
        which, entry, rows, bucket, least = entries(p, bits)
        marks = np.zeros(len(rows), np.uint64)
        for k, s in _by_bucket(bucket):
            marks[s] = answers.next(k, s.stop - s.start)
        at, doc = p.at[which] - (length - GRAM), p.doc[which]
        first = np.maximum(0, p.starts[doc] - at)
        last = np.minimum(length - GRAM, p.ends[doc] - length - at)
        later = p.ids[doc] > least[entry]  # repeats of the pack's own first
        hits = np.where(later, ~np.uint64(0), marks[entry])
        begun = np.zeros(len(p.buffer) + 1, bool)
        for w in range(length - GRAM + 1):
            begun[at[(first <= w) & (w <= last) & (hits >> np.uint64(w) & np.uint64(1)).astype(bool)] + w] = True
        count = np.cumsum(begun[: len(p.buffer)], dtype=np.int32)
        gone = count > 0
        gone[length:] = count[length:] > count[:-length]
        spans, kept = [], []
        for a, e in zip(p.starts.tolist(), p.ends.tolist(), strict=True):
            own = gone[a:e]
            if not own.any():
                spans.append([])
                kept.append(p.bytes[a:e])
                continue
            turns = np.flatnonzero(np.diff(np.r_[False, own, False]))
            spans.append([{"start": int(x), "end": int(y)} for x, y in turns.reshape(-1, 2)])
            kept.append(p.buffer[a:e][~own].tobytes())
        ids = pa.array([None if x == _NO_ID else x for x in p.ids.tolist()], pa.int64())
        return pa.RecordBatch.from_arrays([ids, pa.array(p.sizes), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    def told(blobs: DataFrame, name: str) -> DataFrame:
        return blobs.groupBy(F.col("unit").alias(f"of_{name}")).agg(F.collect_list(F.struct("bucket", "blob")).alias(name))

    bits = stored(packs.mapInArrow(ask, _BLOBS).repartitionById(n, "bucket").mapInArrow(answer, _BLOBS))
    asked = told(bits, "bits")
    known = packs.join(asked, packs["unit"] == asked["of_bits"], "left").select(*packs.columns, "bits")
    marks = known.mapInArrow(send, _BLOBS).repartitionById(n, "bucket").mapInArrow(match, _BLOBS)
    answered = told(marks, "marks")
    done = asked.join(answered, asked["of_bits"] == answered["of_marks"], "left").select("of_bits", "bits", "marks")
    final = packs.join(done, packs["unit"] == done["of_bits"], "left").select(*packs.columns, "bits", "marks")
    return final.mapInArrow(finish, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")

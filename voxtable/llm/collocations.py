r"""Phrase collocations by direct-address tiling.

Words are numbered by their frequency within a language, so that the pairs of frequent words, which are most of all pairs, have two small numbers. A pair is a place in a matrix that is cut into
square tiles of TILE words a side: a task counts the pairs of a tile that is well filled into a dense array by bincount, and those of the other tiles as sorted coordinates. What
a task has counted is summed by pair. Pairs that are frequent enough are numbered by frequency in turn, and the same counter counts their continuations, (pair number, word number), as phrases of
one word more, and so on for longer ones. A phrase that occurs ``least`` times is made of parts that do, so the others need not be counted.

Numbers are given to the most frequent words or phrases of all languages together, HEAD at most, a table of fixed size that all tasks get. Any other word is known by a 62-bit hash, checked to be
free of collisions over all words (else another seed is taken), and any other phrase by its words, which are counted as coordinates; a bitmap of fixed size tells most of those that are too rare. Texts
are read twice, to count words and to encode them; all else works on the encoded texts.

Scores are exact: 1000000 * a * a / (l * r) in decimals of 38 digits, which hold counts up to 10^15.

Defined cases: a null text is empty, a null language is ``und``; very long texts are read in pieces of PIECE bytes cut between words, and adjacency survives the cut; repeated rows count
each; an empty table gives an empty result; extra columns aren't read. Pieces never join over a mark or a line end, words never over texts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, small, stored, utf8

LEAST, WORDS, TOP = 10, 3, 2000
#: A longer candidate hides the phrases inside it if it has this share of their occurrences, in percent.
HIDES = 50
#: Words, and phrases of each length, that get a number and are known to all tasks; some 100 bytes each.
HEAD = 1 << 18
#: Words a side of a tile; a tile is dense if a batch has a pair for every DENSE cells of it.
TILE, DENSE = 256, 8
#: Bits of the map that tells rare words and pairs.
BITS = 1 << 26
#: Bytes of text read at once; encoded words in one row; words counted at once.
PIECE, ROW, BATCH = 1 << 20, 1 << 16, 1 << 19
_BREAK, _RARE, _TAIL, _HASHED = -1, -2, -3, 1 << 62
_MARKS = bytes(10 if c in b".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_TOKEN = re.compile(rb"[^ \n]+|\n+")
_CUT = re.compile(rb"[ \n]")


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text, lower-cased, marks as line ends and tabs as blanks, in parts cut between words."""
    at = 0
    while at < len(text):
        end = at + size
        part = text[at:end].translate(_MARKS)
        while end < len(text):
            more = text[end : end + size].translate(_MARKS)
            found = _CUT.search(more)
            stop = found.start() if found else len(more)
            part, end = part + more[:stop], end + stop
            if found:
                break
        yield part
        at = end


def _langs() -> Column:
    return F.coalesce("lang", F.lit("und")).alias("lang")


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word (UTF-8), n of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def told() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                words, ns = list(counts), list(counts.values())
                for at in range(0, len(words), 1 << 16):
                    part = words[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(part), pa.string()), "word": pa.array(part, pa.binary()), "n": pa.array(ns[at : at + (1 << 16)], pa.int64())})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
                for part in pieces(text, PIECE):
                    counts = held[lang]
                    counts.update(part.replace(b"\n", b" ").split(b" "))
                    counts.pop(b"", None)
                    if sum(map(len, held.values())) > 1 << 20:
                        yield from told()
        yield from told()

    out = docs.select("text", _langs()).mapInArrow(run, "lang string, word binary, n long")
    return out.repartition("lang", "word").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def hashed(words: list[bytes], seed: int) -> list[int]:
    return [xxhash.xxh64_intdigest(w, seed) >> 2 | _HASHED for w in words]


def _hash_column(seed: int):
    def run(words: pd.Series) -> pd.Series:
        return pd.Series(hashed(words.tolist(), seed), dtype="int64")

    return F.pandas_udf(run, "long")


def numbered(counts: DataFrame, least: int, head: int) -> tuple[DataFrame, int]:
    """The words that occur ``least`` times in a language, with id: the rank by frequency of the first ``head`` of all languages, else a hash; and the hash's seed."""
    known = stored(counts)
    for seed in range(64):
        ids = known.withColumn("id", _hash_column(seed)("word"))
        if ids.groupBy("lang", "id").agg(F.count("*").alias("of")).filter("of > 1").isEmpty():
            break
    else:
        raise ValueError("hashes of words collide under every seed")
    return ranked(ids.filter(F.col("n") >= least), ["word"], head), seed


def ranked(counts: DataFrame, named: list[str], head: int) -> DataFrame:
    """counts with rank: the place by frequency within a language for the most frequent rows of all languages, ``head`` of them at most; null for the others."""
    step = F.floor(64 * F.log2("n"))
    counts = stored(counts.withColumn("step", step))
    above, least = 0, None
    for at, n in sorted(map(tuple, counts.groupBy("step").agg(F.count("*").alias("n")).collect()), reverse=True):  # at most 64 * 64 steps
        above += n
        if above > head:
            break
        least = at
    inside = F.lit(False) if least is None else F.col("step") >= least
    place = (F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), *named)) - 1).cast("long")
    first, rest = counts.filter(inside).withColumn("rank", place), counts.filter(~inside).withColumn("rank", F.lit(None).cast("long"))
    return stored(first.unionByName(rest).drop("step"))


def _mixed(*columns: np.ndarray) -> np.ndarray:
    """A place in the bitmap for each row of ids."""
    out = np.zeros(len(columns[0]), np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            out = (out ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return (out % np.uint64(BITS)).astype(np.int64)


def bitmap(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """One bit for each of the rows, of fixed size; made in the tasks and joined by OR, in few steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_mixed(*(batch.column(c).to_numpy().astype(np.int64) for c in columns)))
            yield pa.RecordBatch.from_pydict({"word": pa.array(at >> 6), "bits": pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))})

    words = rows.select(columns).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(BITS >> 6, np.int64)
    for batch in words.toArrow().to_batches():  # at most BITS / 64 rows
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return out


def _may(bits: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    at = _mixed(*columns)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def encoded(docs: DataFrame, vocabulary: DataFrame, seed: int) -> DataFrame:
    """lang, context, ids, tail: texts as ids, a break after each piece. A row repeats the last ``context`` ids of the row before it, if that goes on in it.

    ids are 32-bit numbers: a rank, a break, a rare word, or the place of a hash in tail (``decoded``).
    """
    spark = docs.sparkSession
    known: dict[str, dict[bytes, int]] = defaultdict(dict)
    first = vocabulary.filter("rank is not null").select("lang", "word", "rank").toArrow()  # HEAD rows at most
    for lang, word, rank in zip(*(c.to_pylist() for c in first.columns), strict=True):
        known[lang][word] = rank
    table = spark.sparkContext.broadcast(dict(known))
    tail = vocabulary.filter("rank is null").select("id")
    bits = spark.sparkContext.broadcast(None if tail.isEmpty() else bitmap(tail, ["id"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        size: Counter = Counter()
        context: Counter = Counter()

        def told(lang: str) -> pa.RecordBatch:
            ids = np.concatenate(held[lang])
            far = np.flatnonzero(ids >= _HASHED)
            tail, at = np.unique(ids[far], return_inverse=True)
            keep, codes = ids[-(WORDS - 1) :], ids.copy()  # a row is longer than that
            codes[far] = _TAIL - at
            made = {"lang": pa.array([lang], pa.string()), "context": pa.array([context[lang]], pa.int32()), "ids": pa.array([codes.astype(np.int32).tobytes()], pa.binary()), "tail": pa.array([tail.tobytes()], pa.binary())}
            held[lang], size[lang], context[lang] = [keep], 0, len(keep)
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
                get, tail_bits = table.value.get(lang, {}).get, bits.value
                for part in pieces(text, PIECE):
                    tokens = _TOKEN.findall(part)
                    if not tokens:
                        continue
                    ids = np.fromiter((get(t, _RARE) if t[0] != 10 else _BREAK for t in tokens), np.int64, len(tokens))
                    if tail_bits is not None:
                        rare = np.flatnonzero(ids == _RARE)
                        other = np.array(hashed([tokens[i] for i in rare], seed), np.int64)
                        ids[rare] = np.where(_may(tail_bits, other), other, _RARE)
                    held[lang].append(ids)
                    size[lang] += len(ids)
                    if size[lang] >= ROW:
                        yield told(lang)
                if size[lang] or context[lang]:
                    held[lang].append(np.array([_BREAK]))
        for lang in [x for x in held if size[x]]:
            yield told(lang)

    return docs.select("text", _langs()).mapInArrow(run, "lang string, context int, ids binary, tail binary")


def decoded(ids: bytes, tail: bytes) -> np.ndarray:
    out = np.frombuffer(ids, np.int32).astype(np.int64)
    far = np.flatnonzero(out <= _TAIL)
    out[far] = np.frombuffer(tail, np.int64)[_TAIL - out[far]]
    return out


# ---- the counter ----


def tiled(left: np.ndarray, right: np.ndarray, side: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The different pairs of ranks, with their counts: bincount for well filled tiles, sorted coordinates for all others."""
    wide = int(right.max()) // side + 1 if len(right) else 1
    tile = (left // side) * wide + right // side
    order = np.argsort(tile, kind="stable")
    left, right, tile = left[order], right[order], tile[order]
    edge = np.flatnonzero(np.diff(tile)) + 1
    start, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(tile)]])
    dense = (end - start) * DENSE >= side * side
    for a, b in zip(start[dense], end[dense], strict=True):
        top, aside = left[a] // side * side, right[a] // side * side
        cells = np.bincount((left[a:b] - top) * side + (right[a:b] - aside), minlength=side * side)
        at = np.flatnonzero(cells)
        yield at // side + top, at % side + aside, cells[at]
    rest = np.repeat(~dense, end - start)
    if rest.any():
        left, right = left[rest], right[rest]
        across = int(right.max()) + 1
        code, n = np.unique(left * across + right, return_counts=True)
        yield code // across, code % across, n


def coordinates(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of ids, sorted, with their counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def phrase_counts(texts: DataFrame, size: int, shorter: DataFrame | None, least: int) -> DataFrame:
    """lang, w1 .. w{size}, n of the phrases of so many words that can occur ``least`` times.

    shorter: the frequent phrases of one word less, with their rank; a phrase's first size - 1 words are looked up there, and its last ones must be there, too.
    """
    spark = texts.sparkSession
    names = [f"w{k + 1}" for k in range(size)]
    heads: dict[str, list[np.ndarray]] = {}
    bits = None
    if shorter is not None:
        first = shorter.filter("rank is not null").select("lang", *names[:-1], "rank").toArrow().to_pandas()  # HEAD rows at most
        heads = {lang: _sorted_rows(g[names[:-1]].to_numpy(np.int64), g["rank"].to_numpy(np.int64)) for lang, g in first.groupby("lang")}
        bits = bitmap(shorter, names[:-1])
    shared = spark.sparkContext.broadcast((heads, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[list[np.ndarray]]] = defaultdict(list)
        waiting: Counter = Counter()

        def batch_of(lang: str, columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(n), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(n[cut]), pa.string())} | {k: pa.array(c[cut], pa.int64()) for k, c in zip(names, columns, strict=True)} | {"n": pa.array(n[cut].astype(np.int64))})

        def counted(lang: str) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held.pop(lang), strict=True)]
            waiting[lang] = 0
            heads, bits = shared.value
            if size == 2:
                rank, words = columns[0], None
            else:
                on = _may(bits, *columns[1:])  # the last words are a frequent phrase, as far as the map tells
                columns = [c[on] for c in columns]
                rank, words = _ranks(heads.get(lang), columns[:-1])
                on = (rank >= 0) | _may(bits, *columns[:-1])
                rank, columns = rank[on], [c[on] for c in columns]
            near = (rank >= 0) & (rank < _HASHED) & (columns[-1] < _HASHED)
            for a, b, n in tiled(rank[near], columns[-1][near], TILE) if near.any() else ():
                yield from batch_of(lang, [a, b] if words is None else [*words[a].T, b], n)
            if not near.all():
                yield from batch_of(lang, *coordinates([c[~near] for c in columns]))

        for batch in batches:
            for lang, context, ids, tail in zip(*(batch.column(c).to_pylist() for c in ("lang", "context", "ids", "tail")), strict=True):
                ids = decoded(ids, tail)
                ends = np.arange(max(context, size - 1), len(ids))  # a phrase is counted where it ends, and the context has been
                whole = np.all([ids[ends - k] >= 0 for k in range(size)], axis=0)
                ends = ends[whole]
                held[lang].append([ids[ends - size + 1 + k] for k in range(size)])
                waiting[lang] += len(ends)
                if waiting.total() >= BATCH:
                    yield from counted(max(waiting, key=waiting.get))
        for lang in list(held):
            yield from counted(lang)

    counts = texts.mapInArrow(run, f"lang string, {', '.join(f'{k} long' for k in names)}, n long")
    # a task has summed up its own, so rows are moved first and summed up once
    return counts.repartition("lang", *names).groupBy("lang", *names).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _sorted_rows(rows: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
    """Rows of ids by rank, and the hashes of them in order with their ranks."""
    by_rank = np.empty_like(rows)
    by_rank[rank] = rows
    mixed = _wide(*rows.T)
    order = np.argsort(mixed, kind="stable")
    return [by_rank, mixed[order], rank[order]]


def _wide(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            out = (out ^ c.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
    return out


def _ranks(head: list[np.ndarray] | None, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
    """The rank of each row of ids, -1 if it has none; rows are compared whole, so a hash that two phrases share only costs the later one its number."""
    out = np.full(len(columns[0]), -1, np.int64)
    if head is None:
        return out, None
    by_rank, mixed, rank = head
    want = _wide(*columns)
    at = np.minimum(np.searchsorted(mixed, want), len(mixed) - 1)
    same = (mixed[at] == want) & np.all([by_rank[rank[at], k] == c for k, c in enumerate(columns)], axis=0)
    out[same] = rank[at[same]]
    return out, by_rank


# ---- collocations ----


def collocations(docs: DataFrame, least: int = LEAST, longest: int = WORDS, top: int = TOP, hides: int = HIDES, head: int = HEAD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases of 2 to ``longest`` words."""
    if longest > WORDS or longest < 2:
        raise ValueError(f"phrases have 2 to {WORDS} words")
    counts = stored(word_counts(docs))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    vocabulary, seed = numbered(counts, least, head)
    vocabulary = vocabulary.withColumn("id", F.coalesce("rank", "id"))
    texts = stored(encoded(docs, vocabulary, seed))
    phrases, shorter = {1: vocabulary.select("lang", F.col("id").alias("w1"), "n")}, None
    for size in range(2, longest + 1):
        found = phrase_counts(texts, size, shorter, least)
        phrases[size] = shorter = ranked(found, [f"w{k + 1}" for k in range(size)], head)
    scored = [_scored(phrases, size) for size in range(2, longest + 1)]
    kept = [_unhidden(scored, k, hides) for k in range(len(scored))]
    named = kept[0]
    for part in kept[1:]:
        named = named.unionByName(part, allowMissingColumns=True)
    words = small(stored(vocabulary.select("lang", "id", "word")), 100)
    for k in range(longest):
        named = named.join(words.select("lang", F.col("id").alias(f"w{k + 1}"), F.col("word").cast("string").alias(f"t{k + 1}")), ["lang", f"w{k + 1}"], "left")
    named = named.withColumn("phrase", F.concat_ws(" ", *[f"t{k + 1}" for k in range(longest)]))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each part of a language first, so that no task orders a language
    part = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession)))
    best = named.withColumn("in_part", F.row_number().over(W.partitionBy("lang", part).orderBy(*order))).filter(F.col("in_part") <= top)
    out = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return out.join(small(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def _scored(phrases: dict[int, DataFrame], size: int) -> DataFrame:
    """lang, w1 .., a, l, r, score of the phrases of one length, by the cut that scores lowest."""
    names = [f"w{k + 1}" for k in range(size)]
    out = phrases[size].select("lang", *names, F.col("n").alias("a"))
    cuts = []
    for k in range(1, size):
        for side, used in (("l", names[:k]), ("r", names[k:])):
            part = phrases[len(used)].select("lang", *(F.col(f"w{i + 1}").alias(w) for i, w in enumerate(used)), F.col("n").alias(f"{side}{k}"))
            out = out.join(small(part, 48), ["lang", *used])
        score = F.expr(f"(cast(1000000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(a as decimal(38,0))) div (cast(l{k} as decimal(38,0)) * cast(r{k} as decimal(38,0)))")
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*cuts))
    return out.select("lang", *names, "a", best["l"].alias("l"), best["r"].alias("r"), best["score"].alias("score"))


def _unhidden(scored: list[DataFrame], k: int, hides: int) -> DataFrame:
    """Phrases of one length without those inside a longer candidate that has the share of their occurrences."""
    out, size = scored[k], k + 2
    names = [f"w{i + 1}" for i in range(size)]
    inside = [longer.select("lang", *(F.col(f"w{at + i + 1}").alias(w) for i, w in enumerate(names)), F.col("a").alias("outer")) for m, longer in enumerate(scored[k + 1 :], k + 3) for at in range(m - size + 1)]
    if not inside:
        return out
    union = inside[0]
    for part in inside[1:]:
        union = union.unionByName(part)
    most = union.groupBy("lang", *names).agg(F.max("outer").alias("outer"))
    return out.join(most, ["lang", *names], "left").filter(F.col("outer").isNull() | (100 * F.col("outer") < hides * F.col("a"))).drop("outer")

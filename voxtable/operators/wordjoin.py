"""Looking words up in a lexicon of any size without moving the corpus' words.

The lexicon's words are ranked by their frequency in the corpus, counted where the texts are read (one row a word and task is moved, not one an occurrence). The most frequent ones, HEAD_BYTES of them,
are sent to all tasks, which look them up in place. Of the others a bitmap of fixed size is sent: an occurrence that isn't in it has no entry. What is left, rare words with an entry and the few
that the bitmap mistakes, is exploded and joined by word, and its phones are put back between the others by their places in the text. Only rows with such words are written and moved; the others,
most of them, are done where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.sources.corpus import stored

#: Bytes of lexicon entries that are sent to all tasks.
HEAD_BYTES = 64 << 20
#: Bits of the map of the other words; 16 MiB.
BITS = 1 << 27
_STEPS = 64


def _entry_bytes() -> Column:
    return (F.octet_length("word") + F.octet_length(F.array_join("phones", " ")) + 16).cast("long")


def split_by_frequency(lexicon: DataFrame, words: DataFrame, most: int = HEAD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The lexicon's most frequent entries, ``most`` bytes at most, and its others that the corpus has. words: one array of words a row."""
    counts = words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    known = lexicon.join(counts, "word").withColumn("step", F.floor(_STEPS * F.log2("n"))).withColumn("bytes", _entry_bytes())
    known = stored(known)
    room, least = most, None
    for step, size in sorted(map(tuple, known.groupBy("step").agg(F.sum("bytes").alias("bytes")).collect()), reverse=True):  # a row a step of frequency
        room -= size
        if room < 0:
            break
        least = step
    inside = F.lit(False) if least is None else F.col("step") >= least
    return known.filter(inside).select("word", "phones"), known.filter(~inside).select("word", "phones")


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.view(np.uint64) % np.uint64(bits)).astype(np.int64)


def bitmap(words: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for the hash of each word; made in the tasks, 64 bits a row, at most bits / 64 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(_places(b.column("hash").to_numpy().astype(np.int64), bits))
            yield pa.RecordBatch.from_pydict({"cell": pa.array(at >> 6), "bits": pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))})

    cells = words.select(F.xxhash64("word").alias("hash")).mapInArrow(run, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out


class Entries:
    """A lexicon's words by their 64-bit hashes in order (an index by words would be built anew for every batch), and their phones, joined."""

    def __init__(self, lexicon: DataFrame):
        table = lexicon.withColumn("hash", F.xxhash64("word")).orderBy("hash").toArrow()
        self.words, phones = (table[c].combine_chunks() for c in ("word", "phones"))
        self.hashes = table["hash"].combine_chunks().to_numpy()
        self.alike = bool((self.hashes[1:] == self.hashes[:-1]).any())
        self.counts = pc.list_value_length(phones).to_numpy(zero_copy_only=False).astype(np.int64)
        each = phones.flatten()
        self.odd = bool(each.null_count) or bool(pc.any(pc.match_substring(each, _BETWEEN)).as_py())
        if self.odd:
            each = pa.array(["-" if x is None else x.encode().hex() for x in each.to_pylist()], pa.string())
        self.joined = pc.binary_join(lists(self.counts, each), _BETWEEN)

    def find(self, words: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words have an entry, and the places of these entries."""
        if self.alike or not len(self.hashes):
            index = pc.index_in(words, value_set=self.words)
            return index.is_valid().to_numpy(zero_copy_only=False), pc.drop_null(index).to_numpy()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        has = self.hashes[at] == hashes
        place = at[has]
        same = pc.equal(words.filter(pa.array(has)), self.words.take(pa.array(place))).to_numpy(zero_copy_only=False)
        has[has] = same
        return has, place[same]

    def phones_of(self, row: np.ndarray, place: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
        """The joined phones of each of n rows' entries, one after the other, and how many there are."""
        some = self.counts[place] > 0
        words = self.joined.take(pa.array(place[some]))
        return pc.binary_join(lists(np.bincount(row[some], minlength=n), words), _BETWEEN), np.bincount(row, self.counts[place], n)


def flat(words: pa.Array, hashes: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Joined words and the lists of their hashes -> how many there are in each, and all of them."""
    sizes = np.diff(hashes.offsets.to_numpy())
    return sizes, pc.split_pattern(words.filter(pa.array(sizes > 0)), " ").flatten(), hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def sent_words(words: Column) -> tuple[Column, Column]:
    """An array of words as the task's Python takes it: one string, which passes faster than a list, and their hashes."""
    return F.array_join(words, " "), F.transform(words, lambda w: F.xxhash64(w))


def lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)


def ints(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32))


def apart(joined: Column, n: Column, odd: bool) -> Column:
    """Joined phones as an array. odd: they came as hex digits, as there are nulls or separators among them."""
    each = F.split(joined, _BETWEEN, -1)
    if odd:
        each = F.transform(each, lambda p: F.when(p != "-", F.decode(F.unhex(p), "UTF-8")))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(each)


_BETWEEN = "\x00"
_LOOKED = "struct<phones:string,n_phones:int,known:int,n:int,open:array<int>,at:array<int>,sizes:array<int>>"


def _found(entries: Entries, head: DataFrame, tail_bits: np.ndarray, bits: int):
    """words, their hashes -> phones of the words in the head, the number of these, of known and of all words, and open: places of the words that may be in the tail. Where there are such, also the
    places of the words in the head and how many phones each has."""
    sent = head.sparkSession.sparkContext.broadcast((entries, tail_bits))

    @F.arrow_udf(_LOOKED)
    def look(words: pa.Array, hashes: pa.Array) -> pa.Array:
        entries, marks = sent.value
        sizes, all_words, all_hashes = flat(words, hashes)
        row, n = np.repeat(np.arange(len(words)), sizes), len(words)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        has, index = entries.find(all_words, all_hashes)
        place = _places(all_hashes, bits)
        may = ~has & ((marks[place >> 6] >> (place & 63)) & 1 == 1)
        n_known, n_open = np.bincount(row[has], minlength=n), np.bincount(row[may], minlength=n)
        told = (n_open > 0)[row[has]]
        listed = np.where(n_open > 0, n_known, 0)
        phones, n_phones = entries.phones_of(row[has], index, n)
        return pa.StructArray.from_arrays(
            [phones, ints(n_phones), ints(n_known), ints(sizes), lists(n_open, ints(at[may])), lists(listed, ints(at[has][told])), lists(listed, ints(entries.counts[index[told]]))],
            ["phones", "n_phones", "known", "n", "open", "at", "sizes"],
        )

    return look


def _parts(df: DataFrame, lexicon: DataFrame, words: Column, most: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """df with words and looked: the rows that are done, evaluated when asked for; those with open words, written once; and the lexicon's tail."""
    rows = df.withColumn("words", words)
    head, tail = split_by_frequency(lexicon, rows.select("words"), most)
    entries = Entries(head)
    look = _found(entries, head, bitmap(tail, bits), bits)
    rows = rows.withColumn("looked", look(*sent_words(F.col("words"))))
    rows = rows.withColumn("phones_", apart(F.col("looked.phones"), F.col("looked.n_phones"), entries.odd))
    return rows.filter(F.size("looked.open") == 0), stored(rows.filter(F.size("looked.open") > 0)), tail


def _open(waiting: DataFrame, id_: str) -> DataFrame:
    return waiting.select(F.col(id_).alias("of"), "words", F.explode("looked.open").alias("at")).select("of", "at", F.get("words", F.col("at")).alias("word"))


def rare_words(df: DataFrame, lexicon: DataFrame, words: Column, id_: str, most: int = HEAD_BYTES, bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """df with words and looked; the occurrences that are left, as id, at, word; and the lexicon's tail."""
    done, waiting, tail = _parts(df, lexicon, words, most, bits)
    return done.unionByName(waiting), _open(waiting, id_), tail


def looked_up(df: DataFrame, lexicon: DataFrame, words: Column, id_: str = "id", most: int = HEAD_BYTES, bits: int = BITS) -> DataFrame:
    """df with phones (of the known words, in order) and coverage (known words of all; 0 without words). lexicon: word, phones, a row a word; id_ tells rows apart."""
    done, waiting, tail = _parts(df, lexicon, words, most, bits)
    met = _open(waiting, id_).join(tail, "word").groupBy("of").agg(F.collect_list(F.struct(F.col("at").cast("int").alias("at"), "phones")).alias("more"))
    out = waiting.join(met, waiting[id_] == met["of"], "left")
    none = F.array().cast("array<struct<at:int,phones:array<string>>>")
    starts = F.transform("looked.sizes", lambda n, i: F.aggregate(F.slice("looked.sizes", F.lit(1), i), F.lit(1), lambda a, x: a + x))
    known = F.transform(F.arrays_zip(F.col("looked.at").alias("at"), starts.alias("start"), F.col("looked.sizes").alias("size")), lambda x: F.struct(x["at"].alias("at"), F.slice("phones_", x["start"], x["size"]).alias("phones")))
    out = out.withColumn("found", F.sort_array(F.concat(known, F.coalesce("more", none))))
    share = lambda known, n: (known / F.greatest(n, F.lit(1))).alias("coverage")
    return done.select(*df.columns, F.col("phones_").alias("phones"), share(F.col("looked.known"), F.col("looked.n"))).unionByName(
        out.select(*df.columns, F.flatten("found.phones").alias("phones"), share(F.size("found"), F.size("words")))
    )

"""Column functions on phoneme units: arrays of symbols, never characters of a string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A code point for each distinct unit of a pair of sequences; those of one byte, which compare fastest, come first.
_CODES = "".join(map(chr, [*range(33, 127), *range(0xE000, 0xF8FF)]))


def split_units(ipa: Column) -> Column:
    """Units of a space-joined transcription; '' gives one empty unit."""
    return F.split(ipa, " ")


def join_units(units: Column) -> Column:
    return F.array_join(units, " ")


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once a row, however often use refers to it (inside lambdas, above all)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def collapse(seq: Column) -> Column:
    """Drop elements equal to the one before."""
    return bound(seq, lambda s: F.filter(s, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(s, i - 1))))


def ctc_collapse(ids: Column, vocab: Column, blank: int = 0) -> Column:
    """Greedy CTC: repeats go, then blanks; a blank between equals keeps both. vocab is an array indexed by id."""
    return F.transform(F.filter(collapse(ids), lambda x: x != blank), lambda x: F.get(vocab, x))


def argmax_frames(logits: Column, keep: int) -> Column:
    """Index of the largest of the first ``keep`` scores of each frame, the first if several tie."""
    return F.transform(logits, lambda f: (F.array_position(F.slice(f, 1, keep), F.array_max(F.slice(f, 1, keep))) - 1).cast("int"))


def valid_frames(n_samples: Column, downsample: int = 320) -> Column:
    return F.greatest(F.lit(1), F.floor(n_samples / downsample)).cast("int")


def strip_punct(units: Column) -> Column:
    """Drop units that are one punctuation character."""
    return F.filter(units, lambda u: ~u.rlike(r"^\p{P}$"))


def tokenize(text: Column, symbols: list[str]) -> Column:
    """Greedy longest match against the symbols; other code points are dropped."""
    return F.regexp_extract_all(text, F.lit(alternation(symbols)), F.lit(0))


def alternation(symbols: list[str]) -> str:
    """A Java pattern of the symbols, longest first; single code points are one class, as a list of them would be tried one by one at every place."""
    quoted = [rf"\Q{s}\E" for s in sorted(symbols, key=lambda s: (-len(s), s)) if len(s) > 1]
    single = sorted({s for s in symbols if len(s) == 1})
    return "|".join([*quoted, *(["[" + "".join(rf"\x{{{ord(s):x}}}" for s in single) + "]"] if single else [])]) or "(?!)"


def switch_spans(text: Column, matrix: str, inner: str = "eng") -> Column:
    """array<struct<lang, text>>: [bracketed] spans are in the inner language, the rest in the matrix one; trimmed, empty ones dropped.

    One extraction gives bracketed and other stretches in order; an unmatched [ is plain text.
    """
    parts = F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]|(?:(?!\[[^\]]*\])[\s\S])++"), F.lit(0))
    inside = lambda p: F.startswith(p, F.lit("[")) & F.endswith(p, F.lit("]"))
    bare = lambda p: F.when(inside(p), F.substr(p, F.lit(2), F.length(p) - 2)).otherwise(p)
    spans = F.transform(parts, lambda p: F.struct(F.when(inside(p), inner).otherwise(matrix).alias("lang"), trimmed(bare(p)).alias("text")))
    return F.filter(spans, lambda x: x["text"] != "")


def trimmed(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]) if pairs else F.create_map().cast("map<string,string>")


def map_units(units: Column, symbols: Column) -> Column:
    """Unit -> its entry in a map column; null where there is none."""
    return F.transform(units, lambda u: F.element_at(symbols, u))


def encode_ids(units: Column, lang: Column | None, symbols: Column, bos: str = "^", pad: str = "_", eos: str = "$") -> Column:
    """BOS PAD (LANG PAD)? (unit PAD)* EOS as one flat id list; null if there are no units or one has no id. symbols: map<string, array<int>>."""
    of = lambda s: F.element_at(symbols, F.lit(s))
    nothing = F.array().cast("array<int>")
    token = F.element_at(symbols, F.concat(F.lit("«"), F.coalesce(lang, F.lit("")), F.lit("»"))) if lang is not None else F.lit(None).cast("array<int>")
    head = F.when(token.isNotNull(), F.concat(token, of(pad))).otherwise(nothing)
    body = F.flatten(F.transform(units, lambda u: F.concat(F.element_at(symbols, u), of(pad))))
    # whether there are ids is told from the set of units: a filter on it needs no encoding
    known = (F.size(units) > 0) & (F.size(F.array_except(units, F.map_keys(symbols))) == 0)
    return F.when(known, F.coalesce(F.concat(of(bos), of(pad), head, body, of(eos)), nothing))


def edit_distance(a: Column, b: Column) -> Column:
    """Edit distance of two unit arrays, inside Spark: each distinct unit of the pair becomes one code point for levenshtein. There are 1,048,576 of these beyond
    the short table; a pair with more distinct units is an error."""

    def coded(x: Column, known: Column) -> Column:
        return F.array_join(F.transform(x, lambda u: F.substr(F.lit(_CODES), F.array_position(known, u).cast("int"), F.lit(1))), "")

    def wide(x: Column, known: Column) -> Column:
        """Supplementary code points, written as UTF-32."""
        code = lambda u: F.lit(0xFFFF) + F.array_position(known, u)
        return F.decode(F.unhex(F.array_join(F.transform(x, lambda u: F.lpad(F.hex(code(u)), 8, "0")), "")), "UTF-32")

    def distance(known: Column) -> Column:
        few = F.size(known) <= len(_CODES)
        too_many = F.raise_error(F.lit("over 1,048,576 distinct units in a pair")).cast("int")
        return F.when(few, F.levenshtein(coded(a, known), coded(b, known))).when(F.size(known) <= 1 << 20, F.levenshtein(wide(a, known), wide(b, known))).otherwise(too_many)

    return bound(F.array_distinct(F.concat(a, b)), distance).cast("long")


def l2_normalize(vec: Column) -> Column:
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))) + 1e-9
    return bound(norm, lambda n: F.transform(vec, lambda x: x.cast("double") / n))

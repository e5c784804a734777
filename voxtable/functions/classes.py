"""Coarse phone classes for accent-blind scoring, and symbol unification across inventories."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .units import collapse, literal_map

# fixed values: lexicon phone -> class, vowels are all V
PHONE_CLASS = {
    "P": "p", "B": "b", "T": "t", "D": "d", "K": "k", "G": "g",
    "F": "f", "V": "v", "S": "s", "Z": "z", "SH": "S", "ZH": "S",
    "TH": "t", "DH": "d", "HH": "h", "CH": "C", "JH": "J",
    "M": "m", "N": "n", "NG": "N", "L": "l", "R": "r", "W": "w", "Y": "j", "ER": "V",
    "AA": "V", "AE": "V", "AH": "V", "AO": "V", "AW": "V", "AY": "V", "EH": "V", "EY": "V",
    "IH": "V", "IY": "V", "OW": "V", "OY": "V", "UH": "V", "UW": "V",
}

# fixed values: IPA unit -> class
IPA_CLASS = {
    "p": "p", "pʰ": "p", "b": "b", "t": "t", "tʰ": "t", "d": "d",
    "k": "k", "kʰ": "k", "ɡ": "g", "g": "g", "k͡p": "k", "ɡ͡b": "g", "g͡b": "g",
    "f": "f", "v": "v", "s": "s", "z": "z", "ʃ": "S", "ʒ": "S",
    "θ": "t", "ð": "d", "h": "h", "hʷ": "h", "ç": "h", "x": "h", "ɣ": "g",
    "t͡ʃ": "C", "tɕ": "C", "tʃ": "C", "d͡ʒ": "J", "dʒ": "J", "dz": "J", "dʑ": "J",
    "ts": "s", "tsʰ": "s",
    "m": "m", "n": "n", "ɲ": "n", "ŋ": "N", "ŋ͡m": "N", "m̩": "m", "n̩": "n",
    "l": "l", "r": "r", "ɾ": "r", "ɽ": "r", "ʁ": "r", "ɹ": "r",
    "w": "w", "j": "j", "ɥ": "j",
    "a": "V", "e": "V", "i": "V", "o": "V", "u": "V", "ɛ": "V", "ɔ": "V", "ə": "V", "ɪ": "V",
    "ʊ": "V", "æ": "V", "ʌ": "V", "ɑ": "V", "ɨ": "V", "ʉ": "V",
    "aː": "V", "eː": "V", "iː": "V", "oː": "V", "uː": "V", "ɛː": "V", "ɔː": "V", "ɪː": "V", "ʊː": "V",
    "oɔ": "V", "eɛ": "V", "ie": "V", "uo": "V", "ia": "V", "ua": "V", "ai": "V", "au": "V",
    "ei": "V", "ou": "V", "ɛɔ": "V",
}

# fixed values: symbols that mean the same sound in different inventories, and marks without weight
UNIFY = {
    "ɒ": "ɑ", "əʊ": "oʊ", "ɝ": "ɚ", "ɾ": "t", "ʔ": "", "x": "k", "β": "b",
    "ɣ": "ɡ", "ɦ": "h", "ʉ": "u", "ɨ": "ɪ", "ᵻ": "ɪ", "ɐ": "ʌ", "g": "ɡ",
    "r": "ɹ", "ɜ": "ɚ",
}
DROP = "ˈˌːˑ'|- "
COMBINING = "̩̥̯̃̍"
_REMOVED = ("ʰ", "͡")


def _phone_classes(phones: pa.Array) -> pa.Array:
    named = phones.flatten().dictionary_encode()
    table = np.array([-1 if p is None or (c := PHONE_CLASS.get(p.rstrip("012"))) is None else ord(c) for p in named.dictionary.to_pylist()] + [-1], np.int32)  # classes are single letters
    code = table[named.indices.fill_null(len(table) - 1).to_numpy()]
    row = np.repeat(np.arange(len(phones)), np.diff(phones.offsets.to_numpy()))[code >= 0]
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(phones)))].astype(np.int32)
    code = code[code >= 0].astype(np.uint8)
    letters = pa.StringArray.from_buffers(len(code), pa.py_buffer(np.arange(len(code) + 1, dtype=np.int32)), pa.py_buffer(code.tobytes()))
    return pa.ListArray.from_arrays(pa.array(ends), letters)


def phone_classes(phones: Column) -> Column:
    """Lexicon phones -> classes; stress digits are stripped, unknown phones dropped."""
    return F.when(phones.isNotNull(), F.arrow_udf(_phone_classes, "array<string>")(F.coalesce(phones, F.array().cast("array<string>"))))


def ipa_classes(units: Column) -> Column:
    """IPA units -> classes; unknown units dropped."""
    table = literal_map(IPA_CLASS)
    return F.filter(F.transform(units, lambda u: F.element_at(table, u)), lambda c: c.isNotNull())


def _collapsed(ipa: pa.Array) -> pa.Array:
    units = pc.split_pattern(pc.fill_null(ipa.cast(pa.string()), ""), " ")
    named = units.flatten().dictionary_encode()
    table = np.array([ord(IPA_CLASS.get(u, "\0")) for u in named.dictionary.to_pylist()], np.uint8)  # classes are single letters
    row, code = np.repeat(np.arange(len(units)), np.diff(units.offsets.to_numpy())), table[named.indices.to_numpy()] if len(table) else np.array([], np.uint8)
    return _without_runs(row[code > 0], code[code > 0], len(units))


def _without_runs(row: np.ndarray, code: np.ndarray, n: int) -> pa.Array:
    """Single-byte letters of n rows as strings, of equal neighbours the first."""
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    ends = np.r_[0, np.cumsum(np.bincount(row[first], minlength=n))].astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(code[first].tobytes()))


def _collapsed_letters(letters: pa.Array) -> pa.Array:
    data = pc.fill_null(letters.cast(pa.string()), "")
    sizes = pc.binary_length(data).to_numpy(zero_copy_only=False)
    return _without_runs(np.repeat(np.arange(len(data)), sizes), np.frombuffer("".join(data.to_pylist()).encode("ascii"), np.uint8), len(data))


def collapsed_letters(classes: Column) -> Column:
    """Joined classes, each a single letter, with runs collapsed; '' for null. It is computed once a row, however often it is used, as a pattern in the plan would not be."""
    return F.arrow_udf(_collapsed_letters, "string")(classes)


def collapsed_ipa_classes(ipa: Column) -> Column:
    """The classes of a space-joined transcription, runs collapsed, as one string; '' for null."""
    return F.arrow_udf(_collapsed, "string")(ipa)


def normalized_unit(unit: str) -> str:
    """One unit of any inventory in the common one; may be empty."""
    bare = "".join(c for c in unicodedata.normalize("NFD", unit) if c not in COMBINING and c not in DROP)
    for mark in _REMOVED:
        bare = bare.replace(mark, "")
    return UNIFY.get(bare, bare)


def unit_lookup(df: DataFrame, *columns: str) -> dict[str, str]:
    """Distinct units of array columns -> normalised. A symbol inventory has a few hundred entries, so it may come to the driver; more than 100,000 is an error."""
    units = None
    for c in columns:
        one = df.select(F.explode(F.array_distinct(c)).alias("unit"))
        units = one if units is None else units.unionByName(one)
    found = [r[0] for r in units.filter("unit is not null").distinct().limit(100_001).collect()]
    if len(found) > 100_000:
        raise ValueError("over 100,000 distinct units: not a symbol inventory")
    return {u: normalized_unit(u) for u in sorted(found)}


def normalize_units(units: Column, lookup: dict[str, str]) -> Column:
    """Units through the lookup, empties dropped, runs collapsed."""
    table = literal_map(lookup)
    return collapse(F.filter(F.transform(units, lambda u: F.element_at(table, u)), lambda u: u != ""))

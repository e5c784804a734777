r"""Quality rules as a short-circuit cascade.

The verdict is a conjunction of rules, and each rule works on figures of a whole text. A figure is computed when a rule first asks for it, and only for
the texts that are still in the cascade: a text leaves at the first rule that rejects it. Each rule's cost and rejection rate are estimated on
a sample (random whole texts of every batch, so that the sample covers all data and never leaves its task), and rules are ordered by rejection per cost. The base
rule takes its place among the others. The order changes only the work done, never a verdict.

Words are ``[^\x20\x09-\x0D]+``. Windows of five words are compared exactly: words are numbered, and pairs, quadruples and
quintuples of numbers are numbered in turn.

Defined cases: null and wordless texts have zero figures and fail the base rule; repeated rows are judged each; an empty table
gives an empty result; very long texts take memory in proportion to their batch; extra columns are not read, and a kept column may have any name.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: One text in so many is in the sample on which cost and selectivity are estimated, SAMPLE_LEAST of a batch at least.
SAMPLE_EVERY, SAMPLE_LEAST = 64, 16


class Texts:
    """A batch of texts (UTF-8). A figure of a text is computed once, when it is asked for."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self._words: list[list[bytes] | None] = [None] * len(texts)
        self._known: dict[str, dict[int, int]] = {}

    def words(self, i: int) -> list[bytes]:
        if self._words[i] is None:
            self._words[i] = self.texts[i].split()  # bytes split at exactly the six spaces of the contract
        return self._words[i]

    def figure(self, name: str, at: list[int]) -> np.ndarray:
        """The figure of the texts at the given places."""
        known = self._known.setdefault(name, {})
        missing = [i for i in at if i not in known]
        if missing:
            known.update(zip(missing, FIGURES[name](self, missing), strict=True))
        return np.array([known[i] for i in at], np.int64)


@dataclass(frozen=True)
class Rule:
    """rejects: of the texts at the given places, which are rejected."""

    name: str
    rejects: Callable[[Texts, list[int]], np.ndarray]


def _base(t: Texts, at: list[int]) -> np.ndarray:
    """Too few words, or too many inside repeated windows; windows are looked at only where there are words enough."""
    out = t.figure("n_words", at) < MIN_WORDS
    rest = [i for i, bad in zip(at, out, strict=True) if not bad]
    out[~out] = 100 * t.figure("n_repeat_words", rest) > REPEAT_PERCENT * t.figure("n_words", rest)
    return out


def _dup_lines(t: Texts, at: list[int]) -> np.ndarray:
    """Over half of the lines are copies of earlier ones."""
    copies = t.figure("n_dup_lines", at)
    return (copies > 3) & (2 * copies > t.figure("n_lines", at))


def _symbols(t: Texts, at: list[int]) -> np.ndarray:
    return t.figure("n_symbols", at) * 10 > t.figure("n_words", at)


def _word_length(t: Texts, at: list[int]) -> np.ndarray:
    n, chars = t.figure("n_words", at), t.figure("word_chars", at)
    return (2 * n > chars) | (chars > 15 * n)


def _no_letters(t: Texts, at: list[int]) -> np.ndarray:
    """Under half of the words have a letter or a non-ASCII character."""
    return 2 * t.figure("n_lettered", at) < t.figure("n_words", at)


def _stutter(t: Texts, at: list[int]) -> np.ndarray:
    """Over a quarter of the words repeat the word before them."""
    return 4 * t.figure("n_stuttered", at) > t.figure("n_words", at)


BASE = Rule("base", _base)
RULES = (Rule("symbols", _symbols), Rule("word_length", _word_length), Rule("dup_lines", _dup_lines), Rule("no_letters", _no_letters), Rule("stutter", _stutter))
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]").search
_MARKS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_PART = 4 << 20


def repeat_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Words of each text inside windows that its text holds twice or more. ids number the words, doc their texts (ascending)."""
    n = len(ids)
    if n < window:
        return np.zeros(n_docs, np.int64)

    def paired(left: np.ndarray, gap: int, right: np.ndarray) -> np.ndarray:
        key = left[: len(right) - gap].astype(np.int64) * (int(right.max()) + 1) + right[gap:]
        return np.unique(key, return_inverse=True)[1]

    two = paired(ids, 1, ids)
    four = paired(two, 2, two)
    five = paired(four, 4, ids)  # numbers of word i..i+4
    inside = doc[: len(five)] == doc[window - 1 :]
    at = np.flatnonzero(inside)
    key = doc[at].astype(np.int64) * (int(five.max()) + 1) + five[at]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    often = at[count[back] > 1]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + window, -1)
    return np.bincount(doc, np.cumsum(edge[:-1]) > 0, n_docs).astype(np.int64)


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def _repeated(t: Texts, at: list[int]) -> list[int]:
    words = [t.words(i) for i in at]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, sum(map(len, words)))
    doc = np.repeat(np.arange(len(at)), [len(ws) for ws in words])
    return repeat_words(ids, doc, len(at)).tolist()


def _each(count: Callable[[Texts, int], int]) -> Callable[[Texts, list[int]], list[int]]:
    return lambda t, at: [count(t, i) for i in at]


def _removed(text: bytes, marks: bytes) -> int:
    return len(text) - len(text.translate(None, marks))


FIGURES: dict[str, Callable[[Texts, list[int]], list[int]]] = {
    "n_words": _each(lambda t, i: len(t.words(i))),
    "word_chars": _each(lambda t, i: len(t.texts[i].translate(None, _SPACES).decode("utf-8"))),
    "n_symbols": _each(lambda t, i: _removed(t.texts[i], _MARKS)),
    "n_dup_lines": _each(lambda t, i: dup_lines(t.texts[i])),
    "n_lines": _each(lambda t, i: t.texts[i].count(b"\n") + 1),
    "n_repeat_words": _repeated,
    "n_lettered": _each(lambda t, i: sum(_LETTER(w) is not None for w in t.words(i))),
    "n_stuttered": _each(lambda t, i: sum(map(bytes.__eq__, t.words(i), t.words(i)[1:]))),
}
_TOLD = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def parts(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about _PART bytes, with where they start."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _PART:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, texts[start:]


class Cascade:
    """The rules in an order that is estimated anew with every batch: rejection per cost, on all that was sampled so far."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = list(rules)
        self.seconds, self.rejected, self.sampled = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        self.random = random.Random(len(rules))

    def estimate(self, texts: Texts, sample: list[int]) -> None:
        """Each rule on its own on the sampled texts, then the new order. Figures that texts has already cost nothing."""
        for rule in self.rules:
            fresh = Texts([texts.texts[i] for i in sample])
            fresh._known = {name: {k: known[i] for k, i in enumerate(sample) if i in known} for name, known in texts._known.items()}
            began = time.perf_counter()
            self.rejected[rule] += int(rule.rejects(fresh, list(range(len(sample)))).sum())
            self.seconds[rule] += time.perf_counter() - began
        self.sampled += len(sample)
        self.rules.sort(key=lambda r: self.rejected[r] / (self.seconds[r] + 1e-9), reverse=True)

    def judge(self, texts: Texts, alive: list[int]) -> list[str | None]:
        """For every text the rule that it left at, null if none rejects it. Only the texts in alive are judged."""
        n = len(alive)
        if n:
            self.estimate(texts, sorted(self.random.sample(alive, min(n, max(SAMPLE_LEAST, n // SAMPLE_EVERY)))))
        by: list[str | None] = [None] * len(texts.texts)
        for rule in self.rules:
            if not alive:
                break
            bad = rule.rejects(texts, alive)
            for i, x in zip(alive, bad, strict=True):
                if x:
                    by[i] = rule.name
            alive = [i for i in alive if by[i] is None]
        return by


def judged(docs: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """keep columns, the figures (of every text), base_failed, kept and rejected_by (the rule a text left at; "base" or null)."""
    columns = docs.select(F.col("text").alias("judged_text"), *keep)
    told = [*(T.StructField(f, T.LongType()) for f in _TOLD), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(rules)
        for b in batches:
            for start, raw in parts(utf8(b.column(0))):
                texts, every = Texts(raw), list(range(len(raw)))
                figures = [pa.array(texts.figure(f, every), pa.int64()) for f in _TOLD]
                failed = _base(texts, every).tolist()
                by = cascade.judge(texts, [i for i in every if not failed[i]])
                by = [BASE.name if bad else x for x, bad in zip(by, failed, strict=True)]
                yield pa.RecordBatch.from_arrays([*(b.column(1 + i).slice(start, len(raw)) for i in range(len(keep))), *figures, pa.array(failed, pa.bool_()), pa.array([x is None for x in by], pa.bool_()), pa.array(by, pa.string())], [*keep, *(f.name for f in told)])

    return columns.mapInArrow(run, T.StructType([*columns.schema.fields[1:], *told]))


def good_documents(docs: DataFrame, rules: tuple[Rule, ...] = (BASE, *RULES)) -> DataFrame:
    """The rows of docs that the cascade keeps, whole and with their columns."""
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(rules)
        for b in batches:
            keep: list[bool] = []
            for _, raw in parts(utf8(b.column(where))):
                keep += [x is None for x in cascade.judge(Texts(raw), list(range(len(raw))))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

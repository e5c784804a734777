"""Where models enter: functions over a pandas batch, run where Spark puts the rows.

A plug is a factory: it is called once in each task (load the model there) and returns the function for its batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.audio import acoustic_metrics, cap_wave, normalize_wave, resample, resampled_length
from voxtable.functions.units import ctc_collapse
from voxtable.operators.batching import batch_numbers
from voxtable.operators.symbols import SymbolMap, collected, encoded, extend_symbol_map, fresh_symbols
from voxtable.sources.wavs import decoded

Waves = list[np.ndarray]


#: Frames of a wave of so many samples: one for so many of them.
DOWNSAMPLE = 320


def recognize(waves: DataFrame, plug: Callable[[], Callable[[Waves, int], list[list[int]]]], vocab: list[str], budget: int = 16_000_000, max_rows: int = 64, held: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, samples, rate -> id, units (and the thin columns in keep). Waves stay in the tasks that have them: a task takes waves of about ``held`` budgets at a time, forms batches of one rate by length (see
    batching.batch_numbers) and hands each to the plug, which gives CTC ids of each wave. A row without samples has no units."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, waiting, size = plug(), [], 0

        def told() -> Iterator[pd.DataFrame]:
            for rate in sorted({w[2] for w in waiting}):
                own = sorted(((len(x), i, x, kept) for i, x, r, kept in waiting if r == rate), key=lambda x: x[:2])
                number = batch_numbers(np.array([n for n, *_ in own], np.int64), budget, max_rows)
                for k in range(int(number[-1]) + 1):
                    batch = [own[j] for j in np.flatnonzero(number == k)]
                    ids = model([w[2] for w in batch], rate)
                    yield pd.DataFrame({"id": [w[1] for w in batch], "ids": [list(map(int, x)) for x in ids], **{c: [w[3][j] for w in batch] for j, c in enumerate(keep)}})

        for pdf in parts:
            for i, x, r, *kept in zip(pdf["id"], pdf["samples"], pdf["rate"], *(pdf[c] for c in keep), strict=True):
                if x is None:
                    yield pd.DataFrame({"id": [i], "ids": [None], **{c: [v] for c, v in zip(keep, kept, strict=True)}})
                    continue
                waiting.append((i, np.asarray(x, np.float32), int(r), kept))
                size += len(x)
                if size >= held * budget:
                    yield from told()
                    waiting, size = [], 0
        yield from told()

    thin = "".join(f", `{c}` {waves.schema[c].dataType.simpleString()}" for c in keep)
    out = waves.select("id", "samples", "rate", *keep).mapInPandas(run, f"id string, ids array<int>{thin}")
    return out.select("id", *keep, F.when(F.col("ids").isNotNull(), ctc_collapse(F.col("ids"), F.array(*map(F.lit, vocab)))).alias("units"))


def padded(waves: Waves) -> tuple[np.ndarray, np.ndarray]:
    """Waves as rows of one matrix, zeros after each, and their lengths."""
    sizes = np.array([len(x) for x in waves])
    block = np.zeros((len(waves), max(1, sizes.max(initial=0))), np.float32)
    for row, x in zip(block, waves, strict=True):
        row[: len(x)] = x
    return block, sizes


def transcribe(
    shards: DataFrame, plug: Callable[[], Callable[[np.ndarray, np.ndarray, int], list[list[int]]]], vocab: list[str], target: int = 16_000, max_seconds: float | None = None, audio: str = "bytes",
    budget: int = 16_000_000, max_rows: int = 64,
) -> DataFrame:
    """id, wav bytes -> id, duration, units, n_units, ipa, failed: the whole way from bytes to units.

    Each wave is decoded, mixed to one channel, brought to the target rate, cut at max_seconds and normalised over its own samples; batches by length are padded with zeros. The plug
    gets a matrix of waves, their lengths and the rate, and gives frame ids; frames beyond a wave's own are dropped, repeats and blanks collapse. Audio is decoded where it is read and never shuffled.
    Bytes that can't be decoded give nulls and the error's name in failed.
    """

    def front(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            waves, seconds, errors = [], [], []
            for data in pdf[audio]:
                x, rate, error = decoded(data)
                errors.append(error)
                seconds.append(None if error else len(x) / rate)
                if error:
                    waves.append(None)
                    continue
                y = resample(x, rate, target)[: resampled_length(len(x), rate, target, len(x) * target // rate + 1)]
                y = cap_wave(y, target, max_seconds) if max_seconds else y
                waves.append(normalize_wave(y))
            yield pd.DataFrame({"id": pdf["id"], "samples": waves, "rate": np.full(len(pdf), target, np.int32), "duration": pd.array(seconds, "Float32"), "failed": errors})

    def framed() -> Callable[[Waves, int], list[list[int]]]:
        model = plug()

        def run(waves: Waves, rate: int) -> list[list[int]]:
            block, sizes = padded(waves)
            return [list(ids)[: max(1, n // DOWNSAMPLE)] for ids, n in zip(model(block, sizes, rate), sizes.tolist(), strict=True)]

        return run

    waves = shards.select("id", audio).mapInPandas(front, "id string, samples array<float>, rate int, duration float, failed string")
    out = recognize(waves, framed, vocab, budget, max_rows, keep=("duration", "failed"))
    units = F.col("units")
    return out.select("id", "duration", "units", F.when(units.isNotNull(), F.size(units)).alias("n_units"), F.array_join("units", " ").alias("ipa"), "failed")


class LengthClasses:
    """Waves waiting for a batch of so many rows of one rate and about one length: classes are a factor of ``step`` wide, and a class goes out when it has a batch.

    What waits is bounded: batch - 1 waves a class, so some batch * longest / (1 - 1 / step) samples a rate.
    """

    def __init__(self, batch: int, step: float = 1.125):
        self.batch, self.step, self.held = batch, math.log(step), {}

    def put(self, rate: int, size: int, row: tuple) -> list[tuple] | None:
        """Takes a row; the batch that is complete with it, if one is."""
        key = (rate, int(math.log(max(1, size)) / self.step))
        rows = self.held.setdefault(key, [])
        rows.append(row)
        return self.held.pop(key) if len(rows) >= self.batch else None

    def rest(self) -> Iterator[tuple[int, list[tuple]]]:
        """What still waits, by rate and length, in batches."""
        for rate in sorted({r for r, _ in self.held}):
            rows = [x for key in sorted(k for k in self.held if k[0] == rate) for x in self.held[key]]
            yield from ((rate, rows[at : at + self.batch]) for at in range(0, len(rows), self.batch))
        self.held = {}


def _unit(vectors: np.ndarray, n: int) -> np.ndarray:
    vectors = np.asarray(vectors, np.float64).reshape(n, -1)
    return (vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9)).astype(np.float32)


def embed(df: DataFrame, plug: Callable[[], Callable[[Waves, int], np.ndarray]], cap_seconds: float = 8.0, batch: int = 32) -> DataFrame:
    """id, samples, rate -> id, embedding (unit length). Waves are cut at cap_seconds; each call gets at most ``batch`` waves of one rate and about one length."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, waiting = plug(), LengthClasses(batch)

        def told(rate: int, rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame({"id": [i for i, _ in rows], "embedding": list(_unit(model([x for _, x in rows], rate), len(rows)))})

        for pdf in parts:
            for i, x, r in zip(pdf["id"], pdf["samples"], pdf["rate"], strict=True):
                x = cap_wave(np.asarray(x, np.float32), int(r), cap_seconds)
                if rows := waiting.put(int(r), len(x), (i, x)):
                    yield told(int(r), rows)
        for rate, rows in waiting.rest():
            yield told(rate, rows)

    return df.select("id", "samples", "rate").mapInPandas(run, "id string, embedding array<float>")


def embed_audio(
    shards: DataFrame, plug: Callable[[], Callable[[np.ndarray, np.ndarray, int], np.ndarray]], cap_seconds: float = 8.0, target: int = 16_000, batch: int = 32, audio: str = "bytes",
) -> DataFrame:
    """id, wav bytes -> id, embedding (unit length), snr_est, clip_frac, silence_frac, failed: the whole way from bytes to vectors, one decoding for both.

    A wave is decoded and mixed to one channel; its recording metrics are taken over its whole length at its own rate. It is then cut at cap_seconds, brought to the target rate and waits in the task
    that read it, in a class of its own rate and about its length, until the class has a batch. The plug gets a matrix of at most ``batch`` waves, zeros after each, their lengths relative to the longest
    and the source's rate. Bytes that can't be decoded give nulls and the error's name in failed.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, waiting = plug(), LengthClasses(batch)
        names = ("snr_est", "clip_frac", "silence_frac")

        def told(rate: int, rows: list[tuple]) -> pd.DataFrame:
            block, sizes = padded([x for _, x, _ in rows])
            vectors = _unit(model(block, sizes / block.shape[1], rate), len(rows))
            figures = np.array([m for _, _, m in rows], np.float32)
            return pd.DataFrame({"id": [i for i, _, _ in rows], "embedding": list(vectors), **{c: figures[:, k] for k, c in enumerate(names)}, "failed": None})

        for pdf in parts:
            for i, data in zip(pdf["id"], pdf[audio], strict=True):
                x, rate, error = decoded(data)
                if error:
                    yield pd.DataFrame({"id": [i], "embedding": [None], **{c: pd.array([None], "Float32") for c in names}, "failed": [error]})
                    continue
                figures, x = acoustic_metrics(x, rate), cap_wave(x, rate, cap_seconds)
                y = resample(x, rate, target)[: resampled_length(len(x), rate, target, len(x) * target // rate + 1)]
                if rows := waiting.put(rate, len(y), (i, y, figures)):
                    yield told(rate, rows)
        for rate, rows in waiting.rest():
            yield told(rate, rows)

    return shards.select("id", audio).mapInPandas(run, "id string, embedding array<float>, snr_est float, clip_frac float, silence_frac float, failed string")


def phonemise(df: DataFrame, plugs: dict[str, Callable[[], Callable[[str], list[str]]]], text: str = "text", language: str = "language") -> DataFrame:
    """df with units and failed: each text by the plug of its language; a failing or missing plug gives no units and says so (failed: the error's name, null if there is none)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = {k: p() for k, p in plugs.items()}

        def units(lang, value) -> tuple[list[str], str | None]:
            if lang not in made:
                return [], "no plug"
            try:
                return list(made[lang](value or "")), None
            except Exception as e:  # noqa: BLE001  an engine may fail on one text in any way; that text has no units then
                return [], type(e).__name__

        for pdf in parts:
            got = [units(a, b) for a, b in zip(pdf[language], pdf[text], strict=True)]
            yield pdf.assign(units=[x for x, _ in got], failed=[e for _, e in got])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "units array<string>, failed string"])
    return df.mapInPandas(run, schema)


def tokenizing(symbols: list[str], spell: Callable[[str], str]) -> Callable[[], Callable[[str], list[str]]]:
    """A plug from an engine that writes one IPA string: longest matches of the symbols in it."""
    import re

    def plug() -> Callable[[str], list[str]]:
        find = re.compile("|".join(map(re.escape, sorted((s for s in symbols if s and s != " "), key=len, reverse=True)))).findall
        return lambda text: find(spell(text))

    return plug


def rederive_targets(manifest: DataFrame, plugs: dict, symbols: SymbolMap) -> tuple[DataFrame, SymbolMap, list[str]]:
    """A bilingual manifest with units by each language's plug and their ids under the extended map; the map; the fresh symbols."""
    from voxtable.sources.corpus import settled

    rows = settled(phonemise(manifest, plugs))
    fresh = collected(fresh_symbols(rows, symbols))
    extended = extend_symbol_map(symbols, fresh)
    return encoded(rows, extended), extended, fresh



"""Wav files: listing by id, decoding, exporting."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtable.functions.audio import acoustic_metrics, decode_wav, encode_wav, interpolated, resample
from voxtable.functions.clips import stem
from voxtable.sources.corpus import settled

def list_wavs(spark: SparkSession, path: str) -> DataFrame:
    """id (file stem), path, length of every wav below a folder, without reading content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path)
    return files.select(stem(F.col("path")).alias("id"), "path", "length")


def read_wavs(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path)
    return files.select(stem(F.col("path")).alias("id"), F.col("content").alias("bytes"))


def decode(df: DataFrame, column: str = "bytes", target: int | None = None) -> DataFrame:
    """samples (array<float>), rate, duration and failed in place of wav bytes; bytes that can't be decoded give nulls and the error's name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [decoded(x) for x in pdf.pop(column)]
            waves = [(None, None, error) if error else (resample(w, r, target) if target else w, target or r, None) for w, r, error in found]
            seconds = pd.array([None if e else len(w) / r for w, r, e in waves], "Float32")
            yield pdf.assign(samples=[w for w, _, _ in waves], rate=pd.array([r for _, r, _ in waves], "Int32"), duration=seconds, failed=[e for _, _, e in waves])

    kept = [c for c in df.columns if c != column]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), "samples array<float>, rate int, duration float, failed string"])
    return df.mapInPandas(run, schema)


def decoded(data: bytes | None) -> tuple[np.ndarray | None, int | None, str | None]:
    """Samples and rate, or the name of what went wrong."""
    if data is None:
        return None, None, "missing"
    try:
        return *decode_wav(data), None
    except Exception as e:  # noqa: BLE001  bytes may be broken in any way; that clip has no wave then
        return None, None, type(e).__name__


def resampled(df: DataFrame, target: int, kind: str = "float") -> DataFrame:
    """id, samples, rate -> the same at the target rate. kind: float, or double for samples that aren't rounded to single precision, as sums over them need."""
    made = interpolated if kind == "double" else resample

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            waves = [made(np.asarray(x, np.float32), int(r), target) for x, r in zip(pdf["samples"], pdf["rate"], strict=True)]
            yield pd.DataFrame({"id": pdf["id"], "samples": waves, "rate": np.full(len(pdf), target, np.int32)})

    return df.select("id", "samples", "rate").mapInPandas(run, f"id string, samples array<{kind}>, rate int")


def as_wav(df: DataFrame, target: int) -> DataFrame:
    """id, samples, rate -> id, wav (mono PCM_16 bytes at the target rate), duration (3 digits)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [resample(np.asarray(x, np.float32), int(r), target) for x, r in zip(pdf["samples"], pdf["rate"], strict=True)]
            yield pd.DataFrame({"id": pdf["id"], "wav": [encode_wav(x, target) for x in out], "duration": [round(len(x) / target, 3) for x in out]})

    return df.select("id", "samples", "rate").mapInPandas(run, "id string, wav binary, duration double")


def export_wavs(df: DataFrame, folder: str, target: int) -> DataFrame:
    """Writes <folder>/<id>.wav and returns id, path, duration. folder: a path or URI of any file system that pyarrow knows.

    Two phases, so that neither a repeated nor a speculative task shows: each attempt writes files of its own names below a staging folder and tells them; what Spark takes as the tasks' result is
    the manifest of winners, settled before a file is moved to its name. Moving again what is moved already does nothing. Of several rows of one id the one with the least bytes' digest is exported.
    """
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = pafs.FileSystem.from_uri(staging)
        system.create_dir(at, recursive=True)
        for pdf in batches:
            parts = [f"{uuid.uuid4().hex}.wav" for _ in range(len(pdf))]
            for part, data in zip(parts, pdf["wav"], strict=True):
                with system.open_output_stream(f"{at}/{part}") as f:
                    f.write(data)
            yield pd.DataFrame({"id": pdf["id"], "part": parts, "duration": pdf["duration"], "digest": [hashlib.md5(x).hexdigest() for x in pdf["wav"]]})

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = pafs.FileSystem.from_uri(staging)
        for pdf in batches:
            for i, part in zip(pdf["id"], pdf["part"], strict=True):
                moved_into_place(system, f"{at}/{part}", f"{at.rpartition('/')[0]}/{i}.wav")
            yield pd.DataFrame({"id": pdf["id"], "path": [f"{folder.rstrip('/')}/{i}.wav" for i in pdf["id"]], "duration": pdf["duration"]})

    manifest = settled(as_wav(df, target).mapInPandas(write, "id string, part string, duration double, digest string"))
    winners = settled(manifest.groupBy("id").agg(F.min_by(F.struct("part", "duration"), F.struct("digest", "part")).alias("won")).select("id", "won.*"))
    out = settled(winners.mapInPandas(move, "id string, path string, duration double"))
    system, at = pafs.FileSystem.from_uri(staging)
    if system.get_file_info(at).type == pafs.FileType.Directory:
        system.delete_dir(at)
    return out


def moved_into_place(system: pafs.FileSystem, part: str, path: str) -> None:
    """Moves a staged file to its name; what another attempt moved stays."""
    if system.get_file_info(part).type == pafs.FileType.File:
        try:
            system.move(part, path)
        except OSError:
            if system.get_file_info(part).type == pafs.FileType.File or system.get_file_info(path).type != pafs.FileType.File:
                raise
    elif system.get_file_info(path).type != pafs.FileType.File:
        raise FileNotFoundError(f"neither {part} nor {path}")


def metrics(df: DataFrame) -> DataFrame:
    """id, samples, rate -> id, snr_est, clip_frac, silence_frac (doubles: rounded figures would differ if they were rounded to single precision before); samples don't leave the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = np.array([acoustic_metrics(np.asarray(x, np.float32), int(r)) for x, r in zip(pdf["samples"], pdf["rate"], strict=True)], np.float64).reshape(-1, 3)
            yield pd.DataFrame({"id": pdf["id"], "snr_est": found[:, 0], "clip_frac": found[:, 1], "silence_frac": found[:, 2]})

    return df.select("id", "samples", "rate").mapInPandas(run, "id string, snr_est double, clip_frac double, silence_frac double")


def metrics_sql(df: DataFrame) -> DataFrame:
    """The same figures in built-in functions: frames are slices, percentiles are exact."""
    size = F.greatest(F.floor(F.col("rate") * 0.02), F.lit(1)).cast("int")
    energies = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.aggregate(F.slice("samples", k * F.col("size") + 1, F.col("size")), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.col("size") + 1e-12)
    rows = df.select("id", "samples", size.alias("size")).withColumn("n", F.floor(F.size("samples") / F.col("size")).cast("int"))
    rows = rows.withColumn("energy", F.array_sort(F.when(F.col("n") > 0, energies).otherwise(F.array().cast("array<double>"))))

    def percentile(p: float):
        at = (F.col("n") - 1) * p
        low = F.get("energy", F.floor(at).cast("int"))
        return low + (F.get("energy", F.ceil(at).cast("int")) - low) * (at - F.floor(at))

    rows = rows.withColumn("low", percentile(0.1)).withColumn("high", percentile(0.9))
    share = lambda c, hit: F.size(F.filter(c, hit)) / F.greatest(F.size(c), F.lit(1))
    some = F.col("n") > 0
    return rows.select(
        "id",
        F.when(some, 10 * F.log10(F.col("high") / F.col("low"))).otherwise(0.0).alias("snr_est"),
        F.when(some, share(F.col("samples"), lambda x: F.abs(x.cast("double")) > 0.99)).otherwise(0.0).alias("clip_frac"),
        F.when(some, share(F.col("energy"), lambda e: e < 2 * F.col("low"))).otherwise(1.0).alias("silence_frac"),
    )

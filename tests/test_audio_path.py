"""The audio path: broken bytes, batches by length class, exports under repeated attempts."""

import os
import threading

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from voxtable.functions import audio
from voxtable.operators import plugs
from voxtable.sources import wavs


def wave_of(n, rate=16000, seed=0):
    return audio.encode_wav(np.random.default_rng(seed).normal(scale=0.2, size=n).astype(np.float32), rate)


def test_broken_bytes_fail_alone(spark):
    frame = spark.createDataFrame([("good", bytearray(wave_of(3200)), 1), ("bad", bytearray(b"RIFFxxxx"), 2), ("none", None, 3), ("empty", bytearray(wave_of(0)), 4)], "id string, bytes binary, n int").repartition(1)
    out = {r["id"]: r for r in wavs.decode(frame, target=8000).collect()}
    assert len(out["good"]["samples"]) == 1600 and out["good"]["rate"] == 8000 and out["good"]["failed"] is None and out["good"]["n"] == 1
    assert out["bad"]["samples"] is None and out["bad"]["failed"] and out["bad"]["duration"] is None
    assert out["none"]["failed"] == "missing" and out["empty"]["samples"] == []

    def plug():
        return lambda block, sizes, rate: np.ones((len(sizes), max(1, block.shape[1] // 320)), int)

    told = {r["id"]: r for r in plugs.transcribe(frame, plug, ["-", "a"]).collect()}
    assert told["good"]["units"] == ["a"] and told["good"]["failed"] is None and told["good"]["ipa"] == "a"
    assert told["bad"]["units"] is None and told["bad"]["n_units"] is None and told["bad"]["ipa"] is None and told["bad"]["failed"] == out["bad"]["failed"]
    assert told["none"]["failed"] == "missing" and len(told) == 4


def test_embedding_batches(spark):
    """Every batch has one rate, four rows at most and, if full, about one length; what a row gets doesn't depend on its batch."""
    rows = [(f"w{i}", bytearray(wave_of(800 + 37 * (i * 7 % 60), 16000 if i % 3 else 8000, i))) for i in range(60)] + [("bad", bytearray(b"nothing"))]
    frame = spark.createDataFrame(rows, "id string, bytes binary").repartition(2)

    def plug():
        def model(block, lengths, rate):
            n = np.rint(lengths * block.shape[1]).astype(int)
            assert rate in (8000, 16000) and len(block) <= 4 and n.max() == block.shape[1] and all(not row[k:].any() for row, k in zip(block, n))
            assert len(block) < 4 or n.min() > 100
            return np.array([[row[:k].mean(), row[:k].std(), k] for row, k in zip(block, n)])

        return model

    out = {r["id"]: r for r in plugs.embed_audio(frame, plug, cap_seconds=0.1, target=16000, batch=4).collect()}
    assert len(out) == 61 and out["bad"]["embedding"] is None and out["bad"]["failed"] and out["bad"]["snr_est"] is None
    for i, data in rows[:-1]:
        x, rate = audio.decode_wav(bytes(data))
        figures = audio.acoustic_metrics(x, rate)
        cut = x[: int(0.1 * rate)]
        y = audio.resample(cut, rate, 16000)[: audio.resampled_length(len(cut), rate, 16000, len(cut) * 16000 // rate + 1)]
        want = np.array([y.mean(), y.std(), len(y)])
        assert np.allclose(out[i]["embedding"], want / np.linalg.norm(want), atol=1e-5)
        assert np.allclose([out[i][c] for c in ("snr_est", "clip_frac", "silence_frac")], figures, rtol=1e-5)
    assert plugs.embed_audio(frame.limit(0), plug).count() == 0


def test_length_classes_bound_what_waits():
    r = np.random.default_rng(2)
    held, most, out = plugs.LengthClasses(8), 0, []
    for n in r.integers(1, 128_000, 5000).tolist():
        if rows := held.put(16000, n, (n,)):
            out.append([x[0] for x in rows])
        most = max(most, sum(x[0] for rows in held.held.values() for x in rows))
    assert all(len(b) == 8 and max(b) <= 1.13 * min(b) + 1 for b in out)
    assert most < 8 * 128_000 / (1 - 1 / 1.125)
    rest = [x[0] for _, rows in held.rest() for x in rows]
    assert len(rest) + 8 * len(out) == 5000 and rest == sorted(rest, key=lambda n: int(np.log(max(1, n)) / np.log(1.125)))


def test_metrics_figures():
    x = np.concatenate([np.zeros(320), np.full(320, 0.5), np.full(320, 1.0)]).astype(np.float32)
    snr, clipped, silent = audio.acoustic_metrics(x, 16000)
    power = [1e-12, 0.25 + 1e-12, 1 + 1e-12]
    low, high = power[0] + 0.2 * (power[1] - power[0]), power[1] + 0.8 * (power[2] - power[1])
    assert snr == pytest.approx(10 * np.log10(high / low)) and clipped == pytest.approx(1 / 3) and silent == pytest.approx(1 / 3)
    assert audio.acoustic_metrics(x[:100], 16000) == (0.0, 0.0, 1.0)


def test_metrics_are_not_rounded_to_single_precision(spark):
    """The float next to 0.99 is above it, and figures that a query rounds come as doubles."""
    near = [float(np.float32(0.99))] * 8 + [0.5] * 8
    waves = {"near": near, "some": np.random.default_rng(3).normal(scale=0.3, size=64).astype(np.float32).tolist()}
    frame = spark.createDataFrame([(k, x, 400) for k, x in waves.items()], "id string, samples array<float>, rate int")
    for rows in (wavs.metrics(frame), wavs.metrics_sql(frame)):
        got = {r["id"]: r for r in rows.collect()}
        assert got["near"]["clip_frac"] == 0.5
        assert got["some"]["snr_est"] == pytest.approx(audio.acoustic_metrics(np.array(waves["some"], np.float32), 400)[0], rel=1e-12)


def test_resampled_waves_as_doubles(spark):
    wave = np.random.default_rng(4).normal(scale=0.3, size=64).astype(np.float32)
    frame = spark.createDataFrame([("a", wave.tolist(), 400)], "id string, samples array<float>, rate int")
    t = [(np.arange(64) - 2 * k) / 2 * 0.99 for k in range(32)]
    want = [sum(np.where(abs(x) < 6, wave.astype(np.float64) * np.sinc(x) * np.cos(x * np.pi / 12) ** 2 * 0.495, 0)) for x in t]
    assert wavs.resampled(frame, 200, "double").first()["samples"] == pytest.approx(want, rel=1e-11, abs=1e-13)
    assert wavs.resampled(frame, 200).first()["samples"] == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_two_writers_of_one_id(spark, tmp_path):
    """Attempts never share a file, and a name once taken is whole: two exports at once, repeated rows, and a move that another attempt made."""
    folder = str(tmp_path / "wavs")
    rows = [(f"c{i % 20:02d}", [float(i % 20) / 40] * (100 + i % 20), 400) for i in range(40)]
    frame = spark.createDataFrame(rows, "id string, samples array<float>, rate int").repartition(4)
    made = []
    runs = [threading.Thread(target=lambda: made.append(wavs.export_wavs(frame, folder, 400).collect())) for _ in range(2)]
    [t.start() for t in runs]
    [t.join() for t in runs]
    assert [sorted(r["id"] for r in m) for m in made] == [[f"c{i:02d}" for i in range(20)]] * 2
    assert sorted(os.listdir(folder)) == [f"c{i:02d}.wav" for i in range(20)]
    back = {r["id"]: r["samples"] for r in wavs.decode(wavs.read_wavs(spark, folder)).collect()}
    assert all(len(back[f"c{i:02d}"]) == 100 + i and abs(back[f"c{i:02d}"][0] - i / 40) < 1e-3 for i in range(20))
    system, (part, path) = pafs.LocalFileSystem(), (str(tmp_path / "p"), str(tmp_path / "q"))
    open(part, "w").close()
    wavs.moved_into_place(system, part, path)
    wavs.moved_into_place(system, part, path)
    with pytest.raises(FileNotFoundError):
        wavs.moved_into_place(system, part, str(tmp_path / "r"))


def test_same_id_with_other_waves_exports_one_of_them_alike(spark, tmp_path):
    rows = [("a", [0.1] * 50, 400), ("a", [0.2] * 60, 400), ("a", [0.3] * 70, 400)]
    got = set()
    for k in range(3):
        folder = str(tmp_path / f"w{k}")
        wavs.export_wavs(spark.createDataFrame(rows[k:] + rows[:k], "id string, samples array<float>, rate int").repartition(k + 1), folder, 400)
        got.add(open(f"{folder}/a.wav", "rb").read())
    assert len(got) == 1
    assert wavs.list_wavs(spark, folder).filter(F.col("id") == "a").count() == 1

"""Waveform helpers (numpy, run in Arrow batches by the operators that need samples)."""

from __future__ import annotations

import io
import wave

import numpy as np


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Mono float32 samples and rate of PCM wav bytes of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(data)) as f:
        rate, channels, width = f.getframerate(), f.getnchannels(), f.getsampwidth()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1))
    return to_mono(x.reshape(-1, channels)), rate


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(to_pcm16(samples).tobytes())
    return out.getvalue()


def to_mono(samples: np.ndarray) -> np.ndarray:
    return samples.mean(axis=1, dtype=np.float32) if samples.ndim == 2 else samples


def to_pcm16(samples: np.ndarray) -> np.ndarray:
    """16-bit samples; a wave that peaks over 1 is scaled down as a whole."""
    peak = float(np.abs(samples).max(initial=0.0))
    x = samples / peak if peak > 1.0 else samples
    return np.clip(np.rint(x.astype(np.float64) * 32767), -32768, 32767).astype("<i2")


def normalize_wave(samples: np.ndarray, valid: int | None = None) -> np.ndarray:
    """Zero mean and unit (population) variance over the valid samples; what follows them is 0."""
    x = samples.astype(np.float32)
    n = len(x) if valid is None else min(valid, len(x))
    out = np.zeros_like(x)
    if n:
        part = x[:n].astype(np.float64)
        out[:n] = (part - part.mean()) / np.sqrt(part.var() + 1e-5)
    return out


def resampled_length(n: int, source: int, target: int, padded: int) -> int:
    return min(max(1, round(n * target / source)), padded)


def resample(samples: np.ndarray, source: int, target: int, zeros: int = 6, rolloff: float = 0.99) -> np.ndarray:
    """Band-limited interpolation with a Hann-windowed sinc; each output sample weighs the input around its time."""
    return interpolated(samples, source, target, zeros, rolloff).astype(np.float32)


def interpolated(samples: np.ndarray, source: int, target: int, zeros: int = 6, rolloff: float = 0.99) -> np.ndarray:
    """The same before it is rounded to single precision."""
    if source == target or not len(samples):
        return samples.astype(np.float64)
    step = np.gcd(source, target)
    source, target = source // step, target // step
    cutoff = min(source, target) * rolloff
    reach = int(np.ceil(zeros * source / cutoff))
    n = -(-len(samples) * target // source)
    where = np.arange(n, dtype=np.float64) * source / target
    padded = np.pad(samples.astype(np.float64), reach + 1)
    first = np.floor(where).astype(np.int64)
    out = np.zeros(n)
    for k in range(-reach, reach + 2):
        t = np.clip((first + k - where) / source * cutoff, -zeros, zeros)
        out += padded[np.clip(first + k + reach + 1, 0, len(padded) - 1)] * np.sinc(t) * np.cos(t * np.pi / zeros / 2) ** 2 * (cutoff / source)
    return out


def acoustic_metrics(samples: np.ndarray, rate: int) -> tuple[float, float, float]:
    """SNR estimate (dB), share of clipped samples and share of near-silent 20 ms frames; (0, 0, 1) for a clip under one frame."""
    per_frame = max(rate // 50, 1)
    starts = np.arange(0, len(samples) - per_frame + 1, per_frame)
    if not len(starts):
        return 0.0, 0.0, 1.0
    heard = samples[: len(starts) * per_frame].astype(np.float64)
    power = np.sort(np.add.reduceat(heard * heard, starts) / per_frame + 1e-12)
    quiet, loud = np.interp(np.array([0.1, 0.9]) * (len(power) - 1), np.arange(len(power)), power)
    clipped = np.count_nonzero(np.abs(samples.astype(np.float64)) > 0.99) / len(samples)  # as doubles: the float next to 0.99 is above it
    return float(10 * (np.log10(loud) - np.log10(quiet))), clipped, float(np.searchsorted(power, 2 * quiet) / len(power))


def cap_wave(samples: np.ndarray, rate: int, seconds: float = 8.0) -> np.ndarray:
    return samples[: int(seconds * rate)]

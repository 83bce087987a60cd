"""Per-recording signal metrics and splits, in Arrow batches of whole recordings."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.container import read_riff
from ..sources.settings import Settings

FRAME, HOP = 2048, 512  # fixed values
METRICS = """duration double, peak double, rms double, silence double, clipping double, snr double,
    noise_floor double, dynamic_range double, dropout double, rolloff double, sample_rate int, channels int, lufs double"""
# The K-weighting filters (gain in dB, quality, corner frequency), gate and block lengths.
SHELF, HIGH_PASS = (4.0, 2**-0.5, 1500.0), (0.0, 0.5, 38.0)
BLOCK_SECONDS, BLOCK_STEP, ABSOLUTE_GATE, RELATIVE_GATE, LUFS_OFFSET = 0.4, 0.25, -70.0, -10.0, -0.691
LEAST_LUFS_SECONDS = 0.5


UNREADABLE = ValueError  # what decoding raises


def decode_wav(content: bytes) -> tuple[np.ndarray, int, int]:
    """Mono samples in [-1, 1], sample rate, channel count of a file of whole numbers (8 to 32 bits) or floats."""
    f = read_riff(content)
    raw = np.frombuffer(content, np.uint8, f.frames * f.width, f.start)
    if f.subtype == "PCM_24":
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = raw.reshape(-1, 3)
        y = wide.view("<i4")[:, 0] / 2.0**31
    elif f.subtype in ("FLOAT", "DOUBLE"):
        y = raw.view("<f4" if f.subtype == "FLOAT" else "<f8").astype(np.float64)
    elif f.subtype == "PCM_U8":
        y = (raw.astype(np.float64) - 128) / 128
    else:
        y = raw.view("<i2") / 2.0**15 if f.subtype == "PCM_16" else raw.view("<i4") / 2.0**31
    return y if f.channels == 1 else y.reshape(-1, f.channels).mean(axis=1), f.rate, f.channels


def frame_rms(y: np.ndarray) -> np.ndarray:
    """RMS of centred, zero-padded frames."""
    padded = np.pad(y, FRAME // 2)
    sums = np.concatenate([[0.0], np.cumsum(padded**2)])
    starts = np.arange(0, len(padded) - FRAME + 1, HOP)
    return np.sqrt(np.maximum(sums[starts + FRAME] - sums[starts], 0) / FRAME)


def _db(x: np.ndarray | float) -> np.ndarray:
    return 20 * np.log10(np.maximum(x, 1e-10))


def dropout_ratio(db: np.ndarray, below: float = -60.0) -> float:
    """Share of very quiet frames whose neighbours, six either side, are loud."""
    loud = np.percentile(db, 90) - 20
    quiet = np.flatnonzero(db < below)
    hits = 0
    for i in quiet:
        around = np.delete(db[max(0, i - 6) : i + 7], min(i, 6))
        hits += bool(len(around)) and np.median(around) > loud
    return hits / len(db)


def _k_weighting(rate: int, n: int) -> np.ndarray:
    """Frequency response of both filters at the bins of a real transform of n samples."""
    z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
    gain, quality, corner = SHELF
    a, w = 10 ** (gain / 40), 2 * np.pi * corner / rate
    c, edge = np.cos(w), np.sqrt(a) * np.sin(w) / quality
    shelf = a * ((a + 1) + (a - 1) * c + edge - 2 * ((a - 1) + (a + 1) * c) * z + ((a + 1) + (a - 1) * c - edge) * z**2)
    shelf /= (a + 1) - (a - 1) * c + edge + 2 * ((a - 1) - (a + 1) * c) * z + ((a + 1) - (a - 1) * c - edge) * z**2
    _, quality, corner = HIGH_PASS
    w = 2 * np.pi * corner / rate
    c, alpha = np.cos(w), np.sin(w) / (2 * quality)
    return shelf * (1 + c) / 2 * (1 - z) ** 2 / (1 + alpha - 2 * c * z + (1 - alpha) * z**2)


def loudness(y: np.ndarray, rate: int) -> float | None:
    """Integrated loudness of a mono signal by gated blocks; null if too short or silent."""
    seconds = len(y) / rate
    if seconds < LEAST_LUFS_SECONDS:
        return None
    n = 1 << (len(y) + rate - 1).bit_length()  # a second of zeros at least, for the filters to die away
    heard = np.fft.irfft(np.fft.rfft(y, n) * _k_weighting(rate, n), n)[: len(y)]
    energy = np.concatenate([[0.0], np.cumsum(heard**2)])
    at = BLOCK_SECONDS * BLOCK_STEP * np.arange(round((seconds - BLOCK_SECONDS) / (BLOCK_SECONDS * BLOCK_STEP)) + 1)
    first, end = ((x * rate).astype(int).clip(0, len(y)) for x in (at, at + BLOCK_SECONDS))
    power = np.maximum(energy[end] - energy[first], 0) / (BLOCK_SECONDS * rate)
    level = lambda p: LUFS_OFFSET + 10 * np.log10(np.maximum(p, 1e-30))
    loud = power[level(power) >= ABSOLUTE_GATE]
    if len(loud):
        loud = loud[level(loud) > level(loud.mean()) + RELATIVE_GATE]
    return float(level(loud.mean())) if len(loud) else None


def rolloffs(y: np.ndarray, rate: int, share: float = 0.95, batch: int = 256) -> np.ndarray:
    """For every centred, zero-padded frame, the frequency below which the share of its magnitude lies."""
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(y, FRAME // 2), FRAME)[::HOP]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)  # a period of it
    out = []
    for at in range(0, len(frames), batch):
        below = np.cumsum(np.abs(np.fft.rfft(frames[at : at + batch] * window, axis=1)), axis=1)
        out.append((below >= share * below[:, -1:]).argmax(axis=1))
    return np.concatenate(out) * rate / FRAME


def metrics(y: np.ndarray, rate: int, channels: int, s: Settings = Settings()) -> tuple:
    rms = frame_rms(y)
    db = _db(rms)
    whole = float(np.sqrt(np.mean(y**2)))
    p5, p95 = _db(np.percentile(rms, 5)), _db(np.percentile(rms, 95))
    lufs = loudness(y, rate)
    return (
        round(len(y) / rate, 2), round(float(np.abs(y).max()), 4), round(whole, 6), round(float(np.mean(db < s.silence_level)), 4),
        round(float(np.mean(np.abs(y) >= s.clipping_level)), 5), round(float(_db(whole) - p5), 2), round(float(p5), 2),
        round(float(p95 - p5), 2), round(dropout_ratio(db, s.silence_level - 5), 4), round(float(np.median(rolloffs(y, rate))), 1), rate, channels,
        None if lufs is None else round(lufs, 2),
    )


def measure(files: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(path, *metrics, subtype, error) for ``files(path, content)``; what can't be decoded has an error, and no metrics."""
    names = [f.split()[0] for f in METRICS.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    content = bytes(content or b"")
                    y, rate, n = decode_wav(content)
                    if not len(y):
                        raise ValueError("no frames")
                    rows.append((path, *metrics(y, rate, n, s), read_riff(content).subtype, None))
                except UNREADABLE as e:
                    rows.append((path, *[None] * len(names), None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", *names, "subtype", "error"])

    return files.select("path", "content").mapInPandas(run, f"path string, {METRICS}, subtype string, error string")


MAX_PARTS = 5


def part_candidates(candidates: DataFrame, pieces: DataFrame, max_parts: int = MAX_PARTS) -> DataFrame:
    """Candidates of the parts: ``pieces(recording_id, piece, start_s, end_s)``, piece from 0.

    A recording of one piece stays as it is. Parts get ids, titles and lengths of their own;
    those beyond ``max_parts`` are left out, as the feature asks.
    """
    whole = Window.partitionBy("recording_id")
    cut = pieces.withColumn("_pieces", F.count("*").over(whole)).where("_pieces > 1 and piece < " + str(int(max_parts)))
    number = F.col("piece") + 1
    named = candidates.join(cut.drop("_pieces"), "recording_id", "left")
    return named.select(
        *(F.col(c) for c in candidates.columns if c not in ("recording_id", "title", "duration_sec")),
        F.col("recording_id").alias("parent_id"),
        F.when(number.isNull(), F.col("recording_id")).otherwise(F.format_string("%s_p%02d", "recording_id", number)).alias("recording_id"),
        F.when(number.isNull(), F.col("title")).otherwise(F.format_string("%s (Part %d)", "title", number)).alias("title"),
        F.when(number.isNull(), F.col("duration_sec")).otherwise(F.round(F.col("end_s") - F.col("start_s"), 2)).alias("duration_sec"),
        "start_s",
        "end_s",
    )


def pcm_16(y: np.ndarray) -> bytes:
    """Samples in [-1, 1] as those of a 16-bit file."""
    return (np.clip(y, -1, 32767 / 32768) * 32768).round().astype("<i2").tobytes()


def encode_wav(y: np.ndarray | bytes, rate: int) -> bytes:
    """A mono 16-bit PCM file of samples in [-1, 1], or of such as ``pcm_16`` has made."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(y if isinstance(y, bytes) else pcm_16(y))
    return out.getvalue()


def cut_files(parts: DataFrame) -> DataFrame:
    """(recording_id, content) for ``parts(recording_id, content, start_s, end_s)``: one file a part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content, start, end in zip(batch["recording_id"], batch["content"], batch["start_s"], batch["end_s"], strict=True):
                y, rate, _ = decode_wav(content)
                rows.append((name, encode_wav(y[round(start * rate) : round(end * rate)], rate)))
            yield pd.DataFrame(rows, columns=["recording_id", "content"])

    return parts.select("recording_id", "content", "start_s", "end_s").mapInPandas(run, "recording_id string, content binary")

"""Acoustic prints: 32-bit words from the samples of a recording, steady under changes of gain, rate and format.

The signal is brought to ``RATE``, framed, and the power of each frame summed by the twelve notes of the scale (chroma). The
frames' chroma are smoothed over a few frames and scaled to unit length, so loudness has no part in them. A word
holds, for each of 16 filters laid over the last ``SPAN`` frames and the notes, how the sum of one part compares with that of the
other: the logarithm of their ratio, put in one of four classes whose numbers differ from their neighbours'
by one bit. What changes little changes few bits, so prints are compared by their share of equal bits.

The filters and class limits are this module's own, so prints are comparable with each other, not with those of
other programs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..sources.settings import Settings
from .audio import UNREADABLE, decode_wav

RATE = 11025
FRAME, HOP = 4096, 1365  # about eight words a second
LOW, HIGH, NOTES = 28.0, 3520.0, 12
SMOOTHING = np.array([0.25, 0.75, 1.0, 0.75, 0.25])
SPAN = 16  # frames that a word looks at
HELD = 1 << 21  # samples that are held to be printed at once, or those of one file
LIMITS = (-0.12, 0.0, 0.12)  # between the classes of a log ratio
GRAY = (0, 1, 3, 2)
# (shape, first note, notes, frames) of each filter: what is compared with what in that window.
FILTERS = (
    ("whole", 0, 6, 4), ("notes", 0, 12, 8), ("frames", 0, 6, 16), ("frames", 6, 6, 16), ("notes", 0, 6, 8), ("notes", 6, 6, 8),
    ("cross", 0, 6, 16), ("cross", 6, 6, 16), ("notes", 3, 6, 16), ("middle", 0, 12, 8), ("middle", 2, 8, 16), ("frames", 3, 4, 8),
    ("cross", 3, 6, 8), ("notes", 1, 4, 16), ("frames", 8, 4, 8), ("middle", 4, 8, 4),
)


def resampled(y: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    """The signal, or each of several of one length in rows, at another rate, what lies above half of either taken out."""
    length = y.shape[-1]
    if rate == to or not length:
        return y
    # A block at a time, each with a margin on both sides, so that memory doesn't grow with the length.
    block, margin = rate * 8, rate
    out = []
    for at in range(0, length, block):
        piece = y[..., max(0, at - margin) : at + block + margin]
        size = piece.shape[-1]
        n = round(size * to / rate)
        spectrum = np.fft.rfft(piece)
        keep = min(spectrum.shape[-1], n // 2 + 1)
        made = np.fft.irfft(spectrum[..., :keep], n) * (n / size)
        first = round((at - max(0, at - margin)) * to / rate)
        out.append(made[..., first : first + round(min(block, length - at) * to / rate)])
    return np.concatenate(out, axis=-1)


@cache
def _notes() -> tuple[np.ndarray, slice, np.ndarray]:
    """The window of a frame, the bins that count, and (bin, note): 1 where a bin is of a note."""
    hertz = np.fft.rfftfreq(FRAME, 1 / RATE)
    bins = np.flatnonzero((hertz >= LOW) & (hertz <= HIGH))
    octave = np.log2(hertz[bins] / 27.5)
    note = (NOTES * (octave - np.floor(octave))).astype(int)
    return np.hamming(FRAME), slice(bins[0], bins[-1] + 1), np.eye(NOTES)[note]


def chroma(y: np.ndarray, batch: int = 16) -> np.ndarray:
    """Power by note of every whole frame, smoothed over frames, each row of unit length (zero where it is silent)."""
    if len(y) < FRAME:
        return np.zeros((0, NOTES))
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    window, bins, note = _notes()
    rows = []
    for at in range(0, len(frames), batch):
        heard = np.fft.rfft(frames[at : at + batch] * window, axis=1)[:, bins]
        rows.append((heard.real**2 + heard.imag**2) @ note)
    notes = np.concatenate(rows)
    n = len(notes) - len(SMOOTHING) + 1
    if n <= 0:
        return np.zeros((0, NOTES))
    smooth = sum(share * notes[k : k + n] for k, share in enumerate(SMOOTHING))
    length = np.linalg.norm(smooth, axis=1, keepdims=True)
    return np.divide(smooth, length, out=np.zeros_like(smooth), where=length > 1e-9)


@cache
def _boxes() -> np.ndarray:
    """(note and frame of a window, filter): 1 where a cell is of the one part; in as many columns behind these, of the other."""
    one, other = np.zeros((2, len(FILTERS), NOTES, SPAN))
    for k, (shape, p, height, width) in enumerate(FILTERS):
        q, half, third = p + height, width // 2, max(1, width // 4)
        mid = p + height // 2
        if shape == "whole":
            one[k, p:q, :width] = other[k, q:, :width] = 1
        elif shape == "notes":
            one[k, p:mid, :width] = other[k, mid:q, :width] = 1
        elif shape == "frames":
            one[k, p:q, :half] = other[k, p:q, half:width] = 1
        elif shape == "cross":
            one[k, p:mid, :half] = one[k, mid:q, half:width] = 1
            other[k, mid:q, :half] = other[k, p:mid, half:width] = 1
        else:
            one[k, p:q, third : width - third] = 1
            other[k, p:q, :third] = other[k, p:q, width - third : width] = 1
    return np.concatenate([one, other]).reshape(2 * len(FILTERS), -1).T


def words(cells: np.ndarray) -> np.ndarray:
    """A word for every ``SPAN`` frames in a row."""
    n = len(cells) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    sums = np.lib.stride_tricks.sliding_window_view(cells, SPAN, axis=0).reshape(n, -1) @ _boxes()
    ratio = np.log((1 + sums[:, : len(FILTERS)]) / (1 + sums[:, len(FILTERS) :]))
    classes = np.array(GRAY, np.uint32)[np.searchsorted(LIMITS, ratio, "right")]
    return np.bitwise_or.reduce(classes << np.arange(2 * len(FILTERS) - 2, -2, -2, dtype=np.uint32), axis=1)


def fingerprint(y: np.ndarray, rate: int, seconds: float = Settings().print_seconds) -> list[int]:
    """The print of the first seconds; empty where the recording is too short for a word or silent."""
    return _print(resampled(y[: int(seconds * rate)], rate))


def _print(y: np.ndarray) -> list[int]:
    cells = chroma(y)
    return words(cells).astype(np.int64).tolist() if cells.any() else []


PRINTED = "path string, duration double, fingerprint array<bigint>, error string"


def _fill(held: dict[tuple[int, int], list[tuple[list, np.ndarray]]]) -> None:
    """Put the prints of signals, held by rate and length, into their rows; those of one kind are resampled at once, which takes a third of the time."""
    for (rate, _), signals in held.items():
        try:
            for (row, _), y in zip(signals, resampled(np.stack([y for _, y in signals]), rate), strict=True):
                found = _print(y)
                row[2:] = found or None, None if found else "empty fingerprint"
        except UNREADABLE as e:
            for row, _ in signals:
                row[1:] = None, None, str(e) or type(e).__name__
    held.clear()


def printed(batches: Iterator[pd.DataFrame], seconds: float = Settings().print_seconds) -> Iterator[pd.DataFrame]:
    """``PRINTED`` for batches of (path, content), a batch at a time."""
    for batch in batches:
        rows: list[list] = []
        held: dict[tuple[int, int], list[tuple[list, np.ndarray]]] = {}
        samples = 0
        for path, content in zip(batch["path"], batch["content"], strict=True):
            try:
                y, rate, _ = decode_wav(content or b"")
                rows.append([path, len(y) / rate, None, None])
            except UNREADABLE as e:
                rows.append([path, None, None, str(e) or type(e).__name__])
                continue
            if samples + len(y) > HELD:
                _fill(held)
                samples = 0
            samples += len(y)
            y = y[: int(seconds * rate)]
            held.setdefault((rate, len(y)), []).append((rows[-1], y))
        _fill(held)
        yield pd.DataFrame(rows, columns=["path", "duration", "fingerprint", "error"])


def fingerprints(files: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(path, duration, fingerprint, error) for ``files(path, content)`` of WAV bytes.

    A file that can't be read, or that gives no word, has an error and a null print: it passes the duplicate
    gate and is not stored. Null and empty contents are such files; an empty table gives no rows.
    """
    seconds = s.print_seconds
    return files.select("path", "content").mapInPandas(lambda batches: printed(batches, seconds), PRINTED)

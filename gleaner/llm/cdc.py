"""Content-defined chunking by a gear hash with normalised chunk sizes.

The hash of a position mixes the 32 bytes up to it, so a cut depends on these bytes alone and
moves along with them when text before it is inserted or removed. Below the normal size a
stricter mask makes cuts rare, above it a looser one makes them likely, so sizes gather
around the normal size; a chunk is cut at the largest size at the latest.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import xxhash

_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)


@dataclass(frozen=True)
class Sizes:
    """Bounds of chunk sizes in bytes; ``normal`` is a power of two."""

    least: int
    normal: int
    most: int

    @property
    def masks(self) -> tuple[np.uint32, np.uint32]:
        bits = self.normal.bit_length() - 1
        return tuple(np.uint32(((1 << n) - 1) << (32 - n)) for n in (bits + 1, bits - 1))


def gear_hashes(data: bytes) -> np.ndarray:
    """At each byte, the sum of the gear values of the last 32 bytes, older ones shifted further."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for span in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h = longer
    return h


def cut_points(data: bytes, sizes: Sizes) -> list[int]:
    """Ascending ends of the chunks of ``data``; the last is its length."""
    n = len(data)
    if n <= sizes.least:
        return [n] if n else []
    strict, loose = sizes.masks
    h = gear_hashes(data)
    at = np.flatnonzero((h & loose) == 0)
    easy = (at + 1).tolist()
    hard = (at[(h[at] & strict) == 0] + 1).tolist()
    cuts, start = [], 0
    while n - start > sizes.least:
        middle, end = start + sizes.normal, min(start + sizes.most, n)
        i = bisect_left(hard, start + sizes.least)
        if i < len(hard) and hard[i] < middle:
            cut = min(hard[i], end)
        else:
            i = bisect_left(easy, middle)
            cut = easy[i] if i < len(easy) and easy[i] < end else end
        cuts.append(cut)
        start = cut
    if start < n:
        cuts.append(n)
    return cuts

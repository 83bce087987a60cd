"""What the headers of audio files say: a parser of RIFF (WAV), FLAC and Ogg bytes, and the integrity facts of a table of files.

A file's facts hold two lengths: the one its container declares and the one its bytes really hold. They
differ where a file was cut off:

* RIFF: the declared size of the data chunk against the bytes that follow it; a size that was never filled in (0 or
  all ones, as streaming writers leave it) declares nothing.
* FLAC: the total of samples in STREAMINFO (0: not known) against the end of the last frame whose header check
  sum is right.
* Ogg (Vorbis, Opus): the position of the last whole page; without a page that ends the stream, or with
  a page that is cut, the file can't be decoded to its end and has no frames.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACTS = """exists boolean, size bigint, frames bigint, has_stream boolean, container double, pcm double,
    sample_rate int, channels int, subtype string, error string"""


class Broken(ValueError):
    """The bytes are no audio file that can be read."""


@dataclass
class Found:
    """Frames that are there, what was declared (null if nothing was), and the format."""

    frames: int
    declared: int | None
    rate: int
    channels: int
    subtype: str
    start: int = 0  # where the samples of a RIFF file lie
    width: int = 0  # bytes of one of its frames


# Sample formats of RIFF files by tag and bits, and the tag that refers to a longer description.
RIFF_FORMATS = {(1, 8): "PCM_U8", (1, 16): "PCM_16", (1, 24): "PCM_24", (1, 32): "PCM_32", (3, 32): "FLOAT", (3, 64): "DOUBLE"}
EXTENSIBLE = 0xFFFE


def _chunks(data: bytes, at: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= len(data):
        name, size = struct.unpack_from("<4sI", data, at)
        yield name, at + 8, size
        at += 8 + size + size % 2


def read_riff(data: bytes) -> Found:
    if len(data) < 12 or data[:4] not in (b"RIFF", b"RF64") or data[8:12] != b"WAVE":
        raise Broken("no WAVE header")
    form, long_size = None, None
    for name, at, size in _chunks(data, 12):
        if name == b"ds64" and at + 16 <= len(data):
            long_size = struct.unpack_from("<Q", data, at + 8)[0]
        elif name == b"fmt ":
            if size < 16 or at + min(size, 40) > len(data):
                raise Broken("short format chunk")
            tag, channels, rate, _, width, bits = struct.unpack_from("<HHIIHH", data, at)
            if tag == EXTENSIBLE and size >= 40:
                tag = struct.unpack_from("<H", data, at + 24)[0]
            form = (tag, bits), channels, rate, width
        elif name == b"data":
            if form is None:
                raise Broken("data before its format")
            kind, channels, rate, width = form
            if kind not in RIFF_FORMATS or not channels or not rate or width != channels * kind[1] // 8:
                raise Broken(f"unknown sample format {kind}")
            there = len(data) - at
            if size == 0xFFFFFFFF:
                size = long_size
            open_end = size is None or (size == 0 and there > 0)
            held = there if open_end else min(size, there)
            return Found(held // width, None if open_end else size // width, rate, channels, RIFF_FORMATS[kind], at, width)
    raise Broken("no data chunk")


def _crc8(data: bytes) -> int:
    crc = 0
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc << 1 ^ 0x07) & 0xFF if crc & 0x80 else crc << 1
    return crc


def _coded_number(data: bytes, at: int) -> tuple[int, int]:
    """A number in the style of UTF-8, up to seven bytes, and where it ends."""
    first = data[at]
    if first < 0x80:
        return first, at + 1
    length = 8 - (first ^ 0xFF).bit_length()
    if not 2 <= length <= 7 or any(b >> 6 != 2 for b in data[at + 1 : at + length]) or at + length > len(data):
        raise Broken("no number")
    number = first & ((1 << (7 - length)) - 1)
    for b in data[at + 1 : at + length]:
        number = number << 6 | b & 0x3F
    return number, at + length


def _frame_end(data: bytes, at: int, least_block: int) -> int | None:
    """Samples up to the end of the FLAC frame that starts here; null where none does."""
    if at + 5 > len(data) or data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8 or data[at + 2] >> 4 == 0 or data[at + 2] & 15 == 15:
        return None
    try:
        number, end = _coded_number(data, at + 4)
        code, rate = data[at + 2] >> 4, data[at + 2] & 15
        if code == 1:
            block = 192
        elif code <= 5:
            block = 576 << (code - 2)
        elif code >= 8:
            block = 256 << (code - 8)
        else:
            width = code - 5
            block, end = int.from_bytes(data[end : end + width], "big") + 1, end + width
        end += {12: 1, 13: 2, 14: 2}.get(rate, 0)
        if end >= len(data) or _crc8(data[at:end]) != data[end]:
            return None
    except (Broken, IndexError):
        return None
    return number + block if data[at + 1] & 1 else number * least_block + block


def read_flac(data: bytes) -> Found:
    if data[:4] != b"fLaC" or len(data) < 42 or data[4] & 0x7F != 0:
        raise Broken("no STREAMINFO")
    least_block = struct.unpack_from(">H", data, 8)[0]
    packed = int.from_bytes(data[18:26], "big")
    rate, channels, bits, total = packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1
    if not rate:
        raise Broken("no sample rate")
    at, last = 4, False
    while not last:
        if at + 4 > len(data):
            raise Broken("metadata is cut off")
        last, at = bool(data[at] & 0x80), at + 4 + int.from_bytes(data[at + 1 : at + 4], "big")
    if at >= len(data):
        raise Broken("no audio frames")
    found, end = 0, len(data)
    while end > at:  # from the back, so that one frame is read and not all
        end = data.rfind(b"\xff", at, end)
        if end < 0:
            break
        samples = _frame_end(data, end, least_block)
        if samples is not None:
            found = samples
            break
    return Found(min(found, total) if total else found, total or None, rate, channels, f"PCM_{bits}" if bits != 8 else "PCM_S8")


def read_ogg(data: bytes) -> Found:
    at, rate, channels, kind, skip, position, ended = 0, 0, 0, "", 0, 0, False
    while at < len(data):
        if data[at : at + 4] != b"OggS" or at + 27 > len(data):
            raise Broken("a page is cut off or damaged")
        flags, granule = data[at + 5], struct.unpack_from("<q", data, at + 6)[0]
        lengths = data[at + 27 : at + 27 + data[at + 26]]
        body = at + 27 + len(lengths)
        if len(lengths) < data[at + 26] or body + sum(lengths) > len(data):
            raise Broken("a page is cut off")
        packet = data[body : body + 30]
        if packet[:7] == b"\x01vorbis" and len(packet) >= 16:
            kind, channels, rate = "VORBIS", packet[11], struct.unpack_from("<I", packet, 12)[0]
        elif packet[:8] == b"OpusHead" and len(packet) >= 16:
            kind, channels, rate, skip = "OPUS", packet[9], 48000, struct.unpack_from("<H", packet, 10)[0]
        if granule > 0:
            position = granule
        ended, at = ended or bool(flags & 4), body + sum(lengths)
    if not kind or not rate or not channels:
        raise Broken("no audio stream")
    if not ended:
        raise Broken("the stream has no end")
    return Found(max(0, position - skip), max(0, position - skip), rate, channels, kind)


READERS = {b"RIFF": read_riff, b"RF64": read_riff, b"fLaC": read_flac, b"OggS": read_ogg}


def facts(content: bytes | None) -> tuple:
    """FACTS of one file; a null content is a file that isn't there."""
    if content is None:
        return (False, None, None, False, None, None, None, None, None, "no file")
    reader = READERS.get(content[:4])
    if reader is None:
        return (True, len(content), None, False, None, None, None, None, None, "no known container")
    try:
        f = reader(content)
    except (Broken, struct.error) as e:
        return (True, len(content), None, str(e) != "no audio stream", None, None, None, None, None, str(e))
    declared = None if f.declared is None else f.declared / f.rate
    return (True, len(content), f.frames, True, declared, f.frames / f.rate, f.rate, f.channels, f.subtype, None)


def probe(files: DataFrame) -> DataFrame:
    """(path, probe) for ``files(path, content)``: a struct of FACTS, as the integrity gate and the chain take it.

    Null contents are files that aren't there, empty ones hold no stream; what can't be read has an error and no frames;
    rows that repeat keep a row each; other columns are ignored; an empty table gives no rows.
    """
    names = [f.split()[0] for f in FACTS.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, dict(zip(names, facts(None if c is None else bytes(c)), strict=True))) for p, c in zip(batch["path"], batch["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["path", "probe"])

    fields = ", ".join(f"{f.split()[0]}: {f.split()[1]}" for f in FACTS.split(","))
    return files.select("path", "content").mapInPandas(run, f"path string, probe struct<{fields}>")


def probe_candidates(candidates: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Candidates with ``probe`` of their file; one without a file among ``files`` has the facts of a missing one."""
    known = probe(files).withColumnRenamed("path", "_path").dropDuplicates(["_path"])
    missing = F.struct(*(F.lit(v).cast(f.split()[1]).alias(f.split()[0]) for v, f in zip(facts(None), FACTS.split(","), strict=True)))
    joined = candidates.join(known, candidates[path] == known["_path"], "left").drop("_path")
    return joined.withColumn("probe", F.coalesce("probe", missing))

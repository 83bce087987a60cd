"""Container facts and acoustic prints from bytes that are put together by hand."""

import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleaner.operators import audio, dedupe, gates, prints
from gleaner.sources import container


def riff(samples=b"\0\0" * 800, tag=1, channels=1, rate=8000, bits=16, declared=None, extra=b"", head=b"RIFF"):
    width = channels * bits // 8
    fmt = struct.pack("<HHIIHH", tag, channels, rate, rate * width, width, bits) + extra
    size = len(samples) if declared is None else declared
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", size) + samples
    return head + struct.pack("<I", len(body)) + body


def flac(total, frames, block=4096, rate=44100, channels=2, bits=16):
    """STREAMINFO, a comment block and frames: (number, hold) gives a header with its check sum and that many bytes behind it."""
    packed = rate << 44 | (channels - 1) << 41 | (bits - 1) << 36 | total
    info = struct.pack(">HH", block, block) + bytes(6) + packed.to_bytes(8, "big") + bytes(16)
    out = b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x84" + (4).to_bytes(3, "big") + b"abcd"
    for number, hold in frames:
        head = b"\xff\xf8\xc9\x18" + (bytes([number]) if number < 128 else chr(number).encode())  # 4096 samples, 44.1 kHz, stereo, 16 bits
        crc = 0
        for byte in head:  # x^8 + x^2 + x + 1, a bit at a time
            for i in range(7, -1, -1):
                crc = ((crc << 1) & 0xFF) ^ (0x07 if (crc >> 7) ^ (byte >> i & 1) else 0)
        out += head + bytes([crc]) + bytes(hold)
    return out


def page(granule, flags, *packets):
    lengths = b"".join(b"\xff" * (len(p) // 255) + bytes([len(p) % 255]) for p in packets)
    return b"OggS\0" + bytes([flags]) + struct.pack("<qIII", granule, 7, 0, 0) + bytes([len(lengths)]) + lengths + b"".join(packets)


VORBIS = b"\x01vorbis" + struct.pack("<IBI", 0, 2, 22050) + bytes(14)
OPUS = b"OpusHead\x01\x02" + struct.pack("<HI", 312, 44100) + bytes(3)
OGG = page(0, 2, VORBIS) + page(22050, 0, b"x" * 300) + page(44100, 4, b"y" * 20)
CASES = {  # name: (bytes, frames, container, pcm, code)
    "whole": (riff(), 800, 0.1, 0.1, None),
    "stereo 24": (riff(b"\1\2\3" * 200, channels=2, bits=24), 100, 0.0125, 0.0125, None),
    "float": (riff(bytes(3200), tag=3, bits=32), 800, 0.1, 0.1, None),
    "extensible": (riff(tag=0xFFFE, extra=struct.pack("<HHIH", 22, 16, 4, 1) + bytes(14)), 800, 0.1, 0.1, None),
    "open end": (riff(declared=0xFFFFFFFF), 800, None, 0.1, None),
    "cut": (riff(declared=16000 * 4), 800, 4.0, 0.1, "CORRUPT_AUDIO"),
    "a little short": (riff(declared=16000), 800, 1.0, 0.1, None),  # less than a second is let go
    "no samples": (riff(b""), 0, 0.0, 0.0, "CORRUPT_AUDIO"),
    "odd format": (riff(tag=85), None, None, None, "CORRUPT_AUDIO"),
    "header only": (riff()[:30], None, None, None, "CORRUPT_AUDIO"),
    "flac": (flac(44100, [(i, 50) for i in range(11)]), 44100, 1.0, 1.0, None),
    "flac of unknown length": (flac(0, [(0, 9), (200, 30)]), 201 * 4096, None, 201 * 4096 / 44100, None),
    "flac cut": (flac(441000, [(i, 50) for i in range(11)]), 11 * 4096, 10.0, 11 * 4096 / 44100, "CORRUPT_AUDIO"),
    "flac without frames": (flac(441000, []), None, None, None, "CORRUPT_AUDIO"),
    "flac with a false sync": (flac(40960, [(i, 50) for i in range(10)]) + b"\xff\xf8\xc9\x18\x7f\x00", 40960, 40960 / 44100, 40960 / 44100, None),
    "ogg": (OGG, 44100, 2.0, 2.0, None),
    "opus": (page(0, 2, OPUS) + page(48312, 4, b"z" * 10), 48000, 1.0, 1.0, None),
    "ogg without an end": (page(0, 2, VORBIS) + page(22050, 0, b"x" * 300), None, None, None, "CORRUPT_AUDIO"),
    "ogg cut in a page": (OGG[:-5], None, None, None, "CORRUPT_AUDIO"),
    "ogg of another kind": (page(0, 2, b"\x80theora" + bytes(30)) + page(1, 4, b"x"), None, None, None, "CORRUPT_AUDIO"),
    "text": (b"not a sound", None, None, None, "CORRUPT_AUDIO"),
    "empty": (b"", None, None, None, "CORRUPT_AUDIO"),
    "missing": (None, None, None, None, "CORRUPT_AUDIO"),
}


def test_probe(spark):
    files = spark.createDataFrame([(k, None if v[0] is None else bytearray(v[0]), 1) for k, v in CASES.items()], "path string, content binary, probe int")
    p = F.col("probe")
    code = gates.integrity_code(*(p[k] for k in ("exists", "size", "frames", "has_stream", "container", "pcm")))
    got = {r["path"]: r for r in container.probe(files).withColumn("code", code).collect()}
    for name, (content, frames, declared, pcm, code) in CASES.items():
        r = got[name]["probe"]
        assert (r["frames"], got[name]["code"]) == (frames, code), (name, r)
        assert (r["container"], r["pcm"]) == (pytest.approx(declared), pytest.approx(pcm)), name
        assert r["exists"] == (content is not None) and (r["error"] is None) == (frames is not None)
    assert got["stereo 24"]["probe"]["subtype"] == "PCM_24" and got["opus"]["probe"]["sample_rate"] == 48000
    assert container.probe(files.limit(0)).count() == 0


def test_probe_of_candidates(spark):
    files = spark.createDataFrame([("a.wav", bytearray(riff()))], "path string, content binary")
    rows = spark.createDataFrame([(1, "a.wav"), (2, "b.wav"), (3, None)], "ord int, path string")
    got = {r["ord"]: r["probe"] for r in container.probe_candidates(rows, files).collect()}
    assert got[1]["frames"] == 800 and not got[2]["exists"] and not got[3]["exists"] and got[2]["error"] == "no file"


@pytest.mark.parametrize("tag, bits, packed", [(1, 8, "u1"), (1, 16, "<i2"), (1, 32, "<i4"), (3, 32, "<f4"), (3, 64, "<f8"), (1, 24, None)])
def test_decoding(tag, bits, packed):
    y = np.array([0.0, 0.5, -0.5, 0.25])
    if bits == 24:
        raw = b"".join(int(v * 2**23).to_bytes(3, "little", signed=True) for v in y)
    elif tag == 3:
        raw = y.astype(packed).tobytes()
    else:
        raw = (y * 2.0 ** (bits - 1) + (128 if bits == 8 else 0)).astype(packed).tobytes()
    got, rate, channels = audio.decode_wav(riff(raw, tag=tag, bits=bits))
    assert got.tolist() == pytest.approx(y.tolist()) and (rate, channels) == (8000, 1)


def song(seed, rate=22050, seconds=16.0):
    """Decaying notes of a scale, a chord of three harmonics each."""
    rng = np.random.default_rng(seed)
    y = np.zeros(int(rate * seconds))
    t = np.arange(int(rate * 0.5)) / rate
    for at in np.arange(0, seconds - 0.5, 0.25):
        f = 220 * 2 ** (rng.integers(0, 24) / 12)
        note = sum(np.sin(2 * np.pi * f * h * t) / h for h in (1, 2, 3)) * np.exp(-3 * t)
        y[int(at * rate) : int(at * rate) + len(t)] += note
    return 0.5 * y / np.abs(y).max()


def likeness(a, b):
    n = min(len(a), len(b))
    return 1 - sum(((x ^ y) & 0xFFFFFFFF).bit_count() for x, y in zip(a[:n], b[:n], strict=True)) / (32 * n)


def test_prints_meet_across_gain_rate_and_noise():
    tunes = [song(s) for s in range(5)]
    own = [prints.fingerprint(y, 22050) for y in tunes]
    assert all(0 <= w < 1 << 32 for p in own for w in p)
    for y, p in zip(tunes, own, strict=True):
        for rate, gain, noise in ((22050, 0.05, 0), (16000, 0.6, 0), (44100, 1, 0), (48000, 0.5, 0.003)):
            z = prints.resampled(y, 22050, rate) * gain
            z = z + np.random.default_rng(1).normal(0, noise, len(z)) if noise else z
            again, _, _ = audio.decode_wav(audio.encode_wav(z, rate))
            assert likeness(p, prints.fingerprint(again, rate)) >= 0.9
    assert max(likeness(a, b) for i, a in enumerate(own) for b in own[:i]) < 0.8
    assert prints.fingerprint(np.zeros(22050 * 9), 22050) == [] == prints.fingerprint(tunes[0][:4000], 22050)


def test_prints_cover_the_first_seconds_only():
    y = song(3, seconds=12.0)
    assert prints.fingerprint(y, 22050, 8.0) == prints.fingerprint(y[: 8 * 22050], 22050)
    long = prints.resampled(song(4, 8000, 40.0), 8000)
    assert len(long) == 40 * prints.RATE and np.abs(long).max() < 1


def test_prints_feed_the_duplicate_gate(spark):
    made = [(0, song(1), 22050), (1, prints.resampled(song(1), 22050, 16000) * 0.3, 16000), (2, song(2), 22050)]
    files = [(str(i), bytearray(audio.encode_wav(y, rate))) for i, y, rate in made] + [("3", bytearray(b"junk")), ("4", None), ("5", bytearray(audio.encode_wav(np.zeros(99999), 22050)))]
    got = prints.fingerprints(spark.createDataFrame(files, "path string, content binary"))
    rows = {r["path"]: r for r in got.collect()}
    assert [bool(rows[str(i)]["error"]) for i in range(6)] == [False, False, False, True, True, True]
    assert rows["0"]["duration"] == pytest.approx(16.0) and rows["5"]["error"] == "empty fingerprint"
    found = dedupe.greedy(got.select(F.col("path").cast("long").alias("ord"), F.col("fingerprint").alias("fp")), 0.90)
    assert {r["ord"]: r["duplicate_of"] for r in found.collect()} == {0: None, 1: 0, 2: None, 3: None, 4: None, 5: None}


def test_files_of_a_batch_are_printed_as_alone(monkeypatch):
    """Signals of one rate and length are resampled at once, some files at a time; a file that can't be printed spoils no other."""
    files = [audio.encode_wav(song(k, rate, seconds), rate) for k, (rate, seconds) in enumerate([(16000, 4.0), (16000, 4.0), (8000, 3.0), (16000, 3.0), (11025, 4.0)])]
    files += [audio.encode_wav(np.zeros(1), 48000), b"junk", None, audio.encode_wav(np.zeros(0), 8000)]
    batch = pd.DataFrame({"path": [str(k) for k in range(len(files))], "content": files})
    alone = [next(prints.printed(iter([batch[k : k + 1]]))) for k in range(len(batch))]
    calls, made = [], prints.resampled
    monkeypatch.setattr(prints, "resampled", lambda y, rate: calls.append(y.shape) or made(y, rate))
    for held in (1 << 21, 70_000):
        monkeypatch.setattr(prints, "HELD", held)
        calls.clear()
        got = next(prints.printed(iter([batch])))
        told = lambda row: [x if isinstance(x, list) or pd.notna(x) else None for x in row]
        assert [told(row) for row in got.itertuples(index=False)] == [told(one.iloc[0]) for one in alone]
        assert ((2, 64000) in calls) == (held > 128_000)
    assert [bool(e) for e in got["error"]] == [False] * 5 + [True] * 4

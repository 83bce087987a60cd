"""Sketches, exact quantiles, fetching, splitting of files, checks of a session, selections and reports."""

import json
import logging
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import audio, chain, dedupe, discovery, models, quantiles, sketches, splitter
from gleaner.sources import media, preflight, search, settings
from gleaner.sources.settings import Settings, SettingsError

from .test_audio_files import song
from .test_chain import outcome, table
from .test_reference_operators import RULES

LOG = "recording_id string, category_slug string, decision string, final_score double"


def test_merged_sketches_are_one_pass(spark, tmp_path):
    rng = random.Random(8)
    rows = [(f"r{rng.randrange(6000)}", rng.choice("ab"), rng.choice(["ACCEPT", "REJECT"]), rng.gauss(0.5, 0.2)) for _ in range(20_000)]
    rows += [("n", "none", "REJECT", None)] * 3
    path = str(tmp_path / "sketches")
    for at in range(0, len(rows), 2500):
        sketches.append_sketches(spark.createDataFrame(rows[at : at + 2500], LOG), path)
    got = {r["category_slug"]: r for r in sketches.stored_report(spark, path, ("category_slug",), (0.1, 0.5, 0.9)).collect()}
    for slug in "ab":
        own = [r for r in rows if r[1] == slug]
        assert got[slug]["records"] == len(own)
        assert got[slug]["distinct_ids"] == pytest.approx(len({r[0] for r in own}), rel=4 * sketches.ID_ERROR)
        scores = np.sort([r[3] for r in own])
        for share, q in zip((0.1, 0.5, 0.9), got[slug]["quantiles"], strict=True):
            assert abs(np.searchsorted(scores, q, "right") / len(scores) - share) <= sketches.RANK_ERROR
    assert got["none"]["records"] == 3 and got["none"]["distinct_ids"] == 1 and got["none"]["quantiles"] is None
    whole = sketches.stored_report(spark, path, ()).first()
    assert whole["records"] == len(rows) and whole["distinct_ids"] == pytest.approx(len({r[0] for r in rows}), rel=4 * sketches.ID_ERROR)
    below = sketches.merged(spark.read.parquet(path), ()).select(sketches.share_below(F.col("scores"), 0.5)).first()[0]
    assert abs(below - np.mean([r[3] <= 0.5 for r in rows if r[3] is not None])) <= sketches.RANK_ERROR


def test_exact_quantiles(spark):
    rng = random.Random(9)
    groups = {"many": [rng.randrange(50) / 7 for _ in range(5000)], "one": [3.5], "two": [1.0, 2.0], "same": [4.0] * 99, None: [rng.random() for _ in range(100)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("two", None), ("two", math.nan), ("empty", None)]
    qs = (0.0, 0.05, 0.25, 0.5, 0.95, 1.0)
    got = {(r["k"], r["quantile"]): r["v"] for r in quantiles.exact_quantiles(spark.createDataFrame(rows, "k string, v double").repartition(7), "k", "v", qs).collect()}
    assert got == {(k, q): pytest.approx(float(np.quantile(vs, q))) for k, vs in groups.items() for q in qs}
    assert quantiles.exact_quantiles(spark.createDataFrame([], "k string, v double"), "k", "v", qs).count() == 0


def stereo(rate=8000, seconds=1):
    y = (np.sin(np.arange(rate * seconds) / 9) * 9000).astype("<i2")
    body = np.repeat(y, 2).tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, rate, rate * 4, 4, 16) + b"data" + struct.pack("<I", len(body)) + body


def get(url):
    if url == "gone":
        raise ConnectionError("no such place")
    return b"<html>" if url == "page" else stereo()


def test_fetch_stages_each_recording_once(spark, tmp_path):
    (tmp_path / "old.flac").write_bytes(b"staged before")
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("old", "gone", 3), ("g", "gone", 4), ("p", "page", 5), ("n", None, 6)], "recording_id string, url string, ord int")
    got = {r["ord"]: r for r in media.fetch(rows, get, str(tmp_path), tasks=2, pause=lambda _: None).collect()}
    assert [got[i]["fetched"] for i in range(1, 7)] == [True, True, True, False, False, True]
    assert got[1]["path"] == got[2]["path"] == str(tmp_path / "a.wav") and got[3]["path"].endswith("old.flac")
    assert "no such place" in got[4]["fetch_error"] and "WAVE" in got[5]["fetch_error"]
    y, rate, channels = audio.decode_wav((tmp_path / "a.wav").read_bytes())
    assert (rate, channels) == (16000, 1) and len(y) == 16000
    before = (tmp_path / "a.wav").stat().st_mtime_ns
    again = media.fetch(rows, get, str(tmp_path), pause=lambda _: None)
    assert again.where("ord = 1").first()["fetched"] and (tmp_path / "a.wav").stat().st_mtime_ns == before
    held = {r["recording_id"]: bytes(r["content"]) for r in media.contents(again).collect()}
    assert held["old"] == b"staged before" and sorted(held) == ["a", "n", "old"]
    assert media.fetch(rows.limit(0), get, str(tmp_path)).count() == 0


def test_split_files_go_through_the_chain(spark):
    s = Settings(split_above=9.0, part_min=4.0, part_target=6.0, part_max=8.0, max_parts=2, min_duration=1.0, min_quality=0.2)
    y = np.concatenate([song(1, 8000, 6.0), np.zeros(2000), song(2, 8000, 6.0), np.zeros(2000), song(1, 8000, 6.0)])
    files = [("0", y), ("1", y[: 8 * 8000]), ("3", np.tile(y, 20)), ("4", np.zeros(0))]
    contents = spark.createDataFrame([(k, bytearray(audio.encode_wav(v, 8000))) for k, v in files] + [("2", bytearray(b"junk")), ("5", None)], "recording_id string, content binary")
    pieces = splitter.split_recordings(contents, s)
    got = sorted((r["recording_id"], r["piece"], r["start_s"], r["end_s"]) for r in pieces.select("recording_id", "piece", "start_s", "end_s").collect())
    assert [g[:2] for g in got] == [("0", 0), ("0", 1)]  # the third is beyond the most parts; the others are short, too long or unreadable
    assert got[0][2] == 0.0 and got[0][3] == pytest.approx(6.1, abs=0.3) == got[1][2] and 10 < got[1][3] < 15
    one = pieces.where("piece = 0").first()
    cut, rate, _ = audio.decode_wav(bytes(one["content"]))
    assert len(cut) / rate == pytest.approx(one["end_s"]) and one["metrics"]["duration"] == pytest.approx(one["end_s"], abs=0.01) and one["fp"]
    assert splitter.split_recordings(contents, Settings(split=False)).count() == 0
    own = pieces.withColumn("metrics", F.struct(*(F.col("metrics")[k].cast("double").alias(k) for k in chain.METRICS))).select("recording_id", "piece", "metrics", "fp")
    decided = outcome(chain.decide(table(spark, [{}, {}]), RULES, s=s, pieces=own))
    assert decided["0"][0] == "chunking" and sorted(decided) == ["0", "0_p01", "0_p02", "1"]


def test_settings_of_every_section(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "s.yaml"
    base = {k: {} for k in settings.SECTIONS}
    own = base | {
        "quality_gate": {"maximum_silence_ratio": 0.3, "near_silence_dbfs": -50, "loudness": {"min_lufs": -40}, "dropout": {"max_dropout_ratio": 0.2, "gap_min_ms": 50}},
        "classifier": {"music_min_prob": 0.4, "speech_reject_prob": 0.7, "mixed_low": 0.2}, "metadata_gate": {"min_keyword_hits": 2, "exclude_terms": {"NEWS": ["news"], "NO_CODE": ["x"]}},
        "folk_relevance": {"clap": {"enabled": False, "blend_weight": 0.25}}, "chunking": {"enabled": True, "max_chunks_per_video": 3}, "storage": {"root": "anything"},
    }
    path.write_text(json.dumps(own))
    s = Settings.from_file(str(path))
    assert (s.limits["silence"], s.silence_level, s.limits["min_lufs"], s.limits["dropout"], s.limits["snr"]) == (0.3, -50.0, -40.0, 0.2, 5.0)
    assert (s.min_music, s.max_speech, s.min_mixed, s.keyword_hits, s.second_model, s.second_weight, s.max_parts) == (0.4, 0.7, 0.2, 2, False, 0.25, 3)
    with pytest.warns(UserWarning, match="NO_CODE"):
        assert settings.exclusions_from_file(str(path)) == {"NEWS": ("news",)}
    for section, given in (("quality_gate", {"maximum_silense_ratio": 1}), ("quality_gate", {"loudness": {"low": 1}}), ("scoring", {"weight": {}})):
        path.write_text(json.dumps(base | {section: given}))
        with pytest.raises(SettingsError, match="without effect"):
            Settings.from_file(str(path))


def test_preflight(spark, tmp_path):
    found = {r["check"]: (r["ok"], r["message"]) for r in preflight.preflight(spark).collect()}
    assert all(ok for ok, _ in found.values()) and "settings" not in found
    (tmp_path / "s.yaml").write_text("{}")
    bad = {r["check"]: (r["ok"], r["message"]) for r in preflight.preflight(spark, str(tmp_path / "s.yaml"), ("numpy", "no_such_package")).collect()}
    assert not bad["driver packages"][0] and not bad["settings"][0] and "missing sections" in bad["settings"][1]
    assert "no_such_package" in preflight._on_executors(spark, ("no_such_package",))


def test_logging_is_set_up_once(tmp_path):
    place = tmp_path / "run.log"
    for _ in range(2):
        log = preflight.setup_logging("INFO", str(place))
    log.info("பாடல்")
    assert len(log.handlers) == 2 and place.read_text(encoding="utf-8").count("பாடல்") == 1
    for handler in list(log.handlers):
        handler.close()
        log.removeHandler(handler)
    assert logging.getLogger(preflight.LOGGER) is log


def test_selection_and_report(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "folder_slug string, id int")
    assert sorted(r["id"] for r in discovery.chosen(known, " c, a,,").collect()) == [1, 3] and discovery.chosen(known).count() == 3
    with pytest.raises(Exception, match="unknown category: x"):
        discovery.chosen(known, "a,x").collect()
    found = spark.createDataFrame([(3,), (1,), (2,)], "ord int")
    assert [r[0] for r in discovery.first_candidates(found, 2).collect()] == [1, 2] and discovery.first_candidates(found, 0).count() == 3
    report = discovery.category_report(spark.createDataFrame([("b", 1, 2), ("a", 3, None)], "category string, accepted int, texts int"))
    assert [tuple(r) for r in report.select("category", "accepted", "texts").collect()] == [("a", 3, None), ("b", 1, 2), ("TOTAL", 4, 2)]


def test_prints_of_many_lengths(spark):
    """Classes of lengths leave no pair out; shared words find nearly all of long prints."""
    rng = random.Random(10)
    prints = []
    for i in range(150):
        fp = [rng.getrandbits(32) for _ in range(rng.randint(1, 40))]
        if prints and rng.random() < 0.6:
            fp = list(rng.choice(prints)[1])[: rng.randint(1, 40)] + fp[:5]
            for _ in range(rng.randint(0, len(fp) * 3)):
                fp[rng.randrange(len(fp))] ^= 1 << rng.randrange(32)
        prints.append((i, fp))
    df = spark.createDataFrame(prints, "ord long, fp array<bigint>")

    def near(a, b):
        n = min(len(a), len(b))
        return 1 - sum((x ^ y).bit_count() for x, y in zip(a[:n], b[:n], strict=True)) / (32 * n)

    want = {(a, b) for a, x in prints for b, y in prints if b < a and near(x, y) >= 0.9}
    assert {(r["ord"], r["other"]) for r in dedupe.similar_pairs(df, 0.9).collect()} == want and len(want) > 30
    assert dedupe.length_classes([5, 6, 8, 9, 20], 0.9) == [(5, 16), (6, 19), (8, 28), (20, 64)]
    long = [(i, [rng.getrandbits(32) for _ in range(100)]) for i in range(60)]
    long += [(60 + i, [w ^ sum(1 << b for b in range(32) if rng.random() < 0.07) for w in fp[: rng.randint(60, 100)]]) for i, fp in long]
    table = spark.createDataFrame(long, "ord long, fp array<bigint>")
    found = {(r["ord"], r["other"]) for r in dedupe.similar_pairs(table, 0.9, by="words").collect()}
    planted = {(60 + i, i) for i in range(60) if near(long[i][1], long[60 + i][1]) >= 0.9}
    assert found <= planted and len(found) >= 0.9 * len(planted) and len(planted) > 50
    with pytest.raises(ValueError):
        dedupe.similar_pairs(table, 0.9, by="luck")


def test_failures_are_told(spark):
    def load():
        def model(values):
            if (values == 3).any():
                raise ValueError("three")
            return [None if v == 4 else v * 2.0 for v in values]

        return model

    use = models.batch_model(load, "double", errors=True)
    out = spark.range(6).withColumn("r", use(F.col("id") > 0, F.col("id")))
    got = {r["id"]: (r["r"]["answer"], r["r"]["error"]) for r in out.collect()}
    assert got == {0: (None, None), 1: (2.0, None), 2: (4.0, None), 3: (None, "ValueError: three"), 4: (None, None), 5: (10.0, None)}
    sources = spark.createDataFrame([("a", 0, 2), ("bad", 1, 2), ("none", 2, 2)], "query string, source_ord int, most int")

    def find(query, most):
        if query == "bad":
            raise ConnectionError
        return [{"id": "x"}] if query == "a" else []

    hits = search.search(sources, find, attempts=1)
    assert sorted(r["query"] for r in search.failed_sources(sources, hits).collect()) == ["bad", "none"]


def test_positions_over_many_partitions(spark):
    rows = [(f"v{i % 3}", i) for i in range(0, 900) if i % 3 != 1 or i < 90]
    df = spark.createDataFrame(rows, "variant string, n int").repartition(5)
    got = {(r["variant"], r["n"]): r["pos"] for r in discovery.interleave(df, "variant", "n").collect()}
    turn, want = {}, []
    for v, n in rows:
        turn[v] = turn.get(v, 0) + 1
        want.append((turn[v], v, n))
    assert got == {(v, n): i + 1 for i, (_, v, n) in enumerate(sorted(want))}
    assert discovery.numbered(df.limit(0), "n").count() == 0

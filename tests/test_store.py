"""Transcripts, the store step and the backfill, with services that fail on purpose."""

import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators import store, transcription
from gleaner.sources import runlog, storage

quick = {"pause": lambda _: None}


def primary(content):
    if content.startswith(b"down"):
        raise ConnectionError("primary is down")
    if content == b"odd":
        return "no json"
    return json.dumps({"text": f"one of {content.decode()}. two"})


def fallback(content):
    if content.endswith(b"down down"):
        raise TimeoutError("fallback too")
    return json.dumps({"transcript": ["by ", "fallback"]})


def test_fallback_and_failures_by_row(spark):
    files = spark.createDataFrame([(k, bytearray(k.encode())) for k in ("a", "down", "down down", "odd", "")], "path string, content binary")
    got = {r["path"]: r for r in transcription.transcribe(files, (primary, fallback), parallel=3, tasks=2, **quick).collect()}
    assert (got["a"]["text"], got["a"]["answered_by"]) == ("one of a. two", 0)
    assert (got["down"]["text"], got["down"]["answered_by"]) == ("by fallback", 1)
    assert got["down down"]["text"] is None and got["down down"]["error"] == "TimeoutError: fallback too"
    assert got["odd"]["text"] == "" and got["odd"]["error"] is None and got[""]["text"] == "one of . two"
    plain = transcription.transcribe(files.where("path = 'a'"), (lambda b: b.decode() * 2,), json=False, **quick)
    assert plain.first()["text"] == "aa"
    assert transcription.transcribe(files.limit(0), (primary,)).count() == 0
    none = transcription.transcribe(files.where("path = 'a'"), (), **quick).first()
    assert none["text"] is None and "nothing to call" in none["error"]


def test_tries_again():
    asked = []

    def flaky(content):
        asked.append(content)
        if len(asked) < 3:
            raise ConnectionError
        return "done"

    assert transcription.answered(b"x", (flaky,), 3, lambda _: None) == ("done", 0)
    with pytest.raises(ConnectionError):
        asked.clear()
        transcription.answered(b"x", (flaky,), 2, lambda _: None)


def test_backfill_writes_what_is_missing_once(spark, tmp_path):
    place = tmp_path / "tn" / "harvest"
    place.mkdir(parents=True)
    for name, content in {"a.wav": b"A", "b.wav": b"down down", "c.wav": b"C", "d.wav": b"D", "c.txt": b"t" * 30, "d.txt": b"short", "x.log": b""}.items():
        (place / name).write_bytes(content)
    tried, totals = transcription.backfill(spark, str(tmp_path), (primary, fallback), parallel=2, **quick)
    assert tuple(totals.first()) == (4, 1, 2, 1)  # total, done before, transcribed, remaining
    assert {r["path"].rsplit("/", 1)[1]: r["error"] is None for r in tried.collect()} == {"a.wav": True, "b.wav": False, "d.wav": True}
    text = (place / "a.txt").read_text()
    assert text.startswith("Title: Tamil Folk Song (a)\nArtist: Unknown Artist\n") and "Category: harvest\n" in text and text.endswith("[Verse 1]\none of A\ntwo")
    assert (place / "c.txt").read_bytes() == b"t" * 30 and not (place / "b.txt").exists()
    before = (place / "a.txt").stat().st_mtime_ns
    _, totals = transcription.backfill(spark, str(tmp_path), (fallback,), **quick)  # the fallback fails for b
    assert tuple(totals.first()) == (4, 3, 0, 1) and (place / "a.txt").stat().st_mtime_ns == before
    _, totals = transcription.backfill(spark, str(tmp_path), (lambda _: '{"text": "found"}',), force=True, **quick)
    assert tuple(totals.first()) == (4, 0, 4, 0) and "found" in (place / "b.txt").read_text()
    assert not list(place.glob("*.part"))


DECIDED = "recording_id string, category_slug string, decision string, rejection_code string, final_score double, title string"


def test_conclude_stores_and_logs_once(spark, tmp_path):
    rows = [("a", "s", "ACCEPT", None, 0.9, "T"), ("b", "s", "REVIEW", None, 0.5, None), ("c", "s", "REJECT", "NEWS", None, "N"), ("d", "s", "ACCEPT", None, 0.8, None), ("e", "s", "ACCEPT", None, 0.8, None)]
    decided = spark.createDataFrame(rows, DECIDED)
    audio = spark.createDataFrame([("a", bytearray(b"A")), ("b", bytearray(b"B")), ("c", bytearray(b"C")), ("d", bytearray(b"down down"))], "recording_id string, content binary")
    root, log = str(tmp_path / "out"), str(tmp_path / "log")
    for _ in range(2):
        out = {r["recording_id"]: r for r in store.conclude(decided, audio, log, "run-1", root, "tn", (primary, fallback), **quick).collect()}
        assert sorted(out) == ["a", "b", "d", "e"]
        assert out["a"]["text_path"] == f"{root}/tn/s/a.txt" and out["b"]["audio_path"] == f"{root}/tn/s/b.wav" and out["b"]["text_path"] is None
        assert out["d"]["audio_path"] and out["d"]["text_path"] is None and out["e"]["audio_path"] is None
        assert sorted(p.name for p in (tmp_path / "out" / "tn" / "s").iterdir()) == ["a.txt", "a.wav", "b.wav", "d.wav"]
        assert (tmp_path / "out" / "tn" / "s" / "a.txt").read_text().startswith("Title: T\n")
        logged = {r["recording_id"]: (r["decision"], r["rejection_code"], r["final_score"]) for r in runlog.read_run_log(spark, log).collect()}
        assert logged == {r[0]: (r[2], r[3], r[4]) for r in rows}
        assert len(list((tmp_path / "log" / "commits").glob("*.json"))) == 1
    _, totals = transcription.backfill(spark, root, (fallback, lambda _: '{"text": "later"}'), **quick)
    assert tuple(totals.first()) == (3, 1, 2, 0)


def test_a_file_that_cannot_be_written_changes_no_decision(spark, tmp_path):
    (tmp_path / "out").write_text("a file where a folder should be")
    decided = spark.createDataFrame([("a", "s", "ACCEPT", None, 0.9, "T")], DECIDED)
    audio = spark.createDataFrame([("a", bytearray(b"A"))], "recording_id string, content binary")
    log = str(tmp_path / "log")
    got = store.conclude(decided, audio, log, "r", str(tmp_path / "out"), "tn", (primary,), **quick).first()
    assert got["error"] and got["audio_path"] is None and got["text_path"] is None and got["decision"] == "ACCEPT"
    assert runlog.read_run_log(spark, log).first()["decision"] == "ACCEPT"
    assert storage.put_files(decided.select(F.col("recording_id").alias("path"), F.lit(b"").alias("content")).limit(0)).count() == 0


def test_copies(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * (storage.COPY_BYTES + 5))
    pairs = [(str(tmp_path / "a"), str(tmp_path / "to" / "b")), (f"file://{tmp_path}/a", f"file://{tmp_path}/to/c"), (str(tmp_path / "none"), str(tmp_path / "to" / "d")), (None, "/x")]
    got = [r["error"] for r in storage.copy_files(spark.createDataFrame(pairs, "path string, target string").coalesce(1)).collect()]
    assert [e is None for e in got] == [True, True, False, False]
    assert (tmp_path / "to" / "b").read_bytes() == (tmp_path / "to" / "c").read_bytes() == (tmp_path / "a").read_bytes()
    assert sorted(p.name for p in (tmp_path / "to").iterdir()) == ["b", "c"]

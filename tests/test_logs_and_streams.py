"""Transactions of the run log, and streams that keep state or may repeat a batch."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from gleaner.operators import dedupe
from gleaner.sources import runlog, transactions
from gleaner.streaming.prints import SHARE, streamed_duplicates


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "recording_id string, decision string")


def logged(spark, path):
    return {r["recording_id"]: r["decision"] for r in runlog.read_run_log(spark, path).collect()}


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    frames = [records(spark, *((f"{w}-{i}", "ACCEPT") for i in range(50))).repartition(3) for w in range(4)]
    writers = [threading.Thread(target=runlog.append_run_log, args=(f, path)) for f in frames]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(logged(spark, path)) == 200


def test_an_aborted_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append_run_log(records(spark, ("a", "ACCEPT")), path)
    boom = F.when(F.col("id") == 77, F.raise_error(F.lit("boom")).cast("string")).otherwise("REJECT")
    bad = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("recording_id"), boom.alias("decision"))
    with pytest.raises(Exception, match="boom"):
        runlog.append_run_log(bad, path)
    assert logged(spark, path) == {"a": "ACCEPT"}
    assert len(list((tmp_path / "log" / "parts").iterdir())) == 1


def test_parts_without_a_commit_do_not_count(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append_run_log(records(spark, ("a", "ACCEPT")), path)
    stray = tmp_path / "log" / "parts" / "dead-000000-1.json"
    stray.write_text('{"recording_id": "b", "decision": "REJECT", "row": 0}\n')
    assert logged(spark, path) == {"a": "ACCEPT"}
    assert transactions.remove_stray_parts(spark, path) == 0 and stray.exists()  # may belong to a job that runs
    assert transactions.remove_stray_parts(spark, path, older_than=0) == 1 and not stray.exists()
    assert logged(spark, path) == {"a": "ACCEPT"}


def test_an_append_reads_nothing(spark, tmp_path):
    path = tmp_path / "log"
    runlog.append_run_log(records(spark, ("a", "ACCEPT")), str(path))
    for part in (path / "parts").iterdir():
        part.chmod(0)  # read by nobody but root; so it is replaced by what no reader could parse, too
        part.chmod(0o600)
        part.write_bytes(b"\xff\xfe broken")
    runlog.append_run_log(records(spark, ("b", "REJECT")), str(path))
    assert logged(spark, str(path)) == {"b": "REJECT"}


def test_a_named_transaction_counts_once(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append_run_log(records(spark, ("a", "ACCEPT")), path, "t-1")
    runlog.append_run_log(records(spark, ("a", "REJECT"), ("b", "REJECT")), path, "t-1")
    runlog.append_run_log(records(spark), path, "t-2")
    assert logged(spark, path) == {"a": "ACCEPT"}
    assert transactions.committed_lines(spark, path).count() == 1


def test_open_fields_stay(spark, tmp_path):
    path = tmp_path / "log"
    path.mkdir()
    (path / "old.json").write_text('{"recording_id": "z", "decision": "REJECT", "row": "r", "odd": {"deep": [1, null, "x"]}}\n')
    rows = spark.createDataFrame([("a", "ACCEPT", ["t", "u"], 1.5), ("n", "ACCEPT", None, None)], "recording_id string, decision string, tags array<string>, gain double")
    runlog.append_run_log(rows, str(path))
    extras = lambda: {r["recording_id"]: json.loads(r["e"]) for r in runlog.read_run_log(spark, str(path)).withColumn("e", F.to_json("extra")).collect()}
    first = extras()
    assert first["z"] == {"odd": {"deep": [1, None, "x"]}} and first["a"] == {"tags": ["t", "u"], "gain": 1.5}
    runlog.append_run_log(runlog.read_run_log(spark, str(path)).withColumn("gain", F.lit(2)), str(path))
    second = extras()
    assert second["z"] == {"odd": {"deep": [1, None, "x"]}, "gain": 2} and second["a"] == {"tags": ["t", "u"], "gain": 2}


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def test_a_repeated_micro_batch_adds_no_line(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "log")
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text(json.dumps({"recording_id": f"r{i}", "decision": "ACCEPT"}))
    sink = runlog.run_log_sink(path, "hits")
    seen = []

    def twice(batch, number):
        """As when a driver dies between the sink and the stream's own commit."""
        seen.append(number)
        sink(batch, number)
        sink(batch, number)

    rows = stream(spark, source, "recording_id string, decision string")
    rows.writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and transactions.committed_lines(spark, path).count() == 3 and len(logged(spark, path)) == 3


def test_streamed_duplicates_are_those_of_the_batch(spark, tmp_path):
    rng = random.Random(4)
    base = [[rng.getrandbits(32) for _ in range(rng.choice((6, 8)))] for _ in range(120)]
    prints = []
    for i in range(900):  # more than one share of kept prints in a key
        fp = list(rng.choice(base)) if rng.random() < 0.5 else [rng.getrandbits(32) for _ in range(7)]
        for _ in range(rng.randint(0, 20)):
            fp[rng.randrange(len(fp))] ^= 1 << rng.randrange(32)
        prints.append({"category_slug": rng.choice("aab"), "ord": i, "fp": fp if i % 50 else [] if i % 100 else None})
    source = tmp_path / "in"
    source.mkdir()
    for at in range(0, 900, 300):
        (source / f"{at:04d}.json").write_text("\n".join(map(json.dumps, prints[at : at + 300])))
    schema = "category_slug string, ord bigint, fp array<bigint>"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = streamed_duplicates(stream(spark, source, schema), 0.90)
        done = out.writeStream.format("memory").queryName("decided").option("checkpointLocation", str(tmp_path / "cp"))
        done.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {r["ord"]: r["duplicate_of"] for r in spark.table("decided").collect()}
    table = spark.createDataFrame([(p["category_slug"], p["ord"], p["fp"]) for p in prints], schema)
    want = {}
    for slug in "ab":
        want |= {r["ord"]: r["duplicate_of"] for r in dedupe.greedy(table.where(F.col("category_slug") == slug).select("ord", "fp"), 0.90).collect()}
    assert got == want and sum(v is None for v in want.values()) > SHARE and sum(v is not None for v in want.values()) > 50

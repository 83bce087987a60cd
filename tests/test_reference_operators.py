import io
import json
import os
import re
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.functions import scoring, text
from gleaner.operators import audio, chain, dedupe, discovery, gates, models, relevance, splitter
from gleaner.plans import queries
from gleaner.sources import retry, runlog, search, storage
from gleaner.sources.settings import Settings, SettingsError, all_queries, categories, keywords, unknown_slugs
from gleaner.streaming import runlog as stream

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def norm(records):
    return sorted([["~" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r] for r in records])


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    mine = queries.QUERIES[name](spark, SF)
    columns = sorted(mine.columns)
    picked = ", ".join(f'"{c}"' for c in columns)
    theirs = con.execute(f"select {picked} from ({queries.ORACLE_SQL[name]})").fetchall()
    assert norm(map(tuple, mine.select(columns).collect())) == norm(theirs)


def test_rows_only_queries_run(spark):
    for name in set(queries.QUERIES) - set(queries.ORACLE_SQL):
        assert queries.QUERIES[name](spark, SF).count() > 0


RULES = gates.TextRules("[ఀ-౿]", ("telugu",), "[஀-௿]", ("tamil",), {"SPEECH": ("speech",), "NEWS": ("news", "செய்தி")})


@pytest.mark.parametrize(
    ("raw", "narration", "code"),
    [
        ("a tamil song", False, None),
        ("தமிழ் பாடல்", False, None),
        ("tamil speech", False, "SPEECH"),
        ("tamil speech", True, None),
        ("a speech", False, "NON_FOLK"),
        ("tamil telugu mix", False, "NON_FOLK"),
        ("tamilx", False, "NON_FOLK"),
        ("தமிழ் செய்தி", False, "NEWS"),
        ("tamil_news", False, "NEWS"),
        ("", False, "NON_FOLK"),
    ],
)
def test_text_gate(spark, raw, narration, code):
    df = spark.createDataFrame([(raw, narration)], "raw string, n boolean")
    assert df.select(gates.text_code(F.col("raw"), F.col("n"), RULES)).first()[0] == code


def test_duration_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (None, 0.0, 9.99, 10.0, 300.0, 300.01)], "s double")
    got = [r[0] for r in df.select(gates.duration_code(F.col("s"))).collect()]
    assert got == [None, None, "TOO_SHORT", None, None, "TOO_LONG"]


def test_weighted_mean_renormalises(spark):
    df = spark.createDataFrame([(0.8, None, 0.5, None), (None, None, None, None), (1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(gates.final_score(*map(F.col, "abcd"))).collect()]
    assert got == [0.7, 0.0, 1.0]


def test_final_rules(spark):
    schema = "q double, r double, m double, s double, l string, n boolean"
    cases = [
        ((0.54, 0.9, 0.9, 0.0, "SONG", False), "CODE"),
        ((0.55, 0.9, 0.9, 0.0, "SONG", False), None),
        ((0.9, 0.9, 0.1, 0.85, "SPEECH", False), "SPEECH"),
        ((0.9, 0.9, 0.1, 0.92, "SPEECH", True), None),
        ((0.9, 0.9, 0.1, 0.93, "SPEECH", True), "SPEECH"),
        ((0.9, 0.39, 0.24, 0.0, "UNKNOWN", False), "NON_SONG"),
        ((None, None, None, None, None, None), "NON_SONG"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], schema)
    score = gates.final_score(F.col("q"), F.col("r"), F.col("m"), F.col("s"))
    code = gates.final_code(F.col("q"), F.col("r"), F.col("m"), F.col("s"), F.col("l"), F.col("n"), score, F.lit("CODE"))
    assert [r[0] for r in df.select(code).collect()] == [c for _, c in cases]


def test_override_first_listed_wins_ties(spark):
    got = spark.range(1).select(gates.override_code([(F.lit(-0.1), "A"), (F.lit(-0.1), "B"), (F.lit(-5.0), "C")])).first()[0]
    assert got == "A"


def test_fold_and_chain(spark):
    df = spark.createDataFrame([(1, 1, "PASS", None), (1, 2, "REVIEW", None), (2, 1, "REVIEW", None), (2, 2, "REJECT", "X"), (3, 1, "PASS", None)], "id int, o int, decision string, rejection_code string")
    assert rows(gates.fold_decisions(df, "id", "o")) == [(1, "REVIEW", None), (2, "REJECT", "X"), (3, "ACCEPT", None)]
    chain = [("small", lambda d: d.withColumn("code", F.when(F.col("id") < 3, "LOW"))), ("odd", lambda d: d.withColumn("code", F.when(F.col("id") % 2 == 1, "ODD")))]
    out = gates.run_chain(spark.range(6), chain)
    assert rows(out) == sorted([(0, "small", "LOW"), (1, "small", "LOW"), (2, "small", "LOW"), (3, "odd", "ODD"), (4, "DONE", None), (5, "odd", "ODD")], key=str)


def test_hamming_similarity(spark):
    df = spark.createDataFrame([([1, -1], [1, 0xFFFFFFFF, 7]), ([], [1]), ([0], [0xFFFF])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in df.select(scoring.hamming_similarity(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.5]


def test_greedy_matches_one_pass(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 32, 12)
    prints = [[int(base[i % 12]) ^ int(sum(1 << b for b in rng.choice(32, rng.integers(0, 5), replace=False)))] for i in range(90)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "ord long, fp array<bigint>")
    pairs = dedupe.similar_pairs(df, 0.85)
    sim = lambda a, b: 1 - (a[0] ^ b[0]).bit_count() / 32
    expected, kept = {}, []
    for i, p in enumerate(prints):
        best = max(((sim(p, prints[k]), -k) for k in kept), default=(0, 0))
        expected[i] = -best[1] if best[0] >= 0.85 else None
        if expected[i] is None:
            kept.append(i)
    assert {r[0]: r[1] for r in dedupe.greedy(df, 0.85).collect()} == expected
    brute = {(i, j) for i in range(90) for j in range(i) if sim(prints[i], prints[j]) >= 0.85}
    assert {(r[0], r[1]) for r in pairs.collect()} == brute


def similarity(a, b):
    n = min(len(a), len(b))
    return 1 - sum(((x ^ y) & 0xFFFFFFFF).bit_count() for x, y in zip(a, b, strict=False)) / (32 * n) if n else 0.0


def test_prints_of_unequal_length(spark):
    rng = np.random.default_rng(9)
    base = [rng.integers(0, 1 << 32, 4) for _ in range(5)]
    prints = [[0, 123456], [0b10101]]
    for i in range(70):
        p = [int(w) for w in base[i % 5][: rng.integers(0, 5)]]
        prints.append([w ^ int(sum(1 << b for b in rng.choice(32, rng.integers(0, 4), replace=False))) for w in p] if i % 3 else p)
    df = spark.createDataFrame(list(enumerate(prints)), "ord long, fp array<bigint>")
    brute = {(i, j): similarity(prints[i], prints[j]) for i in range(len(prints)) for j in range(i)}
    near = {k: v for k, v in brute.items() if v >= 0.9}
    assert {(r["ord"], r["other"]): r["similarity"] for r in dedupe.similar_pairs(df, 0.9).collect()} == pytest.approx(near)
    assert (1, 0) in near
    best = {i: max((v, -j) for (k, j), v in near.items() if k == i) for i in {k for k, _ in near}}
    assert {r["ord"]: (r["similarity"], -r["duplicate_of"]) for r in dedupe.any_earlier(df, 0.9).collect()} == best
    for cut in (0, 20):  # the first rows that a pass keeps are the store of the next one
        kept, expected = [], {}
        for i in range(len(prints)):
            blockers = [(brute[i, k], -k) for k in kept if brute[i, k] >= 0.9]
            expected[i] = -max(blockers)[1] if blockers else None
            kept += [] if blockers else [i]
        stored = df.where(F.col("ord").isin([k for k in kept if k < cut])) if cut else None
        got = dedupe.greedy(df.where(F.col("ord") >= cut), 0.9, stored)
        assert {r["ord"]: r["duplicate_of"] for r in got.collect()} == {i: v for i, v in expected.items() if i >= cut}


def test_run_log_keeps_the_last_append(spark, tmp_path):
    log = str(tmp_path / "log")
    schema = "recording_id string, decision string"
    runlog.append_run_log(spark.createDataFrame([("a", "REJECT")], schema), log)
    many = spark.createDataFrame([(f"x{i}", "REVIEW") for i in range(20_000)] + [("a", "ACCEPT")], schema)
    runlog.append_run_log(many.repartition(3), log)
    assert runlog.read_run_log(spark, log).where("recording_id = 'a'").first()["decision"] == "ACCEPT"
    runlog.append_run_log(spark.createDataFrame([("a", "REVIEW")], schema), log)
    assert runlog.read_run_log(spark, log).where("recording_id = 'a'").first()["decision"] == "REVIEW"


def test_fingerprint_store_keeps_the_first(spark, tmp_path):
    store = str(tmp_path / "prints")
    schema = "recording_id string, duration double, fingerprint array<bigint>, ord int"
    runlog.append_fingerprints(spark.createDataFrame([("a", 2.0, [2], 1), ("a", 1.0, [1], 2)], schema), store, "ord")
    runlog.append_fingerprints(spark.createDataFrame([("a", 9.0, [9], 1), ("b", 1.0, [3], 1)], schema), store, "ord")
    assert rows(runlog.read_fingerprints(spark, store)) == [("a", 2.0, [2]), ("b", 1.0, [3])]


def test_long_verses(spark):
    one = [f"s{i % 7}" for i in range(10_000)]
    got = spark.createDataFrame([(". ".join(one),)] * 8, "v string").select(text.verses(F.col("v"))).collect()
    out, held, number = ["[Verse 1]"], 0, 1
    for s in one:
        out.append(s)
        held += 1
        if held >= 3 and s != one[-1]:
            number, held = number + 1, 0
            out += ["", f"[Verse {number}]"]
    assert all(r[0] == "\n".join(out) for r in got)


def test_noise_floor_and_rolloff_by_hand():
    rate, n = 8000, 8000 * 4
    y = np.sin(2 * np.pi * 1000 * np.arange(n) / rate) * np.linspace(0.01, 0.5, n)
    got = dict(zip((f.split()[0] for f in audio.METRICS.split(",")), audio.metrics(y, rate, 1), strict=True))
    rms = audio.frame_rms(y)
    low, high = 20 * np.log10(np.percentile(rms, 5)), 20 * np.log10(np.percentile(rms, 95))
    assert got["noise_floor"] == round(low, 2) and got["dynamic_range"] == round(high - low, 2)
    assert abs(got["rolloff"] - 1000) < 40
    frame = np.pad(y, 1024)[512 * 5 : 512 * 5 + 2048] * np.hanning(2049)[:-1]
    below = np.cumsum(np.abs(np.fft.rfft(frame)))
    assert audio.rolloffs(y, rate)[5] == np.flatnonzero(below >= 0.95 * below[-1])[0] * rate / 2048
    assert len(audio.rolloffs(y, rate)) == len(rms)


def test_discovery_stops_after_empty_rounds(spark):
    calls = []

    def fetch(n, _):
        calls.append(n)
        return spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)] if n == 1 else [("a", 1)], "recording_id string, ord int")

    out = discovery.discover(fetch, spark.createDataFrame([("b", 0)], "recording_id string, ord int"), max_rounds=9)
    assert rows(out) == [("a", 1, 1)] and calls == [1, 2, 3]


def test_text_functions(spark):
    df = spark.createDataFrame([("A. B! C? D|", "Official THE song  x", "https://y.example/watch?v=abcdefghijk&t=1"), ("...", "", "abc"), ("la. x. la. la", None, "")], "v string, m string, u string")
    got = df.select(text.verses(F.col("v")), text.strip_markers(F.col("m"), ["official", "the"]), text.media_id(F.col("u"))).collect()
    assert [r[0] for r in got] == ["[Verse 1]\nA\nB\nC\n\n[Verse 2]\nD", "[Verse 1]\n...", "[Verse 1]\nla\nx\nla\nla"]
    assert [r[1] for r in got] == ["song x", "", None]
    assert [r[2] for r in got] == ["abcdefghijk", "abc", ""]
    assert text.ratio("abc", "abd") == pytest.approx(66.667, abs=0.01)
    assert text.partial_ratio("abc", "xxabcxx") == 100 and text.token_set_ratio("b a", "a b c") == 100
    assert text.keyword_score("தமிழ் பாடல்", "பாடல்") == 100


def test_run_log(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    lines = [{"recording_id": "a", "decision": "REVIEW"}, {"decision": "x"}, {"recording_id": "a", "decision": "ACCEPT"}, {"recording_id": "b"}]
    (log / "x.json").write_text("\n\n{broken\n[1]\n" + "\n".join(map(json.dumps, lines)))
    got = runlog.read_run_log(spark, str(log))
    assert rows(got.select("recording_id", "decision")) == [("a", "ACCEPT"), ("b", "")]
    todo = runlog.unprocessed(spark.createDataFrame([("a",), ("c",)], "recording_id string"), got)
    runlog.append_run_log(todo.withColumn("decision", F.lit("REJECT")), str(log))
    again = spark.createDataFrame([("a",), ("c",)], "recording_id string")
    assert runlog.unprocessed(again, runlog.read_run_log(spark, str(log))).count() == 0
    store = str(tmp_path / "fp")
    fps = spark.createDataFrame([("a", 1.0, [1, 2]), ("e", 1.0, [])], "recording_id string, duration double, fingerprint array<bigint>")
    runlog.append_fingerprints(fps, store)
    runlog.append_fingerprints(fps.withColumn("duration", F.lit(9.0)), store)
    assert rows(runlog.read_fingerprints(spark, store)) == [("a", 1.0, [1, 2])]


def test_settings():
    assert Settings.from_mapping({"accept": 0.6}).accept == 0.6
    for bad in ({"accept": 0.4}, {"weights": {"quality": 0.9}}, {"min_quality": 0}, {"nope": 1}):
        with pytest.raises(SettingsError):
            Settings.from_mapping(bad)


def test_categories(spark):
    row = {"id": 1, "folder_slug": "a", "native_name": "n", "english_name": "e", "search_queries": {"v": ["q"]}}
    assert categories(spark, [row]).count() == 1
    for bad in ([row, row], [{**row, "english_name": ""}]):
        with pytest.raises(SettingsError):
            categories(spark, bad)


def test_search_source(spark):
    spark.dataSource.register(search.SearchSource)
    canned = {"q": [{"id": "1", "title": "t", "uploader": "u"}, None, {"title": "no id"}, {"id": "2"}], "r": [{"id": "3", "duration": 5}]}
    df = spark.read.format("gleaner_search").option("queries", json.dumps(["q", "r"])).option("canned", json.dumps(canned)).load()
    assert rows(df.select("recording_id", "channel", "duration_sec", "hit_ord")) == [("1", "u", 0.0, 0), ("2", "", 0.0, 1), ("3", "", 5.0, 0)]


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise OSError
        return "ok"

    assert retry.with_retry(flaky, sleep=lambda _: None) == "ok"
    with pytest.raises(retry.PermanentError):
        retry.with_retry(lambda: (_ for _ in ()).throw(retry.PermanentError()), sleep=lambda _: None)


def wav(y, rate=16000):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setparams((1, 2, rate, 0, "NONE", ""))
        f.writeframes((np.clip(y, -1, 1) * 32767).astype("<i2").tobytes())
    return bytearray(out.getvalue())


def test_audio_metrics(spark):
    time = np.arange(32000) / 16000
    sine = 0.5 * np.sin(2 * np.pi * 440 * time)
    gap = sine.copy()
    gap[14000:17000] = 0
    files = [("silence", wav(0 * sine)), ("sine", wav(sine)), ("square", wav(np.sign(sine))), ("gap", wav(gap)), ("empty", wav(sine[:0])), ("junk", bytearray(b"xx"))]
    got = {r["path"]: r for r in audio.measure(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert got["silence"]["silence"] == 1 and got["sine"]["silence"] == 0
    assert got["sine"]["rms"] == pytest.approx(0.3535, abs=1e-3) and got["sine"]["duration"] == 2
    assert got["square"]["clipping"] > 0.9 and got["gap"]["dropout"] > got["sine"]["dropout"] == 0
    assert got["empty"]["error"] and got["junk"]["error"] and got["junk"]["subtype"] is None and got["sine"]["subtype"] == "PCM_16"
    assert got["silence"]["lufs"] is None and -11 < got["sine"]["lufs"] < -9


def test_loudness():
    rate = 48000
    tone = np.sin(2 * np.pi * 997 * np.arange(rate * 5) / rate)
    assert audio.loudness(tone, rate) == pytest.approx(-3.0, abs=0.2)
    assert audio.loudness(tone, rate) - audio.loudness(tone / 10, rate) == pytest.approx(20, abs=1e-6)
    quiet_half = np.concatenate([tone, tone * 1e-3])
    assert audio.loudness(quiet_half, rate) == pytest.approx(audio.loudness(tone, rate), abs=0.3)
    assert audio.loudness(tone[: rate // 4], rate) is None and audio.loudness(np.zeros(rate), rate) is None
    # The same filters as a plain recursion over samples.
    x, out = tone[:3000], []
    a, c, s = 10 ** (4 / 40), np.cos(2 * np.pi * 1500 / rate), np.sin(2 * np.pi * 1500 / rate) / 2**0.5 * a_root(4)
    shelf = ([a * (a + 1 + (a - 1) * c + 2 * s), -2 * a * (a - 1 + (a + 1) * c), a * (a + 1 + (a - 1) * c - 2 * s)], [a + 1 - (a - 1) * c + 2 * s, 2 * (a - 1 - (a + 1) * c), a + 1 - (a - 1) * c - 2 * s])
    c, al = np.cos(2 * np.pi * 38 / rate), np.sin(2 * np.pi * 38 / rate)
    passed = ([(1 + c) / 2, -1 - c, (1 + c) / 2], [1 + al, -2 * c, 1 - al])
    for b, d in (shelf, passed):
        out = []
        for n in range(len(x)):
            past = sum(b[k] * x[n - k] - (d[k] * out[n - k] if k else 0) for k in range(3) if n >= k)
            out.append(past / d[0])
        x = np.array(out)
    n = 1 << 17
    assert np.fft.irfft(np.fft.rfft(tone[:3000], n) * audio._k_weighting(rate, n), n)[:3000] == pytest.approx(x, abs=1e-6)


def a_root(gain):
    return np.sqrt(10 ** (gain / 40))


def test_cuts():
    rms = np.ones(400)
    rms[[90, 210, 330]] = 0
    assert splitter.cuts(rms, 400, 1, 60, 100, 130) == [0, 90, 210, 330, 400]
    assert splitter.cuts(rms[:100], 100, 1, 60, 100, 130) == [0, 100]
    assert splitter.cuts(rms, 350, 1, 60, 100, 130) == [0, 90, 210, 350]  # a short rest takes the boundary before it along
    assert splitter.cuts(np.zeros(0), 250, 512, 60, 100, 130) == [0, 100, 250]  # no frame between the bounds: the target length
    assert splitter.cuts(rms, 0, 1, 60, 100, 130) == [0] and splitter.cuts(rms, 130, 1, 60, 100, 130) == [0, 130]


def test_streaming_counts(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").withColumn("decision", F.col("event_type")).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    run = stream.decision_counts(source).writeStream.outputMode("complete").format("memory").queryName("decision_counts").start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("decision_counts").agg(F.sum("count")).first()[0] == 1000
    keyed = source.withColumn("recording_id", F.col("user_id"))
    run = stream.first_seen(keyed, late="10000 days").writeStream.outputMode("append").format("memory").queryName("first_seen").start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("first_seen").count() == keyed_count(spark)


def keyed_count(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()


def test_verse_break_waits_behind_a_refrain(spark):
    df = spark.createDataFrame([("a. b. R. c. d. e. R",), (" \n\u00a0",), (None,)], "v string")
    got = [r[0] for r in df.select(text.verses(F.col("v"))).collect()]
    assert got[0] == "[Verse 1]\na\nb\nR\nc\n\n[Verse 2]\nd\ne\nR"
    assert got[1] == got[2] == "[Verse 1]\n[Instrumental / No Speech Detected]"


def test_responses_and_endpoints(spark):
    bodies = ['{"text": " x "}', '{"text": null, "transcript": "y"}', '{"result": ["a", {"text": "b"}]}', "[1]", "broken", None]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert [r[0] for r in df.select(text.response_text(F.col("b"))).collect()] == ["x", "y", "ab", "", "", ""]
    df = spark.createDataFrame([(u,) for u in ("h/", "h/api/transcribe", "h/transcribe", " ", None)], "u string")
    assert [r[0] for r in df.select(text.endpoint(F.col("u"))).collect()] == ["h/api/transcribe", "h/api/transcribe", "h/transcribe", "", ""]


def test_storage_round_trip(spark, tmp_path):
    decided = spark.createDataFrame([("a", "s1", "ACCEPT"), ("b", "s1", "REVIEW"), ("c", "s2", "ACCEPT")], "recording_id string, category_slug string, decision string")
    placed = storage.with_paths(decided, str(tmp_path / "store"), "tn")
    assert {r["recording_id"]: r["text_path"] is None for r in placed.collect()} == {"a": False, "b": True, "c": False}
    sound = placed.select(F.col("audio_path").alias("path"), F.lit(b"wave").alias("content"))
    words = placed.where("recording_id = 'a'").select(F.col("text_path").alias("path"), F.lit(b"w" * 30).alias("content"))
    for _ in range(2):
        storage.write_files(sound.unionByName(words))
    listing = storage.list_files(spark, str(tmp_path / "store")).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    assert listing.count() == 4 and storage.audio_files(spark, str(tmp_path / "store")).count() == 3
    missing = storage.missing_transcripts(listing)
    assert {os.path.basename(r["path"]) for r in missing.collect()} == {"b.wav", "c.wav"}
    assert storage.missing_transcripts(listing, force=True).count() == 3
    assert {r["recording_id"] for r in storage.stored(decided, listing, str(tmp_path / "store"), "tn").collect()} == {"a"}
    assert rows(storage.category_counts(listing, str(tmp_path / "store" / "tn"))) == [("s1", 2, 1, 0), ("s2", 1, 0, 0)]
    storage.write_manifest(placed.withColumn("state", F.lit("tn")), str(tmp_path / "manifest"))
    assert spark.read.parquet(str(tmp_path / "manifest")).where("category_slug = 's1'").count() == 2
    refused = storage.with_paths(spark.createDataFrame([("d", "s1", "REJECT")], decided.schema), "r", "tn")
    with pytest.raises(Exception, match="not stored: d"):
        refused.collect()


def test_parts_of_long_recordings(spark):
    rate = 8000
    y = np.sin(np.arange(rate * 4) / 9) * 0.5
    pieces = spark.createDataFrame([("a", 0, 0.0, 1.5), ("a", 1, 1.5, 4.0), ("b", 0, 0.0, 4.0)], "recording_id string, piece int, start_s double, end_s double")
    given = spark.createDataFrame([("a", "T", 4.0, "u"), ("b", "B", 4.0, "v"), ("c", "C", 1.0, "w")], "recording_id string, title string, duration_sec double, url string")
    parts = audio.part_candidates(given, pieces)
    got = rows(parts.select("recording_id", "parent_id", "title", "duration_sec"))
    assert got == [("a_p01", "a", "T (Part 1)", 1.5), ("a_p02", "a", "T (Part 2)", 2.5), ("b", "b", "B", 4.0), ("c", "c", "C", 1.0)]
    cut = audio.cut_files(parts.where("start_s is not null").withColumn("content", F.lit(audio.encode_wav(y, rate))))
    lengths = {r["recording_id"]: len(audio.decode_wav(bytes(r["content"]))[0]) for r in cut.collect()}
    assert lengths == {"a_p01": rate * 3 // 2, "a_p02": rate * 5 // 2}


def test_category_terms(spark):
    row = {"id": 1, "folder_slug": "s", "native_name": "N", "english_name": "Oosal / Oonjal song, oosal", "search_queries": {"tamil": ["q1", "n"], "english": ["q2"]}}
    known = categories(spark, [row])
    got = known.select(keywords(F.col("native_name"), F.col("english_name"), F.col("search_queries")["tamil"]).alias("k"), all_queries(F.col("search_queries")).alias("q")).first()
    assert got["k"] == ["N", "Oosal / Oonjal song, oosal", "Oosal", "Oonjal song", "q1"] and got["q"] == ["q1", "n", "q2"]
    candidates = spark.createDataFrame([("a", "s"), ("b", "x")], "recording_id string, category_slug string")
    assert [r[0] for r in unknown_slugs(candidates, known).select("recording_id").collect()] == ["b"]


def test_keywords_of_odd_rows(spark):
    many = ", ".join(f"{'Term' if i < 60 else 'TERM'} {i % 60}" for i in range(120))
    given = [("N", "a/b,A , ,b", ["n", " B", "c", None, "c "]), (None, "x", ["X"]), ("N", None, ["q"]), ("N", "e", None), ("", " ", []), ("\u0130", "i\u0307,\u039f\u03a3/\u03bf\u03c2,\u03bf\u03c3", []), ("m", many, [])]
    df = spark.createDataFrame(given, "native string, english string, queries array<string>")
    found = df.select(keywords(F.col("native"), F.col("english"), F.col("queries")).alias("k"))
    got = [r["k"] for r in found.collect()]
    assert got[:6] == [["N", "a/b,A , ,b", "a", "b", "c"], ["x"], None, ["N", "e"], [], ["\u0130", "i\u0307,\u039f\u03a3/\u03bf\u03c2,\u03bf\u03c3", "\u039f\u03a3", "\u03bf\u03c3"]]
    assert got[6] == ["m", many, *(f"Term {i}" for i in range(60))]
    looked_in = re.findall(r"array_position\((lambda \w+|\w+\()", found._jdf.queryExecution().optimizedPlan().toString())
    assert looked_in and all(x.startswith("lambda ") for x in looked_in)  # what is searched for each term is a variable, not an expression


def test_chain_calls_each_gate_once(spark):
    calls = {name: spark.sparkContext.accumulator(0) for name in ("two", "three", "five")}

    def gate(name, k):
        count = calls[name]

        def run(batches):
            for b in batches:
                count.add(len(b))
                yield b.assign(code=["X" if v % k == 0 else None for v in b["id"]])

        return lambda df: df.mapInPandas(run, "id long, code string")

    steps = [("two", gate("two", 2)), ("big", F.when(F.col("id") > 90, "BIG")), ("three", gate("three", 3)), ("five", gate("five", 5))]
    out = {r["id"]: r["stage"] for r in gates.run_chain(spark.range(100), steps).collect()}
    expected = {i: "two" if i % 2 == 0 else "big" if i > 90 else "three" if i % 3 == 0 else "five" if i % 5 == 0 else "DONE" for i in range(100)}
    assert out == expected
    assert {k: v.value for k, v in calls.items()} == {
        "two": 100,
        "three": sum(1 for s in expected.values() if s not in ("two", "big")),
        "five": sum(1 for s in expected.values() if s in ("five", "DONE")),
    }


def test_gate_result_rejects_with_a_code_alone(spark):
    df = spark.createDataFrame([("C", True, 0.5), (None, True, 0.5), (None, None, None)], "code string, review boolean, score double")
    got = df.select(gates.gate_result("s", F.col("code"), F.col("review"), F.col("score")).alias("r")).collect()
    assert [tuple(r["r"]) for r in got] == [("s", "REJECT", "C", None), ("s", "REVIEW", None, 0.5), ("s", "PASS", None, None)]


def test_quality_override_ties_and_unknown_metrics(spark):
    limits = {"silence": 0.5, "clipping": 0.5, "snr": 5.0, "noise_floor": -25.0, "dynamic_range": 4.0, "dropout": 0.5, "rolloff": 3000.0}
    none = F.lit(None).cast("double")
    known = {k: none for k in limits}
    codes = spark.range(1).select(
        gates.quality_override(known, limits), gates.quality_override({**known, "snr": F.lit(2.0), "dynamic_range": F.lit(1.0)}, limits)
    ).first()
    assert tuple(codes) == ("MOSTLY_SILENT", "VERY_LOW_SNR")


def test_batch_model_asks_for_active_rows_only(spark):
    asked = spark.sparkContext.accumulator(0)

    def load():
        def model(values):
            if (values == 13).any():
                raise ValueError("bad row")
            asked.add(len(values))
            return values * 2.0

        return model

    use = models.batch_model(load, "double")
    out = spark.range(0, 40, numPartitions=2).withColumn("y", use(F.col("id") % 2 == 1, F.col("id")))
    assert {r["id"]: r["y"] for r in out.where("id >= 0").collect()} == {i: 2.0 * i if i % 2 and i != 13 else None for i in range(40)}
    assert asked.value == 19


def test_relevance_concepts_and_band(spark):
    df = spark.createDataFrame([([], "harvest"), (["x"], "harvest"), (None, "boat")], "c array<string>, e string")
    got = [r[0] for r in df.select(relevance.concepts(F.col("c"), F.col("e"))).collect()]
    assert got == [["Tamil folk harvest traditional song"], ["x"], ["Tamil folk boat traditional song"]]
    refs = F.array(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.6), F.lit(0.8)))
    none = F.expr("cast(null as array<double>)")
    one = spark.range(1).select(
        relevance.best_similarity(F.array(F.lit(0.0), F.lit(1.0)), refs), relevance.best_similarity(none, refs),
        relevance.best_similarity(F.array(F.lit(1.0)), F.expr("cast(array() as array<array<double>>)")),
    ).first()
    assert tuple(one) == (0.8, None, 0.0)
    sims = spark.createDataFrame([(0.24, 0.5), (0.5, 0.1), (0.24, None), (None, 0.9)], "a double, b double")
    blended = [r[0] for r in sims.select(relevance.blend(F.col("a"), F.col("b"))).collect()]
    assert blended == [pytest.approx(0.37), 0.5, 0.24, None]
    assert sims.select(relevance.relevance_result(F.col("a")).alias("r")).first()["r"].rejection_code == "NON_FOLK"


GOOD = {"duration": 60.0, "silence": 0.0, "clipping": 0.0, "dynamic_range": 30.0, "snr": 30.0, "noise_floor": -60.0, "dropout": 0.0, "rolloff": 8000.0,
        "sample_rate": 44100.0, "lufs": -14.0}
CANDIDATE = {"category_slug": "c", "raw": "tamil song", "narration": False, "best": 90.0, "hits": 1, "duration": 60.0,
             "probe": {"exists": True, "size": 9, "frames": 9, "has_stream": True, "container": 60.0, "pcm": 60.0},
             "metrics": GOOD, "fp": None, "music": 0.9, "speech": 0.1, "vocal": 0.8, "similarity": 0.6}
CHAIN = """recording_id string, ord long, category_slug string, raw string, narration boolean, best double, hits int, duration double,
    probe struct<exists: boolean, size: long, frames: long, has_stream: boolean, container: double, pcm: double>,
    metrics struct<duration: double, silence: double, clipping: double, dynamic_range: double, snr: double, noise_floor: double, dropout: double, rolloff: double,
      sample_rate: double, lufs: double>, fp array<bigint>, music double, speech double, vocal double, similarity double"""


def test_candidates_meet_every_gate_in_order(spark):
    weak = {**GOOD, "silence": 0.44, "clipping": 0.03, "snr": 6.0, "noise_floor": -26.0, "dynamic_range": 5.0}
    cases = [
        ({}, ("final_scoring", "ACCEPT", None, 8)),
        ({"raw": "telugu tamil"}, ("metadata_gate", "REJECT", "NON_FOLK", 1)),
        ({"best": 61.0}, ("metadata_gate", "REJECT", "NON_FOLK", 1)),
        ({"best": 65.0}, ("final_scoring", "REVIEW", None, 8)),
        ({"duration": 301.0}, ("metadata_gate", "REJECT", "TOO_LONG", 2)),
        ({"duration": None}, ("final_scoring", "ACCEPT", None, 8)),
        ({"probe": {**CANDIDATE["probe"], "frames": 0}}, ("integrity_gate", "REJECT", "CORRUPT_AUDIO", 3)),
        ({"metrics": {**GOOD, "silence": 0.46}}, ("quality_gate", "REJECT", "MOSTLY_SILENT", 4)),
        ({"metrics": weak, "similarity": 0.98}, ("final_scoring", "REJECT", "MOSTLY_SILENT", 5)),
        ({"similarity": 0.2}, ("folk_relevance_gate", "REJECT", "NON_FOLK", 7)),
        ({"similarity": None}, ("final_scoring", "REVIEW", None, 9)),
        ({"similarity": 0.3}, ("final_scoring", "REVIEW", None, 9)),
        ({"fp": [5]}, ("final_scoring", "ACCEPT", None, 9)),
        ({"fp": [5]}, ("duplicate_gate", "REJECT", "DUPLICATE_RECORDING", 8)),
        ({"fp": [99 << 20]}, ("duplicate_gate", "REJECT", "DUPLICATE_RECORDING", 8)),
        ({"music": 0.1, "speech": 0.9}, ("final_scoring", "REJECT", "SPEECH", 9)),
    ]
    df = spark.createDataFrame([{**CANDIDATE, "recording_id": str(i), "ord": i, **x} for i, (x, _) in enumerate(cases)], CHAIN)
    stored = spark.createDataFrame([(-1, [99 << 20])], "ord long, fp array<bigint>")
    steps = {"metadata_gate": 2, "integrity_gate": 3, "quality_gate": 4, "folk_relevance_gate": 7, "duplicate_gate": 8}
    heard = spark.sparkContext.accumulator(0)

    def signals(rows):
        def run(batches):
            for b in batches:
                heard.add(len(b))
                yield b[["ord"]]

        counted = rows.mapInPandas(run, "ord long")
        return rows.join(counted, "ord").join(df.select("ord", *chain.HEARD), "ord")

    bare = df.drop(*chain.HEARD)
    for out in (chain.decide(df, RULES, stored=stored), chain.decide(bare, RULES, signals, stored)):
        out = out.persist()
        got = {r["recording_id"]: r for r in out.collect()}
        for i, (x, (stage, decision, code, reached)) in enumerate(cases):
            r = got[str(i)]
            assert (r["stage"], r["decision"], r["rejection_code"]) == (stage, decision, code), (i, x, r)
            assert [s["stage"] for s in r["results"]][-1] == stage
            assert len(r["results"]) == (reached if stage in steps else 5 if x.get("metrics") is weak else 9)
            assert (r["final_score"] is None) == (stage != "final_scoring")
        assert rows(chain.new_prints(out)) == [("12", [5])]
        out.unpersist()
    assert heard.value == 10
    none = chain.decide(df.limit(0), RULES, stored=stored)
    assert none.count() == 0


def test_pending_and_addresses(spark):
    made = chain.address_candidates(spark.createDataFrame([(" https://x.example/watch?v=abcdefghijk",), ("abcdefghijl",)], "url string"), "c")
    assert rows(made.select("recording_id", "category_slug", "title")) == [("abcdefghijk", "c", ""), ("abcdefghijl", "c", "")]
    ids = lambda *x: spark.createDataFrame([(v,) for v in x], "recording_id string")
    assert rows(chain.pending(ids("a", "b", "c"), ids("a"), ids("b"))) == [("c",)]


def canned(query, most):
    """A search for the data source test: named by module and function."""
    return [{"id": f"{query}{i}"} for i in range(most + 5)]


def test_search_rounds_expand_channels(spark):
    asked = spark.sparkContext.accumulator(0)
    tables = {"q": [{"id": "1", "channel_id": "UCa"}, {"id": "2", "channel_id": "UCb"}, {"id": "3", "channel_id": "UCb"}, {"id": "4", "channel_id": "zz"}],
              "r": [{"id": "2"}, {"id": "5"}], "list/UCb": [{"id": "6"}, {"id": "1"}], "list/UCa": [{"id": "7"}], "list/zz": [{"id": "8"}]}

    def fetch(query, most):
        asked.add(1)
        if query == "broken":
            raise ValueError("no answer")
        return tables[query]

    queries_ = spark.createDataFrame([("q", 0), ("broken", 1), ("r", 2)], "query string, source_ord int")
    seen = spark.createDataFrame([("3",)], "recording_id string")
    found = discovery.search_rounds(queries_, lambda q, m: fetch(q, m), seen, channels=1, listing="list/%s")
    assert [(r["recording_id"], r["round"]) for r in found.orderBy("round", "place").collect()] == [("1", 1), ("2", 1), ("4", 1), ("5", 1), ("7", 2)]
    spark.dataSource.register(search.SearchSource)
    df = spark.read.format("gleaner_search").option("queries", json.dumps(["a", "b"])).option("limit", "2").option("fetch", f"{__name__}:canned").load()
    assert rows(df.select("recording_id")) == [("a0",), ("a1",), ("b0",), ("b1",)]


def test_settings_file(tmp_path):
    from gleaner.sources import settings

    pytest.importorskip("yaml")
    path = tmp_path / "s.yaml"
    body = {k: {} for k in settings.SECTIONS} | {"scoring": {"accept_threshold": 0.6, "review_threshold": 0.3, "weights": {"quality": 0.7, "folk_relevance": 0.1, "music_speech": 0.1, "vad": 0.1}}}
    path.write_text(json.dumps(body))  # JSON is YAML
    s = Settings.from_file(str(path))
    assert (s.accept, s.review, s.min_quality, s.weights["relevance"]) == (0.6, 0.3, 0.55, 0.1)
    path.write_text(json.dumps({k: v for k, v in body.items() if k != "vad"}))
    with pytest.raises(SettingsError, match="vad"):
        Settings.from_file(str(path))
    path.write_text(json.dumps(body | {"scoring": {"accept_threshold": 0.2}}))
    with pytest.raises(SettingsError):
        Settings.from_file(str(path))


def test_seeded_order_and_decibels(spark):
    ids = spark.range(50).select(F.col("id").cast("string").alias("v"))
    order = lambda seed: [r[0] for r in ids.orderBy(discovery.seeded_order(F.col("v"), seed)).collect()]
    assert order(1) == order(1) != order(2) and sorted(order(1)) == sorted(order(2))
    got = [r[0] for r in spark.createDataFrame([(1.0,), (0.1,), (0.0,)], "x double").select(scoring.decibels(F.col("x"))).collect()]
    assert got == pytest.approx([0.0, -20.0, -200.0])

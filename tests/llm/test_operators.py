"""Each corpus operator against a plain version, on rows with nulls, ties, repeats and odd texts."""

import collections
import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import bpe, chat, fingerprints, graph, mixing, pii, sharding, simhash, suffixes, topk, toxicity
from gleaner.llm.cdc import Sizes, cut_points
from gleaner.llm.graph import connected_components

from .test_jaccard import plain as plain_similar

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefghiéñß") for _ in range(rng.randint(2, 8))) for _ in range(300)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = [prose(rng.randint(3, 200)) for _ in range(40)]
TEXTS = [*BASE, BASE[0], BASE[0], BASE[1] + " x", None, "", " \t\n", "one", "Two words", prose(15000), "z" * 5000, "mail a.b@c.de or +1 (234) 555-1234, 10.0.0.1, 4111 1111 1111 1111"]


def table(spark, texts=TEXTS, ids=None):
    rows = [(i if ids is None else ids[i], t, None if i % 9 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    extra = {c: F.lit("clash") for c in ("fp", "cdf", "parts", "first_id", "key", "score", "node", "range", "size", "copy", "shard", "_level")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(extra)


@pytest.fixture
def docs(spark):
    return table(spark)


def found(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# 1 SimHash


def plain_components(fps):
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in fps:
        for j in fps:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in fps}


@pytest.mark.parametrize("hot", [1, 256])
def test_simhash(spark, docs, hot):
    got = found(simhash.near_duplicates(docs, hot))
    fps = {i: simhash.fingerprint_of(t) & (2**64 - 1) for i, t in enumerate(TEXTS)}
    assert {i: r["fp"] & (2**64 - 1) for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(fps)


def test_simhash_links_of_close_fingerprints(spark):
    seed = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for s in seed for _ in range(40)})
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    expected = plain_components(dict(enumerate(fps)))
    for hot, parts in ((2, None), (10_000, None), (10_000, 6), (10_000, 8), (10_000, 12)):
        groups = {r["node"]: r["component"] for r in connected_components(simhash.fingerprint_links(nodes, hot, parts)).collect()}
        assert {i: groups.get(i, i) for i in expected} == expected


@pytest.mark.parametrize("block", [4, 1 << 18])
def test_components_of_paths_hubs_and_loops(spark, monkeypatch, block):
    """The least node of each component, in few rounds; a block may hold a part of the links only."""
    written = []
    made = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df: (written.append(df), made(df))[1])
    monkeypatch.setattr(graph, "BLOCK", block)
    rng = random.Random(3)
    ids = rng.sample(range(-500, 500), 60)
    path = list(zip(ids, ids[1:], strict=False))
    hub = [(5000, i) for i in range(1000, 1060)] + [(i, 7000 + i) for i in range(1000, 1010)]
    links = [*path, *hub, (1 << 40, 1 << 41), (1 << 41, 1 << 40), (9, 9), (None, 3)]
    root = {n: n for link in [*path, *hub, (1 << 40, 1 << 41)] for n in link}
    for a, b in [*path, *hub, (1 << 40, 1 << 41)]:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = {n: new if r == old else r for n, r in root.items()}
    rows = connected_components(spark.createDataFrame(links, "u long, v long").repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(root.items())
    assert len(written) <= (2 if block > 4 else 12)


def test_simhash_fingerprint_by_hand():
    import xxhash

    h = [xxhash.xxh64_intdigest(s, seed=42) for s in (b"a b c", b"b c d")]
    assert simhash.fingerprint_of("A b\tC\x0bd") & (2**64 - 1) == h[0] & h[1]
    assert simhash.fingerprint_of("a  b") & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b", seed=42)


def test_drop_near_duplicates(spark, docs):
    kept = [r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()]
    expected = plain_components({i: simhash.fingerprint_of(t) & (2**64 - 1) for i, t in enumerate(TEXTS)})
    assert sorted(kept) == sorted(set(expected.values()))
    assert simhash.drop_near_duplicates(table(spark, ["a", "a"], [None, None])).count() == 2
    again = simhash.drop_near_duplicates(table(spark, ["first text", "another text", "a third text"], [4, 4, 9]))
    least = min(["first text", "another text"], key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert [(r["doc_id"], r["text"]) for r in again.orderBy("doc_id").collect()] == [(4, least), (9, "a third text")]


# 2 toxicity


def test_toxicity_held_out(spark):
    texts, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        body = prose(rng.randint(30, 80)).split()
        for _ in range(4 if toxic else 0):
            body.insert(rng.randrange(len(body)), rng.choice(["nasty", "vile", "awful"]))
        texts.append(" ".join(body))
        labels.append((i, int(toxic)))
    texts += [None, ""]
    docs = table(spark, texts, [*range(900), None, 901])
    marks = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.score_documents(docs, marks).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["doc_id"] is None or crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean([r["predicted"] == (r["doc_id"] % 6 == 0) for r in held]) > 0.97
    assert toxicity.drop_toxic(docs, marks).columns == docs.columns
    none = toxicity.score_documents(docs, marks.limit(0))
    assert none.agg(F.max("score")).first()[0] == 0


def test_toxicity_gradient():
    gen = np.random.default_rng(4)
    pos, unl = gen.normal(size=(20, 5)), gen.normal(size=(60, 5))
    for scale in (0.1, 8.0):  # the second drives the risk of negatives below zero
        w = gen.normal(size=6) * scale
        for a, b, prior in ((pos, unl, 0.2), (pos, pos, 0.9), (pos, -pos, 0.9)):
            whole = lambda x: sum(r) if (r := toxicity.risk(x, a, b, prior))[1] >= 0 else -r[1]  # noqa: B023, E731
            steps = [(whole(w + h) - whole(w - h)) / 2e-6 for h in np.eye(6) * 1e-6]
            assert toxicity.risk_gradient(w, a, b, prior) == pytest.approx(steps, abs=1e-5)


def test_toxicity_learns_from_long_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda keep, dense, positive, prior: seen.append(len(dense)) or toxicity.Model({}, None))
    ids = [i for i in range(100) if crc32(str(i).encode()) % 3 != 1][:30]
    texts = [("vile " if i % 2 else "mild ") * 9000 for i in range(30)]
    labels = spark.createDataFrame([(d, i % 2) for i, d in enumerate(ids)], "doc_id long, toxic int")
    toxicity.train(table(spark, texts, ids), labels)
    assert seen == [45]


def test_toxicity_sample_size():
    assert (toxicity.MAX_POSITIVE, toxicity.MAX_UNLABELLED) == (3000, 6000)


def test_toxicity_learns_from_one_row_of_an_id(spark, monkeypatch):
    texts = [f"{'vile' if i % 4 == 0 else 'mild'} {prose(20)}" for i in range(200)]
    ids = [i for i in range(2000) if crc32(str(i).encode()) % 3 != 1][:200]
    labels = spark.createDataFrame([(d, int(i % 4 == 0)) for i, d in enumerate(ids)], "doc_id long, toxic int")
    rows = []
    monkeypatch.setattr(toxicity, "fit", lambda keep, dense, positive, prior: rows.append((len(dense), positive.sum())) or toxicity.Model({}, None))
    toxicity.train(table(spark, [*texts, *([texts[0] + " again"] * 300)], [*ids, *([ids[0]] * 300)]), labels)
    assert rows == [(250, 50)]


# 3 BPE


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(bpe.default_tokenizer())
    rows = docs.unionByName(docs.where("doc_id = 2"))
    got = bpe.encode_digests(rows).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        ids = whole.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), digest, decoded)
    real = found(bpe.encode_documents(docs))
    assert real[47]["ids"] == whole.encode("Two words", add_special_tokens=False).ids if TEXTS[47] == "Two words" else True


def test_bpe_words_and_joints():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(bpe.default_tokenizer()), bpe.Encoder(bpe.default_tokenizer())
    parts = ["<|endoftext|>", "don't", "'s", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "É", "é", "ς", "Σ", "İ", "漢", "字1", "🙂", "<|start", "a", "b!!", "%%%"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert own.unpack(own.encode(text)) == whole.encode(text, add_special_tokens=False).ids
    text = prose(500)
    at = [i for i, c in enumerate(text) if c == " " and text.isascii()] or [i for i, c in enumerate(text.encode()) if c == 32]
    data = text.encode()
    known = [(at[i], at[i + 9], own.encode(data[at[i] : at[i + 9]].decode())) for i in range(5, 400, 20)]
    assert bpe.assemble(own, text, known) == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_repairs_joints(name):
    """Texts put together from stretches that are cut anywhere, against the whole library call."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    whole, own = Tokenizer.from_file(path), bpe.Encoder(path)
    repaired = 0
    for _ in range(60):
        text = "".join(rng.choice(["Some", "words", " ", "  ", "\n", "\n\n", " \n ", "it's", "...", "été", "12345", " a", "\t"]) for _ in range(120))
        data = text.encode()
        ends = sorted(i for i in rng.sample(range(len(data) + 1), 12) if i == len(data) or data[i] & 0xC0 != 0x80)
        known = [(a, b, own.encode(data[a:b].decode())) for a, b in zip(ends[::2], ends[1::2], strict=False)]
        ids = whole.encode(text, add_special_tokens=False).ids
        assert bpe.assemble(own, text, known) == ids
        parts = [0, *(i for k in known for i in k[:2]), len(data)]
        apart = [t for a, b in zip(parts, parts[1:], strict=False) for t in whole.encode(data[a:b].decode(), add_special_tokens=False).ids]
        repaired += apart != ids
    assert repaired > 30


def test_bpe_other_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    passage = prose(1500)
    texts = [f"{prose(30)}\n{passage}  {prose(20)}" for _ in range(6)] + ["", None, " \n"]
    for i, r in found(bpe.encode_documents(table(spark, texts), path)).items():
        ids = whole.encode(texts[i] or "", add_special_tokens=False).ids
        assert (r["ids"], r["decoded"]) == (ids, whole.decode(ids, skip_special_tokens=False))


# 4 top-k


def test_top_k(spark):
    gen = np.random.default_rng(5)
    vectors = [(i, gen.normal(size=8).round(2).tolist()) for i in range(300)]
    vectors += [(300, None), (350, [float("nan")] * 8), (400, [None] * 8), (450, []), (500, [1.0, 2.0]), (None, [1.0] * 8), (301, vectors[7][1]), (302, vectors[7][1]), (550, [1e6] * 8), (600, [1e6] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in topk.top_k(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q in [i for i in whole if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=True)), i) for i, w in whole.items() if i != q and len(w) == len(whole[q]))
        assert got[q] == [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_beyond_one_block(spark, monkeypatch):
    gen = np.random.default_rng(6)
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, gen.normal(size=6 + i % 2).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    whole = {r["vec_id"]: np.floor(np.array(r["embedding"]) * 256).astype(int) for r in df.collect()}
    got = collections.defaultdict(list)
    for r in topk.top_k(df, df.where("vec_id % 10 = 0"), 3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    assert got == {q: sorted((-int(v @ w), i) for i, w in whole.items() if i != q and len(w) == len(v))[:3] for q, v in whole.items() if q % 10 == 0}


def test_top_k_never_shuffles_tiles(spark):
    tiles = spark.createDataFrame([], "tile long, dim int, ids binary, data binary")
    asked = spark.createDataFrame([], "vec_id long, dim int, v array<double>, block int, cut long")
    plan = topk._met(tiles, asked)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and len(re.findall(r"\bExchange hashpartitioning", plan)) == 1 and "hashpartitioning(block" in plan


def test_top_k_prunes():
    gen = np.random.default_rng(7)
    rows = gen.normal(size=(3000, 64))
    rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1)[:, None])
    q = rows[::50]
    own = topk._own(np.arange(0, 3000, 50), np.arange(3000))
    qi, vi = topk.leaders(q, rows, own, 40)
    assert len(qi) <= 4 * 40 * len(q)
    scores = q @ rows.T
    scores[own] = -np.inf
    reached = np.zeros(scores.shape, bool)
    reached[qi, vi] = True
    cuts = np.sort(np.where(reached, scores, -np.inf), axis=1)[:, -5].astype(np.int64)
    qi, vi, got, scored = topk.reaching(q, rows, cuts, own)
    assert set(zip(qi, vi, strict=True)) == set(zip(*np.nonzero(scores >= cuts[:, None]), strict=True))
    assert (got == scores[qi, vi]).all() and scored < 0.25 * scores.size


@pytest.mark.parametrize("scale, kind", [(256, np.float32), (1 << 20, np.float64), (1 << 28, object)])
def test_top_k_numbers(scale, kind):
    gen = np.random.default_rng(8)
    rows = gen.normal(size=(600, 16))
    rows = np.floor(scale * rows / np.linalg.norm(rows, axis=1)[:, None])
    rows[300:400] = rows[7]  # copies
    ids = np.arange(600)
    q, v = topk._numbers(rows[::50], rows)
    assert q.dtype == v.dtype == kind
    own = topk._own(ids[::50], ids)
    at, score = topk._best(topk.leading(q, v, own, 600), 5)
    exact = [[(sum(int(x) * int(y) for x, y in zip(a, b, strict=True)), j) for j, b in enumerate(rows) if j != i * 50] for i, a in enumerate(rows[::50])]
    best = [sorted((s for s, _ in r), reverse=True)[:5] for r in exact]
    assert [[int(s) for s in score[at == i]] for i in range(12)] == best
    cuts = np.array([b[-1] for b in best])
    qi, vi, got, scored = topk.reaching(q, v, cuts, own)
    assert sorted(zip(qi.tolist(), vi.tolist(), map(int, got), strict=True)) == sorted((i, j, s) for i, r in enumerate(exact) for s, j in r if s >= cuts[i])
    assert scored < 0.5 * len(q) * len(v)


def test_top_k_cutoffs_take_one_exchange_of_scores(spark):
    tiles = spark.createDataFrame([], "dim int, ids binary, data binary")
    asked = spark.createDataFrame([], "vec_id long, dim int, v array<double>, block int, cut long")
    plan = topk._cutoffs(tiles, asked, 5)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"\bExchange hashpartitioning\((\w+?)#", plan) == ["query_id", "block"] and "Aggregate" not in plan


def test_top_k_odd_rows(spark):
    given = [(1, [0.5, float("inf")]), (2, [float("-inf"), 0.0]), (3, [None, 1.0]), (50, [1.0, -0.004]), (50, [1.0, -0.004]), (4, [0.0, 0.0]), (4, [0.0, 0.0]), (100, [1.0]), (5, [2.0]), (150, None)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(50, 1, 4, 0), (50, 2, 4, 0), (100, 1, 5, 256 * 512)]


# 5 PII

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()  # noqa: B023
            out += [(kind, *m.span())] if fits else []
    return out


def test_pii_base_spans():
    for _ in range(8000):
        text = "".join(rng.choice("a1@.-+ 9()x%é_255") for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_base(text)
    for _ in range(4000):
        text = "".join(rng.choice(["4111 1111 1111 1111", "4111 1111 1111 1112", " +1 234 555 1234", "+1", " 555-123-4567", "a@b.c", "a (at) b.com", "1.2.3.4", "1.2.3.400", " "]) for _ in range(rng.randint(1, 9)))
        good, more = pii.candidates(text)
        assert not any(g[0] == s[0] and g[1] < s[2] and s[1] < g[2] for g in good for s in more)
    pii.candidates("4111 1111 1111 1111, 4111 1111 1111 1112, " * 30_000)
    for long in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000):
        pii.base_spans(long)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_query(spark, docs):
    got = found(pii.summarize(pii.find_spans(docs)))
    for i, t in enumerate(TEXTS):
        base = plain_base(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[i]["spans"].split(","))
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
    masked = found(pii.redact(docs))
    assert masked[len(TEXTS) - 1]["text"] == "mail [EMAIL] or [PHONE], [IP], [CARD]"
    assert masked[len(TEXTS) - 1]["n_chars"] == 37 and masked[0]["text"] == TEXTS[0]


@pytest.mark.parametrize(
    "text", ["call 555.123.4567 now", "(555) 123 4567", "jane (AT) host.com", "jane [ at ] host [ dot ] com", "jane [At] host (DOT) com"]
)
def test_pii_near_misses_stand_alone(text):
    kind = "phone" if "555" in text else "email"
    assert [s[0] for s in pii.candidates(text)[1]] == [kind]
    assert pii.candidates(text + " -at)")[1] == pii.candidates(text)[1]


def test_pii_parts_of_failed_matches():
    text = "call +1 (269) 555-3296 4111 1111 1111 1111 2 or +1"
    good, more = pii.candidates(text)
    found = {(s[0], text[s[1] : s[2]]) for s in more}
    assert not good and {("phone", "+1 (269) 555-3296"), ("card", "4111 1111 1111 1111")} <= found
    pii.candidates("1 " * 50_000 + "+1 " * 50_000)


def test_pii_added_spans(spark):
    """Precision and recall of what the classifier adds, on planted spans that no base pattern gives."""
    card = lambda: (c := "4" + "".join(rng.choice("0123456789") for _ in range(14))) + next(d for d in "0123456789" if pii.luhn(c + d))
    phone = lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
    texts, planted = [], set()
    for i in range(600):
        parts, hidden = [prose(rng.randint(3, 20)) + "."], None
        if i % 3 == 0:
            parts += [rng.choice([phone, card, lambda: f"u{i}@mail.example.com", lambda: f"10.{i % 256}.7.9"])()]
        elif i % 10 == 1:
            hidden = [("phone", phone()), ("card", card())]
            parts += [f"{hidden[0][1]} {hidden[1][1]}"]
        elif i % 10 == 2:
            parts += [rng.choice(["order " + "".join(rng.choice("0123456789") for _ in range(25)), "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1", "+1 2 3 4 5 6 7", "300.300.1.1"])]
        text = " ".join([*parts, prose(6)])
        texts.append(text)
        planted |= {(i, k, text.index(v), text.index(v) + len(v)) for k, v in hidden or ()}
    got = pii.find_spans(table(spark, texts)).collect()
    added = set()
    for r in got:
        extra = set(filter(None, r["spans"].split(","))) - set(filter(None, r["base"].split(",")))
        added |= {(r["doc_id"], *(x if n == 0 else int(x) for n, x in enumerate(s.split(":")))) for s in extra}
    assert len(planted) >= 80
    assert len(added & planted) >= 0.95 * len(planted) and len(added & planted) >= 0.95 * len(added), [(s, texts[s[0]][s[2] : s[3]]) for s in added - planted]


def test_pii_em_by_hand():
    """Two labelers that agree and one at random: EM finds which are reliable."""
    gen = np.random.default_rng(8)
    truth = gen.random(4000) < 0.5
    vote = lambda right: np.where(gen.random(4000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
    seen = np.stack([vote(0.95), vote(0.9), vote(0.5), vote(0.9), vote(0.9)], axis=1)
    patterns, place, n = np.unique(seen, axis=0, return_inverse=True, return_counts=True)
    p = pii.reliabilities(patterns, n.astype(float))
    assert np.mean((p > 0.5)[place.ravel()] == truth) > 0.97
    flipped = patterns.copy()
    flipped[:, 2] *= -1
    other = {tuple(r): x for r, x in zip(patterns, p, strict=True)}
    assert all(abs(other[tuple(r)] - x) < 0.2 for r, x in zip(flipped, p, strict=True) if tuple(r) in other)


def test_pii_reliabilities():
    votes = np.array([[1, 1, 1, 0, 1], [-1, -1, -1, -1, -1], [-1, 1, 1, 0, 1]])
    true = pii.reliabilities(votes, np.array([100.0, 100.0, 1.0]))
    assert true[0] > 0.95 and true[1] < 0.05


# 6 mixing


def test_mixing_matches_duckdb(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "copy", "shuffle_key")
    expected = con.execute(f"select doc_id, copy, shuffle_key from ({mixing.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_mixing_reaches_weights(spark):
    rows = [(i, "t", "en", "big" if i % 100 else None, 1) for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cdf", F.lit(1))
    got = {r["source"]: r["count"] for r in mixing.mix(df).groupBy("source").count().collect()}
    assert abs(got["big"] - 10_000) < 500 and abs(got[None] - 10_000) < 500
    only = mixing.mix(df, {"big": 1.0})
    assert {r[0] for r in only.select("source").distinct().collect()} == {"big"} and "cdf" in only.columns


# 7 fingerprints


def test_edited_likeness(spark, docs):
    got = found(fingerprints.edited_likeness(docs))
    texts = [t or "" for t in TEXTS]
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprints.fingerprint(t), fingerprints.fingerprint(changed))
        assert r["near_edited"] == fingerprints.containment(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == fingerprints.containment(r["fingerprint"], fingerprints.fingerprint(following))
    alone = fingerprints.edited_likeness(table(spark, ["abcd"])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abca").hexdigest()
    assert fingerprints.edited_likeness(table(spark, ["a", "b", "c"], [None, 4, 4])).count() == 3


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: None if i % 3 == 0 else i, lambda i: 7 if i % 2 else i, lambda i: None, lambda i: -i])
def test_edited_likeness_over_many_ranges(spark, ids):
    texts = [prose(rng.randint(0, 60) if i % 20 else 900) for i in range(200)] + ["twin"] * 30
    rows = [(ids(i), t) for i, t in enumerate(texts)]
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())
    ordered = sorted(rows, key=key)
    expected = collections.Counter()
    for n, (i, t) in enumerate(ordered):
        changed = fingerprints.edited(t, ordered[(n + 1) % len(ordered)][1])
        expected[i, len(t), hashlib.sha256(changed.encode()).hexdigest()] += 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    got = fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected


def test_tasks_of_like_bytes():
    size = lambda b, lo, hi: {"bytes": b, "least": lo, "most": hi}
    cuts, spread, tasks = fingerprints._plan_tasks([size(100, i, i + 9) for i in range(0, 1000, 10)] + [size(5000, 2000, 2000)], 15)
    assert spread[len(cuts)][1] == 5 and tasks <= 30 and cuts[0] == 100


def test_chunks_move_with_their_text():
    sizes = Sizes(16, 64, 255)
    data = prose(3000).encode()
    cut = cut_points(data, sizes)
    assert cut[-1] == len(data) and all(b - a <= 255 for a, b in zip([0, *cut], cut, strict=False))
    parts = lambda d: {d[a:b] for a, b in zip([0, *cut_points(d, sizes)], cut_points(d, sizes), strict=False)}
    assert len(parts(data) & parts(b"inserted text " + data)) > 0.95 * len(parts(data))


# 8 suffixes


def plain_removal(texts, n=suffixes.LENGTH):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group_rows", [1, 6, suffixes.GROUP_ROWS])
def test_suffix_removal(spark, group_rows):
    passages = [prose(rng.randint(80, 160)) for _ in range(3)]
    texts = []
    for _ in range(50):
        parts = [prose(rng.randint(2, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts += [p[a : a + rng.randint(300, 900)], rng.choice(["a" * 700, "ab" * 300, prose(20)])]
        texts.append("".join(parts))
    texts += [texts[0], texts[0], None, "", "x" * 399, "y" * 400, "y" * 400, "z" * 401]
    got = found(suffixes.removal_digests(table(spark, texts), group_rows))
    assert [tuple(got[i])[1:] for i in range(len(texts))] == plain_removal(texts)


def test_blind_trie_orders():
    data = [prose(6).encode() for _ in range(30)] + [b"abcabc", b"abcabd", b"abc", b"abcabc", b"abcabc", b""]
    whole, starts, ends = b"".join(data), [], []
    for d in data:
        starts.append(sum(map(len, data[: len(starts)])))
        ends.append(starts[-1] + len(d))
    trie = suffixes.BlindTrie(whole, starts, ends)
    share = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    for i in range(len(data)):
        trie.insert(i)
    got = list(trie.in_order())
    assert [data[i] for i, _ in got] == sorted(data)
    assert all(common == share(data[a], data[b]) for (a, _), (b, common) in zip(got, got[1:], strict=False))


def test_multikey_quicksort():
    gen = np.random.default_rng(3)
    words, group = gen.integers(0, 4, (500, 3)).astype(np.uint64), gen.integers(0, 9, 500)
    order, deep = suffixes.multikey_quicksort(words, group)
    rows = [(group[i], *words[i]) for i in order]
    assert rows == sorted(rows)
    equal = collections.Counter(rows)
    assert sorted(b - a for a, b in deep) == sorted(n for n in equal.values() if n > 1)
    assert all(len(set(rows[a:b])) == 1 for a, b in deep)


def test_suffix_removal_at_edges_that_many_share(spark):
    passage = prose(110)
    texts = [f"{prose(60)} {passage} {prose(60)}" for _ in range(150)] + [f"{prose(5)} {passage[: 420 + i]}{prose(9)}" for i in range(60)]
    for group_rows in (40, suffixes.GROUP_ROWS):
        got = found(suffixes.removal_digests(table(spark, texts), group_rows))
        assert [tuple(got[i])[1:] for i in range(len(texts))] == plain_removal(texts)


# 9 chat


def test_chat_round_trip(spark):
    odd = ["<|im_end|>", "<\\|im_start|>", "<\\\\|x|>", "a<|b\n", None, "", "plain", "é" * 900]
    turns = [(c, n, rng.choice(["system", "user", "assistant", None, "to\\ol\n1"]), rng.choice(odd) if c % 2 else prose(rng.randint(0, 300))) for c in range(12) for n in range(rng.randint(1, 40))]
    turns += [(3, 5, "user", "tie"), (None, 1, "assistant", "lost"), (4, None, "system", "first")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("span", F.lit("clash"))
    made = chat.windows(df)
    got = found(chat.read_back(made), "conv_id")
    by = collections.defaultdict(list)
    for c, n, role, text in turns:
        by[c].append((n is not None, n or 0, (role or "").encode(), (text or "").encode()))
    for c, rows in by.items():
        rows.sort()
        whole = b"".join(r[2] + b"\n" + r[3] + b"\n" for r in rows)
        loss = b"".join(r[3] for r in rows if r[2] == b"assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(rows), hashlib.sha256(whole).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss.decode()), hashlib.sha256(loss).hexdigest())
    assert made.count() > len(by) and chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_chat_budget_and_history(spark):
    say = lambda n: " ".join(["w"] * n)
    turns = []
    for c, system in enumerate((None, 20, 700, 890, 3000)):
        sizes = [rng.choice([1, 30, 90, 200, 600, 5000]) for _ in range(40)]
        turns += [(c, 0, "system", say(system))] if system else []
        turns += [(c, n + 1, "assistant" if n % 2 else "user", say(k)) for n, k in enumerate(sizes)]
    made = chat.windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    context = 0
    for w in made:
        parts = w["formatted"].split(chat.START)[1:]
        own = parts[w["n_context"] :]
        sizes = [len(p.removesuffix(chat.END + "\n").partition("\n")[2].split()) + chat.MARKER_TOKENS for p in parts]
        system = sum(s for s, p in zip(sizes, parts, strict=True) if p.startswith("system"))
        if sum(sizes) > chat.WINDOW_TOKENS:
            alone = [s for s, p in zip(sizes, parts, strict=True) if not p.startswith("system")]
            assert len(own) == 1 and len(alone) <= 1, (system, sizes)
        history = sum(s for s, p in zip(sizes[: w["n_context"]], parts, strict=False) if not p.startswith("system"))
        assert history <= chat.HISTORY_TOKENS
        context += history > 0
        masked = [w["formatted"][m["start"] - 1 : m["start"] - 1 + m["length"]] for m in w["mask"]]
        assert masked == [p.removesuffix(chat.END + "\n").partition("\n")[2] for p in own if p.startswith("assistant")]
    assert context > 5


@pytest.mark.parametrize("role", ["a\x00b", "\\n", "\\\\n\n\\", "\n\\\n", "\x00b\\", "<\\|<|x"])
def test_chat_roles_come_back(spark, role):
    df = spark.createDataFrame([(role,)], "r string")
    assert df.select(chat._unescape_role(chat._escape_role(F.col("r")))).first()[0] == role


# 10 sharding


def test_hilbert_curve(spark):
    axis = lambda n: spark.range(8).select(F.col("id").cast("int").alias(n))
    cells = axis("x").crossJoin(axis("y")).crossJoin(axis("z")).withColumn("h", sharding.hilbert_index(["x", "y", "z"], 3)).orderBy("h").collect()
    assert [r["h"] for r in cells] == list(range(512))
    assert all(sum(abs(a[c] - b[c]) for c in "xyz") == 1 for a, b in zip(cells, cells[1:], strict=False))


def test_shards(spark, docs):
    rows = docs.unionByName(docs.limit(3)).unionByName(table(spark, ["q"], [None]))
    got = sharding.shard_documents(rows).collect()
    assert len(got) == len(TEXTS) + 4
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        t = ("q" if r["doc_id"] is None else TEXTS[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 1, crc32(t))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_follow_the_curve(spark):
    """Ranks ascend along the curve, shards hold compact boxes, and a filter skips most of them."""
    rows = [(i, "x" * rng.randint(0, 4000), rng.choice("abcd"), rng.choice("stuv"), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    sized = df.select("doc_id", F.length("text").alias("chars"), "source", "lang", F.crc32("text").alias("text_crc32"))
    cuts = sharding.quantile_cuts(sized, ["chars", "source", "lang"])
    level = lambda x, c: sum(x > k for k in c)
    placed = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign_shards(sized, ["chars", "source", "lang"]).collect()}
    cells = {(level(len(t), cuts[0]), level(crc32(s.encode()), cuts[1]), level(crc32(la.encode()), cuts[2])) for _, t, la, s, _ in rows}
    at = {tuple(r)[:3]: r["h"] for r in spark.createDataFrame(sorted(cells), "x int, y int, z int").withColumn("h", sharding.hilbert_index(["x", "y", "z"])).collect()}
    in_order = sorted(rows, key=lambda r: placed[r[0]])
    curve = [at[level(len(t), cuts[0]), level(crc32(s.encode()), cuts[1]), level(crc32(la.encode()), cuts[2])] for _, t, la, s, _ in in_order]
    assert curve == sorted(curve)
    read = sum(any(placed[i][0] == n and s == "t" and 1000 < len(t) < 1500 for i, t, _, s, _ in rows) for n in range(16))
    boxes = collections.defaultdict(set)
    for i, t, _, s, _ in rows:
        boxes[placed[i][0]].add((s, len(t)))
    kept = sum(any(s == "t" for s, _ in b) and min(n for _, n in b) < 1500 and max(n for _, n in b) > 1000 for b in boxes.values())
    assert read <= kept <= 8


def test_shards_match_duckdb(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = sharding.shard_documents(spark.read.parquet(f"{SF}/documents.parquet"))
    expected = con.execute(f"select {', '.join(got.columns)} from ({sharding.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(TEXTS) and back.select("shard").distinct().count() == 4


# empty tables


def test_empty_tables(spark):
    empty = table(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    frames = [
        simhash.near_duplicates(empty), toxicity.score_documents(empty, labels), bpe.encode_digests(empty),
        pii.summarize(pii.find_spans(empty)), mixing.mix(empty), fingerprints.edited_likeness(empty),
        suffixes.removal_digests(empty), sharding.shard_documents(empty),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


# pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        before, seen = seen, stage(spark, seen, SF)
        if name != "bpe":
            assert seen.columns == docs.columns
        if name == "simhash near-dedup":
            kept = {r["doc_id"]: r["text"] for r in before.collect()}
            roots = plain_similar(kept)  # the stage's rule: five words, similarity 0.8
            assert {r["doc_id"] for r in seen.collect()} == set(roots.values())
        if name == "pii":
            assert not any(pii.base_spans(r["text"]) for r in seen.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, seen.collect()))


def test_pipeline_defined_cases(spark):
    import corpus_pipeline

    text = "one two three four five six seven"
    kind = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    rows = [
        (1, text, "en", "a", len(text), "x"), (1, text, "en", "a", len(text), "x"), (2, text, None, "a", len(text), None),
        (3, None, "en", None, None, "y"), (None, text, "en", "a", len(text), "z"), (None, None, None, None, None, None),
        (5, "mail to jo@example.com now please, all of you", "en", "a", 45, "x"),
    ]
    docs = spark.createDataFrame(rows, kind)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], *rows[3:]], key=repr)
    masked = corpus_pipeline.personal_data(spark, kept, SF)
    assert masked.columns == docs.columns
    assert {r["text"] for r in masked.collect()} == {text, None, "mail to [EMAIL] now please, all of you"}
    mixed = corpus_pipeline.mixing(spark, docs, SF)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= set(rows)
    assert corpus_pipeline.encoding(spark, docs, SF).count() == len(rows)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), SF).count() == 0, name

"""The pipeline's near-duplicate stage against a plain comparison of all pairs."""

import random

import pytest

import corpus_pipeline
from gleaner.llm import jaccard, simhash

SF = "/root/testdata/sf0.001"


def plain(texts, words=5, similarity=(4, 5)):
    def shingles(text):
        found = (text or "").encode().lower().split()
        return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    for i in sorted(texts):
        for j in sorted(texts):
            a, b = sets[i], sets[j]
            if j < i and similarity[1] * len(a & b) >= similarity[0] * len(a | b):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if r == old else r for k, r in root.items()}
    return root


@pytest.mark.parametrize("hot", [2, 64])
def test_near_duplicates(spark, hot):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = " ".join(word() for _ in range(12))
    texts = [None, "", " \n", "One two", "one  TWO", "one two three four five", line, line + " x", line + " x y"]
    for size in (60, 120, 240):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 5, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(size)] = word()
            texts.append(" ".join(copy) + rng.choice(["", "", " " + line]))
    texts = dict(enumerate(texts))
    docs = spark.createDataFrame([*texts.items(), (None, "one two")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, hot=hot).collect()}
    expected = plain(texts)
    assert got == expected
    assert len(set(expected.values())) < len(texts) - 15


def test_stage_reaches_near_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == set(plain({r["doc_id"]: r["text"] for r in docs.collect()}).values())
    assert {1, 6} <= kept and not {177, 145} & kept


def test_stage_starts_from_fingerprints(spark, monkeypatch):
    """The groups of the fingerprints are made, and are what the exact check begins with."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    made, checked = simhash.near_duplicates, jaccard._links_of
    monkeypatch.setattr(simhash, "near_duplicates", lambda d: seen.setdefault("groups", made(d)))
    monkeypatch.setattr(jaccard, "_links_of", lambda f, m: seen.setdefault("links", checked(f, m)))
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == set(plain({r["doc_id"]: r["text"] for r in docs.collect()}).values())
    grouped = seen["groups"].where("doc_id <> component_id")
    assert grouped.count() and "links" in seen


def test_wrong_groups_are_not_believed(spark):
    words = [f"w{i}" for i in range(60)]
    texts = {1: " ".join(words), 2: " ".join([*words, "more"]), 3: "quite another text of a few words", 4: None, 5: "", 6: " ".join(words)}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    found = spark.createDataFrame([(i, 1) for i in texts], "doc_id long, component_id long")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.checked_and_extended(docs, found).collect()}
    assert got == plain(texts) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 1}


def test_links_are_labelled_once(spark, monkeypatch):
    """Components are worked out over all links once; after that only over what links whole groups."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, labelled = [], jaccard.connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda links: (sizes.append(links.count()), labelled(links))[1])
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == set(plain({r["doc_id"]: r["text"] for r in docs.collect()}).values())
    assert len(sizes) == 2 and sizes[0] and not sizes[1]


@pytest.mark.parametrize("parts", [1, 4, 256])
def test_parts_of_more_than_a_byte(spark, monkeypatch, parts):
    """Bounds hold where a part of a set has more shingles than its byte can tell."""
    monkeypatch.setattr(jaccard, "PARTS", parts)
    pairs = []
    made = jaccard._pairs
    monkeypatch.setattr(jaccard, "_pairs", lambda a, b, s: (pairs.append("over" in a.columns), made(a, b, s))[1])
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, texts = [word() for _ in range(700)], []
    for edits in range(0, 60, 3):
        copy = list(base)
        for at in rng.sample(range(700), edits):
            copy[at] = word()
        texts.append(" ".join(copy))
    texts = dict(enumerate(texts))
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, hot=2).collect()}
    assert got == plain(texts) and any(pairs)


def test_ids_with_several_texts_link_groups(spark):
    word = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(9, word("a")), (9, word("b")), (4, word("b") + " x"), (6, word("a") + " x"), (6, word("c")), (2, word("c") + " x"), (3, word("d")), (7, word("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {9: 2, 4: 2, 6: 2, 2: 2, 3: 3, 7: 3}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == expected
    found = simhash.near_duplicates(docs).select("doc_id", "component_id")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.checked_and_extended(docs, found).collect()} == expected

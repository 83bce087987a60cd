"""Conversation repair, token counts and spelling variants against plain versions."""

import hashlib
import itertools
import random
import re
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark import AccumulatorParam
from pyspark.sql import functions as F

from gleaner.llm import cdc, counts, fingerprints, pii, repair, suffixes, toxicity, variants

CLASH = ("place", "role_key", "first", "key", "fault", "initial", "steps", "word", "n", "near", "h", "run", "_conv_id", "n_bytes")
rng = random.Random(5)


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


# 11 Repair


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        pick = crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = "user" if pick == 4 else space(role), space(text)
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        out += [(conv, turn, role, text)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    return out


def faults(rows):
    """Of rows (role, text) in order: b, d, t or a dash."""
    seen, out = set(), []
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", row[1])
        out.append("b" if not words else "d" if row in seen else "t" if words[-1] not in ".!?" else "-")
        seen.add(row)
    return out


def plain_repair(rows):
    """(cost, audit, lines) by the best way to every state, row by row."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def better(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def insert(table):
        for _ in range(2):
            for state, (cost, audit, lines) in list(table.items()):
                better(table, follow[state], (cost + 3, audit + "I", (*lines, name[follow[state]] + ":")))

    for (role, text), fault in zip(rows, faults(rows), strict=True):
        insert(best)
        after = {}
        for state, (cost, audit, lines) in best.items():
            better(after, state, (cost + 4, audit + "D", lines))
            if fault in "bd":
                continue
            more, to = 3 * (fault == "t"), follow[state]
            better(after, to, (cost + 3 + more, audit + "R", (*lines, f"{name[to]}:{text}")))
            if role[:1] == to or role[:1] == "s" and state == "":
                better(after, role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        best = after
    insert(best)
    return min(best[s] for s in ("", "a") if s in best)


def by_conversation(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, role, text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(g, key=key) for c, g in groups.items()}


def plain_digests(rows):
    after = by_conversation(damaged(rows))
    out = {}
    for conv in {r[0] for r in rows}:
        own = after.get(conv, [])
        turns = [t for t, _, _ in own if t is not None]
        kinds = faults([r[1:] for r in own])
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, lines = plain_repair([r[1:] for r in own])
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *map(kinds.count, "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def digests(spark, rows):
    got = repair.repair_digests(clashing(spark.createDataFrame(rows, TURNS))).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got}


def test_search_is_the_cheapest_of_all_edits():
    """Every script of edits of up to three rows, with up to two insertions in every gap."""
    form = re.compile("(s?(ua)+)?")
    for initials in itertools.chain.from_iterable(itertools.product("sua?", repeat=n) for n in (0, 1, 2, 3)):
        kinds = [rng.choice("---tbd") for _ in initials]
        best = None
        options = [[("D", "", 4)] + ([] if f in "bd" else [("K", i, 3 * (f == "t"))] + [("R", r, 3 + 3 * (f == "t")) for r in "ua"]) for i, f in zip(initials, kinds, strict=True)]
        for choice in itertools.product(*options):
            for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(initials) + 1):
                made = gaps[0] + "".join(c[1] + g for c, g in zip(choice, gaps[1:], strict=True))
                if not form.fullmatch(made):
                    continue
                audit = "I" * len(gaps[0]) + "".join(c[0] + "I" * len(g) for c, g in zip(choice, gaps[1:], strict=True))
                way = (sum(c[2] for c in choice) + 3 * sum(map(len, gaps)), audit)
                best = way if best is None else min(best, way)
        found = repair.search("".join(initials), "".join(kinds), repair.NOTHING)
        ends = [(cost + 3 * len(repair.CLOSING[q]), audit + repair.CLOSING[q]) for q, (cost, audit) in found.items()]
        assert min(ends) == best, (initials, kinds)


def test_repair_of_odd_conversations(spark):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User", "ugh"], ["Yes.", "No", "Why?", "", " \n", None, "Done! \t", "a." * 3, "é…", "Yes."]
    rows = []
    for conv in [*range(70), None, 1 << 60, (1 << 60) + 1]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None, -turn]), rng.choice(roles), rng.choice(texts)))
    rows += rng.sample(rows, 30)  # repeated rows
    rows.append((900, None, None, None))
    dropped = next(c for c in range(1000, 2000) if crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "x."))
    got = digests(spark, rows)
    assert got == plain_digests(rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert digests(spark, []) == {}


def test_repair_across_blocks(spark):
    """One conversation of many blocks among short ones: no task has it whole while edits are sought."""
    long = [(7, t // 3, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["One.", f"Two {t}?", f"{t} cut", "", f"t {t}."])) for t in range(5 * repair.BLOCK)]
    rows = long + [(c, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for c in (1, 3, 9, 11) for t in range(6)]
    assert digests(spark, rows) == plain_digests(rows)
    numbered = repair.number(repair.damage(spark.createDataFrame(long, TURNS)))
    parts = numbered.groupBy(F.shiftright("place", repair.BLOCK_BITS)).count().collect()
    assert max(r["count"] for r in parts) <= repair.BLOCK and len(parts) >= 5


def test_repair_of_texts_as_they_are(spark):
    rows = [("c", 0, "assistant", "hi."), ("c", 1, "user", "ok" * 200_000 + "."), ("d", 0, "system", "s."), ("d", 1, "user", "q."), ("d", 2, "assistant", "a.")]
    got = {r["conv_id"]: r for r in repair.repair(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).collect()}
    assert got["c"]["audit"] == "IKKI" and got["c"]["repaired"] == "user:\nassistant:hi.\nuser:" + "ok" * 200_000 + ".\nassistant:"
    assert got["d"]["audit"] == "KKK" and got["d"]["repaired"] == "system:s.\nuser:q.\nassistant:a." and got["d"]["cost"] == 0


# 12 Counts


def test_strings_that_are_proved_whole():
    counter = counts.Counter(counts.default_model())
    assert counter.cuts and len(counter.alone) > 30_000
    for piece in rng.sample(sorted(counter.alone), 300):
        if piece.startswith(counts.BLANK) and piece.strip(counts.BLANK):
            assert counter.model.encode(piece[1:].replace(counts.BLANK, " "), out_type=str) == [piece]


def test_counts_are_those_of_the_library(spark):
    model = counts.Counter(counts.default_model())
    alphabet = "ab ce\n\t▁<s>/é́ﬁ　\x00中 文the​0123.,'😀ா"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " ", "   ", "\n", "<s> </s> <unk> <0x0A>", "word " * 9000, "x" * 50_000, "日本" * 999, " " * 99, "a", "a"]
    df = clashing(spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = counts.count_tokens(df).collect()
    want = [(i if i % 50 else None, len((t or "").encode()), model.library(t or "") if t else 0) for i, t in enumerate(texts)]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got])) == sorted(map(key, want))
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got) and any(r["over_limit"] for r in got)
    assert counts.count_tokens(df.limit(0)).count() == 0


def test_counts_without_cuts():
    """A model whose pre-tokens can't be told apart is given whole texts."""
    counter = counts.Counter(counts.default_model())
    texts = ["two words\n", "", "é <s>"]
    cut = counter.count_all(texts)
    counter.cuts = False
    assert counter.count_all(texts) == cut == [counter.library(t) for t in texts]


# 13 Variants


def plain_vocabulary(docs):
    tally = {}
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            tally[low] = tally.get(low, 0) + 1
    return {w: n for w, n in tally.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def spelled(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_neighbours_are_all_and_distinct():
    everything = np.full(1 << 16, 255, np.uint8)
    alphabet = np.array(sorted(map(ord, "abcé")), np.uint32)
    for word in ("abcabca", "aaaaaaa", "éabbbca", "x", "zzé", "a" * 300):
        got = [n for _, n in variants.neighbours([word], alphabet, everything)]
        letters = "abcé"
        want = {word[:i] + word[i + 1 :] for i in range(len(word))}
        want |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters if c != word[i]}
        want |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        assert len(got) == len(set(got)) and set(got) == want


def test_check_sums_of_neighbours_are_those_of_the_words():
    words = ["".join(rng.choice("abcdé") for _ in range(9)) for _ in range(50)]
    alphabet = np.array(sorted(map(ord, "abcdé")), np.uint32)
    targets = {n for w in words for n in [w[:4] + w[5:], w[:4] + "é" + w[5:], "a" + w, w + "d"]} - set(words)
    bits = np.zeros(1 << 17, np.uint8)
    for t in targets:
        place, step = variants._seed(variants.check_sums(variants._codes([t])))
        for probe in range(variants.PROBES):
            at = int((place + np.uint64(probe) * step)[0]) & ((len(bits) << 3) - 1)
            bits[at >> 3] |= 1 << (at & 7)
    found = {n for _, n in variants.neighbours(words, alphabet, bits)}
    assert targets <= found and len(found) < len(targets) * 1.2 + 50


def test_vocabulary(spark):
    docs = [(i if i % 40 else None, " ".join(rng.choice(["Harvest", "harvest", "HARVESTS", "éclairés", "Éclairés", "boat", "lullaby×", "shortes"]) + rng.choice([" ", ",", "1"]) for _ in range(30))) for i in range(200)]
    docs += [(1, None), (2, ""), (3, docs[3][1]), (3, docs[3][1])]
    got = variants.vocabulary(clashing(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["word"]: r["n"] for r in got.collect()} == plain_vocabulary(docs)


@pytest.mark.parametrize("most_bits", [1 << 29, 1 << 19])
def test_forms_and_roots(spark, monkeypatch, most_bits):
    monkeypatch.setattr(variants, "MOST_BITS", most_bits)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(300)] + ["q" * 400, "q" * 401, "q" * 399 + "z"]
    words = {w: rng.choice([2, 3, 20, 30, 200, 2000, 2000]) for w in base}
    chain = ["stepone"[:6] + "x" * i for i in range(1, 7)]
    words |= {w: 2 * 10**i for i, w in enumerate(chain)} | {"tiesame": 2, "tiesama": 20, "tiesamb": 20}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelled(variants.spelling_variants(clashing(table)))
    assert got == plain_variants(words)
    assert got[chain[0]][1] == chain[-1] and got["tiesame"][0] == "tiesama"
    assert spelled(variants.spelling_variants(table.limit(0))) == {}


# 5 What the registries say


@pytest.mark.parametrize(
    "kind, got, vote",
    [
        ("email", "a@b.de", 1), ("email", "a@b.com", 1), ("email", "a@b.example", -1), ("email", "a@b.c3", 0), ("email", "a@1.2.3.44", -1), ("email", "a@b.unheard", 0),
        ("ip", "8.8.8.8", 1), ("ip", "127.0.0.1", -1), ("ip", "203.0.113.9", -1), ("ip", "203.0.112.9", 1), ("ip", "239.1.1.1", -1), ("ip", "198.19.255.255", -1), ("ip", "198.20.0.0", 1),
        ("ip", "10.0.0.1", 1), ("card", "4111 1111 1111 1111", -1), ("card", "4012888888881881", 1), ("card", "2221000000000009", 1), ("card", "2721000000000009", -1), ("card", "371449635398431", 1),
        ("card", "3714496353984310", -1), ("card", "9111111111111112", -1), ("phone", "+1 (826) 555-4081", 1), ("phone", "+1 (126) 555-4081", -1), ("phone", "+44 20 7946 0000", 1), ("phone", "+210 123 456 789", 1),
        ("phone", "+998 12 345 67 89", 1), ("phone", "(826) 555-4081", 1), ("phone", "126 555-4081", -1), ("phone", "+0 123456789", -1),
    ],
)
def test_registries(kind, got, vote):
    assert pii._gazetteer(kind, got) == vote


# 7 Cuts and likeness, a byte at a time


def plain_cuts(data, least, normal, most):
    gear = [xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)]
    bits = normal.bit_length() - 1
    strict, loose = (((1 << n) - 1) << (32 - n) for n in (bits + 1, bits - 1))
    ends, start, rolling = [], 0, 0
    for i, b in enumerate(data):
        rolling = ((rolling << 1) + gear[b]) & 0xFFFFFFFF
        size = i + 1 - start
        small_rest = len(data) - start <= least
        if not small_rest and size >= least and (size == most or rolling & (strict if size < normal else loose) == 0):
            ends.append(i + 1)
            start = i + 1
    return ends + [len(data)] if start < len(data) else ends


@pytest.mark.parametrize("sizes", [(16, 64, 255), (8, 32, 40), (512, 2048, 8192)])
def test_cuts_a_byte_at_a_time(sizes):
    for n in (0, 1, sizes[0], sizes[0] + 1, sizes[2], 5000, 30_000):
        for letters in (256, 20, 1):
            data = bytes(rng.randrange(letters) for _ in range(n))
            assert cdc.cut_points(data, cdc.Sizes(*sizes)) == plain_cuts(data, *sizes)


def plain_chunks(text):
    data = text.encode()
    ends = plain_cuts(data, 16, 64, 255)
    return {data[a:b] for a, b in zip([0, *ends], ends, strict=False)}


def plain_likeness(a, b):
    own, other = plain_chunks(a), plain_chunks(b)
    return sum(len(c) for c in own if c in other) / sum(map(len, own)) if own else float(not other)


def test_likeness_by_chunks_themselves(spark):
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    texts += [texts[3], texts[3] + " more", None, "", "short", "é" * 3000]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    for i, text in rows:
        text, following = text or "", texts[(i + 1) % len(texts)] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        assert got[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest() and got[i]["n_chars"] == len(text)
        assert got[i]["near_edited"] == pytest.approx(plain_likeness(text, changed)) and got[i]["near_next"] == pytest.approx(plain_likeness(text, following))


# 2 Scores, a word at a time


def test_scores_a_word_at_a_time(spark):
    """The scorer's shares of features times weights, put together from counts without its tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    weights, intercept = {}, -1.0
    for r in docs.limit(50).collect():
        for f in toxicity.feature_counts(r["text"])[0]:
            weights[f] = ((f * 2654435761) % 1000 - 500) / 50
    model = toxicity.Model(weights, intercept)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score_column("text", model).alias("s")).collect()}
    for r in docs.collect():
        tally, total = toxicity.feature_counts(r["text"])
        z = intercept + sum(weights.get(f, 0.0) * n for f, n in tally.items()) / (total + toxicity.SMOOTHING)
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)


# 8 Groups that are too large


class _Most(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, a, b):  # noqa: N802
        return max(a, b)


def test_no_task_holds_a_large_group(spark, monkeypatch):
    """A passage in half of the texts, each time between other words: no group that is sorted has more rows than allowed."""
    passage = " ".join(f"shared{i}" for i in range(60))
    own = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    texts = [f"{own(9)} {passage} {own(9)}" if i % 2 else own(80) for i in range(120)]
    most = spark.sparkContext.accumulator(0, _Most())
    plain = suffixes._sort_groups

    def counting(length):
        run = plain(length)

        def counted(batches):
            sizes = {}

            def seen():
                for batch in batches:
                    for core in batch["core"]:
                        sizes[core] = sizes.get(core, 0) + 1
                    yield batch

            yield from run(seen())
            most.add(max(sizes.values(), default=0))

        return counted

    monkeypatch.setattr(suffixes, "_sort_groups", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffixes.remove_repeats(docs, group_rows=20).collect()}
    assert all(got[i] == (0, 0) for i in range(0, 120, 2)) and all(got[i][0] >= len(passage) and got[i][1] == 1 for i in range(1, 120, 2))
    assert most.value <= 20

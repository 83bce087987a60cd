"""Personal-data spans by weak supervision.

Base spans of four kinds (email, ip, card, phone) come from fixed patterns and checks, and always
stay. Candidates for further spans are near misses: masked addresses, phone numbers without a
country code, numbers that fail a check, and the parts of these that would pass it (a base
pattern takes a phone number and a card number after it for one, and drops both). Five labelers
vote on every base span and candidate, +1, -1 or 0 for no opinion: the pattern with its check, the
structure of the match, a gazetteer (address endings, card issuers, reserved networks), the
words around it, and its borders.

Votes are counted by kind and vote pattern over all documents: at most ``4 * 3**5`` counts,
whatever the size of the corpus. On these, expectation-maximisation estimates for each
kind how often a labeler votes which way on true and on false spans, and so the probability
that a pattern is true. The final classifier never sees the votes: it is logistic over what the
span and its surroundings look like (shape, digits, checksum, borders, the words next to
it), trained on at most ``SAMPLE`` spans a kind, those smallest by a hash, with EM's probabilities
as soft labels. It adds the candidates that it gives ``ACCEPT`` or more; of those that overlap, the
likeliest.

Defined cases: a null text has no spans; offsets are code points, end exclusive; patterns run
over whole texts in time linear in their length; repeated rows are treated alike, null ids are
carried, other columns are ignored by ``find_spans`` and kept by ``redact``.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "structure", "gazetteer", "context", "border")
ACCEPT = 0.9
CONTEXT_CHARS = 40
SAMPLE = 4000
MOST_CHARS = 64
WEIGHTS = 1 << 12
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match takes all digits at its end, so none starts within a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NEAR_PHONE = re.compile(r"(?<![\w+])(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?!\w)")
_NEAR_EMAIL = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9._+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63} ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z]{2,10}(?!\w)", re.IGNORECASE
)
# Fixed values, public registries as of 2025. Endings of addresses: the generic ones of IANA's root zone that are not open to
# any string, and those that RFC 2606 and RFC 6762 keep for tests and local use. An ending of two letters is a country's (ISO 3166).
_ENDINGS = frozenset("com org net edu gov mil int info biz name pro aero coop museum mobi jobs travel tel cat asia post arpa app dev online shop site".split())
_NO_ENDINGS = frozenset("test example invalid localhost local internal home lan".split())
# Card numbers by issuer (ISO/IEC 7812): first and last prefix, lengths.
_ISSUERS = (
    ("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)), ("6011", "6011", (16, 17, 18, 19)),
    ("644", "649", (16, 17, 18, 19)), ("65", "65", (16, 17, 18, 19)), ("300", "305", (14, 16, 17, 18, 19)), ("36", "36", (14, 15, 16, 17, 18, 19)), ("38", "39", (14, 16, 17, 18, 19)),
    ("3528", "3589", (16, 17, 18, 19)), ("62", "62", (16, 17, 18, 19)), ("50", "50", tuple(range(13, 20))), ("56", "58", tuple(range(13, 20))), ("63", "63", tuple(range(13, 20))), ("67", "67", tuple(range(13, 20))),
)
# Networks of RFC 6890 that name no host of the internet's: this network, loop-back, link-local, documentation, tests, multicast, reserved.
_NO_HOSTS = ("0.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "192.0.0.0/24", "192.0.2.0/24", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4")
# Country codes of ITU-T E.164 of one and two digits; all others have three, and begin with one of these pairs.
_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_LONG_CODES = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())


def _network(written: str) -> tuple[int, int]:
    """The first address and the mask of a network."""
    first, bits = written.split("/")
    return _address(first), (1 << 32) - (1 << (32 - int(bits)))


def _address(dotted: str) -> int:
    a, b, c, d = (min(int(p[-9:]), 255) for p in dotted.split("."))
    return a << 24 | b << 16 | c << 8 | d


_NO_HOST_MASKS = tuple(map(_network, _NO_HOSTS))


def known_issuer(digits: str) -> bool:
    return any(len(digits) in lengths and first <= digits[: len(first)] <= last for first, last, lengths in _ISSUERS)


def known_number(digits: str) -> bool:
    """Whether digits behind a plus sign begin with a country's code and, in the North American plan, have its form."""
    if digits[:1] == "1":
        return len(digits) == 11 and digits[1] > "1" and digits[4] > "1"
    return digits[:1] in _CODES or digits[:2] in _CODES or digits[:2] in _LONG_CODES


_FOR = {
    "email": frozenset("mail email contact write address reach send".split()),
    "ip": frozenset("ip host server address from client network ping".split()),
    "card": frozenset("card visa credit payment pay account mastercard billing".split()),
    "phone": frozenset("phone call tel telephone mobile fax contact dial".split()),
}
_AGAINST = frozenset("token key hash version order invoice id sha md5 isbn number serial".split())
_WORDS = re.compile(r"[a-z]+")
_PIECES = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match holds one @; its local part runs back to the last match at most."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))


def _matches(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and matches of a base pattern that fail its check; by kind, then start."""
    good: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    bad: list[Span] = []
    for m in _IP.finditer(text):
        fits = all(len(p) < 4 or not p[:-3].strip("0") for p in m[0].split(".")) and all(int(p[-4:]) <= 255 for p in m[0].split("."))
        (good if fits else bad).append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and len(d := _digits(m[0])) >= 13:
            (good if len(d) <= 19 and luhn(d) else bad).append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        (good if 9 <= len(_digits(m[0])) <= 15 else bad).append(("phone", *m.span()))
    return good, bad


def base_spans(text: str | None) -> list[Span]:
    return _matches(text or "")[0]


def fits(kind: str, got: str) -> bool:
    """Whether the string, on its own, is a base span of the kind."""
    if kind == "card":
        return 13 <= len(d := _digits(got)) <= 19 and luhn(d) and _CARD.fullmatch(got) is not None
    if kind == "phone":
        return 9 <= len(_digits(got)) <= 15 and _PHONE.fullmatch(got) is not None
    return (kind, 0, len(got)) in base_spans(got)


def parts_of(text: str, span: Span) -> Iterator[Span]:
    """Stretches of a failed card or phone match, cut between its runs of digits, that pass on their own."""
    kind, a, b = span
    runs = [m.span() for m in _PIECES.finditer(text, a, b)]
    least, most = (13, 19) if kind == "card" else (9, 15)
    for i, (start, _) in enumerate(runs if kind == "card" else runs[:1]):
        digits = 0
        for first, end in runs[i:]:
            digits += end - first
            if digits > most:
                break
            part = (kind, a if kind == "phone" else start, end)
            if digits >= least and part != span and fits(kind, text[part[1] : end]):
                yield part


def candidates(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and near misses that overlap no base span of their kind."""
    good, bad = _matches(text)
    parts = [part for s in bad if s[0] in ("card", "phone") for part in parts_of(text, s)]
    bad = [s for s in bad if s[2] - s[1] <= MOST_CHARS] + parts  # longer ones are no span of any kind
    # Every match of the patterns holds what is looked for here.
    if "(" in text or "[" in text:
        bad += [("email", *m.span()) for m in _NEAR_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        bad += [("phone", *m.span()) for m in _NEAR_PHONE.finditer(text)]
    if not bad:
        return good, []
    ends = {k: [s[2] for s in good if s[0] == k] for k in KINDS}
    starts = {k: [s[1] for s in good if s[0] == k] for k in KINDS}
    free = []
    for s in set(bad):
        # Base spans of a kind are in order and disjoint: the first to end behind the start decides.
        i = bisect_right(ends[s[0]], s[1])
        if i == len(ends[s[0]]) or starts[s[0]][i] >= s[2]:
            free.append(s)
    return good, sorted(free, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _structure(kind: str, got: str) -> int:
    d = _digits(got)
    if kind == "email":
        return 1 if got.count("@") == 1 and ".." not in got and got[0] not in ".-" else -1
    if kind == "ip":
        return 1 if all(len(p) <= 3 and p == str(int(p)) and int(p) <= 255 for p in got.split(".")) else -1
    if kind == "card":
        return 1 if luhn(d) and len(d) in (14, 15, 16) and min(map(len, _PIECES.findall(got))) > 2 else -1
    return 1 if 10 <= len(d) <= 13 else -1


def _gazetteer(kind: str, got: str) -> int:
    d = _digits(got)
    if kind == "email":
        ending = re.split(r"[^A-Za-z0-9]+", got)[-1].lower()
        return -1 if ending in _NO_ENDINGS or ending.isdigit() else 1 if ending in _ENDINGS or len(ending) == 2 and ending.isalpha() else 0
    if kind == "ip":
        return -1 if len(got) > 15 or any(_address(got) & mask == first for first, mask in _NO_HOST_MASKS) else 1
    if kind == "card":
        return 1 if known_issuer(d) and len(set(d)) > 2 else -1
    if got[0] == "+":
        return 1 if known_number(d) else -1
    return 1 if len(d) == 10 and d[0] > "1" and d[3] > "1" else -1  # a national number, as the candidates without a plus sign are


def votes(text: str, span: Span, strict: bool) -> tuple[int, ...]:
    kind, a, b = span
    around = set(_WORDS.findall((text[max(0, a - CONTEXT_CHARS) : a] + " " + text[b : b + CONTEXT_CHARS]).lower()))
    context = 1 if around & _FOR[kind] else -1 if around & _AGAINST else 0
    inside = (a > 0 and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum())
    return 1 if strict else -1, _structure(kind, text[a:b]), _gazetteer(kind, text[a:b]), context, -1 if inside else 1


def _seen_spans(text: str) -> Iterator[tuple[Span, bool, bool]]:
    """(span, whether it is a base span, whether it passes on its own)."""
    good, more = candidates(text)
    for s in good:
        yield s, True, True
    for s in more:
        yield s, False, fits(s[0], text[s[1] : s[2]])


def _border(c: str) -> str:
    return "edge" if not c else "alnum" if c.isalnum() else "space" if c.isspace() else c


def features(text: str, span: Span) -> list[int]:
    """Hashed features of the span and of what stands next to it."""
    kind, a, b = span
    got, digits = text[a:b], _digits(text[a:b])
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", got))
    before, after = (_WORDS.findall(t.lower()) for t in (text[max(0, a - CONTEXT_CHARS) : a], text[b : b + CONTEXT_CHARS]))
    named = [
        "kind", f"fits {fits(kind, got)}", f"digits {len(digits)}", f"shape {shape[:16]}", f"luhn {luhn(digits)}",
        f"length {min(len(got) // 4, 10)}", f"left {_border(text[a - 1 : a])}", f"right {_border(text[b : b + 1])}",
        f"ending {re.split(r'[^A-Za-z0-9]+', got)[-1].lower() if kind == 'email' else ''}", f"head {got[:2] if kind != 'email' else ''}",
        f"before {before[-1] if before else ''}", f"after {after[0] if after else ''}",
    ]
    return [xxhash.xxh32_intdigest(f"{kind} {n}") % WEIGHTS for n in named]


def _observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of vote patterns (hash null), and the spans smallest by a hash with their features."""
    counts: Counter[tuple] = Counter()
    held: dict[str, list[tuple]] = {k: [] for k in KINDS}
    for batch in batches:
        for text in batch["text"]:
            own = None
            for s, _, strict in _seen_spans(text) if text else ():
                v = votes(text, s, strict)
                counts[(s[0], *v)] += 1
                own = own or xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
                rank = xxhash.xxh64_intdigest(f"{s[0]}:{s[1]}:{s[2]}", seed=own) >> 1
                rows = held[s[0]]
                if len(rows) < SAMPLE or rank < -rows[0][0]:
                    push = heapq.heappush if len(rows) < SAMPLE else heapq.heapreplace
                    push(rows, (-rank, v, np.array(features(text, s), np.int32).tobytes()))
    rows = [(*k, n, None, None) for k, n in counts.items()]
    rows += [(k, *v, 1, str(-rank), seen) for k, found in held.items() for rank, v, seen in found]
    yield pd.DataFrame(rows, columns=["kind", *LABELERS, "n", "rank", "seen"])


def observations(docs: DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Vote patterns with their counts over all documents, and the sample of spans."""
    schema = "kind string, " + ", ".join(f"{x} int" for x in LABELERS) + ", n long, rank string, seen binary"
    parts = materialize(docs.select("text").mapInPandas(_observe, schema))
    patterns = parts.where("rank is null").groupBy("kind", *LABELERS).agg(F.sum("n").alias("n"))
    least = Window.partitionBy("kind").orderBy(F.col("rank").cast("long"), *LABELERS, "seen")
    sample = parts.where("rank is not null").withColumn("at", F.row_number().over(least)).where(F.col("at") <= SAMPLE)
    return patterns.toPandas(), sample.select("kind", *LABELERS, "seen").toPandas()


def reliabilities(votes_: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """EM over vote patterns of one kind: the probability that each pattern is a true span.

    A labeler's votes are independent given the truth; each has, for true and for false spans,
    a distribution over -1, 0 and 1 with one imaginary vote for the side it should take.
    """
    true = np.clip(0.5 + 0.25 * votes_.mean(axis=1) + 0.2 * votes_[:, 0], 0.02, 0.98)
    seen = np.stack([votes_ == v for v in (-1, 0, 1)], axis=-1).astype(float)
    for _ in range(rounds):
        share = (n @ true + 1) / (n.sum() + 2)
        logs = []
        for weight, prior in ((n * true, (0.2, 0.5, 1.0)), (n * (1 - true), (1.0, 0.5, 0.2))):
            tally = np.einsum("p,plv->lv", weight, seen) + np.array(prior)
            logs.append(np.einsum("plv,lv->p", seen, np.log(tally / tally.sum(axis=1, keepdims=True))))
        z = np.log(share / (1 - share)) + logs[0] - logs[1]
        true = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    return true


Model = tuple[np.ndarray, float]


def train(patterns: pd.DataFrame, sample: pd.DataFrame, steps: int = 400) -> Model:
    """Weights and intercept of the span classifier, from EM's soft labels."""
    patterns = patterns.sort_values(["kind", *LABELERS]).reset_index(drop=True)
    kinds, v, n = patterns["kind"].to_numpy(str), patterns[list(LABELERS)].to_numpy(int), patterns["n"].to_numpy(float)
    label: dict[tuple, float] = {}
    for k in sorted(set(kinds)):
        mine = kinds == k
        label |= {(k, *map(int, row)): p for row, p in zip(v[mine], reliabilities(v[mine], n[mine]), strict=True)}
    w, b = np.zeros(WEIGHTS), 0.0
    if not len(sample):
        return w, -10.0
    sample = sample.sort_values(["kind", *LABELERS, "seen"])
    x = np.stack([np.frombuffer(f, np.int32) for f in sample["seen"]])
    soft = np.array([label[(r[0], *map(int, r[1:]))] for r in sample[["kind", *LABELERS]].itertuples(index=False)])
    # Candidates are few beside base spans: both halves of each kind weigh the same.
    half = pd.Series(list(zip(sample["kind"], soft > 0.5, strict=True)))
    weight = (1 / half.map(half.value_counts())).to_numpy(float)
    weight /= weight.sum()
    m, s, rate = np.zeros(WEIGHTS + 1), np.zeros(WEIGHTS + 1), 0.05
    for t in range(1, steps + 1):  # Adam
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(axis=1) + b, -40, 40)))
        g = weight * (p - soft)
        grad = np.append(np.bincount(x.ravel(), np.repeat(g, x.shape[1]), WEIGHTS) + 1e-4 * w, g.sum())
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def classifier(docs: DataFrame) -> Model:
    """Learned from the documents' own spans; what reaches the driver is bounded."""
    return train(*observations(docs))


def probability(text: str, span: Span, model: Model) -> float:
    return float(1 / (1 + np.exp(-np.clip(model[0][features(text, span)].sum() + model[1], -40, 40))))


def spans_of(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and those with what the classifier adds; by kind, then start."""
    base, more = candidates(text)
    likely = [(-p, s[1] - s[2], s) for s in more if (p := probability(text, s, model)) >= ACCEPT]
    added: list[Span] = []
    taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for _, _, s in sorted(likely):
        near = taken[s[0]]
        i = bisect_right(near, (s[1], s[2]))
        if (i == 0 or near[i - 1][1] <= s[1]) and (i == len(near) or near[i][0] >= s[2]):
            near.insert(i, (s[1], s[2]))
            added.append(s)
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) for each row: spans as kind:start:end, comma-joined."""
    known = classifier(docs)

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [tuple(map(_joined, spans_of(t, known) if t else ([], []))) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": [r[0] for r in rows], "spans": [r[1] for r in rows]})

    # The id travels as text: pandas would turn ids beside a null into floats.
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = named.mapInPandas(found, "doc_id string, base string, spans string")
    return out.withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]))


def summarize(spans: DataFrame) -> DataFrame:
    """The digest columns of ``find_spans`` output; counts are of base spans."""
    count = lambda k: F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}")
    return spans.select("doc_id", *(count(k) for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def redacted(text: str, known: dict[tuple, float]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""
    out, at = [], 0
    for kind, a, b in sorted(spans_of(text, known)[1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in text, and n_chars brought up to date."""
    known = classifier(docs)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redacted(t, known) if t else t)

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))


def digest_of(text: str | None) -> str:
    """The base digest of one text, for tests."""
    return sha256(_joined(base_spans(text)).encode()).hexdigest()

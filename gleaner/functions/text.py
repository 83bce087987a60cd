"""Text predicates and layouts as column expressions; fuzzy matching as an Arrow UDF."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _alternation(terms: Sequence[str]) -> str:
    return "|".join(re.escape(t) for t in terms)


def has_script(text: Column, char_class: str) -> Column:
    """Whether any character of the class, such as ``[\\u0B80-\\u0BFF]``, occurs."""
    return text.rlike(char_class)


def has_term(lowered: Column, terms: Sequence[str]) -> Column:
    """Whether any term stands between characters outside a-z and 0-9."""
    terms = [t for t in terms if t]
    return lowered.rlike(f"(?<![a-z0-9])(?:{_alternation(terms)})(?![a-z0-9])") if terms else F.lit(False)


def first_term(lowered: Column, terms: Sequence[str]) -> Column:
    """The first term of the list (not of the text) that occurs, else null."""
    return F.coalesce(*(F.when(has_term(lowered, [t]), F.lit(t)) for t in terms), F.lit(None).cast("string"))


def strip_markers(text: Column, markers: Sequence[str]) -> Column:
    """Markers removed as whole words in any case, runs of white space made one blank, ends trimmed."""
    words = rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{_alternation(markers)})(?![\p{{L}}\p{{N}}_])"
    return F.trim(F.regexp_replace(F.regexp_replace(text, words, ""), r"[ \t\n\r]+", " "))


def evidence(title: Column, label: Column, fallback: Column) -> Column:
    """Cleaned title with a bracketed label where known; the fallback if that is empty."""
    tagged = F.when(label.isNotNull() & (label != "UNKNOWN"), F.concat(title, F.lit(" ["), label, F.lit("]"))).otherwise(title)
    return F.coalesce(F.nullif(F.trim(tagged), F.lit("")), fallback)


MEDIA_MARKS = ("v=", "youtu.be/", "/shorts/", "/watch/")  # fixed values: what stands before an id


def media_id(url: Column) -> Column:
    """The 11-character id behind the first of MEDIA_MARKS that has one; else what is taken for a bare id, the input itself."""
    found = F.regexp_extract(url, f"(?:{_alternation(MEDIA_MARKS)})([A-Za-z0-9_-]{{11}})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), url)


def path_parts(path: Column) -> dict[str, Column]:
    """Directory, base name, stem and extension of a path."""
    base = F.substring_index(path, "/", -1)
    ext = F.regexp_extract(base, r"\.([^.]*)$", 1)
    return {
        "directory": F.regexp_extract(path, r"^(.*)/[^/]*$", 1),
        "base": base,
        "stem": F.regexp_replace(base, r"\.[^.]*$", ""),
        "extension": F.lower(ext),
    }


def object_uri(*segments: Column) -> Column:
    """Segments joined by slashes; empty and null ones are skipped."""
    return F.concat_ws("/", *(F.nullif(s, F.lit("")) for s in segments))


_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """White space of any kind taken off both ends."""
    return F.regexp_replace(text, _EDGES, "")


def sentences(text: Column) -> Column:
    """Stripped pieces between line breaks and ``. ! ? |``, empty ones dropped."""
    return F.filter(F.transform(F.split(text, r"[\n.!?|]+"), strip), lambda s: s != "")


def verses(text: Column, lines: int = 3) -> Column:
    """Sentences laid out in numbered verses.

    A verse ends after ``lines`` sentences, but not at a sentence that reads the same as the
    last one: a refrain holds the break back to the next sentence that may have it. A text of
    separators alone is one line; a null or blank one gives the instrumental marker.
    """
    whole = strip(F.coalesce(text, F.lit("")))

    def lay(found: Column) -> Column:
        parts = F.when(F.size(found) > 0, found).otherwise(F.array(whole))
        return _bound(parts, lambda p: _bound(_verse_ends(p, lines), lambda ends: _joined_verses(p, ends)))

    laid = _bound(sentences(whole), lay)
    return F.when(whole == "", F.lit("[Verse 1]\n[Instrumental / No Speech Detected]")).otherwise(laid)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, even where lambdas read it again and again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _verse_ends(parts: Column, lines: int) -> Column:
    """How many sentences lie before each break, ascending; only numbers are folded."""

    def step(state: Column, s: Column) -> Column:
        at = state["at"] + 1
        ends = (at - state["last"] >= lines) & (s != F.element_at(parts, -1))
        return F.struct(
            at.alias("at"),
            F.when(ends, at).otherwise(state["last"]).alias("last"),
            F.when(ends, F.concat(state["ends"], F.array(at))).otherwise(state["ends"]).alias("ends"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("last"), F.array().cast("array<int>").alias("ends"))
    return F.aggregate(parts, start, step, lambda state: state["ends"])


def _joined_verses(parts: Column, ends: Column) -> Column:
    def verse(k: Column) -> Column:
        first = F.when(k > 0, F.get(ends, k - 1)).otherwise(0)
        behind = F.coalesce(F.get(ends, k), F.size(parts))
        head = F.concat(F.lit("[Verse "), (k + 1).cast("string"), F.lit("]\n"))
        return F.concat(head, F.array_join(F.slice(parts, first + 1, behind - first), "\n"))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.size(ends)), verse), "\n\n")


def lyrics_file(title: Column, artist: Column, slug: Column, source: Column, text: Column) -> Column:
    """Five header lines, a blank one, then the verses. Labels and fallbacks are fixed values."""
    known = lambda c, fallback: F.coalesce(F.nullif(c, F.lit("")), F.lit(fallback))
    head = [
        F.concat(F.lit("Title: "), known(title, "Tamil Folk Song")),
        F.concat(F.lit("Artist: "), known(artist, "Unknown Artist")),
        F.lit("Language: Tamil"),
        F.concat(F.lit("Source: "), known(source, "YouTube")),
        F.concat(F.lit("Category: "), F.coalesce(slug, F.lit(""))),
        F.lit(""),
    ]
    return F.concat_ws("\n", *head, verses(text))


def endpoint(url: Column, path: str = "/api/transcribe") -> Column:
    """A service address with its path: added unless the address ends in it or in its last part."""
    clean = strip(F.coalesce(url, F.lit("")))
    named = clean.endswith(path) | clean.endswith("/" + path.rsplit("/", 1)[-1])
    return F.when((clean == "") | named, clean).otherwise(F.concat(F.regexp_replace(clean, "/+$", ""), F.lit(path)))


def response_text(body: Column) -> Column:
    """The transcript in a JSON answer: the first of text, transcript and result that is not empty.

    A list of strings or of segments with a ``text`` is joined without separators; what is no
    JSON object gives the empty string.
    """
    answer = F.try_parse_json(body)

    def field(name: str) -> Column:
        listed = F.try_variant_get(answer, f"$.{name}", "array<variant>")
        segments = F.transform(
            listed, lambda x: F.coalesce(F.try_variant_get(x, "$.text", "string"), F.try_variant_get(x, "$", "string"), F.lit(""))
        )
        plain = F.try_variant_get(answer, f"$.{name}", "string")
        filled = F.when(F.size(listed) > 0, F.array_join(segments, ""))
        return F.when(listed.isNotNull(), filled).otherwise(F.nullif(plain, F.lit("")))

    return strip(F.coalesce(*map(field, ("text", "transcript", "result")), F.lit("")))


def _lcs(a: str, b: str) -> int:
    """Longest common subsequence, by one integer a column (bit-parallel)."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Indel similarity, 0 to 100."""
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best similarity of the shorter text to a window of the longer."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    best = _best_window(short, long)
    # Of two texts of one length either may be the window.
    return max(best, _best_window(long, short)) if len(short) == len(long) else best


def _best_window(short: str, long: str) -> float:
    """Over windows of the short text's length, and shorter ones at both ends.

    Up to 64 characters all windows are scored at once, by the step of ``_lcs`` on an array of integers, one for each
    window; a step takes the next character of every window.
    """
    n, m = len(short), len(long)
    if n > 64:
        return max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, m))
    masks: dict[int, int] = {}
    for i, c in enumerate(short):
        masks[ord(c)] = masks.get(ord(c), 0) | 1 << i
    codes = np.frombuffer(long.encode("utf-32-le", "surrogatepass"), np.uint32)
    seen, place = np.unique(codes, return_inverse=True)
    of_char = np.array([masks.get(c, 0) for c in seen.tolist()], np.uint64)
    none = np.zeros(n - 1, np.uint64)
    padded = np.concatenate([none, of_char[place], none])  # before the start and behind the end nothing matches
    full = np.uint64((1 << n) - 1)
    row = np.full(m + n - 1, full)
    for k in range(n):
        hit = row & padded[k : k + len(row)]
        row = (row + hit) | (row - hit)
    common = n - np.bitwise_count(row & full).astype(np.int64)
    ends = np.arange(1, len(row) + 1)
    held = np.minimum(np.minimum(ends, n), len(row) + 1 - ends)
    return float((200.0 * common / (n + held)).max())


def token_set_ratio(a: str, b: str) -> float:
    """Best similarity among the common words and each side's common plus own words."""
    x, y = set(a.split()), set(b.split())
    common = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, (common, " ".join(sorted(s))))) for s in (x - y, y - x))
    if common and (not x - y or not y - x):
        return 100.0
    return max(ratio(left, right), ratio(common, left) if common else 0.0, ratio(common, right) if common else 0.0)


def keyword_score(text: str, keyword: str) -> float:
    """Non-Latin keywords: 100 if contained, else partial; Latin ones: the better of both, lowered."""
    if any(ord(c) > 0x24F for c in keyword):
        return 100.0 if keyword in text else partial_ratio(keyword, text)
    low, key = text.lower(), keyword.lower()
    return max(partial_ratio(key, low), token_set_ratio(key, low))


def _scores(texts: pd.Series, keywords: pd.Series) -> pd.Series:
    return pd.Series([keyword_score(t or "", k or "") for t, k in zip(texts, keywords, strict=True)], dtype="float64")


def fuzzy_score(text: Column, keyword: Column) -> Column:
    return F.pandas_udf(_scores, "double")(text, keyword)


def keyword_scores(text: Column, keywords: Column, threshold: float) -> Column:
    """A struct of the best score of any keyword, the first listed that has it, and how many reach the threshold.

    Keywords are trimmed and blank ones left out; a score of 0 has no keyword. A null text gives nulls and costs nothing.
    """

    def run(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for text, words in zip(texts, lists, strict=True):
            if text is None:
                rows.append((None, None, None))
                continue
            named = [k.strip() for k in (words if words is not None else []) if k and k.strip()]
            scores = [keyword_score(text, k) for k in named]
            best = max(scores, default=0.0)
            rows.append((best, named[scores.index(best)] if best > 0 else None, sum(s >= threshold for s in scores)))
        return pd.DataFrame(rows, columns=["best", "keyword", "hits"]).astype({"hits": "Int64"})

    return F.pandas_udf(run, "best double, keyword string, hits long")(text, keywords)

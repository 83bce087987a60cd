"""Token counts of whole texts by a sentence-piece model, mostly by table look-up.

A text is cut into pre-tokens at places that no merge can cross: a merge makes a string of the
vocabulary, so none crosses two characters that stand side by side in no vocabulary string. Blanks open
a pre-token (no vocabulary string has a blank after another character), and a character that no longer
string holds is one of its own. So the tokens of a text are those of its pre-tokens. For the
strings of the vocabulary it is then proved, once per process and with the library itself, which of them
encode alone as one token: a pre-token of that table counts as one. Only the others are merged, each
distinct one of a batch once, by the library.

``Counter.cuts`` is tested on the model when it is loaded: where the model folds or strips
characters, or the proof fails, whole texts go through the library. There is no exchange: texts are counted where they are read.

Defined cases: a null text is empty and has no tokens; texts and pre-tokens of any length are counted
whole; strings of special tokens in a text are plain text, as the library takes them; rows that repeat keep a row
each; null ids are carried; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter as Tally
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
BLANK = "▁"  # what the model writes for a blank
APART = "\n"  # set before a pre-token that is merged alone, so that the blank put before every text isn't its own
PROBES = ("a  b ", "ﬁ Ａ é é", " ▁x　y z", "\ta\r\n\nb\x00c", "<s>a</s>​ ", "x" * 70 + " " * 40)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    """Counts of one model, with a bounded table of merged pre-tokens."""

    KEPT = 500_000

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(self.model.get_piece_size()) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        strings = {self.model.id_to_piece(i): i for i in plain}
        social = {c for s in strings if len(s) > 1 for c in s} - {BLANK}
        inside = "".join(map(re.escape, sorted(social)))
        self.pattern = re.compile(f"{BLANK}+[{inside}]*|[{inside}]+|[^{BLANK}{inside}]")
        blanks_first = all(BLANK not in s.lstrip(BLANK) for s in strings)
        self.alone: frozenset[str] = frozenset()
        self.merged: dict[str, int] = {}
        self.cuts = blanks_first and APART not in social and not any(self.model.is_unused(i) for i in plain)
        if self.cuts:
            self.apart = len(self.model.encode(APART))
            whole = [s for s in strings if self.pattern.fullmatch(s)]
            self.alone = frozenset(s for s, ids in zip(whole, self._encode(whole), strict=True) if ids[self.apart :] == [strings[s]])
            self.cuts = all(self.count(p) == self.library(p) for p in PROBES)

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode([APART + p.replace(BLANK, " ") for p in pieces], num_threads=1)

    def library(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def count(self, text: str) -> int:
        return self.count_all([text])[0]

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a pre-token that is not in the table is merged once for all of them."""
        if not self.cuts:
            return [self.library(t) for t in texts]
        alone, merged = self.alone, self.merged
        tallies = [Tally(self.pattern.findall(BLANK + t.replace(" ", BLANK))) if t else Tally() for t in texts]
        if len(merged) > self.KEPT:
            merged.clear()
        rest = list({p for tally in tallies for p in tally if p not in alone and p not in merged})
        for piece, ids in zip(rest, self._encode(rest), strict=True):
            merged[piece] = len(ids) - self.apart
        return [sum(n if p in alone else n * merged[p] for p, n in tally.items()) for tally in tallies]


GROUP_CHARS = 1 << 20  # texts are counted together up to this length


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text)
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


_OF_PATH: dict[str, Counter] = {}


def _count(path: str):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _OF_PATH:
            _OF_PATH[path] = Counter(path)
        counter = _OF_PATH[path]
        for batch in batches:
            counts = [n for group in _groups(batch["text"].tolist()) for n in counter.count_all(group)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": counts})

    return run


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("string"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInPandas(_count(path or default_model()), "doc_id string, n_bytes long, n_tokens long")
    return counted.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

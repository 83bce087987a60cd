"""BPE encoding and decoding with content-defined chunk reuse.

Distinct texts are cut into chunks by a rolling hash (see ``cdc``). A chunk that stands in more
than one place is encoded once, by the task that holds one of its texts, from its first blank to its
last; the ids are then joined to all its places. What lies between such stretches is encoded in
place. Then every joint is repaired: a window of words around it is encoded again as a whole
and compared with the ids on both sides. Where they agree exactly the joint stands; else the
window grows, and when it has taken up both stretches they are encoded as one.

Texts move once, by content key (copies are merged before the exchange, so a group of copies of
any size is one row); what else is shuffled are chunk digests and the ids of shared chunks.
For a tokenizer whose tokens never depend on white space a word is encoded once while it stays in
the task's bounded table, and a stretch is put together from words; for any other a stretch goes
through the library whole.

Defined cases: a null text is empty; the empty text has no ids; very long texts and words are
encoded whole; rows that repeat keep a row each; null ids are carried; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cdc import Sizes, cut_points
from .common import text_key

SIZES = Sizes(512, 2048, 8192)
_BLANK = re.compile(rb"[ \t\n\r]")
_WORD = re.compile(r"[^ \t\n\r]+")
_BLANKS = " \t\n\r"
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def _byte_symbols() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


_BYTE_SYMBOLS = _byte_symbols()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """A tokenizer file with bounded tables of the words and joints it has seen.

    Where the file lower-cases, splits off runs of letters and lets no match span white space, a
    new word of Latin letters and closing marks is put together from the ids of these two
    pieces, each taken from the model directly; any other word goes through the whole library
    call. Words unused since the table was last renewed are forgotten.
    """

    LIMIT = 300_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_word = ids("one two\n three,  \tx") == ids("one") + ids("two") + ids("three,") + ids("x")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.decimal = [str(i) for i in range(size)]
        self.token = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.joints: dict[tuple[str, str], bool] = {}
        self.by_piece = self.by_word and all(ids(t) == self._model_ids(t.lower()) for t in ("Straße", "PRÉsent", "un", "zzqqÿ")) and ids(
            "Ab.,!"
        ) == ids("ab") + ids(".,!")

    def _model_ids(self, piece: str) -> list[int]:
        symbols = piece.encode().decode("latin-1").translate(_BYTE_SYMBOLS)
        return [t.id for t in self.tokenizer.model.tokenize(symbols)]

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) > self.LIMIT:
                self.pieces.clear()
            self.pieces[piece] = got = np.array(self._model_ids(piece), self.kind).tobytes()
        return got

    def _word(self, word: str) -> bytes:
        got = self.before.get(word)
        if got is None:
            simple = _SIMPLE.fullmatch(word) if self.by_piece else None
            if simple:
                got = b"".join(self._piece(p) for p in (simple[1].lower(), simple[2]) if p)
            else:
                got = self.whole(word)
        if len(self.words) >= self.LIMIT:
            self.before, self.words = self.words, {}
        self.words[word] = got
        return got

    def whole(self, text: str) -> bytes:
        """Ids that the library gives the text, packed."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of the text, packed."""
        if not self.by_word:
            return self.whole(text)
        known = self.words.get
        return b"".join([known(w) or self._word(w) for w in _WORD.findall(text)])

    def unpack(self, ids: bytes) -> list[int]:
        return np.frombuffer(ids, self.kind).tolist()

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: tokens joined by blanks."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(map(self.token.__getitem__, ids))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The chunks of each text: digest, and where the text between their outer blanks lies.

    Chunks without two blanks have nothing that can be reused and are left out.
    """
    for batch in batches:
        rows = []
        for key, text in zip(batch["key"], batch["text"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            start = 0
            for end in cut_points(data, SIZES):
                first = _BLANK.search(data, start, end)
                if first:
                    last = max(data.rfind(b, start, end) for b in (b" ", b"\t", b"\n", b"\r"))
                    if last > first.start():
                        rows.append((key, first.start(), last, xxhash.xxh3_128_digest(data[start:end])))
                start = end
        yield pd.DataFrame(rows, columns=["key", "start", "end", "digest"])


def _encode_owned(path: str):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            ids = []
            for text, start, end in zip(batch["text"], batch["start"], batch["end"], strict=True):
                body = text.encode("utf-8", "surrogatepass")[start:end]
                ids.append(encoder.encode(body.decode("utf-8", "surrogatepass")))
            yield pd.DataFrame({"digest": batch["digest"], "ids": ids})

    return run


def _tail(text: str, words: int) -> str:
    """The last words of the text, from the blank before them on."""
    at = len(text.rstrip(_BLANKS))
    for _ in range(words):
        at = max(text.rfind(b, 0, at) for b in _BLANKS)
        if at < 0:
            return text
    return text[at:]


def _head(text: str, words: int) -> str:
    """The first words of the text, up to the blank behind them."""
    at = 0
    for _ in range(words):
        found = _WORD.search(text, at)
        if not found:
            return text
        at = found.end()
    return text[:at]


def joint_holds(encoder: Encoder, left: tuple[str, bytes], right: tuple[str, bytes]) -> bool:
    """Whether some window around the joint of two (text, ids) encodes as the two sides do.

    The window starts with a word of each side and doubles until it agrees or has taken up both.
    """
    words = 1
    while True:
        a, b = _tail(left[0], words), _head(right[0], words)
        agrees = encoder.joints.get((a, b))
        if agrees is None:
            agrees = encoder.whole(a + b) == encoder.encode(a) + encoder.encode(b)
            if len(encoder.joints) >= encoder.LIMIT // 4:
                encoder.joints.clear()
            encoder.joints[a, b] = agrees
        if agrees and left[1].endswith(encoder.encode(a)) and right[1].startswith(encoder.encode(b)):
            return True
        if len(a) == len(left[0]) and len(b) == len(right[0]):
            return False
        words *= 2


def assemble(encoder: Encoder, text: str, reuse: list[tuple[int, int, bytes]]) -> list[int]:
    """Ids of a text, some stretches (start, end, ids) of which are known; joints are repaired."""
    data = text.encode("utf-8", "surrogatepass")
    read = lambda a, b: data[a:b].decode("utf-8", "surrogatepass")
    parts: list[tuple[str, bytes]] = []
    at = 0
    for start, end, ids in [*sorted(reuse, key=lambda r: r[0]), (len(data), len(data), b"")]:
        for part in ((read(at, start), None), (read(start, end), ids)):
            if not part[0]:
                continue
            part = (part[0], encoder.encode(part[0]) if part[1] is None else part[1])
            while parts and not joint_holds(encoder, parts[-1], part):
                whole = parts.pop()[0] + part[0]
                part = (whole, encoder.whole(whole))
            parts.append(part)
        at = end
    return encoder.unpack(b"".join(ids for _, ids in parts))


def _assemble_texts(path: str, full: bool):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            for key, text, reuse in zip(batch["key"], batch["text"], batch["reuse"], strict=True):
                known = [(r["start"], r["end"], r["ids"]) for r in reuse] if reuse is not None else []
                ids = assemble(encoder, text, known)
                if full:
                    rows.append((key, ids, encoder.decode(ids)))
                else:
                    decimal = " ".join(map(encoder.decimal.__getitem__, ids))
                    decoded = encoder.decode(ids).encode("utf-8", "surrogatepass")
                    rows.append((key, len(ids), sha256(decimal.encode()).hexdigest(), sha256(decoded).hexdigest()))
            yield pd.DataFrame(rows, columns=["key", "ids", "decoded"] if full else ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded_texts(docs: DataFrame, path: str, full: bool) -> DataFrame:
    # All uses of ``texts`` below read one exchange; that no key is null is said here, as the
    # filters that joins add for it would make their plans differ from the others.
    texts = (
        docs.select(text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
        .where("key is not null")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    chunks = texts.mapInPandas(_cut, "key binary, start int, end int, digest binary")
    shared = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("key", "start", "end")).alias("owner"))
    shared = shared.where("n > 1").select("digest", "owner.*")
    encoded = texts.join(shared, "key").select("digest", "text", "start", "end").mapInPandas(_encode_owned(path), "digest binary, ids binary")
    places = chunks.join(encoded, "digest").groupBy("key").agg(F.collect_list(F.struct("start", "end", "ids")).alias("reuse"))
    joined = texts.join(places, "key", "left")
    kind = "ids array<int>, decoded string" if full else "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return joined.select("key", "text", "reuse").mapInPandas(_assemble_texts(path, full), f"key binary, {kind}")


def _by_row(docs: DataFrame, by_text: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(by_text, "key").drop("key")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) for each row."""
    return _by_row(docs, _encoded_texts(docs, path or default_tokenizer(), full=True))


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row."""
    return _by_row(docs, _encoded_texts(docs, path or default_tokenizer(), full=False))

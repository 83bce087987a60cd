"""Duplicates among a stream of prints: the kept prints live in keyed state, rows are decided in arrival order.

All rows of one key meet one state, so a key should be what duplicates must share (a category, say): only within it are they
looked for. The batch counterpart is ``operators.dedupe.greedy`` over the rows of one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SHARE = 256  # prints in one entry of the state


def _similarities(kept: list[np.ndarray], one: np.ndarray) -> np.ndarray:
    """Share of equal bits with each kept print, over the common prefix."""
    out = np.zeros(len(kept))
    for i, other in enumerate(kept):
        n = min(len(one), len(other))
        if n:
            out[i] = 1 - int(np.bitwise_count(one[:n] ^ other[:n]).sum()) / (32 * n)
    return out


class KeptPrints(StatefulProcessor):
    """State of a key: a map from the number of a share to the orders and prints that were kept, ``SHARE`` of them in each."""

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.shares = handle.getMapState("shares", "share int", "ords array<bigint>, sizes array<int>, words binary")

    def _load(self) -> tuple[list[int], list[np.ndarray]]:
        ords: list[int] = []
        prints: list[np.ndarray] = []
        for _, (own, sizes, words) in sorted(self.shares.iterator(), key=lambda s: s[0][0]):
            ords += own
            prints += np.split(np.frombuffer(words, np.uint32), np.cumsum(sizes)[:-1])
        return ords, prints

    def _save(self, ords: list[int], prints: list[np.ndarray], known: int) -> None:
        """Write the shares that got prints, from the one that the first new print falls into."""
        for share in range(known // SHARE, -(-len(ords) // SHARE)):
            own = slice(share * SHARE, (share + 1) * SHARE)
            words = np.concatenate(prints[own]).astype(np.uint32).tobytes()
            self.shares.updateValue((share,), (ords[own], [len(p) for p in prints[own]], words))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values("ord")
        ords, prints = self._load()
        known = len(ords)
        decided: list[int | None] = []
        for order, fp in zip(batch["ord"], batch["fp"], strict=True):
            one = np.array([] if fp is None else fp, np.int64).astype(np.uint32)
            if not len(one):
                decided.append(None)
                continue
            found = _similarities(prints, one)
            best = int(found.argmax()) if len(found) else -1  # the earliest of equals
            if best >= 0 and found[best] >= self.threshold:
                decided.append(ords[best])
            else:
                decided.append(None)
                ords.append(int(order))
                prints.append(one)
        if len(ords) > known:
            self._save(ords, prints, known)
        yield pd.DataFrame({"key": key[0], "ord": batch["ord"], "duplicate_of": pd.array(decided, "Int64")})

    def close(self) -> None:
        pass


def streamed_duplicates(prints: DataFrame, threshold: float, key: str = "category_slug") -> DataFrame:
    """(key, ord, duplicate_of) for a stream ``prints(key, ord, fp)``; ``duplicate_of`` is null for kept rows.

    Rows of one micro-batch are decided by ``ord``, micro-batches as they come; where orders rise from batch to batch the decisions are those
    of ``greedy`` over all rows of the key. Rows without a print are kept and not remembered. State is only written for
    kept prints. Needs the RocksDB state store.
    """
    kind = dict(prints.dtypes)[key]
    rows = prints.select(prints[key].alias("key"), "ord", "fp").groupBy("key")
    processor = KeptPrints(threshold)
    return rows.transformWithStateInPandas(processor, f"key {kind}, ord bigint, duplicate_of bigint", "append", "none").withColumnRenamed("key", key)

"""Search: a callable over a table of sources, and a data source with one input partition a query.

The data source takes option ``fetch`` (``module:function``, called as function(query, limit)) or, for tests, ``canned`` hits.
"""

from __future__ import annotations

import importlib
import json
import logging
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .retry import with_retry

HIT = "recording_id string, title string, channel string, channel_id string, duration_sec double, description string, url string, query string, hit_ord int"

_log = logging.getLogger("gleaner")

Fetch = Callable[[str, int], Iterable[Mapping[str, Any]]]


def _hits(found: Iterable[Mapping[str, Any] | None], query: str, limit: int) -> Iterator[tuple]:
    """Hits without an id are dropped; title, channel and address fall back as far as known."""
    n = 0
    for hit in found:
        if n >= limit:
            return
        if not hit or not hit.get("id"):
            continue
        url = hit.get("url") or hit.get("webpage_url") or f"id:{hit['id']}"
        channel = hit.get("channel") or hit.get("uploader") or ""
        yield (hit["id"], hit.get("title") or "", channel, hit.get("channel_id"), float(hit.get("duration") or 0), hit.get("description") or "", url, query, n)
        n += 1


def search(sources: DataFrame, fetch: Fetch, attempts: int = 2, pause: float = 2.0) -> DataFrame:
    """Hits of every source ``(query, source_ord, most)`` by ``fetch(query, most)``, called in tasks, with ``source_ord``.

    A source is tried again after a failure and left out if it fails for good, which its task logs; ``failed_sources`` names those.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in HIT.split(", ")]
        for batch in batches:
            for query, place, most in zip(batch["query"], batch["source_ord"], batch["most"], strict=True):
                try:
                    found = with_retry(lambda q=query, m=most: list(_hits(fetch(q, int(m)), q, int(m))), attempts, pause)
                except Exception as e:
                    _log.warning("the source %r failed: %r", query, e)
                    continue
                yield pd.DataFrame(found, columns=names).assign(source_ord=place)

    return sources.select("query", "source_ord", "most").mapInPandas(run, f"{HIT}, source_ord int")


def failed_sources(sources: DataFrame, hits: DataFrame) -> DataFrame:
    """Sources of ``search`` that gave no hit at all, whether they failed or have none."""
    return sources.join(hits.select("query", "source_ord").distinct(), ["query", "source_ord"], "left_anti")


class _Query(InputPartition):
    def __init__(self, text: str) -> None:
        self.text = text


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.queries = json.loads(options["queries"])
        canned = json.loads(options.get("canned", "{}"))
        self.place = options.get("fetch")
        self.fetch = self._named if self.place else lambda text, _: canned.get(text, [])
        self.limit = int(options.get("limit", "100"))

    def _named(self, text: str, limit: int) -> Iterable[Mapping[str, Any]]:
        module, name = self.place.split(":")
        return with_retry(lambda: list(getattr(importlib.import_module(module), name)(text, limit)))

    def partitions(self) -> list[InputPartition]:
        return [_Query(q) for q in self.queries]

    def read(self, partition: _Query) -> Iterator[tuple]:
        yield from _hits(self.fetch(partition.text, self.limit), partition.text, self.limit)


class SearchSource(DataSource):
    """``spark.dataSource.register(SearchSource)``, then ``format("gleaner_search")``."""

    @classmethod
    def name(cls) -> str:
        return "gleaner_search"

    def schema(self) -> str:
        return HIT

    def reader(self, schema: object) -> _Reader:
        return _Reader(self.options)

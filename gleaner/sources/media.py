"""Fetching of recordings by a callable, in tasks, brought to one form and staged."""

from __future__ import annotations

import io
import posixpath
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .retry import with_retry
from .storage import put_bytes, staged_file

RATE = 16000


def to_mono(content: bytes, rate: int = RATE) -> bytes:
    """WAV bytes as a mono 16-bit file of the rate; what is no WAV file raises ValueError."""
    from ..operators.audio import decode_wav, encode_wav
    from ..operators.prints import resampled

    y, own, _ = decode_wav(content)
    return encode_wav(resampled(y, own, rate), rate)


def fetch(
    candidates: DataFrame, get: Callable[[str], bytes], staging: str, convert: Callable[[bytes], bytes] = to_mono, parallel: int = 2, tasks: int | None = None,
    attempts: int = 2, pause: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``candidates(recording_id, url, ...)`` with path, fetched and fetch_error.

    ``get`` gives the bytes behind an address, ``convert`` brings them to the form of the chain; the file is staged as ``staging/id.wav``, a folder
    that all tasks and the next stages reach. A file that is staged already, under any audio extension, is used as it is, so a
    run that is repeated fetches only what it lacks. At most ``parallel`` fetches run at once in a task, and ``tasks`` times that in all.
    What can't be fetched or converted has ``fetched`` false, as the chain's DOWNLOAD_FAILED wants it. A recording that several
    rows name is fetched once.
    """
    wanted = candidates.groupBy("recording_id").agg(F.min("url").alias("url"))
    wanted = wanted.repartition(tasks) if tasks else wanted

    def one(name: str, url: str) -> tuple:
        try:
            there = staged_file(staging, name)
            if there is None:
                there = posixpath.join(staging, f"{name}.wav")
                put_bytes(there, convert(with_retry(lambda: get(url), attempts, sleep=pause)))
            return there, True, None
        except Exception as e:
            return None, False, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(parallel) as pool:
            for batch in batches:
                found = pool.map(one, batch["name"], batch["url"])
                yield pd.concat([batch["name"], pd.DataFrame(list(found), columns=["path", "fetched", "fetch_error"], index=batch.index)], axis=1)

    got = wanted.select(F.col("recording_id").cast("string").alias("name"), "url").mapInPandas(run, "name string, path string, fetched boolean, fetch_error string")
    return candidates.join(got, F.col("recording_id").cast("string") == F.col("name"), "left").drop("name").withColumn("fetched", F.coalesce("fetched", F.lit(False)))


def contents(fetched: DataFrame) -> DataFrame:
    """(recording_id, path, content) of what was fetched, read in tasks from where it is staged."""
    from .storage import read_file

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):  # a file at a time is held
                row = batch.iloc[i : i + 1]
                yield row.assign(content=[io.BytesIO(read_file(row["path"].iloc[0])).getvalue()])

    kind = dict(fetched.dtypes)["recording_id"]
    return fetched.where("fetched").select("recording_id", "path").distinct().mapInPandas(run, f"recording_id {kind}, path string, content binary")

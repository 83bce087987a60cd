"""Texts of recordings by calls to a service or model, and the pass that makes those that are still missing."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lyrics_file, path_parts, response_text
from ..sources.retry import with_retry
from ..sources.storage import LEAST_TEXT_BYTES, backfill_totals, list_files, missing_transcripts, put_files, read_file

Call = Callable[[bytes], str]


def answered(content: bytes, calls: Sequence[Call], attempts: int, pause: Callable[[float], None]) -> tuple[str, int]:
    """The first answer and the number of the call that gave it; a round asks each call once, and rounds are tried again."""

    def one_round() -> tuple[str, int]:
        for n, call in enumerate(calls):
            try:
                return call(content), n
            except Exception:
                if n == len(calls) - 1:
                    raise
        raise ValueError("there is nothing to call")

    return with_retry(one_round, attempts, sleep=pause)


def transcribe(
    files: DataFrame, calls: Sequence[Call], parallel: int = 1, tasks: int | None = None, attempts: int = 2, json: bool = True, pause: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """(path, text, answered_by, error) for ``files(path)``, or ``files(path, content)`` where the bytes are at hand.

    ``calls`` are the primary and what to fall back on, each taking a file's bytes and giving an answer: a JSON object as
    ``response_text`` reads it, or with ``json`` off the text itself. At most ``parallel`` calls run at once in a task, and
    ``tasks`` times that in all if given; a task holds the bytes of so many files. A row that fails for good keeps a null text and its error; the
    others go on. An answer without text is an empty text. A call may be made again if a task is.
    """
    given = "content" in files.columns
    rows = files.select("path", *(["content"] if given else []))
    rows = rows.repartition(tasks) if tasks else rows

    def one(path: str, content: bytes | None) -> tuple:
        try:
            text, by = answered(bytes(content) if given else read_file(path), calls, attempts, pause)
            return path, text, by, None
        except Exception as e:
            return path, None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(parallel) as pool:
            for batch in batches:
                contents = batch["content"] if given else [None] * len(batch)
                yield pd.DataFrame(list(pool.map(one, batch["path"], contents)), columns=["path", "answer", "answered_by", "error"]).astype({"answered_by": "Int32"})

    found = rows.mapInPandas(run, "path string, answer string, answered_by int, error string")
    text = F.when(F.col("answer").isNotNull(), response_text(F.col("answer")) if json else F.col("answer"))
    return found.select("path", text.alias("text"), "answered_by", "error")


def backfill(spark: SparkSession, root: str, calls: Sequence[Call], write: Callable[[DataFrame], DataFrame] = put_files, force: bool = False,
             least_bytes: int = LEAST_TEXT_BYTES, **options: object) -> tuple[DataFrame, DataFrame]:
    """Make the texts that audio files under ``root`` lack; decisions are not taken again.

    Gives (path, text_path, error) of each file that was tried, and one row of totals over all audio files. Only what is missing is
    tried, and a text appears whole or not at all, so the pass may be run again at any time; with ``force`` all are made anew.
    """
    from .dedupe import _checkpoint

    listing = _checkpoint(list_files(spark, root))
    every = missing_transcripts(listing, force=True)
    wanted = every if force else missing_transcripts(listing, least_bytes)
    made = transcribe(wanted, calls, **options)
    part = path_parts(F.col("path"))
    slug = F.substring_index(part["directory"], "/", -1)
    address = F.concat(F.lit("https://www.youtube.com/watch?v="), part["stem"])
    content = lyrics_file(F.format_string("Tamil Folk Song (%s)", part["stem"]), F.lit(None).cast("string"), slug, address, F.col("text"))
    text_path = F.concat(part["directory"], F.lit("/"), part["stem"], F.lit(".txt"))
    texts = _checkpoint(made.select("path", text_path.alias("text_path"), content.cast("binary").alias("content"), "error"))
    put = write(texts.where("error is null").select(F.col("text_path").alias("path"), "content")).select(F.col("path").alias("text_path"), F.col("error").alias("_put"))
    tried = _checkpoint(texts.drop("content").join(put, "text_path", "left").select("path", "text_path", F.coalesce("error", "_put").alias("error")))
    attempts = every.select("path").join(tried.select("path", "error", F.lit(True).alias("tried")), "path", "left")
    return tried, backfill_totals(attempts.select(F.col("tried").isNull().alias("done"), (F.col("tried") & F.col("error").isNull()).alias("success")))

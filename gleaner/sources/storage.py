"""Stored outputs: paths, listings, what is there and what is missing, and the sinks."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.text import object_uri, path_parts

AUDIO = ("wav", "mp3", "m4a", "flac", "ogg", "opus")  # fixed values
LEAST_TEXT_BYTES = 20
COPY_BYTES = 1 << 20


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length) of the files under a folder of any file system; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length")


def audio_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Files with an audio extension, in upper or lower case."""
    return list_files(spark, root, recursive=recursive).where(path_parts(F.col("path"))["extension"].isin(*AUDIO))


def output_path(root: Column, state: Column, slug: Column, recording_id: Column, extension: str, review: Column) -> Column:
    """``root/state[/review]/slug/id.extension``; empty segments are skipped."""
    return object_uri(root, state, F.when(review, F.lit("review")), slug, F.concat(recording_id, F.lit(f".{extension}")))


def stored(decided: DataFrame, listing: DataFrame, root: str, state: str, texts: bool = True) -> DataFrame:
    """The rows of ``decided(recording_id, category_slug, decision)`` whose files are listed.

    ACCEPT wants its audio and, with ``texts``, its transcript; REVIEW its audio in the review folder.
    """
    review = F.col("decision") == "REVIEW"
    place = lambda ext: output_path(F.lit(root), F.lit(state), F.col("category_slug"), F.col("recording_id"), ext, review)
    wanted = decided.withColumn("_audio", place("wav"))
    wanted = wanted.withColumn("_text", F.when((F.col("decision") == "ACCEPT") & F.lit(texts), place("txt")))
    paths = listing.select(F.col("path").alias("_path"))
    found = wanted.join(paths, F.col("_audio") == F.col("_path"), "left_semi")
    needs = found.where("_text is not null").join(paths, F.col("_text") == F.col("_path"), "left_semi")
    return needs.unionByName(found.where("_text is null")).drop("_audio", "_text")


def missing_transcripts(listing: DataFrame, least_bytes: int = LEAST_TEXT_BYTES, force: bool = False) -> DataFrame:
    """Audio files of ``listing(path, length)`` without a text of more than ``least_bytes`` beside them."""
    parts = path_parts(F.col("path"))
    named = listing.withColumn("_stem", F.regexp_replace("path", r"\.[^./]*$", "")).withColumn("_ext", parts["extension"])
    audio = named.where(F.col("_ext").isin(*AUDIO))
    if not force:
        texts = named.where((F.col("_ext") == "txt") & (F.col("length") > least_bytes)).select("_stem")
        audio = audio.join(texts, "_stem", "left_anti")
    return audio.select("path", "length")


def category_counts(listing: DataFrame, root: str) -> DataFrame:
    """(category, accepted, texts, review) from paths below ``root``; categories with texts alone are left out."""
    rel = F.split(F.regexp_replace(F.replace("path", F.lit(root)), "^/+", ""), "/")
    in_review = F.get(rel, F.lit(0)) == "review"
    low = F.lower("path")
    rows = listing.select(
        F.when(in_review, F.when(F.size(rel) > 1, F.get(rel, F.lit(1))).otherwise("unknown")).otherwise(F.get(rel, F.lit(0))).alias("category"),
        in_review.alias("in_review"),
        low.endswith(".wav").alias("audio"),
        low.endswith(".txt").alias("text"),
    )
    counted = rows.groupBy("category").agg(
        F.count_if(F.col("audio") & ~F.col("in_review")).alias("accepted"),
        F.count_if(F.col("text") & ~F.col("in_review")).alias("texts"),
        F.count_if(F.col("audio") & F.col("in_review")).alias("review"),
    )
    return counted.where("accepted + review > 0")


def backfill_totals(attempts: DataFrame) -> DataFrame:
    """One row of totals over ``attempts(done, success)``, two booleans a file."""
    totals = attempts.agg(
        F.count("*").alias("total"), F.count_if("done").alias("done"), F.count_if(~F.col("done") & F.col("success")).alias("transcribed")
    )
    return totals.withColumn("remaining", F.greatest(F.lit(0), F.col("total") - F.col("done") - F.col("transcribed")))


def with_paths(decided: DataFrame, root: str, state: str) -> DataFrame:
    """``decided`` with audio_path and text_path; a REJECT has no place and fails the job.

    All are put in the main folder; only an ACCEPT has a text.
    """
    place = lambda ext: output_path(F.lit(root), F.lit(state), F.col("category_slug"), F.col("recording_id"), ext, F.lit(False))
    refused = F.raise_error(F.concat(F.lit("rejected recordings are not stored: "), "recording_id")).cast("string")
    return decided.withColumns(
        {
            "audio_path": F.when(F.col("decision") == "REJECT", refused).otherwise(place("wav")),
            "text_path": F.when(F.col("decision") == "ACCEPT", place("txt")),
        }
    )


def write_manifest(placed: DataFrame, path: str) -> None:
    """The table of what is stored, partitioned so that a state or category is read alone."""
    placed.write.mode("append").partitionBy("state", "category_slug").parquet(path)


def read_file(path: str) -> bytes:
    """The bytes of one file, in a task, through Arrow's file systems."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as stream:
        return stream.read()


def put_bytes(path: str, content: bytes) -> None:
    """A file appears whole or not at all: it is written beside its place and moved there, so a task that runs twice does no harm."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(posixpath.dirname(place), recursive=True)
    part = f"{place}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(content)
    system.move(part, place)


def copy_files(pairs: DataFrame) -> DataFrame:
    """(path, target, error): copy ``pairs(path, target)`` between any two places, in blocks, when the result is asked for.

    A copy appears whole or not at all; the error of one that failed doesn't stop the others. A null path or target is an error.
    """

    def one(path: str, target: str) -> None:
        from pyarrow import fs

        (own, source), (other, place) = fs.FileSystem.from_uri(path), fs.FileSystem.from_uri(target)
        other.create_dir(posixpath.dirname(place), recursive=True)
        part = f"{place}.{uuid.uuid4().hex}.part"
        with own.open_input_stream(source) as read, other.open_output_stream(part) as out:
            while block := read.read(COPY_BYTES):
                out.write(block)
        other.move(part, place)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors: list[str | None] = []
            for path, target in zip(batch["path"], batch["target"], strict=True):
                try:
                    one(path, target)
                    errors.append(None)
                except Exception as e:
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch.assign(error=errors)

    return pairs.select("path", "target").mapInPandas(run, "path string, target string, error string")


def staged_file(folder: str, name: str) -> str | None:
    """The first of ``folder/name.*`` with an audio extension that is there and not empty."""
    from pyarrow import fs

    for extension in AUDIO:
        path = posixpath.join(folder, f"{name}.{extension}")
        system, place = fs.FileSystem.from_uri(path)
        if (system.get_file_info(place).size or 0) > 0:
            return path
    return None


def put_files(files: DataFrame) -> DataFrame:
    """(path, error): write ``files(path, content)`` when the result is asked for; the error of a file that could not be, else null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    put_bytes(path, bytes(content))
                    errors.append(None)
                except Exception as e:
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"path": batch["path"], "error": errors})

    return files.select("path", "content").mapInPandas(run, "path string, error string")


def write_files(files: DataFrame) -> None:
    """Write ``files(path, content)`` through Arrow's file systems, which take paths and URIs; the first failure fails the job."""

    def run(rows: Iterator[Row]) -> None:
        for row in rows:
            put_bytes(row["path"], bytes(row["content"]))

    files.select("path", "content").foreachPartition(run)

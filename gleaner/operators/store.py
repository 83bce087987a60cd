"""What follows a decision: files of what is kept, texts of what is accepted, one audit line each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lyrics_file
from ..sources.runlog import append_run_log
from ..sources.storage import put_files, with_paths
from .dedupe import _checkpoint
from .transcription import Call, transcribe


def conclude(
    decided: DataFrame, audio: DataFrame, log: str, run: str, root: str, state: str, calls: Sequence[Call] = (),
    write: Callable[[DataFrame], DataFrame] = put_files, texts: bool = True, **options: object,
) -> DataFrame:
    """Store and log the rows of ``decided(recording_id, category_slug, decision, rejection_code, final_score[, title, channel, url])``.

    ``audio(recording_id, content)`` holds the bytes. ACCEPT and REVIEW go to the main folder, REJECT nowhere; an ACCEPT also gets its text, unless
    no call gives one, in which case it stays an ACCEPT and ``backfill`` can make the text later. A file that can't be written
    doesn't change a decision. Last, all rows are logged as the transaction ``run``: to conclude the same run again writes the same files
    and adds no line. Gives (recording_id, decision, audio_path, text_path, error), paths of what was written alone.
    """
    c = F.col
    known = lambda name: c(name) if name in decided.columns else F.lit(None).cast("string").alias(name)
    rows = decided.select("recording_id", "category_slug", "decision", "rejection_code", "final_score", *map(known, ("title", "channel", "url")))
    placed = _checkpoint(with_paths(rows.where("decision <> 'REJECT'"), root, state))
    held = placed.join(audio.select("recording_id", "content"), "recording_id")
    sound = held.select(c("audio_path").alias("path"), "content")
    spoken = held.where("decision = 'ACCEPT'").select(c("audio_path").alias("path"), "content")
    if texts and calls:
        heard = transcribe(spoken, calls, **options).where("text is not null").select(c("path").alias("audio_path"), "text")
        address = F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit("https://www.youtube.com/watch?v="), c("recording_id").cast("string")))
        layout = lyrics_file(c("title"), c("channel"), c("category_slug"), address, c("text"))
        sheets = placed.join(heard, "audio_path").select(c("text_path").alias("path"), layout.cast("binary").alias("content"))
        files = sound.unionByName(sheets)
    else:
        files = sound
    put = _checkpoint(write(files))
    fine = put.where("error is null").select("path")
    result = placed.select("recording_id", "decision", "audio_path", "text_path")
    for name in ("audio_path", "text_path"):
        done = fine.select(c("path").alias(name), F.lit(True).alias("_done"))
        result = result.join(done, name, "left").withColumn(name, F.when(c("_done"), c(name))).drop("_done")
    wrong = placed.select("recording_id", F.explode(F.array_compact(F.array("audio_path", "text_path"))).alias("path"))
    wrong = wrong.join(put.where("error is not null"), "path").groupBy("recording_id").agg(F.min("error").alias("error"))
    append_run_log(decided.select("recording_id", "category_slug", known("title"), "decision", "rejection_code", "final_score"), log, run)
    return result.join(wrong, "recording_id", "left").select("recording_id", "decision", "audio_path", "text_path", "error")

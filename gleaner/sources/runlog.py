"""The append-only run log and fingerprint store, as JSON lines in transactions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .transactions import append_lines, committed_lines

RECORD = "ts string, recording_id string, category_slug string, title string, decision string, rejection_code string, final_score double"
PRINT = "recording_id string, duration double, fingerprint array<bigint>"
EXTRA = "extra map<string, variant>"


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    latest = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def _own_files(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files that stand in the folder itself, or of the one file that the path names."""
    text = spark.read.text(path)
    return text.select("value", F.col("_metadata.file_modification_time").alias("t"), F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("n"))


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parsed lines with ``line``, their place in the order of appends; broken and id-less ones are skipped.

    Lines that were appended here are ordered by their transaction's time, then by the number of their row. Files from
    elsewhere are ordered by their time of change, then by offset, before all of those. Fields
    that the schema doesn't have are kept in ``extra``.
    """
    foreign = F.struct(F.lit(-1).cast("long").alias("stamp"), F.col("t"), F.col("f"), F.col("n"))
    own = F.struct(F.col("stamp"), F.lit(None).cast("timestamp").alias("t"), F.lit("").alias("f"), F.get_json_object("value", "$.row").cast("long").alias("n"))
    text = _own_files(spark, path).select("value", foreign.alias("line"))
    text = text.unionByName(committed_lines(spark, path).select("value", own.alias("line")))
    objects = text.where(F.trim("value").startswith("{"))
    named = F.array(*map(F.lit, [*StructType.fromDDL(schema).names, "row"]))
    every = F.from_json("value", "map<string, variant>")
    extra = F.map_filter(F.when(F.try_parse_json("value").isNotNull(), every), lambda k, _: ~F.array_contains(named, k))
    parsed = objects.select(F.from_json("value", schema).alias("r"), extra.alias("extra"), "line")
    return parsed.where("r.recording_id is not null and r.recording_id <> ''").select("r.*", "extra", "line")


def _append(rows: DataFrame, path: str, transaction: str | None = None) -> None:
    """Write rows as one transaction; their own order is that of the table, and each keeps what is in ``extra``."""
    own = [c for c in rows.columns if c != "extra"]
    known = F.to_json(F.struct(*own, F.monotonically_increasing_id().alias("row")))
    if "extra" in rows.columns:
        extra = F.map_filter("extra", lambda k, _: ~F.array_contains(F.array(*map(F.lit, [*own, "row"])), k))
        more = F.when(F.size(extra) > 0, F.concat(F.lit(","), F.substring(F.to_json(extra), 2, 1 << 30))).otherwise("}")
        known = F.concat(F.substring(known, F.lit(1), F.length(known) - 1), more)
    append_lines(rows.select(known.alias("value")), path, transaction)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The latest record of each recording; a missing decision reads as the empty string."""
    return last_by_key(_lines(spark, path, RECORD), "recording_id", "line").drop("line").fillna({"decision": ""})


def append_run_log(records: DataFrame, path: str, transaction: str | None = None) -> None:
    """Add records, all or none of them; any number of writers may do so at once.

    Columns that a record has besides its fields go into ``extra``, as does what is in a column of that name, a map of
    VARIANT values. Records of a transaction that was committed under the same name before are left out.
    """
    fields = StructType.fromDDL(RECORD).names
    more = [c for c in records.columns if c not in (*fields, "extra")]
    rows = records.withColumn("ts", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    if more:
        added = F.create_map(*(x for c in more for x in (F.lit(c), F.to_variant_object(F.struct(F.col(c).alias("v"))))))
        added = F.transform_values(added, lambda _, v: F.variant_get(v, "$.v", "variant"))
        given = F.coalesce("extra", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))) if "extra" in rows.columns else None
        kept = added if given is None else F.map_concat(F.map_filter(given, lambda k, _: ~F.array_contains(F.array(*map(F.lit, more)), k)), added)
        rows = rows.withColumn("extra", kept)
    _append(rows.drop(*more), path, transaction)


def run_log_sink(path: str, name: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each micro-batch is a transaction named by stream and batch, so one that is repeated adds nothing."""
    return lambda batch, number: append_run_log(batch, path, f"{name}-{number}")


def read_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """The last stored print of each recording, empty ones left out."""
    rows = last_by_key(_lines(spark, path, PRINT), "recording_id", "line").drop("line", "extra")
    return rows.where(F.size("fingerprint") > 0)


def append_fingerprints(new: DataFrame, path: str, order: str | None = None) -> None:
    """Unlike a read, an append keeps what is known: ids in the store are left out.

    Of new rows that share an id the first by ``order`` is kept; without one, the first by duration and print.
    """
    spark = new.sparkSession
    place = [order] if order else ["duration", "fingerprint"]
    first = Window.partitionBy("recording_id").orderBy(*place)
    rows = new.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    try:
        known = _lines(spark, path, PRINT).select("recording_id").distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        rows = rows.join(known, "recording_id", "left_anti")
    _append(rows.select("recording_id", "duration", "fingerprint"), path)


def unprocessed(candidates: DataFrame, log: DataFrame) -> DataFrame:
    return candidates.join(log.select("recording_id").distinct(), "recording_id", "left_anti")

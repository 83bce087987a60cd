"""Checks of a session before a long run: what would fail late, found early."""

from __future__ import annotations

import importlib.util
import logging
import sys
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .settings import Settings

PACKAGES = ("numpy", "pandas", "pyarrow")
LOGGER = "gleaner"


def setup_logging(level: str = "INFO", file: str | None = None) -> logging.Logger:
    """The driver's logger, to the console and, in UTF-8, to a file; a second call changes the level and adds nothing."""
    log = logging.getLogger(LOGGER)
    log.setLevel(level)
    log.propagate = False
    form = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
    known = {getattr(h, "baseFilename", "console") for h in log.handlers}
    for place, made in (("console", logging.StreamHandler(sys.stderr)), (file, logging.FileHandler(file, encoding="utf-8", delay=True) if file else None)):
        if made and getattr(made, "baseFilename", "console") not in known:
            made.setFormatter(form)
            log.addHandler(made)
    return log


def _shared_folder(spark: SparkSession) -> str | None:
    """Null if what tasks write in the checkpoint folder is there for driver and tasks, else what is wrong."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        return "spark.checkpoint.dir is not set"
    path = f"{folder}/preflight-{uuid.uuid4().hex}"
    tasks = max(2, spark.sparkContext.defaultParallelism)
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        there = spark.read.parquet(path).count()
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception as e:
        return str(e).splitlines()[0]
    return None if there == tasks else f"{tasks - there} of {tasks} rows that tasks wrote are not there: the folder is not shared"


def _on_executors(spark: SparkSession, packages: Sequence[str]) -> str | None:
    """Packages that some task's Python lacks."""

    def lacking(rows):  # noqa: ANN001, ANN202
        import pandas as pd

        list(rows)
        yield pd.DataFrame({"name": [p for p in packages if importlib.util.find_spec(p) is None]}, dtype=object)

    tasks = max(2, spark.sparkContext.defaultParallelism)
    missing = sorted({r["name"] for r in spark.range(0, tasks, 1, tasks).mapInPandas(lacking, "name string").distinct().collect()})
    return f"missing in tasks: {missing}" if missing else None


def preflight(spark: SparkSession, settings_file: str | None = None, packages: Sequence[str] = PACKAGES) -> DataFrame:
    """(check, ok, message): versions, packages in driver and tasks, the shared folder, the settings file."""
    found: list[tuple[str, str | None]] = []
    found.append(("spark", None if tuple(map(int, spark.version.split(".")[:2])) >= (4, 0) else f"Spark {spark.version} is too old"))
    lacking = [p for p in packages if importlib.util.find_spec(p) is None]
    found.append(("driver packages", f"missing: {lacking}" if lacking else None))
    found.append(("task packages", "not tried" if lacking else _on_executors(spark, packages)))
    found.append(("shared folder", _shared_folder(spark)))
    if settings_file:
        try:
            Settings.from_file(settings_file)
            found.append(("settings", None))
        except Exception as e:
            found.append(("settings", f"{type(e).__name__}: {e}"))
    return spark.createDataFrame([(name, wrong is None, wrong or "fine") for name, wrong in found], "check string, ok boolean, message string")

"""Helpers shared by the corpus operators: loading, materialising, keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 2 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table through Spark only, so that any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a private folder is made on a local master, as in tests; on
    a cluster that would be a folder of the driver alone, so it is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="gleaner-"))
    return sc.getCheckpointDir()


def short_batches(df: DataFrame) -> DataFrame:
    """The same rows in a session of their own, where rows reach Python workers in Arrow batches of ``BATCH_BYTES``.

    Spark's own bound of 64 MB lets a worker, and the task that feeds it, hold a whole partition of texts
    two or three times over. The new session has all other settings of the old one, which is left as it is;
    a bound that was given to that stays too.
    """
    spark = df.sparkSession
    if spark.conf.get(_BATCH_SETTING) != _BATCH_DEFAULT:
        return df
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    view = f"rows_{uuid.uuid4().hex}"  # what sessions of an application share
    df.createGlobalTempView(view)
    rows = own.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{view}")
    own.catalog.dropGlobalTempView(view)
    return rows


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage like ``checkpoint()`` does, survives the loss of executors,
    and gives the optimiser true sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.table_path = path
    return written


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by ``materialize`` that no plan reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.table_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """128-bit content key of a text; a null text counts as the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def same(name: str) -> Column:
    """Whether ``name`` equals ``_name``, nulls being alike: to join with a side whose key was renamed."""
    return F.col(name).eqNullSafe(F.col(f"_{name}"))

"""Intermediate tables, kept on shared storage.

A written table cuts the lineage and survives the loss of executors. The folder is the
one the session names in ``spark.checkpoint.dir``. Only a local session without that
setting gets a temporary folder of its own, which goes when Python ends. All tables of a
session lie in one folder there; ``clear`` deletes it when they are no longer used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
PARTS_A_FILE = 16  # partitions of a shuffle that go to one file of a table of short rows
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="tallyrank-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[context.applicationId] = folder
    return _local_roots[context.applicationId]


def session_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tallyrank-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all scratch tables of this session; results that read them end with them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def gathered(df: DataFrame) -> DataFrame:
    """``df`` in a sixteenth of a shuffle's partitions, or in two for each core if those are more.

    For tables of short rows that a shuffle has dealt out and ``materialize`` writes: one file for each
    partition would be many small ones, each with a task and calls of the file system of its own (a
    local one starts a process for each, which counts the executor's memory again until it runs). Rows
    are not dealt anew, and the files' number still follows the partitions.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(2 * spark.sparkContext.defaultParallelism, partitions // PARTS_A_FILE))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new scratch table and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

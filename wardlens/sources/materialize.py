"""Materialized relations: written once to the shared folder, then read back.

A stage that many later jobs read (cohort, feature matrix, model vectors) is
written as a table.  Later jobs scan it with column pruning and pushed filters, and
a lost executor costs a re-read of files, not a re-run of the stages before it.

One storage rule holds in every mode: the folder in ``spark.checkpoint.dir``, and
where that is unset the session's warehouse.  Both are shared by all executors.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; intermediate tables go below it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative ML fits a place to cut their lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def data_version(spark: SparkSession, folder: str) -> str:
    """A digest of names, sizes and times of the files in a data folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    seen, todo = [], [path]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if status.isDirectory():
                todo.append(status.getPath())
            seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()[:12]


def materialize(spark: SparkSession, name: str, folder: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` made from the data in ``folder``, built on first use.

    It is built anew when the files in ``folder`` change.
    """
    slot = (spark.sparkContext.applicationId, f"{name}|{folder}", data_version(spark, folder))
    if slot not in _TABLES:
        _TABLES[slot] = written(build(), name)
    return _TABLES[slot]

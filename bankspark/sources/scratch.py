"""The folder that all executors share, for tables a job writes on its way."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: list[str] = []
_prefixes: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one named in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; on a cluster a
    missing setting is an error, since a machine-local folder would be lost
    with its executor.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="bankspark-")
    folder = f"{base.rstrip('/')}/bankspark-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def clean(spark: SparkSession) -> None:
    """Delete the folders and drop the tables of this process: for the end of a job, when nothing reads them any more."""
    if _prefixes:
        for table in spark.catalog.listTables():
            if table.name.startswith(tuple(_prefixes)):
                spark.sql(f"DROP {'VIEW' if table.tableType == 'VIEW' else 'TABLE'} IF EXISTS {table.name}")
        _prefixes.clear()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, **options: object) -> DataFrame:
    """Write a frame that several jobs read to the shared folder, and read it from there.

    Unlike a cache it outlives a lost executor, and nothing is computed twice.  ``options`` are the writer's.
    """
    path = shared_folder(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(stored: DataFrame) -> None:
    """Delete a stored table after its last use, when no frame still to be computed reads it."""
    for folder in {file.rsplit("/", 1)[0] for file in stored.inputFiles()}:
        path = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table_prefix() -> str:
    """A prefix that keeps the tables of one run apart from those of another."""
    _prefixes.append(f"run_{uuid.uuid4().hex[:12]}_")
    return _prefixes[-1]

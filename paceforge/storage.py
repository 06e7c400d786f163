"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders made for sessions that name none, by application.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see: ``spark.checkpoint.dir``, or one of our own for a session without it.

    On one machine that is a new temporary folder, on a cluster a folder of the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        alone = context.master == "local" or context.master.startswith("local[")
        if context.applicationId not in _own_folders:
            _own_folders[context.applicationId] = (
                tempfile.mkdtemp(prefix="paceforge-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir')}/paceforge"
            )
        named = _own_folders[context.applicationId]
    return named.rstrip("/")


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/paceforge-tables-{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that nothing before it runs again.

    Lost executors lose none of it, and Spark knows its size when it plans the joins after it.
    """
    spark = df.sparkSession
    path = f"{_place(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return []
    return sorted(found.getPath().getName() for found in files.listStatus(where) if found.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def clear_stored(spark: SparkSession) -> None:
    """Delete all tables that ``stored`` made for this application; DataFrames that read them are of no more use."""
    remove(spark, _place(spark))

"""Small helpers that the text operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that one step of a task looks at together; long texts make a step of their own.
CHUNK_ROWS, CHUNK_BYTES = 1_000, 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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
                tempfile.mkdtemp(prefix="paceforge-llm-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir')}/paceforge-llm"
            )
        named = _own_folders[context.applicationId]
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that nothing before it runs again.

    Lost executors lose none of it, and Spark knows its size when it plans the joins after it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/paceforge-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str, parts: int) -> Column:
    """The part that a document falls in: CRC-32 of its id as text; a missing id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of bounded rows and bytes, a single row at the least."""
    for batch in batches:
        per_row = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, min(CHUNK_ROWS, CHUNK_BYTES // per_row))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_chunks(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on every piece of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            yield work(piece)

    return df.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str]:
    """Texts of a column, a missing one as ''."""
    return ["" if x is None else x for x in column.to_pylist()]

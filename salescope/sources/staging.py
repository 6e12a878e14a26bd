"""Written tables in the shared folder named by ``spark.checkpoint.dir``.

A table written here cuts the lineage, survives lost executors, and has a
known file size, so Catalyst broadcasts it only when it is really small.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# A summary of at most this many rows may be broadcast (a few MB of keys and
# numbers); larger ones are joined through a shuffle.
BROADCAST_ROWS = 50_000
# Rows of one written file. A file is one task when it is read: the joins leave about as
# many files as there are cores and one more, which alone would double a scan's time.
FILE_ROWS = 500_000
# Rows below which a file is not worth its task: small results of a shuffle are written
# in fewer tasks. A local file system starts a process of the executor for each file.
LEAST_FILE_ROWS = 5_000
# Fixed value: whether Spark deletes the shuffle files of a query when it ends, not only
# when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The shared folder of this session; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="salescope-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark).rstrip('/')}/salescope/{name}-{uuid.uuid4().hex}"


def write_staged(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet, its rows where they are, and return the path."""
    path = new_path(df.sparkSession, name)
    write_files(df, path)
    return path


def write_files(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet files small enough to be dealt out evenly to readers."""
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)


def read_staged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is computed inside leaves no shuffle files: for a table written only once."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a table of ``new_path`` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def fewer_files(df: DataFrame, rows: int, each: int = LEAST_FILE_ROWS) -> DataFrame:
    """``df`` in no more partitions than ``rows``, its number of rows at most, are worth.
    Its tasks grow with the rows; nothing is shuffled for it."""
    return df.coalesce(max(1, -(-rows // each)))


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table. With ``rows``, at most
    its number of rows, a small table is written in few files."""
    if rows is not None:
        df = fewer_files(df, rows)
    return read_staged(df.sparkSession, write_staged(df, name), df.schema)

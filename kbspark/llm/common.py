"""What the operators share: the shared folder, stored tables, tables by name."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than these (Java regular expression).
SPACES = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


@contextmanager
def few_rows(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While a table is written, Python workers get so many rows at a time; then the session's setting is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: A stored table on local disks is written without checksum files. For each file and each task's folder Hadoop starts a process (chmod), which
#: shares the memory of the whole JVM until it has begun, and is counted with it: two a task, three with checksum files. Other file systems aren't concerned.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

#: Paths of stored tables that haven't been forgotten, and the JVM's weak reference to what every plan that reads one holds.
_STORED: dict[str, object] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: its lineage ends there, and a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with few_rows(df.sparkSession):
        df.write.options(**PLAIN_FILES).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    relation = out._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation()
    _STORED[path] = df.sparkSession._jvm.java.lang.ref.WeakReference(relation)
    out._stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _STORED.pop(path, None)


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read again."""
    for df in tables:
        _delete(spark, df._stored_at)


def drop_shuffles(spark: SparkSession) -> None:
    """Asks for the files of finished shuffles to be dropped: Spark does so once the driver has collected the last reference to one.

    Only a help for disks: results don't depend on it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget_unread(spark: SparkSession) -> None:
    """Deletes the stored tables that no DataFrame reads any more, be it one derived from them; those that one may still read stay."""
    for _ in range(4):
        # what Python has dropped, the JVM hears of a little later
        drop_shuffles(spark)
        time.sleep(0.2)
    for path, read in list(_STORED.items()):
        if read.refersTo(None):
            _delete(spark, path)


def forget_all(spark: SparkSession) -> None:
    """Deletes every stored table: for when the results that read them have been written or dropped."""
    for path in sorted(_STORED):
        _delete(spark, path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows, fewer at a time; then the worker gives back the memory that it no longer uses."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many leading underscores as make it clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))



def crc_mod(column: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))

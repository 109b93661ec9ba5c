"""Table access shared by the operators: reading, numbering of shared
folders, and the column-name hygiene that keeps extra columns from clashing.

Internal columns start with ``_tm_``; operators select the columns they need
under such names, so an input may carry any other columns.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.session import ensure_checkpoint_dir, prepare


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the operators; small Arrow batches bound a task's
    memory when texts are very long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``: seen by driver and executors."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to a shared folder and read back: cuts lineage, survives executor loss."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_record(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as one struct ``_tm_rec`` beside computed columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_tm_rec"),
                     *[c.alias(f"_tm_{k}") for k, c in columns.items()])


def records(df: DataFrame) -> DataFrame:
    """Undo :func:`with_record`: the original columns only."""
    return df.select("_tm_rec.*")


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5 = 0 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def release() -> None:
    """Give a finished task's memory back: Python workers live on for the next
    tasks beside the executor's JVM, and free lists would stay with them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with per-task state: ``make()`` runs once in each task and
    returns ``fn(batch) -> iterable of record batches``; an optional ``fn.end()``
    yields what the task still holds."""
    def run(batches):
        fn = make()
        for batch in batches:
            yield from fn(batch)
        end = getattr(fn, "end", None)
        if end is not None:
            yield from end()
        del fn, end
        release()
    return df.mapInArrow(run, schema)

"""Readers for the driver tables and the reference's JSON corpus format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("documents", "pages", "benchmark", "conversations", "labels")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Scan-parallelism guard for CPU-heavy narrow work (cleaning, encoding).

    A row group is read by one task, however many splits its file is cut into,
    so what counts is where the rows are: a count by scan partition, which reads
    no column, only the files' footers.  When fewer partitions than the
    cluster's parallelism hold rows, or one holds more than twice an even
    share, hash-partition by ``key`` (deterministic on retry, and reusable by
    later joins on ``key``); an evenly split scan is left alone.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= target:
        held = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
        filled, most, total = held.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
        if filled >= target and most * target <= 2 * total:
            return df
    return df.repartition(max(target, splits), key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: ``doc_id`` is the order key, ``text`` plays ``summary``."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


CORPUS_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("encoded", T.ArrayType(T.IntegerType())),
])


def read_json_corpus(spark: SparkSession, path: str, with_encoded: bool | None = None,
                     layout: str = "auto") -> DataFrame:
    """A JSON corpus with an explicit schema, no inference.

    ``layout``: ``array`` (one JSON array per file, read whole by one task),
    ``lines`` (one record per line, splittable; what :func:`write_corpus`
    writes) or ``auto``, which looks at the first character of the text.
    Row order in the files becomes ``doc_id``; Parquet is the format to use
    at scale.
    """
    if layout not in ("auto", "array", "lines"):
        raise ValueError("layout must be 'auto', 'array' or 'lines'")
    if layout == "auto":
        head = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
        layout = "array" if head and head[0]["value"].lstrip().startswith("[") else "lines"
    schema = CORPUS_SCHEMA if with_encoded is not False else T.StructType(CORPUS_SCHEMA.fields[:2])
    df = spark.read.schema(schema).json(path, multiLine=layout == "array")
    df = df.withColumn("doc_id", F.monotonically_increasing_id())
    if with_encoded is None and "encoded" in df.columns:
        if df.where(F.col("encoded").isNotNull()).limit(1).count() == 0:
            df = df.drop("encoded")
    return df


def write_corpus(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Sink for the crawled corpus (Parquet at scale, JSON lines on request)."""
    getattr(df.write.mode(mode), fmt)(path)


def write_prepared(df: DataFrame, base: str, context_length: int, mode: str = "overwrite") -> str:
    """S3: prepared corpus keyed by context length (one partition folder each)."""
    path = f"{base.rstrip('/')}/context_length={context_length}"
    df.write.mode(mode).parquet(path)
    return path

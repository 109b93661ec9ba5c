"""Sequence preparation: P3/P4/P5 filters, G5 framing, G7 pairs, H4 preparation.

All narrow (no shuffle): each document is handled inside its own row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A


def filter_computed(df: DataFrame, cond) -> DataFrame:
    """Filter on computed columns without recomputing them.

    Catalyst pushes a filter through a deterministic projection by inlining
    the aliased expressions, so an expensive column (cleaning, encoding) would
    be evaluated once in the filter and again in the projection -- and below
    any exchange.  A projection holding a non-deterministic column (here the
    cheap ``spark_partition_id()``) is not pushed through, so each row's
    columns are computed once and the filter runs on the result.
    """
    # the condition reads the barrier, so column pruning cannot drop it first
    return (df.withColumn("_barrier", F.spark_partition_id())
            .where(cond & (F.col("_barrier") >= 0)).drop("_barrier"))


def length_filter(df: DataFrame, context_length: int, col: str = "encoded") -> DataFrame:
    """Keep sequences strictly shorter than ``context_length`` (before specials)."""
    return filter_computed(df, F.size(col) < context_length)


def framed_filter(df: DataFrame, context_length: int, col: str = "encoded") -> DataFrame:
    """Keep pre-framed sequences of exactly ``context_length + 1`` ids."""
    return filter_computed(df, F.size(col) == context_length + 1)


def frame_sequences(df: DataFrame, context_length: int, col: str = "encoded") -> DataFrame:
    """P3 then G5: drop too-long sequences, frame the rest to ``n + 1`` ids."""
    return length_filter(df, context_length, col).withColumn(
        col, A.frame(F.col(col), context_length))


def prepare_corpus(df: DataFrame, tokenizer, context_length: int,
                   text_col: str = "text") -> DataFrame:
    """H4 (with P5): encode -> P3 -> G5, or P4 when ``encoded`` already exists.

    The path is chosen from the schema at plan time, so an empty input gives an
    empty output instead of an error, and no input row is mutated.
    """
    if "encoded" in df.columns:
        return framed_filter(df, context_length)
    encoded = tokenizer.encode(df, text_col, "encoded")
    return frame_sequences(encoded, context_length)


def next_token_pairs(df: DataFrame, col: str = "encoded") -> DataFrame:
    """G7 (+P6): (x, y) = (all but last, all but first) of each framed sequence."""
    return df.select("*", A.shift_inputs(F.col(col)).alias("x"),
                     A.shift_targets(F.col(col)).alias("y"))


def crop_context(df: DataFrame, context_length: int, col: str = "encoded",
                 out: str = "context") -> DataFrame:
    """Keep the last ``context_length`` ids."""
    return df.withColumn(out, A.keep_last(F.col(col), context_length))


def prefix_split(df: DataFrame, train_size: float, col: str = "encoded") -> DataFrame:
    """Split each sequence at ``int(train_size * len)``."""
    if not 0 <= train_size <= 1:
        raise ValueError("train_size must be between 0 and 1")
    n = A.split_point(F.size(col), train_size)
    return df.withColumn("_n", n).select(
        "*", A.head(F.col(col), F.col("_n")).alias("train"),
        A.tail(F.col(col), F.col("_n")).alias("test")).drop("_n")

"""Composed jobs: H3 text-to-token steps (K1 chain) and H4 summaries.

Steps are plain ``DataFrame -> DataFrame`` callables chained with
``DataFrame.transform``, the Spark form of a function-as-step chain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.functions import text as TX
from tokenmill.operators import sequence as S
from tokenmill.operators.batching import stream_split

Step = Callable[[DataFrame], DataFrame]


def chain(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """K1: apply steps in order (each any DataFrame -> DataFrame callable)."""
    for step in steps:
        df = df.transform(step)
    return df


def text_to_tokens(df: DataFrame, tokenizer, train_size: float, col: str = "text",
                   whole_stream: bool = False) -> DataFrame:
    """H3: transliterate -> encode -> (array) -> split.

    ``whole_stream=False`` splits every document at ``int(train_size * len)``
    (W2); ``True`` reads the corpus as one stream in ``doc_id`` order (W3).
    """
    if not 0 <= train_size <= 1:
        raise ValueError("train_size must be between 0 and 1")
    steps: list[Step] = [
        lambda d: d.withColumn(col, TX.transliterate(F.col(col))),
        lambda d: tokenizer.encode(d, col, "encoded"),
        (lambda d: stream_split(d, train_size)) if whole_stream
        else (lambda d: S.prefix_split(d, train_size)),
    ]
    return chain(df, steps)


def prepare_summary(docs: DataFrame, tokenizer, context_length: int, ratio: float) -> DataFrame:
    """H4 + W1 + A6 counts: documents in, kept after P3, train and test sizes."""
    spark = docs.sparkSession
    n_in = docs.count()
    kept = S.prepare_corpus(docs, tokenizer, context_length).count()
    train = int(ratio * kept)  # the positional split's size needs no numbering
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in (
        ("n_in", n_in), ("n_kept", kept), ("n_train", train), ("n_test", kept - train))])

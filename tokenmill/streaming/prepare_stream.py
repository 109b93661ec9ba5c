"""Structured Streaming form of corpus preparation (F5 -> encode -> P3 -> G5).

The chain is stateless once the tokenizer is fitted (the vocabulary is a
constant or a broadcast), so new documents landing in a folder can be
prepared incrementally.  The stream's checkpoint belongs to its sink: unless
one is given it lies in the sink folder, so a later application that writes
to the same sink goes on where the last one stopped (a checkpoint of another
sink, or a new one, would make the file sink skip batches it has recorded).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenmill.functions import text as TX
from tokenmill.operators import sequence as S
from tokenmill.operators.tokenizer import CharacterTokenizer, Tokenizer

DOC_SCHEMA = "doc_id long, text string"


def prepare_stream(spark: SparkSession, source_dir: str, sink_dir: str, context_length: int,
                   tokenizer: Tokenizer | None = None, clean_mode: str = "reference",
                   checkpoint_location: str | None = None, available_now: bool = True,
                   max_files_per_trigger: int | None = None,
                   path_glob: str | None = None) -> StreamingQuery:
    """Start a query that prepares every document file arriving in ``source_dir``.

    Narrow throughout: texts are not shuffled, a task prepares what it reads.
    ``max_files_per_trigger`` bounds a micro-batch.
    """
    tokenizer = tokenizer or CharacterTokenizer()
    if checkpoint_location is None:
        checkpoint_location = sink_dir.rstrip("/") + "/_stream_checkpoint"
    reader = spark.readStream.schema(DOC_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    raw = reader.parquet(source_dir)
    docs = raw.select("doc_id", TX.clean_text(F.col("text"), clean_mode).alias("text"))
    prepared = S.prepare_corpus(docs, tokenizer, context_length)
    writer = (prepared.writeStream.format("parquet")
              .option("path", sink_dir)
              .option("checkpointLocation", checkpoint_location)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

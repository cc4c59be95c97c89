"""Structured Streaming over a text source.

The reference has no streams.  What carries over unchanged are the per-row
operators: whitespace / code tokenising (C1-C3) and the per-row BPE encode,
which needs no shuffle (an Arrow UDF with the broadcast merge list).  Aggregating operators are batch jobs over the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import code_tokens, whitespace_tokens
from ..operators import bpe


def text_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet file stream (new files in ``path`` arrive as micro-batches)."""
    r = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def tokenized(stream: DataFrame, col: str = "text", code: bool = False) -> DataFrame:
    tok = code_tokens(col) if code else whitespace_tokens(col)
    return stream.withColumn("tokens", tok).withColumn("n_tokens", F.size("tokens"))


def encoded(stream: DataFrame, model: bpe.BpeModel, col: str = "text") -> DataFrame:
    """Per-row BPE ids of a stream (no state, no shuffle)."""
    return bpe.encode_rows(stream, col, model)


def run_available(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet"):
    """Process every file available now, then stop (``availableNow`` trigger); exactly-once file sink."""
    q = (df.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()
    return q

"""Model persistence (A6, A7): parquet tables, reloadable on any cluster."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bpe import BpeModel


def save_bpe(spark: SparkSession, model: BpeModel, path: str, mode: str = "overwrite") -> None:
    """``vocab/`` (token, id), ``merges/`` (rank, lhs, rhs, pair_count) and a one-row ``meta/``."""
    model.vocab_df(spark).write.mode(mode).parquet(os.path.join(path, "vocab"))
    model.merges_df(spark).write.mode(mode).parquet(os.path.join(path, "merges"))
    meta = spark.createDataFrame([(model.vocab_size, model.eow_in_vocab, model.n_base, model.specials)],
                                 "vocab_size int, eow_in_vocab boolean, n_base int, specials array<string>")
    meta.write.mode(mode).parquet(os.path.join(path, "meta"))


def load_bpe(spark: SparkSession, path: str) -> BpeModel:
    """Reload; the tables are vocabulary-sized, so they come back to the driver."""
    meta = spark.read.parquet(os.path.join(path, "meta")).first()
    vocab = {r["token"]: int(r["id"]) for r in spark.read.parquet(os.path.join(path, "vocab")).collect()}
    merges = [(r["lhs"], r["rhs"], int(r["pair_count"]))
              for r in spark.read.parquet(os.path.join(path, "merges")).orderBy("rank").collect()]
    return BpeModel(vocab, merges, meta["vocab_size"], list(meta["specials"]), meta["eow_in_vocab"], meta["n_base"])


def save_vectors(vectors: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(word, vector array<double>)`` as parquet."""
    vectors.select("word", F.col("vector").cast("array<double>")).write.mode(mode).parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

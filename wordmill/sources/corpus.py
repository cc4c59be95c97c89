"""Corpus sources and sinks (A1-A5, A8) and the paired-text view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_records import read_csv

CORPUS_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True)
                              for c in ("code", "docstring", "summary", "func_name", "repo", "partition")])


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                required=(), parallel: bool = True) -> DataFrame:
    """A1: load the corpus; CSV is read with a header and quoted multi-line fields.

    A CSV file is read by a task per byte range (``csv_records``); quotes
    inside an unquoted field are an error there.  ``parallel=False`` takes
    Spark's multi-line reader, which reads such files, each in one task.
    """
    if fmt == "csv" and parallel:
        df = read_csv(spark, path, schema)
    elif fmt == "csv":
        r = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
        df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    else:
        df = spark.read.format(fmt).load(path)
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in df.columns])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"corpus lacks required column(s): {missing}")
    return df


def sample_key(key, seed: int = 42) -> F.Column:
    """Deterministic pseudo-random order key, md5 of ``seed:key`` (same value in DuckDB)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def sample_rows(df: DataFrame, n: int | None, key: str, seed: int = 42) -> DataFrame:
    """A2: ``min(n, rows)`` rows without replacement, seeded (a distributed top-n, TakeOrderedAndProject)."""
    if not n:
        return df
    return df.orderBy(sample_key(key, seed), F.col(key)).limit(n)


def first_rows(df: DataFrame, n: int | None, key: str) -> DataFrame:
    """A3: the first n rows by ``key``; 0/None keeps every row."""
    if not n:
        return df
    return df.orderBy(key).limit(n)


def write_corpus_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: CSV sink with a header, no index column; white space around values is kept."""
    kept = df.write.mode(mode).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    kept.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_report(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: JSON report of a long metrics table."""
    metrics.write.mode(mode).json(path)


def write_generated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Generated documentation ``{name, summary, docstring}`` as JSON lines (UTF-8 kept)."""
    df.select("name", "summary", "docstring").write.mode(mode).option("ignoreNullFields", False).json(path)


def pair_view(conversations: DataFrame) -> DataFrame:
    """Paired text: a ``user`` turn (code) and the following ``assistant`` turn (docstring).

    One window per conversation (bounded by its turns) supplies the next turn.
    """
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = conversations.select("conv_id", "turn", "role", "text",
                               F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("next_text"))
    return (nxt.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
            .select("conv_id", "turn", F.col("text").alias("code"), F.col("next_text").alias("docstring")))

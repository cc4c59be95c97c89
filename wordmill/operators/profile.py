"""Corpus profiling (B1-B5): one-pass projections and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import null_as, whitespace_tokens
from ..session import attach_scalars


def profile_shape(df: DataFrame) -> DataFrame:
    """B1: one row per column ``(ordinal, column_name, dtype, n_rows, n_columns)``.

    The schema part is metadata; only ``n_rows`` touches the data (a
    partial+final count, nothing shuffled but one number per partition).
    """
    spark = df.sparkSession
    fields = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    meta = spark.createDataFrame(fields, "ordinal long, column_name string, dtype string")
    return (attach_scalars(meta, df.agg(F.count(F.lit(1)).alias("n_rows")))
            .withColumn("n_columns", F.lit(len(fields)).cast("long"))
            .select("ordinal", "column_name", "dtype", "n_rows", "n_columns"))


def profile_missing(df: DataFrame) -> DataFrame:
    """B2: null count per column, computed in a single aggregation pass then unpivoted."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_missing)")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Distribution of ``col`` (nulls dropped, as pandas does), most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)))


def _unpivot_text(df: DataFrame, cols, null_value) -> DataFrame:
    parts = [df.select(F.lit(c).alias("column_name"), null_as(F.col(c).cast("string"), null_value).alias("text"))
             for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def text_stats(df: DataFrame, cols, null_value: str | None = "nan") -> DataFrame:
    """Mean / sample std / min / max of character and word counts per text column.

    ``null_value="nan"`` reproduces ``astype(str)`` on nulls; ``None`` skips nulls.
    """
    t = _unpivot_text(df, list(cols), null_value)
    t = t.select("column_name", F.length("text").alias("n_chars"),
                 F.size(whitespace_tokens("text")).alias("n_words"))
    return t.groupBy("column_name").agg(
        F.avg("n_chars").alias("mean_length"), F.stddev_samp("n_chars").alias("std_length"),
        F.min("n_chars").cast("long").alias("min_length"), F.max("n_chars").cast("long").alias("max_length"),
        F.avg("n_words").alias("mean_words"), F.stddev_samp("n_words").alias("std_words"),
        F.min("n_words").cast("long").alias("min_words"), F.max("n_words").cast("long").alias("max_words"))


def token_counts(df: DataFrame, text_col: str, by: list[str] | None = None, tokens=None) -> DataFrame:
    """Exploded whitespace tokens counted per ``by`` keys (partial aggregation map-side)."""
    by = list(by or [])
    tok = tokens if tokens is not None else whitespace_tokens(text_col)
    return (df.select(*by, F.explode(tok).alias("token"))
            .groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n")))


def token_distribution(df: DataFrame, text_col: str, by: list[str] | None = None, k: int = 20) -> DataFrame:
    """Per group, unique and total tokens plus the top-k tokens.

    Output ``(*by, rank, token, n, unique_tokens, total_tokens)``.  The top-k
    is ``row_number() <= k``, which Spark plans as a partial window-group limit
    before the shuffle, so no task ever holds a whole group's vocabulary.
    """
    by = list(by or [])
    counts = token_counts(df, text_col, by)
    if by:
        w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("token"))
        top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        summary = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("unique_tokens"),
                                          F.sum("n").cast("long").alias("total_tokens"))
        out = top.join(summary, on=by, how="inner")
    else:
        top = counts.orderBy(F.desc("n"), F.asc("token")).limit(k)
        top = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("token"))))
        summary = counts.agg(F.count(F.lit(1)).alias("unique_tokens"), F.sum("n").cast("long").alias("total_tokens"))
        out = attach_scalars(top, summary)
    return out.select(*by, F.col("rank").cast("long").alias("rank"), "token", "n", "unique_tokens", "total_tokens")

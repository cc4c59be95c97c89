"""CSV with quoted newlines, read by several tasks per file (A1).

A newline ends a record only where an even number of quotes stands before it,
so where a byte range's records begin depends on all quotes before the range.
Two scans settle that: the first counts quotes per range, a prefix sum over a
file's ranges tells each whether it begins inside quotes, and the second cuts
every range's lines at the true boundaries.  Only the pieces of records that
cross a range (two a range at most) are shuffled to be joined.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bounded_broadcast, cut_lineage

# a record of RFC 4180: fields without quotes, or quoted whole with quotes doubled
RECORD = re.compile(r'(?:"(?:[^"]|"")*+"|[^",]*+)(?:,(?:"(?:[^"]|"")*+"|[^",]*+))*+\r?')
RANGE_BYTES = 256   # of a range's row in a broadcast: its file's path above all
PIECES = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
                       T.StructField("head", T.BooleanType()), T.StructField("first", T.BooleanType()),
                       T.StructField("whole", T.BooleanType()), T.StructField("text", T.StringType())])
TYPES = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())


def check_record(text: str) -> str:
    """``text`` without the carriage return of its end; an error for quotes that say nothing certain about boundaries."""
    if '"' in text and not RECORD.fullmatch(text):
        raise ValueError(f"stray quote in a CSV record, read it with parallel=False: {text[:80]!r}")
    return text[:-1] if text.endswith("\r") else text


def cut_records(batches):
    """Lines in order with their range's state to records (``whole``) and the pieces of records that cross ranges.

    ``inside``: the range begins within quotes.  A piece with ``head`` carries
    on the record before it; the last piece of a range is open if its quotes are.
    """
    at, inside, lines, started, n = None, False, [], False, 0
    out = []

    def close(whole):
        nonlocal n
        text = "\n".join(lines)
        if started and whole:
            text = check_record(text)
        out.append((at[0], at[1], not started, at[1] == 0 and started and n == 0, whole and started, text))
        n += started
        lines.clear()

    def flush():
        table = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], names=PIECES.names)
        out.clear()
        return table

    for b in batches:
        for file, block, state, line in zip(*(b.column(c).to_pylist() for c in ("file", "block", "inside", "line"))):
            if (file, block) != at:
                if lines:
                    close(False)
                at, inside, started, n = (file, block), state, not state, 0
            lines.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                close(True)
                started = True
        if out:
            yield flush()
    if lines:
        close(False)
    if out:
        yield flush()


def csv_records(spark: SparkSession, path) -> DataFrame:
    """``(record, first)``: every record of the files as text; ``first`` marks a file's header."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = cut_lineage(ranges.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")))
    small = bounded_broadcast(states, states.count(), RANGE_BYTES)
    if small is states:   # more ranges than may be broadcast: a shuffled join, and the lines put in order again
        known = lines.withColumn("line_no", F.monotonically_increasing_id()).join(states, ["file", "block"], "left")
        known = known.repartition("file", "block").sortWithinPartitions("file", "block", "line_no")
    else:
        known = lines.join(small, ["file", "block"], "left")
    # a state belongs to a place of the file, whatever the range's length; a scan cut at other places must not lose its lines
    inside = F.coalesce("inside", F.raise_error(F.lit("the CSV files were split anew between two scans, read them again")).cast("boolean"))
    pieces = known.select("file", "block", inside.alias("inside"), "line").mapInArrow(cut_records, PIECES)

    # a record that crosses ranges: the piece that starts it and the heads that follow, up to the next start
    order = Window.partitionBy("file").orderBy("block", F.desc("head"))
    broken = pieces.where(~F.col("whole")).withColumn("record", F.sum((~F.col("head")).cast("long")).over(order))
    checked = F.udf(check_record, "string", useArrow=True)
    joined = broken.groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n").alias("text"),
        F.max("first").alias("first"))
    return pieces.where("whole").select(F.col("text").alias("record"), "first") \
        .unionByName(joined.select(checked("text").alias("record"), "first"))


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header, quotes doubled inside quoted fields, newlines inside quotes.

    Equal to Spark's multi-line reader for files whose fields are quoted whole
    or not at all; a quote elsewhere raises an error in the task that meets it,
    for it would move the boundaries.  Empty lines are no records.  Columns
    are read as strings, named by the header, or by ``schema`` in its order.
    """
    if schema is None:
        schema = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).schema
        # where the header holds a quoted newline, that reader leaves a carriage return on its end
        schema = T.StructType([T.StructField(f.name.rstrip("\r"), f.dataType) for f in schema.fields])
    rows = csv_records(spark, path).where(~F.col("first") & (F.col("record") != ""))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("record", ddl, {"quote": '"', "escape": '"'}).alias("r")).select("r.*")

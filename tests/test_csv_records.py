"""CSV with quoted newlines read by several tasks, against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from wordmill.sources import csv_records
from wordmill.sources.corpus import read_corpus


def spell(field, rnd):
    if field is None:
        return ""
    if field == "" or any(c in field for c in '",\n\r') or rnd.random() < 0.3:
        return '"' + field.replace('"', '""') + '"'
    return field


def write(path, rows, seed, end="\n", last=True):
    rnd = random.Random(seed)
    body = end.join(",".join(spell(f, rnd) for f in row) + (end if rnd.random() < 0.1 else "") for row in rows)
    path.write_bytes((body + (end if last else "")).encode())


def rows_of(df):
    return sorted(df.collect(), key=lambda r: tuple((x is None, x or "") for x in r))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("broadcast", [True, False])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, monkeypatch, seed, broadcast):
    rnd = random.Random(seed)
    if not broadcast:
        monkeypatch.setattr(csv_records, "RANGE_BYTES", 1 << 40)
    bits = ["a", "é", "\n", "\n\n", '"', '""', ",", " ", "x,y", '\n"', "end", "\t"]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 3, 10, 200])))
    expected = []
    for i in range(3):
        rows = [("id", "a \"b\"\nc", "z")] + [(f"{i}-{k}", rnd.choice([None, text()]), text()) for k in range(60)]
        write(tmp_path / f"f{i}.csv", rows, seed + i, "\r\n" if i == 1 else "\n", last=i != 2)
        expected += rows[1:]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257b")
    spark.conf.set("spark.sql.files.openCostInBytes", "64b")
    try:
        got = read_corpus(spark, str(tmp_path), "csv")
        ranges = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
        here = rows_of(got)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ranges > 10
    # as in Spark's reader, an empty field is null, quoted or not
    assert [tuple(r) for r in here] == sorted([tuple(x or None for x in r) for r in expected], key=lambda r: tuple((x is None, x or "") for x in r))
    # Spark's reader takes its line ends from what it meets first, quoted or not: no carriage returns here
    whole = read_corpus(spark, [str(tmp_path / f"f{i}.csv") for i in (0, 2)], "csv", parallel=False)
    assert got.columns == whole.columns == ["id", 'a "b"\nc', "z"]
    assert [r for r in here if not r["id"].startswith("1-")] == rows_of(whole)


def test_schema_names_and_missing_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\ny"\n2\n\n3,z,more\n')
    got = read_corpus(spark, str(tmp_path), "csv", schema=spark.range(1).select(F.lit(1).alias("n"), F.lit("").alias("t")).schema)
    assert [tuple(r) for r in rows_of(got.withColumn("n", F.col("n").cast("string")))] == [("1", "x\ny"), ("2", None), ("3", "z")]
    with pytest.raises(ValueError):
        read_corpus(spark, str(tmp_path), "csv", required=["summary"])


def test_stray_quote_is_an_error_and_empty_files_have_no_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,x"y\n2,z"\n')
    with pytest.raises(Exception, match="stray quote"):
        read_corpus(spark, str(tmp_path), "csv").collect()
    assert read_corpus(spark, str(tmp_path), "csv", parallel=False).count() == 2
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "h.csv").write_text("a,b\n")
    assert read_corpus(spark, str(tmp_path / "g"), "csv").collect() == []

"""What a settled table leaves on the disk."""

import time

from pyspark.sql import functions as F

from wordmill.session import SHUFFLES_GO, cut_lineage, settled


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i)) for i in range(files.size()) if "shuffle_" in str(files.apply(i)) and str(files.apply(i)).endswith(".data")}


def test_shuffle_files_go_with_the_step_that_made_them(spark):
    before, was = shuffle_files(spark), spark.conf.get(SHUFFLES_GO)
    rows = spark.range(5000).withColumn("k", F.col("id") % 7)
    held = rows.groupBy("k").agg(F.sum("id").alias("s"))
    kept = [settled(held), settled(held, by=("k",)), cut_lineage(held), cut_lineage(rows.orderBy(F.desc("k")))]
    for _ in range(100):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLES_GO) == was
    want = sorted((r["k"], r["s"]) for r in held.collect())
    assert all(sorted((r["k"], r["s"]) for r in t.collect()) == want for t in kept[:3]) and kept[3].count() == 5000

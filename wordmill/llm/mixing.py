"""Mixing sources to target weights with DataFrame operations only.

Every row gets a hash-random key.  Equal-width ranges of that key cut each
source into buckets of bounded size; sorting within buckets and adding the
totals of the buckets before gives distributed prefix sums, and each source is
cut at its exact budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import fresh_name, settle

# Words are maximal runs of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of the largest source that share a bucket, on average.
BUCKET_ROWS = 20_000
# Sources whose table of budgets may be broadcast (some 100 bytes each).
BROADCAST_SOURCES = 50_000
# Copies of the table of budgets beyond that, so that the rows of a hot source are joined by many tasks.
SALTS = 64


def sized_rows(docs: DataFrame, seed: int, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """Row identity, source, size in words and hash-random key, without the text; ``bare`` marks a null source."""
    text = F.col(text_col).cast("string")
    doc_id = F.col(id_col).cast("bigint")
    source = F.col(source_col).cast("string")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(source, F.lit("")).alias("source"), source.isNull().alias("bare"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        hash_key(doc_id, text, seed).alias("key"), F.xxhash64(text).alias("text_key"))


def hash_key(doc_id: Column, text: Column, seed: int) -> Column:
    """By id and text: rows without an id, or of one id, are spread too."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def bucket(key: Column, buckets: int) -> Column:
    """Which of ``buckets`` equal ranges of the unsigned key it lies in; ascending, like the key read as unsigned."""
    return F.shiftright(F.shiftrightunsigned(key, 32) * F.lit(buckets), 32)


def key_order() -> list[Column]:
    """Ascending unsigned key; equal keys by id and text, so that a tie has one order."""
    return [F.shiftrightunsigned("key", 32), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), F.col("doc_id"), F.col("text_key")]


def source_ranks(totals: DataFrame) -> DataFrame:
    """``totals`` with ``rank``: 0, 1, ... by code point, null last; numbered by partition counts, not in one task."""
    ordered = settle(totals.orderBy("bare", "source"))
    place = F.monotonically_increasing_id()
    ordered = ordered.withColumn("place", place).withColumn("part", F.shiftright("place", 33))
    counts = sorted(ordered.groupBy("part").count().collect())
    before, total = {}, 0
    for part, n in counts:
        before[part], total = total, total + n
    offset = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for p in before.items() for x in p]), F.col("part")) if before else F.lit(0)
    return ordered.withColumn("rank", offset + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("place", "part")


def budgets(totals: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Targets of all sources: ``share`` of all words by weight, none above ``most`` times its own, the excess reshared.

    Each round is one aggregation over the sources: those whose share passes
    their limit stop there, and what is left is shared by the others, until
    nobody is above.
    """
    ranked = settle(source_ranks(totals).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint")))
    all_words = ranked.agg(F.sum("source_size")).first()[0] or 0
    stopped = F.lit(False)
    closed = -1
    while True:
        row = ranked.agg(F.sum(F.when(stopped, F.col("source_size") * F.lit(most))).alias("used"),
                         F.sum(F.when(~stopped, F.col("weight"))).alias("weights"),
                         F.sum(stopped.cast("int")).alias("closed")).first()
        rest, weights_left = all_words * share - (row.used or 0.0), row.weights or 1
        if row.closed == closed or not row.weights:
            break
        closed = row.closed
        stopped = F.col("weight") * F.lit(float(rest)) / F.lit(weights_left) > F.col("source_size") * F.lit(most)
    target = F.least(F.col("source_size") * F.lit(most), F.col("weight") * F.lit(float(rest)) / F.lit(weights_left))
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("bigint")
    return (ranked.withColumn("target", target.cast("double")).withColumn("epochs", whole)
            .withColumn("rest", F.floor("target").cast("bigint") - F.col("epochs") * F.col("source_size")))


def with_prefix_sums(rows: DataFrame, weights, share, most) -> DataFrame:
    """Rows with their source's budget and ``before``, the words of the source's rows of smaller key."""
    totals = settle(rows.groupBy("bare", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")))
    buckets = 1 + (totals.agg(F.max("rows")).first()[0] or 0) // BUCKET_ROWS
    plan = budgets(totals.drop("rows"), weights, share, most)
    rows = rows.withColumn("bucket", bucket(F.col("key"), buckets))
    earlier = Window.partitionBy("bare", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    lead = (rows.groupBy("bare", "source", "bucket").agg(F.sum("size").alias("words"))
            .select("bare", "source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("lead"))
            .join(plan, ["bare", "source"]))
    within = Window.partitionBy("bare", "source", "bucket").orderBy(*key_order()).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(lead, ["bare", "source", "bucket"]).withColumn("before", F.col("lead") + F.col("inside")))


def partial() -> Column:
    """Words of the last, partial epoch that fall on a row."""
    return F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("before"))).cast("bigint")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 42,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, source_size, target, epochs, taken)`` of every row of ``docs``.

    Sources by code point, null last, have ``weights`` in turn.  A source
    yields whole epochs of all its rows and then rows by ascending key up to
    its exact budget; the row at the cut yields the words that are left, so
    the words taken are the target, rounded down.  A null text has size 0; rows
    of null or repeated doc_id have keys by their texts.  Repeated rows tie and are taken one after
    the other.  An empty table gives an empty result.
    """
    rows = settle(sized_rows(docs, seed, id_col, source_col, text_col))
    placed = with_prefix_sums(rows, weights, share, most)
    return placed.select("doc_id", "size", "source_size", "target", "epochs",
                         (F.col("epochs") * F.col("size") + partial()).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                    seed: int = 42) -> DataFrame:
    """The mix itself: the columns of ``docs`` plus ``epoch`` and ``taken``, a row per document and epoch.

    Where ``docs`` has columns of these names, the new ones get underscores appended (``fresh_name``).

    The cut of each source is one key, so the texts are neither shuffled nor
    sorted: each row compares its key with its source's cut.  A row at the cut
    keeps its first ``taken`` words (joined by single spaces).
    """
    rows = settle(sized_rows(docs, seed, "doc_id", "source", "text"))
    placed = with_prefix_sums(rows, weights, share, most)
    place = F.struct(*key_order())
    cuts = settle(placed.groupBy("bare", "source").agg(
        F.first("epochs").alias("epochs"),
        F.max(F.when(F.col("before") < F.col("rest"), F.struct(place.alias("place"), partial().alias("taken")))).alias("cut")))
    few = cuts.count() <= BROADCAST_SOURCES
    text = F.col("text").cast("string")
    mix, plan, salt, size, copy = (fresh_name(docs, "mix_" + c) for c in ("row", "plan", "salt", "size", "copy"))
    mine = docs.withColumn(mix, F.struct(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("source").isNull().alias("bare"),
        F.col("doc_id").cast("bigint").alias("doc_id"), hash_key(F.col("doc_id").cast("bigint"), text, seed).alias("key"), F.xxhash64(text).alias("text_key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        (F.lit(0) if few else F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).cast("int").alias("salt")))
    side = cuts.select(F.struct("*").alias(plan), F.explode(F.sequence(F.lit(0), F.lit(0 if few else SALTS - 1))).alias(salt))
    side = F.broadcast(side) if few else side
    joined = mine.join(side, (F.col(f"{mix}.source") == F.col(f"{plan}.source")) & (F.col(f"{mix}.bare") == F.col(f"{plan}.bare")) & (F.col(f"{mix}.salt") == F.col(salt)))
    here = F.struct(F.shiftrightunsigned(F.col(f"{mix}.key"), 32).alias("a"), F.col(f"{mix}.key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"),
                    F.col(f"{mix}.doc_id").alias("c"), F.col(f"{mix}.text_key").alias("d"))
    cut = F.col(f"{plan}.cut.place")
    last = (F.when(here < cut, F.col(f"{mix}.size")).when(here == cut, F.col(f"{plan}.cut.taken")).otherwise(F.lit(0)))
    copies = F.filter(F.concat(F.transform(F.sequence(F.lit(1), F.greatest(F.col(f"{plan}.epochs"), F.lit(1))),
                                           lambda e: F.struct(e.alias("epoch"), F.when(F.col(f"{plan}.epochs") > 0, F.col(f"{mix}.size")).otherwise(F.lit(0)).alias("taken"))),
                               F.array(F.struct((F.col(f"{plan}.epochs") + 1).alias("epoch"), F.coalesce(last, F.lit(0)).cast("bigint").alias("taken")))),
                      lambda c: c["taken"] > 0)
    out = joined.select(*docs.columns, F.col(f"{mix}.size").alias(size), F.explode(copies).alias(copy))
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col(f"{copy}.taken").cast("int")), " ")
    short = F.col(f"{copy}.taken") < F.col(size)
    values = {"text": F.when(short, head).otherwise(text),
              "n_chars": F.when(short, F.length(head)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {"text": F.when(short, head).otherwise(text)}
    return out.select(*[(values[c] if c in values else F.col(c)).alias(c) for c in docs.columns],
                      F.col(f"{copy}.epoch").alias(fresh_name(docs, "epoch")), F.col(f"{copy}.taken").alias(fresh_name(docs, "taken")))

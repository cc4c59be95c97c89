"""Session, table access and lineage helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "wordmill", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session tuned for the corpus workloads.

    AQE stays on: it coalesces the many small post-aggregation partitions of
    vocabulary-sized tables and splits skewed join partitions (a hot word can
    hold a large share of all token rows).
    """
    master = master or os.environ.get("WORDMILL_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # superseded checkpoints of iterative operators are removed with their DataFrames
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", os.environ.get("WORDMILL_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# A table planned at no more than this many bytes may be dealt to all cores before text work.
SPREAD_BYTES = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read one driver table.

    Parallelism comes from the scan's splits.  A small table (one file with
    one row group is a single split) is dealt round-robin to all cores, since
    text work is CPU-bound; the size is taken from the plan's statistics, so
    no more than ``SPREAD_BYTES`` is ever shuffled for it.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SPREAD_BYTES:
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return df


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used.  Only a local session without the setting gets a fresh
    scratch folder (tests, local benches).  On a cluster a missing setting is
    an error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before training")
    path = tempfile.mkdtemp(prefix="wordmill-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Executions planned in here remove their shuffle files at their end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder.

    Used by iterative operators (BPE rounds, greedy generation) so that the
    plan does not grow with the number of iterations and a lost executor only
    recomputes from the last checkpoint.
    """
    ensure_checkpoint_dir(spark_of(df))
    with shuffles_go(spark_of(df)):
        return df.select("*").checkpoint(eager=True)  # an execution of its own: ``df`` was planned before


def settled(df: DataFrame, by=()) -> DataFrame:
    """Materialise ``df`` as Parquet below the shared folder: for large tables of few columns a fraction of a checkpoint's size.

    Its rows are in folders of their own by the columns ``by``."""
    spark = spark_of(df)
    path = f"{ensure_checkpoint_dir(spark)}/{scratch_name('table')}"
    with shuffles_go(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def scratch_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def scalar_row(agg_df: DataFrame) -> dict:
    """Collect a one-row aggregate (a bounded handful of numbers) as a dict."""
    rows = agg_df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one aggregate row, got {len(rows)}")
    return rows[0].asDict()


def attach_scalars(df: DataFrame, agg_df: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row of ``df`` as literals.

    The aggregate is reduced on the executors; only its single row reaches the
    driver, so no join (and no cross product) is planned.
    """
    from pyspark.sql import functions as F

    row = scalar_row(agg_df)
    types = dict((f.name, f.dataType) for f in agg_df.schema.fields)
    for k, v in row.items():
        df = df.withColumn(k, F.lit(v).cast(types[k]))
    return df


# Largest model table (vocabulary, merge list, counts) shipped whole to every task.
BROADCAST_MAX_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, n_rows: int, row_bytes: int = 64, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only for a table whose size is known and under the bound; else a shuffle join follows."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if n_rows * row_bytes <= max_bytes else df


def with_rank(df: DataFrame, *order, name: str = "rank") -> DataFrame:
    """``df`` with 0, 1, 2, ... by ``order``: a range sort, then offsets from the partitions' counts (no one-task window)."""
    from pyspark.sql import functions as F

    placed = cut_lineage(df.orderBy(*order)).withColumn(name, F.monotonically_increasing_id())
    part = F.shiftright(name, 33)
    before, total = {}, 0
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):
        before[p], total = total, total + n
    if not before:
        return placed
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv]), part)
    return placed.withColumn(name, offset + F.col(name).bitwiseAND(F.lit((1 << 33) - 1)))

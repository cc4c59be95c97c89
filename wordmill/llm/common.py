"""Helpers shared by the training-data operators: tokenising on bytes, settled tables, components."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.session import ensure_checkpoint_dir, scratch_name

# bytes.translate table that lower-cases A-Z and leaves every other byte alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Words of [0-9a-z] and non-ASCII characters, after lower-casing A-Z: every other byte becomes a space.
ALNUM = bytes(LOWER[b] if b >= 0x80 or 48 <= b <= 57 or 97 <= LOWER[b] <= 122 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from wherever ``sf_dir`` points."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, prefix: str) -> str:
    """Address of a fresh folder (not created) below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), scratch_name(prefix))


def release_memory() -> None:
    """Give freed memory back to the system: Arrow's and the C library's pools keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a task whose worker, which Spark keeps for later tasks, does not keep what the task has freed."""
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return task


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def byte_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow binary column without nulls: value i takes the bytes from offset i to i + 1."""
    _, offsets, content = column.buffers()
    large = pa.types.is_large_binary(column.type)
    every = np.frombuffer(offsets, "<i8" if large else "<i4")[column.offset:column.offset + len(column) + 1]
    return every.astype(np.int64), np.frombuffer(content or b"", np.uint8)


def text_blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring texts that together take no more than ``most`` bytes, or a single longer text."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the classes of ``a[i]`` and ``b[i]``; a label is the smallest index of its class."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        la, lb = la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up


# Nodes whose edges may be looked up by broadcast in ``components`` (24 bytes each), and edges below which a node is none of them.
HUBS, HUB_EDGES = 1000, 64


def with_lowest(rows: DataFrame, neighbours: DataFrame, edges: int) -> DataFrame:
    """``rows`` ``(u, v)`` with ``m``, the smallest ``v`` that ``neighbours`` holds for ``u``.

    ``neighbours`` has at most ``2 * edges`` rows, so no more than ``HUBS``
    nodes hold over ``2 * edges / HUBS`` of them.  Those nodes' minima are
    broadcast and their rows stay where they are; all other keys are shuffled,
    and each is at most that share of the rows.
    """
    low = neighbours.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    hubs = low.where(F.col("n") > max(HUB_EDGES, 2 * edges // HUBS)).select(F.col("u").alias("hub"), F.col("m").alias("hub_m"))
    marked = rows.join(F.broadcast(hubs), F.col("u") == F.col("hub"), "left")
    return marked.where("hub is not null").select("u", "v", F.col("hub_m").alias("m")).unionByName(
        marked.where("hub is null").select("u", "v").join(low, "u").select("u", "v", "m"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``; the root is the smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    round is two aggregations, pre-aggregated before their shuffle, and two
    look-ups that never gather the edges of a large node (``with_lowest``), so
    no neighbourhood is ever collected.  Every round ends in a reliable
    checkpoint.  Only the round's edge count and checksum reach the driver.
    """
    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_lowest(both.where("v > u"), both, before[0]).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        small = (with_lowest(large, large, before[0])
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        e = settle(small)
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""SimHash near-duplicates: fingerprints of word shingles, bit-sliced comparison, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import LOWER, components, fresh_name, merge_labels, settle

# Fingerprints of one bucket that a single task compares; larger buckets are split into tiles of this size.
TILE = 8192
# Rows that one comparison task holds (buckets are packed into tasks of about this size).
ROWS_PER_TASK = 20_000
# Block comparisons done in one go; bounds the memory of a task.
CHUNK = 40_000


def fingerprint(raw: bytes, k: int, seed: int) -> int:
    """SimHash of one UTF-8 text over its k-word shingles (0 for a text without words)."""
    words = raw.translate(LOWER).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= k:
        return xxhash.xxh64_intdigest(joined, seed)
    length = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(length) + np.arange(n)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip((end - length)[:n - k + 1].tolist(), end[k - 1:].tolist())],
                      dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp)``: the 64-bit fingerprint (as a signed bigint) of every whole text; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", k, seed) for x in b.column(2)),
                             np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("raw"))
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def bit_planes(fps: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Vertical layout: row b holds, per block of up to 64 fingerprints, bit b of each of them."""
    planes = np.zeros((64, len(first)), np.uint64)
    for slot in range(int(n.max(initial=0))):
        has = n > slot
        x = fps[first[has] + slot]
        for b in range(64):
            planes[b, has] |= ((x >> np.uint64(b)) & np.uint64(1)) << np.uint64(slot)
    return planes


def close_in_blocks(fps: np.ndarray, planes: np.ndarray, valid: np.ndarray, query: np.ndarray, block: np.ndarray,
                    radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compare fingerprint ``query[i]`` with all of block ``block[i]`` at once, plane by plane.

    The distances of a block's 64 members are kept as vertical binary counters
    and advanced with carry-save additions.  ``dead`` marks members whose
    counter has passed the radius; a comparison is abandoned as soon as all
    members of its block are dead.  Returns the surviving (query, block, mask).
    """
    levels = radius.bit_length()
    limit = (1 << levels) - 1 - radius
    counters = [np.zeros(len(query), np.uint64) for _ in range(levels)]
    for c in range(levels):  # start at an offset, so that passing the radius overflows the top counter
        if limit >> c & 1:
            counters[c][:] = np.uint64(0xFFFFFFFFFFFFFFFF)
    dead = ~valid[block]
    bits = fps[query]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for b in range(64):
        flip = np.uint64(0) - ((bits >> np.uint64(b)) & np.uint64(1))
        carry = planes[b][block] ^ flip
        for c in range(levels):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        dead |= carry
        if b % 8 == 7:
            alive = dead != full
            if not alive.all():
                query, block, bits, dead = query[alive], block[alive], bits[alive], dead[alive]
                counters = [x[alive] for x in counters]
            if not len(query):
                break
    return query, block, ~dead


def link_buckets(value: np.ndarray, fps: np.ndarray, tile: np.ndarray, radius: int) -> np.ndarray:
    """Class labels (index of the smallest member) of fingerprints that share a bucket and lie within the radius.

    If ``tile`` holds two values, only comparisons between the two tiles are made.
    """
    order = np.lexsort((fps, tile, value))
    value, fps, tile = value[order], fps[order].view(np.uint64), tile[order]
    n = len(fps)
    labels = np.arange(n)
    edge = np.r_[True, (value[1:] != value[:-1]) | (tile[1:] != tile[:-1])]
    start = np.flatnonzero(edge)
    size = np.diff(np.r_[start, n])
    blocks = -(-size // 64)
    run_of_block = np.repeat(np.arange(len(start)), blocks)
    nth = np.arange(len(run_of_block)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = start[run_of_block] + nth * 64
    members = np.minimum(64, start[run_of_block] + size[run_of_block] - first)
    planes = bit_planes(fps, first, members)
    valid = np.where(members == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (members % 64).astype(np.uint64)) - np.uint64(1))
    block_at = np.cumsum(blocks) - blocks
    two = len(np.unique(tile)) == 2
    for low, high, r0, r1 in comparisons(start, size, blocks, two):
        # each fingerprint of runs [low, high) meets the blocks of run r0 + its own run's offset
        runs = np.arange(low, high)
        target = r0 + (runs - low) if r1 else runs
        q = np.repeat(np.arange(start[low], start[high - 1] + size[high - 1]), np.repeat(blocks[target], size[runs]))
        lead = np.repeat(np.repeat(block_at[target], size[runs]), np.repeat(blocks[target], size[runs]))
        per = np.repeat(blocks[target], size[runs])
        blk = lead + np.arange(len(q)) - np.repeat(np.cumsum(per) - per, per)
        if not two:  # within one run, a block wholly before the query has met it already
            keep = first[blk] + members[blk] > q
            q, blk = q[keep], blk[keep]
        for at in range(0, len(q), CHUNK):
            a, b, mask = close_in_blocks(fps, planes, valid, q[at:at + CHUNK], blk[at:at + CHUNK], radius)
            hit = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, slot = np.nonzero(hit)
            labels = merge_labels(labels, a[row], first[b[row]] + slot)
    out = np.empty(n, np.int64)
    out[order] = order[labels]
    return out


def comparisons(start, size, blocks, two: bool) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of runs to compare, cut so that a step lists a bounded number of comparisons."""
    if two:  # exactly two runs, the two tiles of one bucket
        yield 0, 1, 1, 1
        return
    low, total = 0, 0
    for i in range(len(start)):
        cost = int(size[i]) * int(blocks[i])
        if i > low and total + cost > 2_000_000:
            yield low, i, 0, 0
            low, total = i, 0
        total += cost
    if low < len(start):
        yield low, len(start), 0, 0


def link_fingerprints(nodes: DataFrame, radius: int, tile: int = TILE, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints ``nodes(fp)`` within ``radius`` bits of each other.

    Pigeonhole: of ``radius + 1`` bit blocks, two fingerprints within the
    radius agree on one at least, so only fingerprints of equal block value
    (a bucket) are compared.  Buckets are packed into tasks of bounded size; a
    bucket of more than ``tile`` fingerprints is dealt to tile-pair tasks.  A
    task returns a spanning forest of the links that it finds, never the pairs.
    """
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    blocks = F.array(*[F.struct(F.lit(i).alias("part"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1) if hi - lo < 64 else F.lit(-1)).alias("value"))
                       for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
    keyed = nodes.select("fp", F.explode(blocks).alias("x")).select("fp", "x.part", "x.value")
    tasks = max(1, nodes.count() // rows_per_task)
    large = (keyed.groupBy("part", "value").count().where(F.col("count") > tile)
             .select("part", "value", F.ceil(F.col("count") / tile).cast("int").alias("tiles")))
    dealt = keyed.join(large, ["part", "value"], "left").withColumn(
        "tile", F.when(F.col("tiles").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), F.col("tiles"))).cast("int"))
    dealt = dealt.select(
        "fp", "part", "value", "tile",
        F.when(F.col("tiles").isNull(), F.pmod(F.xxhash64("value"), F.lit(tasks))).otherwise(F.col("value")).alias("task"),
        F.explode(F.when(F.col("tiles").isNull(), F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"))))
                  .otherwise(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                                         lambda o: F.struct(F.least(F.col("tile"), o).alias("i"), F.greatest(F.col("tile"), o).alias("j"))))).alias("t"))

    def compare(df: pd.DataFrame) -> pd.DataFrame:
        fps = df["fp"].to_numpy()
        root = link_buckets(df["value"].to_numpy(), fps, df["tile"].to_numpy(), radius)
        moved = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[moved], "b": fps[root[moved]]})

    return (dealt.select("fp", "part", "value", "tile", "task", F.col("t.i").alias("i"), F.col("t.j").alias("j"))
            .groupBy("part", "task", "i", "j").applyInPandas(compare, "a bigint, b bigint"))


def simhash_groups(docs: DataFrame, k: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id",
                   text_col: str = "text", tile: int = TILE, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs``.

    Texts are lower-cased (A-Z) and shingled whole.  A null or empty text has
    fingerprint 0 and links like any other.  Repeated rows and equal texts
    share a fingerprint, are compared once and all returned.  A null doc_id is
    kept but never names a component; a component without any id has a null
    one.  An empty table gives an empty result.
    """
    fps, named = named_fingerprints(docs, k, radius, seed, id_col, text_col, tile, rows_per_task)
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def named_fingerprints(docs: DataFrame, k: int, radius: int, seed: int, id_col: str = "doc_id", text_col: str = "text",
                       tile: int = TILE, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Every row's fingerprint, and per fingerprint ``(fp, root, component_id)``."""
    fps = settle(fingerprints(docs, k, seed, id_col, text_col))
    nodes = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    links = components(link_fingerprints(nodes.select("fp"), radius, tile, rows_per_task))
    links = links.withColumnRenamed("node", "fp")
    rooted = nodes.join(links, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps, rooted.join(lowest, "root").select("fp", "root", "component_id")


def simhash_dedup(docs: DataFrame, k: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of smallest doc_id, rows without one last.

    A group is of texts, whatever their ids: two unlike texts of one doc_id
    both stay, and of several texts of the chosen doc_id in one group the one
    of smallest hash does.  Of repeated rows one stays.  Columns of any name
    are kept as they are.
    """
    fps, named = named_fingerprints(docs, k, radius, seed)
    place = F.struct(F.col("doc_id").isNull().alias("bare"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text_key")
    of_row = (fps.groupBy("fp", place.alias("place")).agg(F.count(F.lit(1)).alias("rows")).join(named, "fp"))
    first = settle(of_row.groupBy("root").agg(F.min(F.struct("place", "rows")).alias("m")).select("m.place.*", "m.rows"))
    names = {c: fresh_name(docs, "kept_" + c) for c in first.columns}
    first = first.select(*[F.col(c).alias(n) for c, n in names.items()])
    mine = (F.col("doc_id").isNull() == F.col(names["bare"])) & (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)) == F.col(names["doc_id"])) \
        & (F.xxhash64(F.col("text").cast("string")) == F.col(names["text_key"]))
    kept = docs.join(first.hint("shuffle_hash"), mine)
    out = kept.where(F.col(names["rows"]) == 1).select(*docs.columns)
    if first.where(F.col(names["rows"]) > 1).isEmpty():
        return out
    again = kept.where(F.col(names["rows"]) > 1).groupBy(*[F.col(n) for c, n in names.items() if c != "rows"])
    return out.unionByName(again.agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("row")).select("row.*"))

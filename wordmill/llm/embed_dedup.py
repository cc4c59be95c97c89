"""Embedding near-dedup: subspace pigeonhole join of rotated unit vectors.

Two unit vectors of cosine ``c`` are ``2 - 2c`` apart in squared distance.  A
random rotation spreads that distance evenly over the dimensions; cut into
blocks, at least one block holds no more than its proportional share of it.
Each block is range-joined under that share, and the union of the candidates
is verified exactly in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import components, merge_labels, settle

# Dimensions of a block, and the seed of the rotation.
BLOCK_DIMS, SEED = 16, 20240101
# Vectors of a tile, pivots per tile, most pivots, rows of one comparison step.
TILE, PIVOTS_PER_TILE, MOST_PIVOTS, STRIP = 8192, 4, 1024, 256
# Tiles whose bounds are compared on the driver (at most 4 bytes a pair); beyond, every pair of tiles is joined.
MOST_BOUNDS = 2_000
# Slack of the candidate search for single-precision rounding.
SLACK = 1e-4


def rotation(dims: int) -> np.ndarray:
    """A random rotation of ``dims`` dimensions, the same on every run."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def block_edges(dims: int) -> list[tuple[int, int]]:
    n = max(1, dims // BLOCK_DIMS)
    cuts = [dims * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, scaled first so that no finite component over- or underflows when squared."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def join_tiles(a: np.ndarray, b: np.ndarray, same: bool, cosine: float):
    """Yield (i, j) of the vectors of two tiles whose cosine is at least ``cosine``; i < j within one tile."""
    a, b = unit(a), a if same else unit(b)
    b = a if same else b
    dims = a.shape[1]
    turn = rotation(dims)
    distance = 2 - 2 * cosine
    sides = []
    for lo, hi in block_edges(dims):
        # one product per block gives -(squared distance) / 2 of all pairs
        x, y = (a @ turn[:, lo:hi]), (b @ turn[:, lo:hi])
        half = lambda v: (v * v).sum(axis=1, keepdims=True) / 2
        one = lambda v: np.ones((len(v), 1))
        sides.append((np.hstack([x, -half(x), one(x)]).astype(np.float32), np.hstack([y, one(y), -half(y)]).astype(np.float32).T.copy(),
                      np.float32(-(distance * (hi - lo) / dims + SLACK) / 2)))
    for at in range(0, len(a), STRIP):
        begin = at if same else 0
        near = np.zeros((min(STRIP, len(a) - at), len(b) - begin), bool)
        for x, y, least in sides:
            near |= x[at:at + STRIP] @ y[:, begin:] >= least
        i, j = np.nonzero(near)
        i, j = i + at, j + begin
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 200_000):
            p, q = i[part:part + 200_000], j[part:part + 200_000]
            exact = np.einsum("ij,ij->i", a[p], b[q]) >= cosine
            yield p[exact], q[exact]


def tile_rows(reps: DataFrame, cosine: float, tile: int) -> DataFrame:
    """``(node, copies, embedding, tile, i, j)``: every vector once for each pair of tiles that it has to meet.

    Vectors go to their nearest pivot (a bounded sample of vectors); cells are
    packed into tiles, large cells are split.  A pair of tiles is left out if,
    in every block, their balls are further apart than the block's share.
    """
    n = reps.count()
    pivots = reps.orderBy(F.xxhash64("node")).limit(int(min(MOST_PIVOTS, 1 + PIVOTS_PER_TILE * n // tile))).select("embedding").toPandas()
    if not len(pivots):
        return reps.select("node", "copies", "embedding", *[F.lit(0).alias(c) for c in ("tile", "i", "j")]).limit(0)
    pivots = unit(stack(pivots["embedding"]))
    pivots = pivots[np.argsort(pivots @ rotation(pivots.shape[1])[:, 0])]

    def nearest(vectors: pd.Series) -> pd.Series:
        return pd.Series((unit(stack(vectors)) @ pivots.T).argmax(axis=1).astype(np.int32))

    celled = settle(reps.withColumn("cell", F.pandas_udf(nearest, "int")("embedding")))
    sizes = sorted(celled.groupBy("cell").count().collect())
    first, parts, at, filled = {}, {}, 0, 0
    for cell, size in sizes:
        pieces = -(-size // tile)
        if filled and (pieces > 1 or filled + size > tile):
            at, filled = at + 1, 0
        first[cell], parts[cell] = at, pieces
        at, filled = (at + pieces, 0) if pieces > 1 else (at, filled + size)
    tiles = at + bool(filled)
    look = lambda d: F.element_at(F.array(*[F.lit(d.get(c, 0)) for c in range(len(pivots))]), F.col("cell") + 1)
    tiled = celled.withColumn("tile", (look(first) + F.pmod(F.xxhash64("node"), look(parts))).cast("int")).drop("cell")
    every = F.sequence(F.lit(0), F.lit(tiles - 1))
    if tiles <= MOST_BOUNDS:
        partners = tile_partners(tiled, tiles, cosine)
        tiled = tiled.join(F.broadcast(tiled.sparkSession.createDataFrame(list(enumerate(partners)), "tile int, partners array<int>")), "tile")
        every = F.col("partners")
    return (tiled.withColumn("other", F.explode(every))
            .select("node", "copies", "embedding", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")))


def tile_partners(tiled: DataFrame, tiles: int, cosine: float) -> list[list[int]]:
    """For each tile the tiles that hold a candidate for it in some block, judged by balls around the tiles' means."""
    def measure(df: pd.DataFrame) -> pd.DataFrame:
        v = unit(stack(df["embedding"]))
        v = v @ rotation(v.shape[1])
        mean = v.mean(axis=0)
        radius = [float(np.sqrt(((v[:, lo:hi] - mean[lo:hi]) ** 2).sum(axis=1).max())) for lo, hi in block_edges(v.shape[1])]
        return pd.DataFrame({"tile": [df["tile"].iloc[0]], "mean": [mean.tolist()], "radius": [radius]})

    bounds = tiled.select("tile", "embedding").groupBy("tile").applyInPandas(measure, "tile int, mean array<double>, radius array<double>").toPandas()
    mean, radius = np.zeros((tiles, len(bounds["mean"].iloc[0]))), np.zeros((tiles, len(bounds["radius"].iloc[0])))
    mean[bounds["tile"]], radius[bounds["tile"]] = np.stack(bounds["mean"]), np.stack(bounds["radius"])
    edges = block_edges(mean.shape[1])
    out = []
    for t in range(tiles):
        meet = np.zeros(tiles, bool)
        for k, (lo, hi) in enumerate(edges):
            apart = np.sqrt(((mean[:, lo:hi] - mean[t, lo:hi]) ** 2).sum(axis=1)) - radius[:, k] - radius[t, k]
            meet |= apart <= np.sqrt((2 - 2 * cosine) * (hi - lo) / mean.shape[1]) + SLACK
        out.append(np.flatnonzero(meet).tolist())
    return out


def link_tiles(rows: DataFrame, cosine: float) -> DataFrame:
    """``(node, links, low)`` per tile pair: linked vectors (copies counted), and an edge of a spanning forest of the links."""
    def compare(df: pd.DataFrame) -> pd.DataFrame:
        tiles = df["tile"].to_numpy()
        order = np.argsort(tiles, kind="stable")
        node, copies = df["node"].to_numpy()[order], df["copies"].to_numpy()[order]
        vectors = stack(df["embedding"])[order]
        cut = int(np.searchsorted(tiles[order], df["j"].iloc[0]))
        same = df["i"].iloc[0] == df["j"].iloc[0]
        if not same and (cut == 0 or cut == len(node)):
            return pd.DataFrame({"node": [], "links": [], "low": []})
        start = 0 if same else cut
        links, labels = np.zeros(len(node), np.int64), np.arange(len(node))
        for i, j in join_tiles(vectors if same else vectors[:cut], vectors[start:], same, cosine):
            j = j + start
            links += np.bincount(i, copies[j], len(node)).astype(np.int64) + np.bincount(j, copies[i], len(node)).astype(np.int64)
            labels = merge_labels(labels, i, j)
        met = np.flatnonzero(links)
        return pd.DataFrame({"node": node[met], "links": links[met], "low": node[labels[met]]})

    return rows.groupBy("i", "j").applyInPandas(compare, "node bigint, links bigint, low bigint")


def embedding_groups(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                     tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors``.

    Equal vectors are compared once; vectors of different length never link.
    Null or empty vectors, zero vectors and vectors with a null or non-finite
    component link with nothing.  Repeated rows are vectors of their own.  A
    null vec_id is no component's name and is not kept.  An empty table gives
    an empty result.
    """
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    x = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce((F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    reps = rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("copies"))
    reps = settle(reps).withColumn("node", F.monotonically_increasing_id())  # a checkpoint's partitions stay as they are
    lengths = [r[0] for r in reps.select(F.size("embedding")).distinct().collect()]
    found = None
    for dims in lengths:
        part = link_tiles(tile_rows(reps.where(F.size("embedding") == dims).select("node", "copies", "embedding"), cosine, tile), cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    found = settle(found)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    known = reps.join(links, "node", "left").join(roots, "node", "left").select(
        "embedding", "low_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    named = known.join(known.groupBy("root").agg(F.min("low_id").alias("component_id")), "root").select("embedding", "links", "component_id")
    out = rows.where(usable).join(named, "embedding").select("vec_id", F.col("links").alias("n_links"), "component_id")
    out = out.unionByName(rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

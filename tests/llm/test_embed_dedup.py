"""Embedding near-dedup against the matrix of all cosines."""

import numpy as np
import pytest

from wordmill.llm.embed_dedup import embedding_groups, rotation


def slow(rows, cosine=0.9):
    n = len(rows)
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float64), np.array(rows[j][1], np.float64)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                near[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((str(rows[i][0]), int(near[i].sum()), str(low), rows[i][0] is not None and rows[i][0] == low))
    return sorted(out)


def make(seed, dims):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(30):
        centre = rng.normal(size=dims)
        for _ in range(rng.choice([1, 1, 2, 12])):
            v = centre + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.3, 0.45])
            rows.append((500 - len(rows), [float(x) for x in v.astype(np.float32) * rng.choice([1, 1, 4])]))
    return rows


ODD = [(600, None), (601, []), (602, [0.0, 0.0]), (603, [1.0, None]), (604, [1.0, float("nan")]), (605, [1.0, float("inf")]), (606, [1.0, 0.1]), (607, [1.0, 0.1]),
       (608, [1.0, 0.1, 0.0]), (None, [1.0, 0.1]), (None, [5.0, -9.0]), (606, [1.0, 0.1]), (609, [-0.0, 3.0]), (610, [0.0, 3.0]), (611, [1e30, 1e29])]


@pytest.mark.parametrize("seed,dims,tile,kind", [(1, 64, 8192, "float"), (2, 64, 16, "float"), (3, 7, 10, "double"), (4, 33, 5, "double")])
def test_equals_all_pairs(spark, seed, dims, tile, kind):
    rows = make(seed, dims) + ODD
    vectors = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, label int, node string")
    if kind == "float":
        rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = embedding_groups(vectors, tile=tile).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == slow(rows)


def test_rotation_is_orthogonal_and_empty_table(spark):
    q = rotation(64)
    assert np.allclose(q @ q.T, np.eye(64)) and np.array_equal(q, rotation(64))
    assert embedding_groups(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    none = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert [(r.n_links, r.component_id, r.kept) for r in embedding_groups(none).collect()] == [(0, 1, True)]

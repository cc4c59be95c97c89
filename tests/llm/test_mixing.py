"""Mixing: targets against plain water-filling, exact budgets, reruns and the mixed documents."""

import random

import pytest

from wordmill.llm import mixing
from wordmill.llm.mixing import mix_sources, mixed_documents


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    stopped, target = set(), {}
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        total = sum(weight[s] for s in names if s not in stopped) or 1
        target = {s: most * sizes[s] if s in stopped else weight[s] * rest / total for s in names}
        more = {s for s in names if target[s] > most * sizes[s]}
        if not more:
            return target
        stopped |= more


def make(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        source = rng.choice(["hot"] * 8 + ["a", "b", "é", "zz", "Z", "", None, "tiny"])
        if source == "tiny" and rng.random() < 0.8:
            source = "hot"
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30]))), source))
    return rows + [(7, rows[7][1], rows[7][2]), (None, "a b", "hot"), (400, None, "hot"), (401, "", "void"), (402, "x \u00a0 y\x0bz", "b"), (403, "w " * 20000, "a")]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_budgets(docs_of, seed, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    rows = make(seed)
    size = lambda t: len([w for w in (t or "").replace("\x0b", " ").split(" ") if w])
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    docs = docs_of(rows)
    got = mix_sources(docs).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), size(t)) for i, t, _ in rows)
    source_of = {str(i): s for i, _, s in rows}
    target, taken = slow_targets(sizes), {}
    for r in got:
        s = source_of[str(r.doc_id)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s], rel=1e-12) and 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert taken == {s: int(target[s]) for s in sizes}
    again = mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_mixed_documents_follow_the_decisions(docs_of, broadcast, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    rows = [r for r in make(3) if r[0] not in (7,)]
    docs = docs_of(rows)
    want = {str(r.doc_id): r.taken for r in mix_sources(docs).collect() if r.taken}
    got = {}
    for r in mixed_documents(docs).collect():
        words = len([w for w in r.text.replace("\x0b", " ").split(" ") if w])
        assert words == r.taken and r.n_chars == len(r.text)
        got[str(r.doc_id)] = got.get(str(r.doc_id), 0) + r.taken
    assert got == want


def test_empty(docs_of):
    assert mix_sources(docs_of([])).count() == 0 and mixed_documents(docs_of([])).count() == 0
    only = mix_sources(docs_of([(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_columns_of_any_name_are_kept(docs_of, broadcast, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    names = ["epoch", "taken", "mix", "mix_size", "mix_copy", "salt", "plan", "mix_row", "mix_plan", "mix_salt", "cut", "key"]
    docs = docs_of([(i, "w " * i, "ab"[i % 2]) for i in range(8)]).select("*", *[F.lit(c).alias(c) for c in names])
    out = mixed_documents(docs)
    assert out.columns == [*docs.columns, "epoch_", "taken_"]
    rows = out.collect()
    assert rows and all(r[c] == c for r in rows for c in names) and all(len(r.text.split()) == r.taken_ for r in rows)


def test_rows_without_an_id_are_spread(docs_of):
    from wordmill.llm.mixing import sized_rows
    rows = sized_rows(docs_of([(None, f"text {i}") for i in range(50)]), 42, "doc_id", "source", "text")
    assert rows.select("key").distinct().count() == 50

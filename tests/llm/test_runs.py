"""Periodic runs against brute force: every start and period tried; Lyndon arrays against the definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.llm import runs as R
from wordmill.llm.queries import LLM_QUERIES
from wordmill.llm.runs import collapsed, find_runs, lyndon_array, runs_of, stretches, text_runs


def slow_lyndon(s):
    def longest(i):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        return j - i
    return [longest(i) for i in range(len(s))]


def slow_runs(w, least):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)  # periods come in rising order, so the smallest stays
            i = j + 1
    return {(s, length, q) for (s, length), q in found.items()}


def strings(rng, n):
    for _ in range(n):
        kind, size = rng.randrange(4), rng.randint(0, 60)
        if kind == 0:
            yield [rng.randrange(2) for _ in range(size)]
        elif kind == 1:
            yield [rng.randrange(5) for _ in range(size)]
        else:
            out = []
            while len(out) < size:
                root = [rng.randrange(3 + kind) for _ in range(rng.randint(1, 9))]
                out += root * rng.randint(1, 6) + root[:rng.randrange(len(root))]
            yield out


def test_lyndon_array_equals_definition():
    for s in strings(random.Random(1), 600):
        assert lyndon_array(s) == slow_lyndon(s), s
        assert lyndon_array([-x for x in s]) == slow_lyndon([-x for x in s]), s


@pytest.mark.parametrize("least", [2, 3, 12])
def test_runs_equal_brute_force(least):
    for s in strings(random.Random(least), 500):
        assert runs_of(np.array(s, np.int64), least) == slow_runs(s, least), s


def test_texts_together_equal_texts_alone():
    texts = [[b"%d" % x for x in s] for s in strings(random.Random(7), 800)]
    for found, t in zip(text_runs(texts, 12), texts):
        assert found == sorted(slow_runs(t, 12), key=lambda r: (r[0], r[2]))


def test_periodic_words_far_apart_are_pruned():
    line = list(range(20))
    s = np.array(line + list(range(100, 400)) + line + list(range(500, 700)) + line * 3)
    kept = list(stretches(s, np.zeros(len(s), np.int64), 12))
    assert sum(b - a for a, b in kept) < 100 and text_runs([[b"%d" % x for x in s]], 12) == [[(540, 60, 20)]]


def test_periods_of_powers_are_the_smallest():
    assert runs_of(np.array([1, 2] * 8), 12) == {(0, 16, 2)}
    assert runs_of(np.array([1] * 500), 12) == {(0, 500, 1)}


def test_collapse():
    w = b"a b c a b c a b c a b c x x x".split()
    assert collapsed(w, [(0, 12, 3)]) == b"a b c x x x"


def planted(doc_id, text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_brute_force(spark):
    query = next(q for n, q in LLM_QUERIES.items() if n.startswith("op11_"))
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    with_runs = 0
    for r in query(spark, sf).collect():
        words = planted(r["doc_id"], docs[r["doc_id"]])
        if len(words) > 1500:
            continue
        runs = sorted(slow_runs(words, 12), key=lambda x: (x[0], x[2]))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode())
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in gone).encode())
        with_runs += bool(runs)
    assert with_runs > 5


@pytest.mark.parametrize("at_once", [1, 4 << 20])
def test_rows_that_are_odd(spark, docs_of, monkeypatch, at_once):
    monkeypatch.setattr(R, "BYTES_AT_ONCE", at_once)
    rows = [(None, "a b " * 9), (1, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "x y " * 20), (3, "x y " * 20), (4, "é è\n" * 100_000)]
    clash = docs_of(rows).select("*", *[F.lit("x").alias(c) for c in ("runs", "n_words", "raw", "start")])
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(clash).collect()), key=repr)
    assert got == sorted([(None, 18, [(0, 18, 2)], "a b"), (1, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (3, 20, [(0, 20, 1)], "x y"),
                          (3, 20, [(0, 20, 1)], "x y"), (4, 200_000, [(0, 200_000, 2)], "é è")], key=repr)
    assert find_runs(docs_of([])).count() == 0

"""Substring dedup against brute force over every window, and the suffix-tree pieces."""

import hashlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

from wordmill.llm import substring
from wordmill.llm.queries import LLM_QUERIES
from wordmill.llm.substring import anchored_spans, dedup_substrings, pack, prefix_groups, resolve, subtree_repeats, unpack


def slow_words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def slow(rows, window=13):
    first = {}
    for i, t in rows:
        w = slow_words(t)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in rows:
        w = slow_words(t)
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (float("inf") if i is None else i):
                gone |= set(range(s, s + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def make(seed):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(40)] + ["é", "Ü\u2028x", "a\x00b", "A", "a"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [text(rng.choice([12, 13, 14, 20, 70])) for _ in range(8)]
    rows = []
    for i in range(80):
        words = text(rng.choice([0, 3, 20]))
        for _ in range(rng.choice([0, 1, 1, 3])):
            words += rng.choice(passages) + text(rng.choice([0, 1, 30]))
        rows.append((i * 7 % 83, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(200, None), (201, ""), (202, " "), (3, rows[5][1]), (None, rows[6][1]), (None, rows[6][1]), (None, "z " * 40), (300, "z " * 40),
             (301, "y " * 30000), (302, "y " * 20), rows[0], (0, " ".join(passages[4]) + " tail")]
    return rows


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"partition_bytes": 500, "subtree": 10}), (3, {"anchor": 1, "partition_bytes": 3000})])
def test_equals_brute_force(docs_of, seed, options, monkeypatch):
    monkeypatch.setattr(substring, "STEP", 100)
    rows = make(seed)
    got = dedup_substrings(docs_of(rows), **options).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got) == slow(rows)
    for r in got:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_query(spark, docs_of, tmp_path):
    rows = make(4)
    docs_of(rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = LLM_QUERIES["op5_substring_dedup"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow(rows)
    assert dedup_substrings(docs_of([])).count() == 0


def test_every_window_lies_in_one_span():
    rng = np.random.default_rng(0)
    hashes, doc = rng.integers(0, 2**63, 500).astype(np.uint64), np.sort(rng.integers(0, 9, 500))
    start, n, anchor = anchored_spans(hashes, doc, 13, 4)
    seen = sorted(s + i for s, m in zip(start, n) for i in range(m))
    assert seen == [s for s in range(488) if doc[s] == doc[s + 12]]


def test_long_batches_are_sliced(monkeypatch):
    rng = np.random.default_rng(2)
    hashes, doc = rng.integers(0, 2**63, 900).astype(np.uint64), np.zeros(900, np.int64)
    whole = anchored_spans(hashes, doc, 13, 4)
    of_window = lambda found: {s + i: a for s, m, a in zip(*found) for i in range(m)}
    for size in (1, 50, 887, 888, 889):
        monkeypatch.setattr(substring, "SLICE_WORDS", size)
        assert of_window(anchored_spans(hashes, doc, 13, 4)) == of_window(whole)
    assert len(anchored_spans(hashes[:12], doc[:12], 13, 4)[0]) == 0


def test_spans_of_hot_anchors_are_dealt_by_window(spark, docs_of, monkeypatch):
    monkeypatch.setattr(substring, "HOT_SAMPLE", 1)
    monkeypatch.setattr(substring, "HOT_LEAST", 2)
    monkeypatch.setattr(substring, "HOT_SHARE", 0.0)
    rows = make(5)
    from pyspark.sql import functions as F
    raw = docs_of(rows).select("doc_id", F.col("text").cast("binary").alias("raw"))
    assert len(substring.hot_anchors(raw, 13, 4, 1)) > 3
    got = dedup_substrings(docs_of(rows), partition_bytes=500).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got) == slow(rows)


def test_subtree_and_prefix_groups():
    rng = np.random.default_rng(1)
    suffix = rng.integers(0, 2, (300, 4))
    order, nodes = subtree_repeats(suffix)
    ranked = [tuple(x) for x in suffix[order]]
    assert ranked == sorted(ranked)
    assert len(nodes) == len(set(ranked)) and [ranked[i] for i in nodes] == sorted(set(ranked))
    group = prefix_groups(suffix, 30)
    for g in np.unique(group):
        mine = {tuple(x) for x in suffix[group == g]}
        depth = next(d for d in range(4, -1, -1) if len({x[:d] for x in mine}) == 1)
        others = {tuple(x)[:depth] for x in suffix[group != g]}
        assert depth and next(iter(mine))[:depth] not in others
    assert np.bincount(group).max() <= 60


def test_pack_round_trip():
    parts = {"a": np.arange(5, dtype=np.uint32), "b": b"x\ny", "c": np.empty(0, np.int64)}
    back = unpack(pack(**parts))
    assert back["b"] == b"x\ny" and all(np.array_equal(back[k], parts[k]) and back[k].dtype == parts[k].dtype for k in "ac")


def test_words_are_coded_by_first_appearance():
    values = np.array([9, 4, 9, 9, 7, 4])
    names, codes = substring.first_seen(values, 10)
    assert names.tolist() == [9, 4, 7] and codes.tolist() == [0, 0, 1, 1, 0, 2]
    assert names[substring.numbers_seen(codes)].tolist() == values.tolist()


def test_words_are_cut_whatever_the_separators():
    rng = random.Random(8)
    pieces = ["a", "bb", "é", "\u2028", "\x00", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(12))).encode() for _ in range(300)] + [b"", b" ", b"a", b"\xff \xfe"]
    n, words = substring.cut_words(texts)
    assert n.tolist() == [len(t.split()) for t in texts]
    assert words.to_pylist() == [w + b"\n" for t in texts for w in t.split()]
    assert substring.line_bytes(words.slice(2, 3)) == b"\n".join([w for t in texts for w in t.split()][2:5])


def test_no_python_step_runs_per_word():
    # 20,000 distinct words, once read by the shipping task and once by the resolving task
    text = " ".join(f"w{i}" for i in range(20_000)).encode()
    rows = pa.record_batch([pa.array([5, 2, None]), pa.array([0, 0, 0]), pa.array([text, text, None])], ["doc_id", "text_key", "raw"])
    tasks = []
    docs = type("Docs", (), {"mapInArrow": lambda self, run, schema: tasks.append(run)})()
    substring.ship_spans(docs, 13, 4, 1)
    steps = 0

    def count(frame, event, arg):
        nonlocal steps
        steps += 1

    sys.setprofile(count)
    try:
        blocks = [b for out in tasks[0](iter([rows])) for b in out.column(1).to_pylist()]
        ids, keys, at = resolve(blocks, 13)
    finally:
        sys.setprofile(None)
    assert set(ids.tolist()) == {5} and sorted(at.tolist()) == list(range(20_000 - 12))
    assert steps < 5_000

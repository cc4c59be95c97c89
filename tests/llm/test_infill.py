"""Fill-in-middle: SWAR rank and select against plain Python, outputs against the definition, round trips."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.llm import infill
from wordmill.llm.common import text_blocks
from wordmill.llm.infill import as_words, cut, fill_in_middle, rank, restored, select, unit_ends
from wordmill.llm.queries import LLM_QUERIES

ALPHABET = ["a", "é", "߿", "ࠀ", "￿", "𐀀", "🙂", "日", "\0", "\n", "<", "P", ">", "́"]


def slow(doc_id, text):
    text, digest = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_rank_and_select_equal_counting():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 50)))
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = unit_ends(as_words(raw), len(raw))
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)))
        lengths = np.cumsum([len(c.encode()) for c in text], dtype=np.int64)
        assert before[-1] == len(text)
        if text:
            assert select(ends, before, np.arange(1, len(text) + 1)).tolist() == lengths.tolist()
        assert rank(ends, before, np.arange(len(raw) + 1)).tolist() == [int((lengths <= i).sum()) for i in range(len(raw) + 1)]


def test_cuts_of_many_texts_in_one_buffer():
    rng = random.Random(4)
    texts = ["".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 2, 7, 8, 9, 30]))) for _ in range(500)]
    sizes = [len(t.encode()) for t in texts]
    offsets = np.cumsum([0, *sizes])
    draws = np.array([[rng.randrange(1 << 32) for _ in texts] for _ in range(2)])
    n, (units, at) = cut(np.frombuffer("".join(texts).encode(), np.uint8), offsets, draws)
    for i, t in enumerate(texts):
        a, b = sorted(int(d) % (len(t) + 1) for d in draws[:, i])
        assert (n[i], units[0, i], units[1, i]) == (len(t), a, b)
        assert [int(x) - offsets[i] for x in at[:, i]] == [len(t[:a].encode()), len(t[:b].encode())]


def test_blocks_cover_every_text():
    sizes = [0, 5, 100, 1, 1, 0, 50, 50, 7]
    offsets = np.cumsum([0, *sizes])
    blocks = list(text_blocks(offsets, 60))
    assert [i for lo, hi in blocks for i in range(lo, hi)] == list(range(len(sizes)))
    assert all(hi - lo == 1 or sum(sizes[lo:hi]) <= 60 for lo, hi in blocks)


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_output_equals_definition(spark, docs_of, monkeypatch, words):
    monkeypatch.setattr(infill, "WORDS_AT_ONCE", words)
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices(ALPHABET, k=rng.randint(0, 40)))) for i in range(400)]
    rows += [(None, "null id é"), (5, None), (5, ""), (7, "same"), (7, "same"), (900, "ends <P"), (901, "has <M> it"), (902, "é" * 300_000)]
    out = fill_in_middle(docs_of(rows)).withColumn("back", restored())
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, *slow(i, t), t or "") for i, t in rows), key=repr)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {r["doc_id"]: slow(r["doc_id"], r["text"]) + (r["text"],) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in next(q for n, q in LLM_QUERIES.items() if n.startswith("op12_"))(spark, sf).collect():
        n, form, a, m, output, text = want[r["doc_id"]]
        assert tuple(r) == (r["doc_id"], n, form, a, m, sha(output), sha(text))


def test_edges(spark, docs_of):
    assert fill_in_middle(docs_of([])).count() == 0
    clash = docs_of([(1, "a b")]).select("*", *[F.lit("x").alias(c) for c in ("form", "n", "raw", "h1", "output")])
    assert fill_in_middle(clash).first()["n"] == 3

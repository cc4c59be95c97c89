"""Best-fit packing: ids against the tokenizer, placements against one-at-a-time best fit."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from wordmill.llm.packing import ByteBpe, cut_points, pack_documents, packed_sequences, sweep

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "a", " a", "a ", "a  b", "a \n b", "a\n\n b  ", "it's 'll don't,  x", "\t\ta", "naïve café - 12,5 %", "a b c  d",
          "\x1c x \x1f y", "日本語 テキスト 🙂 🙂🙂", "foo, bar. baz; qux: (x) [y] {z}", "<|endoftext|> x <|endoftext|>", "a" * 300,
          "x\u0085 y", "don't Don'T 'S 's", "1 22 333 4a a4", "é éx", "- - -- --- ...", "_a _b a_b", "​ a ​"]


def slow_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_tokenizer():
    rng = random.Random(5)
    units = [*"ab c,.!?'\n\t 1é日  \x1c\x85_-", "  ", " the", " x,", "'s", "\n\n"]
    texts = TRICKY + ["".join(rng.choices(units, k=rng.randint(1, 40))) for _ in range(3000)]
    for most in (250_000, 7):  # a memory that is always full gives the same ids
        encode = ByteBpe(PATH, most)
        for text, ids in zip(texts, slow_ids(texts)):
            assert np.frombuffer(encode(text), "<u4").tolist() == ids, text


def test_ids_of_given_documents(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encode = ByteBpe(PATH)
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == slow_ids(texts)


def one_at_a_time(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def check(rows, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_sweep_equals_one_at_a_time():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([8, 20, 64])
        lengths = [rng.randint(1, capacity) if rng.random() < .7 else 3 for _ in range(rng.randint(1, 60))]
        counts = np.bincount(lengths, minlength=capacity + 1)
        due, rank = [], 0
        for length in range(capacity, 0, -1):
            if counts[length]:
                due.append((length, rank, int(counts[length])))
                rank += int(counts[length])
        assert sweep(due, {}, capacity)[2] == one_at_a_time(lengths, capacity)


@pytest.mark.parametrize("capacity,n", [(16, 60), (50, 150)])
def test_packing_equals_one_at_a_time(spark, docs_of, capacity, n):
    rng = random.Random(n)
    rows = [(i, " ".join(rng.choices(["the", "of", "a", "in"], k=rng.choice([1, 2, 3, 5, 9, 14, 30, 77])))) for i in range(n)]
    rows += [(None, "null id"), (3, "repeated id"), (3, "repeated id"), (n, None), (n + 1, "")]
    out = pack_documents(docs_of(rows), PATH, capacity, keep_ids=True).collect()
    want = {}
    for (i, t), ids in zip(rows, slow_ids([t or "" for _, t in rows])):
        ids = [*ids, 0]
        starts = cut_points(len(ids), capacity)
        for p, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            key = (i, p, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes()), tuple(ids[s:e]))
            want[key] = want.get(key, 0) + 1
            assert p == 0 or e - s == capacity
    got = {}
    for r in out:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"]))
        got[key] = got.get(key, 0) + 1
    assert got == want
    assert check(out, capacity) == one_at_a_time([r["length"] for r in out], capacity)


def test_sequences_hold_their_pieces(spark, docs_of):
    packed = pack_documents(docs_of([(i, "word " * (i % 7)) for i in range(20)]), PATH, 32, keep_ids=True)
    rows = {r["sequence_id"]: r for r in packed_sequences(packed).collect()}
    for r in packed.collect():
        s = rows[r["sequence_id"]]
        assert s["ids"][r["offset"]:r["offset"] + r["length"]] == r["ids"] and r["offset"] + r["length"] in s["ends"]


def test_edges(spark, docs_of):
    assert pack_documents(docs_of([]), PATH).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert pack_documents(docs_of([]), PATH).count() == 0
    clash = docs_of([(1, "a b"), (2, "c")]).select("*", *[F.lit("x").alias(c) for c in ("rank", "length", "room", "offset", "sequence_id", "ids")])
    assert check(pack_documents(clash, PATH).collect(), 2048) == 1
    one = pack_documents(docs_of([(1, "a " * 200_000)]), PATH).collect()
    assert check(one, 2048) == -(-sum(r["length"] for r in one) // 2048)
    same = pack_documents(docs_of([(i, "same text here") for i in range(3000)]), PATH, 64).collect()
    n = same[0]["length"]
    assert check(same, 64) == -(-3000 // (64 // n)) and {r["length"] for r in same} == {n}

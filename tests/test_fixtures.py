"""Hand-checkable fixtures (FIXTURES.md section 3) and small properties."""

import math

import pytest
from pyspark.sql import functions as F

from wordmill.functions import text
from wordmill.operators import embed, lm, profile, tokeval, vectors


def one(spark, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema)


def test_code_literals_and_tokens(spark):
    df = one(spark, "x = 3.14 + 42 \"a b\" 'c'")
    got = df.select(text.code_tokens("s").alias("t")).first()["t"]
    assert got == ["x", "=", "<NUM>", "+", "<NUM>", "<STR>", "<STR>"]


def test_whitespace_tokens_empty_and_unicode(spark):
    df = spark.createDataFrame([("",), (None,), ("a b　 c\x1cd",)], "s string")
    got = [r["t"] for r in df.select(text.whitespace_tokens("s").alias("t")).collect()]
    assert got == [[], [], ["a", "b", "c", "d"]]
    assert "a b　 c\x1cd".split() == ["a", "b", "c", "d"]


def test_sentences_keep_empty_pieces(spark):
    assert one(spark, "a..b.").select(text.sentences("s").alias("p")).first()["p"] == ["a", "", "b", ""]


def test_char_pairs(spark):
    got = one(spark, "abab").select(text.distinct_char_pairs("s").alias("p")).first()["p"]
    assert got == ["ab", "ba"]
    assert one(spark, "a").select(text.distinct_char_pairs("s").alias("p")).first()["p"] == []


def test_entropy(spark):
    counts = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "id int, n long")
    assert tokeval.token_entropy(counts).first()["entropy"] == pytest.approx(1.5)


def test_sample_std(spark):
    df = spark.createDataFrame([("a",), ("ab",)], "t string")
    row = profile.text_stats(df, ["t"]).first()
    assert row["std_length"] == pytest.approx(0.707107, abs=1e-6)


def test_skipgram_window_one(spark):
    s = spark.createDataFrame([(1, 1, ["a", "b", "a", "c"])], "conv_id long, turn long, tokens array<string>")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    got = sorted((r["center"], r["context"]) for r in embed.skipgram_pairs(s, vocab, window=1).collect())
    assert got == sorted([("a", "b"), ("b", "a"), ("b", "a"), ("a", "b"), ("a", "c"), ("c", "a")])


def test_cosine_and_missing(spark):
    v = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [2.0, 1.0]), ("z", [0.0, 0.0])], "word string, vector array<double>")
    p = spark.createDataFrame([("x", "y"), ("x", "q"), ("x", "z")], "a string, b string")
    got = {(r["a"], r["b"]): r["similarity"] for r in vectors.similarity(p, v).collect()}
    assert got[("x", "y")] == pytest.approx(0.8)
    assert got[("x", "q")] == 0.0 and got[("x", "z")] == 0.0


def test_nearest_matches_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    v = spark.createDataFrame(rows, "word long, vector array<double>").repartition(5)
    nn = vectors.most_similar(v.select("word"), v, topn=3, ).collect()
    got = {}
    for r in nn:
        got.setdefault(r["query"], []).append((r["rank"], r["word"]))
    m = np.array([x for _, x in rows])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = u @ u.T
    for q in range(0, 300, 37):
        order = sorted((j for j in range(300) if j != q), key=lambda j: (-sims[q, j], j))[:3]
        assert [w for _, w in sorted(got[q])] == order


@pytest.mark.parametrize("ref,hyp,want", [
    ("a b c d e", "a b c d e", 1.0),
    ("a b c d", "a b x d", 0.186165),
    ("a b c d e f", "a b c", 0.211795),
    ("a b", "x y", 0.0),
    ("a b", "", 0.0),
])
def test_bleu(spark, ref, hyp, want):
    df = spark.createDataFrame([(1, ref, hyp)], "k long, r string, h string")
    got = lm.bleu(df, "r", "h", "k").first()["bleu"]
    assert got == pytest.approx(want, abs=2e-6)


def test_lm_encode_decode_truncate(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "a a"), (3, "")], "doc_id long, text string")
    vocab = lm.lm_vocab(docs, "text", min_freq=2)
    assert {r["token"]: r["id"] for r in vocab.df().collect()} == {"<PAD>": 0, "<UNK>": 1, "<BOS>": 2, "<EOS>": 3, "a": 4}
    enc = lm.lm_encode(docs, "text", vocab)
    got = {r["doc_id"]: r["ids"] for r in enc.collect()}
    assert got == {1: [2, 4, 1, 4, 1, 3], 2: [2, 4, 4, 3], 3: [2, 3]}
    dec = {r["doc_id"]: r["decoded"] for r in lm.lm_decode(enc, "ids", vocab).collect()}
    assert dec == {1: "a <UNK> a <UNK>", 2: "a a", 3: ""}
    t = enc.select(lm.truncate_ids("ids", 4).alias("t")).collect()
    assert sorted(r["t"] for r in t) == sorted([[2, 4, 1, 3], [2, 4, 4, 3], [2, 3]])


def test_ngram_argmax_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    vocab = lm.lm_vocab(docs, "text", min_freq=2)
    enc = lm.lm_encode(docs, "text", vocab)
    model = lm.train_ngram_lm(enc, ["doc_id"], len(vocab))
    best3, top_w = model.best3, model.top_w
    l3, l2, l1, _ = model.lambdas
    tri = {(r["c2"], r["c1"], r["w"]): r["n3"] for r in model.tri.collect()}
    bi, ctx1, ctx2 = {}, {}, {}
    for (c2, c1, w), n in tri.items():
        bi[(c1, w)] = bi.get((c1, w), 0) + n
        ctx2[(c2, c1)] = ctx2.get((c2, c1), 0) + n
        ctx1[c1] = ctx1.get(c1, 0) + n
    uni = {}
    for (c1, w), n in bi.items():
        uni[w] = uni.get(w, 0) + n
    tot = sum(uni.values())
    followers = {}
    for (c1, w) in bi:
        followers.setdefault(c1, set()).add(w)
    got = {(r["c2"], r["c1"]): r["pred"] for r in best3.collect()}
    for (c2, c1) in list(ctx2)[:400]:
        cands = followers[c1] | {top_w}
        def score(w):
            return (l3 * tri.get((c2, c1, w), 0) / ctx2[(c2, c1)] + l2 * bi.get((c1, w), 0) / ctx1[c1]
                    + l1 * uni.get(w, 0) / tot)
        want = min(cands, key=lambda w: (-score(w), w))
        assert got[(c2, c1)] == want

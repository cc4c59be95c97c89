"""Encoding with the language model's vocabulary: tokens of rows whose keys repeat or are null, and that no token is a row."""

import random
from collections import defaultdict

from wordmill.operators import lm


def table(spark):
    rnd = random.Random(5)
    text = lambda: " ".join(rnd.choice(["a", "b", "c", "rare%d" % rnd.randint(0, 99), "<UNK>"]) for _ in range(rnd.choice([0, 1, 3, 40])))
    rows = [(i, "k%d" % (i % 3), text(), i % 2) for i in range(60)]
    rows += [(1, "k1", "a zz a", 7), (1, "k1", "b", 7), (None, "k1", "a b", 8), (2, None, "a", 8), (None, None, None, 9), (70, "k", None, 9), (70, "k", "c a", 9)]
    return rows, spark.createDataFrame(rows, "i long, k string, t string, extra int").repartition(5)


def test_rows_of_one_key_share_their_tokens(spark, monkeypatch):
    rows, df = table(spark)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 50, raising=False)
    vocab = lm.lm_vocab(df, "t", min_freq=2)
    number = {r["token"]: r["id"] for r in vocab.table.collect()}
    tokens = defaultdict(list)
    for i, k, t, _ in rows:
        if i is not None and k is not None:
            tokens[i, k] += [(at, number.get(w, lm.UNK_ID)) for at, w in enumerate((t or "").split())]
    got = lm.lm_encode(df, "t", vocab, ["i", "k"], keep=("extra",))
    assert got.columns == ["i", "k", "extra", "ids"]
    want = [(i, k, e, [lm.BOS_ID, *(n for _, n in sorted(tokens.get((i, k), []))), lm.EOS_ID]) for i, k, _, e in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_tokens_are_not_rows(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b")], "doc_id long, text string")
    plan = lm.lm_encode(docs, "text", lm.lm_vocab(docs, "text", min_freq=1))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.lm_encode(docs, "text", lm.lm_vocab(docs, "text")).collect() == []

"""Tables of the language models and joins of the linear skip-gram: where they lie, and that nothing large is collected."""

import random

from wordmill.operators import embed, lm, ngrams
from wordmill.session import settled


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sequences(spark, n=60):
    rnd = random.Random(3)
    rows = [(i, [2] + [rnd.choice([4, 4, 5, 6, 7]) for _ in range(rnd.choice([0, 1, 7, 20]))] + [3]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(3)


def test_settled_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, [1, None]), (None, None), (1, [1, None])], "a int, b array<int>")
    for x in (df, df.limit(0)):
        assert settled(x).schema == x.schema and sorted(map(str, settled(x).collect())) == sorted(map(str, x.collect()))


def test_model_tables_are_parquet(spark):
    model = lm.train_ngram_lm(sequences(spark), ["doc_id"], 8)
    assert all(t.inputFiles() for t in (model.uni, model.bi, model.tri, model.ctx1, model.ctx2, model.best3, model.best2))
    ordered = ngrams.train_ordered_lm(sequences(spark), 3, 8)
    assert all(t.inputFiles() for t in (ordered.counts, *ordered.follow, *ordered.best))


def test_trigrams_are_read_once_for_the_argmax(spark):
    model = lm.train_ngram_lm(sequences(spark), ["doc_id"], 8)
    best3, _, _ = lm.argmax_tables(model)
    assert executed(best3).count("n3:bigint") == 1   # in the schemas read by the scans


def test_linear_skipgram_joins_are_not_broadcast(spark):
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "word string, n long")
    cooc = spark.createDataFrame([("a", "b", 2), ("b", "a", 1)], "center string, context string, n long")
    vecs = embed._init_vectors(vocab, 4, 1, "w")
    delta = embed._weighted_sum(cooc, vecs, "context", "center")
    assert "Broadcast" not in executed(delta)
    assert "Broadcast" not in executed(embed._apply(vecs, delta, 0.1))


def test_weighted_sums_do_not_depend_on_the_grid(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(23)]
    pairs = [(a, b, rnd.randint(1, 9)) for a in words for b in words if rnd.random() < 0.4]
    vecs = {w: [rnd.random() for _ in range(3)] for w in words}
    cooc = spark.createDataFrame([*pairs, ("w1", "unknown", 7)], "center string, context string, n long")
    v = spark.createDataFrame(list(vecs.items()), "word string, vector array<double>")
    want = {}
    for a, b, n in pairs:
        want[a] = [x + n * y for x, y in zip(want.get(a, [0.0] * 3), vecs[b])]
    for grid in (1, 2, 5):
        delta = embed._weighted_sum(cooc, v, "context", "center", grid)
        found = {r["word"]: [round(x, 9) for x in r["delta"]] for r in delta.collect()}
        assert {w: s for w, s in found.items() if any(s)} == {w: [round(x, 9) for x in s] for w, s in want.items()}
        assert "u" not in delta.columns and "SortMergeJoin" not in executed(delta)

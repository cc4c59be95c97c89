"""Sources and sinks, model files, generation, approximate neighbours and the encoder's consistency check."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.operators import bpe, docgen, embed, lm, tokeval, vectors
from wordmill.session import with_rank
from wordmill.sources import corpus, models

TRAIN = ["def test(): return success", "print the test result and return success"]
PROBE = "test success"


def test_csv_keeps_quotes_and_newlines(spark, tmp_path):
    rows = [('def f():\n    return "a, b"', "Doc, with comma", None, "f", "r", "train"), ("x = 'y'", 'says "hi"', "s", "g", "r", "test")]
    df = spark.createDataFrame(rows, corpus.CORPUS_SCHEMA)
    corpus.write_corpus_csv(df, str(tmp_path / "c"))
    back = corpus.read_corpus(spark, str(tmp_path / "c"), "csv", corpus.CORPUS_SCHEMA, required=("code", "docstring"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, str(tmp_path / "c"), "csv", required=("nothing",))


def lines(path):
    return [json.loads(x) for f in sorted(os.listdir(path)) if f.endswith(".json") for x in open(os.path.join(path, f), encoding="utf-8")]


def test_report_and_generated_json(spark, tmp_path):
    corpus.write_report(spark.createDataFrame([("g", "m", 0.5)], "metric_group string, metric string, value double"), str(tmp_path / "r"))
    assert lines(tmp_path / "r") == [{"metric_group": "g", "metric": "m", "value": 0.5}]
    docs = spark.createDataFrame([("f", "Sümmary", None, 1)], "name string, summary string, docstring string, extra int")
    corpus.write_generated(docs, str(tmp_path / "g"))
    assert lines(tmp_path / "g") == [{"name": "f", "summary": "Sümmary", "docstring": None}]


def test_model_files_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TRAIN)), "doc_id long, text string")
    model = bpe.train_bpe(docs, "text", vocab_size=140)
    models.save_bpe(spark, model, str(tmp_path / "m"))
    back = models.load_bpe(spark, str(tmp_path / "m"))
    assert back == model
    probe = spark.createDataFrame([(1, PROBE)], "doc_id long, text string")
    a, b = (bpe.encode(probe, "text", m).first()["ids"] for m in (model, back))
    assert a == b
    assert bpe.decode(bpe.encode(probe, "text", back), "ids", back).first()["decoded"] == PROBE
    v = spark.createDataFrame([("a", [0.5, 1.0]), ("b", [1.0, 2.0])], "word string, vector array<double>")
    models.save_vectors(v, str(tmp_path / "v"))
    assert sorted(models.load_vectors(spark, str(tmp_path / "v")).collect()) == sorted(v.collect())


def toy_lm(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d", "a b c e", "b c d a", "c d a b c"] * 3)], "doc_id long, text string")
    vocab = lm.lm_vocab(docs, "text", min_freq=2)
    return docs, vocab, lm.train_ngram_lm(lm.lm_encode(docs, "text", vocab), ["doc_id"], len(vocab))


def test_greedy_generation_walks_the_argmax_tables(spark):
    docs, vocab, model = toy_lm(spark)
    prompts = lm.lm_encode(spark.createDataFrame([(1, "a b"), (2, "zz"), (3, ""), (4, "d a")], "doc_id long, text string"), "text", vocab)
    got = {r["doc_id"]: (r["ids"], r["n_new"]) for r in docgen.greedy_generate(prompts, model, max_new_tokens=20).collect()}
    best3 = {(r["c2"], r["c1"]): r["pred"] for r in model.best3.collect()}
    best2 = {r["c1"]: r["pred2"] for r in model.best2.collect()}
    for r in prompts.collect():
        ids = r["ids"][:-1]
        n = 0
        while n < 20 and (n == 0 or ids[-1] != lm.EOS_ID):
            c2 = ids[-2] if len(ids) > 1 else lm.BOS_ID
            ids = [*ids, best3.get((c2, ids[-1]), best2.get(ids[-1], model.top_w))]
            n += 1
        assert got[r["doc_id"]] == (ids, n)


def test_generated_documents(spark):
    docs, vocab, model = toy_lm(spark)
    df = spark.createDataFrame([(1, "a b c", "f"), (2, None, "g"), (3, "", None)], "k long, code string, name string")
    tok = bpe.train_bpe(docs, "text", vocab_size=115)
    out = {r["k"]: r for r in docgen.generate_docs(df, "k", "code", "name", vocab, model, bpe_model=tok, max_tokens=10).collect()}
    assert set(out) == {1, 2, 3} and all(r["summary"] and r["docstring"] for r in out.values())
    assert len(out[1]["docstring"].split()) >= len(out[1]["summary"].split())


def test_approximate_neighbours_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.15 * rng.normal(size=16)).tolist()) for i in range(400)]
    v = spark.createDataFrame(rows, "word long, vector array<double>")
    exact = {(r["query"], r["word"]) for r in vectors.most_similar(v.select("word"), v, 5).collect()}
    near = {(r["query"], r["word"]) for r in vectors.most_similar_approx(v.select("word"), v, 5).collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_approximate_neighbours_recall_without_clusters(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(600)] + [(600 + i, [1.0] * 32) for i in range(30)]
    v = spark.createDataFrame(rows, "word long, vector array<double>")
    of = lambda df: {(r["query"], r["word"]) for r in df.collect()}
    exact = of(vectors.most_similar(v.select("word"), v, 10))
    for options in ({}, {"query_block": 100, "vector_block": 90}):
        near = of(vectors.most_similar_approx(v.select("word"), v, 10, **options))
        assert len(near) == len(exact) and len(exact & near) / len(exact) >= 0.9


def test_nearest_blocks_give_the_same_answer(spark):
    rng = np.random.default_rng(5)
    v = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(90)], "word long, vector array<double>")
    q = v.select(F.col("word").alias("query"), "vector")
    whole = vectors.nearest(q, v, 4)
    blocks = vectors.nearest(q, v, 4, query_block=20, vector_block=13)
    assert sorted((r["query"], r["rank"], r["word"]) for r in whole.collect()) == sorted((r["query"], r["rank"], r["word"]) for r in blocks.collect())


def test_completion_with_unknown_words_only(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 0.1])], "word string, vector array<double>")
    lost = spark.createDataFrame([("s", ["zz", "yy"])], "id string, tokens array<string>")
    assert tuple(vectors.completion_accuracy(lost, v).first()) == (0.0, 1)
    known = spark.createDataFrame([("s", ["a", "c"]), ("t", ["a", "b"]), ("u", ["a"])], "id string, tokens array<string>")
    assert tuple(vectors.completion_accuracy(known, v).first()) == (0.5, 2)


def test_consistency_sees_a_faulty_encoder(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "low lower newest"), (2, "low"), (3, ""), (4, None)], "doc_id long, text string")
    model = bpe.model_from_merges(None, [("l", "o", 3), ("lo", "w", 3)])
    assert tokeval.encoding_consistency(docs, "text", model).first()["consistency_score"] == 1.0
    broken = bpe.model_from_merges(None, [("l", "o", 3), ("lo", "w", 3), ("n", "e", 1)])
    native = bpe.encode_words_native
    monkeypatch.setattr(bpe, "encode_words_native", lambda words, m: native(words, broken))
    assert tokeval.encoding_consistency(docs, "text", model).first()["consistent_texts"] == 3.0


def test_linear_skipgram_equals_numpy(spark):
    s = spark.createDataFrame([(1, 1, ["a", "b", "a", "c"])], "conv_id long, turn long, tokens array<string>")
    vocab = embed.frequency_vocab(s, 1)
    cooc = embed.cooccurrence(s, vocab, window=1)
    start = {k: {r["word"]: np.array(r["vector"]) for r in embed._init_vectors(vocab, 4, 42, k).collect()} for k in "wc"}
    n = {(r["center"], r["context"]): r["n"] for r in cooc.collect()}
    w, c = start["w"], start["c"]
    for _ in range(2):
        w, c = ({x: w[x] + 0.1 * sum((n.get((x, y), 0) * c[y] for y in c), np.zeros(4)) for x in w},
                {y: c[y] + 0.1 * sum((n.get((x, y), 0) * w[x] for x in w), np.zeros(4)) for y in c})
    got = {r["word"]: r["vector"] for r in embed.linear_skipgram(cooc, vocab, dim=4, lr=0.1, epochs=2).collect()}
    assert set(got) == set(w) and all(np.allclose(got[x], w[x]) for x in w)


def test_exact_split_and_batches(spark):
    df = spark.range(103).select(F.col("id").alias("doc_id"), F.array(F.lit(2), F.lit(3)).alias("ids"))
    counts = dict(lm.split_train_val_test(df, "doc_id", exact=True).groupBy("split").count().collect())
    assert counts == {"train": 82, "val": 10, "test": 11}
    sizes = sorted(r["count"] for r in lm.next_token_examples(df, "doc_id", batch_size=25).groupBy("batch").count().collect())
    assert sizes == [3, 25, 25, 25, 25]
    ranked = with_rank(df.repartition(7), F.desc("doc_id")).collect()
    assert all(r["rank"] == 102 - r["doc_id"] for r in ranked)
    assert with_rank(df.where("doc_id < 0"), "doc_id").count() == 0


def test_consistency_counts_rows_of_one_key(spark):
    docs = spark.createDataFrame([(1, "low lower"), (1, "low lower"), (1, "other"), (None, "low"), (2, None)], "doc_id long, text string")
    row = tokeval.encoding_consistency(docs, "text", bpe.model_from_merges(None, [("l", "o", 3)])).first()
    assert (row["consistency_score"], row["consistent_texts"], row["total_texts"]) == (1.0, 5.0, 5)


def test_few_contexts_travel_to_the_table(spark, monkeypatch):
    table = spark.range(1000).selectExpr("id % 300 as node", "id as seen").repartition(3)
    nodes = spark.createDataFrame([(5,), (5,), (299,), (1000,)], "node long")
    near = docgen.rows_of(table, nodes, 4)
    assert sorted(r["seen"] for r in near.collect()) == [5, 299, 305, 599, 605, 899, 905]
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "strategy=broadcast" in plan
    monkeypatch.setattr(docgen, "BROADCAST_MAX_BYTES", 4 * 32 - 1)
    assert docgen.rows_of(table, nodes, 4) is table


def test_tables_of_steps_serve_further_prompts(spark):
    _, vocab, model = toy_lm(spark)
    encoded = lambda texts: lm.lm_encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text", vocab)
    jumps, kept = [], []
    for texts, most in ((["a b"], 3), (["a b", "d a", ""], 20), (["zz", "e e", "zz zz c", "c a"], 7)):
        rows = lambda j: sorted(map(tuple, docgen.greedy_generate(encoded(texts), model, max_new_tokens=most, jumps=j).collect()))
        assert rows(jumps) == rows(None)
        kept.append(list(jumps))
    assert len(kept[0]) == 2 and len(kept[1]) == 5
    assert all(a is b for a, b in zip(kept[0], kept[1]))

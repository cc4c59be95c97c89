import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import SF001, bpe_segment, bpe_train
from wordmill.operators import bpe

FIXTURE = {"low": 5, "lower": 2, "newest": 6, "widest": 3}
EXPECTED = [("e", "s", 9), ("es", "t", 9), ("est", "</w>", 9), ("l", "o", 7), ("lo", "w", 7),
            ("e", "w", 6), ("ew", "est</w>", 6), ("n", "ewest</w>", 6), ("low", "</w>", 5),
            ("d", "est</w>", 3)]


def fixture_df(spark):
    text = " ".join(w for w, f in FIXTURE.items() for _ in range(f))
    return spark.createDataFrame([(1, text)], "doc_id long, text string")


def test_base_vocab_sizes(spark):
    assert len(bpe.base_vocab_tokens(eow_in_vocab=False)) == 103
    assert len(bpe.base_vocab_tokens(bpe.ADVANCED_SPECIALS, eow_in_vocab=False)) == 105
    assert bpe.base_vocab(spark).count() == 104


def test_train_fixture(spark):
    base = len(bpe.base_vocab_tokens())
    model = bpe.train_bpe(fixture_df(spark), "text", vocab_size=base + 10)
    assert model.merges == EXPECTED
    assert bpe_train(FIXTURE, 10) == EXPECTED


def test_segment_fixture(spark):
    model = bpe.model_from_merges(None, EXPECTED)
    df = spark.createDataFrame([(w,) for w in FIXTURE], "word string")
    got = {r["word"]: r["tokens"] for r in bpe.encode_words(df, model).collect()}
    assert got["low"] == ["low</w>"]
    assert got["lower"] == ["low", "e", "r", "</w>"]
    assert got["newest"] == ["newest</w>"]
    assert got["widest"] == ["w", "i", "dest</w>"]


def test_merge_left_to_right(spark):
    df = spark.createDataFrame([("aaa",)], "word string")
    syms = bpe.init_symbols(df.withColumn("freq", F.lit(1)))
    out = bpe.merge_pair(syms, "a", "a").select(bpe.symbols_of("sym").alias("s")).first()["s"]
    assert out == ["aa", "a", "</w>"]


def test_fully_merged_word_has_no_pairs(spark):
    df = spark.createDataFrame([(bpe.SEP + "ab</w>" + bpe.SEP, 3)], "sym string, freq long")
    assert bpe.pair_counts(df).count() == 0


def test_train_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    freqs = {r["word"]: r["freq"] for r in bpe.word_freqs(docs, "text").collect()}
    model = bpe.train_bpe(docs, "text", vocab_size=len(bpe.base_vocab_tokens()) + 21 + 30)
    assert len(model.merges) == 30
    assert model.merges == bpe_train(freqs, 30)
    # encode on distinct words equals list-based segmentation
    words = spark.createDataFrame([(w,) for w in list(freqs)[:500]], "word string")
    for r in bpe.encode_words(words, model).collect():
        assert r["tokens"] == bpe_segment(r["word"], model.merges)


def test_encode_decode_roundtrip(spark):
    model = bpe.model_from_merges(None, EXPECTED)
    df = spark.createDataFrame([(1, "low  lower\nnewest"), (2, ""), (3, None)], "doc_id long, text string")
    enc = bpe.encode(df, "text", model)
    got = {r["doc_id"]: r["ids"] for r in enc.collect()}
    assert got[2] == [] and got[3] == []
    dec = {r["doc_id"]: r["decoded"] for r in bpe.decode(enc, "ids", model).collect()}
    assert dec[1] == "low lower newest"
    rows = bpe.encode_rows(df, "text", model).collect()
    assert {r["doc_id"]: r["ids"] for r in rows}[1] == got[1]


@pytest.mark.parametrize("seed,top", [(1, 4000), (2, 5), (4, 4000)])
def test_many_merges_a_round_equal_one_at_a_time(spark, seed, top):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefé\u0001\u0002"
    freqs = Counter("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(120))
    freqs = {w: f * rng.choice([1, 1, 2, 3]) for w, f in freqs.items()}
    df = spark.createDataFrame([("x", w, f) for w, f in freqs.items()] + [("y", w, f) for w, f in list(freqs.items())[:4]],
                               "corpus string, word string, freq long")
    base = len(bpe.base_vocab_tokens()) + len({c for w in freqs for c in w} - set(bpe.base_characters()))
    models = bpe.train_bpe_keyed(df, {"x": base + 50, "y": 100000}, top_pairs=top)
    assert models["x"].merges == bpe_train(freqs, 50)
    assert models["y"].merges == bpe_train(dict(list(freqs.items())[:4]), 100000)
    words = spark.createDataFrame([(w,) for w in freqs], "word string")
    want = {w: bpe_segment(w, models["x"].merges) for w in freqs}
    assert {r["word"]: r["tokens"] for r in bpe.encode_words(words, models["x"]).collect()} == want
    ids = {w: [models["x"].vocab.get(t, models["x"].unk_id) for t in want[w]] for w in want}
    assert {r["word"]: r["ids"] for r in bpe.encode_words_native(words, models["x"]).collect()} == ids


def test_words_with_the_separator_are_kept(spark):
    df = spark.createDataFrame([(1, "a\u0001b a\u0001b \u0002a \u0001")], "doc_id long, text string")
    freqs = bpe.word_freqs(df, "text")
    assert {r["word"]: bpe_segment(r["word"], []) for r in freqs.collect()} == {
        r["word"]: r["s"] for r in bpe.init_symbols(freqs).select("word", bpe.symbols_of("sym").alias("s")).collect()}
    model = bpe.train_bpe(df, "text", vocab_size=1000)
    assert ("\u0001", "b", 2) in model.merges
    enc = bpe.encode(df, "text", model)
    assert bpe.decode(enc, "ids", model).first()["decoded"] == "a\u0001b a\u0001b \u0002a \u0001"


def test_truncated_model_is_the_smaller_training(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(20)
    large = bpe.train_bpe(docs, "text", vocab_size=260)
    small = bpe.train_bpe(docs, "text", vocab_size=200)
    assert large.truncated(len(small.merges)).vocab == small.vocab and large.merges[:len(small.merges)] == small.merges


def test_real_sizes_are_registered_and_the_sweep_has_every_metric(spark, monkeypatch):
    from wordmill.operators import tokeval
    from wordmill.plans import queries

    assert queries.SWEEP == (1000, 3000, 5000) and {"d8_train_bpe_5000", "d9_train_bpe_per_corpus_5000"} <= set(queries.QUERIES)
    assert queries.BPE_LARGE == 5000 and set(queries.D9_LARGE.values()) == {5000}
    docs = spark.createDataFrame([(1, "low lower newest"), (2, "low")], "doc_id long, text string")
    monkeypatch.setattr(queries, "_docs", lambda *_: docs)
    groups = {(r["vocab_size"], r["metric_group"]) for r in queries.q_d10(spark, "sweep of a toy table").collect()}
    assert groups == {(n, m) for n in queries.SWEEP for m in tokeval.ADVANCED_METRICS}


def test_large_models_per_corpus_equal_brute_force(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(160)]
    freqs = {c: {w: rng.randint(1, 9) for w in words[i * 30:100 + i * 30]} for i, c in enumerate(("code", "doc"))}
    df = spark.createDataFrame([(c, w, f) for c in freqs for w, f in freqs[c].items()], "corpus string, word string, freq long")
    models = bpe.train_bpe_keyed(df, {"code": 5000, "doc": 5000})
    for c in freqs:
        assert len(models[c].merges) > 250 and models[c].merges == bpe_train(freqs[c], 5000)
    asked = spark.createDataFrame([(w,) for w in words + ["a" * 300, "\u0001a</w>", ""]], "word string")
    want = {r["word"]: r["ids"] for r in bpe.encode_words(asked, models["doc"]).collect()}
    assert {r["word"]: r["ids"] for r in bpe.encode_words_native(asked, models["doc"]).collect()} == want


@pytest.mark.parametrize("seed", range(12))
def test_replayed_rounds_are_the_merges_of_one_at_a_time(seed):
    """Without Spark: counts of a round, replay, merges applied, and again; short floors and few letters make many ties and overlaps."""
    rng = random.Random(seed)
    letters = "ab" if seed % 3 == 0 else "abcd" if seed % 3 == 1 else "</w>a"
    freqs = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 10))): rng.randint(1, 6) for _ in range(60)}
    words, merges = [([*w, bpe.EOW], f) for w, f in freqs.items()], []
    want = bpe_train(freqs, 80)
    while len(merges) < len(want):
        pairs, contexts = Counter(), Counter()
        for parts, f in words:
            for p in zip(parts, parts[1:]):
                pairs[p] += f
            for p in zip(parts, parts[1:], parts[2:]):
                contexts[p] += f
        top = sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0]))[:rng.choice([3, 20, 500])]
        floor = top[-1][1] if len(top) < len(pairs) else 0
        known = {p: n for p, n in top if n > floor}
        seen = {k: n for k, n in contexts.items() if k[:2] in known and k[1:] in known}
        found = bpe.replay(known, seen, floor, len(want) - len(merges), {bpe.EOW, *(a + b for a, b, _ in merges)}) or [(*top[0][0], top[0][1])]
        merges += found
        rank = {(a, b): i for i, (a, b, _) in enumerate(found)}
        after = lambda p, last=-1: r if (r := rank.get(p)) is not None and r > last else None
        words = [(bpe.fold(parts, [after(p) for p in zip(parts, parts[1:])], after), f) for parts, f in words]
        assert merges == want[:len(merges)]


def test_smaller_models_are_read_off_the_larger_ones_merges():
    rng = random.Random(3)
    freqs = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))): rng.randint(1, 5) for _ in range(50)}
    merges = bpe_train(freqs, 40)
    segment = bpe.Segmenter(merges, {}, -1)
    for w in freqs:
        assert segment.symbols_at(w, [0, 7, 20, 40]) == [bpe_segment(w, merges[:n]) for n in (0, 7, 20, 40)]


def test_merges_over_arrays_equal_one_at_a_time():
    """The passes of a training work on rows of symbol numbers: runs of equal symbols, row ends, symbols spelled by other merges."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(11)
    for _ in range(40):
        words = ["".join(rnd.choice("aab\u0001<") for _ in range(rnd.randint(0, 9))) + rnd.choice(["", "</w>"]) for _ in range(30)]
        symbols = bpe.Symbols(c for w in words for c in w)
        sym, sizes = bpe.split_words(pa.array(words), symbols.points)
        row = np.repeat(np.arange(len(words)), sizes)
        parts = [[*map(bpe.escape, w), bpe.EOW] for w in words]
        assert [symbols.spelled[i] for i in sym] == [s for p in parts for s in p]
        merges = []
        for _ in range(8):
            pairs = sorted({p for w in parts for p in zip(w, w[1:])})
            if not pairs:
                break
            lhs, rhs = rnd.choice(pairs)
            merges.append((symbols.of(lhs), symbols.of(rhs), symbols.of(lhs + rhs)))
            parts = [bpe.fold(w, [0 if p == (lhs, rhs) else None for p in zip(w, w[1:])], lambda p, last: None) for w in parts]
        new, of = bpe.merge_rows(sym.copy(), row, merges)
        assert [[symbols.spelled[s] for s in new[of == i]] for i in range(len(words))] == parts


def test_first_merge_splits_the_texts_once(spark):
    from wordmill.plans.queries import QUERIES

    assert not [f for f in QUERIES["d7_merge_best_pair"](spark, SF001).inputFiles() if "documents" in f]

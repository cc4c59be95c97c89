"""Decoding by blocks (G3) and the report's BLEU on ids."""

import math

from wordmill.operators import lm

WORDS = ["<PAD>", "<UNK>", "<BOS>", "<EOS>", "a", "bb", "é"]
ROWS = [(1, "x", [2, 4, 5, 99, 1, 3]), (2, "y", [2, 3]), (3, "y", []), (4, "z", None), (None, "n", [2, 4, 3]),
        (5, "p", [2, 6, None, 0, 4, 3]), (5, "q", [2, 6, 4, 3])]


def test_no_id_is_a_row(spark, monkeypatch):
    vocab = lm.LmVocab(spark.createDataFrame([(t, i) for i, t in enumerate(WORDS)], "token string, id int"), len(WORDS))
    df = spark.createDataFrame(ROWS, "doc_id long, o string, ids array<int>")
    want = {"x": "a bb <UNK> <UNK>", "y": "", "z": "", "n": "", "p": "é é a a", "q": "é é a a"}  # rows of key 5 share their ids
    for size in (1, 16 << 20):
        monkeypatch.setattr(lm, "BLOCK_BYTES", size)
        out = lm.lm_decode(df, "ids", vocab)
        assert out.columns == ["doc_id", "o", "ids", "decoded"] and out.count() == len(ROWS)
        assert {r["o"]: r["decoded"] for r in out.collect()} == want
    both = {r["o"]: r["decoded"] for r in lm.lm_decode(df, "ids", vocab, ["doc_id", "o"]).collect()}
    assert both == want | {"p": "é a", "q": "é a"}
    once = lm.lm_decode(df.where("doc_id < 5"), "ids", vocab)
    assert "posexplode" not in once._jdf.queryExecution().optimizedPlan().toString()
    assert lm.lm_decode(df.limit(0), "ids", vocab).count() == 0


def test_the_report_needs_no_spelling(spark):
    positions = spark.createDataFrame([("val", 1, i + 1, 2, 4 + i, w) for i, w in enumerate([4, 5, 6, 4, 3])] + [("val", None, 1, 2, 2, 3)],
                                      "split string, doc_id long, pos int, c2 int, c1 int, w int")
    scored = spark.createDataFrame([(2, 4 + i, w, -1.0, p) for i, (w, p) in enumerate([(4, 4), (5, 5), (6, 6), (4, 4), (3, 99)])] + [(2, 2, 3, -1.0, 3)],
                                   "c2 int, c1 int, w int, logp double, pred int")
    got = {(r["split"], r["metric"]): r["value"] for r in lm.lm_report(positions, scored, lm.LmVocab(None, 7), "doc_id").collect()}
    # five predicted words, the last unknown, of four said: 4/5, 3/4, 2/3, 1/2; the row without words scores 0
    assert math.isclose(got["val", "bleu"], (4 / 5 * 3 / 4 * 2 / 3 * 1 / 2) ** 0.25 / 2)
    assert math.isclose(got["val", "accuracy"], 5 / 6) and got["val", "n_tokens"] == 6

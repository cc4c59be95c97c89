"""Encoding work: each distinct word of a slice once, each text once, whatever reads the encoding."""

import pyarrow as pa
from pyspark.sql import functions as F

from brute import bpe_segment
from wordmill.operators import bpe, tokeval

MERGES = [("a", "b"), ("ab", "a"), ("c", "</w>"), ("b", "ab"), ("a", "b")]
TEXTS = ["abab c cab", "", None, "ab. abab\x01c \x02ba", "c c c", "abababab" * 3 + " é"]


def model():
    return bpe.model_from_merges(None, MERGES, extra_chars=("é", "\x01", "\x02"))


def test_segments_do_not_depend_on_slices(monkeypatch):
    m = model()
    words = [None if t is None else t.split() for t in TEXTS] * 3
    want = [[s for w in ws or [] for s in bpe_segment(w, m.merges)] for ws in words]
    for size in (1, 2, 5, 1000):
        monkeypatch.setattr(bpe, "SLICE_WORDS", size)
        rows = pa.array([["x"], *words], pa.list_(pa.string())).slice(1)
        assert bpe.segmented(rows, bpe.Segmenter(m.merges, m.vocab, m.unk_id, most=2), False).to_pylist() == want
        ids = bpe.segmented(rows, bpe.Segmenter(m.merges, m.vocab, m.unk_id), True).to_pylist()
        assert ids == [[m.vocab.get(s, m.unk_id) for s in ss] for ss in want]


def test_a_slice_holds_few_distinct_lookups():
    seen = []

    class Counting(bpe.Segmenter):
        def remembered(self, word, ids):
            seen.append(word)
            return super().remembered(word, ids)

    m = model()
    bpe.segmented(pa.array([["ab", "c"] * 50] * 20), Counting(m.merges, m.vocab, m.unk_id), True)
    assert sorted(seen) == ["ab", "c"]


def test_ids_are_counted_from_one_encoding(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    counts = tokeval.id_counts(tokeval.encoded_table(df, "text", model()))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    m = model()
    want = {}
    for t in TEXTS:
        for w in (t or "").split():
            for s in bpe_segment(w, m.merges):
                i = m.vocab.get(s, m.unk_id)
                want[i] = want.get(i, 0) + 1
    assert {r["id"]: r["n"] for r in counts.collect()} == want


def test_facts_do_not_depend_on_slices(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 4)], "doc_id long, text string").repartition(1)
    models = {"all": model(), "some": model().truncated(2)}
    read = lambda: sorted((r["model"], r["metric_group"], r["metric"], str(r["value"]))
                          for r in tokeval.evaluate(models, df, metrics=tokeval.ADVANCED_METRICS).collect())
    whole = read()
    monkeypatch.setattr(tokeval, "SLICE_CHARS", 1)
    assert read() == whole


def test_folding_picks_the_same_merges(monkeypatch):
    m = model()
    words = sorted({w for t in TEXTS if t for w in t.split()})
    few = [bpe.Folder(m.merges, m.vocab, m.unk_id).ids(w, n) for w in words for n in (None, 0, 2, 9)]
    monkeypatch.setattr(bpe, "FEW_MERGES", 0)
    assert few == [bpe.Folder(m.merges, m.vocab, m.unk_id).ids(w, n) for w in words for n in (None, 0, 2, 9)]


def test_many_words_are_segmented_as_one_at_a_time(monkeypatch):
    merges = [*MERGES[:4], ("ab", "ab"), ("a", "a"), ("aa", "a"), ("é", "é"), ("abab", "c</w>")]
    words = ["abab", "c", "cabab", "aaaaa", "aaaa", "éééé", "ab\x01c", "\x02aa", "z", "ababc", "</w>"]
    for passes in (0, 64):  # looked up per word, and one merge after another
        monkeypatch.setattr(bpe, "PASSES", passes)
        many, sizes = bpe.ManyWords(merges), [0, 3, 6, len(merges)]
        for size, (sym, n) in zip(sizes, many.segmented(words, sizes)):
            spelled = iter(many.spellings(sym))
            assert [[next(spelled) for _ in range(k)] for k in n] == [bpe_segment(w, merges[:size]) for w in words]


def test_words_of_a_slice_are_segmented_together(monkeypatch):
    calls = []
    monkeypatch.setattr(bpe.Segmenter, "symbols", lambda self, word: calls.append(word))
    monkeypatch.setattr(bpe.Folder, "ids", lambda self, word, before=None: calls.append(word))
    m = bpe.model_from_merges(None, MERGES[:4], extra_chars=("é",))
    ids = bpe.segmented(pa.array([["abab", "cab", "é"], ["c"]]), bpe.Segmenter(m.merges, m.vocab, m.unk_id), True).to_pylist()
    want = lambda w: [m.vocab.get(s, m.unk_id) for s in bpe_segment(w, m.merges)]
    assert ids == [[*want("abab"), *want("cab"), *want("é")], want("c")] and not calls
    facts = tokeval.WordFacts([m.truncated(2), m], set(tokeval.ADVANCED_METRICS))
    held = [tokeval.Counter(), tokeval.Counter()]
    facts.add(["abab c. cab.c", "é abab"], held)
    assert not calls and held[1]["consistent", 0] == 2 and held[1]["kept", 0] == held[1]["either", 0] == 5


def test_facts_show_a_fault_of_either_encoder(monkeypatch):
    m, held = bpe.model_from_merges(None, MERGES[:4]), [tokeval.Counter()]
    good = bpe.Folder.many
    monkeypatch.setattr(bpe.Folder, "many", lambda self, words, sizes: [([*s[:-1], "?"], n) for s, n in good(self, words, sizes)])
    tokeval.WordFacts([m], {"consistency"}).add(["ab c", "ab", "c ab"], held)
    assert held[0]["texts", 0] == 3 and held[0]["consistent", 0] == 1


def test_words_are_folded_together(spark, monkeypatch):
    m = bpe.model_from_merges(None, MERGES[:4], extra_chars=("é",))
    words = ["abab", "cab", "é", "c", "z"]
    want = {w: [m.vocab.get(s, m.unk_id) for s in bpe_segment(w, m.merges)] for w in [*words, "a\x01b"]}
    folded = lambda ws: {r["word"]: r["ids"] for r in bpe.encode_words_native(spark.createDataFrame([(w,) for w in ws], "word string").coalesce(1), m).collect()}
    assert folded([*words, "a\x01b"]) == want

    class Together(bpe.Folder):
        def ids(self, word, before=None):
            raise AssertionError("a word of its own")

    monkeypatch.setattr(bpe, "Folder", Together)
    assert folded(words) == {w: want[w] for w in words}

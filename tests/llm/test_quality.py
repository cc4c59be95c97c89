"""Co-trained quality classifier: held-out accuracy, pseudo-labels, degenerate labels; the regression it rests on."""

import os
import random
import zlib

import numpy as np

from wordmill.llm import quality
from wordmill.llm.common import releasing
from wordmill.llm.logit import fit_line, fit_softmax, scores_of, softmax, temperature
from wordmill.llm.quality import (FOLDS, CoTrained, classes_of, co_train, keep_good, meta_view, sample_features, score_quality, sigmoid, surest,
                                  text_view, unlabelled_features, word_features)


def make(seed, n=700):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)]
    rows, truth = [], {}
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(20, 120))
        kind = rng.choice(["good", "good", "good", "junk", "toxic"])
        if kind == "junk":
            words = [w.upper() + "!!" for w in words]
        if kind == "toxic":
            for _ in range(rng.randint(2, 4)):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "moron"])
        rows.append((i, " ".join(words), "bad" if kind == "junk" and rng.random() < 0.9 else "src%d" % rng.randrange(3)))
        truth[i] = kind
    return rows, truth


def labels_of(spark, truth, ids):
    return spark.createDataFrame([(i, int(truth[i] != "junk"), int(truth[i] == "toxic"), "x") for i in ids], "doc_id bigint, quality int, toxic int, text string")


def test_held_out_accuracy_and_exchange(spark, docs_of):
    rows, truth = make(1)
    odd = [(900, None), (901, ""), (902, "w1 " * 50000), (None, rows[0][1]), rows[3]]
    docs = docs_of(rows + odd)
    labels = labels_of(spark, truth, range(0, 400)).unionByName(labels_of(spark, truth, [5, 6])).unionByName(
        spark.createDataFrame([(8, None, None, "x"), (None, 1, 0, "x")], "doc_id bigint, quality int, toxic int, text string"))
    got = score_quality(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r.doc_id is not None and 400 <= r.doc_id < 700]
    right = np.mean([r.keep == (truth[r.doc_id] == "good") for r in held])
    assert right > 0.95
    assert all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in got)
    assert sorted(map(str, score_quality(docs, labels).collect())) == sorted(map(str, got))
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)
    model = co_train(docs, labels, confidence=0.9)
    assert any(sum(r.values()) for r in model.rounds)


def test_nothing_to_learn_keeps_everything(spark, docs_of):
    rows, truth = make(2, 20)
    good = [i for i in truth if truth[i] == "good"]
    for labels in (labels_of(spark, truth, []), labels_of(spark, truth, good)):
        assert {(r.score, r.keep) for r in score_quality(docs_of(rows), labels).collect()} == {(1.0, True)}
    assert score_quality(docs_of([]), labels_of(spark, truth, range(20))).count() == 0


def slow_views(model: CoTrained, lang, source, n_chars, text):
    """Both calibrated scores and the combined probability of one document, feature by feature."""
    raw = (text or "").encode()
    words, styles = text_view(raw)
    features = {10_000 + f for w in words for f in word_features(w)} | {100 * s + int((edges < x).sum()) for s, (edges, x) in enumerate(zip(model.edges, styles))}
    z = {"text": sum(model.text_weights[model.text_index[f]][1] for f in features if f in model.text_index) + model.text_weights[-1][1],
         "meta": sum(model.meta_weights[model.meta_index[f]][1] for f in {zlib.crc32(m) for m in meta_view(lang, source, n_chars, raw)}
                     if f in model.meta_index) + model.meta_weights[-1][1]}
    z = [float(np.clip(z[v] * model.platt[v][0] + model.platt[v][1], -30, 30)) for v in ("text", "meta")]
    return *map(sigmoid, z), sigmoid(z[0] * model.combine[0] + z[1] * model.combine[1] + model.combine[2])


def test_scores_against_brute_force(spark, docs_of):
    rows, truth = make(3, 300)
    docs = docs_of(rows + [(None, rows[0][1]), (None, None), (7, "w1 w2"), (500, "")])
    labels = labels_of(spark, truth, range(200))
    model = co_train(docs, labels)
    want = sorted(tuple(np.round((*slow_views(model, r.lang, r.source, r.n_chars, r.text),), 7)) for r in docs.collect())
    got = sorted(tuple(np.round((r.p_text, r.p_meta, r.score), 7)) for r in score_quality(docs, labels).collect())
    assert np.allclose(got, want, atol=1e-6)


def test_pseudo_labels_are_the_surest_of_all_unlabelled(spark, docs_of):
    rows, truth = make(4, 500)
    hot = [(1000 + i, rows[450][1], rows[450][2]) for i in range(60)]  # copies take one place
    docs = docs_of(rows + hot + [(None, rows[i][1], rows[i][2]) for i in range(455, 470)]).repartition(7)
    known = classes_of(labels_of(spark, truth, range(120)))
    model = co_train(docs, labels_of(spark, truth, range(120)), rounds=0)
    pool = unlabelled_features(docs, known, model)
    stored = pool.collect()
    assert len(stored) == len(rows) - 120 + 60 + 15
    taught = {"text": {stored[0].key: 1}, "meta": {stored[1].key: 0}}
    given = surest(pool, model, taught, 5, 0.6)
    texts, metas = ({r.key: r[c] for r in stored} for c in ("text", "meta"))
    for pupil, teacher in (("text", 1), ("meta", 0)):
        p = {k: float(np.round(sigmoid(model.views([np.array(texts[k])], [metas[k]])[teacher][0]), 9)) for k in texts}
        want = {}
        for label in (1, 0):
            sure = sorted(((-(x if label else 1 - x), k) for k, x in p.items() if (x if label else 1 - x) >= 0.6 and k not in taught[pupil]))
            want |= {k: label for _, k in sure[:5]}
        assert given[pupil] == want and len(want) > 4


def test_calibration_fold_holds_both_classes(spark, docs_of):
    rows, truth = make(5, 120)
    few = [i for i in truth if truth[i] == "good"][:40] + [i for i in truth if truth[i] == "junk"][:2]
    docs = docs_of(rows + [(few[0], "other text")] * 50)  # a repeated doc_id is one labelled document
    sample = sample_features(docs, classes_of(labels_of(spark, truth, few)), 1000).collect()
    assert len(sample) == len(few)
    assert sum(r.held for r in sample) == -(-40 // FOLDS) + 1 and {r.good for r in sample if r.held} == {0, 1}
    assert co_train(docs, labels_of(spark, truth, few), rounds=1) is not None
    assert co_train(docs, labels_of(spark, truth, few[:-1])) is None  # one bad document: nothing to calibrate with
    assert len(sample_features(docs, classes_of(labels_of(spark, truth, few)), 10).collect()) == 10


def test_regression_finds_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(400)]
    truth = np.array([[0, 0, 0], [1, -1, 0], [0, 2, -1], [0, 0, 1], [1, 1, -2], [-1, 0, 0], [0.3, -0.2, 0.1]])
    labels = np.array([rng.choice(3, p=p) for p in softmax(scores_of(rows, truth))])
    w = fit_softmax(rows, labels, 6, 3, l2=1.0)

    def loss(w):
        return -np.log(softmax(scores_of(rows, w))[np.arange(400), labels]).sum() + 0.5 * (w[:-1] ** 2).sum()

    for _ in range(50):
        step = rng.normal(size=w.shape) * 0.01
        step[:, 0] = 0
        assert loss(w) <= loss(w + step) + 1e-6
    x = rng.normal(size=(2000, 1))
    y = (rng.random(2000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    assert np.allclose(fit_line(x, y), [2, -1], atol=0.3)
    assert temperature(scores_of(rows, w) * 4, labels) > 2


def test_scoring_holds_few_rows_at_a_time():
    import tracemalloc

    import numpy as np

    from wordmill.llm.logit import scores_of

    rng = np.random.default_rng(3)
    weights = rng.normal(size=(501, 2))
    rows = [rng.choice(500, size=n, replace=False).astype(np.int32) for n in rng.integers(0, 300, 10_000)]
    tracemalloc.start()
    got = scores_of(rows, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    assert np.allclose(got, [weights[r].sum(axis=0) + weights[-1] for r in rows])
    assert scores_of([], weights).shape == (0, 2)


def test_the_words_a_task_remembers_are_bounded(monkeypatch):
    monkeypatch.setattr(quality, "REMEMBERED_WORDS", 50)
    model = CoTrained(np.zeros((len(quality.STYLES), quality.STYLE_BINS - 1)), {zlib.crc32(b"w7") + quality.WORDS_FROM: 3}, np.empty(0), {}, np.empty(0), {}, np.empty(0), [])
    features = quality.features_by(model)
    memo = next(c.cell_contents for c in features.__closure__ if isinstance(c.cell_contents, dict))
    for i in range(0, 400, 4):
        numbers, _ = features(None, None, None, b" ".join(b"w%d" % n for n in range(i, i + 4)))
        assert numbers.tolist() == ([3] if i == 4 else [])
        assert len(memo) <= 50


def resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_a_task_gives_back_what_it_has_freed():
    kept = []

    def run(batches):
        for n in batches:
            texts = [bytes(2000) for _ in range(n)]
            kept.append(texts[-1])  # lies above the others, which the C library then keeps
            yield len(texts)

    before = resident_mb()
    assert list(releasing(run)(iter([50_000]))) == [50_000]
    assert resident_mb() - before < 30

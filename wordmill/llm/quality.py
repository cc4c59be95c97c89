"""Quality classifier by co-training of a text view and a metadata view.

Both views start from the same labelled documents.  In each round both score
every unlabelled document of the corpus, and those that one view is surest of
become pseudo-labels for the other.  The final views are calibrated on labelled
documents that no view has trained on, combined there, and applied to all
documents.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import ALNUM, fresh_name, release_memory, releasing, settle
from wordmill.llm.logit import SCORED_ROWS, fit_line, fit_softmax, scores_of

# Labelled documents that a model is fitted on at most (chosen by hash; their whole texts are used).
MAX_LABELLED = 12_000
# Rounds, pseudo-labels of each class that a view gives the other per round, and the probability these need.
ROUNDS, PSEUDO_LABELS, CONFIDENCE = 3, 300, 0.98
# A feature needs this many documents, and this z of its rate among good and bad ones.
MIN_DOCS, MIN_Z = 4, 2.5
FOLDS = 5  # one of them calibrates
WORDS_FROM = 10_000  # word features are hashes from here on; below are the bins of the style measures
STYLE_BINS = 16
REMEMBERED_WORDS = 50_000  # words whose features a task remembers
L2 = 0.3
KEEP_AT = 0.5
SEED = 7

VIEWS = ("text", "meta")
STYLES = ("upper", "symbols", "doubled", "repeated", "distinct", "word_length", "stopped")
UPPER_AT, SYMBOL_AT = np.zeros(256, bool), np.zeros(256, bool)
UPPER_AT[65:91] = True
SYMBOL_AT[[ord(c) for c in "!#$%&*+/<=>@[]^_`{|}~\\"]] = True


def text_view(raw: bytes) -> tuple[list[bytes], list[float]]:
    """Distinct lower-cased words of a whole text, and its style measures (``STYLES``)."""
    words = raw.translate(ALNUM).split()
    n = len(words)
    distinct = list(dict.fromkeys(words))
    codes = np.frombuffer(raw, np.uint8)
    letters = max(1, len(codes))
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    symbols = SYMBOL_AT[codes]
    doubled = np.count_nonzero(symbols[1:] & (codes[1:] == codes[:-1]))
    return distinct, [np.count_nonzero(UPPER_AT[codes]) / letters, np.count_nonzero(symbols) / letters, doubled / max(1, n), repeated / max(1, n),
                      len(distinct) / max(1.0, n ** 0.8), sum(map(len, words)) / max(1, n), raw.count(b".") / max(1, n)]


def word_features(word: bytes) -> tuple[int, ...]:
    """A word and its beginning, as hashes."""
    return (zlib.crc32(word), zlib.crc32(b"^" + word[:5])) if len(word) > 5 else (zlib.crc32(word),)


def meta_view(lang, source, n_chars, raw: bytes) -> list[bytes]:
    """Metadata: language, source, recorded length, lines and their length, in powers of two."""
    power = lambda x: str(int(max(0, x)).bit_length()).encode()
    lines = raw.count(b"\n") + 1
    text = lambda x: b"" if x is None else str(x).encode()
    length = -1 if n_chars is None or n_chars != n_chars else int(n_chars)
    return [b"lang=" + text(lang), b"source=" + text(source), b"chars=" + (power(length) if length >= 0 else b""), b"lines=" + power(lines),
            b"per_line=" + power(max(length, 0) // lines)]


@dataclass
class CoTrained:
    """A fitted model; everything a scoring task needs, bounded by the features of the sample."""

    edges: np.ndarray  # bin edges of the style measures
    text_index: dict
    text_weights: np.ndarray
    meta_index: dict
    meta_weights: np.ndarray
    platt: dict
    combine: np.ndarray
    rounds: list

    def text_numbers(self, words, styles) -> np.ndarray:
        """Numbers of the known ones of a text's word features (hashes) and of its style bins."""
        bins = (s * 100 + int(np.searchsorted(self.edges[s], x)) for s, x in enumerate(styles))
        return np.array(sorted({self.text_index[f] for f in (*words, *bins) if f in self.text_index}), np.int32)

    def meta_numbers(self, features) -> np.ndarray:
        return np.array(sorted({self.meta_index[f] for f in features if f in self.meta_index}), np.int32)

    def views(self, texts, metas) -> list[np.ndarray]:
        """Calibrated scores of both views, from a text's numbers and the metadata's hashes."""
        rows = {"text": (texts, self.text_weights), "meta": ([self.meta_numbers(m) for m in metas], self.meta_weights)}
        return [calibrated(margin(scores_of(*rows[v])), self.platt[v]) for v in VIEWS]

    def probabilities(self, texts, metas) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        views = self.views(texts, metas)
        return (*map(sigmoid, views), sigmoid(np.column_stack([*views, np.ones(len(views[0]))]) @ self.combine))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def margin(scores: np.ndarray) -> np.ndarray:
    return scores[:, 1] - scores[:, 0]


def calibrated(scores: np.ndarray, line: np.ndarray) -> np.ndarray:
    return np.clip(scores * line[0] + line[1], -30, 30)


def select_features(sample: DataFrame) -> list[int]:
    """Word features whose rate differs between good and bad training documents; counted by Spark."""
    train = sample.where("not held")
    total = train.agg(F.sum("good").alias("n1"), F.count(F.lit(1)).alias("n")).first()
    n1, n0 = float(total.n1 or 1), float(max(1, total.n - (total.n1 or 0)))
    counts = train.select("good", F.explode("words").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("every"), F.sum("good").alias("pro"))
    rate = F.col("every") / (n1 + n0)
    gap = F.abs(F.col("pro") / n1 - (F.col("every") - F.col("pro")) / n0)
    z = gap / F.sqrt(F.greatest(rate * (1 - rate) * (1 / n1 + 1 / n0), F.lit(1e-12)))
    return sorted(r[0] for r in counts.where((F.col("every") >= MIN_DOCS) & (z >= MIN_Z)).select("f").collect())


def classes_of(labels: DataFrame) -> DataFrame:
    """``(doc_id, good)``: a document is good if its quality is 1 and it is not toxic; of several labels the worst counts, null ones are none."""
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    known = labels.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                                      F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 0).otherwise(good).alias("good"))
    return known.where("good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))


def sample_features(docs: DataFrame, known: DataFrame, max_labelled: int) -> DataFrame:
    """Features of a bounded sample of the labelled documents, settled; ``held`` is the fold that calibrates.

    Of rows that share a doc_id one is taken.  Every ``FOLDS``-th document of
    each class, by hash, is held out, so the fold has both classes if the
    labels have.
    """
    chosen = known.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(max_labelled)
    mine = view_columns(docs).join(F.broadcast(chosen), "doc_id")  # bounded by the parameter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chain.from_iterable(map(slices, batches)):
            rows = []
            for i, lang, source, n_chars, raw, g in zip(*(c.to_pylist() for c in b.columns)):
                words, styles = text_view(raw or b"")
                features = sorted({f + WORDS_FROM for w in words for f in word_features(w)})
                rows.append((i, g, features, styles, [zlib.crc32(m) for m in meta_view(lang, source, n_chars, raw or b"")]))
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "good", "words", "styles", "meta"])

    columns = mine.select("doc_id", "lang", "source", "n_chars", "raw", "good")
    found = columns.mapInArrow(releasing(run), "doc_id bigint, good int, words array<bigint>, styles array<double>, meta array<bigint>")
    row = F.struct("good", "words", "styles", "meta")
    found = found.groupBy("doc_id").agg(F.min_by(row, F.xxhash64(row)).alias("r")).select("doc_id", "r.*")
    nth = F.row_number().over(Window.partitionBy("good").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id"), "doc_id"))
    return settle(found.withColumn("held", nth % FOLDS == 1))


def view_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       F.col("n_chars").cast("bigint").alias("n_chars"), F.col("text").cast("string").cast("binary").alias("raw"))


def slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch a few rows at a time: only their texts and features are Python objects at once."""
    return (b.slice(i, SCORED_ROWS) for i in range(0, b.num_rows, SCORED_ROWS))


def features_by(model: CoTrained):
    """A function that gives a row's numbered text features and hashed metadata; it remembers the words it has met."""
    memo = {}

    def features(lang, source, n_chars, raw: bytes) -> tuple[np.ndarray, list[int]]:
        words, styles = text_view(raw)
        hits = set()
        for w in words:
            f = memo.get(w)
            if f is None:
                if len(memo) >= REMEMBERED_WORDS:  # only a memory of look-ups
                    memo.clear()
                f = memo[w] = tuple(x + WORDS_FROM for x in word_features(w) if x + WORDS_FROM in model.text_index)
            if f:
                hits.update(f)
        return model.text_numbers(hits, styles), [zlib.crc32(m) for m in meta_view(lang, source, n_chars, raw)]

    return features


def unlabelled_features(docs: DataFrame, known: DataFrame, model: CoTrained) -> DataFrame:
    """``(key, text, meta)`` of every document without a label, settled; rows of equal features have equal keys.

    Texts are read where they lie: only their features meet the labels.  Rows
    without a doc_id are unlabelled, and the salt deals them to all tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = features_by(shared.value)
        for b in chain.from_iterable(map(slices, batches)):
            rows = [features(a, s, n, raw or b"") for a, s, n, raw in zip(*(c.to_pylist() for c in b.columns[1:]))]
            text, meta = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.list_(pa.int32())), pa.array(meta, pa.list_(pa.int64()))], ["doc_id", "text", "meta"])

    every = view_columns(docs).mapInArrow(releasing(run), "doc_id bigint, text array<int>, meta array<bigint>")
    every = every.withColumn("key", F.xxhash64("text", "meta"))
    every = every.withColumn("salt", F.when(F.col("doc_id").isNull(), F.col("key")).otherwise(0))
    return settle(every.join(known.withColumn("salt", F.lit(0).cast("bigint")), ["doc_id", "salt"], "left_anti").select("key", "text", "meta"))


def surest(pool: DataFrame, model: CoTrained, taught: dict, pseudo_labels: int, confidence: float) -> dict[str, dict[int, int]]:
    """The pseudo-labels of a round, ``{pupil: {key: label}}``, out of all unlabelled documents.

    A task keeps the best ``pseudo_labels`` different documents per pupil and
    label, Spark the best of these, so what moves is bounded per task and
    copies of one document take one place.
    """
    shared = pool.sparkSession.sparkContext.broadcast((model, {v: np.array(sorted(t), np.int64) for v, t in taught.items()}))
    kinds = [(v, label) for v in VIEWS for label in (1, 0)]

    def best(keys: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, first = np.unique(keys, return_index=True)
        at = np.lexsort((keys, -sure[first]))[:pseudo_labels]
        return keys[at], sure[first][at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, done = shared.value
        found = [(np.empty(0, np.int64), np.empty(0)) for _ in kinds]
        for b in chain.from_iterable(map(slices, batches)):
            keys = b.column(0).to_numpy()
            texts, metas = ([x.values.to_numpy() for x in b.column(c)] for c in (1, 2))
            # rounded, so that equal features rank alike in every task
            p = {v: np.round(sigmoid(s), 9) for v, s in zip(VIEWS, model.views(texts, [m.tolist() for m in metas]))}
            for n, (pupil, label) in enumerate(kinds):
                teacher = p["meta" if pupil == "text" else "text"]
                sure = teacher if label else 1 - teacher
                at = np.flatnonzero((sure >= confidence) & ~np.isin(keys, done[pupil]))
                found[n] = best(np.r_[found[n][0], keys[at]], np.r_[found[n][1], sure[at]])
        kind = np.repeat(np.arange(len(kinds)), [len(k) for k, _ in found]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(kind), *(pa.array(np.concatenate(x)) for x in zip(*found))], ["kind", "key", "sure"])

    each = settle(pool.mapInArrow(releasing(run), "kind int, key bigint, sure double").groupBy("kind", "key").agg(F.max("sure").alias("sure")))
    given = {v: {} for v in VIEWS}
    for n, (pupil, label) in enumerate(kinds):
        for row in each.where(F.col("kind") == n).orderBy(F.desc("sure"), "key").limit(pseudo_labels).collect():
            given[pupil][row.key] = label
    return given


def co_train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS,
             pseudo_labels: int = PSEUDO_LABELS, confidence: float = CONFIDENCE) -> CoTrained | None:
    """Fit both views; None if the labels do not hold two good and two bad documents.

    Labelled documents may be sampled (``max_labelled``); unlabelled ones are
    not: all of them are scored in every round, from features that are stored
    once.  Features are counted and selected by Spark, and one task fits the
    model on the sample and the pseudo-labelled documents (at most
    ``4 * pseudo_labels`` a round), so only models come to the driver.
    """
    known = classes_of(labels)
    sample = sample_features(docs, known, max_labelled)
    index = select_features(sample)
    names = set(index)
    chosen = F.pandas_udf(lambda rows: rows.map(lambda w: [f for f in w.tolist() if f in names]), "array<bigint>")
    sample = settle(sample.withColumn("words", chosen("words")))  # the task that fits reads no other words
    taught, lessons, model = {v: {} for v in VIEWS}, None, None
    history, pool = [], None
    for r in range(rounds + 1):
        model = fit_task(sample, lessons, index, taught, model)
        if model is None or r == rounds:
            break
        pool = unlabelled_features(docs, known, model) if pool is None else pool
        given = surest(pool, model, taught, pseudo_labels, confidence)
        history.append({v: len(g) for v, g in given.items()})
        keys = sorted({k for g in given.values() for k in g})
        if not keys:
            break
        for v, g in given.items():
            taught[v] |= g
        wanted = docs.sparkSession.createDataFrame([(k,) for k in keys], "key bigint")
        fresh = pool.join(F.broadcast(wanted), "key").dropDuplicates(["key"])  # bounded by the parameter
        lessons = settle(fresh if lessons is None else lessons.unionByName(fresh).dropDuplicates(["key"]))
    if model is not None:
        model.rounds = history
    return model


def fit_task(sample: DataFrame, lessons: DataFrame | None, index: list[int], taught: dict, before: CoTrained | None) -> CoTrained | None:
    """``fit_views`` in one task on the bounded sample and the pseudo-labelled documents."""
    rows = sample if lessons is None else sample.unionByName(lessons, allowMissingColumns=True)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if parts:
            model = fit_views(pd.concat(parts), index, taught, before)
            parts.clear()
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    found = rows.repartition(1).mapInPandas(releasing(fit), "model binary").first()
    return pickle.loads(found[0]) if found else None


def fit_views(rows: pd.DataFrame, index: list[int], taught: dict, before: CoTrained | None) -> CoTrained | None:
    """Both views, their calibration and combination, from labelled rows and, by key, pseudo-labelled ones; ``before`` is where the fit starts."""
    labelled = rows[rows["good"].notna()].sort_values("doc_id", kind="stable", ignore_index=True)
    good, held = labelled["good"].to_numpy(np.int64), labelled["held"].to_numpy(bool)
    if len(set(good[~held])) < 2 or len(set(good[held])) < 2:
        return None
    if before is None:
        styles = np.array(labelled["styles"].tolist(), np.float64)
        edges = np.quantile(styles, np.linspace(0, 1, STYLE_BINS + 1)[1:-1], axis=0).T
        bins = [s * 100 + b for s in range(len(STYLES)) for b in range(STYLE_BINS)]
        before = CoTrained(edges, {f: i for i, f in enumerate([*bins, *index])}, np.empty(0), {}, np.empty(0), {}, np.empty(0), [])
    pupils = rows[rows["good"].isna()].sort_values("key", ignore_index=True) if "key" in rows else rows.iloc[:0].assign(key=0, text=None)
    numbered = [before.text_numbers(w.tolist(), s) for w, s in zip(labelled["words"], labelled["styles"])]
    model = CoTrained(before.edges, before.text_index, np.empty(0), {}, np.empty(0), {}, np.empty(0), [])
    metas = [m.tolist() for m in labelled["meta"]]
    train = np.flatnonzero(~held).tolist()
    lesson = {v: [(i, taught[v][k]) for i, k in enumerate(pupils["key"].tolist()) if k in taught[v]] for v in VIEWS}
    heard = pupils["meta"].tolist()
    known = {f for i in train for f in metas[i]} | {int(f) for i, _ in lesson["meta"] for f in heard[i]}
    model.meta_index = {f: i for i, f in enumerate(sorted(known))}
    views = {"text": (numbered, pupils["text"].tolist(), len(model.text_index)),
             "meta": ([model.meta_numbers(m) for m in metas], [model.meta_numbers(m.tolist()) for m in heard], len(model.meta_index))}
    weights, scores = {}, {}
    for v, (mine, theirs, size) in views.items():
        start = None
        if len(before.meta_weights):
            start = before.text_weights if v == "text" else np.zeros((size + 1, 2))
            if v == "meta":
                for f, i in before.meta_index.items():
                    if f in model.meta_index:
                        start[model.meta_index[f]] = before.meta_weights[i]
                start[-1] = before.meta_weights[-1]
        labels = np.array([*good[train], *(label for _, label in lesson[v])], np.int64)
        weights[v] = fit_softmax([*(mine[i] for i in train), *(np.asarray(theirs[i], np.int32) for i, _ in lesson[v])], labels, size, 2, l2=L2, start=start)
        scores[v] = margin(scores_of([mine[i] for i in np.flatnonzero(held)], weights[v]))
        model.platt[v] = fit_line(scores[v], good[held])
    model.text_weights, model.meta_weights = weights["text"], weights["meta"]
    model.combine = fit_line(np.column_stack([calibrated(scores[v], model.platt[v]) for v in VIEWS]), good[held], l2=1.0)
    return model


def quality_column(docs: DataFrame, model: CoTrained | None) -> Column:
    """Struct (p_text, p_meta, score) of each row from the columns of ``documents``; 1.0 throughout without a model."""
    if model is None:
        return F.struct(*[F.lit(1.0).alias(c) for c in ("p_text", "p_meta", "score")])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        features = features_by(shared.value)
        for columns in parts:  # Arrow, so that only the texts of a slice are Python objects
            found = [np.empty((3, 0))]
            for i in range(0, len(columns[0]), SCORED_ROWS):
                rows = [features(lang, source, n_chars, raw or b"") for lang, source, n_chars, raw in zip(*(c.slice(i, SCORED_ROWS).to_pylist() for c in columns))]
                found.append(shared.value.probabilities(*zip(*rows)))
            yield pa.StructArray.from_arrays([pa.array(p) for p in np.concatenate(found, axis=1)], ["p_text", "p_meta", "score"])
        del features
        release_memory()

    score = F.arrow_udf(run, "p_text double, p_meta double, score double")
    return score(F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("bigint"), F.col("text").cast("string").cast("binary"))


def score_quality(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT, **options) -> DataFrame:
    """``(doc_id, p_text, p_meta, score, keep)`` of every row: calibrated probabilities of being good, per view and combined.

    Null texts are empty and null metadata is a value of its own.  Repeated
    rows are scored each.  If the table is empty, or the labels hold fewer than
    two of its good or of its bad documents (one to train on, one to calibrate
    with), nothing can be learned and everything is kept with 1.0.
    """
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), quality_column(docs, co_train(docs, labels, **options)).alias("q"))
    return scored.select("doc_id", "q.p_text", "q.p_meta", "q.score", (F.col("q.score") >= keep_at).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT, **options) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, in one pass without a shuffle."""
    name = fresh_name(docs, "quality_score")
    scored = docs.withColumn(name, quality_column(docs, co_train(docs, labels, **options)))
    return scored.where(F.col(name + ".score") >= keep_at).drop(name)

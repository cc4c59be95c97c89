"""Decontamination against brute force over every window and document position."""

import hashlib
import random

import pytest

from wordmill.llm.decontaminate import contamination, drop_contaminated
from wordmill.llm.queries import LLM_QUERIES


def slow_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c >= "\x80" or "0" <= c <= "9" or "a" <= c <= "z":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def slow(docs, items, window=13):
    out = []
    for i, text in docs:
        words = slow_words(text)
        hit, with_hits = set(), set()
        for item, t in items:
            w = slow_words(t)
            size = min(window, len(w))
            for s in range(len(w) - size + 1 if w else 0):
                for p in range(len(words) - size + 1):
                    if words[p:p + size] == w[s:s + size]:
                        hit |= set(range(p, p + size))
                        with_hits.add(item)
        ids = sorted(str(x) for x in with_hits if x is not None)
        out.append((str(i), len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out)


def make(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "C", "dé", "E1", "x"] + ["w%d" % i for i in range(30)]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", ",", "."]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for i in range(14)] + [(50, None), (51, ""), (52, "..."), (None, text(20)), (3, text(15))]
    docs = []
    for i in range(60):
        parts = [text(rng.choice([0, 1, 10, 80]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            w = slow_words(rng.choice(items)[1])
            s = rng.randrange(len(w) + 1)
            parts += [" ".join(w[s:s + rng.choice([5, 12, 13, 20, 60])]).upper(), text(rng.choice([0, 5, 40]))]
        docs.append((i, " ".join(parts)))
    return docs + [(100, None), (101, ""), (7, docs[7][1]), (None, items[12][1])], items


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"segment_words": 100}), (3, {"block_bytes": 400}), (4, {"block_bytes": 1, "segment_words": 30})])
def test_equals_brute_force(spark, docs_of, tmp_path, seed, options):
    docs, items = make(seed)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    hits = contamination(docs_of(docs), bench, **options)
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, len({p.item_id for p in r.phrases} - {None})) for r in hits.collect())
    assert got == sorted(x[:4] for x in slow(docs, items))


def test_query_and_phrases(spark, docs_of, tmp_path):
    docs, items = make(9)
    docs_of(docs).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = LLM_QUERIES["op3_benchmark_decontamination"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == slow(docs, items)


def test_proximity_and_drop(spark, docs_of):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    loose = passage.replace("gamma", "gamma inserted").replace("theta", "other")
    docs = docs_of([(1, passage), (2, loose), (3, "clean words only here"), (4, None), (5, "z " * 400 + passage)])
    hits = {r.doc_id: r for r in contamination(docs, bench).collect()}
    assert [tuple(p) for p in hits[1].phrases] == [(1, 0, 15)]
    assert hits[2].n_hit == 0 and list(hits[2].near_items) == [1] and not hits[3].near_items
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).collect()) == [2, 3, 4, 5]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r.n_hit) for r in contamination(docs_of([(1, "a b")]), none).collect()] == [(2, 0)]
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert contamination(docs_of([]), some).count() == 0
    assert [r.n_hit for r in contamination(docs_of([(1, None)]), some).collect()] == [0]


def slow_near(docs, items, window=13, slop=3):
    out = []
    for i, text in docs:
        words, near = slow_words(text), set()
        for item, t in items:
            w = slow_words(t)
            size = min(window, len(w))
            for s in range(len(w) - size + 1 if w else 0):
                for p in range(-size - slop, len(words) + slop):
                    held = sum(w[s + k] in words[max(0, p + k - slop):max(0, p + k + slop + 1)] for k in range(size))
                    if 4 * held >= 3 * size:
                        near.add(item)
        out.append((str(i), sorted(str(x) for x in near)))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"segment_words": 100, "block_bytes": 200}])
def test_near_items_equal_brute_force(spark, docs_of, options):
    rng = random.Random(5)
    common = ["w%d" % i for i in range(40)]
    items = [(i, " ".join(rng.choice([rng.choice(common), f"u{i}x{k}"]) for k in range(rng.choice([3, 9, 16, 30])))) for i in range(12)]
    docs = []
    for i in range(40):
        w = slow_words(items[i % 12][1])
        w = w[rng.randrange(4):]
        for k in rng.sample(range(len(w)), min(len(w), rng.randrange(5))):
            w[k] = rng.choice(["changed", w[k] + " inserted", ""])
        docs.append((i, " ".join([*rng.choices(common, k=rng.randrange(20)), *w, *rng.choices(common, k=rng.randrange(20))])))
    hits = contamination(docs_of(docs), spark.createDataFrame(items, "item_id bigint, text string"), **options)
    assert sorted((str(r.doc_id), sorted(str(x) for x in r.near_items)) for r in hits.collect()) == slow_near(docs, items)


def test_near_copy_between_strides_and_without_the_rarest_words(spark, docs_of, tmp_path):
    words = ["word%d" % i for i in range(18)]
    spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    late = [*words[5:9], "other", *words[10:18]]
    docs = [(k, " ".join(["x", *(["other"] * (k > 0)), *["y" if j in range(k, k + 3) else w for j, w in enumerate(words[:13])], "z"])) for k in range(11)]
    docs += [(50, "x x " + " ".join(late) + " y"), (51, " ".join(words[:9]))]
    docs_of(docs).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_near, r.near_items) for r in LLM_QUERIES["op3_proximity_matches"](spark, str(tmp_path)).collect()}
    assert got.pop(51) == (0, "") and set(got.values()) == {(1, "1")}

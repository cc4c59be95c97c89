"""The pipeline on planted cases, stage by stage against brute force."""

import random

import corpus_pipeline
from tests.llm.test_decontaminate import slow as slow_contamination
from tests.llm.test_mixing import slow_targets
from tests.llm.test_secrets import slow_spans
from tests.llm.test_simhash import slow_classes, slow_fingerprint


def make(spark, folder):
    rng = random.Random(4)
    vocab = ["w%d" % i for i in range(400)]
    passage = " ".join("item%d" % i for i in range(40))
    rows, bad = [], set()
    for i in range(400):
        words = rng.choices(vocab, k=rng.randint(30, 120))
        if i % 4 == 1:
            bad.add(i)
            words = [w.upper() + "!!" for w in words]
        text = " ".join(words)
        if i % 40 == 2:
            text += " " + passage
        if i % 40 == 6:
            text += " password=abcdef%08d0123" % i
        rows.append((i, text, "en", rng.choice(["hot", "hot", "hot", "b", None]), len(text)))
    rows += [(1000 + i, r[1] + (" extra" if i % 2 else ""), *r[2:]) for i, r in enumerate(rows[:40]) if r[0] not in bad]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i not in bad), 0) for i in range(400)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, bad, [(1, passage)]


def test_stages_equal_brute_force(spark, tmp_path):
    rows, bad, items = make(spark, tmp_path)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out_{name}")
        docs = spark.read.parquet(f"{tmp_path}/out_{name}")
        seen.append({} if name == "source_mix" else {r.doc_id: r for r in docs.collect()})
        if name != "source_mix":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == len(seen[-1])
    quality, near, clean, masked = seen[:4]
    want = {r[0] for r in rows} - bad
    assert len(set(quality) ^ want) <= 4
    fps = [slow_fingerprint(r.text) for r in quality.values()]
    ids = list(quality)
    assert set(near) == {min(ids[m] for m in c) for c in slow_classes(fps, 2)}
    assert set(clean) == {int(i) for i, *_, c in slow_contamination([(r.doc_id, r.text) for r in near.values()], items) if not c}
    assert set(masked) == set(clean)
    for i, r in masked.items():
        spans = slow_spans(clean[i].text)
        assert (r.text == clean[i].text and r.n_chars == clean[i].n_chars) if not spans else (
            "[REDACTED]" in r.text and not slow_spans(r.text) and r.n_chars == len(r.text))
    sizes, taken = {}, {}
    for r in masked.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in docs.collect():
        assert len(r.text.split()) == r.taken and set(r.text.split()) <= set(masked[r.doc_id].text.split())
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t) for s, t in slow_targets(sizes).items()}
    once = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, once.collect())) == sorted(map(str, docs.collect()))

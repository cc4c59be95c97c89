"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is executed in full through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    ("profile_top_tokens", "b5_token_distribution_by_lang"),
    ("word_freqs", "d2_word_freqs"),
    ("bpe_train", "d8_train_bpe"),
    ("bpe_encode_documents", "d12_encode_documents"),
    ("tokenizer_evaluation", "e12_evaluate_tokenizer"),
    ("skipgram_cooccurrence", "f4_cooccurrence"),
    ("nearest_neighbours", "f10_most_similar"),
    ("analogy", "f13_analogy_query"),
    ("ngram_lm_metrics", "g9_lm_metrics"),
    ("bleu", "g10_bleu"),
    ("greedy_generation", "h1_greedy_generate"),
]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from wordmill.session import build_session
    from wordmill.plans.queries import QUERIES

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="wm-bench-ckpt-")})
    # warm the JVM (code paths, class loading) on a tiny read
    spark.read.parquet(os.path.join(sf, "region.parquet")).count()
    times = {}
    for label, name in HEADLINE:
        if name not in QUERIES:
            continue
        t0 = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[label] = round(time.time() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf}))


if __name__ == "__main__":
    main()

"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from wordmill.llm.common import table
from wordmill.llm.decontaminate import contaminated, contamination
from wordmill.llm.embed_dedup import embedding_groups
from wordmill.llm.infill import fill_in_middle, restored
from wordmill.llm.licenses import scan_licences
from wordmill.llm.mixing import mix_sources
from wordmill.llm.packing import pack_documents
from wordmill.llm.quality import score_quality
from wordmill.llm.runs import find_runs, longest_run
from wordmill.llm.secrets import scan_secrets, span_list
from wordmill.llm.simhash import simhash_groups
from wordmill.llm.substring import dedup_substrings
from wordmill.llm.urls import filter_urls
from wordmill.llm.warc import warc_round_trip

LLM_QUERIES = {}
LLM_ORACLE = {}


def query(name: str, sql: str | None = None):
    def add(f):
        LLM_QUERIES[name] = f
        if sql:
            LLM_ORACLE[name] = sql
        return f
    return add


@query("op1_secret_scan")
def op1(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", of_kind("assign"), of_kind("access"), of_kind("hex"),
                        F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"),
                        F.size(F.filter("spans", lambda s: s["kind"] == "random")).cast("bigint").alias("n_random"))


# The rules that the query judges by.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@query("op2_url_filter")
def op2(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op3_benchmark_decontamination", f"""
WITH item AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS size FROM item WHERE len(w) > 0),
wanted AS (SELECT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
doc AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
place AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size),
met AS (SELECT DISTINCT p.doc_id, p.i, p.size, wanted.item_id FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g FROM place) p
        JOIN wanted ON wanted.size = p.size AND wanted.g = p.g),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op3(spark, sf_dir):
    hits = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    items = F.array_compact(F.array_distinct(F.transform("phrases", lambda p: p["item_id"])))
    return hits.select("doc_id", "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
                       F.sha2(F.concat_ws(",", F.array_sort(F.transform(items, lambda i: i.cast("string")))), 256).alias("items_sha256"),
                       contaminated(hits).alias("contaminated"))


@query("op3_proximity_matches")
def op3_near(spark, sf_dir):
    hits = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    near = F.array_sort(F.array_distinct(F.array_compact("near_items")))
    return hits.select("doc_id", F.size(near).cast("bigint").alias("n_near"), F.array_join(near.cast("array<string>"), ",").alias("near_items"))


@query("op4_mix_sources")
def op4(spark, sf_dir):
    mix = mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_substring_dedup", """
WITH doc AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)),
seen AS (SELECT g, min(doc_id) AS first_id FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN seen USING (g) WHERE doc_id > first_id),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM doc)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON g.doc_id = doc.doc_id
LEFT JOIN (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.k) AS kept FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.k = word.k
           WHERE gone.k IS NULL GROUP BY word.doc_id) t ON t.doc_id = doc.doc_id
""")
def op5(spark, sf_dir):
    cut = dedup_substrings(table(spark, sf_dir, "documents"), window=13)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_simhash_near_dedup")
def op6(spark, sf_dir):
    groups = simhash_groups(table(spark, sf_dir, "documents"), k=3, radius=2, seed=42)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_licence_scan")
def op7(spark, sf_dir):
    found = scan_licences(table(spark, sf_dir, "documents"))
    families = F.transform("findings", lambda f: f["family"])
    return found.select("doc_id", "n_paragraphs", F.size("findings").cast("bigint").alias("n_licence"),
                        F.concat_ws(",", F.array_sort(F.array_distinct(families))).alias("families"),
                        F.concat_ws(",", F.transform("findings", lambda f: F.concat_ws(":", f["family"], f["paragraph"]))).alias("findings"))


@query("op8_quality_classifier")
def op8(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_warc_round_trip", """
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id
      FROM (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages))
""")
def op9(spark, sf_dir):
    read = warc_round_trip(table(spark, sf_dir, "pages"), least_bytes=100)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_embedding_near_dedup", """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
""")
def op10(spark, sf_dir):
    return embedding_groups(table(spark, sf_dir, "embeddings"), cosine=0.9)


def with_planted_runs(docs):
    """The contract's texts: in a tenth of the documents, by the id's CRC, the words from one place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != ""))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w")).withColumn("n", F.size("w"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    found = find_runs(with_planted_runs(table(spark, sf_dir, "documents")), least=12)
    found = found.withColumn("best", longest_run("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_fill_in_middle", """
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
units AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
                 CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM drawn),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units),
cut AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM cut
""")
def op12(spark, sf_dir):
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


@query("op13_best_fit_packing")
def op13(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

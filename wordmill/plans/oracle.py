"""DuckDB oracle SQL for the registered queries (views named like the tables).

Whitespace is ``\\s+`` here: the driver's text tables hold only space and
newline (see FIXTURES.md), so RE2's ASCII class agrees with the engine's
Python-compatible class on them.
"""

from __future__ import annotations

WORDS = "list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')"

ORACLE: dict[str, str] = {}

ORACLE["b5_token_distribution_by_lang"] = f"""
WITH t AS (SELECT lang, unnest({WORDS.format(c='text')}) AS token FROM documents),
c AS (SELECT lang, token, count(*) AS n FROM t GROUP BY lang, token),
s AS (SELECT lang, count(*) AS unique_tokens, CAST(sum(n) AS BIGINT) AS total_tokens FROM c GROUP BY lang),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rk FROM c)
SELECT r.lang, CAST(rk AS BIGINT) AS rank, token, n, unique_tokens, total_tokens
FROM r JOIN s ON r.lang = s.lang WHERE rk <= 20
"""


# ------------------------------------------------------------------ BPE (D)
# Segmented words are wrapped like the engine's: chr(1) around every symbol.

def _words_cte(source: str = "SELECT text FROM documents", col: str = "text") -> str:
    return f"""words AS (
  SELECT w AS word, CAST(count(*) AS BIGINT) AS freq
  FROM (SELECT unnest({WORDS.format(c=col)}) AS w FROM ({source}))
  GROUP BY w)"""


INIT_SYM = "chr(1) || array_to_string(string_split({w}, ''), chr(1) || chr(1)) || chr(1) || chr(1) || '</w>' || chr(1)"
SYMS = "list_filter(string_split({s}, chr(1)), lambda x: x <> '')"


def vocab_ctes(vocab_size: int | str, specials=("<UNK>", "<PAD>", "<BOS>", "<EOS>", "<CODE>", "<DOC>")) -> str:
    """CTEs chars/basev/xchars/nvocab/train/mvocab/vocab; needs a ``words`` CTE."""
    spec = ", ".join(f"('{t}', {97 + i})" for i, t in enumerate(list(specials) + ["</w>"]))
    nb = 97 + len(specials) + 1
    return f"""chars AS (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM words),
basev AS (
  SELECT t AS token, CAST(row_number() OVER (ORDER BY cp) - 1 AS INTEGER) AS id
  FROM (SELECT chr(9) AS t, 9 AS cp UNION ALL SELECT chr(10), 10
        UNION ALL SELECT chr(CAST(i AS INTEGER)), i FROM range(32, 127) r(i))
  UNION ALL SELECT * FROM (VALUES {spec}) v(token, id)),
xchars AS (
  SELECT c AS token, CAST({nb} - 1 + row_number() OVER (ORDER BY c) AS INTEGER) AS id
  FROM chars WHERE c NOT IN (SELECT token FROM basev)),
nvocab AS (SELECT {nb} + (SELECT count(*) FROM xchars) AS n),
init AS (SELECT list({{'f': freq, 's': {INIT_SYM.format(w='word')}}}) AS ws FROM words),
r(step, ws, lhs, rhs, cnt) AS (
  SELECT 0, ws, NULL::VARCHAR, NULL::VARCHAR, NULL::BIGINT FROM init
  UNION ALL
  SELECT step + 1,
    list_transform(ws, lambda x: {{'f': x.f, 's': replace(x.s, chr(1) || b.lhs || chr(1) || chr(1) || b.rhs || chr(1), chr(1) || b.lhs || b.rhs || chr(1))}}),
    b.lhs, b.rhs, b.cnt
  FROM r, LATERAL (
    SELECT lhs, rhs, CAST(sum(f) AS BIGINT) AS cnt FROM (
      SELECT f, sy[i] AS lhs, sy[i + 1] AS rhs FROM (
        SELECT f, sy, unnest(range(1, len(sy))) AS i FROM (
          SELECT u.f AS f, {SYMS.format(s='u.s')} AS sy FROM (SELECT unnest(r.ws) AS u)))
    ) GROUP BY lhs, rhs ORDER BY cnt DESC, lhs, rhs LIMIT 1) b
  WHERE r.step < (SELECT {vocab_size} - n FROM nvocab)),
train AS (SELECT CAST(step AS BIGINT) AS rank, lhs, rhs, cnt AS pair_count FROM r WHERE step > 0),
mvocab AS (
  SELECT token, CAST((SELECT n FROM nvocab) - 1 + row_number() OVER (ORDER BY rk) AS INTEGER) AS id
  FROM (SELECT lhs || rhs AS token, min(rank) AS rk FROM train GROUP BY lhs || rhs)
  WHERE token NOT IN (SELECT token FROM basev UNION ALL SELECT token FROM xchars)),
vocab AS (SELECT * FROM basev UNION ALL SELECT * FROM xchars UNION ALL SELECT * FROM mvocab)"""


def seg_ctes(word_source: str = "SELECT word FROM words", sfx: str = "") -> str:
    """CTE ``segid{sfx}(word, ids, toks)``: every merge of ``train`` applied in rank order."""
    return f"""wl{sfx} AS (SELECT list({{'w': word, 's': {INIT_SYM.format(w='word')}}}) AS ws FROM ({word_source})),
e{sfx}(step, ws) AS (
  SELECT 0, ws FROM wl{sfx}
  UNION ALL
  SELECT e{sfx}.step + 1, list_transform(e{sfx}.ws, lambda x: {{'w': x.w, 's': replace(x.s, chr(1) || m.lhs || chr(1) || chr(1) || m.rhs || chr(1), chr(1) || m.lhs || m.rhs || chr(1))}})
  FROM e{sfx} JOIN train m ON m.rank = e{sfx}.step + 1),
segu{sfx} AS (SELECT unnest(ws) AS u FROM e{sfx} WHERE step = (SELECT coalesce(max(rank), 0) FROM train)),
seg{sfx} AS (SELECT u.w AS word, {SYMS.format(s='u.s')} AS toks FROM segu{sfx}),
segid{sfx} AS (
  SELECT word, list(coalesce(v.id, 97) ORDER BY k) AS ids, list(t ORDER BY k) AS toks
  FROM (SELECT word, unnest(toks) AS t, generate_subscripts(toks, 1) AS k FROM seg{sfx}) x
  LEFT JOIN vocab v ON v.token = x.t GROUP BY word)"""


def docs_ids_cte(source: str = "SELECT doc_id, text FROM documents", key: str = "doc_id", col: str = "text") -> str:
    """CTE ``dids(key, ids)``: per-row concatenation of word ids in word order (needs ``segid``)."""
    return f"""occ AS (SELECT {key} AS k, unnest({WORDS.format(c=col)}) AS word,
                 generate_subscripts({WORDS.format(c=col)}, 1) AS pos FROM ({source})),
dids0 AS (SELECT o.k, flatten(list(s.ids ORDER BY o.pos)) AS ids FROM occ o JOIN segid s ON s.word = o.word GROUP BY o.k),
dids AS (SELECT d.{key} AS k, coalesce(x.ids, []::INTEGER[]) AS ids, d.{col} AS text FROM ({source}) d LEFT JOIN dids0 x ON x.k = d.{key})"""


BPE_VOCAB = 150


def _bpe(body: str, vocab_size: int = BPE_VOCAB, with_seg=False, with_docs=False, src=None) -> str:
    parts = [_words_cte(), vocab_ctes(vocab_size)]
    if with_seg:
        parts.append(seg_ctes())
    if with_docs:
        parts.append(docs_ids_cte(*(src or ())))
    return "WITH RECURSIVE " + ",\n".join(parts) + ("" if body.lstrip().startswith(",") else "\n") + body


ORACLE["d2_word_freqs"] = "WITH " + _words_cte() + " SELECT word, freq FROM words"
ORACLE["d3_init_symbols"] = ("WITH " + _words_cte() + f""" SELECT word, freq,
  array_to_string({SYMS.format(s=INIT_SYM.format(w='word'))}, ' ') AS symbols FROM words""")
ORACLE["d4_char_vocab"] = _bpe("SELECT token, id FROM xchars")
ORACLE["d5_pair_counts"] = ("WITH " + _words_cte() + f""",
s AS (SELECT freq, {SYMS.format(s=INIT_SYM.format(w='word'))} AS sy FROM words),
p AS (SELECT freq, sy[i] AS lhs, sy[i + 1] AS rhs FROM (SELECT freq, sy, unnest(range(1, len(sy))) AS i FROM s))
SELECT lhs, rhs, CAST(sum(freq) AS BIGINT) AS n FROM p GROUP BY lhs, rhs""")
ORACLE["d6_best_pairs"] = ORACLE["d5_pair_counts"].replace(
    "SELECT lhs, rhs, CAST(sum(freq) AS BIGINT) AS n FROM p GROUP BY lhs, rhs",
    "SELECT CAST(row_number() OVER (ORDER BY n DESC, lhs, rhs) AS BIGINT) AS rank, lhs, rhs, n FROM "
    "(SELECT lhs, rhs, CAST(sum(freq) AS BIGINT) AS n FROM p GROUP BY lhs, rhs) ORDER BY n DESC, lhs, rhs LIMIT 10")
ORACLE["d7_merge_best_pair"] = ("WITH " + _words_cte() + f""",
s AS MATERIALIZED (SELECT word, freq, {INIT_SYM.format(w='word')} AS raw FROM words),
p AS (SELECT freq, sy[i] AS lhs, sy[i + 1] AS rhs FROM (SELECT freq, sy, unnest(range(1, len(sy))) AS i
      FROM (SELECT freq, {SYMS.format(s='raw')} AS sy FROM s))),
b AS MATERIALIZED (SELECT chr(1) || lhs || chr(1) || chr(1) || rhs || chr(1) AS apart, chr(1) || lhs || rhs || chr(1) AS joined
      FROM p GROUP BY lhs, rhs ORDER BY sum(freq) DESC, lhs, rhs LIMIT 1),
m AS MATERIALIZED (SELECT word, freq, CASE WHEN contains(raw, apart) THEN replace(raw, apart, joined) ELSE raw END AS done FROM s, b)
SELECT word, freq, array_to_string({SYMS.format(s='done')}, ' ') AS symbols FROM m""")
ORACLE["d8_train_bpe"] = _bpe("SELECT rank, lhs, rhs, pair_count FROM train")
ORACLE["d8_vocab"] = _bpe("SELECT token, id FROM vocab")
ORACLE["d11_encode_words"] = _bpe("SELECT word, array_to_string(toks, ' ') AS tokens, "
                                  "array_to_string(ids, ' ') AS ids FROM segid", with_seg=True)
ORACLE["d12_encode_documents"] = _bpe("SELECT k AS doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, "
                                      "array_to_string(ids, ' ') AS ids FROM dids", with_seg=True, with_docs=True)


# ------------------------------------------------------------------ tokenizer evaluation (E)

def _e(body: str, seg=True, docs=True) -> str:
    return _bpe(body, with_seg=seg, with_docs=docs)


DECODED = """dex AS (SELECT k, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM dids),
dec0 AS (SELECT k, string_agg(coalesce(v.token, '<UNK>'), '' ORDER BY i) AS raw FROM dex LEFT JOIN vocab v ON v.id = dex.id GROUP BY k),
dec AS (SELECT d.k, d.text, trim(regexp_replace(replace(coalesce(x.raw, ''), '</w>', ' '), '\\s+', ' ', 'g')) AS decoded
        FROM dids d LEFT JOIN dec0 x ON x.k = d.k)"""

E_SQL = {
    "vocabulary_overlap": f"""gw AS (SELECT DISTINCT unnest({WORDS.format(c='text')}) AS token FROM documents),
fo AS (SELECT g.token AS a, v.token AS b FROM gw g FULL OUTER JOIN (SELECT DISTINCT token FROM vocab) v ON g.token = v.token),
res AS (SELECT CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)) / count(*) ELSE 0.0 END AS jaccard_similarity,
  count(b) AS bpe_vocab_size, count(a) AS ground_truth_vocab_size,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS intersection_size, count(*) AS union_size FROM fo)""",
    "compression_ratio": """tot AS (SELECT CAST(sum(length(text)) AS BIGINT) AS c, CAST(sum(len(ids)) AS BIGINT) AS t FROM dids),
res AS (SELECT CASE WHEN t > 0 THEN c / t ELSE 1.0 END AS compression_ratio, c AS total_characters, t AS total_tokens,
  CASE WHEN t > 0 THEN c / t ELSE 1.0 END AS avg_chars_per_token FROM tot)""",
    "boundary_accuracy": DECODED + f""",
ws AS (SELECT list_distinct({WORDS.format(c='text')}) AS a, list_distinct({WORDS.format(c='decoded')}) AS b FROM dec),
tot AS (SELECT CAST(sum(len(list_intersect(a, b))) AS BIGINT) AS i, CAST(sum(len(list_distinct(list_concat(a, b)))) AS BIGINT) AS u FROM ws),
res AS (SELECT CASE WHEN u > 0 THEN i / u ELSE 0.0 END AS boundary_accuracy, i AS correct_boundaries, u AS total_boundaries FROM tot)""",
    "consistency": """res AS (SELECT 1.0 AS consistency_score, CAST(count(*) AS DOUBLE) AS consistent_texts, count(*) AS total_texts FROM documents)""",
    "oov_rate": """tot AS (SELECT CAST(sum(len(list_filter(ids, lambda x: x = 97))) AS BIGINT) AS o, CAST(sum(len(ids)) AS BIGINT) AS t FROM dids),
res AS (SELECT CASE WHEN t > 0 THEN o / t ELSE 0.0 END AS oov_rate, o AS oov_tokens, t AS total_tokens,
  CASE WHEN t > 0 THEN o / t ELSE 0.0 END * 100 AS oov_percentage FROM tot)""",
    "perplexity": """tot AS (SELECT CAST(sum(len(ids)) AS BIGINT) AS t, (SELECT count(*) FROM vocab) AS v FROM dids),
res AS (SELECT CASE WHEN t > 0 THEN exp(-(t * ln(1.0 / v)) / t) ELSE 'inf'::DOUBLE END AS perplexity, t AS total_tokens,
  CASE WHEN t > 0 THEN (t * ln(1.0 / v)) / t ELSE 0.0 END AS avg_log_prob FROM tot)""",
    "token_distribution": """ic AS (SELECT id, count(*) AS n FROM (SELECT unnest(ids) AS id FROM dids) GROUP BY id),
tot AS (SELECT sum(n) AS t FROM ic),
res AS (SELECT (SELECT count(*) FROM ic) AS unique_tokens, (SELECT CAST(t AS BIGINT) FROM tot) AS total_tokens,
  (SELECT avg(len(ids)) FROM dids) AS avg_text_length, (SELECT stddev_pop(len(ids)) FROM dids) AS std_text_length,
  (SELECT coalesce(-sum((n / t) * log2(n / t)), 0.0) FROM ic, tot) AS entropy)""",
    "semantic_coherence": f"""pc AS (SELECT doc_id AS k, unnest(string_split(text, '.')) AS sentence, generate_subscripts(string_split(text, '.'), 1) AS sidx FROM documents),
pw AS (SELECT k, sidx, unnest({WORDS.format(c='sentence')}) AS word, generate_subscripts({WORDS.format(c='sentence')}, 1) AS pos FROM pc),
{seg_ctes("SELECT DISTINCT word FROM pw", "_p")},
pid AS (SELECT p.k, p.sidx, list_distinct(flatten(list(s.ids ORDER BY p.pos))) AS ids FROM pw p JOIN segid_p s ON s.word = p.word GROUP BY p.k, p.sidx),
pall AS (SELECT c.k, c.sidx, coalesce(p.ids, []::INTEGER[]) AS ids FROM pc c LEFT JOIN pid p ON p.k = c.k AND p.sidx = c.sidx),
pr AS (SELECT k, ids AS a, lead(ids) OVER (PARTITION BY k ORDER BY sidx) AS b FROM pall),
pt AS (SELECT k, avg(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))) AS c FROM pr
       WHERE b IS NOT NULL AND len(a) > 0 AND len(b) > 0 GROUP BY k),
res AS (SELECT coalesce(avg(c), 0.0) AS semantic_coherence, coalesce(stddev_pop(c), 0.0) AS coherence_std, count(*) AS num_evaluated_texts FROM pt)""",
}


def _shared_ctes() -> list[str]:
    return [_words_cte(), vocab_ctes(BPE_VOCAB), seg_ctes(), docs_ids_cte()]


def _e_scalar(group: str, cols: list[str], round_cols: list[str]) -> str:
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in round_cols else c for c in cols)
    return "WITH RECURSIVE " + ",\n".join(_shared_ctes() + [E_SQL[group]]) + f"\nSELECT {sel} FROM res"


ORACLE["e1_vocab_overlap"] = _e_scalar("vocabulary_overlap", ["jaccard_similarity", "bpe_vocab_size", "ground_truth_vocab_size", "intersection_size", "union_size"], ["jaccard_similarity"])
ORACLE["e2_compression_ratio"] = _e_scalar("compression_ratio", ["compression_ratio", "total_characters", "total_tokens", "avg_chars_per_token"], ["compression_ratio", "avg_chars_per_token"])
ORACLE["e3_boundary_accuracy"] = _e_scalar("boundary_accuracy", ["boundary_accuracy", "correct_boundaries", "total_boundaries"], ["boundary_accuracy"])
ORACLE["e4_encoding_consistency"] = _e_scalar("consistency", ["consistency_score", "consistent_texts", "total_texts"], ["consistency_score", "consistent_texts"])
ORACLE["e5_oov_rate"] = _e_scalar("oov_rate", ["oov_rate", "oov_tokens", "total_tokens", "oov_percentage"], ["oov_rate", "oov_percentage"])
ORACLE["e6_uniform_perplexity"] = _e_scalar("perplexity", ["perplexity", "total_tokens", "avg_log_prob"], ["perplexity", "avg_log_prob"])
ORACLE["e7_token_id_distribution"] = ("WITH RECURSIVE " + ",\n".join(_shared_ctes() + [E_SQL["token_distribution"]]) + """,
top AS (SELECT string_agg(CAST(id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, id) AS top_ids FROM (SELECT id, n FROM ic ORDER BY n DESC, id LIMIT 20))
SELECT unique_tokens, total_tokens, round(avg_text_length, 6) AS avg_text_length, round(std_text_length, 6) AS std_text_length,
  round(entropy, 6) AS entropy, top_ids FROM res, top""")
ORACLE["e8_token_entropy"] = _e_scalar("token_distribution", ["entropy"], ["entropy"])
ORACLE["e9_semantic_coherence"] = _e_scalar("semantic_coherence", ["semantic_coherence", "coherence_std", "num_evaluated_texts"], ["semantic_coherence", "coherence_std"])

ORACLE["e10_token_length_histogram"] = _e(""", lens AS (SELECT CAST(len(ids) AS DOUBLE) AS n FROM dids),
mm AS (SELECT CASE WHEN min(n) = max(n) THEN min(n) - 0.5 ELSE min(n) END AS lo,
              CASE WHEN min(n) = max(n) THEN max(n) + 0.5 ELSE max(n) END AS hi FROM lens),
bc AS (SELECT CAST(least(floor((n - lo) / ((hi - lo) / 50)), 49) AS BIGINT) AS bin, count(*) AS n FROM lens, mm GROUP BY 1)
SELECT CAST(r.i AS BIGINT) AS bin, round(lo + r.i * ((hi - lo) / 50), 6) AS lower, round(lo + (r.i + 1) * ((hi - lo) / 50), 6) AS upper,
       CAST(coalesce(bc.n, 0) AS BIGINT) AS n
FROM range(50) r(i) CROSS JOIN mm LEFT JOIN bc ON bc.bin = r.i""")

ORACLE["e11_top_tokens"] = _e(""", ic AS (SELECT id, count(*) AS n FROM (SELECT unnest(ids) AS id FROM dids) GROUP BY id),
top AS (SELECT id, n, row_number() OVER (ORDER BY n DESC, id) AS rk FROM ic)
SELECT CAST(rk AS BIGINT) AS rank, top.id, v.token, top.n FROM top LEFT JOIN vocab v ON v.id = top.id WHERE rk <= 20""")


def _e_long(groups) -> str:
    """Long ``(metric_group, metric, value)`` rows; each group's helper CTEs live in a nested scope."""
    parts = [f"""SELECT * FROM (WITH RECURSIVE {E_SQL[g]}
  SELECT '{g}' AS metric_group, metric, round(value, 6) AS value
  FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM res) ON COLUMNS(*) INTO NAME metric VALUE value))""" for g in groups]
    return "WITH RECURSIVE " + ",\n".join(_shared_ctes()) + "\n" + "\nUNION ALL\n".join(parts)


ORACLE["e12_evaluate_tokenizer"] = _e_long(["vocabulary_overlap", "compression_ratio", "boundary_accuracy", "consistency",
                                            "oov_rate", "perplexity", "token_distribution", "semantic_coherence"])


BASIC = ["vocabulary_overlap", "compression_ratio", "boundary_accuracy", "consistency", "oov_rate"]


def _e_model(name: str, budget: str) -> str:
    """The basic metrics of the model whose budget of merges is ``budget`` (an expression over ``nvocab.n``)."""
    sql = _e_long(BASIC).replace(f"(SELECT {BPE_VOCAB} - n FROM nvocab)", f"(SELECT {budget} FROM nvocab)")
    return f"SELECT '{name}' AS model, * FROM ({sql})"


ORACLE["e13_compare_tokenizers"] = (_e_model("merges_all", f"{BPE_VOCAB} - n") + "\nUNION ALL\n"
                                    + _e_model("merges_half", f"({BPE_VOCAB} - n) // 2"))


# ------------------------------------------------------------------ sources, profiling, text scalars

ORACLE["a1_read_corpus"] = "SELECT * FROM documents"
ORACLE["a1_read_csv"] = """WITH t AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, lang,
  '"' || coalesce(text, '') || '",' || chr(10) || chr(10) || coalesce(source, '') || chr(10) AS code FROM documents)
SELECT doc_id, CAST(length(code) AS BIGINT) AS n_chars, md5(code) AS code_md5, lang FROM t"""
ORACLE["a2_sample_rows"] = "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100"
ORACLE["a3_first_rows"] = "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 100"

ORACLE["b1_profile_shape"] = """SELECT CAST(row_number() OVER () AS BIGINT) AS ordinal, column_name,
  CASE lower(column_type) WHEN 'varchar' THEN 'string' ELSE lower(column_type) END AS dtype,
  (SELECT count(*) FROM documents) AS n_rows, CAST(count(*) OVER () AS BIGINT) AS n_columns
FROM (DESCRIBE documents)"""
ORACLE["b2_profile_missing"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM documents"
    for c in ("doc_id", "text", "lang", "source", "n_chars"))
ORACLE["b3_value_counts"] = "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang"
ORACLE["b4_text_stats"] = " UNION ALL ".join(f"""SELECT '{c}' AS column_name,
  round(avg(length(t)), 6) AS mean_length, round(stddev_samp(length(t)), 6) AS std_length,
  CAST(min(length(t)) AS BIGINT) AS min_length, CAST(max(length(t)) AS BIGINT) AS max_length,
  round(avg(len({WORDS.format(c='t')})), 6) AS mean_words, round(stddev_samp(len({WORDS.format(c='t')})), 6) AS std_words,
  CAST(min(len({WORDS.format(c='t')})) AS BIGINT) AS min_words, CAST(max(len({WORDS.format(c='t')})) AS BIGINT) AS max_words
FROM (SELECT coalesce(CAST({c} AS VARCHAR), 'nan') AS t FROM documents)""" for c in ("text", "source"))

PAIRS = """(SELECT conv_id, turn, code, docstring FROM (
  SELECT conv_id, turn, role, text AS code, lead(role) OVER w AS next_role, lead(text) OVER w AS docstring
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

ORACLE["c1_whitespace_tokens"] = f"""SELECT doc_id, CAST(len({WORDS.format(c='text')}) AS BIGINT) AS n_tokens,
  array_to_string({WORDS.format(c='text')}, ' ') AS tokens FROM documents"""
NORMALIZE = """regexp_replace(regexp_replace(regexp_replace(regexp_replace({c},
  '\\b\\d+\\.\\d+\\b', '<NUM>', 'g'), '\\b\\d+\\b', '<NUM>', 'g'), '"[^"]*"', '<STR>', 'g'), '''[^'']*''', '<STR>', 'g')"""
ORACLE["c2_normalize_code_literals"] = f"SELECT doc_id, {NORMALIZE.format(c='text')} AS normalized FROM documents"
ORACLE["c3_batch_tokenize"] = f"""SELECT doc_id, CAST(len({WORDS.format(c=NORMALIZE.format(c='text'))}) AS BIGINT) AS n_tokens,
  array_to_string({WORDS.format(c=NORMALIZE.format(c='text'))}, ' ') AS tokens FROM documents"""
ORACLE["c4_sentences"] = """SELECT doc_id, CAST(generate_subscripts(string_split(text, '.'), 1) - 1 AS BIGINT) AS idx,
  unnest(string_split(text, '.')) AS sentence FROM documents"""
ORACLE["c5_combine_text"] = f"SELECT conv_id, turn, code || ' ' || docstring AS combined FROM {PAIRS}"
ORACLE["c6_distinct_char_pairs"] = f"""WITH {_words_cte()} SELECT word,
  array_to_string(list_sort(list_distinct(list_transform(range(1, length(word)), lambda i: substring(word, i, 2)))), ' ') AS pairs FROM words"""
ORACLE["c7_build_prompt"] = f"""SELECT doc_id,
  'Summarize function ' || coalesce(source, '') || ': ' || array_to_string({WORDS.format(c='text')}[1:100], ' ') AS summary_prompt,
  'Detailed docstring for ' || coalesce(nullif(source, ''), 'function') || ': ' || coalesce(lang, '') AS doc_prompt
FROM documents"""


# ------------------------------------------------------------------ embeddings (F)

SENT = f"""(SELECT conv_id, turn, kind, toks FROM (
  SELECT conv_id, turn, 'code' AS kind, {WORDS.format(c="coalesce(code, 'nan')")} AS toks FROM {PAIRS}
  UNION ALL SELECT conv_id, turn, 'doc', {WORDS.format(c="coalesce(docstring, 'nan')")} FROM {PAIRS}
  UNION ALL SELECT conv_id, turn, 'combined', {WORDS.format(c="coalesce(code, 'nan') || ' ' || coalesce(docstring, 'nan')")} FROM {PAIRS})
  WHERE len(toks) > 0)"""
COMB = f"(SELECT conv_id, turn, toks FROM {SENT} WHERE kind = 'combined')"
FVOCAB = f"""(SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS BIGINT) AS id FROM (
  SELECT word, count(*) AS n FROM (SELECT unnest(toks) AS word FROM {COMB}) GROUP BY word HAVING count(*) >= 5))"""
SKIP = f"""(SELECT conv_id, turn, CAST(pos AS BIGINT) AS pos, CAST(ctx_pos AS BIGINT) AS ctx_pos, toks[pos + 1] AS center, toks[ctx_pos + 1] AS context
  FROM (SELECT conv_id, turn, toks, pos, unnest(range(greatest(pos - 5, 0), least(pos + 5, len(toks) - 1) + 1)) AS ctx_pos
        FROM (SELECT conv_id, turn, toks, unnest(range(0, len(toks))) AS pos FROM {COMB}))
  WHERE ctx_pos <> pos AND toks[pos + 1] IN (SELECT word FROM {FVOCAB}) AND toks[ctx_pos + 1] IN (SELECT word FROM {FVOCAB}))"""

ORACLE["f1_training_sentences"] = f"SELECT conv_id, turn, kind, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens FROM {SENT}"
ORACLE["f2_frequency_vocab"] = f"SELECT word, n, id FROM {FVOCAB}"
ORACLE["f3_skipgram_pairs"] = f"SELECT * FROM {SKIP}"
ORACLE["f4_cooccurrence"] = f"SELECT center, context, count(*) AS n FROM {SKIP} GROUP BY center, context"

GV = "(SELECT vec_id AS word, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings)"
COS = "coalesce(list_cosine_similarity({a}, {b}), 0.0)"
ORACLE["f7_embedding_info"] = f"SELECT count(*) AS vocab_size, CAST(max(len(vector)) AS BIGINT) AS vector_size, 'given' AS model_type FROM {GV}"
ORACLE["f8_get_vectors"] = f"""SELECT l.doc_id AS word, g.vector IS NOT NULL AS found, CAST(coalesce(len(g.vector), 0) AS BIGINT) AS dim,
  round(list_sum(g.vector), 6) AS vsum FROM labels l LEFT JOIN {GV} g ON g.word = l.doc_id"""
ORACLE["f9_similarity"] = f"""SELECT p.a, p.b, round(CASE WHEN x.vector IS NULL OR y.vector IS NULL THEN 0.0 ELSE {COS.format(a='x.vector', b='y.vector')} END, 6) AS similarity
FROM (SELECT vec_id AS a, vec_id + 1 AS b FROM embeddings) p LEFT JOIN {GV} x ON x.word = p.a LEFT JOIN {GV} y ON y.word = p.b"""
NN = f"""(SELECT q.word AS query, c.word, {COS.format(a='q.vector', b='c.vector')} AS similarity,
   row_number() OVER (PARTITION BY q.word ORDER BY {COS.format(a='q.vector', b='c.vector')} DESC, c.word) AS rank
   FROM {GV} q JOIN {GV} c ON c.word <> q.word)"""
ORACLE["f10_most_similar"] = f"SELECT query, CAST(rank AS BIGINT) AS rank, word, round(similarity, 6) AS similarity FROM {NN} WHERE rank <= 10"
ORACLE["f12_semantic_similarity_report"] = f"""WITH nn AS (SELECT * FROM {NN} WHERE rank <= 5),
first AS (SELECT string_agg(query || ':' || word, ',' ORDER BY s DESC, query, word) AS examples
          FROM (SELECT query, word, round(similarity, 6) AS s FROM nn ORDER BY s DESC, query, word LIMIT 10))
SELECT count(*) AS total_similarities, round(avg(similarity), 6) AS avg_similarity, any_value(examples) AS examples FROM nn, first"""
UNITS = f"(SELECT word, label, list_transform(vector, lambda x: x / sqrt(list_sum(list_transform(vector, lambda y: y * y)))) AS u FROM {GV})"
ORACLE["f14_completion_given"] = f"""WITH u AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY word DESC) = 1 AS last, count(*) OVER (PARTITION BY label) AS n FROM {UNITS}),
m AS (SELECT label, list(a ORDER BY i) AS vector FROM (SELECT label, i, avg(u[i]) AS a FROM (SELECT label, u, unnest(range(1, len(u) + 1)) AS i FROM u WHERE NOT last AND n > 1) GROUP BY label, i) GROUP BY label),
r AS (SELECT m.label, g.word, row_number() OVER (PARTITION BY m.label ORDER BY {COS.format(a='m.vector', b='g.vector')} DESC, g.word) AS k
      FROM m JOIN {GV} g ON g.label <> m.label OR g.word IN (SELECT word FROM u WHERE last))
SELECT round(coalesce(avg(CASE WHEN r.word = u.word THEN 1.0 ELSE 0.0 END), 0.0), 6) AS accuracy, count(*) AS total_tests
FROM u LEFT JOIN r ON r.label = u.label AND r.k = 1 WHERE u.last AND u.n > 1"""
ORACLE["f15_doc_relevance_given"] = f"""WITH g AS {GV},
p AS (SELECT a.label, avg({COS.format(a='a.vector', b='b.vector')}) AS v FROM g a JOIN g b ON a.label = b.label WHERE a.word % 2 = 0 AND b.word % 2 = 1 GROUP BY a.label)
SELECT round(coalesce(avg(v), 0.0), 6) AS avg_relevance, count(*) AS total_tests FROM p"""
ORACLE["f17_context_hint_given"] = f"""WITH t AS (SELECT label, word, row_number() OVER (PARTITION BY label ORDER BY word) AS pos FROM {GV}),
h AS (SELECT t.label, t.pos, n.rank, n.word, row_number() OVER (PARTITION BY t.label ORDER BY t.pos, n.rank) AS k FROM t JOIN {NN} n ON n.query = t.word WHERE t.pos <= 10 AND n.rank <= 2)
SELECT label AS id, ' Context: ' || string_agg(CAST(word AS VARCHAR), ' ' ORDER BY pos, rank) AS hint FROM h WHERE k <= 5 GROUP BY label"""
ORACLE["f13_analogy_query"] = f"""WITH u AS (SELECT word, label, list_transform(vector, lambda x: x / sqrt(list_sum(list_transform(vector, lambda y: y * y)))) AS u FROM {GV}),
d AS (SELECT label, unnest(generate_series(1, 64)) AS i FROM (SELECT DISTINCT label FROM u)),
m AS (SELECT d.label AS query, list(avg(u.u[d.i]) ORDER BY d.i) AS mv FROM d JOIN u ON u.label = d.label GROUP BY d.label, d.i),
mv AS (SELECT query, list(v ORDER BY i) AS vector FROM (SELECT d.label AS query, d.i, avg(u.u[d.i]) AS v FROM d JOIN u ON u.label = d.label GROUP BY d.label, d.i) GROUP BY query),
r AS (SELECT mv.query, g.word, {COS.format(a='mv.vector', b='g.vector')} AS similarity,
      row_number() OVER (PARTITION BY mv.query ORDER BY {COS.format(a='mv.vector', b='g.vector')} DESC, g.word) AS rank
      FROM mv JOIN {GV} g ON g.label <> mv.query)
SELECT query, CAST(rank AS BIGINT) AS rank, word, round(similarity, 6) AS similarity FROM r WHERE rank <= 1"""


# ------------------------------------------------------------------ language model (G)

SPLIT = "CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'val' ELSE 'test' END"
LM_CTES = f"""lmdocs AS (SELECT doc_id, text, {SPLIT} AS split FROM (
  SELECT doc_id, text, (('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100) AS b FROM documents)),
lmc AS (SELECT w AS token, count(*) AS n FROM (SELECT unnest({WORDS.format(c='text')}) AS w FROM lmdocs WHERE split = 'train') GROUP BY w HAVING count(*) >= 2),
lmtop AS (SELECT token, n FROM lmc),
lmv AS (SELECT token, CAST(3 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id FROM lmtop
        WHERE token NOT IN ('<PAD>', '<UNK>', '<BOS>', '<EOS>')
        UNION ALL SELECT * FROM (VALUES ('<PAD>', 0), ('<UNK>', 1), ('<BOS>', 2), ('<EOS>', 3)) v(token, id)),
lmw AS (SELECT doc_id, unnest({WORDS.format(c='text')}) AS t, generate_subscripts({WORDS.format(c='text')}, 1) AS k FROM lmdocs),
lmid0 AS (SELECT doc_id, list(coalesce(v.id, 1) ORDER BY k) AS ids FROM lmw LEFT JOIN lmv v ON v.token = lmw.t GROUP BY doc_id),
lme AS (SELECT d.doc_id, d.split, list_concat([2], coalesce(x.ids, []::INTEGER[]), [3]) AS ids FROM lmdocs d LEFT JOIN lmid0 x ON x.doc_id = d.doc_id),
pos AS (SELECT doc_id, split, p AS pos, CASE WHEN p >= 2 THEN ids[p - 1] ELSE 2 END AS c2, ids[p] AS c1, ids[p + 1] AS w
        FROM (SELECT doc_id, split, ids, unnest(range(1, len(ids))) AS p FROM lme)),
tri AS (SELECT c2, c1, w, count(*) AS n3 FROM pos WHERE split = 'train' GROUP BY c2, c1, w),
bi AS (SELECT c1, w, sum(n3) AS n2 FROM tri GROUP BY c1, w),
uni AS (SELECT w, sum(n2) AS n1 FROM bi GROUP BY w),
ctx1 AS (SELECT c1, sum(n2) AS m1 FROM bi GROUP BY c1),
ctx2 AS (SELECT c2, c1, sum(n3) AS m2 FROM tri GROUP BY c2, c1),
tot AS (SELECT CAST(sum(n1) AS DOUBLE) AS t, (SELECT count(*) FROM lmv) AS v FROM uni),
topu AS (SELECT w, n1 FROM uni ORDER BY n1 DESC, w LIMIT 1),
sc AS (
  SELECT p.doc_id, p.split, p.pos, p.c2, p.c1, p.w,
    ln(0.5::DOUBLE * CASE WHEN x2.m2 > 0 THEN coalesce(t3.n3, 0) / x2.m2 ELSE 0.0 END
       + 0.3::DOUBLE * CASE WHEN x1.m1 > 0 THEN coalesce(t2.n2, 0) / x1.m1 ELSE 0.0 END
       + 0.15::DOUBLE * (coalesce(u.n1, 0) / tot.t) + 0.05::DOUBLE / tot.v) AS logp
  FROM pos p CROSS JOIN tot
  LEFT JOIN tri t3 ON t3.c2 = p.c2 AND t3.c1 = p.c1 AND t3.w = p.w
  LEFT JOIN ctx2 x2 ON x2.c2 = p.c2 AND x2.c1 = p.c1
  LEFT JOIN bi t2 ON t2.c1 = p.c1 AND t2.w = p.w
  LEFT JOIN ctx1 x1 ON x1.c1 = p.c1
  LEFT JOIN uni u ON u.w = p.w),
ctxs AS (SELECT DISTINCT c2, c1 FROM pos WHERE split <> 'train'),
cand AS (
  SELECT c.c2, c.c1, b.w, b.n2 FROM ctxs c JOIN bi b ON b.c1 = c.c1
  UNION ALL SELECT c.c2, c.c1, t.w, 0 FROM ctxs c CROSS JOIN topu t),
cs AS (
  SELECT cand.c2, cand.c1, cand.w,
    CASE WHEN cand.n2 > 0 THEN
      CASE WHEN t3.n3 IS NOT NULL THEN 0.5::DOUBLE * t3.n3 / x2.m2 + 0.3::DOUBLE * cand.n2 / x1.m1 + 0.15::DOUBLE * u.n1 / tot.t
           ELSE 0.3::DOUBLE * cand.n2 / x1.m1 + 0.15::DOUBLE * u.n1 / tot.t END
    ELSE 0.15::DOUBLE * u.n1 / tot.t END AS s
  FROM cand CROSS JOIN tot
  LEFT JOIN tri t3 ON t3.c2 = cand.c2 AND t3.c1 = cand.c1 AND t3.w = cand.w
  LEFT JOIN ctx2 x2 ON x2.c2 = cand.c2 AND x2.c1 = cand.c1
  LEFT JOIN ctx1 x1 ON x1.c1 = cand.c1
  LEFT JOIN uni u ON u.w = cand.w),
am AS (SELECT c2, c1, w AS pred FROM (SELECT *, row_number() OVER (PARTITION BY c2, c1 ORDER BY s DESC, w) AS r FROM cs) WHERE r = 1),
scored AS (SELECT sc.*, am.pred FROM sc JOIN am ON am.c2 = sc.c2 AND am.c1 = sc.c1 WHERE sc.split <> 'train')"""

ORACLE["g1_lm_vocab"] = f"WITH {LM_CTES} SELECT token, id FROM lmv"
ORACLE["g2_lm_encode"] = f"WITH {LM_CTES} SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, array_to_string(ids, ' ') AS ids FROM lme"
ORACLE["g3_lm_decode"] = f"""WITH {LM_CTES}, lr AS (SELECT token, id FROM lmv),
dx AS (SELECT doc_id, unnest(ids) AS i, generate_subscripts(ids, 1) AS k FROM lme)
SELECT d.doc_id, coalesce(string_agg(coalesce(lr.token, '<UNK>'), ' ' ORDER BY dx.k) FILTER (WHERE dx.i NOT IN (0, 2, 3)), '') AS decoded
FROM lme d LEFT JOIN dx ON dx.doc_id = d.doc_id LEFT JOIN lr ON lr.id = dx.i GROUP BY d.doc_id"""
TRUNC = "CASE WHEN len(ids) > 256 THEN list_concat(ids[1:255], [3]) ELSE ids END"
ORACLE["g4_truncate_ids"] = f"""WITH {LM_CTES} SELECT doc_id, CAST(len({TRUNC}) AS BIGINT) AS n_ids, array_to_string({TRUNC}, ' ') AS ids FROM lme"""
ORACLE["g5_next_token_examples"] = f"""WITH {LM_CTES},
tr AS (SELECT doc_id, ids, (row_number() OVER (ORDER BY md5('batch:42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) // 64 AS batch FROM lme),
wd AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) - 1 AS width FROM tr)
SELECT doc_id, CAST(batch AS BIGINT) AS batch, CAST(len(ids) - 1 AS BIGINT) AS length,
  array_to_string(list_concat(ids[1:len(ids) - 1], list_transform(range(width - (len(ids) - 1)), lambda x: 0)), ' ') AS inputs,
  array_to_string(list_concat(ids[2:len(ids)], list_transform(range(width - (len(ids) - 1)), lambda x: 0)), ' ') AS targets
FROM wd"""
ORACLE["g6_split_exact"] = """SELECT doc_id, CASE WHEN r < CAST(floor(0.8 * n) AS BIGINT) THEN 'train'
  WHEN r < CAST(floor(0.8 * n) AS BIGINT) + CAST(floor(0.1 * n) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)"""
ORACLE["g6_split"] = f"WITH {LM_CTES} SELECT doc_id, split FROM lmdocs"
ORACLE["g7_ngram_counts"] = f"WITH {LM_CTES} SELECT CAST(c2 AS INTEGER) AS c2, CAST(c1 AS INTEGER) AS c1, CAST(w AS INTEGER) AS w, n3 FROM tri"
ORACLE["g8_score_lm"] = f"""WITH {LM_CTES} SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(w AS INTEGER) AS target,
  round(logp, 6) AS logp, CAST(pred AS INTEGER) AS pred FROM scored WHERE split = 'val'"""
LM5_CTES = LM_CTES.split("\npos AS (")[0] + """
w5 AS (SELECT doc_id, split, p AS pos, list_reverse(list_concat([2, 2, 2], ids)[p:p + 3]) AS ctx, ids[p + 1] AS w
        FROM (SELECT doc_id, split, ids, unnest(range(1, len(ids))) AS p FROM lme)),
cnt AS (SELECT k, ctx[1:k] AS ctx, w, count(*) AS n FROM w5, range(0, 5) r(k) WHERE split = 'train' GROUP BY ALL)"""
SCORE5 = "0.0"
for _k in range(5):
    SCORE5 = f"({2 ** (_k + 1)}.0::DOUBLE / 63 * coalesce(s{_k}.p, 0.0) + {SCORE5})"
SHARES5 = " ".join(f"LEFT JOIN sh s{_k} ON s{_k}.k = {_k} AND s{_k}.w = x.w AND s{_k}.ctx = x.ctx[1:{_k}]" for _k in range(5))
ORACLE["g7_ngram_counts_order5"] = f"""WITH {LM5_CTES}
SELECT CAST(k + 1 AS BIGINT) AS length, array_to_string(list_concat(list_reverse(ctx), [w]), ' ') AS gram, n FROM cnt"""
ORACLE["g8_score_lm_order5"] = f"""WITH {LM5_CTES},
ctt AS (SELECT k, ctx, sum(n) AS m FROM cnt GROUP BY ALL),
sh AS (SELECT k, ctx, w, n::DOUBLE / m::DOUBLE AS p FROM cnt JOIN ctt USING (k, ctx)),
asked AS (SELECT DISTINCT ctx FROM w5 WHERE split = 'val'),
x AS (SELECT a.ctx, c.w FROM asked a JOIN cnt c ON c.k = 1 AND c.ctx = a.ctx[1:1]
      UNION SELECT a.ctx, t.w FROM asked a CROSS JOIN (SELECT w FROM cnt WHERE k = 0 ORDER BY n DESC, w LIMIT 1) t),
best AS (SELECT ctx, w AS pred FROM (SELECT x.ctx, x.w, {SCORE5} AS s FROM x {SHARES5})
         QUALIFY row_number() OVER (PARTITION BY ctx ORDER BY s DESC, w) = 1)
SELECT x.doc_id, CAST(x.pos AS BIGINT) AS pos, CAST(x.w AS INTEGER) AS target,
  round(ln({SCORE5} + 1.0::DOUBLE / 63 / (SELECT count(*) FROM lmv)), 6) AS logp, CAST(best.pred AS INTEGER) AS pred
FROM w5 x JOIN best ON best.ctx = x.ctx {SHARES5} WHERE x.split = 'val'"""
ORACLE["g9_lm_metrics"] = f"""WITH {LM_CTES},
ag AS (SELECT split, sum(-logp) AS tl, count(*) AS nt, sum(CASE WHEN pred = w THEN 1 ELSE 0 END) AS nc FROM scored WHERE split IN ('val', 'test') AND w <> 0 GROUP BY split)
SELECT split, round(tl / greatest(nt, 1), 6) AS loss, round(CASE WHEN tl / greatest(nt, 1) < 20 THEN exp(tl / greatest(nt, 1)) ELSE 'inf'::DOUBLE END, 6) AS perplexity,
  round(nc / greatest(nt, 1), 6) AS accuracy, CAST(nt AS BIGINT) AS n_tokens FROM ag"""


def bleu_sql(rows: str, key: str) -> str:
    """Sentence BLEU-4, smoothing method 4, over ``rows`` with columns (key, r, h) as token lists."""
    g = lambda side, col: f"""SELECT {key}, n, g, count(*) AS c FROM (SELECT {key}, n, unnest(list_transform(range(1, len({col}) - n + 2),
        lambda i: array_to_string({col}[i:i + n - 1], ' '))) AS g FROM bt, (VALUES (1), (2), (3), (4)) v(n) WHERE len({col}) >= n) GROUP BY {key}, n, g"""
    return f"""bt AS ({rows}),
hg AS ({g('h', 'h')}), rg AS ({g('r', 'r')}),
cl AS (SELECT hg.{key}, hg.n, sum(least(hg.c, coalesce(rg.c, 0))) AS m FROM hg LEFT JOIN rg ON rg.{key} = hg.{key} AND rg.n = hg.n AND rg.g = hg.g GROUP BY hg.{key}, hg.n),
wm AS (SELECT bt.{key}, len(bt.h) AS lh, len(bt.r) AS lr,
  coalesce(max(m) FILTER (WHERE n = 1), 0) AS m1, coalesce(max(m) FILTER (WHERE n = 2), 0) AS m2,
  coalesce(max(m) FILTER (WHERE n = 3), 0) AS m3, coalesce(max(m) FILTER (WHERE n = 4), 0) AS m4
  FROM bt LEFT JOIN cl ON cl.{key} = bt.{key} GROUP BY bt.{key}, len(bt.h), len(bt.r)),
wz AS (SELECT *, (m1 = 0)::INT AS j1, (m1 = 0)::INT + (m2 = 0)::INT AS j2, (m1 = 0)::INT + (m2 = 0)::INT + (m3 = 0)::INT AS j3,
  (m1 = 0)::INT + (m2 = 0)::INT + (m3 = 0)::INT + (m4 = 0)::INT AS j4 FROM wm),
wp AS (SELECT {key}, lh, lr, m1,
  {', '.join(f"CASE WHEN m{n} > 0 THEN m{n} / greatest(lh - {n} + 1, 1) WHEN lh > 1 THEN ln(lh) / (5.0 * pow(2.0, j{n})) / greatest(lh - {n} + 1, 1) ELSE NULL END AS p{n}" for n in (1, 2, 3, 4))}
  FROM wz),
bl AS (SELECT {key}, CASE WHEN lh = 0 OR lr = 0 THEN 0.0 WHEN m1 = 0 THEN 0.0
  ELSE (CASE WHEN lh > lr THEN 1.0 ELSE exp(1 - lr / lh) END) *
       exp({' + '.join(f"CASE WHEN p{n} > 0 THEN ln(p{n}) * 0.25 ELSE 0.0 END" for n in (1, 2, 3, 4))}) END AS bleu FROM wp)"""


ORACLE["g10_bleu"] = f"""WITH {bleu_sql(f"SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS id, {WORDS.format(c='docstring')} AS r, {WORDS.format(c='code')} AS h FROM {PAIRS}", 'id')}
SELECT id, round(bleu, 6) AS bleu FROM bl"""


ALL_SPLITS = LM_CTES.replace("FROM pos WHERE split <> 'train')", "FROM pos)").replace(" WHERE sc.split <> 'train')", ")")
ORACLE["g11_lm_report"] = f"""WITH {ALL_SPLITS},
ag AS (SELECT split, sum(-logp) AS tl, count(*) AS nt, sum(CASE WHEN pred = w THEN 1 ELSE 0 END) AS nc FROM scored WHERE w <> 0 GROUP BY split),
words AS (SELECT s.split || ':' || CAST(s.doc_id AS VARCHAR) AS id,
    coalesce(list(coalesce(r.token, '<UNK>') ORDER BY s.pos) FILTER (WHERE s.w NOT IN (0, 2, 3)), []) AS r,
    coalesce(list(coalesce(h.token, '<UNK>') ORDER BY s.pos) FILTER (WHERE s.pred NOT IN (0, 2, 3)), []) AS h
  FROM scored s LEFT JOIN lmv r ON r.id = s.w LEFT JOIN lmv h ON h.id = s.pred GROUP BY ALL),
{bleu_sql("SELECT id, r, h FROM words", 'id')},
long AS (SELECT split, unnest(['loss', 'perplexity', 'accuracy', 'n_tokens']) AS metric,
    unnest([tl / greatest(nt, 1), CASE WHEN tl / greatest(nt, 1) < 20 THEN exp(tl / greatest(nt, 1)) ELSE 'inf'::DOUBLE END, nc / greatest(nt, 1), nt::DOUBLE]) AS value FROM ag
  UNION ALL SELECT split_part(id, ':', 1), 'bleu', avg(bleu) FROM bl GROUP BY 1)
SELECT split, metric, round(value, 6) AS value FROM long"""

BEST = """b2 AS (SELECT bi.c1, bi.w, 0.3::DOUBLE * n2 / m1 + 0.15::DOUBLE * n1 / tot.t AS s
       FROM bi JOIN ctx1 ON ctx1.c1 = bi.c1 JOIN uni ON uni.w = bi.w CROSS JOIN tot
       UNION ALL SELECT ctx1.c1, topu.w, 0.15::DOUBLE * topu.n1 / tot.t FROM ctx1 CROSS JOIN topu CROSS JOIN tot),
best2 AS (SELECT c1, w, s FROM (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY s DESC, w) AS r FROM b2) WHERE r = 1),
t3 AS (SELECT tri.c2, tri.c1, tri.w, 0.5::DOUBLE * n3 / m2 + 0.3::DOUBLE * n2 / m1 + 0.15::DOUBLE * n1 / tot.t AS s
       FROM tri JOIN ctx2 ON ctx2.c2 = tri.c2 AND ctx2.c1 = tri.c1 JOIN bi ON bi.c1 = tri.c1 AND bi.w = tri.w
       JOIN ctx1 ON ctx1.c1 = tri.c1 JOIN uni ON uni.w = tri.w CROSS JOIN tot),
b3 AS (SELECT c2, c1, w, s FROM t3
       UNION ALL SELECT x.c2, x.c1, b.w, coalesce(t3.s, b.s) FROM ctx2 x JOIN best2 b ON b.c1 = x.c1 LEFT JOIN t3 ON t3.c2 = x.c2 AND t3.c1 = x.c1 AND t3.w = b.w),
best3 AS (SELECT c2, c1, w FROM (SELECT *, row_number() OVER (PARTITION BY c2, c1 ORDER BY s DESC, w) AS r FROM b3) WHERE r = 1)"""
ORACLE["h1_greedy_generate"] = f"""WITH RECURSIVE {LM_CTES}, {BEST},
pr AS (SELECT doc_id, CASE WHEN ids[len(ids)] = 3 THEN ids[1:len(ids) - 1] ELSE ids END AS ids FROM lme),
st AS (SELECT doc_id, CASE WHEN len(ids) >= 2 THEN ids[len(ids) - 1] ELSE 2 END AS c2, CASE WHEN len(ids) >= 1 THEN ids[len(ids)] ELSE 2 END AS c1 FROM pr),
gen(s2, s1, step, c2, c1) AS (
  SELECT DISTINCT c2, c1, 0, c2, c1 FROM st
  UNION ALL
  SELECT g.s2, g.s1, g.step + 1, g.c1, coalesce(x3.w, x2.w, (SELECT w FROM topu))
  FROM gen g LEFT JOIN best3 x3 ON x3.c2 = g.c2 AND x3.c1 = g.c1 LEFT JOIN best2 x2 ON x2.c1 = g.c1
  WHERE g.step < 80 AND (g.step = 0 OR g.c1 <> 3)),
nw AS (SELECT s2, s1, list(c1 ORDER BY step) AS new FROM gen WHERE step > 0 GROUP BY s2, s1)
SELECT pr.doc_id, CAST(len(nw.new) AS BIGINT) AS n_new, array_to_string(list_concat(pr.ids, nw.new), ' ') AS ids
FROM pr JOIN st ON st.doc_id = pr.doc_id JOIN nw ON nw.s2 = st.c2 AND nw.s1 = st.c1"""


# ------------------------------------------------------------------ D (continued), U

def _bpe_corpus(src: str, size: int) -> str:
    return ("WITH RECURSIVE " + ",\n".join([_words_cte(src), vocab_ctes(size)]) +
            "\nSELECT rank, lhs, rhs, pair_count FROM train")


ORACLE["d9_train_bpe_per_corpus"] = " UNION ALL ".join(
    f"SELECT '{name}' AS corpus, * FROM ({_bpe_corpus(src, size)})" for name, src, size in (
        ("code", f"SELECT code AS text FROM {PAIRS}", 140),
        ("doc", f"SELECT docstring AS text FROM {PAIRS}", 140),
        ("combined", f"SELECT code AS text FROM {PAIRS} UNION ALL SELECT docstring AS text FROM {PAIRS}", 160)))
ORACLE["d13_encode_rows"] = ORACLE["d12_encode_documents"]
ORACLE["d14_decode"] = _e(", " + DECODED + "\nSELECT k AS doc_id, decoded FROM dec")
ORACLE["d15_tokenize_with"] = _bpe(""", occt AS (SELECT doc_id AS k, unnest(""" + WORDS.format(c='text') + """) AS word,
     generate_subscripts(""" + WORDS.format(c='text') + """, 1) AS pos FROM documents),
tk AS (SELECT o.k, flatten(list(s.toks ORDER BY o.pos)) AS toks FROM occt o JOIN segid s ON s.word = o.word GROUP BY o.k)
SELECT d.doc_id, CAST(coalesce(len(tk.toks), 0) AS BIGINT) AS n_tokens, coalesce(array_to_string(tk.toks, ' '), '') AS tokens
FROM documents d LEFT JOIN tk ON tk.k = d.doc_id""", with_seg=True)
ORACLE["u1_tokenize_udf"] = ORACLE["c1_whitespace_tokens"]

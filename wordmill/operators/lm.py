"""Language-model corpus, n-gram model, metrics and BLEU.

The reference trains a neural next-token model on one GPU.  Here the model is
re-aimed as an interpolated trigram model whose training is counting:
n-gram and context counts are group-bys (partial aggregation absorbs frequent
n-grams) and scoring is equi-joins on the context, so every step is a Spark
job whose cost grows linearly with the corpus.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import whitespace_tokens
from ..session import bounded_broadcast, cut_lineage, scalar_row, settled, with_rank
from ..sources.corpus import sample_key

# Special tokens of the language model, ids 0-3.
PAD, UNK, BOS, EOS = "<PAD>", "<UNK>", "<BOS>", "<EOS>"
SPECIALS = [PAD, UNK, BOS, EOS]
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3


def split_bucket(key, seed: int = 42) -> F.Column:
    """0..99 from the first 8 hex digits of md5(seed:key) (identical in DuckDB)."""
    return F.pmod(F.conv(F.substring(sample_key(key, seed), 1, 8), 16, 10).cast("long"), F.lit(100))


def split_train_val_test(df: DataFrame, key: str, train: float = 0.8, val: float = 0.1, seed: int = 42,
                         exact: bool = False) -> DataFrame:
    """Adds ``split`` in {train, val, test}.

    By default each row falls by its seeded hash (no shuffle, shares are met on
    average).  ``exact`` ranks the rows by that hash, so that the splits hold
    exactly floor(train * n) and floor(val * n) rows, and the rest.
    """
    if exact:
        ranked = with_rank(df.withColumn("_h", sample_key(key, seed)), "_h", F.col(key), name="_rank")
        n = ranked.count()
        t, v, b = int(train * n), int(train * n) + int(val * n), F.col("_rank")
        return ranked.withColumn("split", F.when(b < t, "train").when(b < v, "val").otherwise("test")).drop("_h", "_rank")
    b = split_bucket(key, seed)
    t, v = int(round(train * 100)), int(round((train + val) * 100))
    return df.withColumn("split", F.when(b < t, "train").when(b < v, "val").otherwise("test"))


@dataclass
class LmVocab:
    """Word -> id as a table ``(token, id)``; ids 0-3 are the specials."""

    table: DataFrame
    size: int

    def __len__(self):
        return self.size

    def df(self, spark=None) -> DataFrame:
        return self.table


def lm_vocab(df: DataFrame, col: str, min_freq: int = 2, max_size: int | None = None) -> LmVocab:
    """G1: specials, then all words with freq >= min_freq by descending frequency (ties: word).

    Ids come from a range sort, so the vocabulary never passes through the
    driver or one task.  ``max_size`` is the caller's option to keep the most
    frequent words only; a word spelled like a special is skipped but still
    uses its place under it.
    """
    counts = (df.select(F.explode(whitespace_tokens(col)).alias("token")).groupBy("token")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_freq))
    if max_size is not None:
        counts = counts.orderBy(F.desc("n"), F.asc("token")).limit(max(0, max_size - len(SPECIALS)))
    ranked = with_rank(counts.where(~F.col("token").isin(SPECIALS)), F.desc("n"), F.asc("token"), name="id")
    words = ranked.select("token", (F.col("id") + len(SPECIALS)).cast("int").alias("id"))
    specials = df.sparkSession.createDataFrame([(t, i) for i, t in enumerate(SPECIALS)], "token string, id int")
    table = cut_lineage(specials.unionByName(words))
    return LmVocab(table, table.count())


# Text that a task of the encoder holds at a time, with the ids of its distinct words.
BLOCK_BYTES = 16 << 20
# What an id stands for in a text, with its blank.
ID_BYTES = 6


def lm_encode(df: DataFrame, col: str, vocab: LmVocab, key: str | list[str] = "doc_id",
              out: str = "ids", keep=()) -> DataFrame:
    """[BOS] + tokens + [EOS] as ids; unknown words -> UNK; empty or null text -> [BOS, EOS].

    Texts are dealt to blocks of some ``BLOCK_BYTES``.  A block's distinct words
    meet the vocabulary (broadcast under the byte bound, else a shuffle
    join), and its texts look their words up among these, so no token is a row
    of its own.  Rows of one key share their tokens, in position order; a null key has none.
    """
    keys, keep = [key] if isinstance(key, str) else list(key), list(keep)
    spark = df.sparkSession
    n_bytes = scalar_row(df.agg(F.sum(F.octet_length(col)).alias("n")))["n"] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-n_bytes // BLOCK_BYTES))
    texts = (df.select(*keys, *keep, F.col(col).alias("_text"))
             .withColumn("_block", F.pmod(F.xxhash64(*keys, "_text"), F.lit(n)).cast("int")).repartition(n, "_block"))
    # the outer explode, else a filter on the array's size would split each text twice
    words = texts.select("_block", F.explode_outer(whitespace_tokens("_text")).alias("token")).where(F.col("token").isNotNull()).distinct()
    known = words.join(bounded_broadcast(vocab.df(spark), len(vocab)), "token").select(F.col("_block").alias("_of"), "token", "id")
    rows = texts.select(*keys, *keep, "_block", whitespace_tokens("_text").alias("_words"))

    def look_up(texts: pa.Table, known: pa.Table) -> pa.Table:
        tokens = texts["_words"].combine_chunks()
        found = pc.index_in(tokens.flatten(), value_set=known["token"].combine_chunks())
        ids = pc.fill_null(known["id"].combine_chunks().take(found), UNK_ID).cast(pa.int32())
        ends = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))
        return texts.select([*keys, *keep]).append_column(out, pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), ids))

    schema = T.StructType([*rows.select(*keys, *keep).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    coded = rows.groupBy("_block").cogroup(known.groupBy("_of")).applyInArrow(look_up, schema)
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    body = F.when(keyed, F.col(out)).otherwise(F.array().cast("array<int>"))
    repeated = cut_lineage(df.where(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys))
    if not repeated.isEmpty():
        coded = settled(coded)
        ids = (coded.join(repeated, keys, "left_semi").select(*keys, F.posexplode(out).alias("_k", "id")).groupBy(*keys)
               .agg(F.array_sort(F.collect_list(F.struct("_k", "id"))).alias("p")))
        coded = coded.join(ids.select(*keys, F.transform("p", lambda x: x["id"]).alias("_all")), keys, "left")
        body = F.coalesce("_all", body)
    full = F.concat(F.array(F.lit(BOS_ID)), body, F.array(F.lit(EOS_ID)))
    return coded.select(*keys, *keep, full.alias(out))


def lm_decode(df: DataFrame, ids_col: str, vocab: LmVocab, key: str | list[str] = "doc_id",
              out: str = "decoded") -> DataFrame:
    """Ids -> words joined by spaces; BOS/EOS/PAD dropped, unknown ids -> <UNK>.

    As in ``lm_encode`` no id is a row: rows are dealt to blocks, a block's distinct ids meet the vocabulary, and its rows
    look their words up among these.  Rows of one key share their ids, by position; a null key has none.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark, rest = df.sparkSession, [c for c in df.columns if c not in keys and c != out]
    silent = [BOS_ID, EOS_ID, PAD_ID]
    n_ids = scalar_row(df.agg(F.sum(F.greatest(F.size(ids_col), F.lit(0)).cast("long")).alias("n")))["n"] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-n_ids * ID_BYTES // BLOCK_BYTES))
    rows = df.select(*keys, *rest).withColumn("_block", F.pmod(F.xxhash64(*keys, ids_col), F.lit(n)).cast("int")).repartition(n, "_block")
    v = bounded_broadcast(vocab.df(spark), len(vocab))
    met = rows.select("_block", F.explode_outer(F.array_distinct(ids_col)).alias("id")).where(F.col("id").isNotNull()).distinct()
    known = met.join(v, "id").select(F.col("_block").alias("_of"), "id", "token")

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        ids = rows[ids_col].combine_chunks()
        flat, sizes = ids.flatten(), pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False)
        spoken = pc.and_(pc.is_valid(flat), pc.invert(pc.is_in(flat, pa.array(silent, pa.int32()))))
        words = known["token"].combine_chunks().take(pc.index_in(flat.filter(spoken), value_set=known["id"].combine_chunks()))
        before = np.r_[0, np.cumsum(spoken.to_numpy(zero_copy_only=False))]
        ends = before[np.r_[0, np.cumsum(sizes)]]
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.fill_null(words, UNK)), " ")
        return rows.select([*keys, *rest]).append_column(out, text)

    schema = T.StructType([*rows.select(*keys, *rest).schema.fields, T.StructField(out, T.StringType())])
    decoded = rows.groupBy("_block").cogroup(known.groupBy("_of")).applyInArrow(look_up, schema)
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    body = F.when(keyed, F.col(out)).otherwise("")
    repeated = cut_lineage(df.where(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys))
    if not repeated.isEmpty():
        occ = df.join(repeated, keys, "left_semi").select(*keys, F.posexplode(ids_col).alias("_k", "id")).where(~F.col("id").isin(silent))
        words = (occ.join(v, "id", "left").groupBy(*keys)
                 .agg(F.array_sort(F.collect_list(F.struct("_k", F.coalesce("token", F.lit(UNK)).alias("t")))).alias("p")))
        shared = F.array_join(F.transform("p", lambda x: x["t"]), " ")
        decoded = decoded.join(words.select(*keys, shared.alias("_all")), keys, "left")
        body = F.coalesce("_all", body)
    return decoded.select(*keys, *rest, body.alias(out))


def truncate_ids(ids_col, max_len: int | None = 256) -> F.Column:
    """Cut to ``max_len`` and make the last id EOS (None keeps whole sequences)."""
    ids = F.col(ids_col) if isinstance(ids_col, str) else ids_col
    if not max_len:
        return ids
    return F.when(F.size(ids) > max_len, F.concat(F.slice(ids, 1, max_len - 1), F.array(F.lit(EOS_ID)))).otherwise(ids)


def next_token_examples(encoded: DataFrame, key: str, ids: str = "ids", batch_size: int = 64,
                        seed: int = 42) -> DataFrame:
    """inputs = all but last, targets = all but first, padded to the longest in their batch.

    Rows are ranked by a seeded hash of the key (salted apart from the split's)
    and cut into batches of exactly ``batch_size``; padding is a window per batch.
    """
    e = with_rank(encoded.select(key, F.col(ids).alias("ids"), F.md5(F.concat_ws(":", F.lit("batch"), F.lit(str(seed)), F.col(key).cast("string"))).alias("_h")),
                  "_h", F.col(key), name="_rank")
    e = e.select(key, "ids", F.floor(F.col("_rank") / batch_size).alias("batch"))
    L = F.size("ids")
    e = e.withColumn("width", F.max(L).over(Window.partitionBy("batch")) - 1)
    pad = F.array_repeat(F.lit(PAD_ID), F.col("width") - (L - 1))
    return e.select(key, "batch", (L - 1).alias("length"),
                    F.concat(F.slice("ids", 1, L - 1), pad).alias("inputs"),
                    F.concat(F.slice("ids", 2, L - 1), pad).alias("targets"))


# ------------------------------------------------------------------ n-gram model

@dataclass
class NgramLm:
    """Interpolated trigram model: settled count and arg-max tables plus weights (l3, l2, l1, l0)."""

    uni: DataFrame          # (w, n1)
    bi: DataFrame           # (c1, w, n2)
    tri: DataFrame          # (c2, c1, w, n3)
    ctx1: DataFrame         # (c1, m1)   count of c1 as a context
    ctx2: DataFrame         # (c2, c1, m2)
    total: int
    vocab_size: int
    lambdas: tuple = (0.5, 0.3, 0.15, 0.05)
    best3: DataFrame | None = None   # (c2, c1, pred) arg-max next token per context
    best2: DataFrame | None = None   # (c1, pred2) per last token
    top_w: int = UNK_ID              # overall


def shifted(ids: str, **beside: F.Column) -> F.Column:
    """One struct per predicted position of an array of two ids or more: ``pos`` (from 1), the target ``w``, and what stands
    beside it in arrays of as many elements.  Slices are zipped in generated code; a lambda per position is not."""
    n = F.size(ids) - 1
    columns = {"pos": F.sequence(F.lit(1), n), **beside, "w": F.slice(ids, F.lit(2), n)}
    return F.explode_outer(F.arrays_zip(*[c.alias(name) for name, c in columns.items()]))


def target_positions(encoded: DataFrame, keys, ids: str = "ids") -> DataFrame:
    """One row per predicted position: ``(*keys, pos, c2, c1, w)`` (pos >= 1; c2 = BOS before the start).

    The triples are built inside the array (one pass per row) and then
    exploded, so no output row carries its whole sequence.
    """
    keys, n = list(keys), F.size(ids) - 1
    trip = shifted(ids, c2=F.slice(F.concat(F.array(F.lit(BOS_ID)), F.col(ids)), F.lit(1), n), c1=F.slice(ids, F.lit(1), n))
    return (encoded.where(F.size(ids) > 1).select(*keys, trip.alias("t"))
            .select(*keys, "t.pos", "t.c2", "t.c1", "t.w"))


def train_ngram_lm(encoded: DataFrame, keys, vocab_size: int, ids: str = "ids",
                   lambdas=(0.5, 0.3, 0.15, 0.05)) -> NgramLm:
    """N-gram and context counts of the training sequences, and the arg-max tables, settled once."""
    t = target_positions(encoded, keys, ids)
    tri = settled(t.groupBy("c2", "c1", "w").agg(F.count(F.lit(1)).alias("n3")))
    bi = settled(tri.groupBy("c1", "w").agg(F.sum("n3").alias("n2")))
    uni = settled(bi.groupBy("w").agg(F.sum("n2").alias("n1")))
    ctx1 = settled(bi.groupBy("c1").agg(F.sum("n2").alias("m1")))
    ctx2 = settled(tri.groupBy("c2", "c1").agg(F.sum("n3").alias("m2")))
    total = scalar_row(uni.agg(F.sum("n1").alias("t")))["t"] or 0
    lm = NgramLm(uni, bi, tri, ctx1, ctx2, int(total), vocab_size, tuple(lambdas))
    best3, best2, lm.top_w = argmax_tables(lm)
    lm.best3, lm.best2 = settled(best3), settled(best2.withColumnRenamed("pred", "pred2"))
    return lm


def _prob(lm: NgramLm) -> F.Column:
    l3, l2, l1, l0 = lm.lambdas
    p3 = F.when(F.col("m2") > 0, F.coalesce(F.col("n3"), F.lit(0)) / F.col("m2")).otherwise(0.0)
    p2 = F.when(F.col("m1") > 0, F.coalesce(F.col("n2"), F.lit(0)) / F.col("m1")).otherwise(0.0)
    p1 = F.coalesce(F.col("n1"), F.lit(0)) / F.lit(float(max(lm.total, 1)))
    return F.lit(l3) * p3 + F.lit(l2) * p2 + F.lit(l1) * p1 + F.lit(l0 / lm.vocab_size)


def argmax_tables(lm: NgramLm) -> tuple[DataFrame, DataFrame, int]:
    """Arg-max next token per trigram context, per bigram context, and overall.

    For context (c2, c1) the score of w is l3*p3 + l2*p2 + l1*p1 (+ const).
    Words that never followed (c2, c1) score l2*p2 + l1*p1, which does not
    depend on c2; their best is computed once per c1.  So the arg-max is the
    best of the trigram followers and that per-c1 winner; no context is ever
    paired with the whole vocabulary.  Where the winner also followed, its score
    there is no lower, so it needs no second look among the followers.  Ties go to the smaller id.
    What depends on (c1, w) alone is put together before it meets the trigrams.
    """
    l3, l2, l1, _ = lm.lambdas
    tot = float(max(lm.total, 1))
    top1 = lm.uni.orderBy(F.desc("n1"), F.asc("w")).first()
    top_w = int(top1["w"]) if top1 else UNK_ID
    top_s = (l1 * top1["n1"] / tot) if top1 else 0.0
    b = lm.bi.join(lm.ctx1, "c1").join(lm.uni, "w")
    b = b.select("c1", "w", (F.lit(l2) * F.col("n2") / F.col("m1")).alias("b"), (F.lit(l1) * F.col("n1") / F.lit(tot)).alias("u"))
    first = lambda s: F.max(F.struct(s.alias("s"), (-F.col("w")).alias("w"))).alias("t")
    after1 = b.select("c1", "w", (F.col("b") + F.col("u")).alias("s")) \
        .unionByName(lm.ctx1.select("c1", F.lit(top_w).alias("w"), F.lit(top_s).alias("s")))
    best2 = settled(after1.groupBy("c1").agg(first(F.col("s"))).select("c1", (-F.col("t.w")).alias("w2"), F.col("t.s").alias("s2")))
    t = lm.tri.join(b, ["c1", "w"]).join(lm.ctx2, ["c2", "c1"])
    t = t.groupBy("c2", "c1").agg(first(F.lit(l3) * F.col("n3") / F.col("m2") + F.col("b") + F.col("u"))) \
        .select("c2", "c1", (-F.col("t.w")).alias("w"), F.col("t.s").alias("s"))
    wins = (F.col("s2") > F.col("s")) | (F.col("s2") == F.col("s")) & (F.col("w2") < F.col("w"))
    best3 = t.join(bounded_broadcast(best2, lm.vocab_size, 24), "c1") \
        .select("c2", "c1", F.when(wins, F.col("w2")).otherwise(F.col("w")).alias("pred"))
    return best3, best2.select("c1", F.col("w2").alias("pred")), top_w


def score_triples(triples: DataFrame, lm: NgramLm) -> DataFrame:
    """``(c2, c1, w, logp, pred)`` for distinct triples: score and prediction depend on nothing else.

    Tables of one key are joined before they meet the triples, and tables of
    one row per word are broadcast under the byte bound.
    """
    pair = lm.ctx2.join(lm.best3, ["c2", "c1"], "left")
    last = bounded_broadcast(lm.ctx1.join(lm.best2, "c1", "left"), lm.vocab_size, 24)
    word = bounded_broadcast(lm.uni, lm.vocab_size, 16)
    j = (triples.join(lm.tri, ["c2", "c1", "w"], "left").join(lm.bi, ["c1", "w"], "left").join(pair, ["c2", "c1"], "left")
         .join(last, "c1", "left").join(word, "w", "left"))
    return j.select("c2", "c1", "w", F.ln(_prob(lm)).alias("logp"), F.coalesce("pred", "pred2", F.lit(lm.top_w)).alias("pred"))


def score_lm(positions: DataFrame, lm: NgramLm, keys, scored: DataFrame | None = None) -> DataFrame:
    """Log-probability of each target and the arg-max prediction at each position.

    Every distinct triple is scored once (``scored`` passes a prepared table)
    and joined back to its positions.
    """
    scored = score_triples(positions.select("c2", "c1", "w").distinct(), lm) if scored is None else scored
    return positions.join(scored, ["c2", "c1", "w"]).select(*keys, "pos", F.col("w").alias("target"), "logp", "pred")


def lm_metrics(scored: DataFrame, pad_id: int = PAD_ID, by=(), weight: str | None = None) -> DataFrame:
    """Token-weighted loss over non-pad targets, perplexity (inf when loss >= 20), accuracy, per ``by``.

    ``weight`` names a count column when rows stand for several positions.
    """
    s = scored.where(F.col("target") != pad_id)
    n = F.col(weight) if weight else F.lit(1)
    agg = s.groupBy(*by).agg(F.sum(-F.col("logp") * n).alias("tl"), F.coalesce(F.sum(n), F.lit(0)).alias("nt"),
                             F.sum(F.when(F.col("pred") == F.col("target"), n).otherwise(0)).alias("nc"))
    loss = F.coalesce(F.col("tl") / F.greatest(F.col("nt"), F.lit(1)), F.lit(0.0))
    return agg.select(*by, loss.alias("loss"),
                      F.when(loss < 20, F.exp(loss)).otherwise(float("inf")).alias("perplexity"),
                      (F.coalesce(F.col("nc"), F.lit(0)) / F.greatest(F.col("nt"), F.lit(1))).alias("accuracy"),
                      F.col("nt").cast("long").alias("n_tokens"))


# ------------------------------------------------------------------ BLEU

@F.pandas_udf(T.ArrayType(T.LongType()))
def clipped_matches(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """Per row, for n = 1 to 4, the n-grams that two token arrays share as multisets."""
    def row(h, r):
        h, r = ([] if x is None else list(x) for x in (h, r))
        out = []
        for n in (1, 2, 3, 4):
            here, there = (Counter(zip(*(x[i:] for i in range(n)))) for x in (h, r))
            out.append(sum(min(c, there[g]) for g, c in here.items() if g in there))
        return out

    return pd.Series([row(h, r) for h, r in zip(hyp, ref)])


def bleu(df: DataFrame, ref: str, hyp: str, key: str, tokens: bool = False) -> DataFrame:
    """Sentence BLEU-4 per row, uniform weights, smoothing method 4 (k = 5).

    p_n = clipped / max(1, len_h - n + 1); no unigram match -> 0; a zero p_n
    with len_h > 1 becomes ln(len_h) / (5 * 2^j) / denominator, j counting the
    zero orders; zero orders left out of the log sum; brevity penalty 1 when
    len_h > len_r else exp(1 - len_r / len_h).  Empty sides score 0.
    The n-gram multisets of a row are compared inside the row, so nothing is shuffled.
    ``tokens``: the columns are token arrays already.
    """
    words = F.col if tokens else whitespace_tokens
    t = df.select(key, words(ref).alias("r"), words(hyp).alias("h"))
    j = t.select(key, F.size("h").alias("lh"), F.size("r").alias("lr"), clipped_matches("h", "r").alias("m"))
    j = j.select(key, "lh", "lr", *[F.col("m")[n - 1].alias(str(n)) for n in (1, 2, 3, 4)])
    lh = F.col("lh")
    ps, zero_seen = [], F.lit(0)
    for n in (1, 2, 3, 4):
        num = F.coalesce(F.col(str(n)), F.lit(0)).cast("double")
        den = F.greatest(lh - n + 1, F.lit(1)).cast("double")
        is_zero = num == 0
        j_count = zero_seen + F.when(is_zero, 1).otherwise(0)
        smoothed = F.when(is_zero & (lh > 1), F.log(lh.cast("double")) / (F.lit(5.0) * F.pow(F.lit(2.0), j_count)) / den)
        ps.append(F.when(~is_zero, num / den).otherwise(smoothed))
        zero_seen = j_count
    logsum = sum((F.when(p > 0, F.log(p) * 0.25).otherwise(0.0) for p in ps), F.lit(0.0))
    bp = F.when(lh > F.col("lr"), 1.0).otherwise(F.exp(1 - F.col("lr") / lh))
    score = F.when((lh == 0) | (F.col("lr") == 0), 0.0) \
        .when(F.coalesce(F.col("1"), F.lit(0)) == 0, 0.0).otherwise(bp * F.exp(logsum))
    return j.select(key, score.alias("bleu"))


def lm_report(positions: DataFrame, scored: DataFrame, vocab: LmVocab, key: str, split: str = "split") -> DataFrame:
    """``(split, metric, value)``: loss, perplexity, accuracy, tokens and mean BLEU of the predictions, per split.

    Metrics come from distinct triples with counts.  For BLEU, predictions and
    targets meet in one join of the positions with the scored triples.  Ids are
    compared, not words: each id from 0 to the vocabulary's size has a spelling
    of its own, and any other is <UNK>.  All splits go through at once.
    """
    triples = positions.groupBy(split, "c2", "c1", "w").agg(F.count(F.lit(1)).alias("n")).join(scored, ["c2", "c1", "w"])
    metrics = lm_metrics(triples.withColumnRenamed("w", "target"), by=[split], weight="n")
    out = metrics.selectExpr(split, "stack(4, 'loss', loss, 'perplexity', perplexity, 'accuracy', accuracy, "
                             "'n_tokens', CAST(n_tokens AS DOUBLE)) AS (metric, value)")
    both = score_lm(positions, None, [split, key], scored)
    silent = lambda c: F.col(c).isin(BOS_ID, EOS_ID, PAD_ID)
    spoken = lambda c: F.when(F.col(c).between(0, len(vocab) - 1), F.col(c)).otherwise(UNK_ID)
    side = lambda c: F.transform(F.array_sort(F.collect_list(F.when(
        ~silent(c), F.struct("pos", spoken(c).alias("t"))))), lambda x: x["t"])
    texts = settled(both.groupBy(split, key).agg(side("pred").alias("hyp"), side("target").alias("ref")))
    score = bleu(texts.select(F.struct(split, key).alias("id"), "hyp", "ref"), "ref", "hyp", "id", tokens=True)
    return out.unionByName(score.groupBy(F.col("id")[split].alias(split)).agg(F.avg("bleu").alias("value"))
                           .select(split, F.lit("bleu").alias("metric"), "value"))

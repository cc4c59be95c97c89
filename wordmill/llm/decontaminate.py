"""Benchmark decontamination: a distributed positional inverted index and phrase search on it.

The index is partitioned by document, as in a sharded search engine: each row
is one segment with the complete posting lists of some tens of thousands of
documents' tokens.  A search sends the (bounded) blocks of benchmark texts to
the segments, so neither the corpus nor its postings are ever shuffled and no
term, however frequent, gathers in one task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import ALNUM, settle

# Words of one index segment (a longer document gets a segment of its own).
SEGMENT_WORDS = 250_000
# Bytes of benchmark text that are sent to the segments at a time.
BLOCK_BYTES = 16_000_000
# Candidate alignments that a search step holds at a time.
STEP = 1_000_000
# Share of a window's words that a near copy must hold, each within the slop of its place (10 of 13).
NEAR_SHARE = 0.75
# Windows whose words are ranked at a time.
RANKED = 200_000
# Rows of a list of doc_ids that may be broadcast (16 bytes each).
BROADCAST_ROWS = 500_000

INDEX_SCHEMA = ("doc_ids binary, id_null binary, text_keys binary, doc_words binary, terms binary, "
                "term_counts binary, positions binary")
HIT_SCHEMA = ("doc_id bigint, text_key bigint, n_words bigint, n_hit bigint, hit_words binary, "
              "phrases array<struct<item_id: bigint, start: int, end: int>>, near_items array<bigint>")


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased words: maximal runs of ASCII letters, digits and non-ASCII characters."""
    return raw.translate(ALNUM).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Positional inverted index of every whole text, one row per segment.

    Posting lists are stored one after another: ``terms`` (newline-joined),
    ``term_counts`` and the ascending int32 ``positions`` of each term.  The
    texts of a segment follow each other with one free position between them,
    so no phrase spans two texts.  A null text has no words.
    """
    def segment(ids, keys, lengths, words) -> pa.RecordBatch:
        term_of = defaultdict(count().__next__)
        ids_of_words = np.fromiter((term_of[w] for w in words), np.int64, len(words))
        n = np.array(lengths, np.int64)
        position = np.arange(len(words)) + np.repeat(np.arange(len(n)), n)
        postings = np.sort(ids_of_words << 32 | position)
        nulls = np.array([i is None for i in ids])
        cols = [np.array([i or 0 for i in ids], np.int64), nulls, np.array(keys, np.int64), n.astype(np.int32),
                b"\n".join(term_of), np.bincount(ids_of_words, minlength=len(term_of)).astype(np.int32),
                (postings & 0xFFFFFFFF).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([c if isinstance(c, bytes) else c.tobytes()], pa.binary()) for c in cols],
                                          [f.split()[0] for f in INDEX_SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, lengths, words = [], [], [], []
        for b in batches:
            for i, key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                w = words_of(raw.as_buffer().to_pybytes()) if raw.is_valid else []
                if ids and len(words) + len(w) > segment_words:
                    yield segment(ids, keys, lengths, words)
                    ids, keys, lengths, words = [], [], [], []
                ids.append(i)
                keys.append(key)
                lengths.append(len(w))
                words += w
        if ids:
            yield segment(ids, keys, lengths, words)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       text.cast("binary").alias("raw"))
    return rows.mapInArrow(run, INDEX_SCHEMA)


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The benchmark's (item ids, word lists) in blocks of bounded size, read one partition at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"))
    for i, raw in rows.toLocalIterator():
        w = words_of(bytes(raw)) if raw is not None else []
        if w:
            if texts and size + len(raw) > block_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(w)
            size += len(raw)
    if texts:
        yield ids, texts


class Block:
    """One block of benchmark texts laid out for searching: all words in a row, one free slot between texts."""

    def __init__(self, ids: list, texts: list[list[bytes]], window: int):
        term_of = defaultdict(count().__next__)
        length = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(length + 1) - length - 1
        self.words = np.full(int((length + 1).sum()) + window, -1, np.int64)
        for at, t in zip(self.first.tolist(), texts):
            self.words[at:at + len(t)] = [term_of[w] for w in t]
        self.terms = list(term_of)
        self.item_at = np.repeat(np.arange(len(texts)), length + 1)
        self.ids, self.length, self.window = ids, length, window
        self.near = self.near_windows()

    def near_windows(self) -> list[tuple[np.ndarray, int]]:
        """The starts of all windows, by their length."""
        size_of = np.minimum(self.length, self.window)
        return [(np.concatenate([np.arange(f, f + n - size + 1) for f, n in zip(self.first[size_of == size].tolist(), self.length[size_of == size].tolist())]), size)
                for size in np.unique(size_of).tolist()]


def anchors(block: Block, freq: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray | None]]:
    """Positions of the rarest term of each window all of whose terms occur, by window length."""
    for size in np.unique(np.minimum(block.length, block.window)).tolist():
        view = np.lib.stride_tricks.sliding_window_view(freq, size)
        if size == block.window:
            starts = np.flatnonzero(view.min(axis=1) > 0)
        else:
            starts = block.first[block.length == size]
            starts = starts[view[starts].min(axis=1) > 0]
        if len(starts):
            yield starts, size, view[starts].argmin(axis=1)


def search_segment(block: Block, terms, counts, positions, first, n_slots: int, slop: int):
    """Maximal exact occurrences ``(slot, length, item)`` of windows, and near matches ``(slot, item)``, in one segment.

    For each window the posting list of its rarest term gives the candidate
    alignments.  The lists of the neighbouring terms, shifted by their
    offsets, are intersected outwards from it; intersecting an alignment with
    a shifted list is one look-up in the segment's position -> term table,
    which is the posting lists inverted.
    """
    known = {t: i for i, t in enumerate(terms)}
    local = np.array([known.get(t, -3) for t in block.terms] + [-2], np.int64)
    want = local[block.words]  # -2 between texts, -3 for a term that the segment lacks; gaps of term_at are -1
    listed = np.cumsum(counts) - counts
    freq = np.where(want >= 0, counts[np.maximum(want, 0)], 0)
    pad = block.window + 2 * slop
    term_at = np.full(n_slots + 2 * pad, -1, np.int64)
    term_at[positions + pad] = np.repeat(np.arange(len(terms)), counts)
    want = np.r_[np.full(pad, -2), want, np.full(pad, -2)]
    found = []
    for starts, size, rare in anchors(block, freq):
        anchor = np.unique(starts + rare)
        for part in by_weight(anchor, freq[anchor], STEP):
            n = freq[part]
            a = np.repeat(part, n)
            nth = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            p = positions[np.repeat(listed[want[part + pad]], n) + nth]
            reach = np.zeros((2, len(a)), np.int64)
            for side, step in enumerate((-1, 1)):
                alive = np.arange(len(a))
                for k in range(1, size):
                    alive = alive[term_at[p[alive] + pad + step * k] == want[a[alive] + pad + step * k]]
                    if not len(alive):
                        break
                    reach[side, alive] = k
            whole = reach.sum(axis=0) + 1 >= size
            found.append((p[whole] - reach[0, whole], a[whole] - reach[0, whole], reach[:, whole].sum(axis=0) + 1))
    text_at = np.full(n_slots + 2 * pad, -1, np.int64)
    text_at[pad:pad + n_slots] = np.searchsorted(first, np.arange(n_slots), side="right")
    near = [proximity(block, starts, size, freq, want, pad, listed, positions, term_at, text_at, slop) for starts, size in block.near]
    join = lambda parts, i: np.concatenate([x[i] for x in parts]) if parts else np.empty(0, np.int64)
    return maximal(block, *(join(found, i) for i in range(3))), [join(near, i) for i in range(2)]


def maximal(block: Block, slot: np.ndarray, place: np.ndarray, length: np.ndarray):
    """Join matches ``(slot, place in the block, length)`` that overlap on one alignment into maximal ones."""
    if not len(slot):
        return slot, length, slot
    order = np.lexsort((slot, slot - place))
    slot, place, end = slot[order], place[order], (slot + length)[order]
    line = np.cumsum(np.r_[0, np.diff(slot - place) != 0])
    span = int(end.max()) + 1
    reached = np.maximum.accumulate(line * span + end)
    new = np.r_[True, (line[1:] != line[:-1]) | (line[1:] * span + slot[1:] > reached[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(slot) - 1]
    return slot[first], reached[last] - line[last] * span - slot[first], block.item_at[place[first]]


def proximity(block, starts, size, freq, want, pad, listed, positions, term_at, text_at, slop):
    """Near matches ``(slot, item)``: ``NEAR_SHARE`` of a window's words lie within ``slop`` of their places on one alignment, in one text.

    Of the words of a window so many may miss, and one more than these are its
    leads, the rarest of the segment first: a match holds one of them, so every
    alignment is met whichever words were changed, and the result does not
    depend on the segment or the block.  A text and item met once are done.
    """
    need = math.ceil(NEAR_SHARE * size)
    slots, items, seen = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.empty(0, np.int64)
    for i in range(0, len(starts), RANKED):
        begin = starts[i:i + RANKED]
        count_of = np.lib.stride_tricks.sliding_window_view(freq, size)[begin]
        enough = (count_of > 0).sum(axis=1) >= need
        begin, count_of = begin[enough], count_of[enough]
        order = np.argsort(count_of, axis=1, kind="stable")

        def holds(w, at, text, reach):
            """Which alignments (window, slot of its start) hold enough words within ``reach``; the rarest are tried first."""
            misses, alive = np.zeros(len(w), np.int64), np.arange(len(w))
            for k in range(size):
                offset = order[w[alive], k]
                term, place = want[begin[w[alive]] + offset + pad], at[alive] + offset + pad
                hit = np.zeros(len(alive), bool)
                for d in range(-reach, reach + 1):
                    met = np.flatnonzero(term_at[place + d] == term)
                    hit[met] |= text_at[place[met] + d] == text[alive[met]]
                misses[alive] += ~hit
                alive = alive[misses[alive] <= size - need]
            return alive

        for lead in range(size - need + 1):
            offset = order[:, lead]
            n_of = count_of[np.arange(len(begin)), offset]
            for part in by_weight(np.arange(len(begin)), n_of, STEP):
                n = n_of[part]
                w = np.repeat(part, n)
                nth = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
                p = positions[np.repeat(listed[np.maximum(want[begin[part] + offset[part] + pad], 0)], n) + nth].astype(np.int64)
                key = text_at[p + pad] * len(block.ids) + block.item_at[begin[w]]
                keep = np.flatnonzero(~np.isin(key, seen))
                # the lead may itself be out of place by the slop, so others by twice that from it
                keep = keep[holds(w[keep], p[keep] - offset[w[keep]], text_at[p[keep] + pad], 2 * slop)]
                for d in sorted(range(-slop, slop + 1), key=abs):
                    keep = keep[~np.isin(key[keep], seen)]
                    met = keep[holds(w[keep], p[keep] - offset[w[keep]] - d, text_at[p[keep] + pad], slop)]
                    if len(met):
                        slots.append(p[met])
                        items.append(block.item_at[begin[w[met]]])
                        seen = np.union1d(seen, key[met])
    return np.concatenate(slots), np.concatenate(items)


def by_weight(values: np.ndarray, weight: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Split ``values`` into runs of bounded total weight (a single heavier value stays alone)."""
    total = np.cumsum(weight)
    cuts = np.flatnonzero(np.diff(total // most)) + 1
    return (x for x in np.split(values, cuts) if len(x))


def search(index: DataFrame, block: Block, slop: int) -> DataFrame:
    """Matches of one benchmark block in every text of the index (``HIT_SCHEMA``; ``hit_words`` is a bit per word)."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield segment(shared.value, row)

    def segment(block: Block, row: dict) -> pa.RecordBatch:
        words = np.frombuffer(row["doc_words"], np.int32).astype(np.int64)
        first = np.cumsum(words + 1) - words - 1
        slots = int((words + 1).sum())
        terms = row["terms"].split(b"\n") if row["terms"] else []
        (at, length, item), (near_at, near_item) = search_segment(
            block, terms, np.frombuffer(row["term_counts"], np.int32).astype(np.int64),
            np.frombuffer(row["positions"], np.int32), first, slots, slop) if terms else ([np.empty(0, np.int64)] * 3, [np.empty(0, np.int64)] * 2)
        doc = np.searchsorted(first, at, side="right") - 1
        turn = np.zeros(slots + 1, np.int64)
        np.add.at(turn, at, 1)
        np.add.at(turn, at + length, -1)
        hit = np.cumsum(turn) > 0
        total = np.r_[0, np.cumsum(hit)]
        n_hit = total[first + words] - total[first]
        bits = [np.packbits(hit[f:f + n]).tobytes() if h else b"" for f, n, h in zip(first.tolist(), words.tolist(), n_hit.tolist())]
        phrases = [[] for _ in words]
        spans = np.unique(np.stack([doc, item, at - first[doc], at - first[doc] + length], axis=1), axis=0) if len(at) else np.empty((0, 4), int)
        for d, i, s, e in spans.tolist():
            phrases[d].append({"item_id": block.ids[i], "start": s, "end": e})
        near = [[] for _ in words]
        pairs = np.unique(np.stack([np.searchsorted(first, near_at, side="right") - 1, near_item], axis=1), axis=0) if len(near_at) else np.empty((0, 2), int)
        for d, i in pairs.tolist():
            near[d].append(block.ids[i])
        ids = pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=np.frombuffer(row["id_null"], bool))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(np.frombuffer(row["text_keys"], np.int64)), pa.array(words), pa.array(n_hit), pa.array(bits, pa.binary()),
             pa.array(phrases, pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(near, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "n_words", "n_hit", "hit_words", "phrases", "near_items"])

    return index.mapInArrow(run, HIT_SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 3, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  segment_words: int = SEGMENT_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_words, n_hit, phrases, near_items``.

    ``phrases`` are the exact occurrences (word offsets) of item windows of
    ``window`` words, or of a whole shorter item; ``n_hit`` counts the words
    inside any of them.  ``near_items`` are proximity matches of any of an
    item's windows (see ``proximity``).  A benchmark
    that fits one block needs one pass.  A larger one is searched block by
    block over the stored index, and the blocks' hit bits are merged by row.
    Null texts and items have no words; a null item_id still marks hits.  An
    empty benchmark leaves every count at 0.
    """
    index = build_index(docs, id_col, text_col, segment_words)
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    parts, following = [], next(blocks, ([], []))
    while following is not None:
        block, following = Block(*following, window), next(blocks, None)
        if following is None and not parts:
            return search(index, block, slop).drop("hit_words")
        if not parts:
            index = settle(index)
        parts.append(settle(search(index, block, slop)))
    spark = docs.sparkSession
    merge = F.udf(lambda bits: int(np.unpackbits(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in bits])).sum()) if bits else 0, "bigint")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # a row that occurs several times occurs as often in every block, with equal hits
    whole = every.groupBy("doc_id", "text_key", "n_words").agg(
        (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
        F.collect_set(F.when(F.length("hit_words") > 0, F.col("hit_words"))).alias("bits"),
        F.array_distinct(F.flatten(F.collect_list("phrases"))).alias("phrases"),
        F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"))
    return (whole.select("doc_id", "text_key", "n_words", merge("bits").alias("n_hit"), "phrases", "near_items",
                         F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy"))


def contaminated(hits: DataFrame, share: int = 20) -> F.Column:
    """True where at least one in ``share`` words, and one at all, lies in a benchmark window."""
    return (hits["n_hit"] > 0) & (hits["n_hit"] * share >= hits["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows, columns as they were."""
    hits = contamination(docs, benchmark, **options)
    bad = settle(hits.where(contaminated(hits)).select(F.col("doc_id").alias("bad_id"), "text_key").distinct())
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["text_key"]), "left_anti")

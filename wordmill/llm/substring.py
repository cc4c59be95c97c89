"""Substring dedup: repeated word windows found with prefix-partitioned suffix trees.

A window is ``L`` consecutive words.  Shipping every suffix's own ``L`` words
would cost ``L`` times the corpus, so suffixes travel in spans: each suffix
belongs to its anchor, the lowest-hashing ``k`` words inside its first ``L``,
and consecutive suffixes with the same anchor share one span of text.  Equal
windows have the same anchor, hence meet in the same partition.  There, the
suffixes whose window occurs more than once are split by variable-length word
prefixes into groups of bounded size, and each group's suffix tree (sorted
suffixes and their common-prefix lengths) is built in memory; its internal
nodes of depth ``L`` are the repeats.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import settle, text_blocks

# Words of the anchor; longer anchors occur less often but share fewer suffixes.
ANCHOR = 4
# Words that a map task gathers before it ships its spans, and bytes of text that it cuts into words at a time.
BATCH_WORDS, CUT_BYTES = 1_000_000, 1 << 21
# Windows that are given their anchors at a time, at most 2^24 with the words they end in.
SLICE_WORDS = 1 << 23
# An anchor is hot if it leads more than this share of a partition's spans; counted in one of so many documents.
HOT_SHARE, HOT_SAMPLE = 0.1, 50
# Occurrences in the sample that an anchor needs at least to be hot.
HOT_LEAST = 20
# Bytes of text that a partition of spans, and a bucket of documents in the last step, stand for.
PARTITION_BYTES = 8_000_000
# Bytes of text that a map task packs into blocks by bucket.
PACK_BYTES = 12_000_000
# Suffixes of one subtree.
SUBTREE = 200_000
# Suffix occurrences that are resolved at a time.
STEP = 1_000_000

NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id, and sorts after every other
# bytes.translate table that makes every separator of words a newline
NEWLINES = bytes(10 if b == 32 or 9 <= b <= 13 else b for b in range(256))
ODD = 0x9E3779B97F4A7C15
ODD_INVERSE = pow(ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Sums:
    """Polynomial fingerprints (mod 2^64) of any slices of a row of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(ODD, len(values)), out=self.total[1:])
        self.undo = powers(ODD_INVERSE, len(values) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.undo[start] + (end - start).astype(np.uint64))


def expand(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] values), then the same from start[1], and so on."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


def anchored_spans(hashes: np.ndarray, doc: np.ndarray, window: int, k: int):
    """Spans of the windows of one batch: first word, number of windows and anchor hash of each.

    A key holds a word's place in 24 bits, so longer batches (a single long
    text) are taken in overlapping slices; a window lies in one of them.
    """
    found = [spans_of_slice(hashes[lo:lo + SLICE_WORDS + window - 1], doc[lo:lo + SLICE_WORDS + window - 1], window, k)
             for lo in range(0, max(1, len(hashes) - window + 1), SLICE_WORDS)]
    start = [f[0] + i * SLICE_WORDS for i, f in enumerate(found)]
    return np.concatenate(start), np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])


def spans_of_slice(hashes: np.ndarray, doc: np.ndarray, window: int, k: int):
    n = len(hashes)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    gram = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        gram = gram * np.uint64(ODD) + hashes[i:n - k + 1 + i]
    gram = mix(gram)
    low = np.uint64((1 << 24) - 1)
    key = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)  # ties go to the leftmost
    width, best, have = window - k + 1, key, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:len(best) - step], best[step:])
        have += step
    starts = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    anchor = (best[starts] & low).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)] if len(starts) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.r_[first, len(starts)]), gram[anchor[first]]


def pack(**parts) -> bytes:
    """Arrays and bytes, compressed; arrays are stored by byte plane, which suits small numbers."""
    flat = {k: v if isinstance(v, bytes) else (v.dtype.str, np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.dtype.itemsize).T.tobytes())
            for k, v in parts.items()}
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(flat))


def unpack(blob: bytes) -> dict:
    return {k: v if isinstance(v, bytes) else
            np.ascontiguousarray(np.frombuffer(v[1], np.uint8).reshape(np.dtype(v[0]).itemsize, -1).T).view(v[0]).reshape(-1) if v[1] else np.empty(0, v[0])
            for k, v in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)).items()}


def first_seen(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (below ``n``) by first appearance, and codes for all: 0 for a new one, else its number plus 1."""
    place = np.arange(len(values))
    held = np.empty(n, np.int64)
    held[values[::-1]] = place[::-1]  # of equal places the last assignment stays, which is the first appearance
    new = held[values] == place
    names = values[new]
    held[names] = np.arange(1, len(names) + 1)
    return names, np.where(new, 0, held[values])


def numbers_seen(codes: np.ndarray) -> np.ndarray:
    """The numbers that ``first_seen`` coded."""
    new = codes == 0
    return np.where(new, np.cumsum(new) - 1, codes.astype(np.int64) - 1)


def lines(content: np.ndarray) -> pa.LargeBinaryArray:
    """The words of bytes that hold a newline after each; a value keeps its newline."""
    offsets = np.r_[0, np.flatnonzero(content == 10) + 1]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(content)])


def line_bytes(words: pa.LargeBinaryArray) -> bytes:
    """The words, joined by newlines."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    return words.buffers()[2][int(offsets[0]):int(offsets[-1]) - 1].to_pybytes() if len(words) else b""


def cut_words(texts: list[bytes]) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """The number of words of each text, and all words (each with a newline) in one array."""
    content = np.frombuffer((b"\n".join(texts) + b"\n").translate(NEWLINES), np.uint8)
    gap = content == 10
    ends = gap.copy()
    ends[0] = False
    ends[1:] &= ~gap[:-1]  # the first separator after a word
    after = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return np.diff(np.searchsorted(np.flatnonzero(ends), after), prepend=0), lines(content[~gap | ends])


def ship_batch(ids, keys, length, words, window, k, partitions, hot=()) -> Iterator[tuple[int, bytes]]:
    """The spans of one batch of documents, equal ones once, as one block per partition.

    ``words`` holds the words of all documents, ``length`` how many each has.

    The spans of hot anchors are cut into their windows, which are dealt by
    all their words: equal windows still meet, and others part.
    """
    coded = words.dictionary_encode()
    word, vocabulary = coded.indices.to_numpy(), coded.dictionary
    doc = np.repeat(np.arange(len(length)), length)
    doc_first = np.cumsum(length) - length
    hash_of = np.fromiter(map(xxhash.xxh64_intdigest, line_bytes(vocabulary).split(b"\n")), np.uint64, len(vocabulary))
    hashes = hash_of[word]
    start, n_windows, anchor = anchored_spans(hashes, doc, window, k)
    if not len(start):
        return
    sums = Sums(hashes)
    if len(hot):
        often = np.isin(anchor, hot)
        alone = expand(start[often], n_windows[often])
        start, n_windows = np.r_[start[~often], alone], np.r_[n_windows[~often], np.ones(len(alone), np.int64)]
        anchor = np.r_[anchor[~often], sums.of(alone, alone + window)]
    size = n_windows + window - 1
    _, first, inverse = np.unique(sums.of(start, start + size), return_index=True, return_inverse=True)
    same = first[inverse]
    # equal fingerprints are checked word by word, so that only equal spans are merged
    merged = np.flatnonzero(same != np.arange(len(same)))
    like = merged[size[same[merged]] == size[merged]]
    unequal = word[expand(start[like], size[like])] != word[expand(start[same[like]], size[like])]
    differ = np.union1d(merged[size[same[merged]] != size[merged]], np.repeat(like, size[like])[unequal])
    same[differ] = differ
    part = (mix(anchor) % np.uint64(partitions)).astype(np.int64)
    order = np.lexsort((np.arange(len(same)), same, part))
    cuts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(order)]):
        rows = order[lo:hi]
        span = same[rows]
        lead = np.flatnonzero(np.r_[True, span[1:] != span[:-1]])
        at = span[lead]
        used, codes = first_seen(word[expand(start[at], size[at])], len(vocabulary))
        docs, owner = np.unique(doc[start[rows]], return_inverse=True)
        yield int(part[rows[0]]), pack(
            dictionary=line_bytes(vocabulary.take(pa.array(used))), words=codes.astype(np.uint32),
            size=size[at].astype(np.uint16), copies=np.diff(np.r_[lead, len(rows)]).astype(np.uint32),
            owner=owner.astype(np.uint32), begin=(start[rows] - doc_first[doc[start[rows]]]).astype(np.uint32),
            doc_step=np.diff(ids[docs], prepend=0), doc_keys=keys[docs])


def hot_anchors(docs: DataFrame, window: int, k: int, partitions: int) -> np.ndarray:
    """Anchors that lead more than ``HOT_SHARE`` of a partition's spans, as one in ``HOT_SAMPLE`` documents shows.

    This only decides how spans are dealt; whatever the sample, the results
    are the same.  No more than ``partitions / HOT_SHARE`` anchors can be hot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                words = raw.as_py().split()
                if len(words) >= window:
                    names, word = np.unique(np.array(words, object), return_inverse=True)
                    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))[word]
                    anchor, n = np.unique(anchored_spans(hashes, np.zeros(len(word), np.int64), window, k)[2], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], ["anchor", "n"])

    sample = docs.where((F.pmod(F.xxhash64("doc_id", "raw"), F.lit(HOT_SAMPLE)) == 0) & F.col("raw").isNotNull()).select("raw")
    counts = sample.mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    counts = settle(counts)
    spans = counts.agg(F.sum("n")).first()[0] or 0
    least = max(HOT_LEAST, HOT_SHARE * spans / partitions)
    return np.array([r["anchor"] for r in counts.where(F.col("n") > least).collect()], np.int64).view(np.uint64)


def ship_spans(docs: DataFrame, window: int, k: int, partitions: int, hot=()) -> DataFrame:
    """``(part, block)`` rows with the spans of all documents; ``docs`` is (doc_id, text_key, raw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            documents = (np.concatenate(x) for x in zip(*((i, k, n) for i, k, n, _ in held)))
            rows = list(ship_batch(*documents, pa.concat_arrays([w for *_, w in held]), window, k, partitions, hot))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["part", "block"])

        held, total = [], 0
        for b in batches:
            raws = b.column(2)
            ids, keys = (b.column(c).fill_null(NO_ID).to_numpy(zero_copy_only=False) for c in (0, 1))
            size = pc.fill_null(pc.binary_length(raws), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in text_blocks(np.r_[0, np.cumsum(size)], CUT_BYTES):
                n, words = cut_words([raw or b"" for raw in raws[lo:hi].to_pylist()])
                if total and total + len(words) > BATCH_WORDS:
                    yield flush()
                    held, total = [], 0
                held.append((ids[lo:hi], keys[lo:hi], n, words))
                total += len(words)
        if total:
            yield flush()

    return docs.mapInArrow(run, "part bigint, block binary")


def prefix_groups(suffix: np.ndarray, most: int) -> np.ndarray:
    """Group of each suffix by a variable-length prefix: lengthened word by word while its group is larger than ``most``."""
    group = np.unique(suffix[:, 0], return_inverse=True)[1]
    for depth in range(1, suffix.shape[1]):
        large = np.bincount(group)[group] > most
        if not large.any():
            break
        key = group.astype(np.int64) << 32 | np.where(large, suffix[:, depth].astype(np.int64) + 1, 0)
        group = np.unique(key, return_inverse=True)[1]
    return group


def subtree_repeats(suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in lexical order, and where each node of full depth begins among them.

    Sorted suffixes and the common prefix of neighbours are a suffix tree's
    leaves and the depths of its internal nodes; neighbours that agree on the
    whole window hang below one node of depth ``L``.
    """
    order = np.lexsort(suffix.T[::-1])
    ranked = suffix[order]
    common = np.r_[0, np.argmin(np.c_[ranked[1:] == ranked[:-1], np.zeros(len(ranked) - 1, bool)], axis=1)]
    return order, np.flatnonzero(common < suffix.shape[1])


def resolve(blocks: list[bytes], window: int, subtree: int = SUBTREE):
    """Windows to remove in one partition: arrays (doc_id, text_key, first word), one entry per window occurrence."""
    dictionaries, words, sizes, copies, owners, begins, ids, keys, terms, docs = [], [], [], [], [], [], [], [], 0, 0
    for blob in blocks:
        b = unpack(blob)
        dictionaries.append(b["dictionary"])
        local = numbers_seen(b["words"])
        words.append((local + terms).astype(np.int32))
        terms += int(local.max()) + 1
        sizes.append(b["size"].astype(np.int64))
        copies.append(b["copies"].astype(np.int64))
        owners.append(b["owner"].astype(np.int64) + docs)
        begins.append(b["begin"].astype(np.int64))
        ids.append(np.cumsum(b["doc_step"]))
        keys.append(b["doc_keys"])
        docs += len(ids[-1])
    words, size, copies, owner, begin, ids, keys = map(np.concatenate, (words, sizes, copies, owners, begins, ids, keys))
    dictionaries.append(b"")
    coded = lines(np.frombuffer(b"\n".join(dictionaries), np.uint8)).dictionary_encode()
    words = coded.indices.to_numpy()[words]
    n_terms = len(coded.dictionary)
    del dictionaries, coded
    span_at = np.cumsum(size) - size
    n = size - window + 1
    window_at = expand(span_at, n)  # first word of every window of every distinct span
    first_copy = np.cumsum(copies) - copies
    span_low = np.minimum.reduceat(ids[owner], first_copy)
    low = np.repeat(span_low, n)
    names = Sums(mix(np.arange(1, n_terms + 1, dtype=np.uint64))[words]).of(window_at, window_at + window)
    order = np.argsort(names)
    again = names[order[1:]] == names[order[:-1]]
    repeated = np.sort(order[np.r_[again, False] | np.r_[False, again]]) if len(order) else order
    del names, order, again
    if len(repeated):
        # suffixes go to their subtrees a slice of first words at a time, so that few are held with all their words
        lead = np.argsort(words[window_at[repeated]], kind="stable")
        repeated = repeated[lead]
        head = words[window_at[repeated]]
        begins_word = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
        for lo, hi in slices(begins_word, len(head), 4 * subtree):
            mine = repeated[lo:hi]
            suffix = words[window_at[mine][:, None] + np.arange(window)]
            group = prefix_groups(suffix, subtree)
            by = np.argsort(group, kind="stable")
            edges = np.flatnonzero(np.r_[True, group[by][1:] != group[by][:-1]])
            for a, b in slices(edges, len(by), subtree):
                leaf = by[a:b]
                order, nodes = subtree_repeats(suffix[leaf])
                members = mine[leaf[order]]
                least = np.minimum.reduceat(low[members], nodes)
                low[members] = np.repeat(least, np.diff(np.r_[nodes, len(members)]))
    window_of_span = np.cumsum(n) - n
    out = []
    span = np.repeat(np.arange(len(size)), copies)
    changed = np.bitwise_or.reduceat(low < np.repeat(span_low, n), window_of_span)
    todo = np.flatnonzero((ids[owner] > span_low[span]) | changed[span])
    for part in np.array_split(todo, 1 + int(n[span[todo]].sum()) // STEP):
        if not len(part):
            continue
        s, m = span[part], n[span[part]]
        occurrence = np.repeat(part, m)
        offset = expand(np.zeros(len(m), np.int64), m)
        gone = low[np.repeat(window_of_span[s], m) + offset] < ids[owner[occurrence]]
        occurrence = occurrence[gone]
        out.append((ids[owner[occurrence]], keys[owner[occurrence]], begin[occurrence] + offset[gone]))
    return [np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in range(3)]


def slices(edges: np.ndarray, end: int, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole groups (beginning at ``edges``) of about ``most`` members; one larger group stays alone."""
    lo = 0
    stops = np.r_[edges[1:], end]
    while lo < end:
        i = np.searchsorted(stops, lo + most, side="right") - 1
        hi = int(stops[i]) if i >= 0 and stops[i] > lo else int(stops[np.searchsorted(stops, lo, side="right")])
        yield lo, hi
        lo = hi


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def repeated_windows(blocks: DataFrame, window: int, buckets: int, subtree: int) -> DataFrame:
    """``(bucket, runs)``: runs of windows to remove, packed per bucket of documents."""
    def run(df: pd.DataFrame) -> pd.DataFrame:
        ids, keys, at = resolve(df["block"].tolist(), window, subtree)
        rows = []
        if len(ids):
            bucket = bucket_of(ids, buckets)
            order = np.lexsort((at, keys, ids, bucket))
            ids, keys, at, bucket = ids[order], keys[order], at[order], bucket[order]
            new = np.r_[True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1)]
            first = np.flatnonzero(new)
            n = np.diff(np.r_[first, len(ids)])
            ids, keys, at, bucket = ids[first], keys[first], at[first], bucket[first]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for lo, hi in zip(cuts, np.r_[cuts[1:], len(ids)]):
                rows.append((bucket[lo], pack(id_step=np.diff(ids[lo:hi], prepend=0), keys=keys[lo:hi],
                                              at=at[lo:hi].astype(np.uint32), n=n[lo:hi].astype(np.uint32))))
        return pd.DataFrame(rows, columns=["bucket", "runs"])

    return blocks.groupBy("part").applyInPandas(run, "bucket bigint, runs binary")


def pack_texts(docs: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, texts)``: the documents dealt by id, compressed in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0

        def flush():
            squeeze = zstandard.ZstdCompressor(level=3).compress
            rows = [(b, squeeze(pickle.dumps(x))) for b, x in held.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "texts"])

        for b in batches:
            ids = b.column(0).to_pylist()
            bucket = bucket_of(np.array([NO_ID if i is None else i for i in ids], np.int64), buckets).tolist()
            for at, i, key, raw in zip(bucket, ids, b.column(1).to_pylist(), b.column(2).to_pylist()):
                held[at].append((i, key, raw or b""))
                size += len(raw or b"")
                if size >= PACK_BYTES:
                    yield flush()
                    held, size = defaultdict(list), 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket bigint, texts binary")


def cut_repeats(docs: DataFrame, runs: DataFrame, window: int, buckets: int) -> DataFrame:
    """Remove the covered words of every document."""
    def run(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        marks = [unpack(b) for b in found["runs"]]
        join = lambda f: np.concatenate([f(m) for m in marks]) if marks else np.empty(0, np.int64)
        ids, keys = join(lambda m: np.cumsum(m["id_step"])), join(lambda m: m["keys"])
        at, n = join(lambda m: m["at"].astype(np.int64)), join(lambda m: m["n"].astype(np.int64))
        order = np.lexsort((at, keys, ids))
        ids, keys, at, n = ids[order], keys[order], at[order], n[order]
        out = []
        for blob in texts["texts"]:
            for i, key, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
                words = raw.split()
                name = NO_ID if i is None else i
                lo, hi = np.searchsorted(ids, name, "left"), np.searchsorted(ids, name, "right")
                lo, hi = lo + np.searchsorted(keys[lo:hi], key, "left"), lo + np.searchsorted(keys[lo:hi], key, "right")
                turn = np.zeros(len(words) + 1, np.int64)
                np.add.at(turn, at[lo:hi], 1)
                np.add.at(turn, at[lo:hi] + n[lo:hi] + window - 1, -1)
                gone = np.cumsum(turn)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if len(edge) else words)
                out.append((i, key, len(words), int(gone.sum()), kept.decode("utf-8", "replace"),
                            [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]))
        df = pd.DataFrame(out, columns=["doc_id", "text_key", "n_words", "n_removed", "kept", "removed"])
        df["doc_id"] = df["doc_id"].astype("Int64")
        return df

    return pack_texts(docs, buckets).groupBy("bucket").cogroup(runs.groupBy("bucket")).applyInPandas(
        run, "doc_id bigint, text_key bigint, n_words bigint, n_removed bigint, kept string, removed array<struct<start: int, end: int>>")


def dedup_substrings(docs: DataFrame, window: int = 13, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
                     partition_bytes: int = PARTITION_BYTES, subtree: int = SUBTREE) -> DataFrame:
    """``(doc_id, text_key, n_words, n_removed, kept, removed)`` of every row of ``docs``.

    A word is removed where a window of ``window`` words covers it that also
    starts in a document of smaller doc_id; ``removed`` lists the maximal
    removed passages as word offsets, ``kept`` is the rest, joined by single
    spaces.  Windows are judged on the whole input.  A null text has no words;
    a null doc_id counts as larger than any other; rows that share a doc_id do
    not remove from each other.  Texts of any length are whole; a text is one
    row and so one task.  An empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    doc_id = F.col(id_col).cast("bigint")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = 1 + total // partition_bytes
    shared = not docs.groupBy(doc_id.alias("id")).count().where(F.col("count") > 1).isEmpty()
    rows = docs.select(doc_id.alias("doc_id"), (F.xxhash64(text) if shared else F.lit(0).cast("bigint")).alias("text_key"),
                       text.cast("binary").alias("raw"))
    hot = hot_anchors(rows, window, anchor, parts)
    runs = repeated_windows(ship_spans(rows, window, anchor, parts, hot), window, parts, subtree)
    return cut_repeats(rows, runs, window, parts)

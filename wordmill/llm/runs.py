"""Periodic runs in word sequences: Lyndon roots from the first phase of a suffix sorter, extended by common extensions."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import byte_buffers, text_blocks

# Bytes of text that one step works on (a longer text is one step by itself).
BYTES_AT_ONCE = 4 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position, by Baier's grouping (CPM 2016, phase one).

    Suffixes start in groups by first symbol.  Groups are taken from the
    highest down.  Each member of the group with prefix u points to the nearest
    position before it that stands in a lower group; there, as many u follow the
    prefix v of that position as members point to it, so its prefix grows to
    v u u ...: such positions move, together, to a new group just above their old
    one.  When a group's turn comes, its prefix is the longest Lyndon word.
    """
    where = defaultdict(list)
    for i, x in enumerate(symbols):
        where[x].append(i)
    members = [set(where[x]) for x in sorted(where)]
    length = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    group = [0] * len(symbols)
    for g, those in enumerate(members):
        for i in those:
            group[i] = g
    free = list(range(len(symbols) + 1))  # position i stands at i + 1; finished ones point to the left
    out = [0] * len(symbols)
    now = len(members) - 1
    while now >= 0:
        size, those = length[now], members[now]
        for i in those:
            out[i] = size
            free[i + 1] = i
        pointed = Counter()
        for i in those:
            while free[i] != i:
                free[i] = i = free[free[i]]
            if i:
                pointed[i - 1] += 1
        moving = defaultdict(list)
        for j, times in pointed.items():
            moving[-times, group[j]].append(j)
        for times, old in sorted(moving):  # more repetitions first: later groups come between them and the old one
            js = moving[times, old]
            if len(js) == len(members[old]):
                length[old] -= times * size
                continue
            members[old].difference_update(js)
            new = len(members)
            members.append(set(js))
            length.append(length[old] - times * size)
            for j in js:
                group[j] = new
            below.append(old)
            above.append(above[old])
            below[above[old]] = new  # the group being taken is above every old one
            above[old] = new
        members[now] = set()
        now = below[now]
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:at + step][:n - at] != b[at:at + step][:n - at]
        if differ.any():
            return at + int(differ.argmax())
        at, step = min(n, at + step), step * 2
    return at


def runs_of(symbols: np.ndarray, least: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of at least ``least`` symbols and two periods.

    Every run has a Lyndon root, under one of the two orders, that is the
    longest Lyndon word at its place (Bannai et al., 2017).
    """
    n, found = len(symbols), set()
    names = np.unique(symbols, return_inverse=True)[1]
    place = np.arange(n)
    for order in (names, -names):
        period = np.array(lyndon_array(order.tolist()), np.int64)
        beyond = np.minimum(place + period, n - 1)
        longer = (place + period < n) & (names[beyond] == names)
        longer[1:] |= names[:-1] == names[(place + period - 1)[1:]]
        done = {}  # period -> the last stretch that has it
        for i in np.flatnonzero(longer).tolist():
            q = int(period[i])
            lo, hi = done.get(q, (0, 0))
            if lo <= i and i + q <= hi:
                continue
            lo = i - common(names[:i][::-1], names[:i + q][::-1])
            hi = i + q + common(names[i:], names[i + q:])
            done[q] = lo, hi
            if hi - lo >= max(least, 2 * q):
                found.add((lo, hi - lo, q))
    return found


def stretches(symbols: np.ndarray, text: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Parts of the sequence that hold all runs; ``text`` numbers the text that each symbol belongs to.

    In a run of period q, the k-gram (k = least / 2) at each place but the
    last q + k - 1 comes again q places on; so all these places, q - k + 1 of
    them or more, have a next equal k-gram at a distance of q at most.  A place whose
    distance exceeds its streak's length plus k - 1 is in no such row, which
    may break the streak; what is left is followed by q + k - 1 places at most.
    """
    k, n = (least + 1) // 2, len(symbols)
    if n < 2 * k:
        return
    size = n - k + 1
    gram = text[:size].astype(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):  # equal hashes of different grams only leave more to look at
            gram = (gram ^ symbols[i:size + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            gram ^= gram >> np.uint64(29)
    order = np.argsort(gram, kind="stable")
    again = gram[order[1:]] == gram[order[:-1]]
    at, distance = order[:-1][again], (order[1:] - order[:-1])[again]
    same = text[at] == text[at + distance + k - 1]
    by_place = np.argsort(at[same], kind="stable")
    at, distance = at[same][by_place], distance[same][by_place]
    while len(at):
        first = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(text[at]) != 0)))
        streak = np.diff(np.append(first, len(at)))
        far = distance > np.repeat(streak, streak) + k - 1
        if not far.any():
            last_of_text = np.searchsorted(text, text[at[first]], "right")
            end = np.minimum(at[first] + 2 * streak + 2 * k - 2, last_of_text)
            lo, hi = int(at[first[0]]), int(end[0])
            for a, b in zip(at[first[1:]].tolist(), end[1:].tolist()):
                if a > hi or text[a] != text[lo]:
                    yield lo, hi
                    lo, hi = a, b
                hi = max(hi, b)
            yield lo, hi
            return
        at, distance = at[~far], distance[~far]


def text_runs(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each word list, by start, then period."""
    name = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    symbols = np.fromiter((name[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    text, first = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
    out = [[] for _ in texts]
    for lo, hi in stretches(symbols, text, least):
        of = int(text[lo])
        out[of] += [(lo - int(first[of]) + start, length, period) for start, length, period in runs_of(symbols[lo:hi], least)]
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)])


def find_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``: the maximal periodic runs of every whole text, and the text without repetitions.

    Words are parted by ASCII white space.  A run is a stretch of at least
    ``least`` words and two periods, by its smallest period, that no neighbouring word extends.  ``runs`` are
    in order of start, then period.  A null or empty text has no words and no
    runs.  Each row stands for itself, so null and repeated ids and repeated
    rows all come back; further columns of any name change nothing.  An empty
    table gives an empty result.  A text is one row and so one task, however long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            offsets, content = byte_buffers(whole.column(1))
            for lo, hi in text_blocks(offsets, BYTES_AT_ONCE):
                bounds = offsets[lo:hi + 1].tolist()
                texts = [content[s:e].tobytes().split() for s, e in zip(bounds, bounds[1:])]
                runs = text_runs(texts, least)
                flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
                struct = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], ["start", "length", "period"])
                ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(ends, struct),
                     pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary())], ["doc_id", "n_words", "runs", "raw"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))
    out = rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, raw binary")
    return out.select("doc_id", "n_words", "runs", F.col("raw").cast("string").alias("collapsed"))


def longest_run(runs: str = "runs") -> F.Column:
    """The longest run (ties: smallest start, then period) as a struct (length, start, period); null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(best.isNotNull(), F.struct(best["length"].alias("length"), (-best["s"]).alias("start"), (-best["p"]).alias("period")))

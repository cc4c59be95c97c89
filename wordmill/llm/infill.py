"""Fill-in-middle: texts cut at code points found by word-parallel (SWAR) rank and select over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import byte_buffers, text_blocks

HIGH, ONES = np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
MARKS = ("<P>", "<S>", "<M>")
# Words of eight bytes worked on at once: 8 MB of text.
WORDS_AT_ONCE = 1 << 20


def u64(x) -> np.uint64:
    return np.uint64(x)


def as_words(raw: np.ndarray) -> np.ndarray:
    """The bytes as little-endian uint64, filled up with bytes that end no unit."""
    words = np.full(len(raw) // 8 + 1, HIGH, "<u8")
    words.view(np.uint8)[:len(raw)] = raw
    return words


def unit_ends(words: np.ndarray, size: int) -> np.ndarray:
    """Bit 7 of each byte that ends a UTF-8 unit: the byte after it starts one (or the text ends there).

    A byte goes on with a unit if bit 7 is set and bit 6 is not; one shift
    brings all eight bits 6 of a word under its bits 7.
    """
    starts = ~(words & ~(words << u64(1))) & HIGH
    following = np.append(starts[1:], u64(0)) << u64(56)
    ends = (starts >> u64(8)) | following
    if size:  # the byte before the filling ends the last unit
        ends[(size - 1) // 8] |= u64(0x80 << 8 * ((size - 1) % 8))
    return ends


def rank(ends: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of units that end in the first ``at`` bytes; ``before`` counts those of all earlier words."""
    word, byte = at // 8, (at % 8).astype(np.uint64)
    low = (u64(1) << (byte * u64(8))) - u64(1)
    return before[word] + np.bitwise_count(ends[word] & low).astype(np.int64)


def select(ends: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Number of bytes that the first ``k`` (1 or more) units take.

    A search in the cumulative counts finds the word.  In it, a product with
    0x0101.. sums the marks up to each byte; the bytes whose sum is still less
    than wanted stand before the unit's end, and are counted at once.
    """
    word = np.searchsorted(before, k, "left") - 1
    sums = (ends[word] >> u64(7)) * ONES
    wanted = (k - before[word]).astype(np.uint64) * ONES
    reached = ((sums | HIGH) - wanted) & HIGH
    return word * 8 + 8 - np.bitwise_count(reached).astype(np.int64) + 1


def cut(raw: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of each text, and the bytes at which its two cuts come: after ``draws % (n + 1)`` units, smaller one first.

    Text i takes the bytes from ``offsets[i]`` to ``offsets[i + 1]`` of ``raw``.
    """
    ends = unit_ends(as_words(raw), len(raw))
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)))
    first = rank(ends, before, offsets)
    n = np.diff(first)
    units = np.sort(draws % (n + 1), axis=0)
    target = first[:-1] + units
    at = np.broadcast_to(offsets[:-1], units.shape).copy()
    some = units > 0
    at[some] = select(ends, before, target[some])
    return n, np.stack([units, at])


def rearranged(text: bytes, form: str, a: int, b: int) -> bytes:
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "plain":
        return text
    return b"<P>" + prefix + b"<S>" + suffix + b"<M>" + middle if form == "psm" else b"<S>" + suffix + b"<P>" + prefix + b"<M>" + middle


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``: every whole text cut into prefix, middle and suffix.

    The draws are the first four 8-digit groups of the SHA-256 of ``1:`` and
    the decimal doc_id, so they depend on nothing but the id: two give the
    cuts (in code points), one keeps ``plain_percent`` of the texts as they
    are, one writes ``spm_percent`` of the others suffix first.  An empty or
    null text, and one that holds a mark itself, stays plain; a null doc_id
    draws as an empty one.  Each row stands for itself, so repeated ids and
    rows all come back, and further columns of any name change nothing.  An
    empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            every, content = byte_buffers(whole.column(1))
            for lo, hi in text_blocks(every, 8 * WORDS_AT_ONCE):
                b, offsets = whole.slice(lo, hi - lo), every[lo:hi + 1]
                raw, offsets = content[offsets[0]:offsets[-1]], offsets - offsets[0]
                drawn = np.stack([b.column(c).to_numpy() for c in (2, 3)])
                n, (units, at) = cut(raw, offsets, drawn)
                held, text = raw.tobytes(), []
                form = np.array([f.as_py() for f in b.column(4)], object)
                for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    text.append(rearranged(held[s:e], form[i], int(at[0, i]) - s, int(at[1, i]) - s))
                plain = form == "plain"
                size = [pa.array(x, pa.int64(), mask=plain) for x in (units[0], units[1] - units[0])]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(form, pa.string()), *size, pa.array(text, pa.binary())],
                                                 ["doc_id", "n", "form", "prefix_chars", "middle_chars", "raw"])

    doc_id, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    kept = (text == "") | (draw[2] % 100 >= 100 - plain_percent)
    for mark in MARKS:
        kept = kept | F.contains(text, F.lit(mark))
    form = F.when(kept, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(doc_id.alias("doc_id"), text.cast("binary").alias("raw"), draw[0].alias("h1"), draw[1].alias("h2"), form.alias("form"))
    out = rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, raw binary")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.col("raw").cast("string").alias("output"))


def restored(output: str = "output", form: str = "form") -> F.Column:
    """The text that ``fill_in_middle`` was given, rebuilt from output and form alone.

    The parts hold no mark, and neither the end of a part nor the start of one
    can complete a mark beside it, so the output parts at its three marks only.
    """
    parts = F.split(F.col(output), "<[PSM]>", -1)
    part = lambda i: F.element_at(parts, i)
    return (F.when(F.col(form) == "psm", F.concat(part(2), part(4), part(3)))
            .when(F.col(form) == "spm", F.concat(part(3), part(4), part(2))).otherwise(F.col(output)))

"""Best-fit packing: tokenised documents into as few sequences of bounded length as best fit finds, in bulk-synchronous rounds."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import settle, shared_folder
from wordmill.session import with_rank

# Chunks and words of which a Python worker remembers the ids (two generations of each; some 250 MB).
REMEMBERED = 500_000
# Open sequences that one task of a round updates.
GAPS_PER_TASK = 500_000
# Texts that one tokenising step holds.
TEXTS_AT_ONCE = 256
# Unicode's white space, which the tokenizer's word pattern parts from all else but one leading space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# A whole run of Latin letters is one unit of the word pattern, whatever follows.
LATIN = re.compile("( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]++)(?![^\\W\\d_])")
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Remembered(dict):
    """A bounded memory of ``make(key)``: when full, what was used since the last time stays as the older generation."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class ByteBpe:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, by a byte-level BPE file of ``tokenizers``.

    A text is cut where the tokenizer's word pattern always cuts, between
    white space and other characters, so the pieces can be encoded apart and
    remembered: texts of any length take memory by their own size only.
    """

    def __init__(self, path: str, most: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their spellings in a text are ordinary text
        self.word = self.tokenizer.model.tokenize
        # Byte-level BPE spells printable bytes as themselves and the n-th other byte as character 256 + n.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.spelling = {b: chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)}
        self.words = Remembered(self.plain, most)
        self.rests = Remembered(self.whole, most)
        self.chunks = Remembered(self.encode, most)

    def plain(self, word: str) -> bytes:
        """Ids of one unit of the word pattern."""
        if word.isascii():
            spelled = "Ġ" + word[1:] if word[0] == " " else word
        else:
            spelled = "".join([self.spelling[b] for b in word.encode()])
        ids = [t.id for t in self.word(spelled)]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, chunk: str) -> bytes:
        head = LATIN.match(chunk)
        if head:
            word = head[1]
            return self.words[word] + self.rests[chunk[len(word):]] if len(word) < len(chunk) else self.words[word]
        return self.rests[chunk]

    def whole(self, rest: str) -> bytes:
        return np.array(self.tokenizer.encode(rest, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        chunks = CHUNK.findall(text)
        found = list(map(self.chunks.get, chunks))
        if None in found:
            found = [self.chunks[c] if ids is None else ids for c, ids in zip(chunks, found)]
        return b"".join(found)


@lru_cache(maxsize=1)
def encoder(path: str) -> ByteBpe:
    """A Python worker keeps its encoder, and what that remembers, from task to task."""
    return ByteBpe(path)


def cut_points(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` ids start: full pieces, but for the first, which takes the rest."""
    return [0, *range(n % capacity or capacity, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the ids of every whole text and the end id, cut into pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                b, rows, ids = whole.slice(at, TEXTS_AT_ONCE), [], []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                    raw = encode(text.as_py() or "") + end
                    starts = cut_points(len(raw) // 4, capacity)
                    for i, (s, e) in enumerate(zip(starts, [*starts[1:], len(raw) // 4])):
                        part = raw[4 * s:4 * e]
                        rows.append((doc, i, s, e - s, zlib.crc32(part)))
                        if keep_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int64))
                columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECE_SCHEMA + (", ids array<bigint>" if keep_ids else ""))


def sweep(lengths: list[tuple[int, int, int]], rooms: dict[int, int], capacity: int):
    """One round's best fit over size classes: documents of falling length take the nearest room above them.

    ``lengths`` holds (length, first rank, documents), falling; ``rooms`` the
    number of gaps of each room.  A gap that has taken a document stays the
    nearest one while another of that length fits.  Without a gap large enough
    a new one of ``capacity`` opens.  Returns the matches (first rank, class
    and first rank of the gaps as they were before the round, documents a gap
    takes, length, offset in the sequence) in order of rank, the gaps' classes
    afterwards (class before, first rank, end rank, room now), and the number
    of gaps opened.  Both lists are bounded by the
    number of sizes, whatever the number of rows.
    """
    groups = {room: [(room, 0, n)] for room, n in rooms.items() if n}  # room now -> (class before, from, to)
    taken, opened = [], 0
    above = sorted(groups)

    def put(room, part):
        if part[2] > part[1]:
            if room not in groups:
                above.insert(int(np.searchsorted(above, room)), room)
            groups.setdefault(room, []).append(part)

    for length, rank, n in lengths:
        while n:
            at = int(np.searchsorted(above, length))
            if at < len(above):
                room = above[at]
                before, lo, hi = groups[room].pop()
                if not groups[room]:
                    del groups[room], above[at]
            else:
                room = before = capacity
                lo, hi = opened, opened - (-n // (capacity // length))
                opened = hi
            each = room // length
            full = min(n // each, hi - lo)
            rest = 0 if full == hi - lo else n - full * each
            taken.append((rank, before, lo, each, length, capacity - room))
            put(room - each * length, (before, lo, lo + full))
            if rest:
                put(room - rest * length, (before, lo + full, lo + full + 1))
            put(room, (before, lo + full + bool(rest), hi))
            rank, n = rank + full * each + rest, n - full * each - rest
    return taken, sorted((before, lo, hi, room) for room, parts in groups.items() for before, lo, hi in parts), opened


def best_fit(items: DataFrame, counts: dict[int, int], capacity: int) -> DataFrame:
    """``items`` (with ``length`` and ``rank``, 0, 1, ... from the longest down) with ``sequence_id`` and ``offset``.

    Rounds take the lengths by halves: (capacity/2, capacity], (capacity/4,
    capacity/2], ...  In a round the documents, sorted by length, and the
    gaps, sorted by room, are matched by ``sweep`` over the counts of their
    classes; within a class the document of rank r gets the gap of rank r, so
    no two want the same place.  The gaps' table, one row for each open
    sequence, is then updated in its own tasks and settled.  The documents
    join the gaps of their round at the end, all rounds in one pass.
    """
    spark = items.sparkSession
    first, start = 0, {}
    for length in sorted(counts, reverse=True):
        start[length], first = first, first + counts[length]
    gaps, rooms, opened_before, matches, states = None, {}, 0, [], []
    upper = capacity
    while upper:
        lower = upper // 2
        due = [(length, start[length], counts[length]) for length in sorted(counts, reverse=True) if lower < length <= upper]
        upper = lower
        if not due:
            continue
        taken, after, opened = sweep(due, rooms, capacity)
        matches += [(*m, len(states)) for m in taken]
        new = spark.range(0, opened, 1, tasks_for(opened)).select(
            F.lit(capacity).cast("bigint").alias("room"), F.col("id").alias("nth"), (F.col("id") + opened_before).alias("sequence_id"))
        before = new if gaps is None else gaps.unionByName(new) if opened else gaps
        states.append(before.withColumn("round", F.lit(len(states)).cast("bigint")))
        opened_before += opened
        n_before, rooms, moves = opened + sum(rooms.values()), {}, []
        for was, lo, hi, room in after:
            moves.append((was, lo, room, rooms.get(room, 0)))
            rooms[room] = rooms.get(room, 0) + hi - lo
        least = min((length for length in counts if length <= upper), default=capacity + 1)
        rooms = {room: n for room, n in rooms.items() if room >= least}
        gaps = settle(before.coalesce(tasks_for(n_before)).mapInArrow(*moved(moves, least))) if rooms else None
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    placed = items.mapInArrow(*match(items, matches)).join(every, ["round", "room", "nth"])
    return placed.select(*[c for c in items.columns if c != "rank"], "sequence_id", "offset")


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // GAPS_PER_TASK))


def match(items: DataFrame, taken: list[tuple]):
    """mapInArrow arguments: each item with its round, the class and rank of its gap in it, and its offset there."""
    first, room, nth, each, length, offset, round_ = np.array(taken, np.int64).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(first, rank, "right") - 1
            among = rank - first[at]
            added = (room[at], nth[at] + among // each[at], offset[at] + among % each[at] * length[at], round_[at])
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, added)], [*b.schema.names, "room", "nth", "offset", "round"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return run, f"{fields}, room bigint, nth bigint, offset bigint, round bigint"


def moved(moves: list[tuple], least: int):
    """mapInArrow arguments: each gap with its room and rank after the round; those too small for what is left go."""
    was, lo, now, to = np.array(moves, np.int64).T
    order = np.lexsort((lo, was))
    was, lo, now, to = was[order], lo[order], now[order], to[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            room, nth, seq = (b.column(c).to_numpy() for c in range(3))
            begin, end = np.searchsorted(was, room), np.searchsorted(was, room, "right")
            while (end - begin > 1).any():  # the last part of the class that starts at or before the gap's rank
                mid = (begin + end) // 2
                right = (end - begin > 1) & (lo[mid] <= nth)
                begin, end = np.where(right, mid, begin), np.where(right | (end - begin <= 1), end, mid)
            keep = now[begin] >= least
            at = begin[keep]
            yield pa.RecordBatch.from_arrays([pa.array(now[at]), pa.array(to[at] + nth[keep] - lo[at]), pa.array(seq[keep])],
                                             ["room", "nth", "sequence_id"])

    return run, "room bigint, nth bigint, sequence_id bigint"


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Place of every piece: ``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``.

    A document is its ids followed by ``end_id``; a null text counts as empty
    and so has the end id alone.  Documents of more than ``capacity`` ids are
    cut into pieces of ``capacity``, of which the first may be shorter; others
    stay whole.  Pieces of a sequence follow each other from offset 0 without
    gaps.  Equal lengths are ranked by a hash, so reruns over the same rows
    agree.  Null and repeated ids, repeated rows and further columns of any
    name change nothing: each row is packed by itself.  An empty table gives
    an empty result.

    Only the counts of the ``capacity`` sizes reach the driver.
    """
    folder = shared_folder(docs.sparkSession, "packing")
    token_pieces(docs, tokenizer_path, capacity, end_id, keep_ids).write.parquet(f"{folder}/pieces")
    pieces = docs.sparkSession.read.parquet(f"{folder}/pieces")
    key = [F.xxhash64("doc_id", "start", "ids_crc32"), "doc_id", "piece"]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("bigint"), "offset": F.lit(None).cast("bigint")})
    with_rank(pieces, F.desc("length"), *key).write.parquet(f"{folder}/ranked")
    return best_fit(docs.sparkSession.read.parquet(f"{folder}/ranked"), counts, capacity)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, ends)`` of a packing that kept its ids: the ids of each sequence, and where its pieces end."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
                       F.transform("parts", lambda p: p["offset"] + p["length"]).alias("ends"))

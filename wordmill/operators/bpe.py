"""Byte-pair-encoding tokenizer: vocabulary, training, encode, decode.

Representation
--------------
A segmented word is a string in which every symbol is wrapped in U+0001 on
both sides: ``low`` -> ``\\1l\\1\\1o\\1\\1w\\1\\1</w>\\1``.  Merging the pair
``(a, b)`` is then one literal ``replace(s, '\\1a\\1\\1b\\1', '\\1ab\\1')``:
left to right, non-overlapping, aligned to symbol boundaries.  Everything
stays inside Spark's native string functions.

A text may hold U+0001 itself; inside segmentations it and U+0002 are escaped
(``\\2a`` and ``\\2b``), which keeps concatenation and binary order, so no word
is lost.

Training works on the *distinct* words with their frequencies (the corpus is
pre-aggregated once, partial aggregation absorbs hot words) and keeps the pair
counts as a DataFrame.  A round replays as many merges as its counts make certain
in the exact order, and only re-counts words that those merges changed.
The merge list and vocabulary are bounded by ``vocab_size``, so they are the
only things kept on the driver.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import whitespace_tokens
from ..session import cut_lineage, ensure_checkpoint_dir, scratch_name

SEP = "\u0001"
EOW = "</w>"

# Special tokens of the two tokenizer flavours, in id order.
BASIC_SPECIALS = ["<UNK>", "<PAD>", "<BOS>", "<EOS>", "<CODE>", "<DOC>"]
ADVANCED_SPECIALS = ["<UNK>", "<PAD>", "<BOS>", "<EOS>", "<CODE>", "<DOC>", "<NUM>", "<STR>"]
UNK = "<UNK>"


def base_characters() -> list[str]:
    """Printable ASCII (32..126) plus tab and newline, sorted by code point."""
    return sorted({chr(i) for i in range(32, 127)} | {"\n", "\t"})


def base_vocab_tokens(specials=None, eow_in_vocab: bool = True) -> list[str]:
    """D1 as a list: characters, then specials, then ``</w>`` when requested."""
    toks = base_characters() + list(BASIC_SPECIALS if specials is None else specials)
    if eow_in_vocab and EOW not in toks:
        toks.append(EOW)
    return toks


def base_vocab(spark: SparkSession, specials=None, eow_in_vocab: bool = True) -> DataFrame:
    """``(token, id)`` of the base vocabulary (103 entries, 105 with <NUM>/<STR>, +1 for </w>)."""
    toks = base_vocab_tokens(specials, eow_in_vocab)
    return spark.createDataFrame([(t, i) for i, t in enumerate(toks)], "token string, id int")


def word_freqs(df: DataFrame, col: str | None = None, tokens=None) -> DataFrame:
    """``(word, freq)`` over whitespace tokens (or a given token-array column)."""
    tok = tokens if tokens is not None else whitespace_tokens(col)
    return exploded(df, tok, "word").groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def exploded(df: DataFrame, values, name: str) -> DataFrame:
    """One row per element, none of which is null.

    A plain ``explode`` adds a filter on the array's size, pushed below it, which makes the array (a split, or an
    encoding) a second time; the outer one does not.
    """
    return df.select(F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def escape(text: str) -> str:
    return text.replace("\u0002", "\u0002b").replace(SEP, "\u0002a")


def unescape(text: str) -> str:
    return text.replace("\u0002a", SEP).replace("\u0002b", "\u0002")


def unescaped(c: F.Column) -> F.Column:
    return F.replace(F.replace(c, F.lit("\u0002a"), F.lit(SEP)), F.lit("\u0002b"), F.lit("\u0002"))


def wrap_chars(word) -> F.Column:
    """Characters of ``word`` (escaped) each wrapped in U+0001, followed by the wrapped ``</w>``."""
    w = F.col(word) if isinstance(word, str) else word
    w = F.replace(F.replace(w, F.lit("\u0002"), F.lit("\u0002b")), F.lit(SEP), F.lit("\u0002a"))
    return F.concat(F.regexp_replace(w, "(?s)(\u0002.|.)", SEP + "$1" + SEP), F.lit(SEP + EOW + SEP))


def init_symbols(freqs: DataFrame) -> DataFrame:
    """D3: ``(word, freq, sym)``."""
    return freqs.withColumn("sym", wrap_chars("word"))


def raw_symbols(sym) -> F.Column:
    """Array view of a wrapped segmentation, symbols still escaped."""
    s = F.col(sym) if isinstance(sym, str) else sym
    # neighbouring symbols are parted by two separators; no lambda, so it stays in generated code
    return F.split(F.substr(s, F.lit(2), F.length(s) - 2), SEP + SEP, -1)


def symbols_of(sym) -> F.Column:
    """Array view of a wrapped segmentation."""
    s = F.col(sym) if isinstance(sym, str) else sym
    return F.when(s.contains("\u0002"), F.transform(raw_symbols(s), unescaped)).otherwise(raw_symbols(s))


def word_chars(word) -> F.Column:
    w = F.col(word) if isinstance(word, str) else word
    return F.regexp_extract_all(w, F.lit("(?s)(.)"), 1)


def extend_char_vocab(freqs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Characters of the words that ``vocab`` lacks (per ``corpus`` if there is such a column)."""
    by = [c for c in freqs.columns if c == "corpus"]
    chars = freqs.select(*by, F.explode(word_chars("word")).alias("token")).distinct()
    new = chars.join(vocab.select("token"), "token", "left_anti")
    return new


def pair_rows(df: DataFrame, sym: str = "sym", weight: str = "freq", keys=()) -> DataFrame:
    """Adjacent symbol pairs of each segmentation, one row per occurrence, with its weight."""
    rows = df.select(*keys, F.col(weight).alias("w"), raw_symbols(sym).alias("s")).where(F.size("s") > 1)
    n = F.size("s")
    pairs = F.arrays_zip(F.slice("s", F.lit(1), n - 1).alias("lhs"), F.slice("s", F.lit(2), n - 1).alias("rhs"))
    return (rows.select(*keys, "w", F.explode(pairs).alias("p"))
            .select(*keys, F.col("p.lhs").alias("lhs"), F.col("p.rhs").alias("rhs"), "w"))


def pair_counts(symbols: DataFrame, sym: str = "sym", weight: str = "freq", keys=()) -> DataFrame:
    """Frequency-weighted counts of adjacent pairs ``(lhs, rhs, n)``."""
    counts = (pair_rows(symbols, sym, weight, keys)
              .groupBy(*keys, "lhs", "rhs").agg(F.sum("w").cast("long").alias("n")))
    return counts.select(*keys, unescaped(F.col("lhs")).alias("lhs"), unescaped(F.col("rhs")).alias("rhs"), "n")


def best_pair(counts: DataFrame, k: int = 1) -> DataFrame:
    """The arg-max pair(s): count descending, then lhs, rhs in binary order."""
    return counts.orderBy(F.desc("n"), F.asc("lhs"), F.asc("rhs")).limit(k)


def merge_pattern(lhs: str, rhs: str) -> tuple[str, str]:
    lhs, rhs = escape(lhs), escape(rhs)
    return SEP + lhs + SEP + SEP + rhs + SEP, SEP + lhs + rhs + SEP


def merge_pair(symbols: DataFrame, lhs: str, rhs: str, sym: str = "sym") -> DataFrame:
    """Merge every non-overlapping occurrence of ``(lhs, rhs)``, left to right."""
    pat, rep = merge_pattern(lhs, rhs)
    return symbols.withColumn(sym, F.replace(F.col(sym), F.lit(pat), F.lit(rep)))


@dataclass
class BpeModel:
    """A trained tokenizer: ordered merges plus the vocabulary ``token -> id``.

    Both are bounded by ``vocab_size`` (a parameter, not the data), which is
    why they live on the driver and enter plans as literals.
    """

    vocab: dict[str, int]
    merges: list[tuple[str, str, int]] = field(default_factory=list)
    vocab_size: int = 0
    specials: list[str] = field(default_factory=lambda: list(BASIC_SPECIALS))
    eow_in_vocab: bool = True
    n_base: int = 0

    @property
    def unk_id(self) -> int:
        return self.vocab.get(UNK, -1)

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(((t, i) for t, i in self.vocab.items()), key=lambda r: r[1]),
                                     "token string, id int")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r + 1, a, b, int(n)) for r, (a, b, n) in enumerate(self.merges)],
                                     "rank int, lhs string, rhs string, pair_count long")

    def truncated(self, n_merges: int) -> "BpeModel":
        """The model after its first ``n_merges`` merges (merges are prefix-stable)."""
        keep = self.merges[:max(0, n_merges)]
        vocab = {t: i for t, i in self.vocab.items() if i < self.n_base}
        for a, b, _ in keep:
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
        return BpeModel(vocab, keep, self.vocab_size, self.specials, self.eow_in_vocab, self.n_base)


# Pairs of a corpus that a round looks at.
TOP_PAIRS = 4000
# Distinct words of a task: no fewer, and beyond all cores no more.
LEAST_WORDS, MOST_WORDS = 2_000, 100_000
# Counts that a task holds before it passes them on.
HELD_COUNTS = 200_000
STATE = "kind string, corpus string, lhs string, rhs string, n long, sym array<int>"


def replay(pairs: dict[tuple[str, str], int], contexts: dict[tuple[str, str, str], int], floor: int, most: int,
           spelled: set[str] = frozenset()) -> list[tuple[str, str, int]]:
    """The merges that one-at-a-time training takes next, as far as the counts of a round make them certain.

    ``pairs`` are the exact counts of all pairs above ``floor`` (others may
    have up to ``floor``), ``contexts[x, a, b]`` how often x a b stand in a row
    where both (x, a) and (a, b) are among them, ``spelled`` the spellings of
    symbols that merges have made before.

    Merging (a, b) takes ``contexts[x, a, b]`` from (x, a) and gives it to
    (x, ab), and likewise on the right.  That is exact as long as no merge
    before it in the round changed these rows of three: x must not have been
    merged to its left, nor b to its right.  Elsewhere,
    with equal symbols side by side, and for
    pairs that did not exist when the round began, only bounds are known: a count
    never rises by the merge, and what is created is no more than what it comes from.
    The replay ends where a pair that is only bounded, or as rare as the floor, could come next.
    """
    n, bounded, merged = dict(pairs), set(), set()
    ends, begins = defaultdict(set), defaultdict(set)
    for p in n:
        ends[p[1]].add(p)
        begins[p[0]].add(p)
    heap = [(-c, p) for p, c in n.items()]
    heapq.heapify(heap)
    left_gone, right_gone, made, out = set(), set(), set(), []

    def create(p, c, exact):
        if p in n or p in merged or not exact or new in spelled or new in made:  # the same spelling may exist by other merges
            bounded.add(p)
            c += n.get(p, floor)
        if c > floor:
            n[p] = c
            ends[p[1]].add(p)
            begins[p[0]].add(p)
            heapq.heappush(heap, (-c, p))

    def lower(p, q, there, exact):
        """Pair ``p`` loses the rows of three counted by ``there`` to ``q``."""
        counted = p in pairs and made.isdisjoint(there)  # else a merge of this round may have spelled one of them again
        if exact and counted:
            lost = contexts.get(there, 0)
            if lost:
                n[p] -= lost
                heapq.heappush(heap, (-n[p], p))
                create(q, lost, True)
        else:
            most_lost = min(n[p], c, contexts.get(there, 0) if counted and (a, b) in pairs else c)
            if most_lost:
                bounded.add(p)
                create(q, most_lost, False)

    while heap and len(out) < most:
        c, (a, b) = heapq.heappop(heap)
        c = -c
        if n.get((a, b)) != c:
            continue  # an older count
        if c <= floor or (a, b) in bounded:
            break
        new, known = a + b, (a, b) in pairs and a != b
        out.append((a, b, c))
        del n[a, b]
        merged.add((a, b))
        for p in [p for p in ends[a] if p in n]:
            x = p[0]
            lower(p, (x, new), (x, a, b), known and b not in left_gone and x not in right_gone and x != a and x != b)
        for p in [p for p in begins[b] if p in n and p[0] != new]:
            y = p[1]
            lower(p, (new, y), (a, b, y), known and a not in right_gone and y not in left_gone and y != a and y != b)
        left_gone.add(a)
        right_gone.add(b)
        made.add(new)
    return out


class Symbols:
    """Numbers of the (escaped) spellings of a training's symbols; words are rows of them."""

    def __init__(self, characters):
        self.spelled = [EOW, *sorted(set(characters))]
        self.number = {escape(t): i for i, t in enumerate(self.spelled)}
        self.points = np.array([ord(t) for t in self.spelled[1:]], np.uint32)
        self.spelled = list(self.number)

    def of(self, spelling: str) -> int:
        found = self.number.get(spelling)
        if found is None:
            found = self.number[spelling] = len(self.spelled)
            self.spelled.append(spelling)
        return found

    def codes(self, pairs) -> np.ndarray:
        """A pair of symbols as one number; its second symbol is in the lower 32 bits."""
        return np.array([self.of(lhs) << 32 | self.of(rhs) for lhs, rhs in pairs], np.int64)


def split_words(words: pa.Array, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of whole words, each closed by ``EOW`` (number 0; the character ``points[i]`` has ``i + 1``), and their sizes."""
    sizes = pc.fill_null(pc.utf8_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.frombuffer("".join(w for w in words.to_pylist() if w).encode("utf-32-le"), np.uint32)
    out = np.zeros(len(found) + len(sizes), np.int32)
    at = np.arange(len(found)) + np.repeat(np.arange(len(sizes)), sizes)
    out[at] = np.searchsorted(points, found) + 1
    return out, sizes + 1


def places(codes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Where each code stands in the sorted ``ordered``, or -1."""
    if not len(ordered):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(ordered, codes), len(ordered) - 1)
    return np.where(ordered[at] == codes, at, -1)


def adjacent(sym: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of neighbouring symbols of a row, and where each begins."""
    at = np.flatnonzero(row[1:] == row[:-1])
    return sym[at].astype(np.int64) << 32 | sym[at + 1], at


def merge_rows(sym: np.ndarray, row: np.ndarray, merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The merges ``(lhs, rhs, new)`` one after another over all rows: left to right, non-overlapping."""
    for lhs, rhs, new in merges:
        at = np.flatnonzero(sym[:-1] == lhs)
        at = at[(sym[at + 1] == rhs) & (row[at + 1] == row[at])]
        if lhs == rhs and len(at):  # of a run of equal symbols every other pair
            n = np.arange(len(at))
            begins = np.r_[True, at[1:] != at[:-1] + 1]
            at = at[(n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0]
        if len(at):
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym[at] = new
            sym, row = sym[keep], row[keep]
    return sym, row


class Held:
    """Sums by key (columns of numbers) that a task holds before it passes them on."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: list[np.ndarray], n: np.ndarray) -> None:
        if len(n):
            self.parts.append(summed(keys, n))
            self.size += len(self.parts[-1][1])
        if self.size > HELD_COUNTS and len(self.parts) > 1:
            self.together()

    def together(self) -> tuple[list[np.ndarray], np.ndarray]:
        keys, n = summed([np.concatenate(k) for k in zip(*(p[0] for p in self.parts))], np.concatenate([p[1] for p in self.parts]))
        self.parts, self.size = [(keys, n)], len(n)
        return keys, n

    def full(self) -> bool:
        return self.size > HELD_COUNTS

    def taken(self) -> tuple[list[np.ndarray], np.ndarray] | None:
        found = self.together() if self.parts else None
        self.parts, self.size = [], 0
        return found


def summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys, n = [k[order] for k in keys], n[order]
    begins = np.flatnonzero(np.logical_or.reduce([np.r_[True, k[1:] != k[:-1]] for k in keys]))
    return [k[begins] for k in keys], np.add.reduceat(n, begins)


def by_corpus(b: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """A batch's rows corpus by corpus (its first column)."""
    names = pc.unique(b.column(0)).to_pylist()
    for name in names:
        yield name, b if len(names) == 1 else b.filter(pc.equal(b.column(0), name))


def flat_rows(rows: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows, and the row of each."""
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
    return rows.flatten().to_numpy().astype(np.int32), np.repeat(np.arange(len(rows), dtype=np.int32), sizes)


def list_rows(sym: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(sym, pa.int32()))


def word_rows(corpus: str, sym: pa.Array, freq: pa.Array) -> pa.RecordBatch:
    none = pa.nulls(len(sym), pa.string())
    return pa.RecordBatch.from_arrays([pa.repeat("w", len(sym)), pa.repeat(corpus, len(sym)), none, none, freq, sym.cast(pa.list_(pa.int32()))], STATE_NAMES)


def change_rows(corpus: str, held: Held, spelled: pa.Array) -> Iterator[pa.RecordBatch]:
    found = held.taken()
    if found:
        (codes,), n = found
        codes, n = codes[n != 0], n[n != 0]
        yield pa.RecordBatch.from_arrays([pa.repeat("d", len(n)), pa.repeat(corpus, len(n)), spelled.take(pa.array(codes >> 32)),
                                          spelled.take(pa.array(codes & 0xFFFFFFFF)), pa.array(n), pa.nulls(len(n), pa.list_(pa.int32()))], STATE_NAMES)


def first_words(freqs: DataFrame, symbols: Symbols) -> DataFrame:
    """``STATE`` rows of whole words: their characters (kind w) and the counts of their pairs (kind d)."""
    points, spelled = symbols.points, list(symbols.spelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = pa.array(spelled, pa.string()), defaultdict(Held)
        for b in batches:
            for corpus, part in by_corpus(b):
                sym, sizes = split_words(part.column(1), points)
                codes, at = adjacent(sym, row := np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))
                held[corpus].add([codes], part.column(2).to_numpy()[row[at]])
                yield word_rows(corpus, list_rows(sym, sizes), part.column(2))
                if held[corpus].full():
                    yield from change_rows(corpus, held[corpus], names)
        for corpus, h in held.items():
            yield from change_rows(corpus, h, names)

    return freqs.select("corpus", "word", F.col("freq").cast("long").alias("freq")).mapInArrow(run, STATE)


def merged_words(words: DataFrame, batches: dict[str, list[tuple[str, str]]], symbols: Symbols) -> DataFrame:
    """``STATE`` rows: the words (kind w) after the round's merges, and the changes of the pair counts (kind d)."""
    merges = {corpus: [(symbols.of(a), symbols.of(b), symbols.of(a + b)) for a, b in found] for corpus, found in batches.items()}
    due = {corpus: np.sort(symbols.codes(found)) for corpus, found in batches.items()}
    spelled = list(symbols.spelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = pa.array(spelled, pa.string()), defaultdict(Held)
        for b in batches:
            for corpus, part in by_corpus(b):
                if not merges.get(corpus):
                    yield word_rows(corpus, part.column(1), part.column(2))
                    continue
                sym, row = flat_rows(part.column(1))
                codes, at = adjacent(sym, row)
                changed = np.zeros(part.num_rows, bool)
                changed[row[at[places(codes, due[corpus]) >= 0]]] = True
                if not changed.any():
                    yield word_rows(corpus, part.column(1), part.column(2))
                    continue
                same = part.filter(pa.array(~changed))
                yield word_rows(corpus, same.column(1), same.column(2))
                freq = part.column(2).to_numpy()
                mine = changed[row[at]]
                here = changed[row]
                new, of = merge_rows(sym[here], row[here], merges[corpus])
                after, after_at = adjacent(new, of)
                held[corpus].add([np.r_[codes[mine], after]], np.r_[-freq[row[at[mine]]], freq[of[after_at]]])
                yield word_rows(corpus, list_rows(new, np.bincount(of, minlength=part.num_rows)[changed]), pa.array(freq[changed]))
                if held[corpus].full():
                    yield from change_rows(corpus, held[corpus], names)
        for corpus, h in held.items():
            yield from change_rows(corpus, h, names)

    return words.select("corpus", "sym", "freq").mapInArrow(run, STATE)


STATE_NAMES = ["kind", "corpus", "lhs", "rhs", "n", "sym"]


def fold(parts: list[str], due: list, rank, at_rank=None) -> list[str]:
    """Merges in rank order over a word's symbols; ``rank(pair, last)`` is the next rank of a pair above ``last``.

    ``at_rank(last, parts)`` sees the symbols before each merge.
    """
    while True:
        last = min((r for r in due if r is not None), default=None)
        if last is None:
            return parts
        if at_rank:
            at_rank(last, parts)
        joined, at = [], 0
        for at_pair in [i for i, r in enumerate(due) if r == last]:
            if at_pair >= at:  # else its left symbol has just been merged
                joined += parts[at:at_pair] + [parts[at_pair] + parts[at_pair + 1]]
                at = at_pair + 2
        parts = joined + parts[at:]
        due = [rank(p, last) for p in zip(parts, parts[1:])]


def pair_contexts(words: DataFrame, pairs: dict[str, set[tuple[str, str]]], symbols: Symbols) -> DataFrame:
    """``(corpus, x, a, b, n)``: how often three symbols stand in a row of which both pairs are asked for."""
    asked = {corpus: np.sort(symbols.codes(found)) for corpus, found in pairs.items()}
    spelled = list(symbols.spelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = pa.array(spelled, pa.string()), defaultdict(Held)

        def rows(corpus):
            found = held[corpus].taken()
            if found:
                (codes, last), n = found
                three = [names.take(pa.array(x)) for x in (codes >> 32, codes & 0xFFFFFFFF, last)]
                yield pa.RecordBatch.from_arrays([pa.repeat(corpus, len(n)), *three, pa.array(n)], ["corpus", "x", "a", "b", "n"])

        for b in batches:
            for corpus, part in by_corpus(b):
                if corpus not in asked:
                    continue
                sym, row = flat_rows(part.column(1))
                codes, at = adjacent(sym, row)
                known = places(codes, asked[corpus]) >= 0
                two = np.flatnonzero(known[:-1] & known[1:] & (at[1:] == at[:-1] + 1))
                held[corpus].add([codes[two], sym[at[two] + 2].astype(np.int64)], part.column(2).to_numpy()[row[at[two]]])
                if held[corpus].full():
                    yield from rows(corpus)
        for corpus in list(held):
            yield from rows(corpus)

    rows = words.select("corpus", "sym", "freq").mapInArrow(run, "corpus string, x string, a string, b string, n long")
    return rows.groupBy("corpus", "x", "a", "b").agg(F.sum("n").cast("long").alias("n"))


def train_bpe(df: DataFrame, col: str | None = None, vocab_size: int = 5000, specials=None,
              eow_in_vocab: bool = True, tokens=None,
              freqs: DataFrame | None = None, on_merge=None) -> BpeModel:
    """Learn merges until the vocabulary reaches ``vocab_size`` or no pair is left.

    Budget = ``vocab_size`` minus the base vocabulary extended by the corpus
    characters; a negative budget trains no merge.  A merge whose spelling is
    already a token consumes budget but adds no id (ids stay dense, first id wins).
    """
    freqs = freqs if freqs is not None else word_freqs(df, col, tokens)
    keyed = freqs.select(F.lit("").alias("corpus"), "word", "freq")
    return train_bpe_keyed(keyed, {"": vocab_size}, specials, eow_in_vocab,
                           on_merge=(lambda corpus, *m: on_merge(*m)) if on_merge else None)[""]


def train_bpe_keyed(freqs: DataFrame, vocab_sizes: dict[str, int], specials=None, eow_in_vocab: bool = True,
                    top_pairs: int = TOP_PAIRS, on_merge=None) -> dict[str, BpeModel]:
    """Train one model per corpus of ``freqs(corpus, word, freq)``, all in the same rounds.

    State: segmented distinct words and their pair counts, written as Parquet
    below the shared folder each round, after which the round before is
    removed; so a lost executor costs one round, and the disk holds two.  Of
    each corpus the ``top_pairs`` best pairs and the rows of three symbols made
    of them reach the driver (both bounded by parameters), and ``replay`` takes
    as many merges as exact one-at-a-time training would take next: some 70
    on average, more as training goes on.  One pass over the words then
    applies them and returns the changes of the pair counts, of changed words
    only.  How many pairs are looked at never changes the merges, only how many
    a round finds.
    """
    spark = freqs.sparkSession
    specials = list(BASIC_SPECIALS if specials is None else specials)
    base = base_vocab_tokens(specials, eow_in_vocab)
    freqs = cut_lineage(freqs.where(F.col("corpus").isin(list(vocab_sizes))))
    # unseen characters in code-point order (bounded by the alphabet, not the corpus)
    chars = extend_char_vocab(freqs, base_vocab(spark, specials, eow_in_vocab)).collect()
    models = {}
    for corpus, size in vocab_sizes.items():
        tokens = base + sorted(r["token"] for r in chars if r["corpus"] == corpus)
        models[corpus] = BpeModel({t: i for i, t in enumerate(tokens)}, [], size, specials, eow_in_vocab, len(tokens))
    budget = {c: max(0, m.vocab_size - m.n_base) for c, m in models.items()}
    open_ = {c for c in models if budget[c]}
    if not open_:
        return models

    n_words, cores = freqs.count(), spark.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n_words // LEAST_WORDS), max(cores, -(-n_words // MOST_WORDS))))
    state = RoundState(spark)
    symbols = Symbols(c for c in (*base, *(r["token"] for r in chars)) if len(c) == 1)
    words, changes = state.next(first_words(freqs.repartition(tasks), symbols))
    counts = state.counted(changes)
    while True:
        ranked = None
        for corpus in sorted(open_):
            rows = counts.where(F.col("corpus") == corpus).orderBy(F.desc("n"), "lhs", "rhs").limit(top_pairs)
            ranked = rows if ranked is None else ranked.unionByName(rows)
        top = {corpus: [] for corpus in open_}
        for r in ranked.collect():
            top[r["corpus"]].append((int(r["n"]), r["lhs"], r["rhs"]))
        floor = {c: min(rows)[0] if len(rows) >= top_pairs else 0 for c, rows in top.items()}
        # the pairs of the floor's count may be cut off anywhere; the best pair is always exact
        pairs = {c: {(lhs, rhs): n for n, lhs, rhs in rows if n > floor[c]} for c, rows in top.items()}
        rows_of_three = {c: {} for c in top}
        for r in pair_contexts(words, {c: set(p) for c, p in pairs.items()}, symbols).collect():
            rows_of_three[r["corpus"]][r["x"], r["a"], r["b"]] = int(r["n"])
        batches = {}
        for corpus in sorted(open_):
            model, most = models[corpus], budget[corpus] - len(models[corpus].merges)
            found = replay(pairs[corpus], rows_of_three[corpus], floor[corpus], most,
                           {EOW, *(escape(a + b) for a, b, _ in model.merges)})
            if not found and top[corpus]:  # more equal pairs than are looked at: the first of them comes next
                n, lhs, rhs = min(top[corpus], key=lambda r: (-r[0], r[1], r[2]))
                found = [(lhs, rhs, n)]
            batches[corpus] = [(lhs, rhs) for lhs, rhs, _ in found]
            for lhs, rhs, n in found:
                lhs, rhs = unescape(lhs), unescape(rhs)
                model.merges.append((lhs, rhs, n))
                model.vocab.setdefault(lhs + rhs, len(model.vocab))
                if on_merge:
                    on_merge(corpus, len(model.merges), lhs, rhs, n)
            if not found or len(model.merges) >= budget[corpus]:
                open_.discard(corpus)
        if not open_:
            state.drop()
            return models
        words, changes = state.next(merged_words(words, {c: batches[c] for c in open_}, symbols))
        counts = state.counted(counts.unionByName(changes))


class RoundState:
    """The tables of a training's rounds, in a fresh folder below the shared one; a round's files go once the next ones are written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.round = spark, 0
        self.folder = f"{ensure_checkpoint_dir(spark)}/{scratch_name('bpe')}"

    def read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def next(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Writes ``STATE`` rows; returns the words and the changes of counts."""
        self.round += 1
        path = f"{self.folder}/state{self.round}"
        rows.write.partitionBy("kind").parquet(path)
        self.delete(f"state{self.round - 1}")
        if not self.exists(f"{path}/kind=w"):
            words = self.spark.createDataFrame([], "corpus string, sym array<int>, freq long")
        else:
            words = self.read(f"{path}/kind=w", "corpus string, sym array<int>, n long").select("corpus", "sym", F.col("n").alias("freq"))
        if not self.exists(f"{path}/kind=d"):
            return words, self.spark.createDataFrame([], "corpus string, lhs string, rhs string, n long")
        return words, self.read(f"{path}/kind=d", "corpus string, lhs string, rhs string, n long")

    def counted(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/counts{self.round}"
        counts = rows.groupBy("corpus", "lhs", "rhs").agg(F.sum("n").cast("long").alias("n")).where(F.col("n") > 0)
        counts.write.parquet(path)
        self.delete(f"counts{self.round - 1}")
        return self.read(path, "corpus string, lhs string, rhs string, n long")

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        path = self.path(name)
        return self.files(path).exists(path)

    def delete(self, name: str) -> None:
        path = self.path(f"{self.folder}/{name}")
        self.files(path).delete(path, True)

    def drop(self) -> None:
        path = self.path(self.folder)
        self.files(path).delete(path, True)


# ------------------------------------------------------------------ encode

# Merges up to so many are applied one after another to all words; of more, each word's next ones are looked up.
PASSES = 64


class ManyWords:
    """Segments many words at a time with array operations: symbols are numbers, a character's its code point.

    As in ``Segmenter`` symbols of one spelling are one symbol, whichever merges made them.
    """

    FIRST = 0x110000  # above all code points

    def __init__(self, merges):
        self.spelled, self.number = [EOW], {EOW: self.FIRST}
        self.merges = [(self.of(a), self.of(b), self.of(a + b)) for a, b, *_ in merges]
        codes = np.array([a << 32 | b for a, b, _ in self.merges], np.int64)
        self.order = np.argsort(codes, kind="stable")
        self.codes, self.made = codes[self.order], np.array([n for *_, n in self.merges], np.int64)
        self.once = len(np.unique(codes)) == len(codes)

    def of(self, spelling: str) -> int:
        if len(spelling) == 1:
            return ord(spelling)
        if spelling not in self.number:
            self.number[spelling] = self.FIRST + len(self.spelled)
            self.spelled.append(spelling)
        return self.number[spelling]

    def spellings(self, sym: np.ndarray) -> list[str]:
        used, at = np.unique(sym, return_inverse=True)
        names = np.array([chr(n) if n < self.FIRST else self.spelled[n - self.FIRST] for n in used.tolist()], object)
        return names[at].tolist()

    def id_table(self, vocab: dict[str, int], unk_id: int) -> np.ndarray:
        """The vocabulary's id of each symbol."""
        table = np.full(self.FIRST + len(self.spelled), unk_id, np.int64)
        for token, i in vocab.items():
            at = ord(token) if len(token) == 1 else self.number.get(token)
            if at is not None:
                table[at] = i
        return table

    def split(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of whole words, each closed by ``EOW``, and the word of each symbol."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        row = np.repeat(np.arange(len(words)), sizes)
        sym = np.full(len(row), self.FIRST, np.int64)
        inside = np.ones(len(row), bool)
        inside[np.cumsum(sizes) - 1] = False
        sym[inside] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return sym, row

    def merged(self, sym: np.ndarray, row: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The merges ``begin`` to ``end`` in their order, over all rows."""
        if end - begin <= PASSES or not self.once:
            return merge_rows(sym, row, self.merges[begin:end])
        done, last = [], np.full(int(row[-1]) + 1 if len(row) else 0, begin - 1)
        while len(sym):
            pair = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.codes, pair), len(self.codes) - 1)
            rank = np.where((self.codes[at] == pair) & (row[1:] == row[:-1]), self.order[at], end)
            rank = np.r_[np.where((rank > last[row[:-1]]) & (rank < end), rank, end), end]
            begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.r_[begins, len(sym)])
            live = np.repeat(best < end, sizes)
            done.append((sym[~live], row[~live]))
            due = np.flatnonzero((rank == np.repeat(best, sizes)) & live)
            last[row[begins]] = best
            n = np.arange(len(due))  # of a run of equal symbols every other pair
            runs = np.r_[True, due[1:] != due[:-1] + 1][:len(due)]
            due = due[(n - np.maximum.accumulate(np.where(runs, n, 0))) % 2 == 0]
            sym[due] = self.made[rank[due]]
            live[due + 1] = False
            sym, row = sym[live], row[live]
        if not done:
            return sym, row
        sym, row = (np.concatenate(x) for x in zip(*done))
        back = np.argsort(row, kind="stable")
        return sym[back], row[back]

    def segmented(self, words: list[str], sizes: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Symbols, and how many of each word, after the first ``sizes[i]`` merges, for rising sizes (default: after all)."""
        sym, row = self.split(words)
        out, begin = [], 0
        for end in [len(self.merges)] if sizes is None else [min(s, len(self.merges)) for s in sizes]:
            sym, row = self.merged(sym.copy(), row, begin, end)
            out.append((sym, np.bincount(row, minlength=len(words))))
            begin = end
        return out


class Segmenter:
    """Segments words with a model's merges; remembers the words it has met (a bounded memory per task)."""

    def __init__(self, merges, vocab: dict[str, int], unk_id: int, most: int = 200_000):
        self.ranks: dict[tuple[str, str], list[int]] = defaultdict(list)
        for i, (lhs, rhs, *_) in enumerate(merges):  # a pair may be learned again, when a later merge spells its symbols anew
            self.ranks[lhs, rhs].append(i)
        self.first = {p: r[0] for p, r in self.ranks.items()}
        self.once = len(self.first) == len(merges)
        self.vocab, self.unk_id, self.most = vocab, unk_id, most
        self.many = ManyWords(merges)
        self.id_of = None
        self.known: dict[str, list] = {}

    def meet(self, words: list[str], ids: bool) -> None:
        """Segments the words it does not know yet, as many as it remembers, at a time."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = words[:self.most]
        if not new or not (self.once or len(self.many.merges) <= PASSES):
            return
        ((sym, n),) = self.many.segmented(new)
        if ids and self.id_of is None:
            self.id_of = self.many.id_table(self.vocab, self.unk_id)
        found = self.id_of[sym].tolist() if ids else self.many.spellings(sym)
        ends = np.cumsum(n).tolist()
        self.known.update(zip(new, map(found.__getitem__, map(slice, [0, *ends], ends))))

    def remembered(self, word: str, ids: bool) -> list:
        """The word's ids, or its symbols; a segmenter serves one of the two."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            symbols = self.symbols(word)
            found = self.known[word] = [self.vocab.get(s, self.unk_id) for s in symbols] if ids else symbols
        return found

    def rank(self, pair, last: int = -1) -> int | None:
        r = self.first.get(pair)
        if r is None or r > last or self.once:
            return r if r is not None and r > last else None
        return next((r for r in self.ranks.get(pair, ()) if r > last), None)

    def symbols(self, word: str) -> list[str]:
        """Merges in rank order; a merge never applies to what a later one made, so ranks only go up."""
        parts = [*word, EOW]
        due = list(map(self.first.get, zip(parts, parts[1:])))
        if not self.once:
            return fold(parts, due, self.rank)
        last = -1
        while True:
            live = [r for r in due if r is not None and r > last]
            if not live:
                return parts
            last, joined, at = min(live), [], 0
            for i, r in enumerate(due):
                if r == last and i >= at:  # else its left symbol has just been merged
                    joined += parts[at:i]
                    joined.append(parts[i] + parts[i + 1])
                    at = i + 2
            parts = joined + parts[at:]
            due = list(map(self.first.get, zip(parts, parts[1:])))

    def symbols_at(self, word: str, sizes: list[int]) -> list[list[str]]:
        """The symbols after the first ``sizes[i]`` merges, for rising sizes, from one segmentation.

        The merges that make a symbol form a tree whose ranks fall towards the characters; what a smaller
        model leaves are the largest subtrees below its size, which stand there just before the first later merge.
        """
        parts, out = [*word, EOW], []

        def cut(last, parts):
            while len(out) < len(sizes) and sizes[len(out)] <= last:
                out.append(parts)

        parts = fold(parts, [self.rank(p) for p in zip(parts, parts[1:])], self.rank, cut)
        return out + [parts] * (len(sizes) - len(out))


# Words that are segmented at a time: what a task holds does not depend on the rows of an Arrow batch.
SLICE_WORDS = 200_000


def segmented(rows: pa.ListArray, segment: Segmenter, ids: bool) -> pa.Array:
    """Arrays of words to arrays of ids (or symbols): each distinct word of a slice is looked up once, the rest is indexing."""
    sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    kind, ends = pa.int32() if ids else pa.string(), np.cumsum(sizes)
    out, at = [], 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + SLICE_WORDS, side="right")))
        coded = rows.slice(at, stop - at).flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        segment.meet(words, ids)  # what is left for ``remembered`` are lookups
        found = [segment.remembered(w, ids) for w in words]
        index = coded.indices.to_numpy()
        n = np.fromiter(map(len, found), np.int64, len(found))
        begin, length = (np.cumsum(n) - n)[index], n[index]
        upto = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(begin - upto[:-1], length) + np.arange(upto[-1])
        values = pa.array(list(chain.from_iterable(found)), kind).take(pa.array(place))
        offsets = upto[np.concatenate([[0], np.cumsum(sizes[at:stop])])]
        out.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
        at = stop
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(kind))


def segment_udf(model: BpeModel, spark: SparkSession, ids: bool = True):
    """Arrow UDF: array of words -> ids (or tokens) of all of them in order.

    The merge list (bounded by ``vocab_size``) is broadcast, each task segments
    a distinct word once, and no token leaves its row: encoding a corpus needs
    no shuffle.
    """
    shared = spark.sparkContext.broadcast((model.merges, model.vocab, model.unk_id))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segment = Segmenter(*shared.value)
        for rows in batches:
            yield segmented(rows, segment, ids)

    return F.arrow_udf(run, "array<int>" if ids else "array<string>")


def encode_words(words: DataFrame, model: BpeModel, word_col: str = "word") -> DataFrame:
    """``(word, tokens, ids)`` for a table of words; unknown tokens -> <UNK>."""
    spark, one = words.sparkSession, F.array(F.col(word_col))
    return words.withColumn("tokens", segment_udf(model, spark, ids=False)(one)).withColumn("ids", segment_udf(model, spark)(one))


# So many merges are folded one after another; of more, those that a word can hold are picked first.
FEW_MERGES = 64


class Folder:
    """Segments words by literal string replacement: the merges folded in rank order over the wrapped word.

    An encoder of its own for E4 to compare with.  A merge can only apply where
    its spelling stands in the word, so of each word only the merges spelled
    like one of its substrings are folded.
    """

    def __init__(self, merges, vocab: dict[str, int], unk_id: int):
        self.spelled, self.vocab, self.unk_id = defaultdict(list), vocab, unk_id
        for i, (lhs, rhs, *_) in enumerate(merges):
            self.spelled[lhs + rhs].append(i)
        self.patterns = [merge_pattern(a, b) for a, b, *_ in merges]
        self.longest = max(map(len, self.spelled), default=0)

    def ids(self, word: str, before: int | None = None) -> list[int]:
        """Ids of the word's symbols, after the merges of rank less than ``before`` only if given."""
        whole = word + EOW
        if len(self.patterns) <= FEW_MERGES:
            due = range(len(self.patterns) if before is None else min(before, len(self.patterns)))
        else:
            due = self.spelled_in(whole, before)
        plain = SEP not in word and "\u0002" not in word
        sym = SEP + (SEP + SEP).join([*word, EOW] if plain else [*map(escape, word), EOW]) + SEP
        for r in due:
            sym = sym.replace(*self.patterns[r])
        found = sym[1:-1].split(SEP + SEP)
        return [self.vocab.get(t, self.unk_id) for t in (found if plain else map(unescape, found))]

    def many(self, words: list[str], sizes: list[int]) -> list[tuple[list[str], np.ndarray]]:
        """Symbols (and how many of each word) after the first ``sizes[i]`` merges, for rising sizes: all words are one string,
        in which every merge is replaced.  For words without escapes, and few merges."""
        begin, out = 0, []
        # a blank after each word keeps the merges inside it; no word holds one
        sym = " ".join([SEP + (SEP + SEP).join([*w, EOW]) + SEP for w in words])
        for end in sizes:
            for pattern in self.patterns[begin:end]:
                sym = sym.replace(*pattern)
            found = sym.split(" ")
            n = np.fromiter((w.count(SEP) for w in found), np.int64, len(found)) // 2
            out.append((sym[1:-1].replace(SEP + " " + SEP, SEP + SEP).split(SEP + SEP), n))
            begin = end
        return out

    def spelled_in(self, whole: str, before: int | None) -> list[int]:
        spans = {whole[i:j] for i in range(len(whole)) for j in range(i + 2, min(len(whole), i + self.longest) + 1)}
        return sorted({r for s in spans for r in self.spelled.get(s, ()) if before is None or r < before})


def encode_words_native(words: DataFrame, model: BpeModel, word_col: str = "word") -> DataFrame:
    """D11 by literal string replacement (``Folder``)."""
    shared = words.sparkSession.sparkContext.broadcast((model.merges, model.vocab, model.unk_id))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        folder = Folder(*shared.value)
        for rows in batches:
            plain = ~rows.str.contains(f"[{SEP}\u0002 ]", regex=True)
            if len(folder.patterns) > FEW_MERGES or not (len(rows) and plain.all()):
                yield rows.map(folder.ids)
                continue
            ((found, n),) = folder.many(rows.to_list(), [len(folder.patterns)])
            ids, ends = [folder.vocab.get(t, folder.unk_id) for t in found], np.cumsum(n).tolist()
            yield pd.Series(list(map(ids.__getitem__, map(slice, [0, *ends], ends))), dtype=object)

    return words.select(word_col, F.pandas_udf(run, "array<int>")(F.col(word_col)).alias("ids"))


def encode(df: DataFrame, col: str, model: BpeModel, key: str | list[str] = "doc_id",
           out: str = "ids", tokens=None) -> DataFrame:
    """``(*key, ids)`` of every row (empty text -> []); see ``segment_udf``."""
    keys = [key] if isinstance(key, str) else list(key)
    return encode_rows(df.select(*keys, (tokens if tokens is not None else whitespace_tokens(col)).alias("_words")), col, model, out,
                       F.col("_words")).drop("_words")


def encode_rows(df: DataFrame, col: str, model: BpeModel, out: str = "ids", tokens=None) -> DataFrame:
    """``df`` with its text encoded; works on streams too."""
    tok = tokens if tokens is not None else whitespace_tokens(col)
    return df.withColumn(out, F.coalesce(segment_udf(model, df.sparkSession)(tok), F.array().cast("array<int>")))


# ------------------------------------------------------------------ decode

def _strip_ws(c: F.Column) -> F.Column:
    from ..functions.text import WS_CLASS, WS_RUN
    c = F.regexp_replace(c, WS_RUN, " ")
    return F.regexp_replace(c, f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def _finish_decode(text: F.Column) -> F.Column:
    return F.coalesce(_strip_ws(F.replace(text, F.lit(EOW), F.lit(" "))), F.lit(""))


def decode(df: DataFrame, ids_col: str, model: BpeModel, out: str = "decoded") -> DataFrame:
    """Ids -> tokens (unknown id -> <UNK>) joined, ``</w>`` -> space, whitespace collapsed, trimmed.

    The vocabulary (bounded by ``vocab_size``) is broadcast to an Arrow UDF
    that joins the tokens of a row; the clean-up stays in SQL functions.
    """
    shared = df.sparkSession.sparkContext.broadcast({i: t for t, i in model.vocab.items()})

    @F.pandas_udf("string")
    def spell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = shared.value
        for rows in batches:
            yield rows.map(lambda ids: "".join([token.get(i, UNK) for i in (ids if ids is not None else ())]))

    return df.withColumn(out, _finish_decode(spell(F.col(ids_col))))


def tokenize_with(df: DataFrame, text, model: BpeModel | None = None, out: str = "tokens") -> DataFrame:
    """``df`` with the BPE tokens (strings) of ``text`` with a model, else its whitespace tokens."""
    t = whitespace_tokens(text)
    if model is None:
        return df.withColumn(out, t)
    return df.withColumn(out, F.coalesce(segment_udf(model, df.sparkSession, ids=False)(t), F.array().cast("array<string>")))


def model_from_merges(spark_or_none, merges, specials=None, eow_in_vocab=True, extra_chars=(),
                      vocab_size: int = 0) -> BpeModel:
    """Rebuild a model from an ordered merge list (used by loaders and the size sweep)."""
    specials = list(BASIC_SPECIALS if specials is None else specials)
    vocab = {t: i for i, t in enumerate(base_vocab_tokens(specials, eow_in_vocab))}
    for c in extra_chars:
        if c not in vocab:
            vocab[c] = len(vocab)
    n_base = len(vocab)
    ms = []
    for a, b, *n in merges:
        ms.append((a, b, int(n[0]) if n else 0))
        if a + b not in vocab:
            vocab[a + b] = len(vocab)
    return BpeModel(vocab, ms, vocab_size, specials, eow_in_vocab, n_base)

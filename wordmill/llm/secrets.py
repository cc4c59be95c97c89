"""Secret scans: fixed patterns plus a battery of randomness tests with false-discovery control."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import fresh_name, settle

# The base patterns and their shortest accepted lengths.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the maximal runs of [0-9a-f] that are long enough
ASSIGN_MIN, ACCESS_MIN = 12, 18
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

# Runs of encoded symbols that the battery looks at.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Encodings in the order in which they are inferred: name, symbols (position = symbol value).
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (("decimal", DIGITS), ("hex_lower", DIGITS + "abcdef"), ("hex_upper", DIGITS + "ABCDEF"),
             ("base32", UPPER + "234567"), ("base36_lower", DIGITS + LOWER), ("base36_upper", DIGITS + UPPER),
             ("base64", UPPER + LOWER + DIGITS + "+/"), ("base64url", UPPER + LOWER + DIGITS + "-_"))
SYMBOL = np.full((len(ENCODINGS), 256), -1, np.int64)
for _e, (_, _symbols) in enumerate(ENCODINGS):
    for _v, _c in enumerate(_symbols):
        SYMBOL[_e, ord(_c)] = _v
SIZE = np.array([len(s) for _, s in ENCODINGS], np.float64)
CLASS = np.full(256, 3, np.int64)  # lower, upper, digit, other
for _k, _symbols in enumerate((LOWER, UPPER, DIGITS)):
    CLASS[[ord(c) for c in _symbols]] = _k

# The model of ordinary text that a secret must refute: probability that two letters agree, third moment,
# probability that neighbouring symbols differ in class, correlation of neighbours.
TEXT_MATCH, TEXT_CUBE, TEXT_SWITCH, TEXT_SERIAL = 0.068, 0.0060, 0.08, 0.45
# Length bands with separate false-discovery control.
BANDS = np.array([16, 20, 24, 32, 48, 64, 128])
# Resolution of -log10(p) in the corpus-wide histogram, and its last bin.
BIN, BINS = 0.05, 600
FDR = 0.01  # expected share of ordinary strings among the reported ones
ALPHA = 1e-4  # a string that fails a uniformity test at this level is not random


def normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z >= z), from a rational approximation of erfc (Abramowitz and Stegun 7.1.26) with an exponential tail."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    tail = np.exp(-x * x) * t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) / 2
    return np.where(z >= 0, tail, 1 - tail)


def battery(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Encoding, uniformity p-value and text p-value of each ASCII candidate.

    Per inferred encoding: chi-squared of the symbol counts against a uniform
    alphabet, Wald-Wolfowitz runs of symbols in the upper and lower half of
    the alphabet, and lag-1 serial correlation.  Each statistic is judged
    twice.  The uniformity p-value (the smallest of the three, times three) is
    small for strings that are not random.  The text p-value combines (Fisher)
    how improbable the statistics are for ordinary text: matches of symbols,
    changes of character class and the correlation of neighbours; it is small
    for random strings.

    Excluded: strings inferred as decimal, and strings of one character class
    only (digits, lower case or upper case alone).  Their uniformity p-value
    is set to 0 whatever the tests say, so ``random`` never reports them, at
    any length; the fixed patterns are not affected.
    """
    n = np.array([len(s) for s in strings], np.int64)
    raw = np.frombuffer("".join(strings).encode(), np.uint8)
    end = np.cumsum(n)
    start = end - n
    padding = raw == ord("=")
    fits = np.stack([np.logical_and.reduceat((SYMBOL[e][raw] >= 0) | padding, start) for e in range(len(ENCODINGS))])
    fits[-1] |= ~fits.any(axis=0)  # mixed alphabets count as base64url, foreign symbols dropped
    encoding = fits.argmax(axis=0)
    owner = np.repeat(np.arange(len(n)), n)
    symbol = SYMBOL[encoding[owner], raw]
    used = symbol >= 0
    owner, symbol, kind = owner[used], symbol[used], CLASS[raw[used]]
    m = np.maximum(np.bincount(owner, minlength=len(n)), 2).astype(np.float64)
    k = SIZE[encoding]
    per = np.bincount(owner * 64 + symbol, minlength=len(n) * 64).reshape(-1, 64)
    squares = (per * per).sum(axis=1).astype(np.float64)
    # chi-squared against the uniform alphabet (Wilson-Hilferty); the statistic is discrete when few symbols are seen
    chi = k * squares / m - m
    z_chi = (np.cbrt(np.maximum(chi, 0) / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / np.sqrt(2 / (9 * (k - 1)))
    same = owner[1:] == owner[:-1]
    pair = owner[1:][same]
    # runs above and below the middle of the alphabet
    high = symbol >= k[owner] / 2
    n1 = np.bincount(owner, high, len(n))
    n0 = m - n1
    runs = 1 + np.bincount(pair, (high[1:] != high[:-1])[same], len(n))
    mean = 1 + 2 * n0 * n1 / m
    sd = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (m - 1), 1e-9))
    z_runs = np.where(n0 * n1 == 0, 9.0, (runs - mean) / sd)
    # lag-1 serial correlation of the symbol values
    value = symbol - np.bincount(owner, symbol, len(n))[owner] / m[owner]
    spread = np.maximum(np.bincount(owner, value * value, len(n)), 1e-9)
    serial = np.bincount(pair, (value[1:] * value[:-1])[same], len(n)) / spread
    z_serial = (serial + 1 / m) * np.sqrt(m)
    uniform = np.minimum(1, 3 * np.minimum(normal_tail(z_chi), np.minimum(2 * normal_tail(np.abs(z_runs)), 2 * normal_tail(np.abs(z_serial)))))
    # the same three statistics under the model of ordinary text
    matches = m * (m - 1) * TEXT_MATCH
    noise = np.sqrt(2 * m * (m - 1) * (TEXT_MATCH - TEXT_MATCH ** 2) + 4 * m * (m - 1) * (m - 2) * (TEXT_CUBE - TEXT_MATCH ** 2))
    p_match = normal_tail((matches - (squares - m)) / noise)
    switches = np.bincount(pair, (kind[1:] != kind[:-1])[same], len(n))
    p_switch = normal_tail((switches - 0.5 - (m - 1) * TEXT_SWITCH) / np.sqrt((m - 1) * TEXT_SWITCH * (1 - TEXT_SWITCH)))
    p_serial = normal_tail((TEXT_SERIAL - serial) * np.sqrt(m))
    half = -(np.log(np.maximum(p_match, 1e-30)) + np.log(np.maximum(p_switch, 1e-30)) + np.log(np.maximum(p_serial, 1e-30)))
    log_text = -half + np.log1p(half + half * half / 2)
    one_class = np.array([len(set(kind_row)) < 2 for kind_row in np.split(kind, np.cumsum(np.bincount(owner, minlength=len(n)))[:-1])])
    uniform[one_class | (encoding == 0)] = 0.0  # digits or letters of one case alone carry no sign of an encoding
    return encoding, uniform, np.exp(np.maximum(log_text, -200))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the fixed patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out)


def apart(start: int, end: int, spans: list) -> bool:
    return all(end <= s or e <= start for s, e, _ in spans)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and tested candidates of every whole text (null: empty), without the text.

    A row each, whatever its id: null, repeated and very large ids come back as they are.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            base, found, strings, owner = [], [], [], []
            for i, text in enumerate(df["text"]):
                text = text or ""
                base.append(base_spans(text))
                mine = []
                for m in CANDIDATE.finditer(text):
                    if apart(m.start(), m.end(), base[-1]):
                        mine.append([m.start(), m.end(), "", 0, 0, 0.0])
                        strings.append(m.group())
                        owner.append(mine[-1])
                found.append(mine)
            for at in range(0, len(strings), 20_000):
                encoding, uniform, text_p = battery(strings[at:at + 20_000])
                band = np.searchsorted(BANDS, [len(s) for s in strings[at:at + 20_000]], side="right") - 1
                score = np.minimum(np.floor(-np.log10(text_p) / BIN), BINS).astype(int)
                score[uniform < ALPHA] = 0
                for row, e, b, s, u in zip(owner[at:at + 20_000], encoding.tolist(), band.tolist(), score.tolist(), uniform.tolist()):
                    row[2:] = [ENCODINGS[e][0], b, s, u]
            yield pd.DataFrame({"doc_id": df["doc_id"], "text_key": df["text_key"],
                                "base": [[{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in x] for x in base],
                                "tested": [[dict(zip(("start", "end", "encoding", "band", "score", "uniform"), c)) for c in x] for x in found]})

    # pandas would turn ids beside a null one into floats, so they travel as text
    rows = docs.select(F.col(id_col).cast("bigint").cast("string").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    span = "array<struct<start: int, end: int, kind: string>>"
    tested = "array<struct<start: int, end: int, encoding: string, band: int, score: int, uniform: double>>"
    found = rows.mapInPandas(run, f"doc_id string, text_key bigint, base {span}, tested {tested}")
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def cutoffs(measured: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Per length band, the least score (bin of -log10 p) that Benjamini and Hochberg's procedure accepts at ``fdr``.

    The corpus is reduced to a histogram of bands x bins, whose size is fixed;
    a bin counts with its larger p-value, so the control is conservative.
    """
    counts = (measured.select(F.explode("tested").alias("t")).groupBy("t.band", "t.score").count()).collect()
    out = {}
    for band in range(len(BANDS)):
        mine = sorted(((r["score"], r["count"]) for r in counts if r["band"] == band), reverse=True)
        total, seen = sum(c for _, c in mine), 0
        out[band] = BINS + 1
        for score, c in mine:
            seen += c
            if score and 10 ** (-score * BIN) <= fdr * seen / total:
                out[band] = score
    return out


def scan_secrets(docs: DataFrame, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, base, spans)`` of every row; spans are structs (start, end, kind), ends exclusive, in code points.

    ``spans`` holds the base spans and the strings found random (kind
    ``random``), by start.  The measurements are written once (they hold no
    text); the corpus-wide cut-offs are then applied to them.  A null text is
    empty; repeated rows are counted and reported each; an empty table gives an
    empty result.
    """
    measured = settle(measure(docs, id_col, text_col))
    least = F.create_map(*[F.lit(x) for pair in cutoffs(measured, fdr).items() for x in pair])
    extra = F.transform(F.filter("tested", lambda t: t["score"] >= least[t["band"]]),
                        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit("random").alias("kind")))
    return measured.select("doc_id", "text_key", "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def span_list(spans: str) -> F.Column:
    """Spans as ``kind:start:end``, comma-joined, by start and then kind as listed in ``KINDS``."""
    rank = lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], rank(s["kind"]).alias("rank"), s["end"], s["kind"])))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact_secrets(docs: DataFrame, mask: str = "[REDACTED]", fdr: float = FDR) -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` and ``n_chars`` recounted; no row is dropped.

    The corpus-wide cut-offs come from a first pass; a second pass finds the
    same spans again beside the text and replaces them, so the texts are not
    shuffled.
    """
    least = cutoffs(settle(measure(docs).select("tested")), fdr)
    key = fresh_name(docs, "text_masked")

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: t if t is None else masked(t))

    def masked(text: str) -> str:
        spans = base_spans(text)
        mine = [m for m in CANDIDATE.finditer(text) if apart(m.start(), m.end(), spans)]
        if mine:
            _, uniform, p = battery([m.group() for m in mine])
            band = np.searchsorted(BANDS, [m.end() - m.start() for m in mine], side="right") - 1
            score = np.where(uniform < ALPHA, 0, np.minimum(np.floor(-np.log10(p) / BIN), BINS))
            spans = spans + [(m.start(), m.end(), 3) for m, b, s in zip(mine, band.tolist(), score.tolist()) if s >= least[b]]
        out, at = [], 0
        for start, end, _ in sorted(spans):
            if end > at:
                out += [text[at:start], mask] if start >= at else []
                at = end
        return "".join(out) + text[at:]

    new = F.pandas_udf(run, "string")
    changed = docs.withColumn(key, new(F.col("text").cast("string")))
    return changed.select(*[F.col(key).alias(c) if c == "text" else
                            (F.when(F.col(key) != F.col("text"), F.length(key)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c))
                            for c in docs.columns])

"""Small reference implementations used only by the tests, from the published algorithm (Sennrich et al., 2016)."""

import re
from collections import Counter

SF001 = "/root/testdata/sf0.001"
MARK = ""  # stands between symbols; the test corpora do not hold it


def segmented(word):
    return MARK + MARK.join([*word, "</w>"]) + MARK


def apply_merge(seg, lhs, rhs):
    """All occurrences of two neighbouring symbols joined, left to right."""
    return re.sub(f"(?<={MARK}){re.escape(lhs)}{MARK}{re.escape(rhs)}(?={MARK})", lambda _: lhs + rhs, seg)


def bpe_train(word_freqs, n_merges):
    vocabulary = {segmented(w): f for w, f in word_freqs.items()}
    learned = []
    while len(learned) < n_merges:
        weight = Counter()
        for seg, f in vocabulary.items():
            symbols = seg.strip(MARK).split(MARK)
            weight.update({pair: f * times for pair, times in Counter(zip(symbols, symbols[1:])).items()})
        if not weight:
            break
        (lhs, rhs), n = sorted(weight.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        learned.append((lhs, rhs, n))
        vocabulary = {apply_merge(seg, lhs, rhs): f for seg, f in vocabulary.items()}
    return learned


def bpe_segment(word, merges):
    seg = segmented(word)
    for lhs, rhs, *_ in merges:
        seg = apply_merge(seg, lhs, rhs)
    return seg.strip(MARK).split(MARK)

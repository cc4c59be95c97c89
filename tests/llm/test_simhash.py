"""SimHash against brute force: every pair compared, classes by union."""

import random

import numpy as np
import pytest
import xxhash

from wordmill.llm.simhash import close_in_blocks, fingerprint, link_buckets, simhash_dedup, simhash_groups


def slow_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    votes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def slow_classes(fps, radius):
    n = len(fps)
    seen, out = set(), [None] * n
    for i in range(n):
        if i in seen:
            continue
        todo, members = [i], {i}
        while todo:
            x = todo.pop()
            for y in range(n):
                if y not in members and bin(fps[x] ^ fps[y]).count("1") <= radius:
                    members.add(y)
                    todo.append(y)
        seen |= members
        for m in members:
            out[m] = frozenset(members)
    return out


def test_fingerprint_equals_definition():
    for t in ["", "one", "One two", "a B c d e f a b c", "É é x\tY\n z z z z z", "w " * 70000]:
        assert fingerprint(t.encode(), 3, 42) == slow_fingerprint(t)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_links_equal_all_pairs(radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = []
    for _ in range(400):
        x = rng.choice(base)
        for _ in range(rng.randrange(4)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    a = np.array(fps, dtype=np.uint64).view(np.int64)
    root = link_buckets(np.zeros(len(a), np.int64), a, np.zeros(len(a), np.int32), radius)
    want = slow_classes(fps, radius)
    got = {}
    for i, r in enumerate(root):
        got.setdefault(r, set()).add(i)
    assert {frozenset(v) for v in got.values()} == set(want)


def test_block_is_abandoned_when_all_exceed():
    fps = np.array([0, 2**64 - 1], dtype=np.uint64)
    planes = np.array([[2] for _ in range(64)], dtype=np.uint64)
    q, b, mask = close_in_blocks(fps, planes, np.array([2], np.uint64), np.array([0]), np.array([0]), 2)
    assert len(q) == 0


@pytest.mark.parametrize("tile", [8192, 7])
def test_groups_equal_brute_force(docs_of, tile):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 40, 200]))]
        for j in range(rng.choice([1, 1, 4])):
            near = list(text)
            if j and len(near) > 40:
                near[rng.randrange(len(near))] = "changed%d" % j
            rows.append((1000 - len(rows), " ".join(near)))
    rows += [(5, None), (6, ""), (7, "same text here"), (7, "same text here"), (None, "same text here"), (None, "lonely words of none at all"),
             (8, "long " * 30000)]
    got = simhash_groups(docs_of(rows), tile=tile, rows_per_task=16).collect()
    assert len(got) == len(rows)
    fps = [slow_fingerprint(t) for _, t in rows]
    classes = slow_classes(fps, 2)
    want = sorted((str(i), fps[n] if fps[n] < 2**63 else fps[n] - 2**64,
                   str(min((rows[m][0] for m in classes[n] if rows[m][0] is not None), default=None)))
                  for n, (i, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in got) == want


def test_dedup_keeps_one_of_each_group_and_empty_table(docs_of):
    rows = [(3, "a b c d e"), (1, "A b c d e"), (1, "A b c d e"), (2, "other text that differs"), (9, None), (8, ""), (None, "a b c d e")]
    kept = simhash_dedup(docs_of(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 8]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "size"]
    assert simhash_groups(docs_of([])).count() == 0


def test_dedup_goes_by_text_and_not_by_id(docs_of):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    kept = lambda rows: sorted((str(r.doc_id), r.text) for r in simhash_dedup(docs_of(rows)).collect())
    assert kept([(7, a), (7, b), (3, b)]) == [("3", b), ("7", a)]
    assert kept([(7, a), (7, b)]) == [("7", a), ("7", b)]
    assert kept([(None, a), (1, b), (None, b)]) == [("1", b), ("None", a)]
    assert kept([(None, a)] * 3 + [(2, b)] * 2 + [(None, None), (5, "")]) == [("2", b), ("5", ""), ("None", a)]

"""Licence scan: held-out variations of notices, ordinary and unknown wording, planted paragraphs."""

import random

import pytest

from wordmill.llm.licenses import ORDINARY, TEMPLATES, LicenceModel, containment, scan_licences, variations, words_of


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    words = ["the", "of", "and", "license", "work", "version", "copy"] + ["word%d" % i for i in range(200)]
    return LicenceModel([" ".join(rng.choices(words, k=30)).encode() for _ in range(300)])


def test_held_out_accuracy(model):
    rng = random.Random(99)
    filler = ["alpha", "beta", "the", "of", "tool", "project"]
    right = total = wrong = 0
    for family, templates in TEMPLATES.items():
        for t in templates:
            for _ in range(20):
                [found] = model.judge([words_of(variations(t, rng, filler).encode())])
                total += 1
                right += bool(found) and found[0] == family
                wrong += bool(found) and found[0] not in (family, "unknown")
    assert right / total > 0.85 and wrong / total < 0.03
    ordinary = [" ".join(rng.choices(filler + " ".join(ORDINARY).split(), k=25)) for _ in range(200)]
    assert sum(f is not None for f in model.judge([words_of(o.encode()) for o in ordinary])) <= 4


def test_unknown_and_confirmation(model):
    judge = lambda t: model.judge([words_of(t.encode())])[0]
    assert judge("All rights reserved.")[0] == "unknown"
    assert judge("Released under the MIT License.")[0] == "MIT"
    assert judge("Licensed under CC BY-NC 4.0.")[0] == "CC-BY-NC"
    assert judge("plain paragraph about nothing in particular") is None
    a = words_of(b"one two three four five")
    assert containment(a, a) == 1 and containment(words_of(b"x one two three y four five"), a) == 0.75 and containment([], a) == 0
    assert containment(words_of(b"four five one two"), a) == 0.25


def test_scan_numbers_paragraphs_and_handles_odd_rows(docs_of):
    rows = [(1, "first line\n\nReleased under the MIT License.\nlast"), (2, None), (3, ""), (4, "\n\n"), (1, "first line\n\nReleased under the MIT License.\nlast"),
            (None, "Licensed under the Apache License, Version 2.0."), (5, "word " * 50000 + "\r\nThis work is licensed under the GNU General Public License, version 3.")]
    got = sorted((str(r.doc_id), r.n_paragraphs, [(f.family, f.paragraph) for f in r.findings]) for r in scan_licences(docs_of(rows)).collect())
    assert got == [("1", 3, [("MIT", 1)]), ("1", 3, [("MIT", 1)]), ("2", 0, []), ("3", 0, []), ("4", 0, []), ("5", 2, [("GPL-3.0", 1)]), ("None", 1, [("Apache-2.0", 0)])]
    assert scan_licences(docs_of([])).count() == 0


def test_notices_wrapped_over_lines(docs_of):
    import textwrap

    long = [(f, t) for f, ts in TEMPLATES.items() for t in ts if len(t.split()) >= 14]
    assert {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL", "BSD", "ISC"} <= {f for f, _ in long}
    rows, want = [], {}
    for f, t in long:
        for start, width in ((" * ", 78), ("# ", 45), ("", 60)):
            body = "\n".join(start + line for line in textwrap.wrap(t, width))
            rows.append((len(rows), f"tool header\nword of the day\n{body}\nint main is the start of the program\nplain end"))
            want[rows[-1][0]] = [(f, 2)]
    both = "\n".join(textwrap.wrap(TEMPLATES["MIT"][2], 70) + textwrap.wrap(TEMPLATES["Apache-2.0"][1], 70) + ["Licensed under CC BY 4.0."])
    rows.append((len(rows), both))
    out = {r.doc_id: [(x.family, x.paragraph) for x in r.findings] for r in scan_licences(docs_of(rows)).collect()}
    assert [f for f, _ in out.pop(len(rows) - 1)] == ["MIT", "Apache-2.0", "CC-BY"]
    assert out == want

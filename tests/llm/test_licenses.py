"""License scans against a plain alignment of every place."""

import re

import numpy as np
import pytest

from filetally.llm import licenses
from filetally.llm.licenses import TEMPLATES, chains, common, scan_licenses

from .conftest import prose


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def longest(a, b):
    """Length of the longest common subsequence, by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("seed", range(6))
def test_common_is_a_longest_subsequence(seed):
    draw = np.random.default_rng(seed)
    a, b = draw.integers(0, 4, 15), draw.integers(0, 4, 12)
    pairs = common(a, b)
    assert len(pairs) == longest(a.tolist(), b.tolist())
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)
    assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


def test_chains_keep_copies_apart():
    one = [(10 + k, k) for k in range(4)]
    two = [(17 + k, k) for k in range(4)]
    assert sorted(chains(one + two)) == [one, two]


def spread(text, every, between):
    """The words of a text with foreign words after every so many."""
    out = []
    for k, word in enumerate(text.split(" "), 1):
        out.append(word)
        if k % every == 0:
            out += [f"foreign{k}x{j}" for j in range(between)]
    return " ".join(out)


HEADER, NOTICE = TEMPLATES["Apache-2.0-header"], TEMPLATES["MIT-notice"]
CASES = {
    "adjacent": (" ".join([NOTICE] * 3), "MIT-notice", 3),
    "one word apart": (" and ".join([NOTICE] * 4), "MIT-notice", 4),
    "many": (" ".join(NOTICE if k % 2 else prose(k, 3) for k in range(200)), "MIT-notice", 100),
    "drifting": (spread(HEADER, 5, 2), "Apache-2.0-header", 1),
    "drifting, twice": (spread(HEADER, 5, 2) + " " + spread(HEADER, 6, 3), "Apache-2.0-header", 2),
    "words left out": (" ".join(w for k, w in enumerate(HEADER.split(" ")) if k % 7 != 6), "Apache-2.0-header", 1),
    "half of it": (" ".join(HEADER.split(" ")[:18]), "Apache-2.0-header", 0),
}


@pytest.mark.parametrize("case", CASES)
def test_every_place_is_found_with_its_alignment(docs, case):
    middle, name, times = CASES[case]
    text = prose(5, 30) + "\n" + middle + "\n" + prose(6, 30)
    found = [r for r in scan_licenses(docs((1, text))).collect() if r.template == name]
    assert len(found) == times
    words, template = tokens(text), tokens(TEMPLATES[name])
    last = 0
    for r in found:
        assert r.first_word >= last  # no word counts twice
        last = r.last_word
        inside = words[r.first_word : r.last_word]
        assert r.n_matched == longest(template, inside) >= 0.6 * len(template)
        assert r.coverage == r.n_matched / len(template)
        assert tokens(r.span) == inside


def test_odd_rows_and_blocks_of_templates(docs, odd_rows, monkeypatch):
    rows = odd_rows + [(20, NOTICE), (20, NOTICE), (21, prose(3, 20_000) + " " + HEADER)]
    whole = sorted(map(str, scan_licenses(docs(*rows)).collect()))
    assert len(whole) == 4  # the long header holds the short one, too
    monkeypatch.setattr(licenses, "MOST_WORDS", 20)  # most templates are a block of their own
    assert sorted(map(str, scan_licenses(docs(*rows)).collect())) == whole
    assert scan_licenses(docs().limit(0)).collect() == []
    assert scan_licenses(docs((1, "a b")), {"short": "a b"}).collect() == []

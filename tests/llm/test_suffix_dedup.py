"""Repeats against brute force: every window of every text, and every substring of small ones."""

import hashlib
import random

import numpy as np
import pytest

from filetally.llm import suffix_dedup
from filetally.llm.suffix_dedup import (
    digest_columns,
    remove_repeats,
    repeat_groups,
    repeat_intervals,
    suffix_array,
)

from .conftest import prose


def brute(rows, least=50):
    """What the contract says, window by window; a null id is larger than all others."""
    place = {None: 1 << 63}
    texts = [(place.get(i, i), i, (t or "").encode()) for i, t in rows]
    first = {}
    for key, _, data in sorted(texts, key=lambda x: x[0]):
        for p in range(len(data) - least + 1):
            first.setdefault(data[p : p + least], key)
    out = []
    for key, i, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - least + 1):
            if first[data[p : p + least]] < key:
                gone[p : p + least] = b"\1" * least
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(frame, per_bucket=suffix_dedup.PER_BUCKET):
    got = digest_columns(remove_repeats(frame, per_bucket)).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_odd_rows_and_planted_repeats(docs, odd_rows):
    passage = prose(77, 60)
    rows = odd_rows + [
        (20, passage),
        (21, "x" + passage[:49]),  # too short by one byte
        (22, "y" + passage[:50] + "ä" * 30),
        (23, prose(78, 40) + passage + prose(79, 40) + passage + passage),
        (-5, passage[100:] + "ö"),
        (24, passage), (25, passage), (24, passage),
        (26, "ä" * 500), (27, "b" + "ä" * 26), (28, "a\0" * 60), (29, "a\0" * 40),
        (None, passage), (30, prose(7, 30_000)[1000:90_000]),
    ]
    assert found(docs(*rows).repartition(4)) == brute(rows)
    spans = {r.doc_id: r for r in remove_repeats(docs(*rows)).collect() if r.doc_id == 23}
    text = rows[[r[0] for r in rows].index(23)][1].encode()
    edges = [0, *(x for s in spans[23].spans for x in (s.start, s.end)), len(text)]
    assert b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) == spans[23].kept
    assert remove_repeats(docs().limit(0)).collect() == []


@pytest.mark.parametrize("seed, letters, per_bucket", [
    (1, "ab", 3), (2, "a", 40), (3, "abc\0", 10**6), (4, "é a", 100), (5, "xyz0123456789", 10)])
def test_equals_brute_force(docs, monkeypatch, seed, letters, per_bucket):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 2000)  # many parts
    draw = random.Random(seed)
    blocks = [
        "".join(draw.choices(letters, k=draw.choice([30, 49, 50, 51, 80, 200, 400]))) for _ in range(12)
    ]
    rows = []
    for k in range(60):
        parts = [
            draw.choice(blocks) if draw.random() < 0.7
            else "".join(draw.choices("qwertyuiopäß", k=draw.randint(1, 60)))
            for _ in range(draw.randint(0, 6))
        ]
        rows.append((draw.choice([k, k, k, 3, None, -k]), "".join(parts)))
    assert found(docs(*rows).repartition(3), per_bucket) == brute(rows)


def maximal_repeats(texts, shortest):
    """Every substring that is shared, with its occurrences, and cannot be longer at either end."""
    places = {}
    for i, t in enumerate(texts):
        for a in range(len(t)):
            for b in range(a + shortest, len(t) + 1):
                places.setdefault(t[a:b], set()).add((i, a))
    out = {}
    for s, at in places.items():
        left = {texts[i][a - 1] if a else (i, a) for i, a in at}
        right = {texts[i][a + len(s)] if a + len(s) < len(texts[i]) else (i, a) for i, a in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            out[s] = at
    return out


@pytest.mark.parametrize("seed", range(8))
def test_intervals_are_the_maximal_repeats(seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choices("ab" if seed % 2 else "abc", k=draw.randint(1, 14))) for _ in range(5)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    base = np.cumsum([0, *map(len, texts)])
    places = [(i, a) for i, t in enumerate(texts) for a in range(len(t))]
    starts = np.array([base[i] + a for i, a in places])
    rest = np.array([len(texts[i]) - a for i, a in places])
    order, common = suffix_array(data, starts, rest)
    suffixes = [texts[places[k][0]][places[k][1] :] for k in order]
    assert suffixes == sorted(suffixes)
    left = [ord(texts[i][a - 1]) if a else -1 - k for k, (i, a) in enumerate(places)]
    ids = [i for i, _ in places]
    found = {
        suffixes[low][:length]: ({places[k] for k in order[low:high]}, known)
        for length, low, high, known in repeat_intervals(
            common.tolist(), [left[k] for k in order], [ids[k] for k in order], 2
        )
    }
    expected = maximal_repeats(texts, 2)
    assert {s: at for s, (at, _) in found.items()} == expected
    assert all(known == min(i for i, _ in at) for at, known in found.values())


@pytest.mark.parametrize("parts", [1, 4])
def test_groups_have_all_occurrences(docs, monkeypatch, parts):
    """Copies with changes: each repeat is named wherever it stands, and their union is whole."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 3000)
    whole, other = prose(50, 60), prose(51, 25)
    rows = [(k, whole[: 40 * k] + f"<{k}>" + whole[40 * k :]) for k in range(8)]
    rows += [(20, other + " / " + other), (21, prose(52, 80)), (22, other), (22, other), (23, None)]
    made = repeat_groups(docs(*rows).repartition(parts), 50).collect()
    groups = {}
    for r in made:
        groups.setdefault(bytes(r.repeat), set()).add((r.doc_id, r.start))
    texts = {i: (t or "").encode() for i, t in rows}
    assert len(made) >= sum(map(len, groups.values())) > 0
    covered = {i: set() for i in texts}
    for repeat, at in groups.items():
        everywhere = {
            (i, p) for i, t in texts.items() for p in range(len(t)) if t.startswith(repeat, p)
        }
        assert len(repeat) >= 50 and at == everywhere
        assert len(at) > 1 or at == {(22, 0)}  # the id of two equal rows
        for i, p in at:
            covered[i].update(range(p, p + len(repeat)))
    for i, t in texts.items():
        windows = [p for p in range(len(t) - 49) if sum(
            o.startswith(t[p : p + 50], q) for j, o in texts.items() for q in range(len(o))) > 1 or i == 22]
        assert covered[i] == {b for p in windows for b in range(p, p + 50)}
    assert repeat_groups(docs().limit(0)).collect() == []

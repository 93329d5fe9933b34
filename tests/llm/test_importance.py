"""Weights and draws against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from filetally.llm.importance import BUCKETS, _keyed, checksums, kth_key, resample

from .conftest import prose


def features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [
        zlib.crc32(" ".join(words[i : i + k]).encode()) % BUCKETS
        for k in (1, 2, 3)
        for i in range(len(words) - k + 1)
    ]


def brute(rows, target, percent=5, least=20):
    s, t = np.zeros(BUCKETS, int), np.zeros(BUCKETS, int)
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            np.add.at(counts, features(text)[1], 1)
    a, b = int(s.sum()) + BUCKETS, int(t.sum()) + BUCKETS
    out = []
    for i, text in rows:
        words, found = features(text)
        weight = sum(
            math.floor(1000 * math.log((int(t[f]) + 1) * a / ((int(s[f]) + 1) * b))) for f in found
        )
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words), len(found), weight, weight + noise, None])
    ranked = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, row in enumerate(ranked[: len(ranked) * percent // 100]):
        row[5] = k + 1
    return sorted(map(tuple, out), key=str)


def found(frame, target, **options):
    return sorted((tuple(r) for r in resample(frame, target, **options).collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    texts = [prose(k, 60) for k in range(20)] + [None, ""]
    return texts, spark.createDataFrame([(t, 1) for t in texts], "text string, doc_id long")


@pytest.mark.parametrize("percent, least", [(5, 20), (50, 20), (100, 0), (5, 10**6)])
def test_equals_brute_force(docs, odd_rows, target, percent, least):
    texts, frame = target
    rows = odd_rows + [(100 + k, prose(k % 70, 15 + k % 40) + " Größe,ÉTÉ 12a") for k in range(150)]
    rows += [(300 + k, "w" * (60 + k) + " " + prose(k, 30)) for k in range(10)]  # long words
    got = found(docs(*rows).repartition(3), frame, percent=percent, least_words=least)
    expected = brute(rows, texts, percent, least)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    # Rows equal in all but their rank may share their ranks in either order.
    assert sorted(r[5] or 0 for r in got) == sorted(r[5] or 0 for r in expected)
    assert {r[0]: r[5] for r in got if r[0] not in (5, None)} == {
        r[0]: r[5] for r in expected if r[0] not in (5, None)}


def test_empty_tables(docs, target, spark):
    texts, frame = target
    assert resample(docs().limit(0), frame).collect() == []
    rows = [(k, prose(k, 30)) for k in range(40)]
    assert found(docs(*rows), frame.limit(0)) == brute(rows, [])


def test_quickselect_finds_every_rank(spark):
    scores = [5, 5, 5, 9, -3, 0, 0, 7, 5, 1]
    rows = [(k % 4 if k % 3 else None, s, k) for k, s in enumerate(scores)]
    keyed = _keyed(spark.createDataFrame(rows, "doc_id long, score long, row long")).cache()
    order = sorted((-s, i is None, i or 0, r) for i, s, r in rows)
    assert [kth_key(keyed, k + 1, pivots=2) for k in range(len(rows))] == order
    keyed.unpersist()


def test_checksums_of_all_lengths():
    data = np.frombuffer(bytes(range(256)) * 2, np.uint8)
    starts = np.arange(200)
    ends = starts + np.arange(200)
    assert checksums(data, starts, ends).tolist() == [
        zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]

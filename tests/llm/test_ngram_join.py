import re
from itertools import combinations

import pytest
from .conftest import prose

from filetally.llm.ngram_join import Rule, components, near_duplicates


def brute(rows, rule):
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        k = rule.words
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(list(zip([r[0] for r in rows], sets, strict=True)), 2):
        if a is None or b is None or not x or not y:
            continue
        if 100 * len(x & y) >= rule.percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted(
        (i if i is not None else -1, len(s), find(i) if i is not None else -1)
        for (i, _), s in zip(rows, sets, strict=True)
    )


def result(df):
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1)
        for r in df.collect()
    )


def edited(text, *places):
    w = text.split(" ")
    for p in places:
        w[p % len(w)] = f"changed{p}"
    return " ".join(w)


@pytest.mark.parametrize("rule", [Rule(3, 90), Rule(5, 80)])
def test_components_equal_brute_force(docs, rule):
    rows = [(k, prose(k, 20 + 7 * k)) for k in range(12)]
    base = prose(50, 150)
    # a chain: each text one more change away from the first, and copies of some
    rows += [(100 + k, edited(base, *range(5, 5 + 12 * k, 12))) for k in range(10)]
    rows += [(200 + k, edited(base, 30 + k)) for k in range(20)]
    rows += [(300, base), (301, base), (302, base.upper())]
    # texts that share a passage but not more
    rows += [(400 + k, prose(60, 60) + " " + prose(400 + k, 90)) for k in range(12)]
    rows += [(500, "one two"), (501, "one two"), (502, "two one"), (503, "one")]
    rows += [(600, prose(70, 12)), (601, edited(prose(70, 12), 0)), (602, edited(prose(70, 12), 11))]
    assert result(near_duplicates(docs(*rows), rule)) == brute(rows, rule)


def test_odd_rows(docs, odd_rows):
    rule = Rule(5, 80)
    found = result(near_duplicates(docs(*odd_rows), rule))
    assert found == brute(odd_rows, rule)
    assert (2, 0, 2) in found and (3, 0, 3) in found


def test_empty_table(docs):
    assert near_duplicates(docs().limit(0)).collect() == []


def test_an_id_with_two_texts_joins_their_groups(docs):
    a, b = prose(80, 60), prose(81, 60)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, prose(82, 60))]
    found = result(near_duplicates(docs(*rows), Rule(5, 80)))
    assert [r[2] for r in found] == [1, 1, 1, 1, 4]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(90, 91)], "a long, b long")
    found = {r.id: r.root for r in components(links).collect()}
    assert found == {k: 0 for k in range(41)} | {90: 90, 91: 90}

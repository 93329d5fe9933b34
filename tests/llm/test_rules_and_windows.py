"""Quality rules, decontamination, mixing and chat formatting against plain Python."""

import re
from collections import Counter, defaultdict
from hashlib import md5, sha256

import pytest

from filetally.llm.chat import format_chats
from filetally.llm.decontaminate import find_contamination
from filetally.llm.mixing import Target, find_exponent, mix_sources, sources_of
from filetally.llm.quality_rules import assess

from .conftest import prose

SPACE_WORD = r"[^\x20\x09-\x0D]+"


def measures(text):
    w = re.findall(SPACE_WORD, text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(SPACE_WORD, x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(hit),
        len(w) < 50 or 100 * len(hit) > 50 * len(w),
    )


@pytest.fixture(scope="module")
def judged(docs, odd_rows):
    rows = odd_rows + [
        (20, "\n".join([prose(20, 40) + "."] * 3 + [prose(21, 40)])),
        (21, "one two three " * 40),
        (22, prose(22, 60) + "\n" + "\n".join(f"Home{k} | About{k} | News" for k in range(60))),
        (23, prose(23, 90) + ".\nAll rights reserved\nÉtude über größe ß."),
        (24, " ".join(w + "%%%" for w in prose(24, 80).split())),
    ]
    return rows, assess(docs(*rows)).collect()


def test_base_measures(judged):
    rows, found = judged
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    expected = sorted(((i, measures(t)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, tuple(r[n] for n in names)) for r in found), key=key) == expected


def test_lines_fail_and_documents_that_lose_too_much_go(judged):
    found = {r.doc_id: r for r in judged[1]}
    assert found[20].kept is False or found[20].base_failed is False
    assert found[22].n_failed_lines == 60 and not found[22].kept and not found[22].base_failed
    assert found[23].kept and found[23].n_failed_lines == 1
    assert "All rights" not in found[23].clean_text and "Étude" in found[23].clean_text
    assert not found[24].kept and not found[24].base_failed
    assert found[5].kept and found[7].kept
    assert found[1].clean_text == "" and not found[1].kept


BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bench_words(text):
    return re.findall(BENCH_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(rows, items):
    windows = defaultdict(set)
    for i, text in items:
        w = bench_words(text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add("" if i is None else str(i))
    out = []
    for i, text in rows:
        w, hit, found = bench_words(text), set(), set()
        for window, names in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found |= names
        names = ",".join(sorted(found))
        bad = bool(hit) and 20 * len(hit) >= len(w)
        out.append((i, len(w), len(hit), len(found), sha256(names.encode()).hexdigest(), bad))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark, docs, odd_rows):
    passage = prose(30, 60)
    parts = passage.split(" ")
    items = [
        (1, passage),
        (2, "Éclair über Größe"),
        (3, "word"),
        (4, " ".join(parts[:13])),
        (5, ""),
        (6, None),
        (7, passage),
        (None, "mile stone mile stone"),
    ]
    rows = odd_rows + [
        (30, prose(31, 40) + " " + passage.upper() + " " + prose(32, 40)),
        (31, prose(33, 500) + " " + " ".join(parts[5:18])),
        (32, prose(34, 20) + " " + " ".join(parts[5:17])),
        (33, "eclair Éclair über Größe! Éclair, über größe"),
        (34, "mile stone mile stone mile stone mile stone"),
        (35, "words word-word sword"),
    ]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for most_broadcast in (1000, 0):  # at 0 the shingles are joined by a shuffle
        found = find_contamination(docs(*rows), bench, most_broadcast).collect()
        got = sorted((tuple(r[n] for n in names) for r in found), key=str)
        assert got == contamination(rows, items)
    assert find_contamination(docs().limit(0), bench).collect() == []


def test_an_empty_benchmark_leaves_all_clean(spark, docs, odd_rows):
    bench = spark.createDataFrame([], "item_id long, text string")
    found = find_contamination(docs(*odd_rows), bench).collect()
    assert len(found) == len(odd_rows) and not any(r.contaminated for r in found)


def place(block, doc):
    return int(md5(f"0/{block}/{'' if doc is None else doc}".encode()).hexdigest()[:15], 16)


def test_mixing_realises_the_weights(docs):
    rows = [(k, "w " * (5 + k % 7), "en", "big") for k in range(300)]
    rows += [(1000 + k, "w " * (5 + k % 5), "en", "small") for k in range(60)]
    rows += [(2000 + k, "w " * 9, "en", None) for k in range(40)] + [(3000, None, "en", "empty")]
    rows += [(1000, "w " * 5, "en", "small")]
    made = mix_sources(docs(*rows), Target(repeats=1.5)).collect()
    tokens = {}
    for i, text, _, source in rows:
        if text:
            tokens.setdefault(source, []).append((i, len(text.split())))
    total = sum(n for part in tokens.values() for _, n in part)
    taken = Counter()
    for r in made:
        taken[r.source] += r.n_tokens
    weight = {r.source: r.weight for r in made}
    assert abs(sum(weight.values()) - 1) < 1e-6
    for source, part in tokens.items():
        whole = sum(n for _, n in part)
        quota = weight[source] * total
        assert 0 <= taken[source] - quota + 1 <= max(n for _, n in part) + 2
        assert quota / whole <= 1.5 + 1e-6
        blocks, rest = divmod(round(quota), whole)
        for block in range(blocks + 1):
            order = sorted((place(block, i), i, n) for i, n in part)
            upto, expected = 0, []
            for key, i, n in order:
                if block < blocks or upto < rest:
                    expected.append((i, key))
                upto += n
            got = [(r.doc_id, r.order_key) for r in made if r.source == source and r.block == block]
            assert sorted(got) == sorted(expected)


def test_entropy_target_and_empty_table(docs):
    rows = [(k, "a b c", "en", "x" if k % 10 else "y") for k in range(200)]
    counted = docs(*rows).selectExpr("source", "3L AS n_tokens")
    exponent = find_exponent(sources_of(counted), Target(entropy=0.9, repeats=None))
    assert 0 < exponent < 1
    assert mix_sources(docs().limit(0)).collect() == []


TURNS = "conv_id long, turn long, role string, text string, place string"


def chat_rows(*conversations):
    return [(i, k, *turn, "x") for i, turns in conversations for k, turn in enumerate(turns)]


def test_snapshots_collapse(spark):
    talk = [("user" if k % 2 == 0 else "assistant", f"line {k}") for k in range(600)]
    other = [("user", "line 0"), ("assistant", "else")]
    rows = chat_rows(
        (1, talk[:2]), (2, talk[:5]), (3, talk), (4, talk), (5, other), (6, talk[:1]), (7, talk[1:4])
    )
    rows += [(8, 0, None, None, "x"), (9, 0, "user", "", "x"), (None, 0, "user", "lost", "x")]
    rows += [(9, 0, "user", "", "x"), (10, None, "user", "<|end|>", "x"), (10, 1, "user", "b", "x")]
    found = format_chats(spark.createDataFrame(rows, TURNS), segment=64).collect()
    kept = {r.conv_id: (r.n_turns, r.n_copies) for r in found}
    assert kept == {3: (600, 2), 5: (2, 1), 7: (3, 1), 8: (1, 1), 9: (1, 1), 10: (2, 1)}
    long = sorted((r.segment, r.rendered) for r in found if r.conv_id == 3)
    whole = "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in talk)
    assert len(long) == 10 and "".join(t for _, t in long) == whole
    ten = next(r.rendered for r in found if r.conv_id == 10)
    assert ten == "<|user|>\n< |end|>\n<|end|>\n<|user|>\nb\n<|end|>\n"
    assert format_chats(spark.createDataFrame([], TURNS)).collect() == []

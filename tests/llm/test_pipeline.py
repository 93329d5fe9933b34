"""Each stage by itself against brute force, and all of them one after another."""

import re

import pytest

import corpus_pipeline
from corpus_pipeline import (
    STAGES,
    drop_contaminated,
    drop_low_quality,
    drop_near_duplicates,
    drop_toxic,
    run,
)

from .conftest import prose
from .test_rules_and_windows import contamination

PASSAGE = prose(900, 30)


@pytest.fixture(scope="module")
def corpus(spark, docs, labels, odd_rows, tmp_path_factory):
    """Tables with a planted case for every stage; ids of a stage's cases share their hundreds."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    lines = ["\n".join(prose(50 * k + j, 9) for j in range(12)) for k in range(60)]
    rows = [(k, text, "en", "web" if k % 3 else "books") for k, text in enumerate(lines, 5000)]
    for k in range(40):  # toxic: a word that only the labels reveal
        words = (lines[k % 20] + " " + prose(7000 + k, 40)).split(" ")
        words[::15] = ["grumpfel"] * len(words[::15])
        rows.append((100 + k, " ".join(words), "xx", "web"))
    rows.append((200, "too short", "en", "web"))
    rows.append((201, " | ".join(prose(300, 100).split(" ")), "en", "web"))
    whole = prose(301, 200)
    rows += [(300, whole, "en", "web"), (301, whole, "en", "web"), (302, whole + " end", "en", "web")]
    rows.append((400, prose(401, 100) + " " + PASSAGE.upper(), "en", "web"))
    rows += [(i if i is None else 600 + i, text, None, None) for i, text in odd_rows]
    frame = docs(*rows)
    frame.write.parquet(f"{folder}/documents.parquet")
    marks = [(5000 + k, 1, 0) for k in range(60)] + [(100 + k, 1, 1) for k in range(40)]
    labels(*marks).write.parquet(f"{folder}/labels.parquet")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def kept_ids(frame):
    return sorted((r.doc_id for r in frame.collect()), key=str)


def test_stage_toxicity(spark, corpus):
    folder, rows = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = drop_toxic(spark, frame, folder)
    assert kept.columns == frame.columns
    left = kept_ids(kept)
    assert sum(i in left for i in range(100, 140)) <= 4
    clean = [r[0] for r in rows if r[0] is None or not 100 <= r[0] < 140]
    assert sum(i in left for i in set(clean)) >= 0.95 * len(set(clean))


@pytest.mark.parametrize("most_broadcast", [1000, 0])
def test_stage_quality(spark, corpus, most_broadcast):
    folder, rows = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = drop_low_quality(spark, frame, folder, most_broadcast)
    assert kept.columns == frame.columns

    def base_failed(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        return len(words) < 50 or 100 * len(again) > 50 * len(words)

    short = [r[0] for r in rows if len(r[1] or "") < 20_000 and base_failed(r[1])]
    left = kept_ids(kept)
    assert len(left) == len(rows) - len(short) - 1  # 201 fails by its lines
    assert not set(left) & (set(short) | {201}) - {None}
    assert None in left  # one row without id is prose, the other has no text


@pytest.mark.parametrize("most_broadcast", [1000, 0])
def test_stage_near_duplicates(spark, corpus, most_broadcast):
    folder, rows = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = drop_near_duplicates(spark, frame, folder, most_broadcast)
    assert kept.columns == frame.columns
    left = kept_ids(kept)
    assert 300 in left and 301 not in left and 302 not in left
    assert left.count(605) == 1 and left.count(None) == 2

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    alone = [
        i for i, s in sets.items()
        if not any(o < i and s and 100 * len(s & t) >= 80 * len(s | t) for o, t in sets.items())
    ]
    assert sorted(i for i in left if i is not None) == sorted(alone)


@pytest.mark.parametrize("most_broadcast", [1000, 0])
def test_stage_decontamination(spark, corpus, most_broadcast):
    folder, rows = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = drop_contaminated(spark, frame, folder, most_broadcast)
    assert kept.columns == frame.columns
    bad = {i for i, *_, flag in contamination([r[:2] for r in rows], [(1, PASSAGE)]) if flag}
    assert bad == {400}
    assert kept_ids(kept) == sorted((r[0] for r in rows if r[0] not in bad), key=str)


def test_all_stages(spark, corpus, docs, labels, tmp_path):
    folder, rows = corpus
    assert [name for name, _ in STAGES] == [
        "toxicity", "quality rules", "near duplicates", "decontamination", "mixing"]
    made = run(spark, folder)
    ids = {r.doc_id for r in made.collect()}
    assert not ids & {200, 201, 301, 302, 400}
    assert len(ids & set(range(5000, 5060))) >= 55
    empty = str(tmp_path)
    docs().limit(0).write.parquet(f"{empty}/documents.parquet")
    labels((1, 1, 1)).write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert run(spark, empty).collect() == []
    assert corpus_pipeline.ORACLE_SQL is None

"""Chunks of the language model: what they hold, and how much of them a task holds at once."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from filetally.llm import language_model as module
from filetally.session import materialize

from .conftest import prose
from .test_models import lm_words


def chunks_of(texts, trained):
    batch = pa.record_batch(
        {
            "doc_id": pa.array(range(len(texts)), pa.int64()),
            "text": pa.array(texts, pa.string()),
            "trained": pa.array(trained, pa.bool_()),
        }
    )
    return list(module.tokenise([batch]))


@pytest.mark.parametrize(
    "texts",
    [
        [prose(1, 50), None, "Été ÉTÉ été\x00x \x00 b\x0bB", "", prose(2, 9), prose(1, 50)],
        [None, "", " \t"],
        ["one"],
    ],
)
def test_a_vocabulary_leaves_its_chunk_in_pieces(monkeypatch, texts):
    monkeypatch.setattr(module, "PLACED", 3)
    trained = [k % 3 != 1 for k in range(len(texts))]
    chunks = chunks_of(texts, trained)
    pieces = list(module.vocabularies(chunks))
    assert all(0 < p.num_rows <= 3 for p in pieces)
    rows = [r for p in pieces for r in p.to_pylist()]
    assert [r["place"] for r in rows] == list(range(len(rows)))
    words = [lm_words(t)[:-1] for t in texts]
    counts = Counter(w for own, learned in zip(words, trained) if learned for w in own)
    assert {r["word"]: r["n"] for r in rows} == {w: counts[w] for own in words for w in own}
    (chunk,) = [r for c in chunks for r in c.to_pylist()]
    assert {r["chunk"] for r in rows} <= {chunk["chunk"]}
    sizes = np.array(chunk["sizes"])
    codes = module.unpacked(chunk["codes"], int(sizes.sum()), chunk["wide"])
    assert [rows[c]["word"] for c in codes] == [w for own in words for w in own]


class Stored(Exception):
    pass


def test_a_task_reads_few_chunks_at_once(docs, monkeypatch):
    """Row groups are bounded, and no vocabulary becomes an array of the JVM."""
    draw = random.Random(7)
    rows = [(k, " ".join(f"{draw.getrandbits(40):x}" for _ in range(400_000))) for k in range(9)]
    kept = []

    def stored(df, label, *more):
        kept.append(materialize(df, label, *more))
        raise Stored

    monkeypatch.setattr(module, "materialize", stored)
    with pytest.raises(Stored):
        module.score_documents(docs(*rows).coalesce(1))
    assert dict(kept[0].dtypes)["words"] == "binary"
    (file,) = (Path(f.removeprefix("file://")) for f in kept[0].inputFiles())
    held = pq.ParquetFile(file).metadata
    assert held.num_rows == 9
    groups = [held.row_group(k) for k in range(held.num_row_groups)]
    assert sum(g.total_byte_size for g in groups) > 2 * (8 << 20)
    longest = max(g.total_byte_size / g.num_rows for g in groups)
    assert all(g.total_byte_size < (8 << 20) + longest for g in groups)

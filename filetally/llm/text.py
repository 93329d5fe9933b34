"""Whole texts as byte arrays inside tasks: word bounds and 64-bit word fingerprints.

A batch of texts is one byte buffer with text bounds. Words are found by a table lookup per
byte, and fingerprints by a prefix sum over ``byte * M**position`` modulo 2**64, so the cost
per byte is a few numpy operations however long the words are. Two different words share a
fingerprint with a probability of about 2**-64; whatever reports words keeps their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20  # bytes hashed at once; a longer text is a piece of its own
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[ord("A") : ord("Z") + 1] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, so that any part of them can serve as a hash."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column and the bounds of each; null is an empty text."""
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    size = int(bounds[-1])
    if data is None or size == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, size)[bounds[0] :], bounds - bounds[0]


def runs(bounds: np.ndarray, size: int):
    """Row ranges (first, end) of about ``size`` bytes each, with at least one row."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end
        first = end


def word_bounds(data, bounds, space=SPACE):
    """Start and end of every word; a word ends at a separator and at its text's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~space[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[bounds] = True
    after = np.empty(len(data), dtype=bool)  # a word cannot go on across the byte before
    after[0] = True
    after[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (after | begins[:-1]))
    before = np.empty(len(data), dtype=bool)
    before[-1] = True
    before[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (before | begins[1:])) + 1
    return starts, ends


def fingerprints(data, starts, ends, fold=LOWER):
    """Fingerprint of ``data[start:end]`` for each pair, after folding bytes by a table."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.full(len(data) + 1, MULTIPLIER, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((fold[data].astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        inverse = np.full(len(data) + 1, INVERSE, np.uint64)  # an empty word may start at the end
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        return mix((total[ends] - total[starts]) * inverse[starts])


def words(data, bounds, fold=LOWER, space=SPACE):
    """Fingerprint, start, end of every word and the number of words before each text."""
    parts = []
    for first, end in runs(bounds, PIECE):
        low = bounds[first]
        piece = data[low : bounds[end]]
        starts, ends = word_bounds(piece, bounds[first : end + 1] - low, space)
        parts.append((fingerprints(piece, starts, ends, fold), starts + low, ends + low))
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(bounds), np.int64)
    hashes, starts, ends = (np.concatenate(p) for p in zip(*parts, strict=True))
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def slices(data, starts, ends):
    """The byte ranges as an Arrow string array, without a Python loop over bytes."""
    sizes = (ends - starts).astype(np.int64)
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, sizes)
    chars = data[index] if len(index) else np.zeros(0, np.uint8)
    small = offsets.astype(np.int32)
    return pa.StringArray.from_buffers(
        len(sizes), pa.py_buffer(small.tobytes()), pa.py_buffer(chars.tobytes())
    )


def first_places(codes: np.ndarray, distinct: int) -> np.ndarray:
    """First position of each code."""
    places = np.empty(distinct, np.int64)
    places[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return places


def column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """Record batch of the declared schema."""
    arrays = []
    for field in schema:
        values = columns[field.name]
        if isinstance(values, (pa.Array, pa.ChunkedArray)):
            arrays.append(values.cast(field.type))
        else:
            arrays.append(pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)

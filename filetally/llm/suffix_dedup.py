"""Suffix-array dedup: repeats of at least ``LEAST`` bytes, by common-prefix interval trees.

Every window of ``LEAST`` bytes is known by the smallest hash of its ``GRAM``-byte grams, so
equal windows have equal keys wherever they stand. A text falls into stretches of windows with
one key, and windows can only be equal within a key. That deals the work out in four passes:

1. documents are written once, bucketed by the part they were read in, so that later passes
   over them exchange nothing but answers;
2. each part sends its distinct keys, 4 bytes each, to the key's bucket, which replies with a
   bit: seen in another document or not;
3. stretches of shared keys, distinct within the part and with their smallest document, go to
   their bucket. It sorts the suffixes of all its stretches, takes the common prefixes of
   neighbours and scans them with a stack. Each interval of the resulting tree that has more
   than one left extension is a maximal repeat of those stretches, and its smallest document
   is the first to hold it. The reply has, for each stretch, its own smallest document and
   the longer or older repeats within it;
4. each part lays the repeats over its documents and removes what an earlier one has.

Copies meet once per part and not once per document, so a passage that a third of all documents
share costs a bucket one row a part. A repeat longer than a stretch comes back as overlapping
repeats of the stretches along it, whose union it is. Stretches of a part are equal if their
64-bit key and an independent 64-bit digest are; buckets compare the bytes themselves.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import materialize, texts
from filetally.llm.text import buffer_of, mix, runs
from filetally.session import scratch

LEAST = 50  # bytes of a repeat
GRAM = 24  # bytes of a gram, a multiple of 8; short grams are common to unrelated texts
GRAMS = LEAST - GRAM + 1  # grams of a window
LONGEST = 64  # windows of one stretch; a longer one is cut
PER_BUCKET = 1 << 18  # stretches a bucket is meant for, before those of one document go
KEY_BITS = 4  # keys alone are small: so many bits fewer tell their buckets apart
PART_BYTES = 8 << 20  # of a part's texts, about; a part is worked on in one piece of memory
PIECE = 1 << 18  # bytes worked on at once; a longer text is a piece of its own
NO_ID = np.iinfo(np.int64).max  # stands for a null id, which is larger than all others
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, out=out)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position; the last few reach into padding."""
    padded = np.zeros(len(data) + GRAM, np.uint8)
    padded[: len(data)] = data
    out = np.full(len(data), MULTIPLIER, np.uint64)
    with np.errstate(over="ignore"):
        for offset in range(0, GRAM, 8):
            blocks = np.ndarray((len(data),), np.dtype("<u8"), padded.data, offset, strides=(1,))
            out = mix(out + blocks * np.uint64(2 * offset + 1))
    return out


def sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of gram hashes by position, and the factors that undo the position."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(hashes * powers(MULTIPLIER, len(hashes)), out=total[1:])
    return total, powers(INVERSE, len(hashes) + 1)


def digests(total, inverse, starts, sizes) -> np.ndarray:
    """Digest of ``data[start:start + size]`` by its grams; sizes are at least ``GRAM``."""
    with np.errstate(over="ignore"):
        return mix((total[starts + sizes - GRAM + 1] - total[starts]) * inverse[starts])


def window_keys(hashes: np.ndarray) -> np.ndarray:
    """Smallest of ``GRAMS`` hashes from each position, by doubling."""
    low, width = hashes, 1
    while 2 * width <= GRAMS:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = GRAMS - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def piece_stretches(data: np.ndarray, bounds: np.ndarray):
    """Key, start, windows, digest and text number of the stretches of one piece."""
    if len(data) < LEAST:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none
    hashes = gram_hashes(data)
    keys = window_keys(hashes)[: len(data) - LEAST + 1]
    sizes = np.diff(bounds)
    inside = np.zeros(len(data) + 1, np.int8)  # marks windows that lie within one text
    fit = sizes >= LEAST
    np.add.at(inside, bounds[:-1][fit], 1)
    np.add.at(inside, bounds[1:][fit] - LEAST + 1, -1)
    valid = np.cumsum(inside[: len(keys)], dtype=np.int8).astype(bool)
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | ~valid[:-1]
    begins = bounds[:-1][fit]
    fresh[begins] = True
    starts = np.flatnonzero(fresh & valid)
    upto = np.cumsum(valid)
    windows = np.diff(np.append(upto[starts] - 1, upto[-1]))
    parts = -(-windows // LONGEST)
    if len(parts) and parts.max() > 1:
        number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + number * LONGEST
        windows = np.minimum(np.repeat(windows, parts) - number * LONGEST, LONGEST)
    total, inverse = sums(hashes)
    found = digests(total, inverse, starts, windows + LEAST - 1)
    owner = np.searchsorted(bounds, starts, "right") - 1
    return mix(keys[starts]), starts, windows, found, owner


class Part:
    """The stretches of one part's documents."""

    def __init__(self, table: pa.Table):
        text = table.column("text").combine_chunks()
        self.data, self.bounds = buffer_of(text)
        ids = table.column("doc_id").combine_chunks().fill_null(NO_ID)
        self.ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        found = []
        for first, end in runs(self.bounds, PIECE):
            low = self.bounds[first]
            keys, starts, windows, digest, owner = piece_stretches(
                self.data[low : self.bounds[end]], self.bounds[first : end + 1] - low
            )
            found.append((keys, starts + low, windows, digest, owner + first))
        if not found:
            found = [piece_stretches(self.data[:0], self.bounds[:1])]
        self.keys, self.starts, self.windows, self.digest, self.owner = (
            np.concatenate(c) for c in zip(*found, strict=True)
        )

    def distinct_keys(self):
        """Sorted keys, and whether two texts of this part have them."""
        order = np.argsort(self.keys, kind="stable")
        keys, owner = self.keys[order], self.owner[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
        last = np.append(first[1:], len(keys)) - 1
        return keys[first], owner[first] != owner[last[: len(first)]]

    def keep_shared(self, masks: dict[int, bytes], bits: int) -> None:
        """Go on with the stretches whose keys the buckets have seen in another document."""
        keys, _ = self.distinct_keys()
        shared = np.zeros(len(keys), dtype=bool)
        for bucket, low, high in bucket_ranges(keys, bits):
            if bucket in masks:
                flags = np.unpackbits(np.frombuffer(masks[bucket], np.uint8), count=high - low)
                shared[low:high] = flags.astype(bool)
        kept = shared[np.searchsorted(keys, self.keys)] if len(keys) else shared
        for name in ("keys", "starts", "windows", "digest", "owner"):
            setattr(self, name, getattr(self, name)[kept])

    def order_distinct(self) -> None:
        """Sort stretches so that equal ones stand together; ``first`` begins each group."""
        order = np.lexsort((self.digest, self.windows, self.keys))
        for name in ("keys", "starts", "windows", "digest", "owner"):
            setattr(self, name, getattr(self, name)[order])
        new = np.ones(len(order), dtype=bool)
        for c in (self.keys, self.windows, self.digest):
            if len(order):
                new[1:] &= c[1:] == c[:-1]
        if len(order):
            new[1:] = ~new[1:]
        self.first = np.flatnonzero(new)

    def least_ids(self) -> np.ndarray:
        """Smallest document of each group of equal stretches."""
        if not len(self.first):
            return np.zeros(0, np.int64)
        return np.minimum.reduceat(self.ids[self.owner], self.first)


def bucket_ranges(keys: np.ndarray, bits: int):
    """Bucket and range of the sorted keys of each bucket: the first ``bits`` of the key."""
    if not len(keys):
        return
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for low, high in zip(edges, np.append(edges[1:], len(keys)), strict=True):
        yield int(bucket[low]), int(low), int(high)


KEYS = pa.schema(
    [("bucket", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("twice", pa.binary())]
)
KEYS_SQL = "bucket long, part int, keys binary, twice binary"


def key_sender(bits: int):
    """Function for ``applyInArrow``: a part's distinct keys, by bucket."""

    def run(key, table):
        keys, twice = Part(table).distinct_keys()
        short = ((keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rows = {name: [] for name in KEYS.names}
        for bucket, low, high in bucket_ranges(keys, bits):
            rows["bucket"].append(bucket)
            rows["part"].append(key[0].as_py())
            rows["keys"].append(short[low:high].tobytes())
            rows["twice"].append(np.packbits(twice[low:high]).tobytes())
        return pa.table(rows, schema=KEYS)

    return run


REPLIES = pa.schema(
    [
        ("part", pa.int32()),
        ("bucket", pa.int64()),
        ("mask", pa.binary()),  # first reply: which keys are shared
        ("least", pa.binary()),  # second: smallest document of each stretch,
        ("at", pa.binary()),  # and older repeats within: number of the stretch,
        ("offset", pa.binary()),
        ("size", pa.binary()),
        ("older", pa.binary()),  # and their smallest document
    ]
)
REPLIES_SQL = (
    "part int, bucket long, mask binary, least binary, at binary, offset binary, size binary,"
    " older binary"
)


def table_of(schema: pa.Schema, rows: list[dict]) -> pa.Table:
    return pa.table({n: [r.get(n) for r in rows] for n in schema.names}, schema=schema)


def shared_keys(key, table):
    """For ``applyInArrow``: which keys of a bucket stand in more than one document."""
    rows = table.to_pylist()
    sent = [np.frombuffer(r["keys"], np.uint32) for r in rows]
    twice = [
        np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(k)).astype(bool)
        for r, k in zip(rows, sent, strict=True)
    ]
    every = np.sort(np.concatenate(sent))
    several = every[1:][every[1:] == every[:-1]]
    several = np.unique(np.concatenate([several, *(k[t] for k, t in zip(sent, twice, strict=True))]))
    out = []
    for r, keys in zip(rows, sent, strict=True):
        place = np.minimum(np.searchsorted(several, keys), max(len(several) - 1, 0))
        flags = several[place] == keys if len(several) else np.zeros(len(keys), dtype=bool)
        if flags.any():
            mask = np.packbits(flags).tobytes()
            out.append({"part": r["part"], "bucket": r["bucket"], "mask": mask})
    return table_of(REPLIES, out)


STRETCHES = pa.schema(
    [
        ("bucket", pa.int64()),
        ("part", pa.int32()),
        ("sizes", pa.binary()),
        ("bytes", pa.binary()),
        ("least", pa.binary()),
    ]
)
STRETCHES_SQL = "bucket long, part int, sizes binary, bytes binary, least binary"


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The byte ranges one after another."""
    ends = np.cumsum(sizes)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def masked_part(table: pa.Table, replies: list[dict], bits: int) -> Part:
    """The part with its stretches of shared keys, equal ones together."""
    part = Part(table)
    masks = {r["bucket"]: r["mask"] for r in replies if r["mask"] is not None}
    part.keep_shared(masks, bits)
    part.order_distinct()
    return part


def stretch_sender(key_bits: int, bits: int):
    """Function for a cogroup: a part's distinct stretches of shared keys, by bucket."""

    def run(key, table, replies):
        if not table.num_rows:
            return STRETCHES.empty_table()
        part = masked_part(table, replies.to_pylist(), key_bits)
        least, first, out = part.least_ids(), part.first, []
        for bucket, low, high in bucket_ranges(part.keys[first], bits):
            these = first[low:high]
            sizes = part.windows[these] + LEAST - 1
            out.append(
                {
                    "bucket": bucket,
                    "part": key[0].as_py(),
                    "sizes": sizes.astype(np.uint8).tobytes(),
                    "bytes": gathered(part.data, part.starts[these], sizes).tobytes(),
                    "least": least[low:high].tobytes(),
                }
            )
        return table_of(STRETCHES, out)

    return run


def suffix_array(data: np.ndarray, starts: np.ndarray, rest: np.ndarray):
    """Enhanced suffix array of the suffixes ``data[start:start + rest]``, each of at most
    ``LONGEST + LEAST - 1`` bytes: their order, and the common prefix of each with the next."""
    width = LONGEST + LEAST - 1
    order = np.argsort(rest, kind="stable")  # a suffix comes before those it is the beginning of
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, width), (1, 1))[starts[order]]
    rows[np.arange(width) >= rest[order, None]] = 0
    by = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    order, rows = order[by], rows[by]
    differs = rows[1:] != rows[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    return order, np.minimum(common, np.minimum(rest[order[1:]], rest[order[:-1]]))


def repeat_intervals(common, left, least, shortest: int = LEAST):
    """Maximal repeats: ``(length, low, high, id)`` for each interval ``low:high`` of the suffix
    array whose suffixes share ``length`` bytes, at least ``shortest``, and no more, and differ
    in their left extension; ``id`` is the smallest of ``least`` in it. Inner intervals come
    before the ones that hold them, so all occurrences are named, not just neighbours.

    One scan: the stack holds the open intervals, each with its length, first suffix, smallest
    id and left extension (None once there are two).
    """
    stack: list[list] = []
    for i in range(len(common) + 1):
        now = common[i] if i < len(common) else 0
        # what the suffix i adds, then what intervals closed here hand on to the one around
        begin, smallest, before = i, least[i], left[i]
        while stack and stack[-1][0] > now:
            length, low, known, extension = stack.pop()
            known = min(known, smallest)
            extension = extension if extension == before else None
            if extension is None:
                yield length, low, i + 1, known
            begin, smallest, before = low, known, extension
        if now >= shortest:
            if stack and stack[-1][0] == now:
                top = stack[-1]
                top[2] = min(top[2], smallest)
                top[3] = top[3] if top[3] == before else None
            else:
                stack.append([now, begin, smallest, before])


def bucket_repeats(data: np.ndarray, bounds: np.ndarray, least: np.ndarray, every: bool = False):
    """Repeats between distinct stretches: arrays stretch, offset, size, smallest id.

    With ``every`` there is an entry for each occurrence of each maximal repeat. Else only what
    removal needs: of each suffix the repeats older than its stretch, and than any longer one.
    """
    sizes = np.diff(bounds)
    windows = sizes - LEAST + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = bounds[owner] + offset
    total, inverse = sums(gram_hashes(data))
    hashes = digests(total, inverse, starts, np.full(len(starts), LEAST))
    ordered = np.sort(hashes)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = [[], [], [], []]
    if len(again):
        place = np.minimum(np.searchsorted(again, hashes), len(again) - 1)
        several = np.flatnonzero(again[place] == hashes)
        owner, offset, starts = owner[several], offset[several], starts[several]
        order, common = suffix_array(data, starts, sizes[owner] - offset)
        owner, offset = owner[order], offset[order]
        # the first window of a stretch has the unknown before it: an extension of its own
        left = np.where(offset > 0, data[starts[order] - 1].astype(np.int64), -1 - np.arange(len(order)))
        oldest = least[owner].copy()
        for length, low, high, smallest in repeat_intervals(
            common.tolist(), left.tolist(), least[owner].tolist()
        ):
            late = np.arange(low, high)
            if not every:
                late = late[oldest[low:high] > smallest]
            if len(late):
                oldest[late] = smallest
                out[0].append(owner[late])
                out[1].append(offset[late])
                out[2].append(np.full(len(late), length))
                out[3].append(np.full(len(late), smallest))
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


def repeat_finder(every: bool):
    """Function for ``applyInArrow``: the reply of a bucket to each part's stretches.

    With ``every`` repeat, ``least`` of a stretch that only one part has is ``NO_ID``.
    """

    def run(key, table):
        return found_repeats(table, every)

    return run


def found_repeats(table: pa.Table, every: bool) -> pa.Table:
    rows = table.to_pylist()
    sizes = [np.frombuffer(r["sizes"], np.uint8).astype(np.int64) for r in rows]
    count = [len(s) for s in sizes]
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    sent = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(r["bytes"] for r in rows))],
    ).dictionary_encode()
    code = sent.indices.to_numpy()
    claimed = np.concatenate([np.frombuffer(r["least"], np.int64) for r in rows])
    least = np.full(len(sent.dictionary), NO_ID)
    np.minimum.at(least, code, claimed)
    _, bounds, data = sent.dictionary.buffers()
    bounds = np.frombuffer(bounds, np.int64)[: len(least) + 1]
    found = bucket_repeats(np.frombuffer(data, np.uint8)[: bounds[-1]], bounds, least, every)
    if every:
        least = np.where(np.bincount(code, minlength=len(least)) > 1, least, NO_ID)
    order = np.argsort(found[0], kind="stable")
    stretch, offset, size, older = (c[order] for c in found)
    out, at = [], 0
    for r, n in zip(rows, count, strict=True):
        mine = code[at : at + n]
        at += n
        low, high = np.searchsorted(stretch, mine), np.searchsorted(stretch, mine, "right")
        many = high - low
        pick = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        out.append(
            {
                "part": r["part"],
                "bucket": r["bucket"],
                "least": least[mine].tobytes(),
                "at": np.repeat(np.arange(n), many).astype(np.uint32).tobytes(),
                "offset": offset[pick].astype(np.uint8).tobytes(),
                "size": size[pick].astype(np.uint8).tobytes(),
                "older": older[pick].tobytes(),
            }
        )
    return table_of(REPLIES, out)


KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)
KEPT_SQL = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def part_entries(part: Part, replies: list[dict], bits: int):
    """Repeats within the part's groups of equal stretches: group, offset, size, smallest id.

    For each bucket first the stretches as a whole, then what was found inside them.
    """
    by_bucket = {r["bucket"]: r for r in replies if r["least"] is not None}
    for bucket, low, high in bucket_ranges(part.keys[part.first], bits):
        r = by_bucket[bucket]
        whole = np.arange(low, high)
        sizes = part.windows[part.first[whole]] + LEAST - 1
        yield whole, np.zeros(high - low, np.int64), sizes, np.frombuffer(r["least"], np.int64)
        yield (
            low + np.frombuffer(r["at"], np.uint32).astype(np.int64),
            np.frombuffer(r["offset"], np.uint8).astype(np.int64),
            np.frombuffer(r["size"], np.uint8).astype(np.int64),
            np.frombuffer(r["older"], np.int64),
        )


def occurrences_of(part: Part, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of each group one after another, and how many each has."""
    groups = np.append(part.first, len(part.starts))
    many = groups[group + 1] - groups[group]
    return np.arange(many.sum()) + np.repeat(groups[group] - np.cumsum(many) + many, many), many


def removed_ranges(part: Part, replies: list[dict], bits: int):
    """Start and end of every repeat that an earlier document has, in the part's bytes."""
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for group, offset, size, older in part_entries(part, replies, bits):
        index, many = occurrences_of(part, group)
        late = part.ids[part.owner[index]] > np.repeat(older, many)
        begin = part.starts[index[late]] + np.repeat(offset, many)[late]
        starts.append(begin)
        ends.append(begin + np.repeat(size, many)[late])
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    owner = np.searchsorted(part.bounds, starts, "right") - 1
    fresh = np.append(True, (starts[1:] > reach[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(fresh)
    return starts[first], np.maximum.reduceat(ends, first)


OCCURRENCES = pa.schema([("repeat", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int64())])
OCCURRENCES_SQL = "repeat binary, doc_id long, start long"


def occurrence_lister(key_bits: int, bits: int):
    """Function for a cogroup: every occurrence of every maximal repeat in a part."""

    def run(key, table, replies):
        if not table.num_rows:
            return OCCURRENCES.empty_table()
        answers = replies.to_pylist()
        part = masked_part(table, answers, key_bits)
        ids = table.column("doc_id").combine_chunks().cast(pa.int64())
        out = [OCCURRENCES.empty_table()]
        for k, (group, offset, size, least) in enumerate(part_entries(part, answers, bits)):
            index, many = occurrences_of(part, group)
            if k % 2 == 0:  # a whole stretch is a repeat if it occurs again, here or elsewhere
                again = np.repeat((many > 1) | (least != NO_ID), many)
            else:
                again = np.ones(len(index), dtype=bool)
            begin = (part.starts[index] + np.repeat(offset, many))[again]
            sizes, owner = np.repeat(size, many)[again], part.owner[index][again]
            ends = np.cumsum(sizes)
            data = pa.py_buffer(gathered(part.data, begin, sizes).tobytes())
            limits = pa.py_buffer(np.append(0, ends).astype(np.int32))
            repeats = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, limits, data])
            columns = [repeats, ids.take(pa.array(owner)), pa.array(begin - part.bounds[owner])]
            out.append(pa.table(columns, schema=OCCURRENCES))
        return pa.concat_tables(out)

    return run


def remover(key_bits: int, bits: int):
    """Function for a cogroup: what is left of each document of a part."""

    def run(key, table, replies):
        if not table.num_rows:
            return KEPT.empty_table()
        answers = replies.to_pylist()
        part = masked_part(table, answers, key_bits)
        starts, ends = removed_ranges(part, answers, bits)
        owner = np.searchsorted(part.bounds, starts, "right") - 1
        before = np.searchsorted(owner, np.arange(table.num_rows + 1))
        kept, spans = [], []
        whole = memoryview(part.data)
        for i in range(table.num_rows):
            low, high = int(part.bounds[i]), int(part.bounds[i + 1])
            cut = [(int(s), int(e)) for s, e in zip(
                starts[before[i] : before[i + 1]], ends[before[i] : before[i + 1]], strict=True
            )]
            edges = [low, *(x for pair in cut for x in pair), high]
            kept.append(b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": s - low, "end": e - low} for s, e in cut])
        return pa.table(
            {
                "doc_id": table.column("doc_id").cast(pa.int64()),
                "n_bytes": np.diff(part.bounds),
                "spans": pa.array(spans, KEPT.field("spans").type),
                "kept": pa.array(kept, pa.binary()),
            },
            schema=KEPT,
        )

    return run


def bucketed(docs: DataFrame, buckets: int, split: int) -> DataFrame:
    """The documents as a table bucketed by part, written once.

    A part is one of ``split`` shares of what one task read, told apart by a row's place there.
    """
    spark = docs.sparkSession
    name = f"suffix_dedup_{uuid.uuid4().hex}"
    share = F.pmod(F.monotonically_increasing_id(), F.lit(split))
    part = F.spark_partition_id() * split + share
    writer = texts(docs).withColumn("part", part.cast("int")).write.format("parquet")
    writer = writer.bucketBy(buckets, "part").option("path", scratch(spark, "suffix-documents"))
    writer.saveAsTable(name)
    return spark.table(name)


def exchanged(docs: DataFrame, per_bucket: int, every: bool):
    """The stored documents, the buckets' replies, and the bits that tell buckets apart."""
    spark = docs.sparkSession
    read = docs.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("n"))
    size = read.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    expected = 2 * (size["all"] or 0) / (GRAMS + 1)  # stretches, as keys are spread evenly
    bits = max(1, int(np.ceil(np.log2(max(2.0, expected / per_bucket)))))
    key_bits = max(1, bits - KEY_BITS)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = bucketed(docs, buckets, -(-(size.most or 1) // PART_BYTES))
    sent = stored.groupBy("part").applyInArrow(key_sender(key_bits), KEYS_SQL)
    masks = materialize(
        sent.groupBy("bucket").applyInArrow(shared_keys, REPLIES_SQL), "suffix-keys"
    )
    stretches = (
        stored.groupBy("part")
        .cogroup(masks.groupBy("part"))
        .applyInArrow(stretch_sender(key_bits, bits), STRETCHES_SQL)
    )
    found = materialize(
        stretches.groupBy("bucket").applyInArrow(repeat_finder(every), REPLIES_SQL),
        "suffix-repeats",
    )
    return stored, masks.unionByName(found), key_bits, bits


def remove_repeats(docs: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Each document without the bytes that an earlier document has, too.

    Removed is every byte covered by a string of ``LEAST`` bytes that also starts in a row of
    ``docs`` (doc_id, text) with a smaller doc_id, judged on the whole input. Columns: doc_id,
    n_bytes, spans (removed ranges of bytes, maximal and in order) and kept (the remaining
    bytes). A null text is empty; texts of fewer bytes are kept whole, long ones are worked on
    whole. A null id is larger than all others. Rows of one id are compared with smaller ids
    only, so they never remove each other, and equal rows have equal results. An empty table
    gives no rows. Only doc_id and text are read, so other columns cannot clash.
    """
    stored, replies, key_bits, bits = exchanged(docs, per_bucket, every=False)
    return (
        stored.groupBy("part")
        .cogroup(replies.groupBy("part"))
        .applyInArrow(remover(key_bits, bits), KEPT_SQL)
    )


def repeat_groups(docs: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Maximal repeats of at least ``LEAST`` bytes with all their occurrences, within documents, too.

    One row for each occurrence: repeat (its bytes), doc_id, start. Repeats are maximal within
    stretches, so one of more bytes than a stretch shows as several that overlap. A group has
    rows as it has occurrences, nested repeats at most as many as a stretch has windows. Null
    and short texts have none. Only doc_id and text are read.
    """
    stored, replies, key_bits, bits = exchanged(docs, per_bucket, every=True)
    return (
        stored.groupBy("part")
        .cogroup(replies.groupBy("part"))
        .applyInArrow(occurrence_lister(key_bits, bits), OCCURRENCES_SQL)
    )


def digest_columns(kept: DataFrame) -> DataFrame:
    """Counts and digest of what was removed and kept, one row per document."""
    return kept.selectExpr(
        "doc_id",
        "n_bytes",
        "aggregate(spans, 0L, (n, s) -> n + s.end - s.start) AS n_removed",
        "cast(size(spans) AS bigint) AS n_spans",
        "sha2(kept, 256) AS kept_sha256",
    )


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS x FROM documents),
chunks AS (
  SELECT r, doc_id, base, substr(x, 2 * base + 1, 2 * (512 + 49)) AS x
  FROM (SELECT *, unnest(range(0, len(x) // 2 - 49, 512)) AS base FROM docs)),
windows AS (
  SELECT r, doc_id, base + p AS p, substr(x, 2 * p + 1, 100) AS s
  FROM (SELECT *, unnest(range(0, len(x) // 2 - 49)) AS p FROM chunks)),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
hits AS (
  SELECT r, p, p > coalesce(lag(p) OVER (PARTITION BY r ORDER BY p) + 50, -1) AS fresh
  FROM windows JOIN firsts USING (s) WHERE coalesce(doc_id > least, least IS NOT NULL)),
islands AS (SELECT r, p, sum(CAST(fresh AS INT)) OVER (PARTITION BY r ORDER BY p) AS k FROM hits),
spans AS (SELECT r, k, min(p) AS low, max(p) + 50 AS high FROM islands GROUP BY r, k),
pieces AS (
  SELECT r, low, high, substr(x, 2 * coalesce(lag(high) OVER w, 0) + 1,
    2 * (low - coalesce(lag(high) OVER w, 0))) AS piece
  FROM spans JOIN docs USING (r) WINDOW w AS (PARTITION BY r ORDER BY low)),
removed AS (
  SELECT r, sum(high - low) AS n, count(*) AS n_spans, max(high) AS last,
    string_agg(piece, '' ORDER BY low) AS kept FROM pieces GROUP BY r)
SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(concat(coalesce(kept, ''), substr(x, 2 * coalesce(last, 0) + 1)))) AS kept_sha256
FROM docs LEFT JOIN removed USING (r)
"""

"""N-gram Jaccard join with set-relation skipping: components of near-duplicate texts.

Two sets of word shingles link if ``100 * intersection >= percent * union``. The join is exact
and never lists all pairs of a group:

1. Texts with equal sets are one class; its smallest id stands for it.
2. Shingles are ordered by how common they are (from a fixed-size count sketch over all
   documents, so common passages come last) and then by hash. Sets that link share one of
   their first ``n - ceil(percent * n / 100) + 1`` shingles; these make the index lists, whose
   entries carry the position in the set. If the first shared shingle stands at ``i`` and
   ``j``, the sets differ in at least ``i + j`` shingles, which skips most of a list.
3. In every list, each set is compared with the list's leader only: the set whose rarest
   shingle is most common, as the original of many copies has none of their changes. Linked
   sets are merged to components.
4. What is left are pairs of different components. Lists within one component are skipped, and
   so is the block of entries whose positions are both behind half the allowed difference. An
   entry's answer is derived from its leader's: with overlaps ``o`` known for both sets, they
   share at most ``o_y + n_x - o_x`` shingles, so most pairs need no look at the sets. The
   rest is compared exactly, and the components are merged again.

Before sets are compared, 256 parity bits of each (of its shingles by hash bucket) are: every
bit in which they differ is a shingle that only one of the sets has. This drops no link and
settles nearly all pairs that are almost similar enough, at 32 bytes a set. Large sets fill
all parity bits, so what is left is held against the counts of 128 buckets as well: these
differ in sum by no more than the sets do.

The number of compared pairs is about one per list and set, for groups of any size, plus the
pairs of step 4 that no bound settles. Sets are built on 64-bit shingle fingerprints, of which
48 bits are compared: for sets of 400 a chance match has a probability below 1e-9.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import materialize, texts
from filetally.llm.text import PIECE, batch_of, buffer_of, column, mix, runs, words

SLOT_BITS = 22  # size of the count sketch and of what is broadcast of it: one byte a slot
SKETCH_PARTS = 64
FILTER_BITS = 23  # size of the broadcast filter of wanted ids
MOST_BROADCAST = 1_000_000  # rows of up to five numbers; larger tables are joined by a shuffle
KEPT_BYTES = 6  # of a fingerprint, when sets are compared


@dataclass(frozen=True)
class Rule:
    words: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        """Shingles to index of a set of ``n``; none if no other set can link with it."""
        least = -(-self.percent * n // 100)
        if n == 0 or (least == n and 100 * n // self.percent == n):
            return 0
        return n - least + 1

    def least_overlap(self, a: str, b: str) -> str:
        """SQL: shingles that linked sets of these sizes share at least."""
        total = 100 + self.percent
        return f"((({self.percent} * ({a} + {b})) + {total - 1}) DIV {total})"


def shingle_sets(data, bounds, size: int):
    """Sorted distinct shingle fingerprints of each text; a short text is one shingle."""
    for first, end in runs(bounds, PIECE):
        low = bounds[first]
        hashes, _, _, before = words(data[low : bounds[end]], bounds[first : end + 1] - low)
        with np.errstate(over="ignore"):
            joined = hashes.copy()
            for k in range(1, size):
                joined = joined[: max(0, len(hashes) - k)]
                joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
            for row in range(end - first):
                a, b = before[row], before[row + 1]
                if b - a >= size:
                    yield first + row, np.unique(joined[a : b - size + 1])
                elif b > a:
                    one = np.uint64(b - a)
                    for h in hashes[a:b]:
                        one = mix(one * np.uint64(0x9E3779B97F4A7C15) + h)
                    yield first + row, np.array([one], np.uint64)
                else:
                    yield first + row, np.zeros(0, np.uint64)


SKETCH = pa.schema([("part", pa.int32()), ("counts", pa.binary())])


def sketch_counter(size: int):
    """Function for ``mapInArrow``: the partition's document counts by hash slot."""

    def run(batches):
        total = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            data, bounds = buffer_of(column(batch, "text"))
            for _, members in shingle_sets(data, bounds, size):
                total[members >> np.uint64(64 - SLOT_BITS)] += 1
        for k, piece in enumerate(np.split(total, SKETCH_PARTS)):
            if piece.any():
                packed = pa.compress(piece.tobytes(), codec="zstd", asbytes=True)
                yield batch_of(SKETCH, part=[k], counts=[packed])

    return run


def sketch_levels(batches):
    """Sum the counts of each part as they stream in; a level is the count's logarithm."""
    width = (1 << SLOT_BITS) // SKETCH_PARTS
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(*(column(batch, n).to_pylist() for n in SKETCH.names), strict=True):
            raw = pa.decompress(packed, decompressed_size=4 * width, codec="zstd", asbytes=True)
            counts = np.frombuffer(raw, np.uint32).astype(np.int64)
            sums[part] = sums.get(part, 0) + counts
    for part, counts in sums.items():
        levels = np.floor(np.log2(counts + 1)).astype(np.uint8)
        yield batch_of(SKETCH, part=[part], counts=[levels.tobytes()])


def common_levels(docs: DataFrame, size: int) -> np.ndarray:
    """One byte per hash slot: how common its shingles are. It only orders the shingles."""
    width = (1 << SLOT_BITS) // SKETCH_PARTS
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    sums = docs.mapInArrow(sketch_counter(size), "part int, counts binary").repartition("part")
    for r in sums.mapInArrow(sketch_levels, "part int, counts binary").collect():
        levels[r.part * width : (r.part + 1) * width] = np.frombuffer(r.counts, np.uint8)
    return levels


PREFIXES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("level", pa.int64()),
        *[(f"p{k}", pa.int64()) for k in range(4)],
        ("counts", pa.binary()),
        ("prefix", pa.list_(pa.int64())),
    ]
)
PREFIXES_SQL = (
    "doc_id long, n long, low long, high long, level long, p0 long, p1 long, p2 long,"
    " p3 long, counts binary, prefix array<long>"
)
PARITY = [f"p{k}" for k in range(4)]


def signature(members: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    with np.errstate(over="ignore"):
        low = np.add.reduce(mix(members), dtype=np.uint64)
        high = np.bitwise_xor.reduce(mix(members * np.uint64(0xD6E8FEB86659FD93)), initial=0)
    return np.uint64(low).view(np.int64), np.uint64(high).view(np.int64)


def parity(members: np.ndarray) -> np.ndarray:
    """Whether each of 256 buckets holds an odd number of shingles, as four numbers."""
    odd = np.bincount((members & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def bucket_counts(members: np.ndarray) -> bytes:
    """Shingles in each of 128 buckets, as bytes; a count of over 255 is 255."""
    buckets = (members >> np.uint64(8)) & np.uint64(127)
    counts = np.bincount(buckets.astype(np.int64), minlength=128)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def near_in_counts(percent: int):
    """Function for ``mapInArrow``: the pairs whose bucket counts allow a link."""

    def run(batches):
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(column(batch, c).to_pylist()), np.uint8).reshape(-1, 128)
                for c in ("x_counts", "y_counts")
            )
            total = column(batch, "x_n").to_numpy() + column(batch, "y_n").to_numpy()
            most = total - 2 * -(-percent * total // (100 + percent))
            kept = np.abs(x.astype(np.int64) - y).sum(axis=1) <= most
            kept = batch.filter(pa.array(kept))
            yield batch_of(PAIRS, a=column(kept, "a"), b=column(kept, "b"))

    return run


def prefix_maker(rule: Rule, levels: np.ndarray):
    """Function for ``mapInArrow``: size, signature and index shingles of each text's set."""

    def run(batches):
        for batch in batches:
            data, bounds = buffer_of(column(batch, "text"))
            sizes, low, high, rarest, prefix, bits, counts = ([] for _ in range(7))
            for _, members in shingle_sets(data, bounds, rule.words):
                count = rule.prefix(len(members))
                level = levels[members >> np.uint64(64 - SLOT_BITS)]
                order = np.argsort(level, kind="stable")[:count]
                a, b = signature(members)
                sizes.append(len(members))
                low.append(a)
                high.append(b)
                rarest.append(int(level.min(initial=63)))
                prefix.append(members[order].view(np.int64))
                bits.append(parity(members))
                counts.append(bucket_counts(members))
            ids = column(batch, "doc_id")
            bits = dict(zip(PARITY, np.array(bits).reshape(-1, 4).T, strict=True))
            bits |= {"level": rarest, "counts": counts, "prefix": prefix}
            yield batch_of(PREFIXES, doc_id=ids, n=sizes, low=low, high=high, **bits)

    return run


FILTER = pa.schema([("bits", pa.binary())])


def id_slots(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(batches):
    """Bits of the wanted ids of a partition."""
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    for batch in batches:
        bits[id_slots(column(batch, "id").to_numpy())] = True
    yield batch_of(FILTER, bits=[pa.compress(np.packbits(bits).tobytes(), codec="zstd", asbytes=True)])


def stored(members: np.ndarray) -> bytes:
    """The upper bytes of each fingerprint, which keep their order."""
    return members.view(np.uint8).reshape(-1, 8)[:, 8 - KEPT_BYTES :].tobytes()


def restored(data: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, KEPT_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 8 - KEPT_BYTES :] = raw
    return out.view(np.uint64).ravel()


SETS = pa.schema([("set_id", pa.int64()), ("members", pa.binary())])


def set_maker(rule: Rule, packed: bytes):
    """Function for ``mapInArrow``: the sets of the texts whose id passes the filter."""

    def run(batches):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in batches:
            ids = column(batch, "doc_id").to_numpy()
            batch = batch.filter(pa.array(bits[id_slots(ids)]))
            data, bounds = buffer_of(column(batch, "text"))
            members = [stored(m) for _, m in shingle_sets(data, bounds, rule.words)]
            yield batch_of(SETS, set_id=column(batch, "doc_id"), members=members)

    return run


OVERLAPS = pa.schema(
    [(c, pa.int64()) for c in ("a", "b", "size_a", "size_b", "overlap")]
)


def compare(batches):
    """Sizes and overlap of pairs of sets."""
    for batch in batches:
        rows = {c: [] for c in ("size_a", "size_b", "overlap")}
        for x, y in zip(column(batch, "members_a"), column(batch, "members_b"), strict=True):
            x, y = restored(x), restored(y)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            rows["size_a"].append(len(x))
            rows["size_b"].append(len(y))
            rows["overlap"].append(int((y[at] == x).sum()))
        yield batch_of(OVERLAPS, a=column(batch, "a"), b=column(batch, "b"), **rows)


def sets_of(ids: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """``(set_id, members)`` of the ids, made anew from their texts.

    A filter of fixed size keeps most other texts from being shuffled; what it lets through by
    chance finds no partner in the join.
    """
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in ids.coalesce(8).mapInArrow(id_filter, "bits binary").collect():
        raw = pa.decompress(r.bits, decompressed_size=len(bits), codec="zstd", asbytes=True)
        bits |= np.frombuffer(raw, np.uint8)
    return docs.where("doc_id IS NOT NULL").mapInArrow(
        set_maker(rule, bits.tobytes()), "set_id long, members binary"
    )


def overlaps(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Exact overlap of each pair ``(a, b)`` of ids, with ``linked``."""
    right = sets_of(pairs.select(F.col("b").alias("id")), docs, rule)
    left = sets_of(pairs.select(F.col("a").alias("id")), docs, rule)
    compared = (
        pairs.select("a", "b")
        .join(right.selectExpr("set_id AS b", "members AS members_b"), "b")
        .join(left.selectExpr("set_id AS a", "members AS members_a"), "a")
        .select("a", "b", "members_a", "members_b")
        .mapInArrow(compare, "a long, b long, size_a long, size_b long, overlap long")
    )
    union = F.col("size_a") + F.col("size_b") - F.col("overlap")
    return compared.withColumn("linked", 100 * F.col("overlap") >= rule.percent * union)


def light(df: DataFrame, label: str) -> DataFrame:
    """The table written, and marked for broadcast if it is small enough."""
    df = materialize(df, label)
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` of every linked id; the root is the smallest id that links reach.

    Roots spread over the links and are then replaced by their own roots, so the rounds grow
    with the logarithm of the longest chain.
    """
    both = materialize(
        links.select(F.col("a").alias("id"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
        .distinct(),
        "ngram-links",
    )
    roots = materialize(
        both.groupBy("id").agg(F.min("other").alias("root")).selectExpr("id", "least(id, root) AS root"),
        "ngram-roots",
    )
    while True:
        near = both.join(roots.selectExpr("id AS other", "root AS near"), "other")
        spread = (
            near.groupBy("id")
            .agg(F.min("near").alias("near"))
            .join(roots, "id")
            .selectExpr("id", "root AS old", "least(root, near) AS root")
        )
        jump = roots.selectExpr("id AS root", "root AS next")
        moved = materialize(
            spread.join(jump, "root", "left").selectExpr(
                "id", "old", "least(root, coalesce(next, root)) AS root"
            ),
            "ngram-roots",
        )
        roots = moved.select("id", "root")
        if moved.where("root < old").isEmpty():
            return roots


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with ``n_shingles`` and ``component_id``.

    A set holds the distinct shingles of ``rule.words`` words, A-Z lower-cased; a text of fewer
    words is one shingle. Every row gives one row. Null and empty texts, and texts without
    words, have no shingles, link with nothing and are their own component. Rows that share an
    id are one document and link through any of their texts. A row with a null id takes no part
    and has a null component. Ties do not matter, as the result is the set of components.
    """
    docs = texts(docs)
    levels = common_levels(docs, rule.words)
    rows = materialize(docs.mapInArrow(prefix_maker(rule, levels), PREFIXES_SQL), "ngram-prefixes")
    key = ["low", "high", "n"]
    named = rows.where("doc_id IS NOT NULL AND n > 0")
    classes = materialize(
        named.groupBy(*key).agg(
            F.min("doc_id").alias("rep"),
            F.first("level").alias("level"),
            *[F.first(p).alias(p) for p in [*PARITY, "counts"]],
            F.first("prefix").alias("prefix"),
        ),
        "ngram-classes",
    )

    # An entry is three numbers: level, size and place share one, as most bytes go through here.
    entries = (
        classes.select("rep", "level", "n", F.posexplode_outer("prefix").alias("place", "token"))
        .where("token IS NOT NULL")
        .selectExpr("token", "rep", "(level << 56) + (n << 28) + place AS spot")
        .repartition("token")
    )
    lead = F.expr("((63 - (spot >> 56)) << 31) + pmod(xxhash64(rep), 1L << 31)")
    lists = (
        entries.groupBy("token")
        .agg(
            F.count("*").alias("length"),
            F.min_by("rep", lead).alias("leader"),
            F.min_by("spot", lead).alias("leader_spot"),
        )
        .where("length > 1")
        .drop("length")
    )
    shared = materialize(entries.join(lists, "token"), "ngram-lists").selectExpr(
        "token",
        "rep",
        "(spot >> 28) & 268435455 AS n",
        "spot & 268435455 AS place",
        "leader",
        "(leader_spot >> 28) & 268435455 AS leader_n",
        "leader_spot & 268435455 AS leader_place",
    )

    def close(n_x, n_y, i, j):
        need = rule.least_overlap(n_x, n_y)
        return f"{n_x} + {n_y} - 2 * {need} >= {i} + {j} AND least({n_x}, {n_y}) >= {need}"

    def apart(x, y):
        return " + ".join(f"bit_count({x}_{p} ^ {y}_{p})" for p in PARITY)

    def sides(name, id_name):
        own = [F.col(c).alias(f"{name}_{c}") for c in ["n", *PARITY, "counts"]]
        return classes.select(F.col("rep").alias(id_name), *own)

    def likely(pairs, label):
        """Pairs that neither parity bits nor bucket counts rule out."""
        pairs = light(pairs, f"{label}-met")
        near = (
            sides("x", "a")
            .join(pairs, "a")
            .join(sides("y", "b"), "b")
            .where(f"{apart('x', 'y')} <= {differ}")
        )
        return light(near.mapInArrow(near_in_counts(rule.percent), "a long, b long").distinct(), label)

    differ = f"x_n + y_n - 2 * {rule.least_overlap('x_n', 'y_n')}"
    met = (
        shared.where("rep <> leader")
        .where(close("n", "leader_n", "place", "leader_place"))
        .select(F.col("leader").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    to_leader = likely(met, "ngram-leader-pairs")
    first = materialize(overlaps(to_leader, docs, rule), "ngram-leader-overlaps")
    roots = light(components(first.where("linked")).withColumnRenamed("id", "rep"), "ngram-roots")

    rooted = shared.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    mixed = light(
        rooted.groupBy("token")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"))
        .where("least < most")
        .select("token"),
        "ngram-mixed",
    )
    known = light(
        first.groupBy(F.col("a").alias("leader"), F.col("b").alias("rep")).agg(
            F.max("overlap").alias("overlap")
        ),
        "ngram-known",
    )
    bits = light(classes.select("rep", *PARITY), "ngram-parity")
    own = F.when(F.col("rep") == F.col("leader"), F.col("n")).otherwise(F.col("overlap"))
    left_over = materialize(
        rooted.join(mixed, "token", "left_semi")
        .join(known, ["leader", "rep"], "left")
        .join(bits, "rep")
        .select("token", "rep", "n", "place", "root", own.alias("overlap"), *PARITY),
        "ngram-mixed-lists",
    )
    x = left_over.select("token", *[F.col(c).alias(f"x_{c}") for c in left_over.columns[1:]])
    y = left_over.select("token", *[F.col(c).alias(f"y_{c}") for c in left_over.columns[1:]])
    front = x.where(f"2 * x_place <= (100 * x_n) DIV {rule.percent} - x_n")
    need = rule.least_overlap("x_n", "y_n")
    derived = (
        "x_overlap IS NULL OR y_overlap IS NULL OR"
        f" least(x_overlap + y_n - y_overlap, y_overlap + x_n - x_overlap) >= {need}"
    )
    candidates = (
        front.join(y, "token")
        .where("x_root <> y_root")
        .where("x_place < y_place OR (x_place = y_place AND x_rep < y_rep)")
        .where(close("x_n", "y_n", "x_place", "y_place"))
        .where(derived)
        .where(f"{apart('x', 'y')} <= {differ}")
        .selectExpr("least(x_rep, y_rep) AS a", "greatest(x_rep, y_rep) AS b")
        .distinct()
    )
    seen = first.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()
    rest = likely(candidates.join(seen, ["a", "b"], "left_anti"), "ngram-rest-pairs")
    second = materialize(overlaps(rest, docs, rule), "ngram-rest-overlaps")
    second = second.where("linked").select("a", "b")

    membership = named.select("doc_id", *key).join(classes.select(*key, "rep"), key)
    split = (
        membership.groupBy("doc_id")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        .where("a < b")
        .select("doc_id")
    )
    shared_ids = (
        membership.join(split, "doc_id", "left_semi")
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    merged = components(
        first.where("linked").select("a", "b").unionByName(second).unionByName(shared_ids)
    )
    placed = rows.select("doc_id", *key).join(classes.select(*key, "rep"), key, "left")
    return placed.join(merged.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id")).alias("component_id"),
    )


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS i FROM words
        WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o >= 90 * (x.n + y.n - o)),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other),
roots AS (SELECT id AS doc_id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)
"""

"""Conversation prefix trie: ternary search trees per range shard, joined along their borders.

Turns are digests of role and text, so texts never leave the scan; a conversation is the array
of its turns' digests and lengths. Equal conversations are one sequence with a count, its
smallest id and the hash of its ids, gathered in pieces of at most ``PIECE`` ids and streamed
in order, so no group of copies is ever held whole.

Sequences are dealt out by ranges. A shard encodes its digests by a dictionary of its own and
builds a ternary search tree, inserting the median first, so that every level is balanced. An
iterative traversal gathers members, leaves and savings. A node can only reach into another
shard if it lies on the path of its shard's first or last sequence; these borders (two paths a
shard) are merged in shard order with a stack, all other nodes are final where they are.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import materialize
from filetally.llm.text import batch_of

MOST_HEAD = 6  # rebuilt conversations take fewer turns than this from their base
GROUP = 100  # conversations that share a base
PIECE = 4096  # ids gathered at once
EMPTY = hashlib.sha256(b"").hexdigest()

DIGEST = "unhex(sha2(concat(length(role), ':', role, text), 256))"


def turn_lists(turns: DataFrame) -> DataFrame:
    """``(base, conv_id, own)``: the turns of each conversation in order, as digest and length."""
    plain = turns.where("conv_id IS NOT NULL").selectExpr(
        "conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text"
    )
    narrow = plain.selectExpr(
        f"conv_id - conv_id % {GROUP} AS base",
        "conv_id",
        f"struct(turn, {DIGEST} AS digest, length(text) AS chars) AS item",
    )
    return narrow.groupBy("base", "conv_id").agg(
        F.expr("transform(sort_array(collect_list(item)), t -> struct(t.digest, t.chars)) AS own")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: the first h turns of the base, then the conversation's own after h."""
    lists = materialize(turn_lists(turns), "trie-turns")
    heads = lists.where("conv_id = base").selectExpr(
        "base AS head_of", f"slice(own, 1, {MOST_HEAD - 1}) AS head"
    )
    joined = lists.join(heads, F.expr("base = head_of"), "left")
    h = f"cast(crc32(cast(conv_id AS string)) % {MOST_HEAD} AS int)"
    return joined.selectExpr(
        "conv_id",
        f"concat(slice(coalesce(head, array()), 1, {h}), slice(own, {h} + 1, size(own))) AS seq",
    )


SEQUENCES = pa.schema(
    [
        ("digests", pa.list_(pa.binary())),
        ("chars", pa.list_(pa.int64())),
        ("n", pa.int64()),
        ("least", pa.int64()),
        ("ends", pa.string()),
    ]
)
SEQUENCES_SQL = "digests array<binary>, chars array<bigint>, n long, least long, ends string"


def hashed_ends(batches):
    """One row per sequence, from its pieces in order: count, smallest id, hash of all ids."""
    held = state = None

    def closed():
        return batch_of(SEQUENCES, **{k: [v] for k, v in held.items()}, ends=[state.hexdigest()])

    for batch in batches:
        for row in batch.to_pylist():
            if held is not None and row["digests"] == held["digests"]:
                state.update(b"," + row["ids"].encode())
                held["n"] += row["n"]
                continue
            if held is not None:
                yield closed()
            state = hashlib.sha256(row["ids"].encode())
            held = {k: row[k] for k in ("digests", "chars", "n", "least")}
    if held is not None:
        yield closed()


def sequences(rows: DataFrame) -> DataFrame:
    """Distinct sequences with their count, smallest id and the hash of their sorted ids."""
    pieces = (
        rows.selectExpr(
            "conv_id",
            "seq.digest AS digests",
            "transform(seq, t -> cast(t.chars AS bigint)) AS chars",
            f"floor(conv_id / {PIECE}) AS piece",
        )
        .groupBy("digests", "piece")
        .agg(
            F.expr("any_value(chars) AS chars"),
            F.count("*").alias("n"),
            F.min("conv_id").alias("least"),
            F.expr("array_join(sort_array(collect_list(conv_id)), ',') AS ids"),
        )
    )
    return (
        pieces.repartition("digests")
        .sortWithinPartitions("digests", "piece")
        .select("digests", "chars", "n", "least", "ids")
        .mapInArrow(hashed_ends, SEQUENCES_SQL)
    )


class Tree:
    """Ternary search tree over dictionary-encoded turns; node 0 is the root of depth 0.

    ``low``, ``high`` lead to other turns at the same depth, ``next`` to the first turn below.
    """

    def __init__(self):
        self.turn, self.low, self.high, self.next = [-1], [-1], [-1], [-1]
        self.chars, self.digest = [0], [b""]
        self.n, self.least, self.ends = [0], [None], [None]

    def _new(self, turn: int, chars: int, digest: bytes) -> int:
        for kept, value in (
            (self.turn, turn), (self.low, -1), (self.high, -1), (self.next, -1),
            (self.chars, chars), (self.digest, digest),
            (self.n, 0), (self.least, None), (self.ends, None),
        ):
            kept.append(value)
        return len(self.turn) - 1

    def insert(self, codes, digests, chars, n: int, least: int, ends: str) -> list[int]:
        """Add a sequence; returns the nodes on its path, the root first."""
        path, node = [0], 0
        for code, digest, size in zip(codes, digests, chars, strict=True):
            link, at = self.next, node
            while link[at] >= 0:
                at = link[at]
                if self.turn[at] == code:
                    break
                link = self.low if code < self.turn[at] else self.high
            else:
                link[at] = self._new(code, size, digest)
                at = link[at]
            path.append(at)
            node = at
        self.n[node] += n
        self.least[node] = least
        self.ends[node] = ends
        return path

    def children(self, node: int):
        """Nodes one turn below, over the search tree that hangs from ``node``."""
        stack = [self.next[node]]
        while stack:
            at = stack.pop()
            if at >= 0:
                yield at
                stack += (self.low[at], self.high[at])


def median_order(count: int):
    """Indexes of a sorted list, the median of every part before the rest of that part."""
    parts = [(0, count)]
    for low, high in parts:
        if low < high:
            middle = (low + high) // 2
            yield middle
            parts += ((low, middle), (middle + 1, high))


NODES = pa.schema(
    [
        ("shard", pa.int64()),
        ("slot", pa.int64()),  # place among the shard's border nodes, null for final nodes
        ("under", pa.int64()),  # slot of the parent if that is a border node
        ("last", pa.bool_()),  # border nodes: on the path of the last sequence, too or only
        ("first", pa.bool_()),
        ("digest", pa.binary()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("chars", pa.int64()),
        ("ends_sha256", pa.string()),
    ]
)
NODES_SQL = (
    "shard long, slot long, under long, last boolean, first boolean, digest binary, conv_id long,"
    " depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, chars long, ends_sha256 string"
)
ROWS = 4096  # nodes handed on at once


def shard_nodes(batches):
    """Nodes of one shard's tree. A border node counts only what lies below final children."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    rows.sort(key=lambda r: r["digests"])
    codes = {d: k for k, d in enumerate(sorted({d for r in rows for d in r["digests"]}))}
    tree, borders = Tree(), {}
    for i in median_order(len(rows)):
        r = rows[i]
        path = tree.insert(
            [codes[d] for d in r["digests"]], r["digests"], r["chars"], r["n"], r["least"], r["ends"]
        )
        if i in (0, len(rows) - 1):
            borders[i] = path
    first, last = borders[0], borders[len(rows) - 1]
    slots = {node: k for k, node in enumerate(dict.fromkeys(first + last))}
    onfirst, onlast = set(first), set(last)
    size = len(tree.turn)
    depth, parent, order = [0] * size, [-1] * size, [0]
    for node in order:  # parents before their children
        for child in tree.children(node):
            parent[child], depth[child] = node, depth[node] + 1
            order.append(child)
    kids, leaves, saved = [0] * size, [0] * size, [0] * size
    for node in reversed(order):  # children before their parent
        if node not in slots:
            leaves[node] = leaves[node] or 1
            saved[node] += (tree.n[node] - 1) * tree.chars[node]
        up = parent[node]
        if up < 0:
            continue
        tree.n[up] += tree.n[node]
        if tree.least[up] is None or tree.least[node] < tree.least[up]:
            tree.least[up] = tree.least[node]
        if node not in slots:
            kids[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    shard = TaskContext.get().partitionId()
    for at in range(0, size, ROWS):
        part = order[at : at + ROWS]
        yield batch_of(
            NODES,
            shard=[shard] * len(part),
            slot=[slots.get(v) for v in part],
            under=[slots.get(parent[v]) for v in part],
            last=[v in onlast for v in part],
            first=[v in onfirst for v in part],
            digest=[tree.digest[v] for v in part],
            conv_id=[tree.least[v] for v in part],
            depth=[depth[v] for v in part],
            parent_conv_id=[tree.least[parent[v]] if v else None for v in part],
            n_convs=[tree.n[v] for v in part],
            n_children=[kids[v] for v in part],
            n_leaves=[leaves[v] for v in part],
            saved_tokens=[saved[v] for v in part],
            chars=[tree.chars[v] for v in part],
            ends_sha256=[tree.ends[v] for v in part],
        )


MERGED = pa.schema(
    [
        ("shard", pa.int64()),  # with slot: one of the border nodes that this node merges
        ("slot", pa.int64()),
        ("main", pa.bool_()),  # true in exactly one row of a node
        *[f for f in NODES if f.name in {
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", "ends_sha256",
        }],
    ]
)
MERGED_SQL = (
    "shard long, slot long, main boolean, conv_id long, depth long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def merged_borders(batches):
    """Merge the border paths of all shards, which come in order, with a stack of open nodes.

    A node is closed once a path turns away from it. Its row waits for the smallest id of its
    parent, which is known when that closes; only children of open nodes wait.
    """
    stack: list[dict] = []
    done: list[dict] = []

    def close():
        node = stack.pop()
        node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
        for child in node.pop("waiting"):
            child["parent_conv_id"] = node["conv_id"]
            done.append(child)
        if not stack:
            done.append(node | {"parent_conv_id": None})
            return
        up = stack[-1]
        up["n_children"] += 1
        up["n_leaves"] += node["n_leaves"]
        up["saved_tokens"] += node["saved_tokens"]
        up["waiting"].append(node)

    def follow(path: list[dict]) -> None:
        """Go down one path: nodes already open are joined, the others closed or opened."""
        for k, row in enumerate(path):
            if k < len(stack) and stack[k]["digest"] == row["digest"]:
                node = stack[k]
            else:
                while len(stack) > k:
                    close()
                node = {**row, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0}
                node |= {"places": [], "waiting": [], "ends_sha256": None}
                stack.append(node)
            place = (row["shard"], row["slot"])
            if node["places"][-1:] == [place]:
                continue  # the last path begins with nodes of the first
            node["places"].append(place)
            node["conv_id"] = min(node["conv_id"], row["conv_id"])
            node["ends_sha256"] = node["ends_sha256"] or row["ends_sha256"]
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[name] += row[name]

    def emitted():
        rows = []
        for node in done:
            for k, (shard, slot) in enumerate(node["places"]):
                rows.append(node | {"shard": shard, "slot": slot, "main": k == 0})
        done.clear()
        return batch_of(MERGED, **{f.name: [r[f.name] for r in rows] for f in MERGED})

    def take(rows: list[dict]) -> None:
        follow([r for r in rows if r["first"]])
        follow([r for r in rows if r["last"]])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["shard"] != row["shard"]:
                take(held)
                held = []
            held.append(row)
        if done:
            yield emitted()
    if held:
        take(held)
    while stack:
        close()
    if done:
        yield emitted()


COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations of ``turns``.

    ``turns`` has conv_id, turn, role and text. Turns are ordered by number, nulls first and
    equal numbers by the digest of role and text; repeated rows are turns of their own. A null
    role or text is an empty one, very long texts count whole. Rows without conv_id belong to no
    conversation and are left out. A conversation whose turns are all replaced by those of an
    absent base has none and ends at the root. An empty table gives no rows, not even a root.
    Only the four named columns are read, so others cannot clash.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. One conversation's turns (48 bytes each) have to fit in a row.
    """
    unique = materialize(sequences(rebuilt(turns)), "trie-sequences")
    shards = unique.repartitionByRange("digests")
    nodes = materialize(shards.mapInArrow(shard_nodes, NODES_SQL), "trie-nodes")
    borders = (
        nodes.where("slot IS NOT NULL")
        .repartition(1)  # two paths a shard, whatever the number of conversations
        .sortWithinPartitions("shard", "depth", "slot")
    )
    merged = materialize(borders.mapInArrow(merged_borders, MERGED_SQL), "trie-borders")
    final = nodes.where("slot IS NULL").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))
    )
    inner = final.where("under IS NULL").select(*COLUMNS)
    ids = merged.selectExpr("shard", "slot AS under", "conv_id AS border_id")
    outer = (
        final.where("under IS NOT NULL")
        .join(ids, ["shard", "under"])
        .withColumn("parent_conv_id", F.col("border_id"))
        .select(*COLUMNS)
    )
    border = merged.where("main").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))
    )
    return inner.unionByName(outer).unionByName(border.select(*COLUMNS))


SQL = r"""
WITH crc AS (
  SELECT list(r ORDER BY b) AS crc_table FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, k:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS r
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list({'digest': digest, 'chars': length(text)}
    ORDER BY turn NULLS FIRST, digest) AS own FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
        lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])), 4294967295) % 6 AS h
  FROM lists, crc),
built AS (
  SELECT c.conv_id, coalesce(b.own, [])[1:h] || c.own[h + 1:] AS seq
  FROM heads c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100),
steps AS (
  SELECT conv_id, len(seq) AS total, d, CASE WHEN d > 0 THEN seq[d].chars ELSE 0 END AS chars,
    sha256(array_to_string(list_transform(seq[1:d], lambda x: x.digest), ',')) AS node,
    CASE WHEN d > 0 THEN
      sha256(array_to_string(list_transform(seq[1:d - 1], lambda x: x.digest), ',')) END AS parent
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM built)),
nodes AS (
  SELECT node, d, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id,
    count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (total = d), '') AS ends
  FROM steps GROUP BY node, d),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
pairs AS (
  SELECT DISTINCT a.node, a.d, s.node AS below, s.d AS below_d
  FROM steps a JOIN steps s ON a.conv_id = s.conv_id AND s.d >= a.d),
subtrees AS (
  SELECT p.node, p.d, count(*) FILTER (k.n IS NULL) AS n_leaves,
    sum((b.n_convs - 1) * b.chars) AS saved
  FROM pairs p JOIN nodes b ON b.node = p.below AND b.d = p.below_d
  LEFT JOIN kids k ON k.node = b.node AND k.d = b.d GROUP BY p.node, p.d)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs,
  coalesce(k.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subtrees s USING (node, d) LEFT JOIN kids k USING (node, d)
LEFT JOIN nodes u ON u.node = n.parent AND u.d = n.d - 1
"""

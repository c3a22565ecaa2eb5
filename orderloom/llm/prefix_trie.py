"""Trie of conversation prefixes: union-find over the LCP edges of sorted neighbours.

A turn becomes a 16-byte hash of role and text, a conversation the string of its turns' hashes, so
texts are read once and never shuffled. Equal strings form a class, folded over sorted blocks of ids.
The classes are sorted over ranges; in every partition the edges between neighbours, weighted by
their longest common prefix in turns, are taken in descending depth, and each merge of two
components makes (or extends) the branching node at that depth. The turns between a node and its
parent are nodes as well, with one child each.

Ranges cut subtrees. With the common prefix of the last class of one partition and the first of the
next, only the prefixes they share are open. Everything below is final; an open prefix keeps the
sums of its part of each partition (the forest contracted to its rim), and these are merged by the
prefix's hash. Members, leaves, children and tokens are counted where a class first creates a node,
so that sums of parts equal those of the whole.

Null role and text are empty. Turns of one number are ordered by role and text hash; a null turn
comes first. Rows without conv_id belong to no conversation. c % 5 takes the sign of c. An empty
table has no nodes, not even a root. Repeated rows are turns of their own. A conversation, 16
bytes a turn, and one partition of distinct conversations are held in a task; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import map_arrow, pick, written

WIDTH = 16
#: Conversations of one class are folded in blocks of so many neighbouring ids.
ID_BITS = 12
#: Bytes of strings that one partition of the sorted classes may hold on average.
PART_BYTES = 32 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turn_hash(role: Column, text: Column) -> Column:
    """The first 16 bytes of a SHA-256 over role and text, told apart by the role's length."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH)


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (ordered array of turn, hash h and UTF-8 size b) of every conversation."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull())
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct("turn", _turn_hash(role, text).alias("h"), F.octet_length(text).cast("bigint").alias("b"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))


def _strings(rows: DataFrame, heads: str | None = None, h: str | None = None) -> DataFrame:
    """conv_id, key (the turns' hashes in a row) and sizes (8 bytes a turn) of conversations.

    With `heads` and `h` a conversation starts with the first h turns of heads, then goes on with
    its own from the h-th.
    """
    names = list(rows.columns)
    own_at, head_at, h_at = names.index("turns"), heads and names.index(heads), h and names.index(h)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            own = batch.column(own_at).to_pylist()
            first = batch.column(head_at).to_pylist() if heads else [None] * len(own)
            cut = batch.column(h_at).to_pylist() if h else [0] * len(own)
            for turns, before, n in zip(own, first, cut, strict=True):
                turns = [*(before or [])[:n], *turns[n:]]
                keys.append(b"".join(t["h"] for t in turns))
                sizes.append(np.array([t["b"] for t in turns], "<i8").tobytes())
            ids = batch.column(names.index("conv_id"))
            arrays = [ids, pa.array(keys, pa.binary()), pa.array(sizes, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "key", "sizes"])

    return map_arrow(rows, run, T.StructType.fromDDL("conv_id bigint, key binary, sizes binary"))


def sequences(conversations: DataFrame) -> DataFrame:
    """The conversations as they are."""
    return _strings(turn_lists(conversations))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation c behind the first crc32(c) % 9 turns of conversation c - c % 5."""
    lists = written(turn_lists(conversations), "turn-lists")
    own = lists.withColumns(
        {"base": F.col("conv_id") - F.col("conv_id") % 5, "h": (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")}
    )
    heads = lists.where(F.col("conv_id") % 5 == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("heads"))
    joined = own.join(heads, "base", "left").select("conv_id", "turns", "heads", "h")
    return _strings(joined, "heads", "h")


CLASS = "part int, at int, key binary, sizes binary, conv_id bigint, n bigint, ends string, edge int"


def _classes(strings: DataFrame, parts: int | None) -> DataFrame:
    """The distinct strings in order within ranges: part and place, least id, number and hash of ids.

    edge is 1 for the first class of a part, 2 for the last, 3 for both, else 0.
    """
    block = F.shiftright("conv_id", ID_BITS)
    blocks = strings.groupBy("key", "sizes", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = written(blocks, "id-blocks").withColumnRenamed("block", "b")
    if not parts:
        size = blocks.agg(F.sum(F.length("key") + F.length("sizes"))).first()[0] or 0
        needed = -(-size // PART_BYTES)
        if needed > int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            parts = needed
    ranged = blocks.repartitionByRange(parts, "key") if parts else blocks.repartitionByRange("key")
    ranged = ranged.sortWithinPartitions("key", "b").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("part", pa.int32()), ("at", pa.int32()), ("key", pa.binary()), ("sizes", pa.binary())]
            + [("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string()), ("edge", pa.int32())]
        )
        rows: list[tuple] = []
        at, held = 0, None  # held: part, key, sizes, least id, number, running hash

        def closed(last: bool) -> None:
            part, key, sizes, least, n, sha = held
            rows.append((part, at, key, sizes, least, n, sha.hexdigest(), (at == 0) + 2 * last))

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for key, sizes, ids, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = ",".join(map(str, ids)).encode()
                if held and held[1] == key:
                    held[4] += len(ids)
                    held[5].update(b"," + text)
                    continue
                if held:
                    closed(False)
                    at += 1
                held = [part, key, sizes, ids[0], len(ids), hashlib.sha256(text)]
                if len(rows) >= 2000:
                    yield batch_of()
        if held:
            closed(True)
            yield batch_of()

    return written(map_arrow(ranged.select("key", "sizes", "ids", "part"), run, T.StructType.fromDDL(CLASS)), "classes")


def shared_turns(a: bytes, b: bytes) -> int:
    """Longest common prefix of two strings in turns."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    low = 0
    while n - low > 1:  # a[:low] agrees, a[:n] does not
        mid = (low + n) // 2
        if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH]:
            low = mid
        else:
            n = mid
    return low


class Forest:
    """Compressed trie of sorted distinct strings with lengths in turns, by descending LCP."""

    def __init__(self, lengths: list[int], lcps: list[int]) -> None:
        """lcps[i] belongs to the edge between i and i + 1."""
        m = len(lengths)
        self.depth, self.parent = list(lengths), [-1] * m
        self.first = list(range(m))  # a class of the subtree, for the turns on the way
        root = list(range(m))  # union-find over classes
        top = list(range(m))  # the node on top of each component, by its representative

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for e in sorted(range(m - 1), key=lambda e: (-lcps[e], e)):
            a, b, d = find(e), find(e + 1), lcps[e]
            node = top[a]
            if self.depth[node] > d:
                node = len(self.depth)
                self.depth.append(d)
                self.parent.append(-1)
                self.first.append(self.first[top[a]])
                self.parent[top[a]] = node
            self.parent[top[b]] = node
            root[b] = a
            top[a] = node
        last = top[find(0)]
        if self.depth[last] > 0:
            self.parent[last] = len(self.depth)
            self.depth.append(0)
            self.parent.append(-1)
            self.first.append(self.first[last])


NODE = (
    "part int, side int, depth bigint, prefix binary, up binary, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)


def _nodes(part: int, left: int, right: int, keys: list, sizes: list, ids: list, ns: list, ends: list) -> list:
    """The columns of NODE for one partition.

    left and right are the common prefixes with the neighbouring partitions, -1 without one. side is
    0 or 1 for the prefixes open on the left or right; for a closed node below an open one, 2 or 3;
    else null.
    """
    m = len(keys)
    lengths = [len(k) // WIDTH for k in keys]
    lcps = [shared_turns(keys[i], keys[i + 1]) for i in range(m - 1)]
    tree = Forest(lengths, lcps)
    k = len(tree.depth)
    depth, parent = np.array(tree.depth), np.array(tree.parent)
    n_of, id_of, leaves, children = [*ns] + [0] * (k - m), [*ids] + [None] * (k - m), [0] * k, [0] * k
    nexts = [*lcps, right]
    for i in range(m):
        leaves[i] = int(nexts[i] < lengths[i])
    # children come before their parents in this order
    order = sorted(range(k), key=lambda i: -tree.depth[i])
    for i in order:
        p = tree.parent[i]
        if p >= 0:
            n_of[p] += n_of[i]
            leaves[p] += leaves[i]
            children[p] += 1
            if id_of[p] is None or id_of[i] < id_of[p]:
                id_of[p] = id_of[i]
    rims = [np.zeros(k, bool), np.zeros(k, bool)]
    for side, i in ((0, 0), (1, m - 1)):
        while i >= 0:
            rims[side][i] = True
            i = tree.parent[i]
    # a row for every turn between a node and its parent, from the top down
    above = np.where(parent >= 0, depth[parent], -1)
    count = depth - above
    node = np.repeat(np.arange(k), count)
    start = np.cumsum(count) - count
    d = np.arange(len(node)) - start[node] + above[node] + 1
    flat = np.frombuffer(b"".join(sizes), "<i8")
    offset = np.cumsum([0, *lengths])[:-1]
    size = np.zeros(len(node), np.int64)
    deep = d > 0
    size[deep] = flat[(offset[np.array(tree.first)[node]] + d - 1)[deep]]
    n = np.array(n_of, np.int64)[node]
    on_left, on_right = rims[0][node], rims[1][node]
    created = ~(on_left & (d <= left))  # else the partition before counts it
    weight = size * (n - created)
    total = np.add.reduceat(weight, start)
    below = [0] * k  # saved in the subtrees of a node's children
    for i in order:
        if tree.parent[i] >= 0:
            below[tree.parent[i]] += below[i] + int(total[i])
    before = np.cumsum(weight) - weight
    saved = total[node] - (before - before[start][node]) + np.array(below, np.int64)[node]
    bottom = d == depth[node]
    kids = np.where(bottom, np.array(children)[node], 1) - (on_left & (d + 1 <= left))
    open_left, open_right = on_left & (d <= left), on_right & (d <= right)
    up_left, up_right = on_left & (d - 1 <= left) & deep, on_right & (d - 1 <= right) & deep
    # the parent of a closed node may be open without being on the node's own rim
    is_top = d == above[node] + 1
    rim_parent = [np.where(parent >= 0, rims[s][parent], False)[node] & is_top & deep for s in (0, 1)]
    up_left |= rim_parent[0] & (d - 1 <= left)
    up_right |= rim_parent[1] & (d - 1 <= right)
    out: list[list] = [[] for _ in range(12)]
    ids_of = [id_of[i] for i in range(k)]
    columns = (x.tolist() for x in (node, d, n, kids, saved, bottom, is_top, open_left, open_right, up_left, up_right))
    for i, at, count_, kid, save, low, high, ol, orr, ul, ur in zip(*columns, strict=True):
        prefix = up = None
        side = None
        if ol or orr:
            side = 0 if ol else 1
            string = keys[0] if ol else keys[-1]
            prefix = hashlib.sha256(string[: at * WIDTH]).digest()
            up = hashlib.sha256(string[: (at - 1) * WIDTH]).digest() if at else None
        elif ul or ur:
            side = 2 if ul else 3
        above_id = ids_of[i] if not high else (ids_of[tree.parent[i]] if tree.parent[i] >= 0 else None)
        row = (part, side, at, prefix, up, ids_of[i], above_id, count_, kid, leaves[i], save)
        for c, v in zip(out, row, strict=False):
            c.append(v)
        out[11].append(ends[i] if low and i < m else None)
    return out


def _borders(classes: DataFrame) -> DataFrame:
    """part, left and right: what each partition shares with its neighbours; -1 without one.

    Only the numbers of the partitions that hold rows pass through the driver.
    """
    spark = classes.sparkSession
    edges = classes.where("edge > 0").select("part", "edge", "key")
    parts = sorted(r["part"] for r in edges.where("edge in (1, 3)").select("part").collect())
    pairs = spark.createDataFrame(
        list(zip([None, *parts], [*parts, None], strict=True))[1:-1], "before int, part int"
    )
    firsts = edges.where("edge in (1, 3)").select("part", F.col("key").alias("first"))
    lasts = edges.where("edge in (2, 3)").select(F.col("part").alias("before"), F.col("key").alias("last"))
    joined = pairs.join(firsts, "part").join(lasts, "before").select("before", "part", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            lcp = pa.array([shared_turns(a, b) for a, b in both], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lcp], names=["before", "part", "lcp"])

    shared = map_arrow(joined, run, T.StructType.fromDDL("before int, part int, lcp int"))
    sides = shared.select(F.col("part"), F.col("lcp").alias("left"), F.lit(-1).alias("right")).unionByName(
        shared.select(F.col("before").alias("part"), F.lit(-1).alias("left"), F.col("lcp").alias("right"))
    )
    return sides.groupBy("part").agg(F.max("left").alias("left"), F.max("right").alias("right"))


def _forests(classes: DataFrame) -> DataFrame:
    rows = classes.select("part", "at", "key", "sizes", "conv_id", "n", "ends").join(_borders(classes), "part", "left")
    schema = T.StructType.fromDDL(NODE)
    names = schema.names
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.string()]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        lists = {c: table.column(c).to_pylist() for c in ("key", "sizes", "conv_id", "n", "ends")}
        part, left, right = (table.column(c)[0].as_py() for c in ("part", "left", "right"))
        sides = (-1 if s is None else s for s in (left, right))
        made = _nodes(part, *sides, *lists.values())
        return pa.table([pa.array(v, t) for v, t in zip(made, types, strict=True)], names=names)

    return written(rows.groupBy("part").applyInArrow(run, schema), "forests")


def trie(strings: DataFrame, parts: int | None = None) -> DataFrame:
    """A row for every distinct prefix of the strings (conv_id, key, sizes).

    conv_id is the least member, saved_tokens the bytes of the last turns of the subtree's nodes,
    once for every member but one; ends_sha256 hashes the ids of the members that end at the node.
    parts is the number of ranges; without it the session's, or more where these are large.
    """
    forests = _forests(_classes(strings, parts))
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    rim = forests.where("side in (0, 1)")
    merged = rim.groupBy("prefix", "depth").agg(
        F.first("up").alias("up"),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in sums),
        F.max("ends").alias("ends"),
    )
    merged = written(merged, "merged-rims")
    names = merged.select(F.col("prefix").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    rest = ("conv_id", "depth", "parent_conv_id", *sums, "ends")  # of every node
    opened = merged.join(names, "up", "left").select(*rest)
    # closed nodes find their open parent by partition, side and depth: no prefix gathers all of them;
    # a prefix open on both sides stands on the left
    place = rim.select("part", "side", (F.col("depth") + 1).alias("depth"), "prefix")
    place = place.join(merged.select("prefix", F.col("conv_id").alias("known")), "prefix").drop("prefix")
    below = forests.where("side in (2, 3)").withColumn("side", F.col("side") - 2)
    below = below.join(place, ["part", "side", "depth"]).withColumn("parent_conv_id", F.col("known")).select(*rest)
    nodes = forests.where("side is null").select(*rest).unionByName(below).unionByName(opened)
    return nodes.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")


def prefix_trie(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(sequences(conversations), parts)


def rebuilt_trie(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(conversations), parts)

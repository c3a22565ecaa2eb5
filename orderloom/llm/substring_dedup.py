"""Repeated passages by prefix-partitioned suffix trees.

Words are runs of anything but ASCII white space, unchanged. A window is 50 consecutive words of a
document; it is removed if its words also start in a document with a smaller doc_id. Documents of
equal words form a class: all but those of its least doc_id are repeats as a whole, and one row of
the class stands for it in what follows.

Which suffixes can share 50 words is found without listing all of them. Every window names an anchor:
the place of the least hash among its 35 runs of 16 words. Equal windows have their anchor at the
same place, so every repeat is seen from suffixes that start at an anchor. Neighbouring windows with
one anchor form a region (84 words at most), and an anchor whose first 16 words start in one
document only is done with. Regions of equal words are a kind: copies of a kind in later documents
are repeats as they stand, and only one carrier of each kind goes into the trees.

The suffixes are split by prefixes of variable length, so that each group fits into memory: the 16
words at the anchor where at most `group` kinds share them, the whole window of 50 words where more
do. A group's subtree is built by sorting the suffixes of its regions: neighbours and their common
prefixes are the tree's inner nodes, and the topmost nodes at least 50 words deep are the repeats;
deeper ones lie inside them. A group with a prefix of 50 words is one deep node, which needs no tree
but the least doc_id below it, taken by an aggregation.

Words and regions are compared by 64-bit hashes of words and 128 bits (anchor and region).

Null and empty texts have no words and lose none. A null doc_id counts as the largest number; rows of
one doc_id are no repeats of each other, so repeated rows repeat their result. Texts may be of any
length. An empty table gives an empty one; extra columns are not read (`deduplicate`: kept).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import WordHashes, flagged, map_arrow, mix64, pick, written

WINDOW, GRAM = 50, 16
#: Kinds of one prefix that a task holds at once.
GROUP = 1000
#: Words that are hashed in one go.
SLICE = 150_000
LAST = (1 << 63) - 1
_FACTOR = np.uint64(0x9FB21C651E98DF25)
_PLACE = np.uint64((1 << 30) - 1)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").split() if text else []


def _double(g: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of 2 n words from those of n."""
    return mix64(g[: max(0, len(g) - n)] * _FACTOR + g[n:])


def _least(g: np.ndarray, size: int) -> np.ndarray:
    """The least of every `size` neighbours."""
    have = 1
    while have * 2 <= size:
        g = np.minimum(g[: max(0, len(g) - have)], g[have:])
        have *= 2
    return np.minimum(g[: max(0, len(g) - size + have)], g[size - have :])


def regions(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, region hash, first window and number of windows of all regions of some documents.

    h has the word hashes of the documents in a row, which end at `ends`.
    """
    none = (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    if len(h) < WINDOW:
        return none
    g = h
    for n in (1, 2, 4, 8):
        g = _double(g, n)
    order = g & ~_PLACE | np.arange(len(g), dtype=np.uint64)
    place = (_least(order, WINDOW - GRAM + 1) & _PLACE).astype(np.int64)
    # a window that runs over the end of its document is none
    at = np.arange(len(place))
    document = np.searchsorted(ends, at, side="right")
    at = at[at + WINDOW <= ends[document]]
    if not len(at):
        return none
    p, document = place[at], document[at]
    first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (document[1:] != document[:-1])])
    count = np.diff(np.r_[first, len(at)])
    start, size = at[first], count + WINDOW - 1
    g32 = _double(g, GRAM)
    of = mix64(g32[start] ^ count.astype(np.uint64))
    of = mix64(of * _FACTOR + g32[start + (size - 2 * GRAM) // 2])
    of = mix64(of * _FACTOR + g32[start + size - 2 * GRAM])
    return g[p[first]], of, start, count


def _scan(docs: DataFrame) -> DataFrame:
    """A row for each document with its place among others (o), a hash of its words and its regions."""
    schema = T.StructType.fromDDL(
        "doc_id bigint, o bigint, t1 bigint, t2 bigint, n_words bigint, sha binary, "
        "a array<bigint>, rc array<bigint>, start array<int>, n array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(4).to_pylist()
            i = 0
            while i < len(texts):
                counts, shas, all_words, first = [], [], [], i
                while i < len(texts) and len(all_words) < SLICE:
                    own = words(texts[i])
                    texts[i] = None
                    counts.append(len(own))
                    shas.append(hashlib.sha256(b" ".join(own)).digest())
                    all_words += own
                    i += 1
                ends = np.cumsum(counts)
                h = np.fromiter(map(hashes.__getitem__, all_words), np.uint64, len(all_words))
                a, rc, start, n = regions(h, ends)
                owner = np.searchsorted(ends, start, side="right")
                offsets = pa.array(np.searchsorted(owner, np.arange(len(ends) + 1)), pa.int32())
                start = start - (ends - counts)[owner] if len(start) else start
                lists = (a.view(np.int64), rc.view(np.int64), start.astype(np.int32), n.astype(np.int32))
                arrays = [batch.column(k).slice(first, i - first) for k in range(4)]
                arrays += [pa.array(counts, pa.int64()), pa.array(shas, pa.binary())]
                arrays += [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in lists]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(_placed(docs), run, schema).withColumn("rid", F.monotonically_increasing_id())


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, o, two hashes of the text and the text."""
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.select("doc_id", *_place(F.col("doc_id"), F.col("text")), "text")


def _place(doc_id: Column, text: Column) -> list[Column]:
    o = F.coalesce(doc_id.cast("bigint"), F.lit(LAST)).alias("o")
    return [o, F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted rows (o, t1, t2 and others) with their texts."""
    key = ["o", "t1", "t2"]
    rows = _placed(docs).select(*key, "text").where(flagged(wanted, *key))
    # equal rows meet before the shuffle
    return wanted.join(rows.dropDuplicates(key), key)


def deep_nodes(suffixes: list[tuple], depth: int) -> Iterator[list[tuple]]:
    """Leaves of the topmost inner nodes that are `depth` bytes deep, of sorted suffixes (bytes, ...)."""
    for _, leaves in groupby(suffixes, key=lambda s: s[0][:depth]):
        found = list(leaves)
        if len(found) > 1:
            yield found


def repeated_windows(kinds: list[tuple[int, int, bytes]]) -> list[list[int]]:
    """Windows of each kind (o, number of windows, word hashes) that start in an earlier document too."""
    suffixes = [(w[8 * j :], k, j) for k, (_, n, w) in enumerate(kinds) for j in range(n)]
    suffixes.sort()
    out: list[list[int]] = [[] for _ in kinds]
    for leaves in deep_nodes(suffixes, 8 * WINDOW):
        least = min(kinds[k][0] for _, k, _ in leaves)
        for _, k, j in leaves:
            if kinds[k][0] > least:
                out[k].append(j)
    return out


def _runs(windows: list[int]) -> list[int]:
    """Sorted numbers as first, last, first, last, ..."""
    out: list[int] = []
    for j in sorted(windows):
        if out and j <= out[-1] + 1:
            out[-1] = j
        else:
            out += [j, j]
    return out


def _carriers(docs: DataFrame, chosen: DataFrame, scan: DataFrame) -> DataFrame:
    """a, rc, o, n, kinds and w (word hashes) of the chosen kinds, from the texts that carry them."""
    per_text = chosen.groupBy("rid").agg(F.collect_list(F.struct("a", "rc", "start", "n", "kinds")).alias("regions"))
    wanted = written(per_text.join(scan.select("rid", "o", "t1", "t2"), "rid"), "carriers")
    found = _texts(docs, wanted.select("o", "t1", "t2", "regions")).select("o", "regions", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for o, regions_, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = words(text)
                h = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
                columns = [[r[c] for r in regions_] for c in ("a", "rc", "n", "kinds")]
                parts = [h[r["start"] : r["start"] + r["n"] + WINDOW - 1].tobytes() for r in regions_]
                arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64())]
                arrays += [pa.array([o] * len(parts), pa.int64()), pa.array(columns[2], pa.int32())]
                arrays += [pa.array(columns[3], pa.int64()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "rc", "o", "n", "kinds", "w"])

    schema = T.StructType.fromDDL("a bigint, rc bigint, o bigint, n int, kinds bigint, w binary")
    return written(map_arrow(found, run, schema), "regions")


def _subtrees(kinds: DataFrame) -> DataFrame:
    """a, rc and runs of repeated windows, by a tree for each prefix a."""
    schema = T.StructType.fromDDL("a bigint, rc bigint, runs array<int>")

    def solved(a: int, group: list[tuple]) -> Iterator[tuple]:
        found = repeated_windows([g[1:] for g in group])
        return ((a, g[0], _runs(f)) for g, f in zip(group, found, strict=True) if f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        prefix, group = None, []

        def batch_of() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else ([], [], [])
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            for a, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != prefix:
                    out += solved(prefix, group)
                    prefix, group = a, []
                group.append(tuple(rest))
            if len(out) > 10_000:
                yield batch_of()
        out += solved(prefix, group)
        yield batch_of()

    rows = kinds.select("a", "rc", "o", "n", "w").repartition("a").sortWithinPartitions("a")
    return map_arrow(rows, run, schema)


def _whole_prefixes(kinds: DataFrame) -> DataFrame:
    """a, rc and runs of repeated windows, by all 50 words of a window as its prefix."""
    schema = T.StructType.fromDDL("a bigint, rc bigint, o bigint, j int, w binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, rc, o, n, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = [xxhash.xxh3_128_digest(w[8 * j : 8 * (j + WINDOW)]) for j in range(n)]
                arrays = [pa.array([v] * n, pa.int64()) for v in (a, rc, o)]
                arrays += [pa.array(range(n), pa.int32()), pa.array(hashes, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    windows = written(map_arrow(kinds.select("a", "rc", "o", "n", "w"), run, schema), "windows")
    least = windows.groupBy("w").agg(F.min("o").alias("least"), F.max("o").alias("most")).where("least < most")
    later = windows.join(least.select("w", "least"), "w").where("o > least")
    pair = F.flatten(F.transform(F.collect_list("j"), lambda j: F.array(j, j)))
    return later.groupBy("a", "rc").agg(pair.alias("runs"))


def _spans(runs: DataFrame) -> DataFrame:
    """rid, spans (first word, end, ...: sorted and apart) and n_removed, of runs of windows."""
    schema = T.StructType.fromDDL("rid bigint, spans array<int>, n_removed bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_spans, removed = [], []
            for flat in batch.column(1).to_pylist():
                spans: list[int] = []
                for first, last in sorted(zip(flat[::2], flat[1::2], strict=True)):
                    if spans and first <= spans[-1]:
                        spans[-1] = max(spans[-1], last + WINDOW)
                    else:
                        spans += [first, last + WINDOW]
                all_spans.append(spans)
                removed.append(sum(spans[1::2]) - sum(spans[::2]))
            arrays = [batch.column(0), pa.array(all_spans, pa.list_(pa.int32())), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    grouped = runs.groupBy("rid").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return map_arrow(grouped, run, schema)


def _judged(docs: DataFrame, scan: DataFrame, group: int) -> tuple[DataFrame, DataFrame]:
    """Classes with copies in later documents (sha, least), and classes with repeats inside
    (sha, o, t1, t2, spans, n_removed)."""
    long = scan.where(F.col("n_words") >= WINDOW)
    classes = long.groupBy("sha").agg(
        F.min("o").alias("least"), F.max("o").alias("most"), F.min(F.struct("o", "rid")).alias("lead")
    )
    classes = written(classes.select("sha", "least", "most", F.col("lead.rid").alias("rid")), "classes")
    leads = long.join(classes.select("rid"), "rid", "left_semi")
    leads = written(leads.select("rid", "o", "t1", "t2", "sha", "a", "rc", "start", "n"), "leads")
    every = leads.select("rid", "o", F.inline(F.arrays_zip("a", "rc", "start", "n")))
    # prefixes of anchors that start in several documents
    prefixes = every.groupBy("a").agg(F.min("o").alias("least"), F.max("o").alias("most"))
    prefixes = written(prefixes.where("least < most").select("a"), "prefixes")
    shared = written(every.where(flagged(prefixes, "a")).join(prefixes, "a", "left_semi"), "shared-regions")
    place = F.struct("o", "rid", "start", "n")
    kinds = written(shared.groupBy("a", "rc").agg(F.min(place).alias("p"), F.max("o").alias("most")), "kinds")
    numbers = kinds.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1")
    chosen = kinds.select("a", "rc", "p.rid", "p.start", "p.n").join(numbers, "a")
    carriers = _carriers(docs, chosen, leads)
    inside = _subtrees(carriers.where(F.col("kinds") <= group))
    inside = written(inside.unionByName(_whole_prefixes(carriers.where(F.col("kinds") > group))), "deep-nodes")
    known = kinds.select("a", "rc", F.col("p.o").alias("least"), "most").join(inside, ["a", "rc"], "left")
    # written, so that the join below has nothing but its own two sides and a hot kind can be split
    known = written(known.where("least < most or runs is not null").select("a", "rc", "least", "runs"), "known-kinds")
    places = shared.where(flagged(known, "a", "rc")).join(known, ["a", "rc"])
    whole = F.array(F.col("start"), F.col("start") + F.col("n") - 1)
    moved = F.transform("runs", lambda j: j + F.col("start"))
    runs = places.select("rid", F.when(F.col("o") > F.col("least"), whole).otherwise(moved).alias("runs"))
    spans = _spans(runs.where("runs is not null"))
    inner = written(leads.select("rid", "sha", "o", "t1", "t2").join(spans, "rid"), "spans")
    return classes.where("least < most").select("sha", "least"), inner.drop("rid")


def _kept(own: list[bytes], spans: list[int]) -> bytes:
    out: list[bytes] = []
    at = 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        out += own[at:start]
        at = end
    return b" ".join(out + own[at:])


def _rows(scan: DataFrame, copies: DataFrame, inner: DataFrame, *columns: str) -> DataFrame:
    """The rows of the scan with `whole` (a later copy of a class) and the columns of inner."""
    joined = scan.join(copies, "sha", "left").join(inner.select("sha", *columns), "sha", "left")
    return joined.withColumn("whole", F.coalesce(F.col("o") > F.col("least"), F.lit(False)))


def spans(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words and spans of repeated words (first, end, ...) of every row."""
    scan = written(_scan(docs), "scan")
    rows = _rows(scan.drop("a", "rc", "start", "n"), *_judged(docs, scan, group), "spans")
    whole = F.array(F.lit(0), F.col("n_words").cast("int"))
    none = F.array().cast("array<int>")
    return rows.select(
        "doc_id", "n_words", F.when(F.col("whole"), whole).otherwise(F.coalesce("spans", none)).alias("spans")
    )


def deduplicate(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """docs with repeated words cut out; a text that loses some has the others joined by spaces."""
    scan = written(_scan(docs), "scan")
    key = ["__o", "__t1", "__t2"]
    cut = _rows(scan.drop("a", "rc", "start", "n"), *_judged(docs, scan, group), "spans")
    cut = cut.where("whole or spans is not null").select(*(F.col(k[2:]).alias(k) for k in key), "whole", "spans")
    cut = cut.dropDuplicates(key)
    names = list(docs.columns)
    plain = docs.toDF(*(f"__c{i}" for i in range(len(names))))
    text_at, id_at = names.index("text"), names.index("doc_id")
    place = _place(F.col(f"__c{id_at}"), F.col(f"__c{text_at}"))
    marked = plain.select("*", *(c.alias(k) for c, k in zip(place, key, strict=True))).join(cut, key, "left")
    marked = marked.select(*plain.columns, F.coalesce("whole", F.lit(False)).alias("__whole"), F.col("spans").alias("__spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (text_at, len(names), len(names) + 1)), strict=True)
            kept = ["" if whole else _kept(words(t), s).decode() if s else t for t, whole, s in rows]
            arrays = [pa.array(kept, pa.string()) if k == text_at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_arrow(marked, run, docs.schema)


def digests(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by spaces) of every row."""
    scan = written(_scan(docs), "scan")
    copies, inner = _judged(docs, scan, group)
    schema = T.StructType.fromDDL("sha binary, n_removed bigint, kept binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            kept = [hashlib.sha256(_kept(words(t), s)).digest() for s, t in both]
            arrays = [batch.column(0), batch.column(1), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    found = _texts(docs, inner).select("sha", "n_removed", "spans", "text")
    found = written(map_arrow(found, run, schema), "kept")
    rows = _rows(scan.select("doc_id", "o", "sha", "n_words"), copies, found, "n_removed", "kept")
    hashed = F.when(F.col("whole"), F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("kept", "sha"))
    removed = F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return rows.select(
        "doc_id", "n_words", removed.cast("bigint").alias("n_removed"), F.lower(F.hex(hashed)).alias("kept_sha256")
    )

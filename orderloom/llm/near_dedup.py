"""Near-duplicates by fast similarity sketches, banding and exact verification.

A document is the set of hashed word shingles of its whole text (words: split at ASCII white
space, lower-cased in ASCII only; a text of fewer words is one shingle). Its sketch has 128
coordinates. In round i every shingle is thrown into a hashed bin with the value i + (hash in
[0, 1)); a bin keeps its least value. From round 128 on, round i throws all shingles into bin
i - 128, so after 256 rounds at most no bin is empty, and as a rule long before; then two sketches
agree in each coordinate with the probability of the Jaccard similarity, concentrated as if drawn
independently. 32 bands of 4 coordinates make candidates: a pair of similarity 0.8 is missed with
a probability of 5e-8.

Documents of equal sets form a class, compared once. In every bucket all classes are first
compared with two leaders and linked if the full sets say so. Pairs of a bucket that are then not
yet known to be connected are compared too, those of large buckets in blocks inside tasks that
return connecting links only. So every candidate pair is either verified or connected by verified
links, and the pairs within a group are never listed.

Rows of one doc_id are one document: links of any of its texts are its links (`deduplicate` takes
every row for a document of its own). A row without text or words is linked with nothing. Texts
without an id are searched and linked like others; if no text of a component has one, its component
is null and its rows are kept. Repeated rows repeat their result; an empty table gives an empty
one; extra columns are not returned (by `deduplicate`: kept as they are).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import WordHashes, flagged, forget, map_texts, mix64, pick, written

COORDINATES, ROWS = 128, 4
#: Buckets of more classes are compared in blocks of about so many.
LARGE, BLOCK = 32, 250
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTOR = np.uint64(0x9FB21C651E98DF25)


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of a text."""

    def __init__(self, size: int) -> None:
        forget()  # the pipeline's earlier stages have run in the same workers
        self.size, self.hashes = size, WordHashes(200_000)

    def of(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8").lower().split() if text else []
        n = len(words)
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, n)
        size = min(self.size, n)
        out = mix64(h[: n - size + 1])
        for k in range(1, size):
            out = mix64(out * _FACTOR + h[k : n - size + 1 + k])
        return np.unique(out)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 128 coordinates for each set; an empty set has none filled."""
    t = COORDINATES
    out = np.full(len(sets) * t, EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets])
    items = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for i in range(2 * t):
        if not len(items):
            break
        h = mix64(items ^ mix64(np.uint64([i])))
        place = (h & np.uint64(t - 1)).astype(np.int64) if i < t else np.int64(i - t)
        np.minimum.at(out, owner * t + place, np.uint64(i) << np.uint64(48) | h >> np.uint64(16))
        left = (out.reshape(-1, t) == EMPTY).any(axis=1)[owner]
        items, owner = items[left], owner[left]
    return out.reshape(-1, t)


def bands(rows: np.ndarray) -> np.ndarray:
    """One 64-bit value for every band of every sketch, as int64; bands differ in their values."""
    parts = rows.reshape(len(rows), -1, ROWS)
    out = mix64(parts[:, :, 0] ^ np.arange(parts.shape[1], dtype=np.uint64))
    for k in range(1, ROWS):
        out = mix64(out * _FACTOR + parts[:, :, k])
    return out.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _key() -> Column:
    """Tells texts apart without ids."""
    return F.unhex(F.md5("text"))


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key of the text, n_shingles, digest of the set (null if empty), bands."""

    def start() -> Callable[[list], list]:
        of = Shingler(size).of

        def work(texts: list) -> list:
            out: list[list] = [[], [], []]
            for i in range(0, len(texts), 500):
                sets = [of(t) for t in texts[i : i + 500]]
                out[0] += [len(s) for s in sets]
                out[1] += [_digest(s) for s in sets]
                out[2] += [b if len(s) else None for s, b in zip(sets, bands(sketches(sets)), strict=True)]
            return out

        return work

    fields = {"n_shingles": "bigint", "digest": "binary", "bands": "array<bigint>"}
    rows = pick(docs, "doc_id", "text").withColumn("key", _key())
    return map_texts(rows, fields, start, drop=("text",))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """rep and shingles of the wanted classes (rep, digest, least and key: id and text of a row)."""

    def start() -> Callable[[list], list]:
        of = Shingler(size).of

        def work(texts: list) -> list:
            sets = [of(t) for t in texts]
            return [[_digest(s) for s in sets], [s.view(np.int64) for s in sets]]

        return work

    own = wanted.select(F.col("least").alias("i"), F.col("key").alias("k"))
    texts = pick(docs, "doc_id", "text").withColumn("key", _key())
    texts = texts.where(flagged(wanted.select(F.col("least").alias("doc_id"), "key"), "doc_id", "key"))
    # of repeated rows one is enough
    texts = texts.dropDuplicates(["doc_id", "key"])
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k"))
    texts = texts.join(own, same, "left_semi").select("text")
    found = map_texts(texts, {"digest": "binary", "shingles": "array<bigint>"}, start, drop=("text",))
    return found.join(wanted.select("rep", "digest"), "digest").select("rep", "shingles")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    one = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("of_u"))
    two = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("of_v"))
    both = F.size(F.array_intersect("of_u", "of_v"))
    either = F.size("of_u") + F.size("of_v") - both
    joined = pairs.join(one, "u").join(two, "v")
    return joined.where(100 * both >= percent * either).select("u", "v")


def components(edges: DataFrame) -> DataFrame:
    """node and component (least node reachable) of every node of the edges (u, v).

    Every node takes the least label among its neighbours, then the label of its label, until
    nothing changes. Every round is written to shared storage.
    """
    edges = edges.where(F.col("u") != F.col("v"))
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = written(edges.unionByName(turned).distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    changed = 1
    while changed:
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        new = labels.join(near, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        ends = new.select(F.col("u").alias("label"), F.col("label").alias("end"))
        labels = written(new.join(ends, "label").select("u", "old", F.col("end").alias("label")), "labels")
        changed = labels.where("old != label").limit(1).count()
        labels = labels.select("u", "label")
    return labels.select(F.col("u").alias("node"), F.col("label").alias("component"))


def _buckets(classes: DataFrame) -> DataFrame:
    """bucket, rep, n, size and lead (1 or 2 bits) of the classes that share a bucket with others.

    Two classes lead a bucket: the one with the most copies, as originals tend to be, and the one
    that a hash picks, another one in every band.
    """
    few = F.lit(1 << 20) - F.least(F.col("copies"), F.lit((1 << 20) - 1))
    members = classes.select("rep", "n", "key", few.alias("few"), F.explode("bands").alias("bucket"))
    chance = F.xxhash64("key", "bucket")
    members = members.withColumns(
        {"chance": chance, "turn": F.shiftleft("few", 40).bitwiseOR(F.shiftrightunsigned(chance, 24))}
    ).drop("key", "few")
    crowded = written(
        members.groupBy("bucket")
        .agg(F.min("turn").alias("first"), F.min("chance").alias("least"), F.count("*").alias("size"))
        .where("size > 1"),
        "crowded",
    )
    lead = (F.col("turn") == F.col("first")).cast("int") + 2 * (F.col("chance") == F.col("least")).cast("int")
    kept = members.where(flagged(crowded, "bucket")).join(crowded, "bucket")
    return written(kept.select("bucket", "rep", "n", "size", lead.alias("lead")), "buckets")


def _block_links(rows: DataFrame, leaders: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect the rows (bucket, rep, label) of large buckets.

    The members of all buckets of one leader are dealt into blocks, and every two blocks meet in
    a task of their own, which keeps to itself all pairs but those that connect something. Pairs
    whose sketches agree in less than 60 percent cannot be alike (error below 1e-6 at 0.8).
    """
    groups = rows.join(leaders, "bucket").select("u", "rep", "label").distinct()
    groups = written(groups, "groups")
    counts = groups.groupBy("u").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = groups.join(counts, "u").join(sets, "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = dealt.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        reps, labels, own = pdf["rep"].tolist(), pdf["label"].tolist(), pdf["own"].to_numpy()
        shingles = [np.asarray(s, np.int64) for s in pdf["shingles"]]
        rows = sketches([s.view(np.uint64) for s in shingles])
        sizes = np.array([len(s) for s in shingles])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        within = pdf["low"].iloc[0] == pdf["high"].iloc[0]
        for i in range(len(reps) - 1):
            alike = (rows[i + 1 :] == rows[i]).mean(axis=1)
            near = np.minimum(sizes[i], sizes[i + 1 :]) * 100 >= np.maximum(sizes[i], sizes[i + 1 :]) * percent
            meet = np.full(len(alike), True) if within else own[i + 1 :] != own[i]
            for j in np.flatnonzero((alike >= 0.6) & near & meet) + i + 1:
                a, b = root(labels[i]), root(labels[j])
                if a == b:
                    continue
                both = len(np.intersect1d(shingles[i], shingles[j], assume_unique=True))
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    parent[max(a, b)] = min(a, b)
                    out.append((reps[i], reps[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    columns = ["u", "low", "high", "own", "rep", "label", "shingles"]
    return dealt.select(*columns).groupBy("u", "low", "high").applyInPandas(links, "u long, v long")


def _classes(
    docs: DataFrame, scan: DataFrame, size: int, percent: int, large: int = LARGE, by_id: bool = True
) -> DataFrame:
    """digest, rep, component (least rep reachable) and least (doc_id in the component, null if
    none of its texts has one) of every class of equal sets.

    Classes are numbered, so that texts without ids and several texts of one id are classes like
    others; `by_id` links the classes of one doc_id.
    """
    known = scan.where(F.col("digest").isNotNull())
    grouped = known.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("row"),
        F.count("*").alias("copies"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    # the numbers are fixed by being written
    classes = written(
        grouped.select(
            "digest",
            F.col("row.doc_id").alias("least"),
            F.col("row.key").alias("key"),
            "copies",
            "n",
            "bands",
            F.monotonically_increasing_id().alias("rep"),
        ),
        "classes",
    )
    buckets = _buckets(classes)
    one = buckets.select("bucket", F.col("rep").alias("u"), F.col("n").alias("nu"), "lead")
    two = buckets.select("bucket", F.col("rep").alias("v"), F.col("n").alias("nv"))
    enough = F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent
    other = F.col("u") != F.col("v")
    stars = one.where("lead > 0").join(two, "bucket").where(enough & other).select("u", "v").distinct()
    wanted = buckets.select("rep").distinct()
    wanted = written(classes.select("rep", "digest", "least", "key").join(wanted, "rep", "left_semi"), "wanted")
    sets = written(_sets(docs, wanted, size), "sets")
    linked = written(_verified(stars, sets, percent), "star-links")
    # a class takes the least leader it is linked with, then that one's: equal labels are connected
    label = linked.groupBy(F.col("v").alias("rep")).agg(F.min("u").alias("label"))
    label = written(label.select("rep", F.least("rep", "label").alias("label")), "leaders")
    onward = label.select(F.col("rep").alias("label"), F.col("label").alias("next"))
    label = label.join(onward, "label", "left").select("rep", F.coalesce("next", "label").alias("label"))
    # pairs of a bucket that the leaders have not brought together
    placed = buckets.drop("lead").join(label, "rep", "left")
    placed = written(placed.withColumn("label", F.coalesce("label", "rep")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    rest = written(placed.join(mixed.where("low != high").select("bucket"), "bucket", "left_semi"), "rest")
    small = rest.where(F.col("size") <= large)
    one = small.select("bucket", F.col("rep").alias("u"), F.col("n").alias("nu"), F.col("label").alias("lu"))
    two = small.select("bucket", F.col("rep").alias("v"), F.col("n").alias("nv"), F.col("label").alias("lv"))
    pairs = one.join(two, "bucket").where((F.col("lu") < F.col("lv")) & enough).select("u", "v").distinct()
    leaders = buckets.where(F.col("lead").bitwiseAND(F.lit(1)) == 1)
    leaders = leaders.groupBy("bucket").agg(F.min("rep").alias("u"))
    crowds = rest.where(F.col("size") > large).select("bucket", "rep", "label")
    linked = linked.unionByName(_verified(pairs, sets, percent))
    linked = linked.unionByName(_block_links(crowds, leaders, sets, percent))
    if by_id:
        # several texts of one id belong together
        reps = known.where(F.col("doc_id").isNotNull()).select("doc_id", "digest")
        reps = reps.join(classes.select("digest", "rep"), "digest")
        same = reps.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v"))
        repeated = written(same.where("u != v").select("doc_id", "u"), "repeated-ids")
        linked = linked.unionByName(reps.join(repeated, "doc_id").select("u", F.col("rep").alias("v")))
    found = components(linked).withColumnRenamed("node", "rep")
    found = classes.select("rep", F.col("least").alias("own")).join(found, "rep")
    ids = found.groupBy("component").agg(F.min("own").alias("shared"))
    found = found.join(ids, "component").select("rep", "component", "shared")
    named = classes.select("digest", "rep", "least").join(found, "rep", "left")
    alone = F.col("component").isNull()
    least = F.when(alone, F.col("least")).otherwise(F.col("shared"))
    return written(
        named.select("digest", "rep", F.coalesce("component", "rep").alias("component"), least.alias("least")),
        "named-classes",
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, large: int = LARGE) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable) and kept of every row."""
    scan = written(_scan(docs, shingle), "scan")
    named = _classes(docs, scan, shingle, percent, large)
    rows = scan.select("doc_id", "n_shingles", "digest").join(named.select("digest", "least"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80, large: int = LARGE) -> DataFrame:
    """docs with one row of each component: of the rows with its least doc_id (without an id only
    if no row of it has one) one of the least text key, of repeated rows the least.

    Here a row is a document of its own: unlike texts all stay, also under one doc_id or without
    ids, and so do all rows without words.
    """
    scan = written(_scan(docs, shingle), "scan")
    named = _classes(docs, scan, shingle, percent, large, by_id=False)
    first = F.col("doc_id").eqNullSafe(F.col("least"))
    rows = scan.select("doc_id", "key", "digest").join(named, "digest")
    chosen = rows.where(first).groupBy("component").agg(F.min("key").alias("key"), F.first("least").alias("least"))
    names = list(docs.columns)
    at, text = names.index("doc_id"), names.index("text")
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    keyed = plain.withColumn("key", F.unhex(F.md5(f"c{text}")))
    chosen = written(chosen, "chosen")
    found = keyed.where(flagged(chosen, "key")).join(chosen, "key")
    found = found.where(F.col(f"c{at}").eqNullSafe(F.col("least")))
    kept = found.groupBy("component").agg(F.min(F.struct(*plain.columns)).alias("r")).select("r.*")
    # rows without words are linked with nothing
    empty = scan.where(F.col("digest").isNull() & F.col("key").isNotNull()).select("key").distinct()
    empty = written(empty, "texts-without-words")
    bare = keyed.where(flagged(empty, "key")).join(empty, "key", "left_semi").drop("key")
    bare = bare.unionByName(plain.where(F.col(f"c{text}").isNull()))
    return kept.unionByName(bare).toDF(*names)

"""Benchmark passages in training documents: a broadcast set of test n-grams scans token windows.

Words are runs of digits, letters and bytes above ASCII, lower-cased in ASCII only. A window is
`window` consecutive words of a benchmark item, or all of them where it has fewer. A document
word inside any occurrence of a window is hit; windows are compared word by word, not by hash.

The benchmark is a stated query set. Its size is checked: up to `block_bytes` of text it is one
broadcast; beyond, it is taken in blocks of about that size (an item is never split), each of
which scans all documents and adds to the hits of those before.

Null and empty texts have no words and no hits. Items without words are ignored; a null item_id
marks hits but is not listed among the items. Repeated items count once, repeated documents get
one result each, empty tables give empty or hitless results.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import ARROW, field, kept, map_arrow, pick, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes of words, lower-cased; every other byte becomes a space.
_FOLD = bytes(b if WORD.match(bytes([b])) else 0x20 for b in bytes(range(256)).lower())
BLOCK_BYTES = 2 << 20
RUNS, ITEMS, COUNT = "__hit_runs", "__hit_items", "__n_words"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split() if text else []


class Windows:
    """The windows of some items: by first word, size and last word, then word by word."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        self.found: dict[bytes, set[str]] = {}
        self.starts: dict[bytes, dict[int, set[bytes]]] = {}
        for item, text in items:
            own = words(text)
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if size else 0):
                part = own[i : i + size]
                known = self.found.setdefault(b" ".join(part), set())
                if item is not None:
                    known.add(item)
                self.starts.setdefault(part[0], {}).setdefault(size, set()).add(part[-1])

    def scan(self, own: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words as (start, end), in order and apart, and the items that hit."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        starts, found, n = self.starts, self.found, len(own)
        for i in [i for i, w in enumerate(own) if w in starts]:
            for size, lasts in starts[own[i]].items():
                end = i + size
                if end <= n and own[end - 1] in lasts:
                    known = found.get(b" ".join(own[i:end]))
                    if known is not None:
                        items |= known
                        runs.append((i, end))
        return merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without(text: str, runs: list[int]) -> str:
    """The text without the bytes from the first to the last word of each run."""
    data = text.encode("utf-8")
    spans = [m.span() for m in WORD.finditer(data.lower())]
    out, at = [], 0
    for start, end in zip(runs[::2], runs[1::2], strict=True):
        out.append(data[at : spans[start][0]])
        at = spans[end - 1][1]
    return b"".join([*out, data[at:]]).decode("utf-8")


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    items = pick(benchmark, "item_id", "text").where(F.length("text") > 0).distinct()
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    if n <= 1:
        yield [tuple(r) for r in items.collect()]
        return
    numbered = items.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for b in range(n):
        yield [tuple(r) for r in numbered.where(F.col("_b") == b).drop("_b").collect()]


def mark(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """docs with the number of words, the runs of hit words (start, end, ...) and the items."""
    at = docs.columns.index("text")
    own = len(docs.columns)
    kinds = {COUNT: "bigint", RUNS: "array<int>", ITEMS: "array<string>"}
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in kinds.items():
        schema = schema.add(field(name, kind))
    out = docs
    for b, items in enumerate(_blocks(benchmark, block_bytes)):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, first=b == 0, name=uuid.uuid4().hex):
            windows = kept(f"{name}-{window}", lambda: Windows(sent.value, window))
            for batch in batches:
                texts = batch.column(at).to_pylist()
                known = [] if first else [batch.column(own + 1).to_pylist(), batch.column(own + 2).to_pylist()]
                counts, all_runs, all_items = [], [], []
                for k, text in enumerate(texts):
                    parts = words(text)
                    runs, items = windows.scan(parts)
                    if not first:
                        before = known[0][k]
                        runs = merged([*runs, *zip(before[::2], before[1::2], strict=True)])
                        items = items | set(known[1][k])
                    counts.append(len(parts))
                    all_runs.append([x for r in runs for x in r])
                    all_items.append(sorted(items))
                arrays = [batch.column(i) for i in range(own)]
                made = (counts, all_runs, all_items)
                arrays += [pa.array(v, ARROW[k]) for v, k in zip(made, kinds.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

        if b:
            out = written(out, "benchmark-block")
        out = map_arrow(out, run, schema)
    return out


def hits(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each document."""
    ends = F.transform(RUNS, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(ends, F.lit(0).cast("bigint"), lambda a, x: a + x)
    marked = mark(pick(docs, "doc_id", "text"), benchmark, window, block_bytes)
    return marked.select(
        "doc_id",
        F.col(COUNT).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ITEMS).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ITEMS, ","), 256).alias("items_sha256"),
        (F.size(RUNS) > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """docs without contaminated documents, or ("spans") with the hit words cut out of the texts."""
    marked = mark(docs, benchmark, window, block_bytes)
    if remove == "documents":
        return marked.where(F.size(RUNS) == 0).drop(COUNT, RUNS, ITEMS)
    if remove != "spans":
        raise ValueError(f"remove={remove!r}: documents or spans")
    at, runs_at, names = marked.columns.index("text"), marked.columns.index(RUNS), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(at).to_pylist(), batch.column(runs_at).to_pylist(), strict=True)
            cut = pa.array([without(t, r) if r else t for t, r in pairs], pa.string())
            arrays = [cut if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_arrow(marked, run, docs.schema)

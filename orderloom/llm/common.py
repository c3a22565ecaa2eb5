"""Helpers of the corpus operators: picking columns, mapping text batches, shared files."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import scratch_folder

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}

MASK64 = (1 << 64) - 1

#: Texts that a task holds as Python strings at a time; Arrow batches have up to ten times as many.
AT_ONCE = 1000


def field(name: str, kind: str) -> T.StructField:
    return T.StructType.fromDDL(f"`{name}` {kind}").fields[0]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, by position, so that other columns of like names cannot clash."""
    columns = list(df.columns)
    plain = df.toDF(*(f"c{i}" for i in range(len(columns))))
    return plain.select(*(F.col(f"c{columns.index(n)}").alias(n) for n in names))


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """mapInArrow by position, for frames whose names differ in case only or not at all."""
    names = [f"c{i}" for i in range(len(schema.fields))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, schema.fields, strict=True)]
    return plain.mapInArrow(renamed, T.StructType(fields)).toDF(*schema.names)


def map_texts(
    df: DataFrame,
    fields: dict[str, str],
    start: Callable[[], Callable[[list], list]],
    column: str = "text",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Add `fields` (name to Spark type) worked out from a text column, batch by batch.

    `start` runs once per task and returns a function from a list of texts (AT_ONCE at most) to one
    list per field. A column of df with the name of a new field gives way to it.
    """
    at = df.columns.index(column)
    kept = [i for i, c in enumerate(df.columns) if c not in fields and c not in drop]
    schema = T.StructType([df.schema.fields[i] for i in kept])
    for name, kind in fields.items():
        schema = schema.add(field(name, kind))
    types = [ARROW[kind] for kind in fields.values()]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in sliced(batches):
            if work is None:
                work = start()
            made = work(batch.column(at).to_pylist())
            arrays = [batch.column(i) for i in kept]
            arrays += [pa.array(v, type=t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        work = made = arrays = None
        release()

    return map_arrow(df, run, schema)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(k, AT_ONCE)


def filter_texts(
    df: DataFrame, start: Callable[[], Callable[[list], list]], column: str = "text"
) -> DataFrame:
    """Rows of df whose text the function that `start` returns answers with true."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in sliced(batches):
            if work is None:
                work = start()
            yield batch.filter(pa.array(work(batch.column(at).to_pylist()), type=pa.bool_()))
        work = None
        release()

    return map_arrow(df, run, df.schema)


def held_out(doc_id: Column) -> Column:
    """The fifth of documents whose labels are never learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of the ids whose labels may be learned.

    An id with several labels counts as 1 where any is 1. Null ids and labels drop out.
    """
    return (
        pick(labels, "doc_id", label)
        .where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )


def sample_ids(known: DataFrame, per_class: int) -> DataFrame:
    """At most `per_class` ids of y = 0 and of y = 1, first by a hash: small enough to broadcast."""
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def in_ranges(rows: DataFrame, by: str, n: int) -> DataFrame:
    """rows with `part`, the number below n of the range of the numeric column `by`; nulls in 0.

    The ranges hold about as many rows each; rows of equal values stay together. Only the n - 1
    bounds pass through the driver.
    """
    shares = [k / n for k in range(1, n)] or [0.5]
    bounds = rows.agg(F.percentile_approx(by, shares, 10_000)).first()[0] or []
    number = F.lit(0)
    if n > 1 and bounds:
        at = F.array(*map(F.lit, sorted(set(bounds))))
        number = F.when(F.col(by).isNull(), 0).otherwise(F.size(F.filter(at, lambda b: b <= F.col(by))))
    return rows.withColumn("part", number.cast("int"))


def flagged(keys: DataFrame, *columns: str, least: int = 1 << 10, most: int = 1 << 20) -> Column:
    """Whether a row's columns may equal those of a row of `keys`: true for all that do, and for
    few others as long as there are fewer than 8 million keys.

    A table of bits by hash, about 8 for each key and 8 MB at most, is worked out first; it tells
    most rows that a join would drop before they are shuffled. The join itself must follow.
    """
    spark = keys.sparkSession
    words = least
    n = keys.count()
    while words < most and words * 8 < n:
        words *= 2
    place = F.pmod(F.xxhash64(*columns), F.lit(words * 64))
    word, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).cast("int")
    one = F.lit(1).cast("bigint")
    bits = keys.groupBy(word.alias("w")).agg(F.bit_or(F.call_function("shiftleft", one, bit)).alias("bits"))
    every = spark.range(words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("bits"))
    bits = every.unionByName(bits).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    table = bits.agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("all"))
    table = table.select(F.col("all.bits").alias("flags")).scalar()
    return F.call_function("shiftright", F.get(table, word), bit).bitwiseAND(one) == 1


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    plain.write.parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def shared(spark: SparkSession, label: str) -> tuple[str, str]:
    """A new folder in shared storage and the same as executors open it with pyarrow."""
    path = scratch_folder(spark, label)
    fs, plain = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    fs.create_dir(plain, recursive=True)
    return path, path if "://" in path else f"file://{path}"


class SharedFile:
    """Binary file in shared storage that appears under its name only when complete."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def open_shared(uri: str) -> pa.NativeFile:
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over uint64: a bijection without visible structure."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __init__(self, bound: int = 400_000) -> None:
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Remembered(dict):
    """Results of a function by key; of two times `bound` keys at most, the least used go."""

    def __init__(self, make: Callable, bound: int = 400_000) -> None:
        super().__init__()
        self.make, self.bound, self.before = make, bound, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.bound:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What a Python worker holds from task to task; only the last named thing stays."""
    if name not in _KEPT:
        forget()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Let go of what earlier stages have left in this worker, and give its memory back."""
    _KEPT.clear()
    release()


def release() -> None:
    """Give memory that is no longer used back: an idle worker lives on beside the next stages."""
    gc.collect()
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF

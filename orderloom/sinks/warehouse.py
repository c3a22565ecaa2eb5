"""Target tables as partitioned Parquet below one root folder, loaded by key.

Layout: a hidden partition column holds the month of a date or a hash bucket of the key. An upsert
reads the partitions its keys touch, writes them anew in a folder of its own version and then makes
that version the table by one file (snapshots.py). Readers keep the files they started with, and a
load that is cut off anywhere leaves the table as it was; the next one just runs again.

Where the date of a key may change, an index tells the month each key is stored in. It is dealt
into buckets by key hash, is part of the snapshot, and a batch opens only the buckets of its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import TABLES, TableSpec, conform
from orderloom.sinks.merge import merge_state, require_keys, staged_rows
from orderloom.sinks.snapshots import VERSION, Snapshot, SnapshotLog

PART, BUCKET, MONTH = "part", "bucket", "_month"
NO_MONTH = "none"
#: Buckets a key index starts with, and keys of a bucket from which on it gets four times as many.
INDEX_BUCKETS, INDEX_KEYS = 16, 500_000
#: Bytes of a staged batch that are merged at a time. A larger one is merged in passes, each for some of the
#: keys, so what the shuffles of one pass leave on disk does not grow with the batch.
MERGE_BYTES = 1 << 30
#: Versions whose files stay for readers that began before the last load.
KEPT_VERSIONS = 3


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: dict[str, TableSpec] | None = None,
        index_keys: int = INDEX_KEYS,
        merge_bytes: int = MERGE_BYTES,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables or TABLES)
        self.index_keys = index_keys
        self.merge_bytes = merge_bytes

    # ---- layout ----

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def staging_path(self, table: str) -> str:
        return f"{self.root}/{table}_staging"

    def _index_path(self, table: str) -> str:
        return f"{self.path(table)}/_index"

    def log(self, table: str) -> SnapshotLog:
        return SnapshotLog(self.spark, self.path(table))

    def snapshot(self, table: str) -> Snapshot:
        """What the table consists of now."""
        return next(iter(self.log(table).latest()), Snapshot())

    def _stored_schema(self, table: str) -> T.StructType:
        """Declared columns, then the version column if the table does not declare it."""
        spec = self.tables[table]
        fields = [T.StructField(f.name, f.dataType) for f in spec.schema]
        if spec.version and spec.version not in spec.schema.names:
            fields.append(T.StructField(spec.version, T.TimestampType()))
        return T.StructType(fields)

    def _part_type(self, spec: TableSpec) -> T.DataType:
        return T.StringType() if spec.month_of else T.IntegerType()

    def _part(self, spec: TableSpec) -> Column:
        if spec.month_of:
            return F.coalesce(F.date_format(spec.month_of, "yyyy-MM"), F.lit(NO_MONTH))
        return F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int")

    def _layout_schema(self, table: str) -> T.StructType:
        spec = self.tables[table]
        part = T.StructField(PART, self._part_type(spec))
        return T.StructType([*self._stored_schema(table), part])

    # ---- tables ----

    def create(self, table: str) -> None:
        """Create the table if it is not there; an existing one stays as it is."""
        log = self.log(table)
        if not log.latest():
            log.commit(Snapshot(log.free_number()))

    def create_all(self) -> None:
        for table in self.tables:
            self.create(table)

    def files(self, base: str, schema: T.StructType, column: str, live: dict[str, int]) -> DataFrame:
        """The folders loaded_by=…/column=… of the live partitions."""
        if not live:
            # known to be empty when a plan is made, so joins with it are none
            return self.spark.createDataFrame([], schema).where(F.lit(False))
        paths = [f"{base}/{VERSION}={v}/{column}={p}" for p, v in sorted(live.items())]
        full = T.StructType([*schema, T.StructField(VERSION, T.LongType())])
        found = self.spark.read.schema(full).option("basePath", base).parquet(*paths)
        return found.select(*schema.names)

    def _stored(self, table: str, snapshot: Snapshot | None = None, parts: set | None = None) -> DataFrame:
        live = (snapshot or self.snapshot(table)).parts
        if parts is not None:
            live = {p: v for p, v in live.items() if p in parts}
        return self.files(self.path(table), self._layout_schema(table), PART, live)

    def read(self, table: str, months: set[str] | None = None) -> DataFrame:
        """The table with its declared columns, of some months only if these are given."""
        return self._stored(table, parts=months).select(*self.tables[table].schema.names)

    def partitions(self, table: str, snapshot: Snapshot, parts: set[str]) -> DataFrame:
        """Some partitions of a snapshot, with their names in the column PART."""
        return self._stored(table, snapshot, parts)

    def months(self, table: str) -> dict[str, int]:
        """The partitions of the table and the version each was last written by."""
        return dict(self.snapshot(table).parts)

    # ---- loads ----

    def stage(self, table: str, rows: DataFrame) -> DataFrame:
        """Overwrite staging with the latest row per key, cast to the table's schema.

        Staging cuts the lineage of the input, and its size on disk lets Spark broadcast a
        small batch and leave the target unshuffled. The batch is written as it comes; its rows are
        shuffled only if a key repeats, which the hashes of the keys tell.
        """
        spec = self.tables[table]
        if not spec.month_of or spec.month_of in rows.columns:
            rows = rows.withColumn(PART, self._part(spec))
        typed = conform(rows, self._layout_schema(table))
        batch = self._written(require_keys(typed, spec.keys), self.staging_path(table))
        hashes = batch.groupBy(F.xxhash64(*spec.keys).alias("hash")).count()
        if hashes.where("count > 1").isEmpty():
            return batch
        # equal hashes of unlike keys are as good as never seen, and only cost this pass
        latest = staged_rows(batch, spec.keys, self._version(table, batch))
        return self._written(latest, self._latest_path(table))

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _latest_path(self, table: str) -> str:
        return f"{self.staging_path(table)}_latest"

    def clear_staging(self, table: str) -> None:
        self.log(table).delete(self._latest_path(table))
        empty = self.spark.createDataFrame([], self._layout_schema(table))
        empty.write.mode("overwrite").parquet(self.staging_path(table))

    def upsert(self, table: str, rows: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Merge rows into the table by key. Running it twice equals running it once.

        Rows may hold a part of the columns; the others keep their stored values. `batch` names a
        stream and the number of its batch: it is noted in the same step that makes the rows
        visible, and a batch that is noted already is left out (False).
        """
        spec, log = self.tables[table], self.log(table)
        keys = list(spec.keys)
        self.create(table)
        snapshot = log.latest()[0]
        if batch and snapshot.applied.get(batch[0], -1) >= batch[1]:
            return False
        applied = snapshot.applied | ({batch[0]: batch[1]} if batch else {})
        staged = self.stage(table, rows)
        if staged.isEmpty():
            if batch:
                log.commit(snapshot.next(log.free_number(), applied=applied))
            return True

        has_part = PART in staged.columns
        arriving = (
            {str(row[0]) for row in staged.select(PART).distinct().collect()}  # some months, or buckets
            if has_part
            else {NO_MONTH}
        )
        indexed = bool(spec.month_of and not spec.month_fixed)
        stored_in: set[str] = set()
        if indexed:
            buckets = self._buckets_of(staged.select(*keys), snapshot)
            known = self._index(table, snapshot, buckets).join(staged.select(*keys), keys, "left_semi")
            stored_in = {row[0] for row in known.select(MONTH).distinct().collect()}
        elif spec.month_of and not has_part:
            # fixed months of rows that come without their date: the key column tells
            found = self._stored(table, snapshot).join(staged.select(*keys), keys, "left_semi")
            stored_in = {row[0] for row in found.select(PART).distinct().collect()}

        touched = arriving | stored_in
        target = self._stored(table, snapshot, touched)
        number = log.free_number()
        folder = f"{self.path(table)}/{VERSION}={number}"
        passes = 1 + log.size(self.staging_path(table)) // self.merge_bytes
        for n in range(passes):
            stored, arrived = target, staged
            if passes > 1:
                stored, arrived = (rows.where(self._bucket(keys, passes) == n) for rows in (target, staged))
            state = merge_state(stored, arrived, keys, self._version(table, staged), spec.rules)
            if spec.month_of:
                state = state.withColumn(PART, F.coalesce(PART, F.lit(NO_MONTH)))
            # hot partitions are split over several tasks and files, small ones share a task
            laid_out = state.hint("rebalance", F.col(PART)).write.partitionBy(PART)
            laid_out.mode("append" if n else "errorifexists").parquet(folder)
        written = {n.partition("=")[2] for n in log.children(folder) if n.startswith(f"{PART}=")}
        # a month whose last row has moved elsewhere is not written again
        parts = {p: v for p, v in snapshot.parts.items() if p not in touched}
        new = snapshot.next(number, parts=parts | dict.fromkeys(written, number), applied=applied)
        if indexed:
            new = self._reindexed(table, snapshot, new, staged.select(*keys), buckets, written)
        log.commit(new)
        self.clear_staging(table)
        self.vacuum(table)
        return True

    # ---- index of the months that keys are stored in ----

    def _index_schema(self, table: str) -> T.StructType:
        spec = self.tables[table]
        fields = [spec.schema[k] for k in spec.keys]
        return T.StructType(
            [*fields, T.StructField(MONTH, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        )

    def _buckets_of(self, keys: DataFrame, snapshot: Snapshot) -> set[str]:
        """Buckets of the index that may know these keys; none before the first load."""
        if not snapshot.index_buckets:
            return set()
        bucket = self._bucket(keys.columns, snapshot.index_buckets)
        return {str(r[0]) for r in keys.select(bucket.alias(BUCKET)).distinct().collect()}

    def _bucket(self, keys: list[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _index(self, table: str, snapshot: Snapshot, buckets: set[str]) -> DataFrame:
        live = {b: v for b, v in snapshot.index.items() if b in buckets}
        return self.files(self._index_path(table), self._index_schema(table), BUCKET, live)

    def _reindexed(
        self, table: str, old: Snapshot, new: Snapshot, keys: DataFrame, buckets: set[str], written: set[str]
    ) -> Snapshot:
        """`new` with the index buckets of the staged keys written anew.

        The months come from the partitions just written, as a stale row stays where it was.
        """
        names = keys.columns
        before = self._index(table, old, buckets)
        count = old.index_buckets or INDEX_BUCKETS
        grow = False
        if old.index_buckets:
            size = before.count() + keys.count()
            while size / max(1, len(buckets)) * old.index_buckets / count > self.index_keys:
                count *= 4
            grow = count > old.index_buckets
            if grow:
                before = self._index(table, old, set(old.index))
        else:
            while keys.count() / count > self.index_keys:
                count *= 4
        now = self._stored(table, new, written).join(keys, names, "left_semi")
        now = now.select(*names, F.col(PART).alias(MONTH))
        rest = before.join(keys, names, "left_anti").select(*names, MONTH)
        rows = rest.unionByName(now).withColumn(BUCKET, self._bucket(names, count))
        folder = f"{self._index_path(table)}/{VERSION}={new.number}"
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        made = {n.partition("=")[2] for n in self.log(table).children(folder) if n.startswith(f"{BUCKET}=")}
        kept = {} if grow else {b: v for b, v in old.index.items() if b not in buckets}
        return new.next(new.number, index=kept | dict.fromkeys(made, new.number), index_buckets=count)

    # ---- files that no reader needs ----

    def vacuum(self, table: str, keep: int = KEPT_VERSIONS) -> None:
        """Delete what none of the last `keep` versions holds."""
        log = self.log(table)
        snapshots = log.latest(keep)
        if not snapshots:
            return
        live = [{(p, v) for s in snapshots for p, v in d(s).items()} for d in (lambda s: s.parts, lambda s: s.index)]
        for base, column, needed in (
            (self.path(table), PART, live[0]),
            (self._index_path(table), BUCKET, live[1]),
        ):
            for version in log.children(base):
                if not version.startswith(f"{VERSION}="):
                    continue
                number = int(version.partition("=")[2])
                parts = {n for n in log.children(f"{base}/{version}") if n.startswith(f"{column}=")}
                stale = {n for n in parts if (n.partition("=")[2], number) not in needed}
                if stale == parts:
                    log.delete(f"{base}/{version}")
                    continue
                for name in stale:
                    log.delete(f"{base}/{version}/{name}")
        log.drop_before(snapshots[-1].number)

    def _version(self, table: str, staged: DataFrame) -> str | None:
        version = self.tables[table].version
        return version if version in staged.columns else None

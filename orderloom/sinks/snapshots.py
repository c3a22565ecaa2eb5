"""Snapshots of a table: which files are live, kept as one small file per version.

A version lists its partitions with the folder that holds each, the buckets of the key index, and
the last batch applied of every stream. It becomes the table when its file appears complete under
the next number; nothing else is ever changed in place. A file cut off in the middle counts as
absent, so a reader sees the version before or the new one, whatever was lost on the way.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

SNAPSHOTS = "_snapshots"
#: Folders of files by the version that wrote them.
VERSION = "loaded_by"
END = "\n"


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    parts: dict[str, int] = field(default_factory=dict)  # partition to the version that wrote it
    index: dict[str, int] = field(default_factory=dict)  # bucket of the key index likewise
    index_buckets: int = 0
    applied: dict[str, int] = field(default_factory=dict)  # stream to its last batch
    source: dict[str, int] = field(default_factory=dict)  # of a roll-up: the partitions it has seen

    def next(self, number: int, **changes) -> Snapshot:
        return replace(self, number=number, **changes)


class SnapshotLog:
    """The snapshots below one table's folder. Assumes one writer; a second one fails to commit."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.jvm, self.table = spark._jvm, table
        self.fs = self._path(table).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def children(self, path: str) -> list[str]:
        """Names in a folder; none if it is not there."""
        folder = self._path(path)
        if not self.fs.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder))

    def size(self, path: str) -> int:
        """Bytes of all files in a folder."""
        return self.fs.getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def _numbers(self) -> list[int]:
        names = self.children(f"{self.table}/{SNAPSHOTS}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def _file(self, number: int) -> str:
        return f"{self.table}/{SNAPSHOTS}/{number:010d}.json"

    def _load(self, number: int) -> Snapshot | None:
        stream = self.fs.open(self._path(self._file(number)))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(**json.loads(text)) if text.endswith(END) else None

    def latest(self, count: int = 1) -> list[Snapshot]:
        """The last complete snapshots, newest first."""
        found: list[Snapshot] = []
        for number in reversed(self._numbers()):
            snapshot = self._load(number)
            if snapshot:
                found.append(snapshot)
            if len(found) == count:
                break
        return found

    def free_number(self) -> int:
        """Above all numbers in use, those of writers that were cut off included."""
        written = [int(n.partition("=")[2]) for n in self.children(self.table) if n.startswith(f"{VERSION}=")]
        return max([0, *self._numbers(), *written]) + 1

    def commit(self, snapshot: Snapshot) -> None:
        """Make the snapshot the table; fails if another writer has taken its number."""
        out = self.fs.create(self._path(self._file(snapshot.number)), False)
        out.write(bytearray((json.dumps(asdict(snapshot)) + END).encode()))
        out.close()

    def drop_before(self, oldest: int) -> None:
        for number in self._numbers():
            if number < oldest:
                self.delete(self._file(number))

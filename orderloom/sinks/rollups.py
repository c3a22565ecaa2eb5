"""Partial aggregates of a table, kept per month and worked out anew for changed months only.

A roll-up is laid out like the table it belongs to and remembers which version of every month it
has seen. A refresh folds the months that another version wrote since, drops those that are gone,
and makes the result visible by one snapshot, so one that is cut off is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderloom.sinks.snapshots import VERSION
from orderloom.sinks.warehouse import PART, Warehouse


def refresh(
    warehouse: Warehouse, table: str, name: str, fold: Callable[..., DataFrame]
) -> tuple[DataFrame, set[str]]:
    """The roll-up `name` of a table laid out by month, and the months read for it.

    `fold(rows, PART)` groups rows by the month and whatever else; its result is stored. Each name
    belongs to one fold: under a new one everything is folded once.
    """
    path = f"{table}_{name}"
    log = warehouse.log(path)
    before = warehouse.snapshot(path)
    source = warehouse.snapshot(table)
    changed = {m for m, v in source.parts.items() if before.source.get(m) != v}
    parts = {m: v for m, v in before.parts.items() if m in source.parts and m not in changed}
    folded = fold(warehouse.partitions(table, source, changed), PART)
    if changed or before.source != source.parts:
        number = log.free_number()
        if changed:
            folder = f"{warehouse.path(path)}/{VERSION}={number}"
            folded.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
            written = {n.partition("=")[2] for n in log.children(folder) if n.startswith(f"{PART}=")}
            parts |= dict.fromkeys(written, number)
        log.commit(before.next(number, parts=parts, source=dict(source.parts)))
        warehouse.vacuum(path)
    fields = [f for f in folded.schema if f.name != PART]
    schema = T.StructType([*fields, folded.schema[PART]])
    return warehouse.files(warehouse.path(path), schema, PART, parts), changed

"""The new state of a table after an upsert, as a plan; nothing is written here."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.dedup import latest_per_key

Rules = Mapping[str, Callable[[Column, Column], Column]]


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A null key never matches in a merge, so it fails the load."""
    return df.withColumns(
        {
            k: F.coalesce(F.col(k), F.raise_error(F.lit(f"null key {k} in staged rows")))
            for k in keys
        }
    )


def staged_rows(df: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """Staged input reduced to the latest row per key."""
    return latest_per_key(require_keys(df, keys), keys, version)


def merge_state(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    version: str | None = None,
    rules: Rules | None = None,
) -> DataFrame:
    """Target after `staged` (unique per key) is merged in.

    Matched keys take the staged columns, new keys are inserted, all other rows and all
    columns the staged side does not have stay. A null staged value overwrites. With
    `version`, a staged row older than the stored one is ignored; `rules` combine the stored
    and the staged value of a column instead of overwriting.

    Both joins against the target are semi/anti joins on the staged keys, so a staged side
    small enough to broadcast leaves the target unshuffled.
    """
    keys = list(keys)
    rules = rules or {}
    touched = staged.select(*keys)
    # a row without its key stays; without these, both joins below read one and the same shuffle
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    keyed = target.where(~no_key)
    untouched = keyed.join(touched, keys, "left_anti").select(*target.columns)
    untouched = untouched.unionByName(target.where(no_key))
    complete = set(target.columns) <= set(staged.columns)
    if complete and not version and not rules:
        return untouched.unionByName(staged.select(*target.columns))

    rest = [c for c in target.columns if c not in keys]
    matched = latest_per_key(keyed.join(touched, keys, "left_semi"), keys, version)
    old = matched.select(*keys, F.struct(*rest).alias("_old"), F.lit(True).alias("_matched"))
    pairs = staged.join(old, keys, "left")
    stale = F.lit(False)
    if version:
        stale = F.col("_matched") & (F.col(f"_old.{version}") > F.col(version))
        stale = F.coalesce(stale, F.lit(False))

    def value(c: str) -> Column:
        stored = F.col(f"_old.{c}")
        if c not in staged.columns:
            return stored
        if c in rules:
            return F.when(F.col("_matched"), rules[c](stored, F.col(c))).otherwise(F.col(c))
        return F.when(stale, stored).otherwise(F.col(c))

    merged = pairs.select(
        *keys, *[value(c).cast(target.schema[c].dataType).alias(c) for c in rest]
    )
    return untouched.unionByName(merged.select(*target.columns))

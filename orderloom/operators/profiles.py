"""Report and channel profiles, rankings and load audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import money_or_zero, to_double
from orderloom.functions.text import blank_to_null


def report_profile(records: DataFrame) -> DataFrame:
    """Per report file: lines, distinct invoices, customers and products, dates, amount."""
    return records.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("line_items"),
        F.count_distinct("invoice_num").alias("invoices"),
        F.count_distinct("customer_name").alias("customers"),
        F.count_distinct(blank_to_null(F.col("product_description"))).alias("products"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        to_double(F.sum(money_or_zero(F.col("line_amount")))).alias("total_amount"),
    )


def b2b_profile(invoices: DataFrame) -> DataFrame:
    """One row: revenue, quantity, distinct customers and the months covered, sorted."""
    def total(c):
        return F.coalesce(to_double(F.sum(money_or_zero(F.col(c)))), F.lit(0.0))

    return invoices.agg(
        F.count(F.lit(1)).alias("invoices"),
        total("total_amount").alias("total_revenue"),
        total("total_quantity").alias("total_weight"),
        F.count_distinct("customer_name").alias("customers"),
        F.sort_array(F.collect_set("month")).alias("months"),
    )


def revenue_by(
    df: DataFrame, name: Column, amount: str, first_seen: str | None = None
) -> DataFrame:
    """(name, revenue[, first_seen]): exact decimal revenue; first_seen breaks ties."""
    seen = [F.min(first_seen).alias("first_seen")] if first_seen else []
    return df.groupBy(name.alias("name")).agg(
        F.sum(money_or_zero(F.col(amount))).alias("revenue"), *seen
    )


def best_of(ranked: DataFrame) -> Column:
    """Aggregate over revenue_by() rows: (name, revenue) of the best.

    Ties go to the one seen first where that is known, else by name.
    """
    ties = ["first_seen", "name"] if "first_seen" in ranked.columns else ["name"]
    return F.min_by(F.struct("name", "revenue"), F.struct(-F.col("revenue"), *ties))


def top_by_revenue(
    df: DataFrame, name: str, amount: str, n: int = 5, first_seen: str | None = None
) -> DataFrame:
    """The n names with the highest revenue; ties as in best_of()."""
    ranked = revenue_by(df, F.col(name), amount, first_seen)
    ties = ["first_seen", "name"] if first_seen else ["name"]
    return (
        ranked.orderBy(F.desc("revenue"), *ties)
        .limit(n)
        .select(F.col("name").alias(name), to_double(F.col("revenue")).alias("revenue"))
    )


def top_one(ranked: DataFrame) -> DataFrame:
    """One row (top_name, top_revenue) of revenue_by(); N/A and 0 when there is none."""
    best = ranked.agg(best_of(ranked).alias("best"))
    return best.select(
        F.when(F.col("best").isNull(), F.lit("N/A"))
        .otherwise(F.col("best.name"))
        .alias("top_name"),
        F.coalesce(to_double(F.col("best.revenue")), F.lit(0.0)).alias("top_revenue"),
    )


def key_audit(table: DataFrame, *keys: str) -> DataFrame:
    """One row: total rows, distinct keys and whether each key occurs once."""
    per_key = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("passed", F.col("total") == F.col("distinct_keys"))


#: Sketches have 2 ** LG_CONFIG registers; their relative standard error is 1.04 / sqrt of that
#: at most, and an estimate is off by more than four of them once in 15,000 times.
LG_CONFIG = 14
SKETCH_ERROR = 4 * 1.04 / 2 ** (LG_CONFIG / 2)


def key_sketches(table: DataFrame, part: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per partition the number of rows and a sketch of the distinct keys (16 KB at most).

    Sketches merge without the rows: they can be kept with a table, and a load renews those of
    the partitions it touched. A key with a null in it counts like others.
    """
    key = F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys))
    return table.groupBy(*part).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(key, LG_CONFIG).alias("sketch")
    )


def key_audits(table: DataFrame, part: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """key_audit() of each partition."""
    per_key = table.groupBy(*part, *keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*part).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_keys")
    ).withColumn("passed", F.col("total") == F.col("distinct_keys"))


def agrees(distinct: Column) -> Column:
    """Whether estimated_keys is as near to the number of distinct keys as SKETCH_ERROR allows."""
    return F.abs(F.col("estimated_keys") - distinct) <= F.ceil(distinct * SKETCH_ERROR)


def sketch_audit(sketches: DataFrame, exact: DataFrame, part: Sequence[str]) -> DataFrame:
    """Rows, estimated keys and, where `exact` has the partition, exact keys and verdict of each
    partition, and a row with nulls for the partition that merges the sketches of all.

    `within_error` tells whether the estimate agrees with the exact count; null without one.
    """
    each = sketches.select(*part, "rows", F.hll_sketch_estimate("sketch").alias("estimated_keys"))
    whole = sketches.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimated_keys"),
    )
    known = exact.select(*(F.col(c).alias(f"of_{c}") for c in part), "distinct_keys", "passed")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in part]
    kinds = {f.name: f.dataType for f in sketches.schema}
    checked = each.join(known, same, "left").select(
        *part, "rows", "estimated_keys", "distinct_keys", "passed"
    )
    whole = whole.select(
        *(F.lit(None).cast(kinds[c]).alias(c) for c in part),
        "rows",
        "estimated_keys",
        F.lit(None).cast("bigint").alias("distinct_keys"),
        F.lit(None).cast("boolean").alias("passed"),
    )
    return checked.unionByName(whole).withColumn("within_error", agrees(F.col("distinct_keys")))


def load_audit(before: DataFrame, after: DataFrame, *keys: str) -> DataFrame:
    """One row: totals and distinct keys before and after a load, net new rows, verdict."""
    tagged = before.select(*keys, F.lit(0).alias("is_after")).unionByName(
        after.select(*keys, F.lit(1).alias("is_after"))
    )
    per_key = tagged.groupBy(*keys).agg(
        F.count_if(F.col("is_after") == 0).alias("n_before"),
        F.count_if(F.col("is_after") == 1).alias("n_after"),
    )
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return per_key.agg(
        total("n_before").alias("total_before"),
        F.count_if(F.col("n_before") > 0).alias("distinct_before"),
        total("n_after").alias("total_after"),
        F.count_if(F.col("n_after") > 0).alias("distinct_after"),
    ).withColumns(
        {
            "net_new": F.col("total_after") - F.col("total_before"),
            "passed": F.col("total_after") == F.col("distinct_after"),
        }
    )

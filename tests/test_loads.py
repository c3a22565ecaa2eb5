import datetime as dt
import json
import os
import shutil

import pytest
from builders import customer, line, order, page, product
from conftest import rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from orderloom.operators.dedup import latest_per_key, one_per_key
from orderloom.operators.profiles import key_audit, load_audit
from orderloom.plans import backfill, nightly
from orderloom.schemas import BULK_RECORD, TABLES, TableSpec, earlier_of, schema_of
from orderloom.operators.summary import account_totals, merged_totals
from orderloom.sinks.merge import merge_state, staged_rows
from orderloom.sinks.rollups import refresh
from orderloom.sinks.snapshots import SnapshotLog
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources import control
from orderloom.streaming.incremental import stream_bulk, upsert_stream

KV = "k string, v int, d date"


def kv(spark, *items):
    return spark.createDataFrame(
        [(k, v, d and dt.date.fromisoformat(d)) for k, v, d in items], KV
    )


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_dedup_is_independent_of_row_order(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, v int, t string"
    )
    expected = [("a", 2, "y"), ("b", 1, "q")]
    for shuffled in (df, df.repartition(4), df.orderBy("t", ascending=False)):
        assert pairs(latest_per_key(shuffled, ["k"], "v")) == expected
    assert one_per_key(df, ["k"], [F.col("v")]).count() == 2


def test_dedup_prunes_before_the_shuffle(spark):
    plan = latest_per_key(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), ["k"], "v")
    text = plan._jdf.queryExecution().toString()
    assert text.index("Partial") > text.index("Exchange")


def test_merge_updates_and_inserts(spark):
    target = kv(spark, ("a", 1, None), ("b", 2, None))
    staged = kv(spark, ("b", 20, "2026-01-01"), ("c", None, None))
    once = merge_state(target, staged, ["k"])
    assert pairs(once, "k", "v") == [("a", 1), ("b", 20), ("c", None)]
    assert pairs(merge_state(once, staged, ["k"]), "k", "v") == pairs(once, "k", "v")
    assert pairs(merge_state(target, staged.where("false"), ["k"]), "k", "v") == [("a", 1), ("b", 2)]


def test_merge_partial_rules_and_versions(spark):
    target = kv(spark, ("a", 1, "2026-01-05"), ("b", 5, "2026-01-05"))
    partial = kv(spark, ("a", 9, None), ("c", 3, None)).select("k", "v")
    assert pairs(merge_state(target, partial, ["k"]).selectExpr("k", "v", "d IS NULL")) == [
        ("a", 9, False),
        ("b", 5, False),
        ("c", 3, True),
    ]
    earlier = kv(spark, ("a", 9, "2026-01-09"), ("b", 9, None), ("c", 9, "2026-01-01"))
    merged = merge_state(target, earlier, ["k"], rules={"d": earlier_of})
    assert pairs(merged.selectExpr("k", "v", "string(d)")) == [
        ("a", 9, "2026-01-05"),
        ("b", 9, "2026-01-05"),
        ("c", 9, "2026-01-01"),
    ]
    late = kv(spark, ("a", 0, "2026-02-01"), ("b", 7, "2026-02-01"))
    guarded = merge_state(target, late, ["k"], version="v")
    assert pairs(guarded.selectExpr("k", "v", "string(d)")) == [
        ("a", 1, "2026-01-05"),
        ("b", 7, "2026-02-01"),
    ]


def test_null_key_fails(spark):
    with pytest.raises(Exception, match="null key k"):
        staged_rows(kv(spark, (None, 1, None)), ["k"]).collect()


def test_small_batch_leaves_the_target_unshuffled(spark, tmp_path):
    for name, count in (("target", 1000), ("staged", 3)):
        spark.range(count).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / name))
    target, staged = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "staged"))
    plan = merge_state(target, staged, ["k"], version="v")._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" not in plan.toString()


def month_table(spark, root):
    spec = TableSpec(kv(spark).schema, ("k",), month_of="d")
    return Warehouse(spark, str(root), {"t": spec})


def test_rows_move_between_months(spark, tmp_path):
    w = month_table(spark, tmp_path)
    w.upsert("t", kv(spark, ("a", 1, "2026-01-05"), ("b", 2, "2026-02-05"), ("c", 3, "2026-02-06")))
    w.upsert("t", kv(spark, ("a", 10, "2026-03-05"), ("b", 20, "2026-03-05"), ("n", 4, None)))
    assert pairs(w.read("t"), "k", "v") == [("a", 10), ("b", 20), ("c", 3), ("n", 4)]
    w.upsert("t", kv(spark, ("a", 11, "2026-01-07"), ("x", 5, "2026-01-08")))
    assert pairs(w.read("t"), "k", "v") == [("a", 11), ("b", 20), ("c", 3), ("n", 4), ("x", 5)]
    assert key_audit(w.read("t"), "k").first()["passed"]


def crash_at(patch, at, after):
    """Let the at-th write of a run fail, before or after its files are there; returns the count."""
    seen = [0]

    def guarded(write):
        def run(*args, **options):
            seen[0] += 1
            if seen[0] == at and not after:
                raise RuntimeError("lost")
            done = write(*args, **options)
            if seen[0] == at:
                raise RuntimeError("lost")
            return done

        return run

    patch.setattr(DataFrameWriter, "parquet", guarded(DataFrameWriter.parquet))
    patch.setattr(SnapshotLog, "commit", guarded(SnapshotLog.commit))
    patch.setattr(SnapshotLog, "delete", guarded(SnapshotLog.delete))
    return seen


@pytest.mark.parametrize("after", [False, True])
def test_a_crash_at_any_write_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, after):
    old = [("a", 1), ("b", 2), ("c", 3)]
    new = [("a", 10), ("b", 2), ("c", 3), ("d", 4)]
    w = month_table(spark, tmp_path / "0")
    w.upsert("t", kv(spark, ("a", 0, "2025-01-05"), ("b", 2, "2026-02-05")))
    w.upsert("t", kv(spark, ("a", 1, "2026-01-05"), ("c", 3, "2026-02-05")))
    w.upsert("t", kv(spark, ("c", 3, "2026-02-06")))
    batch = kv(spark, ("a", 10, "2026-02-05"), ("d", 4, "2026-03-05"))
    at, states = 0, set()
    while True:
        at += 1
        shutil.copytree(tmp_path / "0", tmp_path / str(at))
        w = month_table(spark, tmp_path / str(at))
        reader = w.read("t")
        with monkeypatch.context() as patch:
            seen = crash_at(patch, at, after)
            try:
                w.upsert("t", batch)
                crashed = False
            except RuntimeError:
                crashed = True
        found = pairs(w.read("t"), "k", "v")
        assert found in (old, new)
        assert pairs(reader, "k", "v") == old  # a reader keeps the table it began with
        states.add(found == new)
        if at % 3 == 2:
            w.upsert("t", batch)
            assert pairs(w.read("t"), "k", "v") == new
        if not crashed:
            break
    assert seen[0] >= 5 and states == {False, True}


def test_a_half_written_snapshot_is_none(spark, tmp_path):
    w = month_table(spark, tmp_path)
    w.upsert("t", kv(spark, ("a", 1, "2026-01-05")))
    number = w.snapshot("t").number
    (tmp_path / "t" / "_snapshots" / f"{number + 1:010d}.json").write_text('{"number": ')
    assert pairs(w.read("t"), "k", "v") == [("a", 1)]
    w.upsert("t", kv(spark, ("b", 2, "2026-01-05")))
    assert pairs(w.read("t"), "k", "v") == [("a", 1), ("b", 2)]


def test_a_second_writer_fails(spark, tmp_path):
    w = month_table(spark, tmp_path)
    w.upsert("t", kv(spark, ("a", 1, "2026-01-05")))
    log = SnapshotLog(spark, w.path("t"))
    with pytest.raises(Exception, match="already exists"):
        log.commit(w.snapshot("t"))
    assert pairs(w.read("t"), "k", "v") == [("a", 1)]


def test_old_versions_go(spark, tmp_path):
    w = month_table(spark, tmp_path)
    for v in range(6):
        w.upsert("t", kv(spark, ("a", v, "2026-01-05"), *([("b", 1, "2026-02-05")] if not v else [])))
    kept = {p.name for p in (tmp_path / "t").glob("loaded_by=*/part=2026-01")}
    assert len(list((tmp_path / "t").glob("loaded_by=*/part=2026-01"))) == 3 and kept == {"part=2026-01"}
    assert len(list((tmp_path / "t").glob("loaded_by=*/part=2026-02"))) == 1
    assert len(list((tmp_path / "t" / "_snapshots").glob("*.json"))) == 3
    assert pairs(w.read("t"), "k", "v") == [("a", 5), ("b", 1)]


def test_a_small_batch_opens_only_its_index_buckets_and_months(spark, tmp_path):
    w = month_table(spark, tmp_path)
    many = [(f"k{n}", n, f"2026-{1 + n % 6:02d}-05") for n in range(200)]
    w.upsert("t", kv(spark, *many))
    index, parts = w.snapshot("t").index, w.snapshot("t").parts
    assert len(index) == 16 and len(parts) == 6
    wanted = w._buckets_of(kv(spark, ("k7", 0, None)).select("k"), w.snapshot("t"))
    for b, v in index.items():
        if b not in wanted:
            for f in (tmp_path / "t" / "_index" / f"loaded_by={v}" / f"bucket={b}").glob("*.parquet"):
                f.write_bytes(b"unreadable")
    for p, v in parts.items():
        if p not in ("2026-02", "2026-05"):
            for f in (tmp_path / "t" / f"loaded_by={v}" / f"part={p}").glob("*.parquet"):
                f.write_bytes(b"unreadable")
    w.upsert("t", kv(spark, ("k7", 70, "2026-05-09")))  # from February to May
    found = w._stored("t", parts={"2026-02", "2026-05"})
    assert pairs(found.where("k = 'k7'"), "k", "v", "part") == [("k7", 70, "2026-05")]
    now = w.snapshot("t")
    assert {b for b in now.index if now.index[b] == now.number} == wanted
    assert {p for p in now.parts if now.parts[p] == now.number} == {"2026-02", "2026-05"}


def test_the_index_grows_with_the_table(spark, tmp_path):
    spec = TableSpec(kv(spark).schema, ("k",), month_of="d", version="v")
    w = Warehouse(spark, str(tmp_path), {"t": spec}, index_keys=4)
    want = {}
    for step in range(4):
        some = [(f"k{n}", step * 1000 + n, f"2026-{1 + (n * 7 + step) % 9:02d}-05") for n in range(step * 20, step * 60 + 30)]
        w.upsert("t", kv(spark, *some))
        want.update({k: v for k, v, _ in some})
        w.upsert("t", kv(spark, ("k1", 0, "2026-12-01")))  # older than what is stored
    assert w.snapshot("t").index_buckets >= 64
    assert pairs(w.read("t"), "k", "v") == sorted(want.items())
    index = w._index("t", w.snapshot("t"), set(w.snapshot("t").index))
    assert pairs(index, "k", "_month") == pairs(w._stored("t"), "k", "part")


def test_a_batch_counts_once(spark, tmp_path):
    w = month_table(spark, tmp_path)
    assert w.upsert("t", kv(spark, ("a", 1, "2026-01-05")), batch=("s", 0))
    assert not w.upsert("t", kv(spark, ("a", 9, "2026-01-05")), batch=("s", 0))
    assert w.upsert("t", kv(spark), batch=("s", 1))
    assert not w.upsert("t", kv(spark, ("a", 9, "2026-01-05")), batch=("s", 1))
    assert w.upsert("t", kv(spark, ("b", 2, "2026-01-05")), batch=("other", 0))
    assert pairs(w.read("t"), "k", "v") == [("a", 1), ("b", 2)]


def test_fixed_months_are_not_searched(spark, tmp_path, monkeypatch):
    spec = TableSpec(kv(spark).schema, ("k",), month_of="d", month_fixed=True)
    w = Warehouse(spark, str(tmp_path), {"t": spec})
    w.upsert("t", kv(spark, ("a", 1, "2026-01-05"), ("b", 2, "2026-02-05")))
    january = next((tmp_path / "t").glob("loaded_by=*/part=2026-01/*.parquet"))
    january.write_bytes(b"unreadable")
    w.upsert("t", kv(spark, ("b", 3, "2026-02-05"), ("c", 4, "2026-02-07")))
    assert pairs(w.read("t", {"2026-02"}), "k", "v") == [("b", 3), ("c", 4)]


def test_only_touched_months_are_rewritten(spark, tmp_path):
    w = month_table(spark, tmp_path)
    w.upsert("t", kv(spark, ("a", 1, "2026-01-05"), ("b", 2, "2026-02-05")))
    january = w.months("t")["2026-01"]
    w.upsert("t", kv(spark, ("b", 3, "2026-02-05")))
    assert w.months("t")["2026-01"] == january and w.months("t")["2026-02"] > january
    assert pairs(w.read("t"), "k", "v") == [("a", 1), ("b", 3)]


def test_partial_columns_and_stale_rows_in_month_table(spark, tmp_path):
    spec = TableSpec(kv(spark).schema, ("k",), month_of="d", version="v")
    w = Warehouse(spark, str(tmp_path), {"t": spec})
    w.upsert("t", kv(spark, ("a", 5, "2026-01-05")))
    w.upsert("t", kv(spark, ("a", 4, "2026-02-05")))
    assert pairs(w.read("t").selectExpr("k", "v", "string(d)")) == [("a", 5, "2026-01-05")]
    w.upsert("t", kv(spark, ("a", 6, None), ("b", 1, None)).select("k", "v"))
    assert pairs(w.read("t").selectExpr("k", "v", "string(d)")) == [
        ("a", 6, "2026-01-05"),
        ("b", 1, None),
    ]


def test_tables(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.create_all()
    w.create_all()
    for table, spec in TABLES.items():
        assert w.read(table).count() == 0
        assert w.read(table).columns == spec.schema.names
    assert schema_of("fact_orders_staging") == schema_of("fact_orders")
    w.upsert("dim_stores", spark.createDataFrame([], schema_of("dim_stores")))
    assert w.read("dim_stores").count() == 0


def test_load_audit(spark):
    before = kv(spark, ("a", 1, None))
    after = kv(spark, ("a", 1, None), ("b", 1, None), ("b", 2, None))
    assert load_audit(before, after, "k").first().asDict() == {
        "total_before": 1,
        "distinct_before": 1,
        "total_after": 3,
        "distinct_after": 2,
        "net_new": 2,
        "passed": False,
    }


def test_windows():
    now = dt.datetime(2026, 3, 31, 12, tzinfo=dt.timezone.utc)
    assert control.cutoff(since="2026-01-01T00:00:00Z") == "2026-01-01T00:00:00Z"
    assert control.cutoff(days_back=30, now=now) == "2026-03-01T12:00:00Z"
    assert control.cutoff(days_back=None) is None
    assert control.next_cutoff(None, now) == "2026-03-01T12:00:00Z"
    assert control.next_cutoff("2026-03-10T00:30:00Z") == "2026-03-09T23:30:00Z"


def test_watermark(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.create("pipeline_control")
    assert control.read_watermark(w.read("pipeline_control")) is None
    for stamp in ("2026-03-01T00:00:00Z", "2026-03-02T00:00:00Z"):
        w.upsert("pipeline_control", control.control_row(spark, stamp, 7))
    assert control.read_watermark(w.read("pipeline_control")) == "2026-03-02T00:00:00Z"
    assert w.read("pipeline_control").count() == 1


def write_pages(folder, entity, nodes):
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text(json.dumps(page(entity, nodes)) + "\n")


def test_nightly_run(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    no_mail = {"id": "c1"}
    write_pages(
        land / "orders",
        "orders",
        [
            order("o1", lines=[line("l1"), line("l2", title="Rice per lb")], customer=no_mail),
            order("o2", "0.00", lines=[line("l3")]),
            order("old", updatedAt="2026-01-01T00:00:00Z"),
        ],
    )
    write_pages(
        land / "customers", "customers", [customer("c1", "A@x.com", updatedAt="2026-03-20T00:00:00Z")]
    )
    write_pages(land / "products", "products", [product()])
    landing = nightly.Landing(*[str(land / n) for n in ("orders", "customers", "products")])
    w = Warehouse(spark, str(tmp_path / "tables"))
    now = dt.datetime(2026, 3, 30, tzinfo=dt.timezone.utc)
    shops = nightly.Settings(stores=[("s1", "Shop", "North", "pos", "x")])
    report = nightly.run(spark, w, landing, shops, now=now)
    assert (report.cutoff, report.watermark, report.orders) == (
        "2026-02-28T00:00:00Z",
        "2026-03-30T00:00:00Z",
        1,
    )
    counts = {"orders_read": 2, "zero_orders": 1, "small_orders": 0, "kept_orders": 1}
    assert report.read == counts
    (stored,) = w.read("fact_orders").collect()
    assert (stored["order_id"], stored["customer_email"]) == ("o1", "a@x.com")
    assert pairs(w.read("fact_order_lines"), "line_item_id", "is_variable_weight") == [
        ("l1", False),
        ("l2", True),
    ]
    (person,) = w.read("dim_customers").collect()
    assert str(person["first_order_date"]) == "2026-03-01 10:00:00"
    assert w.read("dim_products").count() == 1 and w.read("dim_stores").count() == 1

    # a later order must not move the first order date, an older version must not win
    write_pages(
        land / "orders",
        "orders",
        [
            order("o3", createdAt="2026-03-30T05:00:00Z", updatedAt="2026-03-30T05:00:00Z", customer=no_mail),
            order("o1", "500.00", updatedAt="2026-03-29T23:30:00Z", customer=no_mail),
        ],
    )
    write_pages(
        land / "customers",
        "customers",
        [customer("c1", "a@x.com", phone="9", updatedAt="2026-03-30T01:00:00Z")],
    )
    # fetched twice: counted once; landed long ago: not opened
    write_pages(land / "orders", "orders", [order("o1", "500.00", updatedAt="2026-03-29T23:30:00Z", customer=no_mail)])
    (land / "orders" / "long-ago.json").write_text("no page at all")
    os.utime(land / "orders" / "long-ago.json", (0, 0))
    later = nightly.run(spark, w, landing, now=now + dt.timedelta(days=1))
    assert later.cutoff == "2026-03-29T23:00:00Z" and later.orders == 2
    assert pairs(w.read("fact_orders"), "order_id", "total_revenue") == [("o1", 500.0), ("o3", 64.2)]
    (person,) = w.read("dim_customers").collect()
    assert (str(person["first_order_date"]), person["phone"]) == ("2026-03-01 10:00:00", "9")
    (summary,) = w.read("pipeline_summary").collect()
    assert (summary["online_orders"], summary["returning_customers"]) == (2, 1)
    assert key_audit(w.read("fact_order_lines"), "line_item_id").first()["passed"]


EXPORT = [
    {**{k: v for k, v in order("o1").items() if k != "lineItems"}},
    {"__parentId": "o1", **line("l1")},
    {"__parentId": "o1", **line("l2")},
    {"__parentId": "gone", **line("l3")},
]


def test_rollups_read_changed_months_only(spark, tmp_path):
    spec = TableSpec(TABLES["fact_b2b_invoices"].schema, ("invoice_id",), month_of="date")
    w = Warehouse(spark, str(tmp_path), {"invoices": spec})

    def load(*items):
        rows_ = [(i, dt.date.fromisoformat(d), c, a, 1.0) for i, d, c, a in items]
        schema = "invoice_id string, date date, customer_name string, total_amount double, total_quantity double"
        w.upsert("invoices", spark.createDataFrame(rows_, schema))

    def figures():
        kept, read = refresh(w, "invoices", "by_account", account_totals)
        found = merged_totals(kept.drop("part"), "name")
        whole = account_totals(w.read("invoices"))
        assert pairs(found) == pairs(whole.select(*found.columns))
        return read

    w.create("invoices")
    assert figures() == set()
    load(("1", "2026-01-03", "A", 10.1), ("2", "2026-02-03", "A", 0.2), ("3", "2026-02-09", "B", 5.0))
    assert figures() == {"2026-01", "2026-02"}
    assert figures() == set()
    load(("4", "2026-03-01", "B", 2.5), ("3", "2026-03-02", "B", 6.0))
    assert figures() == {"2026-02", "2026-03"}
    # the last invoice leaves its month, which goes
    load(("1", "2026-03-04", "A", 10.1))
    assert figures() == {"2026-03"} and "2026-01" not in w.months("invoices")
    # a load cut off before its snapshot changes nothing, nor does a refresh cut off
    (tmp_path / "invoices_by_account" / "loaded_by=99").mkdir()
    load(("5", "2026-02-20", "C", 1.0))
    assert figures() == {"2026-02"}


def test_backfill_twice(spark, tmp_path):
    (tmp_path / "bulk").mkdir()
    (tmp_path / "bulk" / "a.jsonl").write_text("\n\n".join(json.dumps(r) for r in EXPORT))
    w = Warehouse(spark, str(tmp_path / "tables"))
    first = backfill.run(spark, w, str(tmp_path / "bulk"))
    assert (first.records, first.orders, first.line_items, first.orphans) == (4, 1, 2, 1)
    assert first.net_new == {"fact_orders": 1, "fact_order_lines": 2}
    again = backfill.run(spark, w, str(tmp_path / "bulk"))
    assert again.net_new == {"fact_orders": 0, "fact_order_lines": 0}
    assert all(again.unique.values())


def test_stream_equals_batch(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    for n in range(4):
        batch = [
            order(f"o{(n + i) % 5}", f"{10 + n}.00", updatedAt=f"2026-03-0{1 + n}T0{i}:00:00Z")
            for i in range(3)
        ]
        for node in batch:
            node.pop("lineItems")
        (land / f"{n}.jsonl").write_text("\n".join(json.dumps(b) for b in batch))
    from orderloom.operators.orders import fact_orders

    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    for _ in range(2):
        query = upsert_stream(
            stream_bulk(spark, str(land), files_per_batch=1),
            streamed,
            {"fact_orders": fact_orders},
            str(tmp_path / "progress"),
        )
        query.awaitTermination()
    batch = Warehouse(spark, str(tmp_path / "batch"))
    raw = spark.read.schema(BULK_RECORD).json(str(land))
    batch.upsert("fact_orders", fact_orders(raw))
    assert rows(streamed.read("fact_orders")) == rows(batch.read("fact_orders"))
    assert streamed.read("fact_orders").count() == 5


def test_key_sketches_merge(spark):
    from orderloom.operators import profiles

    table = spark.range(60_000).selectExpr("concat('m', id % 3) AS m", "id div 3 AS a", "IF(id % 2 = 0, id, NULL) AS b")
    table = table.unionByName(table.where("m = 'm1' AND a < 5000"))  # repeated keys in one partition
    sketches = profiles.key_sketches(table, ["m"], ["a", "b"])
    touched = profiles.key_audits(table.where("m <> 'm2'"), ["m"], ["a", "b"])
    found = {r["m"]: r for r in profiles.sketch_audit(sketches, touched, ["m"]).collect()}
    assert [(found[m]["rows"], found[m]["distinct_keys"], found[m]["passed"]) for m in ("m0", "m1", "m2")] == [
        (20_000, 20_000, True),
        (25_000, 20_000, False),
        (20_000, None, None),
    ]
    assert [found[m]["within_error"] for m in ("m0", "m1", "m2", None)] == [True, True, None, None]
    assert abs(found["m2"]["estimated_keys"] - 20_000) <= 20_000 * profiles.SKETCH_ERROR
    distinct = table.select("a", "b").distinct().count()
    assert found[None]["rows"] == 65_000
    assert abs(found[None]["estimated_keys"] - distinct) <= distinct * profiles.SKETCH_ERROR
    none = profiles.key_sketches(table.limit(0), ["m"], ["a", "b"])
    (whole,) = profiles.sketch_audit(none, touched.limit(0), ["m"]).collect()
    assert (whole["m"], whole["rows"], whole["estimated_keys"]) == (None, 0, 0)

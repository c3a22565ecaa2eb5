"""Figures that must not grow with the input: shuffles, files of one task, passes over texts."""

import datetime as dt
import os

from orderloom.operators import invoices as inv
from orderloom.plans import catalogue
from orderloom.sources.report import read_report
from test_invoices import EXAMPLE


def sold_tables(spark, folder, lines=60):
    """Lines of 12 products, 2 suppliers and 20 orders in two years."""
    folder = str(folder)
    day = dt.datetime(1999, 6, 1)
    rows = [
        (n // 3, n % 12, n % 2, n % 3 + 1, float(n % 5 + 1), 10.5 * n, "N", "O", day.replace(year=1999 + n % 2))
        for n in range(lines)
    ]
    spark.createDataFrame(
        rows,
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(
        [(n, f"tray {n}", n + 1, 2.0 + n) for n in range(12)],
        "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    ).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(n, f"Cust {n}") for n in range(2)], "s_suppkey bigint, s_name string").write.parquet(
        f"{folder}/supplier.parquet"
    )
    spark.createDataFrame(
        [(n, n, "F", 100.0, day, "5-LOW") for n in range(lines // 3)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    return folder


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange " in line and "hashpartitioning" in line]


def test_lines_of_records_are_shuffled_by_split_only(spark, tmp_path):
    (tmp_path / "r.csv").write_text(EXAMPLE.replace("memo, ", "memo\n"), encoding="utf-8")
    grid = read_report(spark, str(tmp_path))
    # rows by split or file; a shuffle by record would name its place
    assert not [s for s in shuffles(grid) if "at_seq" in s or "seq#" in s.split("hashpartitioning(")[1].split(")")[0]]
    lines = inv.report_lines(grid)
    assert [r["memo"] for r in lines.where("invoice_num = '100'").collect()] == ['memo\n"x"']


def test_landed_reports_grow_in_number(spark, tmp_path):
    folder = sold_tables(spark, tmp_path)
    path = catalogue._landed_reports(spark, folder, most=20)
    sizes = [
        sum(1 for _ in open(os.path.join(top, name)))
        for top, _, names in os.walk(path.removeprefix("file:"))
        for name in names
        if name.endswith(".csv")
    ]
    # four folders of two years; in one of all products there are 60 lines of sales
    assert len(sizes) > 4 and max(sizes) < 2 * 60
    found = inv.report_lines(read_report(spark, f"{path}/folder=*/{catalogue._report_name(2000)}")).collect()
    assert len(found) == 30 and {r["source_file"] for r in found} == {"sales 2000+lb.csv"}
    # each line stands below its own product
    assert all(f'"tray {r["product_description"].split()[1]}"' in r["memo"] for r in found)


def test_order_pages_are_shuffled_once(spark, tmp_path):
    folder = sold_tables(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = catalogue.QUERIES["page_unnest_orders"](spark, folder)
        # orders and lines by page, and two for the join of lines and products
        assert len(shuffles(pages)) == 4
        assert sum(r["line_edges"] for r in pages.collect()) == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_records_are_parsed_once(spark):
    from orderloom.sources import bulk

    texts = spark.createDataFrame(
        [('{"id":"1","name":"#1"}',), ('{"__parentId":"1","id":"1-1","quantity":2}',)], "value string"
    )
    parents, children = bulk.parse_sides(texts, "value")
    for side in (parents, children):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
    assert [r["id"] for r in parents.collect()] == ["1"] and [r["id"] for r in children.collect()] == ["1-1"]


def test_events_land_in_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "LANDED_EVENTS", 20)
    start = dt.datetime(2024, 1, 1)
    rows = [(n, start + dt.timedelta(hours=3 * n), n % 7, "click", 1.0, "{}") for n in range(320)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    scratch = str(tmp_path / "scratch")
    monkeypatch.setattr(catalogue, "scratch_folder", lambda spark, label: scratch)
    found = catalogue.QUERIES["stream_upsert"](spark, str(tmp_path)).collect()
    assert sorted(r["event_id"] for r in found) == list(range(313, 320))
    assert len([n for n in os.listdir(f"{scratch}/landed") if n.endswith(".parquet")]) >= 16


def test_blocks_of_report_text_grow_with_files_not_lines(spark, tmp_path):
    from orderloom.plans import retail_tables as rt
    from orderloom.sources.report import parse_grid

    folder = sold_tables(spark, tmp_path)
    found = []
    # two reports of 30 lines: one block each, or blocks of every product where they are large
    for most, blocks in ((1000, {2}), (5, range(2 * 12, 2 * 12 * 20))):
        text = rt.report_text(spark, folder, most=most)
        assert text.select("file", "block").distinct().count() in blocks
        assert text.select("file", "block", "seq", "value").distinct().count() == text.count()
        found.append(inv.report_lines(parse_grid(text, "value")).drop(*inv.POSITION).collect())
    assert sorted(found[0]) == sorted(found[1]) and len(found[0]) == 60
    assert all(f'"tray {r["product_description"].split()[1]}"' in r["memo"] for r in found[0])
    assert {r["date"] for r in found[0]} == {dt.date(1999, 6, 1), dt.date(2000, 6, 1)}


def test_facts_are_made_once_for_both_loads(spark, tmp_path, monkeypatch):
    folder = sold_tables(spark, tmp_path)
    plans, upsert = [], catalogue.Warehouse.upsert

    def spied(self, table, rows, batch=None):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return upsert(self, table, rows, batch)

    monkeypatch.setattr(catalogue.Warehouse, "upsert", spied)
    found = catalogue.QUERIES["channel_summary_by_month"](spark, folder).collect()
    assert found == catalogue.QUERIES["channel_summary"](spark, folder).collect()
    assert len(plans) == 6
    assert not [p for p in plans if "Join" in p or "Aggregate" in p or "Window" in p]


def test_only_repeated_keys_are_shuffled_for_staging(spark, tmp_path, monkeypatch):
    from orderloom.schemas import TableSpec
    from orderloom.sinks import warehouse as wh

    calls, staged_rows = [], wh.staged_rows
    monkeypatch.setattr(wh, "staged_rows", lambda *args: calls.append(args) or staged_rows(*args))
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    w = wh.Warehouse(spark, str(tmp_path), {"t": TableSpec(rows.schema, ("k",), version="v")})
    w.upsert("t", rows)
    assert not calls
    w.upsert("t", spark.createDataFrame([("a", 3), ("c", 4), ("a", 5), ("b", 1)], rows.schema))
    assert len(calls) == 1
    assert sorted(map(tuple, w.read("t").collect())) == [("a", 5), ("b", 2), ("c", 4)]
    assert not os.path.exists(w._latest_path("t"))


def test_a_first_load_joins_nothing_and_a_target_is_shuffled_once(spark, tmp_path):
    from orderloom.schemas import TableSpec
    from orderloom.sinks.merge import merge_state
    from orderloom.sinks.warehouse import Warehouse

    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, v int, w int")
    w = Warehouse(spark, str(tmp_path), {"t": TableSpec(rows.schema, ("k",))})
    state = merge_state(w.read("t"), rows.select("k", "v"), ["k"])
    assert "Join" not in state._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, state.collect())) == [("a", 1, None), ("b", 2, None)]
    w.upsert("t", rows)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        state = merge_state(w.read("t"), rows.select("k", "v"), ["k"])
        plan = state._jdf.queryExecution().executedPlan().toString()
        # the keys of the batch and the target are read by both joins
        assert plan.count("ReusedExchange") == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_without_a_key_stay(spark):
    from orderloom.sinks.merge import merge_state

    target = spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "k string, v int")
    for version in (None, "v"):
        state = merge_state(target, spark.createDataFrame([("a", 3)], target.schema), ["k"], version)
        assert sorted(map(str, state.collect())) == sorted(
            ["Row(k=None, v=1)", "Row(k=None, v=1)", "Row(k='a', v=3)"]
        )


def test_a_large_batch_is_merged_in_passes(spark, tmp_path, monkeypatch):
    from orderloom.schemas import TableSpec
    from orderloom.sinks import warehouse as wh

    sizes, merge_state = [], wh.merge_state

    def spied(target, staged, *rest):
        sizes.append(staged.count())
        return merge_state(target, staged, *rest)

    day = dt.date(2026, 1, 5)
    rows = [(f"k{n}", n, day.replace(month=1 + n % 3)) for n in range(60)]
    spec = TableSpec(spark.createDataFrame(rows, "k string, v int, d date").schema, ("k",), month_of="d")
    w = wh.Warehouse(spark, str(tmp_path), {"t": spec}, merge_bytes=1500)
    w.upsert("t", spark.createDataFrame(rows[:40], spec.schema).coalesce(1))
    monkeypatch.setattr(wh, "merge_state", spied)
    later = [(k, -v, day.replace(month=3)) for k, v, _ in rows[20:]]
    w.upsert("t", spark.createDataFrame(later, spec.schema).repartition(4))
    assert len(sizes) > 1 and sum(sizes) == 40 and max(sizes) < 40
    assert sorted(map(tuple, w.read("t").collect())) == sorted(rows[:20] + later)
    # each month is one partition of one version, as ever
    assert len(w.months("t")) == 3 and w.months("t")["2026-03"] == max(w.months("t").values())


def test_shuffle_files_go_when_a_query_ends(spark):
    import glob
    import time

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    before = files()
    kept = spark.range(1000).repartition(7)  # alive, so nothing is garbage
    assert len(kept.collect()) == 1000
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and kept is not None


def test_broken_lines_of_whole_files_are_shuffled_once(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"r{n}.csv").write_text(EXAMPLE.replace("memo, ", "memo\n"), encoding="utf-8")
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    counts = {}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        for name, most in (("whole", splits), ("split", "200b")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            lines = inv.report_lines(read_report(spark, str(tmp_path)))
            # texts of lines are shuffled once; a second shuffle has their places alone
            plan = lines._jdf.queryExecution().executedPlan().toString()
            counts[name] = len([p for p in plan.split("\n") if "- Exchange" in p and "REPARTITION_BY_COL" in p])
            assert "ReusedExchange [value" in plan
            found = [(r["source_file"], r["invoice_num"], r["memo"]) for r in lines.collect()]
            assert len({f for f, _, _ in found}) == 3 and len([m for _, _, m in found if m == 'memo\n"x"']) == 3
            counts[f"{name} rows"] = sorted(map(str, found))
    finally:
        for k, v in {**before, "spark.sql.files.maxPartitionBytes": splits}.items():
            spark.conf.set(k, v)
    assert counts["whole"] == 1 and counts["split"] == 2
    assert counts["whole rows"] == counts["split rows"]


def test_sales_are_shuffled_once_to_land(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    folder = sold_tables(spark, tmp_path)
    plans, text = [], DataFrameWriter.text

    def spied(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return text(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "text", spied)
    catalogue._landed_reports(spark, folder, most=20)
    (plan,) = plans
    # sales and products; the few suppliers are sent to all tasks
    assert len([p for p in plan.split("\n") if "Exchange hashpartitioning" in p]) <= 2

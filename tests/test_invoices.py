import csv
import random

import pytest
from conftest import rows

from orderloom.operators import invoices as inv
from orderloom.operators import profiles
from orderloom.plans import b2b
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources.report import read_report, read_reports

EXAMPLE = '''﻿Report title,,,,,,,,,,,,,,,,,,,,,,
,,,,Type,,Date,,Num,,Memo,,Name,,Qty,,U/M,,Sales Price,,Amount,,Balance
Inventory,,,,,,,,,,,,,,,,,,,,,,
,,WT-7 Walnut,,,,,,,,,,,,,,,,,,,,
,,,,Invoice,,04/01/2026,,100,,"memo, ""x""",,Cust A,,"1,000.5",,lb,,2.00,,"2,001.00",,2001.00
,,,,Credit Memo,,4/2/26,,101,,,,Cust B,,-1,,lb,,2.00,,-2.00,,1999.00
,,Total WT-7 Walnut,,,,,,,,,,,,,,,,,,1999.00,,
,,,,Total Inventory,,,,,,,,,,,,,,,,1999.00,,
'''


def test_example_report(spark, tmp_path):
    (tmp_path / "april.csv").write_text(EXAMPLE, encoding="utf-8")
    grid = read_report(spark, str(tmp_path / "april.csv"))
    found = rows(inv.report_lines(grid), "invoice_num")
    assert [r["product_description"] for r in found] == ["WT-7 Walnut"] * 2
    assert [str(r["date"]) for r in found] == ["2026-04-01", "2026-04-02"]
    assert [r["line_amount"] for r in found] == [2001.0, -2.0]
    assert found[0]["memo"] == 'memo, "x"' and found[0]["quantity"] == 1000.5
    assert found[0]["source_file"] == "april.csv"


def test_report_text_is_read_twice(spark, tmp_path):
    (tmp_path / "april.csv").write_text(EXAMPLE, encoding="utf-8")
    lines = inv.report_lines(read_report(spark, str(tmp_path)))
    assert lines._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 2


def test_equal_file_names_share_no_line_id(spark, tmp_path):
    for folder in ("a", "b", "c"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "april.csv").write_text(EXAMPLE, encoding="utf-8")
    grid = read_report(spark, [str(tmp_path / f) for f in ("a", "b", "c")])
    ids = [r["line_id"] for r in inv.invoice_lines(inv.report_lines(grid)).collect()]
    assert len(ids) == len(set(ids)) == 6


def long_report(products=40, per_product=9):
    lines = ["Title", EXAMPLE.splitlines()[1]]
    expected = []
    for p in range(products):
        lines.append(f",,Product {p},,,,")
        for n in range(per_product):
            lines.append(f",,,,Invoice,,04/01/2026,,{p}-{n},,,,Cust,,1,,lb,,2.00,,2.00")
            expected.append((f"{p}-{n}", f"Product {p}"))
        lines += [",,Total Product,,", "", ",,,,Estimate,,04/01/2026,,skip,,,,Cust"]
    return "\n".join(lines) + "\n", expected


def test_product_is_carried_across_splits(spark, tmp_path):
    text, expected = long_report()
    (tmp_path / "long.csv").write_text(text)
    (tmp_path / "other.csv").write_text(EXAMPLE, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        grid = read_report(spark, str(tmp_path))
        assert grid.select("file", "block").distinct().count() > 10
        records = inv.report_lines(grid)
        found = records.where("source_file = 'long.csv'").collect()
        assert sorted((r["invoice_num"], r["product_description"]) for r in found) == sorted(
            expected
        )
        lines = inv.invoice_lines(records).where("source = 'long.csv'").collect()
        ids = {r["invoice_id"]: r["line_id"] for r in lines}
        assert [ids[i] for i, _ in expected] == [
            f"{i}_long.csv_{n}" for n, (i, _) in enumerate(expected)
        ]
        overall = inv.invoice_lines(records, line_ids="overall").collect()
        numbers = sorted(int(r["line_id"].rsplit("_", 1)[1]) for r in overall)
        assert numbers == list(range(len(expected) + 2))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_line_break(spark, tmp_path):
    text = EXAMPLE.replace("memo, ", "memo\n")
    (tmp_path / "r.csv").write_text(text, encoding="utf-8")
    (tmp_path / "plain.csv").write_text(EXAMPLE, encoding="utf-8")
    found = inv.report_lines(read_report(spark, str(tmp_path))).where("invoice_num = '100'").collect()
    assert sorted(r["memo"] for r in found) == ['memo\n"x"', 'memo, "x"']
    (tmp_path / "bad.csv").write_text(EXAMPLE + ',,,"never closed\n,,x\n', encoding="utf-8")
    with pytest.raises(Exception, match="has no end"):
        read_report(spark, str(tmp_path / "bad.csv")).collect()


def random_report(rng, records):
    """Cells of all kinds: plain, with stray quotes, quoted with commas, quotes and line breaks."""
    inner = ["a", ",", '""', "\n", " ", '",', "b\nc", ""]
    kinds = [
        lambda: rng.choice(["", "x", 'in"ch', 'two""', "word word", " "]),
        lambda: '"' + "".join(rng.choice(inner[:5] + ["b\nc", ""]) for _ in range(rng.randrange(7))) + '"',
        lambda: '"closed"' + rng.choice(["", "x", " y"]),
    ]
    return "\n".join(
        ",".join(rng.choice(kinds)() for _ in range(rng.randint(1, 6))) + ",end" for _ in range(records)
    ) + "\n"


def test_records_over_lines_and_splits_equal_the_whole_file(spark, tmp_path):
    rng = random.Random(8)
    for name in ("one.csv", "two.csv", "lines.csv"):
        (tmp_path / name).write_text(random_report(rng, 150), encoding="utf-8")
    # one cell over several splits, quoted lines that look like other states, and no break at all
    (tmp_path / "long.csv").write_text('a,"' + 'b,"",c\n' * 200 + '",d\n1,2\n', encoding="utf-8")
    (tmp_path / "plain.csv").write_text('a,"b",c"\n' * 60, encoding="utf-8")
    want = {}
    for path in tmp_path.iterdir():
        with open(path, encoding="utf-8", newline="") as f:
            want[path.name] = [r for r in csv.reader(f)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        grid = read_report(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({(r["file"], r["block"]) for r in grid}) > 20
    for name, records in want.items():
        found = sorted((r for r in grid if r["source_file"] == name), key=lambda r: (r["block"], r["seq"]))
        assert [r["cells"] for r in found] == records


def test_stray_quote_and_short_row(spark, tmp_path):
    body = EXAMPLE.splitlines()[1:3] + [
        ',,12" pipe,,',
        ',,,,Invoice,,2026-4-3,,7,,2" bolt,,Cust C',
        ",,,,Cash Sale,,soon,,8,,,,Cust D,,x,,,,1d,,abc",
        ",,,,invoice,,04/01/2026,,9,,,,Cust D",
    ]
    (tmp_path / "r.csv").write_text("\n".join(body))
    found = rows(inv.report_lines(read_report(spark, str(tmp_path))), "invoice_num")
    assert [r["invoice_num"] for r in found] == ["7", "8"]
    assert found[0]["product_description"] == '12" pipe' and found[0]["memo"] == '2" bolt'
    assert str(found[0]["date"]) == "2026-04-03" and found[0]["line_amount"] is None
    assert (found[1]["date"], found[1]["date_text"]) == (None, "soon")
    assert found[1]["quantity"] is found[1]["unit_price"] is found[1]["line_amount"] is None


def test_named_reports(spark, tmp_path):
    (tmp_path / "april 2026.csv").write_text(EXAMPLE, encoding="utf-8")
    (tmp_path / "notes.csv").write_text("no report")
    grid = read_reports(spark, str(tmp_path), ["april 2026.csv", "may 2026.csv"])
    assert {r["source_file"] for r in grid.collect()} == {"april 2026.csv"}
    assert read_reports(spark, str(tmp_path), ["june.csv"]).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_report(spark, str(tmp_path / "june.csv"))


RECORD = (
    "file string, block bigint, seq bigint, invoice_num string, date date, date_text string, "
    "customer_name string, product_description string, memo string, quantity double, "
    "unit_of_measure string, unit_price double, line_amount double, source_file string"
)


def records(spark, *changes):
    base = {
        "file": "f",
        "block": 0,
        "invoice_num": "100",
        "date_text": "2026-04-01",
        "customer_name": "Cust A",
        "product_description": "Walnut tray",
        "memo": "",
        "quantity": 1.0,
        "unit_of_measure": "lb",
        "unit_price": 2.0,
        "line_amount": 2.0,
        "source_file": "f.csv",
    }
    made = []
    for seq, change in enumerate(changes):
        row = {**base, "seq": seq, **change}
        made.append(row)
    df = spark.createDataFrame(
        [tuple(r.get(c) for c in [p.split()[0] for p in RECORD.split(", ") if "date date" != p])
         for r in made],
        RECORD.replace("date date, ", ""),
    )
    parsed = df.selectExpr("*", "try_to_date(date_text, 'yyyy-MM-dd') AS date")
    return parsed.select(*[p.split()[0] for p in RECORD.split(", ")])


def test_reject_reasons(spark):
    df = records(
        spark,
        {},
        {"invoice_num": None, "customer_name": None},
        {"invoice_num": "  "},
        {"customer_name": "", "date_text": None},
        {"date_text": ""},
        {"date_text": "soon"},
    )
    found = rows(inv.rejects(df), "seq")
    assert [r["reason"] for r in found] == [
        "missing invoice_num",
        "missing invoice_num",
        "missing customer_name",
        "missing date",
        "unparsable date",
    ]
    assert inv.accepted(df).count() == 1


def test_invoice_roll_up(spark):
    df = records(
        spark,
        {"line_amount": 10.10, "quantity": 1.0},
        {"line_amount": None, "quantity": None, "customer_name": "Later", "date_text": "2026-05-01"},
        {"line_amount": 5.05, "quantity": 2.0},
    )
    for shuffled in (df, df.repartition(3), df.orderBy("seq", ascending=False)):
        (row,) = inv.invoices(shuffled).collect()
        assert (row["total_amount"], row["total_quantity"], row["line_item_count"]) == (15.15, 3.0, 3)
        assert (row["customer_name"], row["month"]) == ("Cust A", "2026-04")


def test_line_fallbacks(spark):
    df = records(
        spark,
        {"product_description": " ", "memo": " note ", "unit_of_measure": " "},
        {"product_description": None, "memo": None, "line_amount": None},
    )
    found = rows(inv.invoice_lines(df), "line_id")
    assert [r["product_description"] for r in found] == ["note", "Unknown"]
    assert [r["memo"] for r in found] == ["note", ""]
    assert found[0]["unit_of_measure"] is None and found[1]["line_amount"] == 0.0
    assert [r["line_id"] for r in found] == ["100_f.csv_0", "100_f.csv_1"]
    overall = rows(inv.invoice_lines(df, line_ids="overall"), "line_id")
    assert [r["line_id"] for r in overall] == ["100_0", "100_1"]


def test_profiles(spark):
    df = records(
        spark,
        {"line_amount": 5.0},
        {"line_amount": 7.0, "invoice_num": "101", "customer_name": "Cust B"},
        {"line_amount": 2.0, "invoice_num": "102", "date_text": "2026-05-02"},
    )
    profile = profiles.report_profile(df).first()
    assert (profile["line_items"], profile["invoices"], profile["customers"]) == (3, 3, 2)
    assert profile["total_amount"] == 14.0 and str(profile["date_max"]) == "2026-05-02"
    assert profiles.b2b_profile(inv.invoices(df)).first()["months"] == ["2026-04", "2026-05"]
    top = profiles.top_by_revenue(df, "customer_name", "line_amount", first_seen="seq").collect()
    assert [tuple(r) for r in top] == [("Cust A", 7.0), ("Cust B", 7.0)]
    assert profiles.b2b_profile(inv.invoices(df.where("false"))).first()["total_revenue"] == 0.0


def test_load_reports(spark, tmp_path):
    (tmp_path / "reports").mkdir()
    (tmp_path / "reports" / "april.csv").write_text(EXAMPLE, encoding="utf-8")
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    for _ in range(2):
        b2b.load(spark, warehouse, str(tmp_path / "reports"))
    invoices = rows(warehouse.read("fact_b2b_invoices"), "invoice_id")
    assert [(r["invoice_id"], r["total_amount"]) for r in invoices] == [("100", 2001.0), ("101", -2.0)]
    assert warehouse.read("fact_b2b_invoice_lines").count() == 2

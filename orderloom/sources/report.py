"""Accounting report CSVs as a positional grid: one row per record, cells as an array.

A report has no fixed header: title rows, group headers, transactions and subtotals share
the same columns. The order of the rows carries meaning, so every row keeps its position:
file, block (start of the input split) and seq (increasing inside a block).

A quoted cell may hold line breaks, so where a record ends depends on all quotes before it. Every
line is a function of the state it starts in (inside a quoted cell or not) to the state it ends in.
Such functions are folded per split, the splits' results are carried on over the file, and then
every line knows its state and the line its record starts at: huge files stay split.
"""

from __future__ import annotations

from collections.abc import Sequence
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BOM = "\ufeff"

# One cell with the comma before it. A quoted cell doubles its inner quotes; a quote that does
# not open the cell is plain text.
_QUOTED = '"(?:[^"]++|"")*+"'
_CELL = f",({_QUOTED}[^,]*+|[^,]*+)"
# a quoted cell that does not end with the line, after any number of cells that do
_OPENED = rf'(?:,(?:{_QUOTED}[^,]*+|(?!")[^,]*+))*+,"(?:[^"]++|"")*+\z'


# the same, but a quoted cell without an end is no more than its quote, as no other cell is
_CUT = f',({_QUOTED}[^,]*+|(?!")[^,]*+|")'


def raw_cells(line: Column) -> Column:
    """The cells of a record as they are written, for raw_cell()."""
    return F.regexp_extract_all(_after_comma(line), F.lit(_CUT), F.lit(1))


def checked_cells(raw: Column) -> Column:
    """raw_cells() of a record; one that ends inside a quoted cell fails the job."""
    no_end = F.raise_error(F.lit("a quoted cell of the report has no end"))
    return F.when(F.array_contains(raw, '"'), no_end.cast("array<string>")).otherwise(raw)


def raw_cell(raw: Column, index: Column) -> Column:
    """The text of a cell of checked_cells(); null beyond the last."""
    cell = F.try_element_at(raw, index + 1)
    return F.when(cell.startswith('"'), _inside(cell)).otherwise(cell)


def _inside(cell: Column) -> Column:
    inner = F.regexp_replace(cell, f'\\A"((?:[^"]++|"")*+)"', "$1")
    return F.when(cell.contains('""'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(inner)


def _unquoted(cell: Column) -> Column:
    inner = F.regexp_replace(cell, f'\\A"((?:[^"]++|"")*+)"', "$1")
    return F.when(
        cell.startswith('"'),
        F.when(
            cell.rlike(rf"\A{_QUOTED}"), F.replace(inner, F.lit('""'), F.lit('"'))
        ).otherwise(
            F.raise_error(F.lit("a quoted cell of the report has no end"))
        ),
    ).otherwise(cell)


def parse_grid(lines: DataFrame, column: str) -> DataFrame:
    """Adds `cells`, an array as wide as the record; the record itself stays as `line`.

    A record that ends inside a quoted cell fails the job instead of shifting cells.
    """
    line = _after_comma(F.col(column))
    cells = F.transform(F.regexp_extract_all(line, F.lit(_CELL), F.lit(1)), _unquoted)
    return lines.withColumn("cells", cells).withColumnRenamed(column, "line")


def _after_comma(line: Column) -> Column:
    return F.concat(F.lit(","), F.regexp_replace(line, f"\\A{_BOM}", ""))


def _opens(line: Column) -> Column:
    """Whether a line that starts outside quoted cells ends inside one."""
    return line.contains('"') & _after_comma(line).rlike(rf"\A{_OPENED}")


def _goes_on(line: Column) -> Column:
    """Whether a line that starts inside a quoted cell ends inside one, be it another."""
    return ~line.contains('"') | line.rlike(rf'\A(?:[^"]++|"")*+(?:\z|"[^,]*+{_OPENED})')


def _run(rows: DataFrame, partition: list[str], order: str, fixed: Column, turn: Column) -> DataFrame:
    """Adds known and state: the fold of all rows of a partition up to each one.

    A row sets the state (fixed, 0 or 1), turns it (turn = 1) or leaves it. Where no row has set it,
    known is false and state tells whether it has been turned.
    """
    upto = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_fixed": fixed, "_turns": F.sum(turn).over(upto)})
    last = F.last(F.when(F.col("_fixed").isNotNull(), F.struct("_fixed", "_turns")), True).over(upto)
    rows = rows.withColumn("_last", last)
    since = F.coalesce(F.col("_last._fixed") - F.col("_last._turns"), F.lit(0)) + F.col("_turns")
    return rows.withColumns(
        {"known": F.col("_last").isNotNull(), "state": F.pmod(since, F.lit(2)).cast("int")}
    ).drop("_fixed", "_turns", "_last")


def _step(line: Column) -> Column:
    """What a line does to the state: sets it (0, 1), leaves it (2) or turns it (3)."""
    opened = F.when(_goes_on(line), 1).otherwise(3)
    return (
        F.when(~line.contains('"'), 2)
        .when(_opens(line), opened)
        .otherwise(F.when(_goes_on(line), 2).otherwise(0))
    )


def _placed(lines: DataFrame) -> DataFrame:
    """Lines (with _step() as step) with begins_0 and begins_1: the state each begins in if its split
    begins in 0 or in 1; known and state, as of _run(), after it."""
    before = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("step")
    odd = F.coalesce(F.sum(F.when(step == 3, 1)).over(before), F.lit(0)) % 2
    # the state that was set last, less the turns up to there
    fixed = F.last(F.when(step < 2, (step + F.col("_odd")) % 2), True).over(before)
    placed = lines.withColumn("_odd", odd).withColumn("_fixed", fixed)

    def begins(start: int) -> Column:
        return ((F.coalesce("_fixed", F.lit(start)) + F.col("_odd")) % 2).cast("int")

    after = F.when(step < 2, step).when(step == 3, 1 - F.col("begins_0")).otherwise(F.col("begins_0"))
    placed = placed.withColumns({"begins_0": begins(0), "begins_1": begins(1)})
    made = {"known": (step < 2) | F.col("_fixed").isNotNull(), "state": after}
    return placed.withColumns(made).drop("_odd", "_fixed")


def _pieces(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """The lines of every record in one split as one text, by the place of its first line, own; null
    for those that go on with a record of an earlier split."""
    placed = _placed(lines).join(splits.select("file", "block", "start"), ["file", "block"])
    begins = F.when(F.col("start") == 0, F.col("begins_0")).otherwise(F.col("begins_1"))
    return _joined(placed, begins)


def _joined(placed: DataFrame, begins: Column) -> DataFrame:
    """_pieces() of lines whose state is known."""
    upto = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(begins == 0, F.col("seq")), True).over(upto)
    parts = placed.withColumn("own", own).groupBy("file", "block", "own")
    text = F.array_join(F.array_sort(F.collect_list(F.struct("seq", "value")))["value"], "\n")
    return parts.agg(text.alias("value"))


def whole_records(lines: DataFrame, root: str = "", split: bool = True) -> DataFrame:
    """Lines (value and position) joined to records, each at the position of its first line. What
    `file` leaves out of the paths of all files is `root`; `split` tells that a file may have several
    splits.

    The lines are shuffled once, by split: all steps on lines keep to it, and so may later ones. What
    passes from split to split is one row for each, and the text of records that do so. Files of one
    split each begin outside of cells, so they need no pass to find the state that splits begin in.
    """
    chunk = ["file", "block"]
    of_file = Window.partitionBy("file").orderBy("block")
    # one and the same shuffle serves all passes below, so each takes these columns; a join would
    # look for nulls below the shuffle and so have one of its own, but here Spark knows of none
    place = [F.coalesce(c, F.lit(n)).alias(c) for c, n in (("file", ""), ("block", 0))]
    lines = lines.select("value", *place, "seq", _step(F.col("value")).alias("step")).repartition(*chunk)
    if not split:
        own = _joined(_placed(lines), F.col("begins_0")).withColumnRenamed("own", "seq")
        return own.select("value", "file", _source(root), "block", "seq")
    ends = _placed(lines).groupBy(*chunk).agg(
        F.max_by(F.struct("known", "state"), "seq").alias("end"),
        *(F.max(F.when(F.col(f"begins_{s}") == 0, F.col("seq"))).alias(f"last_{s}") for s in (0, 1)),
    )
    # one row per split from here on: a file starts outside of cells
    carried = _run(
        ends, ["file"], "block",
        F.when(F.col("end.known"), F.col("end.state")),
        F.when(F.col("end.known"), 0).otherwise(F.col("end.state")),
    )
    carried = carried.withColumn("start", F.coalesce(F.lag("state").over(of_file), F.lit(0)))
    last = F.when(F.col("start") == 0, F.col("last_0")).otherwise(F.col("last_1"))
    carried = carried.withColumn("_last", last)
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("_last").isNotNull(), F.struct("block", "_last")), True).over(earlier)
    splits = carried.select(*chunk, "start", owner.alias("owner"))
    inside = splits.where("start = 1")
    # no semi join, which would move below the shuffle and so have a second one made of all lines
    heads = _pieces(lines.join(inside.select(*chunk), chunk), inside).where("own IS NULL")
    heads = heads.join(inside.select(*chunk, "owner"), chunk)
    # only the last record of a split goes on
    tails = heads.groupBy("file", F.col("owner.block").alias("block")).agg(
        F.first("owner._last").alias("_of"),
        F.array_join(F.array_sort(F.collect_list(F.struct(heads["block"], "value")))["value"], "\n").alias("_tail"),
    )
    own = _pieces(lines, splits).where("own IS NOT NULL").withColumnRenamed("own", "seq")
    tail = F.when(F.col("seq") == F.col("_of"), F.col("_tail"))
    joined = own.join(tails, chunk, "left").withColumn("value", F.concat_ws("\n", "value", tail))
    return joined.select("value", "file", _source(root), "block", "seq")


def _name(path: Column) -> Column:
    """The file's name. The path comes as in a URI; a plus sign in it is meant literally."""
    return F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def _source(root: str) -> Column:
    return _name(F.concat(F.lit(root), F.col("file"))).alias("source_file")


def _position() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    ]


def read_report(spark: SparkSession, path: str | list[str], name_filter: str | None = None) -> DataFrame:
    """Grid of one or more reports; a missing path fails.

    Files are split like any text, so one huge report is read by many tasks. A first pass looks for
    files with a cell that ends in a later line. Only their lines are shuffled, once, to be joined
    to records. `file` is what tells the paths apart: the part that they share would be a large part
    of what is shuffled and sorted.
    """
    reader = spark.read
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    lines = reader.text(path).select("value", *_position())
    broken = F.max(_opens(F.col("value"))).alias("broken")
    files = lines.groupBy("file").agg(broken, F.max("block").alias("last"))
    found = files.agg(
        F.max("broken"), F.min("broken"), F.max(F.col("broken") & (F.col("last") > 0)), F.min("file"), F.max("file")
    )
    some, every, split, *paths = found.first()
    root = commonprefix(paths) if some is not None else ""
    lines, files = (df.withColumn("file", F.substr("file", F.lit(len(root) + 1))) for df in (lines, files))
    if some and every:
        return parse_grid(whole_records(lines, root, split), "value")
    plain = lines.select("value", "file", _source(root), "block", "seq")
    if not some:
        return parse_grid(plain, "value")
    broken = files.where("broken").select("file")
    plain = plain.join(broken, "file", "left_anti")
    joined = whole_records(lines.join(broken, "file", "left_semi"), root, split)
    return parse_grid(plain.unionByName(joined), "value")


def read_reports(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """The named reports of a folder; names without a file are skipped."""
    return read_report(spark, folder, name_filter="{" + ",".join(names) + "}")

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import written
from ledgersieve.sources import balances as B, grid as G, intake as I

_folder = itertools.count()


def grid_of(spark, files):
    """``files``: name -> list of rows of cells; None leaves a gap in the row numbers."""
    rows = [(name, "Sheet1", i, [None if c == "" else c for c in cells])
            for name, lines in files.items() for i, cells in enumerate(lines, 1) if cells is not None]
    return spark.createDataFrame(rows, "source_file string, source_sheet string, row_no bigint, cells array<string>")


def formats(spark, files):
    return {r.source_file: r for r in I.file_formats(grid_of(spark, files)).collect()}


def loaded(spark, files):
    grid = grid_of(spark, files)
    return written(spark, lambda: I.parsed_lines(I.projected_lines(grid, I.file_formats(grid))))


BODY = ["2024-01-02", "Zeta", "5.00", ""]


def test_layouts(spark):
    got = formats(spark, {
        "DC_1.csv": [["Date", "Description", "Debit", "Credit", "Balance"], BODY],
        "MIO_1.csv": [["Date", "Details", "Money Out", "Money In"], BODY],
        "SIGN_1.csv": [["Posting Date", "Narrative", "Amount"], BODY],
        "TYPE_1.csv": [["Date", "Type", "Description", "Debit", "Credit"], BODY],
        "CLASH_1.csv": [["Transaction Date", "Description", "Debit", "Credit"], BODY],
        "BLANK_1.csv": [["Date", "", "Description", "Debit", "Credit"], BODY],
        "ONE_1.csv": [["Date", "Description", "Withdrawals"], BODY],
        "NONE_1.csv": [["Date", "Particulars"], BODY],
        "noheader.csv": [["just text"], ["more"]],
    })
    assert "noheader.csv" not in got
    assert {n: r.format_type for n, r in got.items()} == {
        "DC_1.csv": "debit_credit", "MIO_1.csv": "debit_credit", "SIGN_1.csv": "amount_signed",
        "TYPE_1.csv": "debit_credit", "CLASH_1.csv": "debit_credit", "BLANK_1.csv": "debit_credit",
        "ONE_1.csv": "debit_credit", "NONE_1.csv": "amount_signed"}
    assert got["DC_1.csv"]["columns"] == {"date": 0, "description": 1, "debit": 2, "credit": 3, "balance": 4}
    assert got["MIO_1.csv"]["columns"] == {"date": 0, "description": 1, "debit": 2, "credit": 3}
    assert got["SIGN_1.csv"]["columns"] == {"date": 0, "description": 1, "amount": 2}
    assert got["TYPE_1.csv"]["columns"] == {"date": 0, "type": 1, "description": 2, "debit": 3, "credit": 4}
    assert got["CLASH_1.csv"]["columns"] == {"date": 0, "description": 1, "debit": 2, "credit": 3}
    assert got["BLANK_1.csv"]["columns"] == {"date": 0, "description": 2, "debit": 3, "credit": 4}
    assert got["DC_1.csv"]["bank"] == "DC"


def test_header_rows_and_rejects(spark):
    head = ["Date", "Description", "Debit", "Credit"]
    files = {f"R{n}_x.csv": [["preamble"]] * (n - 1) + [head, BODY] for n in (1, 7, 50, 51)}
    grid = grid_of(spark, files)
    found = I.file_formats(grid)
    assert {r.source_file: r.header_row for r in found.collect()} == {"R1_x.csv": 1, "R7_x.csv": 7, "R50_x.csv": 50}
    assert [r.source_file for r in I.rejected_files(grid, found).collect()] == ["R51_x.csv"]
    name = spark.createDataFrame([("NoUnderscore.csv",)], "f string")
    assert name.select(I.bank_name(F.col("f"))).first()[0] == "NoUnderscore.csv"


def test_rows_and_counters(spark):
    parsed = loaded(spark, {
        "A_x.csv": [["Date", "Description", "Debit", "Credit"],
                    ["2024-01-02", "Zeta", "1,200.50", ""], ["", "Total", "9", ""], ["x", "no date", "9", ""],
                    ["2024-01-03", "  ", "9", ""], [], ["2024-01-04", "both", "1", "2"],
                    ["2024-01-05", "neither", "0", "text"]],
        "B_x.csv": [["Posting Date", "Narrative", "Amount"],
                    ["01/31/2024", "out", "-10"], ["01/31/2024", "in", "1 0.5"], ["01/31/2024", "zero", "0"]],
    })
    rows = I.statement_rows(parsed).orderBy("source_file", "source_row").collect()
    d = Decimal
    assert [(r.bank, r.source_row, r.date, r.description, r.debit, r.credit) for r in rows] == [
        ("A", 2, dt.date(2024, 1, 2), "Zeta", d("1200.50"), None),
        ("A", 7, dt.date(2024, 1, 4), "both", d("1.00"), d("2.00")),
        ("A", 8, dt.date(2024, 1, 5), "neither", None, None),
        ("B", 2, dt.date(2024, 1, 31), "out", d("10.00"), None),
        ("B", 3, dt.date(2024, 1, 31), "in", None, d("10.50")),
        ("B", 4, dt.date(2024, 1, 31), "zero", None, None)]
    got = {r.source_file: tuple(r)[1:] for r in I.intake_summary(parsed).collect()}
    assert got == {"A_x.csv": (3, 4, 1, 1), "B_x.csv": (3, 0, 0, 1)}


def balances(spark, files):
    grid = grid_of(spark, files)
    rows = I.statement_rows(loaded(spark, files))
    def as_map(b):
        return {r.source_file: (float(r.balance), r.ref) for r in b.collect()}
    return as_map(B.opening_balances(grid, rows)), as_map(B.closing_balances(grid, rows))


def test_balances(spark):
    head = ["Date", "Description", "Debit", "Credit"]
    day = lambda text, debit="", credit="": ["2024-01-02", text, debit, credit]
    files = {
        "A_x.csv": [["Opening balance:", "", "$1,000.50"], ["Closing Balance", "(35.00)"], head, BODY],
        "B_x.csv": [["account balance", "n/a"], ["", "Opening Balance", "0", "(20)"], head, BODY],
        "C_x.csv": [["5", "opening balance", ""], head] + [BODY] * 25 + [day("Balance forward", "7", "")],
        "D_x.csv": [head] + [BODY] * 200 + [day("ending balance", "3"), day("new balance", "", "4"), day("new balance")],
        "E_x.csv": [head, BODY, day("closing balance 31", "", "50"), ["", "x"]],
        "F_x.csv": [["Ending balance", "-$5.50"], head, BODY],
        "G_x.csv": [head] + [BODY] * 200 + [day("ending balance", "3"), day("new balance", "", "4")],
    }
    opening, closing = balances(spark, files)
    assert opening == {"A_x.csv": (1000.5, "Sheet1!C1"), "B_x.csv": (-20.0, "Sheet1!D2"), "C_x.csv": (7.0, "Sheet1!R28")}
    assert closing == {
        "A_x.csv": (-35.0, "Sheet1!B2"),
        # the label holds the first number of the row; the date beside it is no number
        "E_x.csv": (31.0, "Sheet1!B3"), "F_x.csv": (-5.5, "Sheet1!B1"), "G_x.csv": (4.0, "Sheet1!R203")}


def test_text_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "ALPHA_jan.csv").write_text(
        'Opening,10\n\nDate,Description,Debit,Credit\r\n2024-01-02,"Zeta, Inc ""X""",5.00,\n2024-01-03,,1,\n')
    (folder / "BETA.csv").write_text("Date,Details,Amount\n2024-01-04,Shop,-3\n")
    for skipped in ("merged_old.csv", "~tmp.csv", ".hidden.csv", "notes.pdf"):
        (folder / skipped).write_text("Date,Details,Amount\n2024-01-04,Shop,-3\n")
    grid = G.read_grid(spark, str(folder), width=5)
    got = grid.orderBy("source_file", "row_no").collect()
    assert [(r.source_file, r.row_no) for r in got] == \
        [("ALPHA_jan.csv", i) for i in range(1, 6)] + [("BETA.csv", 1), ("BETA.csv", 2)]
    assert got[3].cells == ["2024-01-02", 'Zeta, Inc "X"', "5.00", None, None] and got[1].cells == [None] * 5
    rows = I.statement_rows(I.parsed_lines(I.projected_lines(grid, I.file_formats(grid)))).collect()
    assert sorted((r.bank, r.source_row, r.description) for r in rows) == [
        ("ALPHA", 4, 'Zeta, Inc "X"'), ("BETA.csv", 2, "Shop")]


@pytest.mark.parametrize("split_bytes", ["700", "4096", "1000000"])
def test_row_numbers_over_many_splits(spark, tmp_path, split_bytes):
    """A file read by many tasks, and many files in one task, get the same numbers."""
    folder = tmp_path / f"in{next(_folder)}"
    folder.mkdir()
    for name, n in (("A_big.csv", 900), ("B_small.csv", 3), ("C_mid.csv", 120)):
        (folder / name).write_text("".join(f"{name},{i},{'x' * (i % 37)}\n" for i in range(1, n + 1)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        grid = G.read_grid(spark, str(folder), width=3)
        bad = grid.filter(F.get("cells", F.lit(1)).cast("bigint") != F.col("row_no")).count()
        assert bad == 0 and grid.count() == 1023
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_first_sheet_and_merge(spark):
    grid = spark.createDataFrame(
        [("f", "S2", 1, ["a"]), ("f", "S1", 1, ["b"])],
        "source_file string, source_sheet string, row_no bigint, cells array<string>")
    sheets = spark.createDataFrame([("f", "S1", 2), ("f", "S2", 1)], "source_file string, source_sheet string, position int")
    assert [r.cells for r in G.first_sheet(grid, sheets).collect()] == [["a"]]
    merged = I.merge_layouts([spark.range(1).selectExpr("id a", "1 b"), spark.range(1).selectExpr("2 b", "3 c")])
    assert merged.columns == ["a", "b", "c"] and merged.count() == 2


def test_splits_may_change_between_scans_and_wide_lines_are_whole(spark, tmp_path):
    """The grid is built under one split setting and read under another."""
    folder = tmp_path / "wide"
    folder.mkdir()
    (folder / "A_wide.csv").write_text("".join(",".join(f"{i}.{c}" for c in range(40)) + "\n" for i in range(1, 800)))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    try:
        for name, value in zip(names, ("20000", "10", "7")):
            spark.conf.set(name, value)
        grid = G.read_grid(spark, str(folder))
        for name, value in zip(names, ("3000", "10", "2")):
            spark.conf.set(name, value)
        assert grid.count() == 799
        wrong = F.get("cells", F.lit(39)) != F.concat(F.col("row_no").cast("string"), F.lit(".39"))
        assert grid.filter(wrong | (F.size("cells") != 40)).count() == 0
    finally:
        for name in names:
            spark.conf.unset(name)


def test_cells_of_a_line(spark):
    lines = ['a,b', ',a,,', '"x, y","say ""hi""",z', '"",b', '"open,b', 'a;b', '', '"a"b,c']
    got = spark.createDataFrame([(x,) for x in lines], "v string").select(G.split_cells(F.col("v"))).collect()
    assert [r[0] for r in got] == [["a", "b"], [None, "a", None, None], ["x, y", 'say "hi"', "z"], [None, "b"], ['"open', "b"],
                                   ["a;b"], [None], ['"a"b', "c"]]


def test_words_dates_and_categories_can_be_passed_in(spark):
    from dataclasses import replace

    from ledgersieve import config as C
    from ledgersieve.plans.consolidate import consolidate

    rules = replace(
        C.INTAKE, date_words=("datum",), description_words=("tekst",), amount_words=("beloeb",), amount_markers=("beloeb",),
        opening_words=("primo",), date_formats=((r"^\d{1,2}~\d{1,2}~\d{4}$", "d~M~yyyy"),), category_phrases=(("Cakes", ("kage",)),))
    grid = grid_of(spark, {"A_x.csv": [["primo", "100.00"], ["Datum", "Tekst", "Beloeb"], ["3~1~2024", "kage", "-5"], ["2024-01-04", "kage", "-6"]]})
    run = consolidate(spark, grid, "danish", rules=rules)
    assert [(r.date, r.debit, r.operation_type) for r in run.transactions.collect()] == [(dt.date(2024, 1, 3), Decimal("5.00"), "Cakes")]
    assert [float(r.balance) for r in run.opening.collect()] == [100.0]
    assert {(r.reason, r.example) for r in run.rejects.collect()} == {("above the table", None), ("unread date", "2024-01-04")}
    assert consolidate(spark, grid, "english").transactions.count() == 0

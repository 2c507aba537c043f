"""Layout detection and projection of statement grids to canonical transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgersieve import config as C
from ledgersieve.functions.classify import classify
from ledgersieve.functions.text import (
    clean_description, inflow_part, normalize_vendor, outflow_part, parse_amount, parse_date,
    signed_amount, strip, zero_to_null,
)
from ledgersieve.sources.grid import EXAMPLE, remark

FILE_KEYS = ["source_file", "source_sheet"]


def bank_name(source_file: Column) -> Column:
    """File name, without its folder, up to the first underscore; the whole name if there is none."""
    return F.substring_index(F.substring_index(source_file, "/", -1), "_", 1)


def _says(text: Column, words) -> Column:
    return text.rlike("|".join(words))


def header_rows(grid: DataFrame, rules: C.IntakeConfig = C.INTAKE) -> DataFrame:
    """First of the leading rows that names a date and a description, per file."""
    text = F.lower(F.array_join("cells", " | "))
    return (
        grid.filter(F.col("row_no") <= rules.header_scan_rows).withColumn("header_text", text)
        .filter(_says(F.col("header_text"), rules.date_words) & _says(F.col("header_text"), rules.description_words))
        .groupBy(*FILE_KEYS).agg(
            F.min("row_no").alias("header_row"), F.min_by("cells", "row_no").alias("header_cells"),
            F.min_by("header_text", "row_no").alias("header_text"))
    )


def layout_type(header_text: Column, rules: C.IntakeConfig = C.INTAKE) -> Column:
    debit, credit = _says(header_text, rules.debit_markers), _says(header_text, rules.credit_markers)
    return (
        F.when(debit & credit, "debit_credit")
        .when(_says(header_text, rules.amount_markers) & ~debit, "amount_signed")
        .when(debit | credit, "debit_credit").otherwise("amount_signed")
    )


def _column_of(words, *taken: str) -> Column:
    """Position of the first header cell with one of the words that has no role yet."""
    def fits(i):
        free = F.lower(strip(F.get("header_cells", i))).rlike("|".join(words))
        for role in taken:
            free = free & ~i.eqNullSafe(F.col(role))
        return free
    positions = F.sequence(F.lit(0), F.size("header_cells") - 1)
    return F.get(F.filter(positions, fits), F.lit(0))


def file_formats(grid: DataFrame, rules: C.IntakeConfig = C.INTAKE) -> DataFrame:
    """One row per recognised file: bank, header row, layout and role-to-column map.

    A column has one role; roles are given in the order date, description, balance,
    debit, credit, amount, type.
    """
    separate = F.col("format_type") == "debit_credit"
    shared = ("_date", "_description", "_balance")
    found = (
        header_rows(grid, rules)
        .withColumn("format_type", layout_type(F.col("header_text"), rules))
        .withColumn("_date", _column_of(rules.date_words))
        .withColumn("_description", _column_of(rules.description_words, "_date"))
        .withColumn("_balance", _column_of(rules.balance_words, "_date", "_description"))
        .withColumn("_debit", F.when(separate, _column_of(rules.debit_words, *shared)))
        .withColumn("_credit", F.when(separate, _column_of(rules.credit_words, *shared, "_debit")))
        .withColumn("_amount", F.when(~separate, _column_of(rules.amount_words, *shared)))
        .withColumn("_type", _column_of(rules.type_words, *shared, "_debit", "_credit", "_amount"))
    )
    roles = ("date", "description", "balance", "debit", "credit", "amount", "type")
    mapping = F.create_map(*[x for r in roles for x in (F.lit(r), F.col(f"_{r}").cast("int"))])
    return found.select(
        *FILE_KEYS, bank_name(F.col("source_file")).alias("bank"), "header_row", "format_type",
        F.map_filter(mapping, lambda _, v: v.isNotNull()).alias("columns"))


NO_HEADER = f"no header in rows 1-{C.HEADER_SCAN_ROWS}"
ABOVE, NO_AMOUNT, NOTHING = "above the table", "no amount column", "no line parsed"
NO_DATE, UNREAD_DATE, NO_DESCRIPTION = "no date", "unread date", "no description"


def rejected_files(grid: DataFrame, formats: DataFrame) -> DataFrame:
    """Files in which no header was found."""
    return (
        grid.select(*FILE_KEYS).distinct().join(formats, FILE_KEYS, "left_anti")
        .withColumn("reason", F.lit(NO_HEADER))
    )


def headless_files(rejects: DataFrame) -> DataFrame:
    """The same from the reject table."""
    return rejects.where(F.col("reason") == NO_HEADER).select(*FILE_KEYS, "reason")


def rejects(grid: DataFrame, leading: DataFrame, formats: DataFrame, lines: DataFrame, remarks: DataFrame | None = None) -> DataFrame:
    """Why lines are no transactions: one row per file and reason.

    ``lines`` counts the lines concerned, from ``first_row`` to ``last_row``; ``lost`` those
    of them that are left out for this reason, so that kept and lost lines of a file
    are all its lines; ``example`` is what the first of them has in the column at fault.
    ``remarks`` come from reading the files.  Rows and texts of ``lines`` are a written
    table's; only counts per file are shuffled.
    """
    def summed(rows: DataFrame, reason: Column, row_no: str, example: Column) -> DataFrame:
        return rows.groupBy(*FILE_KEYS, reason.alias("reason")).agg(
            F.min(row_no).cast("long").alias("first_row"), F.max(row_no).cast("long").alias("last_row"), F.count(F.lit(1)).alias("lines"),
            F.count(F.lit(1)).alias("lost"), F.min_by(example, row_no).alias("example"))

    none = F.lit(None)
    headless = grid.select(*FILE_KEYS, "row_no", F.get("cells", F.lit(0)).alias("cell")).join(formats.select(*FILE_KEYS), FILE_KEYS, "left_anti")
    above = leading.select(*FILE_KEYS, "row_no").join(formats.select(*FILE_KEYS, "header_row"), FILE_KEYS).where("row_no <= header_row")
    parts = [
        summed(headless, F.lit(NO_HEADER), "row_no", F.col("cell")),
        summed(above, F.lit(ABOVE), "row_no", none.cast("string")),
        summed(lines.where("reason is not null").select(*FILE_KEYS, "reason", "source_row", "unread"), F.col("reason"), "source_row", F.col("unread"))]
    amounts = F.coalesce(*[F.col("columns")[r] for r in ("debit", "credit", "amount")])
    head = F.col("header_row")
    parts.append(formats.where(amounts.isNull()).select(*FILE_KEYS, *remark(NO_AMOUNT, head, head, F.lit(1), none)))
    kept = lines.where("is_transaction").select(*FILE_KEYS).distinct()
    parts.append(formats.join(kept, FILE_KEYS, "left_anti").select(*FILE_KEYS, *remark(NOTHING, none, none, F.lit(0), none)))
    if remarks is not None:
        parts.append(remarks)
    return reduce(DataFrame.unionByName, parts)


def line_balance(grid: DataFrame, lines: DataFrame, rejects: DataFrame) -> DataFrame:
    """Per file: all lines, kept and lost ones, and whether they add up."""
    counted = grid.groupBy(*FILE_KEYS).agg(F.count(F.lit(1)).alias("lines"))
    kept = lines.where("is_transaction").groupBy(*FILE_KEYS).agg(F.count(F.lit(1)).alias("kept"))
    lost = rejects.groupBy(*FILE_KEYS).agg(F.sum("lost").alias("lost"))
    found = counted.join(kept, FILE_KEYS, "full").join(lost, FILE_KEYS, "full")
    found = found.select(*FILE_KEYS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "kept", "lost")])
    return found.withColumn("balanced", F.col("lines") == F.col("kept") + F.col("lost"))


def projected_lines(grid: DataFrame, formats: DataFrame) -> DataFrame:
    """Lines below the header, with the text of each role.

    ``formats`` has one row per file.  Written before use, its size is known and
    the planner sends it to all tasks or, beyond its limit, shuffles both sides;
    a file with most of the rows is then split by the adaptive skew join.
    """
    cell = lambda role: F.get("cells", F.col("columns")[role])
    roles = ("date", "description", "debit", "credit", "amount", "type")
    return grid.join(formats, FILE_KEYS).filter(F.col("row_no") > F.col("header_row")).select(
        *FILE_KEYS, "bank", "format_type", F.col("row_no").alias("source_row"),
        *[cell(r).alias(f"{r}_text") for r in roles])


def parsed_lines(lines: DataFrame, rules: C.IntakeConfig = C.INTAKE) -> DataFrame:
    """Typed values per line, ``is_transaction`` and else the ``reason``; nothing is dropped yet."""
    signed = parse_amount(F.col("amount_text"))
    by_sign = F.col("format_type") == "amount_signed"
    date = parse_date(F.col("date_text"), rules.date_formats)
    blank = F.coalesce(strip(F.col("description_text")), F.lit("")) == ""
    undated = F.coalesce(strip(F.col("date_text")), F.lit("")) == ""
    reason = F.when(undated, NO_DATE).when(F.col("date").isNull(), UNREAD_DATE).when(blank, NO_DESCRIPTION)
    return (
        lines.withColumn("date", date).withColumn("signed", signed)
        .withColumn("debit", zero_to_null(
            F.when(by_sign, outflow_part(F.col("signed"))).otherwise(parse_amount(F.col("debit_text")))))
        .withColumn("credit", zero_to_null(
            F.when(by_sign, inflow_part(F.col("signed"))).otherwise(parse_amount(F.col("credit_text")))))
        .withColumn("is_transaction", F.col("date").isNotNull() & ~blank)
        .withColumn("reason", F.when(~F.col("is_transaction"), reason))
        .withColumn("unread", F.when(F.col("reason") == UNREAD_DATE, F.left("date_text", F.lit(EXAMPLE))))
        .withColumnsRenamed({"description_text": "description", "type_text": "type_original"})
        .drop("signed", "date_text", "debit_text", "credit_text", "amount_text")
    )


def statement_rows(parsed: DataFrame) -> DataFrame:
    """Only transactions: a readable date and a description."""
    return parsed.filter("is_transaction").drop("is_transaction", "format_type", "reason", "unread")


def enriched(rows: DataFrame, rules: C.IntakeConfig = C.INTAKE) -> DataFrame:
    """Cleaned description, vendor, category, direction and signed amount."""
    described = rows.withColumn("description_clean", clean_description(F.col("description")))
    return (
        classify(described, rules=rules.category_phrases)
        .withColumn("vendor_normalized", normalize_vendor(F.col("description_clean")))
        .withColumn("amount_signed", signed_amount(F.col("debit"), F.col("credit")))
    )


def line_figures() -> dict[str, Column]:
    """Kept and removed lines, and kept lines with both or neither side filled."""
    debit, credit, kept = F.col("debit").isNotNull(), F.col("credit").isNotNull(), F.col("is_transaction")
    return {
        "kept": F.count_if(kept), "removed": F.count_if(~kept),
        "both_filled": F.count_if(kept & debit & credit), "neither_filled": F.count_if(kept & ~debit & ~credit)}


def intake_summary(parsed: DataFrame) -> DataFrame:
    """:func:`line_figures` per file; the totals of a run are observed while its lines are written."""
    return parsed.groupBy("source_file").agg(*[c.alias(name) for name, c in line_figures().items()])


def merge_layouts(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column a layout lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_rows(transactions: DataFrame) -> DataFrame:
    """The first transaction of every file, as a sample for the audit trail."""
    firsts = transactions.groupBy("source_file").agg(F.min("txn_seq").alias("txn_seq"))
    return transactions.join(firsts.select("txn_seq"), "txn_seq", "left_semi").select(
        "source_file", "source_sheet", "source_row", "txn_id")

"""Text, vendor and value expressions.  Every function maps columns to a column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgersieve import config as C
from ledgersieve.schema import MONEY

WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


# Spaces beyond ASCII: exports often hold the no-break space.
WIDE_SPACES = "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def plain_spaces(text: Column) -> Column:
    """Every white-space character beyond ASCII as a plain space; a text with fewer signs than bytes has others than ASCII."""
    wide = F.translate(text, WIDE_SPACES, " " * len(WIDE_SPACES))
    return F.when(F.octet_length(text) != F.char_length(text), wide).otherwise(text)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` only removes spaces)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def odd_spaces(text: Column) -> Column:
    """Whether white space (``\\s``) is anything but single plain spaces; a search for a few signs costs far less than a pattern."""
    found = text.contains("  ")
    for sign in "\t\n\x0b\f\r":
        found = found | text.contains(sign)
    return found


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space; single spaces are left alone."""
    return with_value(text, lambda t: F.when(odd_spaces(t), F.regexp_replace(t, r"\s{2,}|[^\S ]", " ")).otherwise(t))


def with_value(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once a row however often it is used.

    Spark repeats an expression that only some branches of a condition need.  The lambda
    also keeps long conditions out of the stage's one generated method, which the JVM no longer
    compiles beyond 8,000 bytes.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def prefixes_in_order(patterns) -> str:
    """One expression that removes each anchored prefix at most once, in the given order."""
    return "(?i)^" + "".join(f"(?:{p.removeprefix('^')})?" for p in patterns)


def clean_description(text: Column) -> Column:
    """Drop payment-rail prefixes and a trailing reference; blank text stays as it is.

    A prefix ends with white space and a reference starts with it, so something
    is always left of a text that is not blank.
    """
    def cleaned(bare: Column) -> Column:
        without = F.regexp_replace(bare, prefixes_in_order(C.DESCRIPTION_PREFIXES), "")
        without = F.regexp_replace(without, "(?i)" + C.DESCRIPTION_REFERENCE, "")
        return F.when(bare == "", text).otherwise(strip(collapse_spaces(without)))

    return with_value(strip(plain_spaces(text)), cleaned)


def normalize_vendor(text: Column) -> Column:
    """Upper-case vendor key without rails, references, company forms and punctuation."""
    def key(bare: Column) -> Column:
        vendor = F.regexp_replace(F.upper(bare), prefixes_in_order(C.VENDOR_PREFIXES), "")
        vendor = F.regexp_replace(vendor, C.VENDOR_REFERENCE, "")
        vendor = F.regexp_replace(vendor, C.VENDOR_COMPANY_WORDS, "")
        vendor = F.translate(vendor, C.VENDOR_PUNCTUATION, "")
        return F.when(bare == "", text).otherwise(strip(collapse_spaces(vendor)))

    return with_value(strip(plain_spaces(text)), key)


def _or_unknown(*candidates: Column) -> Column:
    filled = [F.nullif(strip(c), F.lit("")) for c in candidates]
    return F.coalesce(*filled, F.lit(C.UNKNOWN_VENDOR))


def screening_vendor(columns) -> Column:
    """Vendor key of the screening rules: the first *present* text column, blank is UNKNOWN."""
    for name in ("vendor_normalized", "description_clean", "description"):
        if name in columns:
            return _or_unknown(F.col(name))
    return F.lit(C.UNKNOWN_VENDOR)


def concentration_vendor(columns) -> Column:
    """Vendor key of the concentration table: a blank vendor falls back to the description."""
    key = [c for c in ("vendor_normalized", "description_clean", "description") if c in columns][:1]
    fallback = [c for c in ("description_clean", "description") if c in columns][:1]
    return _or_unknown(*[F.col(c) for c in key + fallback])


def source_pointer(source_file: Column, source_sheet: Column, source_row: Column) -> Column:
    return F.concat(
        F.coalesce(source_file, F.lit("?")), F.lit(" | "),
        F.coalesce(source_sheet, F.lit("?")), F.lit(" | R"),
        F.coalesce(source_row.cast("string"), F.lit("?")),
    )


def contains_any(text: Column, words) -> Column:
    """True if the lower-cased text contains one of the words; null text is False."""
    return F.coalesce(F.lower(text).rlike("|".join(words)), F.lit(False))


def money_text(amount: Column, decimals: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, decimals))


def month_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def parse_date(text: Column, formats: tuple = C.DATE_FORMATS) -> Column:
    """Text to date over the configured formats; anything else is null, never an error."""
    def read(day: Column) -> Column:
        attempts = [F.when(day.rlike(shape), F.try_to_timestamp(day, F.lit(fmt))) for shape, fmt in formats]
        for shape, (d, m, y) in C.MONTH_NAME_DATES:
            part = lambda i: F.regexp_extract(day, shape, i)  # noqa: B023, E731
            year = F.when(F.length(part(y)) == 2, F.concat(F.lit("20"), part(y))).otherwise(part(y))
            named = F.concat_ws(" ", part(d), F.initcap(F.substring(part(m), 1, 3)), year)
            attempts.append(F.when(day.rlike(shape), F.try_to_timestamp(named, F.lit("d MMM yyyy"))))
        return F.coalesce(*attempts).cast("date")

    # The bare day is made once a row, not once a format.
    return with_value(F.regexp_replace(F.regexp_replace(strip(plain_spaces(text)), C.TIME_OF_DAY, ""), C.DAY_OF_WEEK, ""), read)


def parse_amount(text: Column) -> Column:
    """Text to money: spaces and commas dropped, anything not numeric is null."""
    return F.translate(text, " ,", "").try_cast(MONEY)


def zero_to_null(amount: Column) -> Column:
    return F.nullif(amount, F.lit(0).cast(MONEY))


def outflow_part(signed: Column) -> Column:
    return F.when(signed < 0, F.abs(signed)).cast(MONEY)


def inflow_part(signed: Column) -> Column:
    return F.when(signed > 0, signed).cast(MONEY)


def signed_amount(debit: Column, credit: Column) -> Column:
    zero = F.lit(0).cast(MONEY)
    return (F.coalesce(credit, zero) - F.coalesce(debit, zero)).cast("decimal(19,2)")


def column_letter(position: Column) -> Column:
    """0-based column position to its spreadsheet letters (up to three, 18,278 columns)."""
    letter = lambda n: F.char((n % 26).cast("int") + F.lit(65))
    at = position.cast("int")
    second, third = F.floor(at / 26 - 1), F.floor((at - 702) / 676)
    return F.concat(
        F.when(at >= 702, letter(third)).otherwise(F.lit("")),
        F.when(at >= 26, letter(second)).otherwise(F.lit("")), letter(at))

"""Explainable keyword classification and flow direction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgersieve import config as C
from ledgersieve.functions.text import contains_any, odd_spaces, plain_spaces, with_value


def keyword_category(
    description: Column, transaction_type: Column | None = None, rules=C.CATEGORY_PHRASES
) -> Column:
    """First category with a phrase in the lower-cased description (plus the type, if given).

    The text is made once a row, with single spaces.  A phrase without signs of a pattern
    is then searched as it is; the few others stay patterns.
    """
    text = F.lower(plain_spaces(description))
    if transaction_type is not None:
        text = F.when(description.isNotNull(), F.concat_ws(" ", text, F.nullif(F.lower(transaction_type), F.lit(""))))

    def found(text: Column) -> Column:
        spaced = F.when(odd_spaces(text), F.regexp_replace(text, r"\s+", " ")).otherwise(text)
        return with_value(spaced, lambda t: first_rule(t, text))

    def first_rule(spaced: Column, text: Column) -> Column:
        category = None
        for name, phrases in rules:
            plain = [p for p in phrases if not C.PATTERN_SIGNS.search(p)]
            others = [p for p in phrases if C.PATTERN_SIGNS.search(p)]
            hits = [F.exists(F.array(*map(F.lit, plain)), lambda p: spaced.contains(p))] if plain else []
            hits += [text.rlike(C.phrase_pattern(others))] if others else []
            hit = reduce(lambda a, b: a | b, hits)
            category = F.when(hit, F.lit(name)) if category is None else category.when(hit, F.lit(name))
        return F.lit(C.OTHER_CATEGORY) if category is None else category.otherwise(F.lit(C.OTHER_CATEGORY))

    return with_value(text, found)


def corrected_category(
    category: Column, description_clean: Column, debit: Column, credit: Column
) -> Column:
    """Corrections that look at the side of the payment and the cleaned description.

    No correction produces a category that a later one starts from, except the two
    that turn inventory receipts into customer payments, after the customer-payment
    corrections are over; so one ordered CASE gives the same result as applying
    them one after the other.
    """
    says = lambda words: contains_any(description_clean, words)
    out, into = debit > 0, credit > 0
    customer = category == "Customer Payments"
    inventory = category == "Inventory & Suppliers"
    card = category == "Card Processing"
    return (
        F.when(customer & says(C.FIX_TAX_WORDS), F.lit("Taxes & Government"))
        .when(customer & says(C.FIX_OUTWARD_WORDS), F.lit("Vendor Payments"))
        .when(customer & out & says(C.FIX_RETAIL_WORDS), F.lit("Vendor Payments"))
        .when(inventory & into & says(C.FIX_CUSTOMER_WORDS), F.lit("Customer Payments"))
        .when(card & into & says(C.FIX_SETTLEMENT_WORDS), F.lit("Card Settlement (Income)"))
        .when(card & out & says(C.FIX_FEE_WORDS), F.lit("Card Fees"))
        .otherwise(category)
    )


def flow_direction(debit: Column, credit: Column) -> Column:
    return F.when(credit > 0, F.lit("Inflow")).when(debit > 0, F.lit("Outflow")).otherwise(F.lit("Unknown"))


def classify(transactions: DataFrame, transaction_type: str | None = None, rules=C.CATEGORY_PHRASES) -> DataFrame:
    """Add ``operation_type`` and ``direction`` to rows with description, debit and credit."""
    type_column = F.col(transaction_type) if transaction_type else None
    return (
        transactions
        .withColumn("keyword_category", keyword_category(F.col("description"), type_column, rules))
        .withColumn("operation_type", corrected_category(
            F.col("keyword_category"), F.col("description_clean"), F.col("debit"), F.col("credit")))
        .withColumn("direction", flow_direction(F.col("debit"), F.col("credit")))
        .drop("keyword_category")
    )

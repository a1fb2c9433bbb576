"""Validation rules; one pass over the rows, one issue per rule and row.

Issue types are the source system's; the texts of what was expected are the library's own wording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.money import savings_ok
from shelfwise.functions.text import number, pick

NULL_VALUE, FORMAT_ISSUE, OUTLIER = "NULL_VALUE", "FORMAT_ISSUE", "OUTLIER"
KINDS = [NULL_VALUE, FORMAT_ISSUE, OUTLIER]


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)) == "", F.lit(True))


def _none(c: str) -> Column:
    return F.lower(F.trim(F.col(c))) == "none"


# A rule is a list of checks in order: (failed, issue type, what was expected).
Checks = list[tuple[Column, str, str]]


def check_item(field: str = "item") -> Checks:
    low = F.lower(F.col(field))
    letters = F.regexp_replace(F.replace(low, F.lit("inch"), F.lit("")), r"[^\p{L}]", "")
    return [
        (_blank(field), NULL_VALUE, "Should have item value"),
        (F.lower(F.col(field)) == "none", NULL_VALUE, 'Item should not be "none"'),
        (low.contains("inch") & (F.length(letters) < 2), FORMAT_ISSUE, 'Should include model name or "TV"'),
    ]


def check_price(field: str) -> Checks:
    text = F.trim(F.col(field))
    value = number(F.regexp_replace(text, r"[$,]", ""), "double")
    return [
        (_blank(field), NULL_VALUE, "Should have price value"),
        (_none(field), NULL_VALUE, 'Price should not be "none"'),
        (~text.startswith("$"), FORMAT_ISSUE, "Should start with $"),
        (value.isNull(), FORMAT_ISSUE, "Cannot parse price value"),
        (value <= 0, OUTLIER, "Price should be greater than $0"),
        (value > 50000, OUTLIER, "Price seems unusually high (> $50,000)"),
    ]


def check_screen_size(field: str = "screen_size") -> Checks:
    size = pick(field, r"(\d+)", 1).try_cast("bigint")
    return [
        (_blank(field), NULL_VALUE, "Should have screen size"),
        (~F.lower(F.col(field)).contains("inch"), FORMAT_ISSUE, 'Should include "inch"'),
        (size.isNull(), FORMAT_ISSUE, "Cannot extract size number"),
        (~size.between(20, 100), OUTLIER, "Screen size seems unusual (expected 20-100 inch)"),
    ]


def check_count(field: str) -> Checks:
    optional = ~_blank(field) & (F.lower(F.col(field)) != "none")
    value = F.regexp_replace(F.trim(F.col(field)), ",", "").try_cast("bigint")
    return [
        (optional & value.isNull(), FORMAT_ISSUE, "Should be numeric"),
        (optional & (value < 0), OUTLIER, "Count should not be negative"),
    ]


def check_rating(field: str = "star_rating") -> Checks:
    optional = ~_blank(field) & (F.lower(F.col(field)) != "none")
    value = number(F.trim(F.col(field)), "double")
    return [
        (optional & value.isNull(), FORMAT_ISSUE, "Should be numeric (0-5)"),
        (optional & ~value.between(0, 5), OUTLIER, "Rating should be between 0 and 5"),
    ]


# Rule per field name; fields a table does not have are not checked.
CHECKS = {
    "item": check_item,
    "final_sku_price": check_price,
    "original_sku_price": check_price,
    "savings": check_price,
    "screen_size": check_screen_size,
    "count_of_reviews": check_count,
    "star_rating": check_rating,
}
# Checked only where a value is present.
OPTIONAL = {"original_sku_price", "savings"}


def issues(df: DataFrame, source: str, keys: list[str], checks: dict | None = None, optional: set | None = None) -> DataFrame:
    """Issue log: one row per failed rule with the row's keys and the source name.

    The first failing check of a rule counts. Each rule becomes a number (which check failed), the
    numbers are stacked to rows, and type and expectation are looked up for the failures only.
    """
    checks = CHECKS if checks is None else checks
    optional = OPTIONAL if optional is None else optional
    kinds, expected, numbers, stacked = [], [], {}, []
    for name in [c for c in checks if c in df.columns]:
        first = None
        for failed, kind, text in checks[name](name):
            this = F.lit(len(kinds))
            first = F.when(failed, this) if first is None else first.when(failed, this)
            kinds.append(F.lit(kind))
            expected.append(F.lit(text))
        if name in optional:
            first = F.when(F.col(name) != "", first)
        numbers[f"_{name}"] = first
        stacked += [F.lit(name), F.col(name).cast("string"), F.col(f"_{name}")]
    if not numbers:
        raise ValueError("the table has none of the checked fields")
    rows = df.withColumns(numbers).select(
        *keys, F.stack(F.lit(len(numbers)), *stacked).alias("field", "value", "_number")
    )
    return rows.where(F.col("_number").isNotNull()).select(
        F.lit(source).alias("source"), *keys, "field", "value",
        F.get(F.array(*kinds), F.col("_number")).alias("issue_type"),
        F.get(F.array(*expected), F.col("_number")).alias("expected"),
    )


def issue_summary(log: DataFrame, total: bool = False) -> DataFrame:
    """Issues per type, and with ``total`` a row of type NULL with all of them."""
    if total:
        return log.rollup("issue_type").agg(F.count(F.lit(1)).alias("issues"))
    return log.groupBy("issue_type").agg(F.count(F.lit(1)).alias("issues"))


def savings_issues(df: DataFrame, final: str, original: str, saved: str) -> DataFrame:
    """Rows whose stated savings do not match the prices."""
    return df.where(~savings_ok(final, original, saved))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")

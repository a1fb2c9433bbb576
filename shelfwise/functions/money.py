"""Dollar prices, savings and money display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import blank_to_null, col, number, pick, squeeze

PRICE = "decimal(12,2)"


def us_price(c: Column | str) -> Column:
    """'Now $238.00' -> '$238.00'."""
    return pick(c, r"\$[\d,]+\.?\d*")


def repair_price(c: Column | str, loose: bool = False) -> Column:
    """'$1,797 99' -> '$1797.99'; other text comes back with white space collapsed.

    White space between dollars and cents is required. ``loose`` makes it optional, as in
    the source scripts, where '$238.00' then reads as '$2.38'.
    """
    text = squeeze(c)
    pattern = r"\$\s*(\d[\d,]*)\s" + ("*" if loose else "+") + r"(\d{2})"
    dollars = F.replace(pick(text, pattern, 1), F.lit(","), F.lit(""))
    return F.coalesce(
        F.concat(F.lit("$"), dollars, F.lit("."), pick(text, pattern, 2)), blank_to_null(text)
    )


def price_number(c: Column | str) -> Column:
    """First number in a price text, '$' and ',' ignored, as a decimal."""
    return pick(F.regexp_replace(col(c), r"[$,]", ""), r"\d+\.?\d*").try_cast(PRICE)


def savings_amount(c: Column | str) -> Column:
    """'Save $1,200' -> '$1,200'."""
    return pick(c, r"\$[\d,]+(?:\.\d{2})?")


def savings(final: Column | str, original: Column | str) -> Column:
    """original - final as '$30.00', only where positive."""
    diff = (price_number(original) - price_number(final)).cast(PRICE)
    return F.when(diff > 0, F.concat(F.lit("$"), diff.cast("string")))


def savings_ok(final: Column | str, original: Column | str, saved: Column | str) -> Column:
    """True where original - final = savings; a missing value passes, unreadable text fails."""
    exact = lambda c: number(F.regexp_replace(col(c), r"[$,]", ""), "decimal(18,4)")
    missing = (
        blank_to_null(final).isNull() | blank_to_null(original).isNull() | blank_to_null(saved).isNull()
    )
    close = F.abs(exact(original) - exact(final) - exact(saved)) < F.lit("0.01").cast("decimal(18,4)")
    return missing | F.coalesce(close, F.lit(False))


def money(c: Column | str) -> Column:
    """Thousands separators; no decimals where the amount is whole."""
    value = col(c).cast("decimal(18,2)")
    return F.when(value == F.floor(value), F.format_number(value, 0)).otherwise(F.format_number(value, 2))


def range_gate(price: Column | str, lo: float = 1, hi: float = 50000) -> Column:
    """Price inside lo..hi, else NULL."""
    return F.when(col(price).between(lo, hi), col(price))


def null_if_no_seller(price: Column | str, ships: Column | str, sold: Column | str) -> Column:
    """NULL the price where both the shipper and the seller are blank."""
    has_one = first_present(ships) | first_present(sold)
    return F.when(has_one, col(price))


def first_present(c: Column | str) -> Column:
    return F.coalesce(F.trim(col(c)) != "", F.lit(False))


def outcome(price: Column | str, title: Column | str) -> Column:
    """'no price and title' / 'no price' / 'ok'."""
    return (
        F.when(col(price).isNull() & col(title).isNull(), F.lit("no price and title"))
        .when(col(price).isNull(), F.lit("no price"))
        .otherwise(F.lit("ok"))
    )

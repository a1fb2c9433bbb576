"""Model numbers from specification fields, URLs and product names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import blank_to_null, col, let, pick

# Texts that are never a model number.
GENERIC_MODELS = [
    "4K UHD", "4K (2160P)", "3840 x 2160", "1920 x 1080", "1080p", "1080i", "720p", "480p", "480i",
    "Samsung", "Hisense",
]
# Interface phrases that show a field was read from the wrong place.
UI_PHRASES = [
    "skip to main", "sign in", "pickup", "delivery", "department", "close", "nits", "1080p", "4k", "hz",
]

RESOLUTION = r"(?i)^\d{3,4}[ip]$"
REFRESH_RATE = r"(?i)^\d+Hz$"


def _mixed(x: Column) -> Column:
    """Text with at least one letter and one digit."""
    return x.rlike(r"\p{L}") & x.rlike(r"\p{Nd}")


def is_invalid_model(c: Column | str) -> Column:
    """True for blank, generic, refresh-rate and resolution texts."""
    text = F.trim(col(c))
    bad = (
        (text == "")
        | text.isin(GENERIC_MODELS)
        | text.contains(";")
        | text.rlike(REFRESH_RATE)
        | text.rlike(r"(?i)\d{1,3}(,\d{3})?\s*x\s*\d{1,3}(,\d{3})?")
        | text.rlike(RESOLUTION)
        | text.rlike(r"\(\d+[ip]\)")
    )
    return F.coalesce(bad, F.lit(True))


def model_from_url(url: Column | str, strict: bool = False) -> Column:
    """Model number from the product part of an /ip/ URL path.

    The longest hyphen token with letters and digits wins, joined with a following number of two
    to four digits. ``strict`` follows the worked examples instead of the coded rule: no joining of
    inch sizes and years, resolutions and remote-control numbers never win, and a closing
    one-letter suffix is kept.
    """
    path = F.split(F.trim(pick(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), F.lit("/")), "/")
    at = lambda arr, i: F.coalesce(F.get(arr, i), F.lit(""))

    def candidate(tokens: Column, token: Column, i: Column) -> Column:
        following = at(tokens, i + F.lit(1))
        joins = following.rlike(r"^\d{2,4}$")
        wanted = _mixed(token) & (F.length(token) >= 5)
        if strict:
            joins = joins & ~following.rlike(r"^(19|20)\d{2}$") & (F.lower(at(tokens, i + F.lit(2))) != "inch")
            joins = joins | (following.rlike(r"^[A-Z]$") & (i + F.lit(2) == F.size(tokens)))
            wanted = wanted & ~token.rlike(RESOLUTION) & ~token.rlike(REFRESH_RATE)
            wanted = wanted & (F.lower(following) != "remote")
        return F.when(wanted, F.when(joins, F.concat(token, F.lit("-"), following)).otherwise(token))

    def choose(parts: Column) -> Column:
        tokens, last = F.split(F.get(parts, F.lit(1)), "-"), F.substring_index(F.get(parts, F.lit(1)), "-", -1)
        whole = F.replace(F.get(parts, F.lit(1)), F.lit("-AUS"), F.lit(""))
        longest = let(
            tokens,
            lambda t: F.aggregate(
                F.transform(t, lambda token, i: candidate(t, token, i)),
                F.lit(""),
                lambda best, c: F.when(F.length(c) > F.length(best), c).otherwise(best),
            ),
        )
        chosen = (
            F.when((F.size(parts) == 2) & (F.length(whole) > 3), whole)
            .when(last.rlike(r"^\d{8,}$"), last)
            .otherwise(longest)
        )
        return F.when(F.get(parts, F.lit(0)) == "ip", chosen)

    return blank_to_null(let(path, choose))


def model_from_name(name: Column | str) -> Column:
    """Model number from a product name: last comma part, then parentheses, then last word."""
    c = col(name)
    fits = lambda x: _mixed(x) & F.length(x).between(5, 20)
    tail = F.trim(F.substring_index(c, ",", -1))
    from_tail = F.when(c.contains(",") & ~tail.contains(" ") & fits(tail), tail)
    paren = pick(c, r"\(([A-Z0-9]+)\)", 1)
    from_paren = F.when(F.length(paren).between(5, 20), paren)
    word = F.regexp_replace(pick(c, r"(\S+)\s*$", 1), r"^[.,;:]+|[.,;:]+$", "")
    return F.coalesce(from_tail, from_paren, F.when(fits(word), word))


def model(spec_name: Column | str, spec_model: Column | str, url: Column | str, name: Column | str) -> Column:
    """Specification 'Model name', then 'Model'; if that is invalid, URL, then product name."""

    def usable(c: Column | str) -> Column:
        text = F.trim(col(c))
        ok = F.length(text).between(4, 49)
        for phrase in UI_PHRASES:
            ok = ok & ~F.lower(text).contains(phrase)
        return blank_to_null(F.regexp_replace(F.when(ok, text), r"^\((.*)\)$", "$1"))

    spec = F.coalesce(usable(spec_name), usable(spec_model))
    fallback = F.coalesce(model_from_url(url), model_from_name(name))
    return F.coalesce(let(spec, lambda s: F.when(~is_invalid_model(s), s)), fallback)

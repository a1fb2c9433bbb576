"""Text to counts, ratings, badges and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """NULL for empty text: the source treats '' and NULL alike."""
    return F.nullif(col(c), F.lit(""))


def pick(c: Column | str, pattern: str, group: int = 0) -> Column:
    """First regex match, or NULL (``regexp_extract`` alone gives '')."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column, kind: str) -> Column:
    """Text to a number, else NULL.

    The pattern is tested first: a failed cast costs far more than a failed match.
    """
    return F.when(c.rlike(NUMBER), c).try_cast(kind)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(c: Column | str) -> Column:
    """Collapse runs of white space, no-break space included, and trim."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def first_int(c: Column | str) -> Column:
    """First run of digits, as text: 'only 1 left' -> '1'."""
    return pick(c, r"(\d+)", 1)


def count_suffix(c: Column | str) -> Column:
    """'100+' -> 100, '10k' -> 10000, '1,000+' -> 1000."""
    text = F.regexp_replace(F.lower(col(c)), ",", "")
    thousands = (pick(text, r"([\d.]+)k", 1).try_cast("double") * 1000).cast("bigint")
    plain = pick(text, r"(\d+)", 1).try_cast("bigint")
    return F.when(text.rlike(r"[\d.]+k"), thousands).otherwise(plain)


def purchase_count(c: Column | str, k_anywhere: bool = False) -> Column:
    """'10K+ bought in past month' -> '10,000'.

    The K must follow the number. ``k_anywhere`` multiplies for any K in the text, as the
    source scripts do ('300+ bought in past week' then reads as 300,000).
    """
    number = pick(c, r"([\d.]+)", 1).try_cast("double")
    has_k = F.upper(col(c)).contains("K") if k_anywhere else col(c).rlike(r"^[^\d.]*[\d.]+[Kk]")
    return F.format_number(F.floor(F.when(has_k, number * 1000).otherwise(number)), 0)


def review_count(c: Column | str, style: str) -> Column:
    """Review count text; the style follows the shop.

    paren:  '(1,234 reviews)' -> '1234'    suffix: '16.4k reviews' -> '16400'
    plain:  '1,484 ratings'   -> '1,484'
    """
    if style == "paren":
        return F.regexp_replace(pick(c, r"(?i)\(([\d,]+)\s*reviews?\)", 1), ",", "")
    if style == "suffix":
        return count_suffix(pick(c, r"(?i)([\d,.k]+)\s*reviews?", 1)).cast("string")
    if style == "plain":
        return pick(c, r"([\d,]+)", 1)
    raise ValueError(f"unknown review count style: {style}")


def int_text(c: Column | str) -> Column:
    """'1,123' -> 1123; text that is no integer -> NULL."""
    return F.regexp_replace(col(c), ",", "").try_cast("int")


def stars_total(c: Column | str) -> Column:
    """Sum of a packed star histogram: '5star:142, 4star:14' -> 156."""
    counts = F.regexp_extract_all(col(c), F.lit(r":(\d+)"), 1)
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    return F.when(F.size(counts) > 0, total)


def stars_from_pct(total: Column | str, pcts: Column | str) -> Column:
    """Star counts (5 down to 1) from a total and percentages, truncated; missing pct -> 0."""
    total = col(total).cast("bigint")
    return F.transform(
        col(pcts),
        lambda p: F.coalesce(F.floor(total * p.cast("bigint") / F.lit(100)), F.lit(0).cast("bigint")),
    )


def star_count(span: Column | str, aria: Column | str, total: Column | str) -> Column:
    """Count for one star: '71% (489)', else '489 ratings are rated', else total x percent.

    The last step rounds half to even. A zero or missing total gives no count.
    """
    total = F.nullif(col(total).cast("bigint"), F.lit(0).cast("bigint"))
    from_pct = F.bround(total * pick(span, r"(\d+)%", 1).try_cast("bigint") / F.lit(100.0), 0)
    return F.coalesce(
        pick(F.when(col(span).contains("% ("), col(span)), r"\((\d+)\)", 1).try_cast("bigint"),
        pick(aria, r"(\d+)\s+ratings?\s+are\s+rated", 1).try_cast("bigint"),
        from_pct.cast("bigint"),
    )


def stars_text(counts: Column | str, style: str) -> Column:
    """Pack star counts (array, 5 down to 1).

    comma: '5star:9, 4star:1'  stars without a count are left out; none at all -> NULL
    space: '5stars:9 4stars:1 3stars:0 2stars:0 1star:2'  missing counts read 0
    """
    values = [F.try_element_at(col(counts), F.lit(6 - star)) for star in range(5, 0, -1)]
    stars = range(5, 0, -1)
    if style == "comma":
        parts = [F.concat(F.lit(f"{s}star:"), v.cast("string")) for s, v in zip(stars, values)]
        return blank_to_null(F.concat_ws(", ", *parts))
    if style == "space":
        parts = [
            F.concat(F.lit(f"{s}star{'s' if s > 1 else ''}:"), F.coalesce(v.cast("string"), F.lit("0")))
            for s, v in zip(stars, values)
        ]
        return F.concat_ws(" ", *parts)
    raise ValueError(f"unknown star style: {style}")


def rating(c: Column | str, style: str = "out_of") -> Column:
    """'4.4 out of 5 stars' -> '4.4'; ``strict`` keeps only a bare 'd.d', ``first`` any number."""
    if style == "out_of":
        return pick(c, r"([\d.]+)\s*out of", 1)
    if style == "first":
        return pick(c, r"([\d.]+)", 1)
    if style == "strict":
        return F.when(F.trim(col(c)).rlike(r"^\d+\.\d+$"), F.trim(col(c)))
    raise ValueError(f"unknown rating style: {style}")


def clean_rank(c: Column | str) -> Column:
    """'#8,565 in Electronics (See Top 100)' -> '#8,565 in Electronics'."""
    return F.trim(F.regexp_replace(blank_to_null(c), r"\s*\([^)]*\)", ""))


def rank_int(c: Column | str) -> Column:
    """'#12' -> 12."""
    return F.trim(F.replace(col(c), F.lit("#"), F.lit(""))).try_cast("int")


def slice_between(c: Column | str, start: str, end: str) -> Column:
    """Text from phrase ``start`` up to phrase ``end``; NULL where ``start`` is absent."""
    tail = F.substr(col(c), F.instr(col(c), start))
    return F.when(col(c).contains(start), F.trim(F.substring_index(tail, end, 1)))


def screen_size(c: Column | str, style: str) -> Column:
    """inch: '64.5 in' -> '64.5 inches'; lower: lower case; class: '<n> inches' else raw text."""
    if style == "inch":
        return F.concat(pick(c, r"(?i)([\d.]+)\s*in", 1), F.lit(" inches"))
    if style == "lower":
        return F.lower(col(c))
    if style == "class":
        return F.coalesce(pick(c, r"(\d+\s*inches)", 1), col(c))
    raise ValueError(f"unknown screen size style: {style}")


def classify_badges(badges: Column | str) -> Column:
    """Badge texts (array) to purchased_yesterday, added_to_carts, sku_popularity, status_badge.

    The last badge of a kind wins; texts of no known kind are joined as popularity.
    """
    kinds = F.array_distinct(F.filter(F.transform(col(badges), lambda x: F.trim(x)), lambda b: b != ""))
    bought = lambda b: F.lower(b).contains("bought since yesterday")
    carts = lambda b: F.lower(b).rlike("people'?s carts")
    rollback = lambda b: F.lower(b).contains("rollback")
    last = lambda arr: F.try_element_at(arr, F.lit(-1))
    rest = F.filter(kinds, lambda b: ~bought(b) & ~carts(b) & ~rollback(b))
    return F.struct(
        count_suffix(last(F.filter(kinds, bought))).alias("purchased_yesterday"),
        count_suffix(last(F.filter(kinds, lambda b: ~bought(b) & carts(b)))).alias("added_to_carts"),
        blank_to_null(F.array_join(rest, ", ")).alias("sku_popularity"),
        F.when(
            F.exists(kinds, lambda b: ~bought(b) & ~carts(b) & rollback(b)), F.lit("Rollback")
        ).alias("status_badge"),
    )


def sku_status(rollback: Column | str, sponsored: Column | str) -> Column:
    """Rollback wins over Sponsored; neither -> NULL."""
    return F.when(blank_to_null(rollback).isNotNull(), F.lit("Rollback")).when(
        blank_to_null(sponsored).isNotNull(), F.lit("Sponsored")
    )


def order_discounts(c: Column | str) -> Column:
    """Flash Deal / Reduced price parts first, then the online-price part; else the raw text."""
    parts = F.transform(F.split(col(c), ","), lambda x: F.trim(x))
    first = F.filter(parts, lambda p: F.lower(p).rlike("flash deal|reduced price"))
    online = F.filter(
        parts,
        lambda p: ~F.lower(p).rlike("flash deal|reduced price")
        & F.lower(p).contains("price when purchased online"),
    )
    last_online = F.when(F.size(online) > 0, F.slice(online, -1, 1)).otherwise(online)
    return F.coalesce(blank_to_null(F.array_join(F.concat(first, last_online), ", ")), col(c))


def join_parts(*parts: Column | str) -> Column:
    """Non-blank parts joined by ', '; none -> NULL."""
    return blank_to_null(F.concat_ws(", ", *[blank_to_null(p) for p in parts]))


def kwh(c: Column | str) -> Column:
    """'286 kilowatt hours' -> '286'; text without digits is kept."""
    return F.coalesce(first_int(c), blank_to_null(c))


def recommend(c: Column | str) -> Column:
    """'91%' -> '91% would recommend to a friend'."""
    return F.concat(blank_to_null(c), F.lit(" would recommend to a friend"))


def pad(arr: Column | str, n: int, dash: str = "—") -> Column:
    """At least ``n`` entries: blanks and the dash become NULL, short arrays are filled, longer ones stay."""
    clean = F.transform(col(arr), lambda x: F.nullif(blank_to_null(F.trim(x)), F.lit(dash)))
    have = F.coalesce(clean, F.array().cast("array<string>"))
    return F.concat(have, F.array_repeat(F.lit(None).cast("string"), F.greatest(F.lit(n) - F.size(have), F.lit(0))))


def first_of(*cols: Column | str) -> Column:
    """First non-blank value, trimmed."""
    return F.coalesce(*[blank_to_null(F.trim(col(c))) for c in cols])


def allow(c: Column | str, values: list[str]) -> Column:
    """Keep listed values, else NULL."""
    return F.when(col(c).isin(values), col(c))


def allow_all_of(c: Column | str, subs: list[str]) -> Column:
    """Keep text that contains every phrase, else NULL."""
    keep = F.lit(True)
    for sub in subs:
        keep = keep & col(c).contains(sub)
    return F.when(keep, col(c))


def clean_markup(c: Column | str) -> Column:
    """Markup to text: <br> becomes a space, <sup>99</sup> becomes .99, other tags go."""
    text = F.regexp_replace(col(c), r"<br\s*/?>", " ")
    text = F.regexp_replace(text, r"<sup[^>]*>(\d+)</sup>", ".$1")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    return squeeze(text)


def promo_label(h2: Column | str, p: Column | str, text: Column | str) -> Column:
    """Promotion name: heading plus sub-heading, else heading, else the first two text lines."""
    lines = F.filter(F.transform(F.split(col(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    two_lines = F.array_join(F.slice(lines, 1, 2), " ")
    both = F.concat_ws(" ", F.trim(col(h2)), F.trim(col(p)))
    label = F.when(col(h2).isNotNull() & col(p).isNotNull(), both).when(
        col(h2).isNotNull(), F.trim(col(h2))
    ).otherwise(two_lines)
    return blank_to_null(squeeze(label))

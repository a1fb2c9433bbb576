"""Prices, seller labels and stock texts of the country shops."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.money import PRICE
from shelfwise.functions.text import blank_to_null, col, pick

# Texts that are not a price, as one pattern per country.
REJECT = {
    "it": r"(?iU)^\s*[a-zA-Z\s]+$|^\s*\d+\s*[a-zA-Z]|was\s*€|list\s*price|buy\s*used",
    "de": r"(?iU)^\s*[a-zA-Z\s]+$|^\s*\d+\s*[a-zA-Z]|was\s*€|list\s*price|buy\s*used",
    "fr": r"(?iU)^\s*[a-zA-Z\s]+$|^\s*\d+\s*[a-zA-Z]|was\s*€|list\s*price|buy\s*used|achetez\s*d'occasion",
    "en": r"(?iU)^\s*[a-zA-Z\s]+$|^\s*\d+\s*[a-zA-Z]|was\s*[€$£¥₹]|list\s*price|buy\s*used",
    "es": r"(?U)^\s*[a-zA-Z\s]+$|^\s*\d+\s*[a-zA-Z]|^\s*[^€$£¥₹\s]\d+\s*$",
}

# Accepted price range per country; other countries have none.
PRICE_RANGE = {"it": (1, 50000), "de": (1, 50000), "fr": (1, 50000), "es": (10, 10000), "en": (5, 50000)}

# Label phrases in front of a shipper or seller name.
LABELS = {
    ("ships", "it"): ["ships from", "fulfilled by", "spedito da"],
    ("sold", "it"): ["sold by", "venduto da"],
    ("ships", "de"): ["ships from", "fulfilled by", "versand durch"],
    ("sold", "de"): ["sold by", "verkauft von", "vendu par"],
    ("ships", "fr"): ["ships from", "fulfilled by", "expédié par", "expédie par"],
    ("sold", "fr"): ["sold by", "vendu par"],
}

# Stock phrases, (out of stock, in stock).
STOCK = {
    "it": (
        ["attualmente non disponibile", "non disponibile", "esaurito", "temporaneamente non disponibile",
         "currently unavailable", "out of stock", "temporarily out of stock"],
        ["disponibile", "in stock", "disponibilità immediata", "pronto per la spedizione", "only",
         "left in stock", "disponibili"],
    ),
    "de": (
        ["nicht verfügbar", "ausverkauft", "temporarily out of stock", "currently unavailable", "out of stock"],
        ["auf lager", "only", "left in stock", "in stock"],
    ),
    "fr": (
        ["non disponible", "épuisé", "temporarily out of stock", "currently unavailable", "out of stock",
         "rupture de stock"],
        ["en stock", "disponible", "only", "left in stock", "in stock"],
    ),
    "es": (
        ["currently unavailable", "out of stock", "temporarily out of stock", "no disponible", "agotado"],
        ["in stock", "only", "left in stock", "disponible", "en stock"],
    ),
    "in": (
        ["currently unavailable", "out of stock", "temporarily out of stock", "currently not available"],
        ["in stock", "available", "only", "left in stock"],
    ),
}
# Page-wide sold-out phrases.
PAGE_SOLD_OUT = ["Out of Stock", "Sold Out", "Currently unavailable", "Temporarily out of stock"]


# Shapes of a number once currency signs and white space are gone.
DECIMAL_COMMA = r"^[\d.]*\d[\d.]*,\d{1,2}$"
PLAIN = r"^\d+(\.\d{1,2})?$"


def _stripped(text: Column, cc: str) -> Column:
    """Text without signs and white space; NULL where the country's reject pattern matches."""
    return F.when(~text.rlike(REJECT[cc]), F.regexp_replace(text, r"(?U)[€\s]", ""))


def _gate(price: Column, cc: str) -> Column:
    lo, hi = PRICE_RANGE[cc]
    return F.when(price.between(lo, hi), price)


def _comma_or_plain(c: Column) -> Column:
    """'1.299,99' and '61,84' lose the grouping dots and get a decimal point; '61.84' stays."""
    return (
        F.when(c.rlike(DECIMAL_COMMA), F.translate(c, ",.", ".")).when(c.rlike(PLAIN), c).try_cast(PRICE)
    )


def _italian(text: Column) -> Column:
    c = _stripped(text, "it")
    # A readable decimal comma is taken as it is; only the other form is range checked here.
    ungrouped = F.replace(c, F.lit(","), F.lit(""))
    other = F.when(~c.rlike(r",\d{1,2}$") & ungrouped.rlike(r"^\d+(\.\d{0,2})?$"), ungrouped).try_cast(PRICE)
    return F.coalesce(F.when(c.rlike(DECIMAL_COMMA), F.translate(c, ",.", ".")).try_cast(PRICE), _gate(other, "it"))


def _german(text: Column) -> Column:
    c = _stripped(text, "de")
    cents = F.when(c.rlike(r"^[1-9]\d{3}$"), (c.try_cast("int") / 100).cast(PRICE))
    return F.coalesce(cents, _gate(_comma_or_plain(c), "de"))


def _polish(text: Column) -> Column:
    c = F.trim(F.regexp_replace(text, "zł|PLN| ", ""))
    cents = pick(c, r"(\d+)[,.]?(\d*)", 2)
    return F.concat_ws(".", pick(c, r"(\d+)[,.]?(\d*)", 1), cents).try_cast(PRICE)


def _grouped(text: Column, symbols: str, groups: str, cents: bool = True) -> Column:
    """Currency signs stripped; the rest must be a well-formed grouped or plain number."""
    c = F.regexp_replace(text, rf"(?U)[{symbols}\s]", "")
    tail = r"(\.\d{1,2})?$" if cents else "$"
    ok = c.rlike(rf"^\d{{1,3}}(,\d{{{groups}}})*{tail}") | c.rlike(rf"^\d+{tail}")
    return F.when(ok, F.replace(c, F.lit(","), F.lit(""))).try_cast(PRICE)


def _english(text: Column) -> Column:
    """Up to four digits before the first group, range checked; texts that are no price rejected."""
    c = F.regexp_replace(text, r"(?U)[£$\s]", "")
    ok = ~text.rlike(REJECT["en"]) & c.rlike(r"^\d{1,4}(,\d{3})*(\.\d{1,2})?$")
    return _gate(F.when(ok, F.replace(c, F.lit(","), F.lit(""))).try_cast(PRICE), "en")


def _number_after(text: Column, pattern: str) -> Column:
    return F.replace(pick(text, pattern, 1), F.lit(","), F.lit("")).try_cast(PRICE)


def _dutch(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return pick(plain, r"(\d+\.?\d*)", 1).try_cast(PRICE)


PARSERS = {
    "it": _italian,
    "de": _german,
    "fr": lambda t: _gate(_comma_or_plain(_stripped(t, "fr")), "fr"),
    "es": lambda t: _gate(_comma_or_plain(_stripped(t, "es")), "es"),
    "in": lambda t: _number_after(F.regexp_replace(t, r"(?U)[₹\s]", ""), r"([\d,]+\.?\d*)"),
    "nl": _dutch,
    "gb": lambda t: _number_after(t, r"£?([\d,]+\.?\d*)"),
    "usa": lambda t: _number_after(t, r"\$([\d,]+\.?\d*)"),
    "pl": _polish,
    # Forms of the shared multi-country parser.
    "jp": lambda t: _grouped(t, "¥￥", "3", cents=False),
    "in_grouped": lambda t: _grouped(t, "₹", "2,3"),
    "en_grouped": lambda t: _grouped(t, "$£", "3"),
    "en_ranged": _english,
    # An alternative reading of Spanish prices by the Italian rules.
    "es_alt": _italian,
}


def parse_price(text: Column | str, country: Column | str, countries: list[str] | None = None) -> Column:
    """Price text to decimal(12,2) by the rules of its country; unreadable text -> NULL.

    ``country`` is a column or a literal code. All rules are built-in expressions in one ``when``
    chain, so the parse stays in generated code and only a row's own branch is evaluated.
    """
    text = col(text)
    if isinstance(country, str) and country in PARSERS:
        return PARSERS[country](text)
    chain = None
    for code in countries or ["it", "de", "fr", "es", "in", "nl", "gb", "usa", "pl"]:
        test = col(country) == code
        chain = F.when(test, PARSERS[code](text)) if chain is None else chain.when(test, PARSERS[code](text))
    return chain


def whole_and_fraction(whole: Column | str, fraction: Column | str) -> Column:
    """'61,' and '84' -> '61.84'; NULL where either has no digit."""
    digits = lambda c: blank_to_null(F.regexp_replace(col(c), r"[^\d]", ""))
    return F.concat(digits(whole), F.lit("."), digits(fraction))


def strip_label(c: Column | str, kind: str, cc: str) -> Column:
    """Shipper / seller text without its label; a bare label -> NULL."""
    text = F.trim(col(c))
    low = F.lower(text)
    labels = LABELS[(kind, cc)]
    steps = []
    for label in labels:
        after = F.trim(F.substr(text, F.instr(low, label) + F.lit(len(label))))
        if cc == "de":
            steps.append(F.when(low.startswith(label + " "), blank_to_null(after)))
            steps.append(F.when(low.contains(label) & low.contains("amazon"), F.lit("Amazon")))
        else:
            steps.append(F.when(low.contains(label), blank_to_null(after)))
    return F.when(~low.isin(labels), F.coalesce(*steps, text))


def in_stock(c: Column | str, cc: str) -> Column:
    """False on an out-of-stock phrase, else True (also where nothing is known)."""
    out, there = STOCK[cc]
    low = F.lower(col(c))
    return F.coalesce(
        F.when(low.rlike("|".join(out)), F.lit(False)).when(low.rlike("|".join(there)), F.lit(True)),
        F.lit(True),
    )


def page_in_stock(html: Column | str) -> Column:
    """False where the page shows any sold-out phrase."""
    return ~col(html).rlike("|".join(PAGE_SOLD_OUT))

"""Stored pages to rows, with string and regular expressions on the markup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.clock import date_part
from shelfwise.functions.text import blank_to_null, clean_markup, col, pick
from shelfwise.operators.skew import join_one

MAX_RULES = 10_000


@dataclass(frozen=True)
class Rule:
    """One selector: the first capture group of ``pattern`` is the value of ``field``."""

    field: str
    pattern: str
    priority: int = 1
    active: bool = True


def load_rules(table: DataFrame, where: Column) -> list[Rule]:
    """Read selector rules from a configuration table.

    Rules are settings, not data: they become part of the plan. More than MAX_RULES is an error.
    """
    rows = table.where(where).select("data_field", "pattern", "priority", "is_active").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} selector rules")
    return [Rule(r.data_field, r.pattern, r.priority, r.is_active) for r in rows]


def extract(
    pages: DataFrame, rules: list[Rule], keep: list[str], html: str = "html", post: dict | None = None,
    descending: bool = False,
) -> DataFrame:
    """One column per field: the first rule, by priority, that matches something non-empty.

    There is no join with a rule table and no shuffle: the rules become literal patterns, one
    projection per priority level. A level is evaluated only for fields that are still empty, and
    each pattern at most once per page. ``post`` maps a field to a function of its value.
    """
    fields: dict[str, list[Rule]] = {}
    for rule in sorted((r for r in rules if r.active), key=lambda r: r.priority, reverse=descending):
        fields.setdefault(rule.field, []).append(rule)
    match = lambda rule: F.trim(F.regexp_extract(col(html), rule.pattern, 1))
    out = pages.withColumns({f"_f_{name}": match(cascade[0]) for name, cascade in fields.items()})
    for level in range(1, max(len(cascade) for cascade in fields.values())):
        out = out.withColumns(
            {
                f"_f_{name}": F.when(F.col(f"_f_{name}") != "", F.col(f"_f_{name}")).otherwise(match(cascade[level]))
                for name, cascade in fields.items()
                if level < len(cascade)
            }
        )
    value = lambda name: (post or {}).get(name, lambda c: c)(blank_to_null(f"_f_{name}"))
    return out.select(*keep, *[value(name).alias(name) for name in sorted(fields)])


def extract_by_rules(
    pages: DataFrame, rules: DataFrame, fields: list[str], keep: list[str], on: list[str], html: str = "html", post: dict | None = None, descending: bool = False,
) -> DataFrame:
    """``extract`` with the rules as a table: the rules of a page are those of its shop (the ``on`` columns), joined to it as one list.

    The table has ``on``, ``data_field``, ``pattern``, ``priority``, ``is_active``. The lists, one per shop in order of priority (smallest first,
    or largest with ``descending``; ties by pattern), meet the pages in one join, which Spark broadcasts where the lists are small; a page is
    neither repeated nor grouped, and nothing is collected. A list is walked until a rule gives something that is not empty.
    Pages of shops without rules have NULL in all fields.
    """
    rank = -F.col("priority") if descending else F.col("priority")
    active = rules.where("is_active").select(*on, F.struct(rank.alias("rank"), "pattern", F.col("data_field").alias("field")).alias("_rule"))
    lists = active.groupBy(*on).agg(F.sort_array(F.collect_list("_rule")).alias("_rules"))
    joined = join_one(pages, lists, on)
    match = lambda rule: F.trim(F.call_function("regexp_extract", col(html), rule["pattern"], F.lit(1)))
    first = lambda field: F.aggregate(
        F.filter(F.coalesce("_rules", F.array().cast("array<struct<rank:int,pattern:string,field:string>>")), lambda rule: rule["field"] == field),
        F.lit(""), lambda found, rule: F.when(found != "", found).otherwise(match(rule)),
    )
    value = lambda name: (post or {}).get(name, lambda c: c)(blank_to_null(first(name)))
    return joined.select(*keep, *[value(name).alias(name) for name in sorted(fields)])


def containers(pages: DataFrame, pattern: str, keep: list[str], html: str = "html") -> DataFrame:
    """One row per match of a container pattern, with its position on the page (from 1)."""
    found = F.posexplode(F.regexp_extract_all(col(html), F.lit(pattern), 0)).alias("_pos", "container")
    return pages.select(*keep, found).withColumn("position", F.col("_pos") + 1).drop("_pos")


def attribute(container: Column | str, name: str) -> Column:
    """Value of an attribute in a container's opening tag."""
    return pick(container, rf'^<[^>]*\b{name}="([^"]*)"', 1)


# Areas of a page whose prices belong to other products.
EXCLUDED_AREAS = [
    "productSimilar", "similarProducts", "recommendedProducts", "product-comparison", "comparison", "sponsored",
    "sp-", "aplus-v2", "frequently-bought", "bought-together", "customers-who-viewed", "customers-who-bought",
    "related-products", "accessory-products", "bundle-products", "cross-sell", "widget", "recommendation",
]


def exclude_areas(df: DataFrame, context: str, areas: list[str] | None = None) -> DataFrame:
    """Drop values whose surrounding markup names an excluded area."""
    names = "|".join(f"\\Q{a}\\E" for a in (areas or EXCLUDED_AREAS))
    return df.where(~F.coalesce(F.col(context).rlike("(?i)" + names), F.lit(False)))


@dataclass(frozen=True)
class BlockTexts:
    """Lower-case texts of blocked pages.

    ``body`` counts only where no ``links`` text offers a way on, and, where ``needs`` is set, only
    on pages that also show that text.
    """

    title: tuple[str, ...]
    body: tuple[str, ...]
    links: tuple[str, ...]
    needs: str | None = None


# Blocked pages.
BLOCKED = {
    "es": BlockTexts(
        title=("503", "access denied", "error has occurred", "fehler aufgetreten", "lo sentimos", "se ha producido un error"),
        body=(
            "enter the characters", "verify you are human", "access denied", "automated access", "suspicious activity",
            "geben sie die zeichen ein", "beweisen sie dass sie ein mensch sind", "haz clic aquí para volver", "robot check",
        ),
        links=(
            "continue shopping", "weiter shoppen", "continuar comprando", "seguir comprando", "haz clic aquí para volver",
        ),
    ),
    "it": BlockTexts(
        title=("503", "access denied", "accesso negato", "error has occurred", "errore", "ci dispiace"),
        body=(
            "enter the characters", "inserisci i caratteri", "verify you are human", "controlla di essere umano",
            "access denied", "accesso negato", "automated access", "suspicious activity", "attività sospetta",
        ),
        links=("continua lo shopping", "continue shopping", "clicca qui per tornare"),
        needs="ci dispiace",
    ),
}
# Other page texts by status, lower case.
ERROR_TEXTS = [
    "lo sentimos", "se ha producido un error", "error de servicio", "503", "service unavailable", "algo salió mal",
    "error has occurred", "haz clic aquí para volver", "something went wrong", "robot check", "automated access",
]
ROBOT_TEXTS = ["robot or human?", "enter the characters you see below"]
SORRY_TEXTS = ["sorry", "robot check"]
THROTTLE_TEXTS = ["request was throttled", "please wait a moment and refresh"]
CHALLENGE_TEXTS = ["verifying you are human", "cf-challenge", "just a moment", "checking your browser", "ddos protection"]
NORMAL_MARKS = [
    'id="productTitle"', "id='productTitle'", 'id="feature-bullets"', "id='feature-bullets'", 'id="centerCol"', "id='centerCol'",
    'id="dp-container"', "id='dp-container'", 'id="apex_desktop"', "id='apex_desktop'",
]
# Countries whose pages are tested for the shop's name in the URL before anything else; others after the block texts.
HOST_FIRST = ["it"]


def _any(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | c.contains(word)
    return out


# Parts of a lower-case page that say nothing about its status: scripts and elements marked as reviews.
ASIDE = "(?s)<script.*?</script>" + "".join(f"|<{tag}[^>]*review[^>]*>.*?</{tag}>" for tag in ("div", "section", "li", "span", "p"))
TITLE = r"(?is)<title[^>]*>(.*?)</title>"


def with_status(
    pages: DataFrame, html: str = "html", normal_marks: list[str] | None = None, cc: str = "es", url: str | None = None, host: str = "amazon",
) -> DataFrame:
    """Add ``status``: ok / throttled / challenge / robot / blocked / error.

    A page that shows a normal product element is ok whatever its text says. Body texts of the
    blocked class do not count where a link to continue is offered. The lower-case page and its
    title are columns of their own, computed once per page. With ``url``, a page whose URL does not name the ``host`` is blocked:
    it was led elsewhere. A NULL URL names no host.
    """
    raw, body, title = col(html), F.col("_body"), F.col("_title")
    # 'sorry' is common in scripts and reviews, so the rule reads the whole page without them.
    # Most pages have none of the texts anywhere, and are not searched for those parts.
    aside = F.when(_any(body, SORRY_TEXTS), _any(F.regexp_replace(body, ASIDE, ""), SORRY_TEXTS)).otherwise(F.lit(False))
    sorry = _any(title, SORRY_TEXTS) | aside
    led_away = ~F.coalesce(F.lower(F.col(url)).contains(host), F.lit(False)) if url else F.lit(False)
    texts = BLOCKED[cc]
    needed = body.contains(texts.needs) if texts.needs else F.lit(True)
    blocked = _any(title, texts.title) | (needed & ~_any(body, texts.links) & _any(body, texts.body))
    status = (
        F.when(led_away & F.lit(cc in HOST_FIRST), F.lit("blocked"))
        .when(_any(raw, normal_marks or NORMAL_MARKS), F.lit("ok"))
        .when(_any(body, THROTTLE_TEXTS), F.lit("throttled"))
        .when(_any(body, CHALLENGE_TEXTS) | _any(title, CHALLENGE_TEXTS), F.lit("challenge"))
        .when(_any(body, ROBOT_TEXTS) | sorry, F.lit("robot"))
        .when(blocked | led_away, F.lit("blocked"))
        .when(_any(title, ERROR_TEXTS) | _any(body, ERROR_TEXTS), F.lit("error"))
        .otherwise(F.lit("ok"))
    )
    staged = pages.withColumns(
        {"_body": F.lower(raw), "_title": F.lower(F.regexp_extract(raw, TITLE, 1))}
    )
    return staged.withColumn("status", status).drop("_body", "_title")


def status_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages per status."""
    return with_status(pages, html).groupBy("status").agg(F.count(F.lit(1)).alias("pages"))


def attach_section(elements: DataFrame, page: str, position: str, section: str) -> DataFrame:
    """Give each element the nearest section before it in document order.

    ``section`` is NULL on rows that are not sections. A window group is one page's elements.
    """
    before = Window.partitionBy(page).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return elements.withColumn("nearest_section", F.last(section, ignorenulls=True).over(before))


def specs(pages: DataFrame, labels: dict[str, str], keep: list[str], label: str, value: str, html: str = "html") -> DataFrame:
    """Label / value rows of a page to columns.

    ``label`` and ``value`` are pattern pieces around the text; ``labels`` maps column to label.
    """
    out = [
        blank_to_null(clean_markup(pick(html, label.format(name) + value, 1))).alias(column)
        for column, name in labels.items()
    ]
    return pages.select(*keep, *out)


def events(
    pages: DataFrame, container: str, name: str, date: str, keep: list[str], html: str = "html", channel: Column | None = None
) -> DataFrame:
    """Event containers with name, start and end; fewer than two dates -> dropped. ``channel`` names the retailer of a page, in the channel's spelling."""
    if channel is not None:
        pages, keep = pages.withColumn("channel", channel), [*keep, "channel"]
    rows = containers(pages, container, keep, html)
    dates = F.regexp_extract_all(F.col("container"), F.lit(date), 1)
    return (
        rows.select(
            *keep, "position",
            blank_to_null(clean_markup(pick("container", name, 1))).alias("event_name"),
            date_part(F.try_element_at(dates, F.lit(1))).alias("event_start_date"),
            date_part(F.try_element_at(dates, F.lit(2))).alias("event_end_date"),
        )
        .where(F.col("event_name").isNotNull() & F.col("event_end_date").isNotNull())
    )


def comparison(pages: DataFrame, product: str, pros: str, cons: str, keep: list[str], url: str = "url", html: str = "html", n: int | None = None) -> DataFrame:
    """Compared products by column index with pros and cons, all that a page has; with ``n``, of pages with n at least.

    The first product is the page's own and takes the page URL, the others their link. A dash in
    the cons is NULL. ``product`` captures (link, name).
    """
    names = F.regexp_extract_all(col(html), F.lit(product), 2)
    links = F.regexp_extract_all(col(html), F.lit(product), 1)
    cells = F.arrays_zip(
        names.alias("product_name"),
        links.alias("link"),
        F.regexp_extract_all(col(html), F.lit(pros), 1).alias("pros"),
        F.regexp_extract_all(col(html), F.lit(cons), 1).alias("cons"),
    )
    enough = pages if n is None else pages.where(F.size(names) >= n)
    # Marks without a product belong to no column of the comparison.
    rows = enough.select(*keep, url, F.size(names).alias("_n"), F.posexplode(cells).alias("_pos", "_c"))
    text = lambda c: blank_to_null(clean_markup(c))
    return rows.where(F.col("_pos") < F.col("_n")).select(
        *keep,
        (F.col("_pos") + 1).alias("pos"),
        F.when(F.col("_pos") == 0, F.col(url)).otherwise(blank_to_null("_c.link")).alias("product_url"),
        text("_c.product_name").alias("product_name"),
        text("_c.pros").alias("pros"),
        F.nullif(text("_c.cons"), F.lit("—")).alias("cons"),
    )


def page_contexts(pages: DataFrame, symbol: str, keep: list[str], html: str = "html", around: int = 50) -> DataFrame:
    """Every occurrence of a symbol with its number on the page (from 1), its place, and the text ``around`` it on either side."""
    text, width = col(html), len(symbol)
    many = F.floor((F.length(text) - F.length(F.replace(text, F.lit(symbol), F.lit("")))) / width).cast("int")
    step = lambda places, _: F.concat(
        places, F.array(F.call_function("locate", F.lit(symbol), text, F.coalesce(F.try_element_at(places, F.lit(-1)) + width, F.lit(1))))
    )
    places = F.when(many > 0, F.aggregate(F.sequence(F.lit(1), many), F.array().cast("array<int>"), step))
    rows = pages.select(*keep, text.alias("_html"), F.posexplode(places).alias("_pos", "place"))
    start = F.greatest(F.lit(1), F.col("place") - around)
    context = F.substr("_html", start, F.col("place") + width + around - start)
    return rows.select(*keep, (F.col("_pos") + 1).alias("occurrence"), "place", context.alias("context"))


def page_audit(pages: DataFrame, symbol: str, patterns: dict[str, str], keep: list[str], html: str = "html", around: int = 50) -> DataFrame:
    """Text around the first occurrence of a symbol, and how often each container pattern occurs."""
    at = F.instr(col(html), symbol)
    start = F.greatest(F.lit(1), at - around)
    context = F.when(at > 0, F.substr(col(html), start, at + around - start))
    counts = [F.size(F.regexp_extract_all(col(html), F.lit(p), 0)).alias(name) for name, p in patterns.items()]
    return pages.select(*keep, F.length(html).alias("page_size"), context.alias("context"), *counts)

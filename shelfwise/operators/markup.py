"""Elements of stored pages as nested intervals: matching end tags, ancestors, areas.

A page's open and close marks are numbered in page order. The running depth of a tag gives each mark a level, and an
element reaches from its open mark to the next close mark of its level. Numbers and attributes travel, never the markup; a window group
is one page's marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.text import col
from shelfwise.operators.skew import join_one

# Elements that need an end tag and hold areas of a page.
NESTING = ["article", "aside", "body", "div", "fieldset", "figure", "footer", "form", "header", "main", "nav", "ol", "section", "span", "table", "ul"]
# Parts of a page whose tags are no elements.
NO_MARKUP = r"(?s)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<template\b.*?</template>"
# Parts of ids and classes of areas whose prices belong to other products.
EXCLUDED_IDS = [
    "dp-sims-desktop", "similarities-desktop", "desktop-dp-sims", "recommendations", "also-bought", "also-viewed", "bundleV2", "sims", "ads",
]
EXCLUDED_CLASSES = [
    "product-comparison-desktop", "comparison", "non-deal", "recommendations", "sponsored", "similarities", "also-bought", "also-viewed", "related",
    "frequently", "customers-also", "sims-", "also-", "ads-",
]
# Other attributes of such areas.
EXCLUDED_DATA = {"data-component-type": ["sims"], "data-feature-name": ["sims"]}
# Fixed value: the area that a page's own price is in.
OWN_AREA = "centerCol"


def bare(html: Column | str) -> Column:
    """Markup without comments, scripts, styles and templates."""
    return F.regexp_replace(col(html), NO_MARKUP, "")


def mark_pattern(tags: list[str] | None = None) -> str:
    """Pattern of the open and close marks of some tags."""
    return f"(?i)</?(?:{'|'.join(tags or NESTING)})(?:[\\s/][^<>]*)?>"


def marks(pages: DataFrame, page: str = "page_id", html: str = "html", tags: list[str] | None = None) -> DataFrame:
    """``page, pos, tag, closing, mark, at``: open and close marks of ``tags`` in page order, with their place in ``bare`` markup.

    ``at`` counts characters before the mark: the lengths of the texts between marks are summed along the page.
    """
    pattern = F.lit(mark_pattern(tags))
    text = F.col("_bare")
    cut = pages.select(page, bare(html).alias("_bare")).where("_bare is not null")
    gaps = F.transform(F.split(text, pattern, -1), lambda t: F.length(t))
    found = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("mark"), gaps.alias("gap"))
    rows = cut.select(page, F.posexplode(found).alias("_pos", "_m")).where("_m.mark is not null")
    rows = rows.select(page, (F.col("_pos") + 1).alias("pos"), F.col("_m.mark").alias("mark"), F.col("_m.gap").alias("_gap"))
    along = Window.partitionBy(page).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    at = F.sum(F.col("_gap") + F.length("mark")).over(along) - F.length("mark")
    tag = F.lower(F.regexp_extract("mark", "^</?([a-zA-Z]+)", 1))
    return rows.select(page, "pos", tag.alias("tag"), F.col("mark").startswith("</").alias("closing"), "mark", at.alias("at"))


def elements(pages: DataFrame, page: str = "page_id", html: str = "html", tags: list[str] | None = None) -> DataFrame:
    """``page, tag, opening, level, start, end, at, until``: elements as intervals of mark numbers and of characters.

    ``level`` is the element's depth among elements of its tag. A close mark without an open one ends
    nothing. An element without end tag ends where the smallest element around it does, at the end of the page if there is none
    (``end`` and ``until`` are NULL then).
    """
    step = F.when(F.col("closing"), F.lit(-1)).otherwise(F.lit(1))
    along = Window.partitionBy(page, "tag").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(step).over(along)
    # An open mark and the close mark that ends it have the same level: the depth inside.
    leveled = marks(pages, page, html, tags).withColumn("level", depth + F.when(F.col("closing"), F.lit(1)).otherwise(F.lit(0)))
    same = Window.partitionBy(page, "tag", "level").orderBy("pos")
    ends = lambda c: F.when(F.lead("closing").over(same), F.lead(c).over(same))
    until = F.when(F.lead("closing").over(same), F.lead(F.col("at") + F.length("mark")).over(same))
    found = leveled.select("*", ends("pos").alias("end"), until.alias("until")).where("not closing")
    found = found.select(page, "tag", F.col("mark").alias("opening"), "level", F.col("pos").alias("start"), "end", "at", "until")
    # The nearest end among the closed elements that are open here: the latest opened one that has not ended yet.
    open_ = found.where("end is null").select(page, F.col("start").alias("_start"))
    around = found.where("end is not null").select(F.col(page).alias("_page"), F.col("start").alias("_low"), F.col("end").alias("_high"), F.col("until").alias("_until"))
    inside = [F.col(page) == F.col("_page"), F.col("_low") < F.col("_start"), F.col("_high") > F.col("_start")]
    nearest = open_.join(around, inside).groupBy(page, "_start").agg(F.min("_high").alias("_end"), F.min("_until").alias("_until"))
    out = found.join(nearest.withColumnRenamed("_start", "start"), [page, "start"], "left")
    # Levels count from the page's lowest depth, so that close marks without an open one do not shift them.
    lowest = F.min("level").over(Window.partitionBy(page, "tag"))
    return out.select(
        page, "tag", "opening", (F.col("level") - F.least(lowest, F.lit(1)) + 1).cast("int").alias("level"), "start",
        F.coalesce("end", "_end").alias("end"), "at", F.coalesce("until", "_until").alias("until"),
    )


def attribute_has(opening: Column | str, name: str, parts: list[str]) -> Column:
    """Whether an attribute of an opening tag contains one of some texts (case counts, as in a selector)."""
    value = F.regexp_extract(col(opening), rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", 0)
    found = F.lit(False)
    for part in parts:
        found = found | value.contains(part)
    return F.coalesce(found, F.lit(False))


def is_excluded(opening: Column | str = "opening") -> Column:
    """Whether an element is an area of other products."""
    out = attribute_has(opening, "id", EXCLUDED_IDS) | attribute_has(opening, "class", EXCLUDED_CLASSES)
    for name, parts in EXCLUDED_DATA.items():
        out = out | attribute_has(opening, name, parts)
    return out


def covered(points: DataFrame, areas: DataFrame, page: str, start: str = "start", name: str = "areas") -> DataFrame:
    """``points`` with the number of areas around each: areas opened before it less those ended before it, summed along the page.

    The areas' ``start`` and ``end`` (NULL: to the end of the page) become steps up and down between the points, so that no pairs of points and areas are made.
    """
    up = areas.select(page, F.col("start").alias("_pos"), F.lit(1).alias("_step"))
    down = areas.where("end is not null").select(page, F.col("end").alias("_pos"), F.lit(-1).alias("_step"))
    steps = up.unionByName(down).groupBy(page, "_pos").agg(F.sum("_step").alias("_step"))
    rows = points.withColumn("_pos", F.col(start)).withColumn("_step", F.lit(0)).withColumn("_point", F.lit(True))
    both = rows.unionByName(steps, allowMissingColumns=True)
    # A point that is an area's own mark lies in the areas around that area, not in itself.
    before = Window.partitionBy(page).orderBy("_pos").rangeBetween(Window.unboundedPreceding, -1)
    out = both.withColumn(name, F.coalesce(F.sum("_step").over(before), F.lit(0)).cast("int"))
    return out.where("_point").drop("_pos", "_step", "_point")


def exclude_by_ancestor(
    found: DataFrame, value: Column, excluded: Column | None = None, within: Column | None = None, page: str = "page_id",
) -> DataFrame:
    """Elements that ``value`` chooses (conditions on ``opening`` and ``tag``), without those in an excluded area.

    An element is left out where it, or an element around it at any distance, is an excluded area (``is_excluded`` by default), and, with
    ``within``, where no element around it (or itself) is such an area.
    """
    excluded = is_excluded() if excluded is None else excluded
    chosen = covered(found.where(value & ~excluded), found.where(excluded), page, name="_bad").where("_bad = 0").drop("_bad")
    if within is None:
        return chosen
    return covered(chosen, found.where(within), page, name="_good").where((F.col("_good") > 0) | within).drop("_good")


def section_counts(pages: DataFrame, tag: str, keywords: list[str], page: str = "page_id", html: str = "html") -> DataFrame:
    """``page, keyword, sections``: elements of a tag whose text, that of inner elements included, contains each keyword; pages without any are left out."""
    found = nested_containers(pages, F.col("tag") == tag, page, html, [tag])
    text = F.regexp_replace("container", "<[^>]*>", "")
    words = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: text.contains(k))
    return found.select(page, F.explode(words).alias("keyword")).groupBy(page, "keyword").agg(F.count(F.lit(1)).alias("sections"))


def nested_containers(pages: DataFrame, chosen: Column, page: str = "page_id", html: str = "html", tags: list[str] | None = None) -> DataFrame:
    """``page, position, level, depth, container``: whole markup of the elements ``chosen`` (a condition on ``opening`` and ``tag``).

    A container ends at its own end tag, however many elements of its tag it holds. ``position`` numbers the containers
    of a page from 1, ``depth`` counts those around each. Only places travel; a page's markup meets the list of its places once.
    """
    found = elements(pages, page, html, tags).where(chosen)
    deep = covered(found, found, page, name="depth")
    place = F.struct("start", "at", "until", "level", "depth")
    lists = deep.groupBy(page).agg(F.sort_array(F.collect_list(place)).alias("_places"))
    rows = join_one(pages.select(page, bare(html).alias("_bare")), lists, [page], "inner")
    rows = rows.select(page, "_bare", F.posexplode("_places").alias("_pos", "_p"))
    text = F.substr("_bare", (F.col("_p.at") + 1).cast("int"), (F.coalesce("_p.until", F.length("_bare")) - F.col("_p.at")).cast("int"))
    return rows.select(page, (F.col("_pos") + 1).alias("position"), F.col("_p.level").alias("level"), F.col("_p.depth").alias("depth"), text.alias("container"))

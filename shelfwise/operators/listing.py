"""Listing feeds: latest batch, merging by product, ranks, duplicates, filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.clock import batch_seconds
from shelfwise.functions.order import newest_key, nulls_last, order_key
from shelfwise.functions.text import blank_to_null, col
from shelfwise.operators.skew import combine, join_one
from shelfwise.session import cut_lineage

FEEDS = ["main", "bsr", "promotion", "trend"]


def feed_position(source: Column | str, feeds: list[str] = FEEDS) -> Column:
    """1 for the first feed of the list, 2 for the second ...; NULL for others."""
    return F.nullif(F.array_position(F.array(*[F.lit(f) for f in feeds]), col(source)), F.lit(0)).cast("int")


def latest_batch(listing: DataFrame, domains: dict[str, list[str] | None] | None = None) -> DataFrame:
    """Rows of the newest batch of each feed.

    ``domains`` names the columns that tell feeds apart and the values each may take (None: any,
    NULL included); by default each shop's feeds, or the feeds where the table has no shops. Ids count
    by the time they stand for, so dates and epoch seconds may be mixed; unreadable ids come before all
    others. The list of newest batches has one row per combination of domain values, shops and feeds:
    its broadcast is safe at any size of the listing.
    """
    domains = domains or {**({"account_name": None} if "account_name" in listing.columns else {}), "source": FEEDS}
    for column, values in domains.items():
        if values is not None:
            listing = listing.where(F.col(column).isin(values))
    newest = combine(listing, [*domains, "batch_id"]).where("batch_id is not null")
    newest = newest.groupBy(*domains).agg(F.max(F.struct(batch_seconds("batch_id").alias("at"), "batch_id")).alias("_b"))
    newest = newest.select(*domains, F.col("_b.batch_id").alias("batch_id"))
    matched = listing["batch_id"] == newest["batch_id"]
    for column, values in domains.items():
        matched &= listing[column].eqNullSafe(newest[column]) if values is None else listing[column] == newest[column]
    return listing.join(F.broadcast(newest), matched, "left_semi")


def merge_feeds(
    listing: DataFrame,
    key: str | list[str],
    attrs: list[str],
    feeds: list[str] = FEEDS[:3],
    order: tuple[str, ...] = ("rank",),
    fill: tuple[str, ...] = (),
    strict_parity: bool = True,
) -> DataFrame:
    """Merge feeds into one row per product with one shuffle and no join.

    Attributes come from the first feed that lists the product, at its best rank, rows without a rank last; each feed adds
    its rank column. The first feed gives its best rank; the others their last (largest) one, as in
    the source system, or their best with ``strict_parity=False``. ``fill`` names attributes that,
    while blank, take the best-ranked value of the later feeds in turn.
    """
    keys = [key] if isinstance(key, str) else key
    rows = require(listing.where(F.col("source").isin(feeds)), keys)
    rows = rows.withColumn("_pos", feed_position("source", feeds))
    place = order_key(*order)
    in_feed = lambda feed, value: F.when(F.col("source") == feed, value)

    aggs = [F.min("_pos").alias("_first"), F.min_by(F.struct(*attrs), order_key("_pos", *order)).alias("_row")]
    for i, feed in enumerate(feeds):
        pick_rank = F.max if strict_parity and i > 0 else F.min
        aggs.append(pick_rank(in_feed(feed, F.col("rank"))).alias(f"{feed}_rank"))
    if "promotion_type" in rows.columns:
        promo = F.max_by("promotion_type", in_feed("promotion", newest_key(*order))) if strict_parity else F.min_by("promotion_type", in_feed("promotion", place))
        aggs.append(promo.alias("promotion_type"))
    for attr in fill:
        for feed in feeds[1:]:
            has_value = (F.col("source") == feed) & blank_to_null(attr).isNotNull()
            aggs.append(F.min_by(attr, F.when(has_value, place)).alias(f"_{attr}_{feed}"))
    merged = rows.groupBy(*keys).agg(*aggs)

    names = F.array(*[F.lit(f) for f in feeds])
    out = [*keys, F.element_at(names, F.col("_first")).alias("page_type")]
    for attr in attrs:
        value = F.col(f"_row.{attr}")
        if attr in fill:
            value = F.coalesce(blank_to_null(value), *[F.col(f"_{attr}_{feed}") for feed in feeds[1:]])
        out.append(value.alias(attr))
    out += [F.col(f"{feed}_rank") for feed in feeds]
    if "promotion_type" in rows.columns:
        out.append(F.col("promotion_type"))
    return merged.select(*out)


def dup_count(listing: DataFrame, key: str, feeds: list[str] = FEEDS[:3]) -> DataFrame:
    """Rows loaded, unique products and the difference."""
    rows = listing.where(F.col("source").isin(feeds) & blank_to_null(key).isNotNull())
    n, k = F.count(F.lit(1)), F.countDistinct(key)
    return rows.agg(n.alias("loaded"), k.alias("unique_keys"), (n - k).alias("duplicates"))


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in the given (total) order.

    ``row_number() = 1`` is cut inside each map task before the shuffle, so a hot key sends one
    row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*nulls_last(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column | str], k: int, name: str) -> DataFrame:
    """Rank 1..k per group; rows beyond k are cut before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*nulls_last(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def rank_rows(df: DataFrame, keys: list[str], order: list[Column | str], k: int | None, name: str) -> DataFrame:
    """Rank per group: of all rows, or of the first ``k`` where the caller asks for no more."""
    if k is None:
        return number_rows(df, keys, order, name).withColumn(name, F.col(name).cast("int"))
    return top_per_group(df, keys, order, k, name)


def assign_rank(df: DataFrame, keys: list[str], order: list[Column | str], cap: int | None = None) -> DataFrame:
    """Sequential rank in the batch, of all rows unless a ``cap`` is given."""
    return rank_rows(df, keys, order, cap, "assigned_rank")


def section_rank(df: DataFrame, section: list[str], order: list[Column | str], k: int | None = None) -> DataFrame:
    """Rank within a promotion section, of all rows unless ``k`` is given."""
    return rank_rows(df, section, order, k, "promotion_rank")


def page_order(position: Column | str) -> Column:
    """Position attribute as a number; missing or unreadable -> 999 (last)."""
    return F.coalesce(F.trim(col(position)).try_cast("int"), F.lit(999))


def next_rank(df: DataFrame, rank: str = "rank", by: list[str] | None = None) -> DataFrame:
    """Where the next part's ranks start: MAX(rank) + 1, or 1."""
    grouped = df.groupBy(*by) if by else df
    return grouped.agg((F.coalesce(F.max(rank), F.lit(0)) + 1).cast("bigint").alias("next_rank"))


def number_rows(df: DataFrame, by: list[str], order: list[Column | str], name: str) -> DataFrame:
    """Row numbers 1.. per group in a total order, with no group in one task; NULL is a group like others.

    Rows are range-partitioned by group and order, which splits a large group over many
    partitions, sorted there and written once with their place. A group's first place in a
    partition and its rows in earlier partitions, one row per group and partition, turn places into numbers: the
    rows themselves are shuffled once.
    """
    keys = nulls_last([*by, *order])
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = cut_lineage(placed, "numbering").withColumn("_part", F.shiftrightunsigned("_at", 33))
    sizes = placed.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("_start", F.coalesce(before, F.lit(0)) - F.col("_first") + 1).drop("_first", "_n")
    starts = starts.withColumnsRenamed({c: f"_by_{c}" for c in by}).withColumnRenamed("_part", "_of")
    match = F.col("_part") == F.col("_of")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return placed.join(starts, match).withColumn(name, F.col("_at") + F.col("_start")).drop("_at", "_part", "_of", "_start", *[f"_by_{c}" for c in by])


def continue_rank(
    first: DataFrame, second: DataFrame, by: list[str], order: list[str], all_batches: bool = False
) -> DataFrame:
    """Rank the second part after the end of the first.

    The offset is the first part's largest rank in the same group, NULL being a group like others, or over everything with
    ``all_batches``.
    """
    ranked = number_rows(second, by, order, "_number")
    if all_batches:
        ranked = ranked.withColumn("_offset", first.agg(F.max("rank")).scalar())
    else:
        ranked = join_one(ranked, first.groupBy(*by).agg(F.max("rank").alias("_offset")), by, null_safe=True)
    rank = F.col("_number") + F.coalesce(F.col("_offset"), F.lit(0))
    return ranked.withColumn("continued_rank", rank.cast("bigint")).drop("_number", "_offset")


def feed_order(merged: DataFrame, feeds: list[str] = FEEDS[:3]) -> DataFrame:
    """Order of first appearance: feed by feed, each by its rank."""
    rank = F.coalesce(
        *[F.when(F.col("page_type") == f, F.col(f"{f}_rank")) for f in feeds], F.lit(None).cast("int")
    )
    return merged.orderBy(feed_position("page_type", feeds), rank.asc_nulls_last())


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, columns matched by name."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def merge_selectors(
    stored: DataFrame, default: DataFrame, keys: list[str], value: str, db_first: bool = True, dedupe: bool = True
) -> DataFrame:
    """Concatenate two priority lists, the first one ahead, each value once.

    Both have (keys, value, priority). The result is numbered again as ``position``.
    """
    head, tail = (stored, default) if db_first else (default, stored)
    both = head.withColumn("_list", F.lit(0)).unionByName(tail.withColumn("_list", F.lit(1)))
    if dedupe:
        both = dedupe_first(both, [*keys, value], ["_list", "priority"])
    w = Window.partitionBy(*keys).orderBy("_list", "priority", value)
    return both.withColumn("position", F.row_number().over(w)).drop("_list", "priority")


# Container attributes that mark advertisements and widgets.
WIDGET_MARKS = ["loom-desktop", "sb-themed", "multi-brand", "FEATURED_ASINS_LIST"]
COMPONENT_TYPE = "s-messaging-widget"
COMPONENT_ID = "VideoLandscapeCarouselWidget"
# Off-category titles.
VIDEO_TITLE = "prime video"
BOOK_WORDS = ["Paperback", "Kindle", "Audible", "Hardcover", "Audio CD", "audiobook"]


def exclude_reason(widget: Column | str, comp_type: Column | str, comp_id: Column | str) -> Column:
    """First mark that excludes a container, or NULL for a product."""
    reason = None
    for mark in WIDGET_MARKS:
        test = col(widget).contains(mark)
        reason = F.when(test, F.lit(mark)) if reason is None else reason.when(test, F.lit(mark))
    return reason.when(col(comp_type) == COMPONENT_TYPE, F.lit(COMPONENT_TYPE)).when(
        col(comp_id).contains(COMPONENT_ID), F.lit(COMPONENT_ID)
    )


def off_category(name: Column | str) -> Column:
    """'Prime Video', 'Book' or NULL."""
    return F.when(F.lower(col(name)).contains(VIDEO_TITLE), F.lit("Prime Video")).when(
        col(name).rlike("(?i)" + "|".join(BOOK_WORDS)), F.lit("Book")
    )


def valid_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither NULL nor empty."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in which every named text is present."""
    for c in cols:
        df = df.where(blank_to_null(c).isNotNull())
    return df


def dropped_by_require(df: DataFrame, cols: list[str]) -> DataFrame:
    """How many rows ``require`` keeps and drops."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & blank_to_null(c).isNotNull()
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def duplicate_trace(df: DataFrame, code: str, name: str, page: str, url: str, pos: str, n: int) -> DataFrame:
    """First n repeats of a product code in page order, each with its first appearance.

    The first appearance is an aggregate (combined before the shuffle) joined back to the rows,
    not a window, so that a code holding much of the table is spread over the join's tasks.
    """
    rows = df.where((F.trim(F.col(code)) != "") & (F.trim(F.col(name)) != ""))
    first = (
        rows.groupBy(code)
        .agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(page, pos, url, name), F.struct(page, pos)).alias("_f"))
        .where("_n > 1")
    )
    later = join_one(rows, first, [code], "inner").where(F.struct(page, pos) > F.struct("_f." + page, "_f." + pos))
    return (
        later.select(
            F.col(code).alias("code"),
            F.col("_f." + page).alias("first_page"),
            F.col("_f." + url).alias("first_url"),
            F.col("_f." + name).alias("first_name"),
            F.col(page).alias("duplicate_page"),
            F.col(pos).alias("duplicate_position"),
            F.col(url).alias("duplicate_url"),
            F.col(name).alias("duplicate_name"),
            (F.col(name) == F.col("_f." + name)).alias("same_name"),
            (F.col(page) - F.col("_f." + page)).alias("pages_apart"),
        )
        .orderBy("duplicate_page", "duplicate_position", "code")
        .limit(n)
    )


def page_mismatch(df: DataFrame, by: list[str], page: str, order: list[str], index: str, per_page: int = 16) -> DataFrame:
    """Pages whose first item's index lies outside ((page-1)*per_page + 1 .. page*per_page)."""
    first = df.groupBy(*by, page).agg(F.min_by(index, F.struct(*order)).alias("first_index"))
    lo = ((F.col(page) - 1) * per_page + 1).cast("bigint")
    hi = (F.col(page) * per_page).cast("bigint")
    return first.withColumn("expected_min", lo).withColumn("expected_max", hi).where(
        ~F.col("first_index").between(F.col("expected_min"), F.col("expected_max"))
    )


def rows_per_page(df: DataFrame, page: str = "page_number") -> DataFrame:
    return df.groupBy(page).agg(F.count(F.lit(1)).alias("collected"))


def low_yield(df: DataFrame, by: list[str], page: str, min_rows: int = 16, first_pages: int | None = None) -> DataFrame:
    """Pages with fewer rows than a full page, of all pages unless only the first ones are asked for."""
    counts = (df if first_pages is None else df.where(F.col(page) <= first_pages)).groupBy(*by, page).agg(F.count(F.lit(1)).alias("collected"))
    return counts.where(F.col("collected") < min_rows)


def coverage(df: DataFrame, page: str = "page_number", per_page: int = 16) -> DataFrame:
    """Per page: rows expected, rows missing, and a label."""
    missing = F.lit(per_page) - F.col("collected")
    label = F.when(missing == 0, F.lit("OK")).otherwise(F.concat(F.lit("Missing "), missing.cast("string")))
    return rows_per_page(df, page).select(
        page, "collected", F.lit(per_page).cast("bigint").alias("expected"), missing.alias("missing"), label.alias("status")
    )


def coverage_total(df: DataFrame, page: str = "page_number", per_page: int = 16, cap: int | None = None) -> DataFrame:
    """Expected rows, pages x per_page or at most a given ``cap``, against the rows collected."""
    pages, n = F.countDistinct(page), F.count(F.lit(1))
    expected = pages * per_page if cap is None else F.least(F.lit(cap).cast("bigint"), pages * per_page)
    return df.agg(
        pages.alias("pages"), expected.alias("expected"), n.alias("actual"), (expected - n).alias("difference")
    )


def duplicate_report(df: DataFrame, name: str, page: str, n: int) -> DataFrame:
    """The n names found most often, NULL among them, and the pages they were found on.

    Long form, one row per name and page with the number of rows there, ordered by page within the
    name: the page list of a name that holds a third of the table would not fit one cell.
    ``pack_pages`` renders it as text for reports of ordinary size.
    """
    pages = df.groupBy(name, page).agg(F.count(F.lit(1)).alias("rows_on_page"))
    counts = pages.groupBy(name).agg(F.sum("rows_on_page").alias("page_count")).where("page_count > 1")
    top = counts.orderBy(F.desc("page_count"), F.asc(name)).limit(n)
    # n rows at most: the broadcast is bounded by the report's length.
    top = top.withColumnRenamed(name, "_name")
    return pages.join(F.broadcast(top), F.col(name).eqNullSafe(F.col("_name"))).drop("_name")


def pack_pages(report: DataFrame, name: str, page: str) -> DataFrame:
    """One row per name: pages in order as text, repeats included."""
    cell = F.array_repeat(F.col(page).cast("string"), F.col("rows_on_page").cast("int"))
    packed = F.sort_array(F.collect_list(F.struct(page, cell.alias("_cell"))))
    return report.groupBy(name, "page_count").agg(
        F.array_join(F.flatten(F.transform(packed, lambda x: x["_cell"])), ", ").alias("pages")
    )


def top_reviews(
    df: DataFrame, product: str, text: str, order: list[str], n: int, min_len: int | None = None, style: str = "ordinal"
) -> DataFrame:
    """First n review texts per product, packed.

    ordinal: '1-text, 2-text'   labelled: 'review1-text, review2-text'   bar: 'text | text'
    Texts shorter than ``min_len``, where it is given, are skipped first; at most n texts reach a group.
    """
    rows = df.where(F.col(text).isNotNull() if min_len is None else F.length(F.trim(F.col(text))) >= min_len)
    rows = top_per_group(rows, [product], order, n, "_rn").select(product, "_rn", F.trim(F.col(text)).alias("_t"))
    ordered = F.sort_array(F.collect_list(F.struct("_rn", "_t")))
    prefix = {"ordinal": F.lit(""), "labelled": F.lit("review"), "bar": None}[style]
    if prefix is None:
        packed = F.array_join(F.transform(ordered, lambda x: x["_t"]), " | ")
    else:
        packed = F.array_join(
            F.transform(ordered, lambda x: F.concat(prefix, x["_rn"].cast("string"), F.lit("-"), x["_t"])), ", "
        )
    return rows.groupBy(product).agg(F.count(F.lit(1)).alias("reviews"), packed.alias("review_text"))

"""Price backfill of the unified table from listing feeds."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.order import order_key
from shelfwise.functions.clock import batch_seconds, crawl_seconds
from shelfwise.functions.money import price_number
from shelfwise.functions.text import blank_to_null
from shelfwise.operators.skew import combine, join_one
from shelfwise.operators.nearest import HOUR, band_nearest, nearest_batch
from shelfwise.session import cut_lineage

PRICES = ["final_sku_price", "original_sku_price"]
BAND_REACH = 48 * HOUR


@dataclass(frozen=True)
class AccountRule:
    """How one shop's missing prices are found.

    chain:   feeds in priority order and the price columns each may give
    by_name: fall back to the product name where the chosen batch has no row of the URL
    band:    feeds tried 24 to 48 hours away, after the chain
    band_on: key of that step
    probe:   'detail' = batch of the detail row crawled at the same time, 'crawl' = crawl time
    savings: recompute savings after the update
    """

    account: str
    chain: dict[str, list[str]]
    band: dict[str, list[str]]
    band_on: str
    probe: str
    by_name: bool = False
    savings: bool = False
    need_detail: bool = False
    hours: int = 48


# The three shops.
RULES = [
    AccountRule(
        "Amazon",
        chain={"main": PRICES, "bsr": PRICES[:1]},
        band={"main": PRICES, "bsr": PRICES[:1]},
        band_on="retailer_sku_name",
        probe="detail",
        by_name=True,
        savings=True,
    ),
    AccountRule(
        "Bestbuy",
        chain={"main": PRICES, "bsr": PRICES, "promotion": PRICES},
        band={"main": PRICES},
        band_on="product_url",
        probe="detail",
        need_detail=True,
    ),
    AccountRule(
        "Walmart",
        chain={"main": PRICES, "bsr": PRICES},
        band={"main": PRICES},
        band_on="product_url",
        probe="crawl",
    ),
]


def null_price_rows(unified: DataFrame, account: str | None = None, rng: tuple[str, str] | None = None) -> DataFrame:
    """Rows lacking a price, optionally of one account and inside an inclusive crawl-time range."""
    rows = unified.where(F.col("final_sku_price").isNull() | F.col("original_sku_price").isNull())
    if account:
        rows = rows.where(F.col("account_name") == account)
    if rng:
        rows = rows.where(F.col("crawl_strdatetime").between(*rng))
    return rows


def one_per_key(df: DataFrame, keys: list[str], values: list[str], prefer: list[str]) -> DataFrame:
    """One row per key, chosen by ``prefer`` (smallest first); combined before the shuffle."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), order_key(*prefer)).alias("_row"))


def match_url_then_name(
    left: DataFrame, feed: DataFrame, batch: str, values: list[str], prefer: list[str], by_name: bool = True
) -> DataFrame:
    """Values of the feed row of the same batch and URL; only where there is none, of the name.

    A URL row counts as found even if its values are NULL. Adds ``_hit`` (struct of values).
    """
    url_rows = one_per_key(feed.where("product_url is not null"), ["batch_id", "product_url"], values, prefer)
    out = join_one(
        left,
        url_rows.select(F.col("batch_id").alias(batch), "product_url", F.col("_row").alias("_hit")),
        [batch, "product_url"],
    )
    if not by_name:
        return out
    name_rows = one_per_key(
        feed.where("retailer_sku_name is not null"), ["batch_id", "retailer_sku_name"], values, prefer
    )
    out = join_one(
        out,
        name_rows.select(F.col("batch_id").alias(batch), "retailer_sku_name", F.col("_row").alias("_by_name")),
        [batch, "retailer_sku_name"],
    )
    return out.withColumn("_hit", F.coalesce("_hit", "_by_name")).drop("_by_name")


def fill_chain(rows: DataFrame, found: str, fields: list[str]) -> DataFrame:
    """Fill each field from the struct column ``found`` where it is still missing."""
    for f in fields:
        rows = rows.withColumn(f"_{f}", F.coalesce(f"_{f}", blank_to_null(F.col(f"{found}.{f}"))))
    return rows.drop(found)


def enrich(left: DataFrame, right: DataFrame, on: list[str], cols: list[str], prefer: list[str]) -> DataFrame:
    """UPDATE ... FROM: keep what is there, else take the right side (one row per key)."""
    row = one_per_key(right, on, cols, prefer)
    out = join_one(left, row, on)
    filled = {c: F.coalesce(F.col(c), F.col(f"_row.{c}")) for c in cols}
    return out.withColumns(filled).drop("_row").select(left.columns)


def _steps(rules: list[AccountRule]) -> Column:
    """Per account: the feeds to look into, in order, and which prices each may give."""
    chain = None
    for rule in rules:
        steps = F.array(
            *[
                F.struct(
                    F.lit(source).alias("source"),
                    F.lit(i).alias("_pos"),
                    *[F.lit(p in fields).alias(f"_chain_{p}") for p in PRICES],
                    *[F.lit(p in rule.band.get(source, [])).alias(f"_band_{p}") for p in PRICES],
                )
                for i, (source, fields) in enumerate(rule.chain.items())
            ]
        )
        test = F.col("account_name") == rule.account
        chain = F.when(test, steps) if chain is None else chain.when(test, steps)
    return chain


def _accounts(rules: list[AccountRule], keep) -> Column:
    return F.col("account_name").isin([r.account for r in rules if keep(r)] or [""])


def find_prices(
    missing: DataFrame, detail: DataFrame, listing: DataFrame, prefer: list[str], rules: list[AccountRule] = RULES,
    few: bool = False, zone: str | None = None,
) -> DataFrame:
    """Prices found for rows that lack one: (id, found_final_sku_price, found_original_sku_price).

    All accounts and feeds go through the same joins: a row is repeated once per feed of its
    account, looked up there, and folded back by id. The number of shuffles therefore does not grow
    with accounts or feeds. ``few`` says that the rows cover a short period: listing rows are then
    cut to the batches and times in question before they are sorted and shuffled. ``zone`` is the zone that dated batch ids are written in.
    """
    by_detail = _accounts(rules, lambda r: r.probe == "detail")
    by_name = _accounts(rules, lambda r: r.by_name)
    band_key = F.when(_accounts(rules, lambda r: r.band_on == "retailer_sku_name"), F.col("retailer_sku_name")).otherwise(
        F.col("product_url")
    )
    sources = sorted({source for rule in rules for source in rule.chain})
    hours = max(rule.hours for rule in rules)

    # A row's detail batch is looked up once, before the row is repeated per feed, by the time the batch id stands for.
    batches = detail.where(by_detail & F.col("crawl_strdatetime").isNotNull())
    batches = batches.groupBy("account_name", "crawl_strdatetime").agg(
        F.max(batch_seconds("batch_id", zone)).alias("_detail_at"), F.lit(True).alias("_has_detail")
    )
    base = missing.where(_accounts(rules, lambda r: True)).select(
        "id", "account_name", "product_url", "retailer_sku_name", "crawl_strdatetime",
        crawl_seconds("crawl_strdatetime").alias("_crawled"), band_key.alias("_band_key"),
    )
    base = join_one(base, batches, ["account_name", "crawl_strdatetime"])
    base = base.where(~_accounts(rules, lambda r: r.need_detail) | F.col("_has_detail"))
    base = base.withColumn("_probe", F.when(by_detail, F.col("_detail_at")).otherwise(F.col("_crawled")))
    base = cut_lineage(base.drop("crawl_strdatetime", "_detail_at", "_has_detail"), "backfill-rows")
    rows = base.select("*", F.explode(_steps(rules)).alias("_step")).select("*", "_step.*").drop("_step")

    feeds = listing.where(_accounts(rules, lambda r: True) & F.col("source").isin(sources)).select(
        "account_name", "source", "batch_id", "product_url", "retailer_sku_name", *PRICES,
        *[c for c in prefer if c not in PRICES],
        crawl_seconds("crawl_strdatetime").alias("_seen"), band_key.alias("_band_key"),
    )
    feeds = cut_lineage(feeds.withColumn("_at", F.when(by_detail, batch_seconds("batch_id", zone)).otherwise(F.col("_seen"))), "backfill-feeds")

    on = ["account_name", "source"]
    near = nearest_batch(rows.where("_probe is not null"), feeds, on, "_probe", "_at", "batch_id", hours)
    # Probes and batches are few next to rows; what is found for them is written once for its three uses.
    near = cut_lineage(near, "backfill-near")
    in_batches = feeds
    if few:
        in_batches = feeds.join(near.select(*on, "batch_id").distinct(), [*on, "batch_id"], "left_semi")
    lookup = lambda key, kept: one_per_key(kept.where(F.col(key).isNotNull()), [*on, "batch_id", key], PRICES, prefer)
    url_rows = lookup("product_url", in_batches).withColumnRenamed("_row", "_by_url")
    name_rows = lookup("retailer_sku_name", in_batches.where(by_name)).withColumnRenamed("_row", "_by_name")
    # Only rows that have a batch to look into go through the joins.
    chained = join_one(rows.where("_probe is not null"), near, [*on, "_probe"], "inner").select(
        "id", *on, "batch_id", "product_url", "retailer_sku_name", "_pos", *[f"_chain_{p}" for p in PRICES]
    )
    chained = join_one(chained, url_rows, [*on, "batch_id", "product_url"])
    chained = join_one(chained, name_rows, [*on, "batch_id", "retailer_sku_name"])
    # A URL row counts as found even where its prices are NULL.
    chained = chained.select("id", "_pos", F.coalesce("_by_url", "_by_name").alias("_hit"), *[f"_chain_{p}" for p in PRICES]).where("_hit is not null")

    in_band = reduce(lambda a, b: a | b, [F.col(f"_band_{p}") for p in PRICES])
    searched = rows.where(in_band & F.col("_band_key").isNotNull())
    in_reach = feeds.where(F.col("_band_key").isNotNull())
    if few:
        edge = lambda pick, shift: base.agg((pick("_crawled") + F.lit(shift)).alias("edge")).scalar()
        in_reach = in_reach.where(F.col("_seen").between(edge(F.min, -BAND_REACH), edge(F.max, BAND_REACH)))
    key = [*on, "_band_key"]
    bands = band_nearest(searched.select(*key, "_crawled"), in_reach, key, "_crawled", "_seen", PRICES, prefer)
    bands = bands.select(*key, "_crawled", F.struct(*PRICES).alias("_near"))
    banded = join_one(searched, bands, [*key, "_crawled"], "inner").select("id", "_pos", "_near", *[f"_band_{p}" for p in PRICES])
    # Both kinds of finds are folded by id together.
    rows = chained.unionByName(banded, allowMissingColumns=True)

    def first(step: str, source: str, price: str) -> Column:
        value = F.col(f"{source}.{price}")
        return F.min_by(value, F.when(F.col(f"_{step}_{price}") & value.isNotNull(), F.col("_pos")))

    return rows.groupBy("id").agg(
        *[F.coalesce(first("chain", "_hit", p), first("band", "_near", p)).alias(f"found_{p}") for p in PRICES]
    )


def apply_backfill(unified: DataFrame, found: DataFrame, savings_accounts: list[str]) -> DataFrame:
    """Keep existing prices, fill missing ones, recompute savings where both are then known.

    Complete rows pass by without a shuffle; only rows that lack a price are joined.
    """
    lacks = F.col("final_sku_price").isNull() | F.col("original_sku_price").isNull()
    out = unified.where(lacks).join(found, "id", "left")
    touched = reduce(lambda a, b: a | b, [F.col(f"found_{p}").isNotNull() for p in PRICES])
    new = {p: F.coalesce(F.col(p), F.col(f"found_{p}")) for p in PRICES}
    difference = price_number(new["original_sku_price"]) - price_number(new["final_sku_price"])
    text = F.concat(
        F.when(difference < 0, F.lit("-$")).otherwise(F.lit("$")), F.abs(difference).cast("decimal(12,2)").cast("string")
    )
    recompute = touched & F.col("account_name").isin(savings_accounts) & difference.isNotNull()
    columns = dict(new)
    if "savings" in unified.columns:
        columns["savings"] = F.when(recompute, text).otherwise(F.col("savings"))
    columns["backfilled"] = touched
    filled = out.withColumns(columns).select(*unified.columns, "backfilled")
    return unified.where(~lacks).withColumn("backfilled", F.lit(False)).unionByName(filled)


def backfill_prices(
    unified: DataFrame,
    detail: DataFrame,
    listing: DataFrame,
    prefer: list[str],
    rules: list[AccountRule] = RULES,
    rng: tuple[str, str] | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Fill missing prices of every account; the result has all rows and a ``backfilled`` flag.

    Empty price texts count as missing. ``rng`` limits the rows that are filled, which gives a
    first pass over a priority period; a second pass without it does the rest and leaves the
    filled rows as they are.
    """
    clean = lambda df: df.withColumns({p: blank_to_null(p) for p in PRICES})
    unified, listing = clean(unified), clean(listing)
    missing = null_price_rows(unified, rng=rng)
    found = find_prices(missing, detail, listing, prefer, rules, few=rng is not None, zone=zone)
    return apply_backfill(unified, found, [r.account for r in rules if r.savings])


def backfill_phases(
    unified: DataFrame, detail: DataFrame, listing: DataFrame, prefer: list[str],
    phases: list[tuple[str, str] | None], rules: list[AccountRule] = RULES,
) -> DataFrame:
    """Run the backfill for each phase (a range, or None for everything) in turn.

    A phase ends with a written table, as the source system commits it; the next one starts there.
    """
    out = unified
    for i, rng in enumerate(phases):
        out = backfill_prices(out, detail, listing, prefer, rules, rng).drop("backfilled")
        if i + 1 < len(phases):
            out = cut_lineage(out, "backfill-phase")
    return out


def backfill_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per account: rows updated, rows with a missing price before and after, and failed rows: nothing was found for them."""
    lacks = F.col("final_sku_price").isNull() | F.col("original_sku_price").isNull()
    no = F.lit(False)
    both = before.select("account_name", lacks.alias("_old"), no.alias("_new"), no.alias("_up")).union(
        after.select("account_name", no.alias("_old"), lacks.alias("_new"), F.col("backfilled").alias("_up"))
    )
    return both.groupBy("account_name").agg(
        F.count_if("_old").alias("missing_before"), F.count_if("_up").alias("updated"), F.count_if("_new").alias("missing_after"),
        (F.count_if("_old") - F.count_if("_up")).alias("failed"),
    )


def backfill_latest(
    unified: DataFrame, detail: DataFrame, listing: DataFrame, accounts: str | list[str], prefer: list[str], zone: str | None = None
) -> DataFrame:
    """Newest batch only: listing prices into the detail rows, those into the newest unified rows.

    The newest batch is each account's own, by the time its id stands for, so dated and epoch ids may be mixed; ``zone`` is that
    of dated ids. Returns the unified rows of the newest crawl of each account, prices filled.
    """
    accounts = [accounts] if isinstance(accounts, str) else accounts
    clean = lambda df: df.withColumns({p: blank_to_null(p) for p in PRICES})
    unified, detail, listing = clean(unified), clean(detail), clean(listing)
    own = lambda df, column: df.where(F.col("account_name").isin(accounts) & F.col(column).isNotNull())

    def newest(df: DataFrame, column: str, at: Column) -> DataFrame:
        last = combine(df, ["account_name", column]).groupBy("account_name").agg(F.max(F.struct(at.alias("at"), column)).alias("_last"))
        # One row per account, whose names are given.
        last = last.select(F.col("account_name").alias("_account"), F.col(f"_last.{column}").alias("_newest"))
        return df.join(F.broadcast(last), (F.col("account_name") == F.col("_account")) & (F.col(column) == F.col("_newest")), "left_semi")

    batch_at = batch_seconds("batch_id", zone)
    feed = lambda source: newest(own(listing, "batch_id").where(F.col("source") == source), "batch_id", batch_at)
    on = ["account_name", "product_url"]
    filled = enrich(newest(own(detail, "batch_id"), "batch_id", batch_at), feed("main"), on, PRICES, prefer)
    filled = enrich(filled, feed("bsr"), on, PRICES[:1], prefer)
    last = newest(own(unified, "crawl_strdatetime"), "crawl_strdatetime", F.col("crawl_strdatetime"))
    return enrich(last, filled, on, PRICES, ["crawl_strdatetime", *PRICES])

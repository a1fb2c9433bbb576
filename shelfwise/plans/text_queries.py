"""Scalar functions over texts rendered from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import clock, locale, models, money, text, urls
from shelfwise.plans.registry import query
from shelfwise.plans.views import CHECK_TOKENS, PART_PRICE, SPARK_TOKENS, _expand, check_sql, view

HOST = "https://shop.example.com"
PART, EVENTS = ("part", "p_partkey"), ("events", "event_id")
AMOUNT = "cast(cast(value as decimal(12,2)) as string)"
LABEL = "cast(user_id as string)"


def scalar(
    name: str, table: tuple[str, str], inputs: dict[str, str], out: Callable[[], dict[str, Column]], sql: dict[str, str]
) -> None:
    """Register a query that renders ``inputs`` per row and applies functions to them."""
    source, key = table

    def plan(spark, folder):
        df = spark.read.parquet(f"{folder}/{source}.parquet")
        df = df.selectExpr(key, *[f"{_expand(e, SPARK_TOKENS)} as {c}" for c, e in inputs.items()])
        return df.select(key, *[value.alias(c) for c, value in out().items()])

    rendered = ", ".join(f"{_expand(e, CHECK_TOKENS)} as {c}" for c, e in inputs.items())
    columns = ", ".join(f"{e} as {c}" for c, e in sql.items())
    query(name, f"with t as (select {key}, {rendered} from {source}) select {key}, {columns} from t")(plan)


def found(c: str, pattern: str, group: int = 0) -> str:
    """First match or NULL, for the checking engine."""
    return f"nullif(regexp_extract({c}, '{pattern}', {group}), '')"


# --- prices -------------------------------------------------------------------------------------

scalar(
    "us_price", PART,
    {"t": f"case p_size % 4 when 0 then 'Now $' || cast({PART_PRICE} as string) when 1 then 'Was $1,' || "
          "cast(p_size + 100 as string) || ' today' when 2 then 'call for price' else null end"},
    lambda: {"price": money.us_price("t")},
    {"price": found("t", r"\$[\d,]+\.?\d*")},
)
scalar(
    "repair_price", PART,
    {"t": "case p_size % 5 when 0 then '$1,' || cast(p_size + 100 as string) || ' 99' when 1 then ' $' || "
          "cast(p_size + 10 as string) || '  00 each' when 2 then '$238.00' when 3 then ' free   gift ' else '' end"},
    lambda: {"price": money.repair_price("t")},
    {"price": r"case when regexp_matches(t, '\$\s*(\d[\d,]*)\s+(\d{2})') then '$' || "
              r"replace(regexp_extract(t, '\$\s*(\d[\d,]*)\s+(\d{2})', 1), ',', '') || '.' || "
              r"regexp_extract(t, '\$\s*(\d[\d,]*)\s+(\d{2})', 2) else nullif(trim(regexp_replace(t, '\s+', ' ', 'g')), '') end"},
)
scalar(
    "price_number", PART,
    {"t": "case p_size % 3 when 0 then '$1,' || cast(p_size + 100 as string) || '.50 now' when 1 then "
          "'from ' || cast(p_size as string) else 'none' end"},
    lambda: {"amount": money.price_number("t")},
    {"amount": r"try_cast(nullif(regexp_extract(regexp_replace(t, '[$,]', '', 'g'), '\d+\.?\d*'), '') as decimal(12,2))"},
)
scalar(
    "savings_amount", PART,
    {"t": "case p_size % 3 when 0 then 'Save $1,' || cast(p_size + 100 as string) when 1 then 'Save $' || "
          "cast(p_size as string) || '.25' else 'Sale' end"},
    lambda: {"saved": money.savings_amount("t")},
    {"saved": found("t", r"\$[\d,]+(?:\.\d{2})?")},
)
scalar(
    "savings", EVENTS,
    {"f": f"case when event_id % 5 = 0 then null else '$' || {AMOUNT} end",
     "o": "case when event_id % 4 = 0 then '' else '$' || cast(event_id % 90 as string) || '.99' end"},
    lambda: {"saved": money.savings("f", "o")},
    {"saved": "case when try_cast(replace(o, '$', '') as decimal(12,2)) - try_cast(replace(f, '$', '') as decimal(12,2)) > 0 "
              "then '$' || cast(cast(try_cast(replace(o, '$', '') as decimal(12,2)) - "
              "try_cast(replace(f, '$', '') as decimal(12,2)) as decimal(12,2)) as varchar) end"},
)
SAVED = {
    "f": f"'$' || {AMOUNT}",
    "o": "case when event_id % 6 = 0 then null else '$' || cast(cast(value as decimal(12,2)) + cast(5 as decimal(12,2)) as string) end",
    "s": "case event_id % 4 when 0 then '$5.00' when 1 then '$4' when 2 then 'five' else '' end",
}
scalar(
    "savings_ok", EVENTS, SAVED,
    lambda: {"ok": money.savings_ok("f", "o", "s")},
    {"ok": "o is null or s = '' or coalesce(try_cast(replace(s, '$', '') as decimal(18,4)) = 5, false)"},
)
scalar(
    "money_display", PART,
    {"v": f"case when p_size % 2 = 0 then {PART_PRICE} else cast(p_size * 1000 as decimal(12,2)) end"},
    lambda: {"shown": money.money("v")},
    {"shown": "case when v = floor(v) then format('{:,}', cast(v as bigint)) else format('{:,}', cast(floor(v) as bigint)) || "
              "right(cast(v as varchar), 3) end"},
)
scalar(
    "range_gate", PART,
    {"v": "case when p_size % 3 = 0 then cast(p_retailprice * 100 as decimal(12,2)) else cast(p_size as decimal(12,2)) / 20 end"},
    lambda: {"kept": money.range_gate(F.col("v").cast("decimal(12,2)"))},
    {"kept": "case when cast(v as decimal(12,2)) between 1 and 50000 then cast(v as decimal(12,2)) end"},
)

# --- counts -------------------------------------------------------------------------------------

COUNTED = {
    "t": "case event_id % 6 when 0 then cast(event_id as string) || '+' when 1 then cast(event_id % 90 as string) || '.5k' "
         "when 2 then '1,' || lpad(cast(event_id % 1000 as string), 3, '0') || '+ bought' when 3 then '12K' "
         "when 4 then 'many' else null end"
}
scalar(
    "count_suffix", EVENTS, COUNTED,
    lambda: {"n": text.count_suffix("t")},
    {"n": r"case when regexp_matches(replace(lower(t), ',', ''), '[\d.]+k') then "
          r"cast(trunc(try_cast(regexp_extract(replace(lower(t), ',', ''), '([\d.]+)k', 1) as double) * 1000) as bigint) else "
          r"try_cast(nullif(regexp_extract(replace(t, ',', ''), '(\d+)', 1), '') as bigint) end"},
)
scalar(
    "purchase_count", EVENTS,
    {"t": "case event_id % 5 when 0 then cast(event_id % 40 as string) || 'K+ bought in past month' when 1 then "
          "cast(event_id % 900 as string) || '+ bought in past week' when 2 then cast(event_id % 9 as string) || '.5k+ sold' "
          "when 3 then 'none' else cast(event_id as string) || ' bought' end"},
    lambda: {"n": text.purchase_count("t"), "n_k_anywhere": text.purchase_count("t", k_anywhere=True)},
    {"n": r"format('{:,}', cast(floor(try_cast(nullif(regexp_extract(t, '([\d.]+)', 1), '') as double) * "
          r"case when regexp_matches(t, '^[^\d.]*[\d.]+[Kk]') then 1000 else 1 end) as bigint))",
     "n_k_anywhere": r"format('{:,}', cast(floor(try_cast(nullif(regexp_extract(t, '([\d.]+)', 1), '') as double) * "
                     r"case when upper(t) like '%K%' then 1000 else 1 end) as bigint))"},
)
scalar(
    "first_int", EVENTS,
    {"t": "case when event_id % 4 = 0 then 'none left' else 'only ' || cast(event_id % 50 as string) || ' left of 90' end"},
    lambda: {"n": text.first_int("t")},
    {"n": found("t", r"(\d+)", 1)},
)
scalar(
    "review_count", EVENTS,
    {"p": "case when event_id % 4 = 0 then 'no reviews' else '(1,' || lpad(cast(event_id % 1000 as string), 3, '0') || ' reviews)' end",
     "k": "case when event_id % 3 = 0 then cast(event_id % 30 as string) || '.5k reviews' else cast(event_id as string) || ' Review' end",
     "r": "'1,' || lpad(cast(event_id % 1000 as string), 3, '0') || ' ratings'"},
    lambda: {"paren": text.review_count("p", "paren"), "suffix": text.review_count("k", "suffix"),
             "plain": text.review_count("r", "plain")},
    {"paren": r"replace(" + found("p", r"(?i)\(([\d,]+)\s*reviews?\)", 1) + ", ',', '')",
     "suffix": r"case when k like '%k %' then cast(cast(trunc(try_cast(regexp_extract(k, '([\d.]+)k', 1) as double) * 1000) as bigint) "
               r"as varchar) else regexp_extract(k, '(\d+)', 1) end",
     "plain": found("r", r"([\d,]+)", 1)},
)
scalar(
    "int_text", EVENTS,
    {"t": "case event_id % 3 when 0 then '1,' || lpad(cast(event_id % 1000 as string), 3, '0') when 1 then "
          "cast(event_id as string) else 'n/a' end"},
    lambda: {"n": text.int_text("t")},
    {"n": "try_cast(replace(t, ',', '') as int)"},
)
HISTOGRAM = {
    "t": "case event_id % 4 when 0 then '5star:' || cast(event_id as string) || ', 4star:' || cast(user_id as string) || ', 1star:4' "
         "when 1 then '5stars:' || cast(user_id as string) || ' 1star:8' when 2 then 'no stars' else null end"
}
scalar(
    "stars_total", EVENTS, HISTOGRAM,
    lambda: {"n": text.stars_total("t")},
    {"n": r"cast(list_sum([cast(x as bigint) for x in regexp_extract_all(t, ':(\d+)', 1)]) as bigint)"},
)
PCTS = "array(cast(event_id % 80 as int), cast(13 as int), cast(null as int), cast(3 as int), cast(7 as int))"


@query(
    "stars_from_pct",
    "with t as (select event_id, user_id * 37 as total, event_id % 80 as p5 from events) select event_id, '5star:' || "
    "cast((total * p5) // 100 as bigint) || ', 4star:' || cast((total * 13) // 100 as bigint) || ', 3star:0, 2star:' || "
    "cast((total * 3) // 100 as bigint) || ', 1star:' || cast((total * 7) // 100 as bigint) as histogram from t",
)
def stars_from_pct(spark, folder):
    df = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", "user_id * 37 as total", f"{PCTS} as pcts")
    return df.select("event_id", text.stars_text(text.stars_from_pct("total", "pcts"), "comma").alias("histogram"))


scalar(
    "star_count", EVENTS,
    {"span": "case event_id % 4 when 0 then '71% (' || cast(user_id as string) || ')' else cast(event_id % 100 as string) || '%' end",
     "aria": "case event_id % 4 when 1 then cast(event_id as string) || ' ratings are rated 5 stars' else '5 stars' end",
     "total": "case when event_id % 4 = 3 then 0 else user_id end"},
    lambda: {"n": text.star_count("span", "aria", "total")},
    {"n": r"coalesce(try_cast(nullif(regexp_extract(span, '% \((\d+)\)', 1), '') as bigint), "
          r"try_cast(nullif(regexp_extract(aria, '(\d+) ratings are rated', 1), '') as bigint), "
          r"case when total <> 0 then cast(round_even(total * try_cast(regexp_extract(span, '(\d+)%', 1) as bigint) / 100.0, 0) as bigint) end)"},
)


@query(
    "stars_text",
    "select event_id, concat_ws(', ', '5star:' || user_id, '3star:' || (event_id % 9)) as comma, '5stars:' || user_id || "
    "' 4stars:0 3stars:' || (event_id % 9) || ' 2stars:0 1star:0' as space from events",
)
def stars_text(spark, folder):
    df = spark.read.parquet(f"{folder}/events.parquet").selectExpr(
        "event_id", "array(user_id, cast(null as bigint), event_id % 9) as counts"
    )
    return df.select(
        "event_id", text.stars_text("counts", "comma").alias("comma"), text.stars_text("counts", "space").alias("space")
    )


scalar(
    "rating", EVENTS,
    {"a": f"case when event_id % 5 = 0 then 'unrated' else cast(event_id % 5 as string) || '.4 out of 5 stars' end",
     "b": "case event_id % 3 when 0 then '4.7' when 1 then ' 3.9 ' else '5' end"},
    lambda: {"out_of": text.rating("a"), "first": text.rating("a", "first"), "strict": text.rating("b", "strict")},
    {"out_of": found("a", r"([\d.]+)\s*out of", 1), "first": found("a", r"([\d.]+)", 1),
     "strict": r"case when regexp_matches(trim(b), '^\d+\.\d+$') then trim(b) end"},
)

# --- text ---------------------------------------------------------------------------------------

scalar(
    "clean_rank", PART,
    {"t": "case when p_size % 9 = 0 then '' else '#' || cast(p_partkey as string) || ' in ' || p_type || ' (See Top 100 in ' || p_type || ')' end"},
    lambda: {"rank_text": text.clean_rank("t")},
    {"rank_text": r"trim(regexp_replace(nullif(t, ''), '\s*\([^)]*\)', '', 'g'))"},
)
scalar(
    "rank_int", PART,
    {"t": "case when p_size % 9 = 0 then '#x' else ' #' || cast(p_partkey as string) end"},
    lambda: {"rank": text.rank_int("t")},
    {"rank": "try_cast(trim(replace(t, '#', '')) as int)"},
)
scalar(
    "slice_between", PART,
    {"t": "case p_size % 3 when 0 then p_name || ' Prime members get FREE delivery on ' || p_brand || ' Join Prime now' "
          "when 1 then 'Prime members get FREE delivery ' else p_name end"},
    lambda: {"s": text.slice_between("t", "Prime members get FREE delivery", "Join Prime")},
    {"s": "case when contains(t, 'Prime members get FREE delivery') then trim(split_part(substr(t, "
          "instr(t, 'Prime members get FREE delivery')), 'Join Prime', 1)) end"},
)
scalar(
    "screen_size", PART,
    {"a": "case p_size % 3 when 0 then 'Screen size: ' || cast(p_size as string) || '.5 in' when 1 then "
          "cast(p_size as string) || ' In' else 'unknown' end",
     "b": "case when p_size % 2 = 0 then 'svg' || cast(p_size as string) || ' inches class' else 'Large' end"},
    lambda: {"inch": text.screen_size("a", "inch"), "lower_case": text.screen_size("b", "lower"),
             "class": text.screen_size("b", "class")},
    {"inch": found("a", r"(?i)([\d.]+)\s*in", 1) + " || ' inches'", "lower_case": "lower(b)",
     '"class"': f"coalesce({found('b', r'(\d+\s*inches)', 1)}, b)"},
)
scalar(
    "kwh", PART,
    {"t": "case p_size % 3 when 0 then cast(p_partkey as string) || ' kilowatt hours' when 1 then p_name else '' end"},
    lambda: {"kwh": text.kwh("t")},
    {"kwh": f"coalesce({found('t', r'(\d+)', 1)}, nullif(t, ''))"},
)
scalar(
    "recommend", PART,
    {"t": "case when p_size % 5 = 0 then '' else cast(p_size as string) || '%' end"},
    lambda: {"s": text.recommend("t")},
    {"s": "nullif(t, '') || ' would recommend to a friend'"},
)
scalar(
    "sku_status", EVENTS,
    {"r": "case event_id % 3 when 0 then 'Rollback' when 1 then '' else null end",
     "s": "case when event_id % 2 = 0 then 'Sponsored item' end"},
    lambda: {"status": text.sku_status("r", "s")},
    {"status": "case when nullif(r, '') is not null then 'Rollback' when s is not null then 'Sponsored' end"},
)
scalar(
    "order_discounts", EVENTS,
    {"t": "case event_id % 5 when 0 then 'Price when purchased online, Reduced price' when 1 then "
          "'Price when purchased online,  Flash Deal , Reduced price' when 2 then 'Clearance' when 3 then "
          "'Flash Deal, Best seller ' || cast(user_id as string) else null end"},
    lambda: {"d": text.order_discounts("t")},
    {"d": "case event_id % 5 when 0 then 'Reduced price, Price when purchased online' when 1 then "
          "'Flash Deal, Reduced price, Price when purchased online' when 2 then t when 3 then 'Flash Deal' end"},
)
scalar(
    "join_parts", PART,
    {"a": "case when p_size % 3 = 0 then '' else p_name end", "b": "case when p_size % 2 = 0 then null else p_brand end"},
    lambda: {"j": text.join_parts("a", "b")},
    {"j": "nullif(concat_ws(', ', nullif(a, ''), b), '')"},
)
scalar(
    "first_of", PART,
    {"a": "case when p_size % 3 = 0 then ' ' when p_size % 3 = 1 then null else ' ' || p_name end", "b": "p_brand || ' '"},
    lambda: {"item": text.first_of("a", "b")},
    {"item": "coalesce(nullif(trim(a), ''), trim(b))"},
)
scalar(
    "allow_values", PART,
    {"a": "case p_size % 3 when 0 then 'Limited time deal' when 1 then 'Deal' else null end",
     "b": "case p_size % 3 when 0 then 'Amazon''s  Choice: ' || p_brand when 1 then 'Amazon''s pick' else 'Choice' end"},
    lambda: {"listed": text.allow("a", ["Limited time deal"]), "phrases": text.allow_all_of("b", ["Amazon's", "Choice"])},
    {"listed": "case when a = 'Limited time deal' then a end",
     "phrases": "case when contains(b, 'Amazon''s') and contains(b, 'Choice') then b end"},
)
BADGES = (
    "array(case when event_id % 3 = 0 then cast(user_id as string) || '+ bought since yesterday' else ' ' end, "
    "case when event_id % 4 = 0 then 'In ' || cast(user_id as string) || '0 people''s carts' else 'Best seller' end, "
    "case when event_id % 5 = 0 then 'Rollback' else 'Popular pick' end, 'Best seller')"
)


@query(
    "classify_badges",
    "select event_id, case when event_id % 3 = 0 then user_id end as purchased_yesterday, "
    "case when event_id % 4 = 0 then user_id * 10 end as added_to_carts, "
    "case when event_id % 4 <> 0 and event_id % 5 <> 0 then 'Best seller, Popular pick' "
    "when event_id % 4 <> 0 or event_id % 5 = 0 then 'Best seller' else 'Popular pick, Best seller' end as sku_popularity, "
    "case when event_id % 5 = 0 then 'Rollback' end as status_badge from events",
)
def classify_badges(spark, folder):
    df = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", f"{BADGES} as badges")
    return df.select("event_id", text.classify_badges("badges").alias("b")).select("event_id", "b.*")


@query(
    "pad_products",
    "select conv_id, turn, nullif(split_part(text, ' ', 1), '') as p1, case when turn % 2 = 0 then null else nullif(split_part(text, ' ', 2), '') end as p2, "
    "cast(null as varchar) as p3, cast(null as varchar) as p4 from conversations",
)
def pad_products(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet").selectExpr(
        "conv_id", "turn", "array(split_part(text, ' ', 1), case when turn % 2 = 0 then '—' else split_part(text, ' ', 2) end) as a"
    )
    padded = df.select("conv_id", "turn", text.pad("a", 4).alias("p"))
    return padded.select("conv_id", "turn", *[F.col("p")[i].alias(f"p{i + 1}") for i in range(4)])


scalar(
    "clean_markup", ("pages", "page_id"),
    {"t": "html"},
    lambda: {"body": text.clean_markup("t")},
    {"body": r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '<br\s*/?>', ' ', 'g'), "
             r"'<sup[^>]*>(\d+)</sup>', '.\1', 'g'), '<[^>]*>', '', 'g'), '[\s\x0b\x85\p{Z}]+', ' ', 'g'))"},
)
@query(
    "promo_label",
    "select p_partkey, case p_size % 3 when 0 then p_name || ' ' || p_type || ' sale' when 1 then p_name else "
    "p_brand || ' only now' end as label from part",
)
def promo_label(spark, folder):
    df = spark.read.parquet(f"{folder}/part.parquet").selectExpr(
        "p_partkey",
        "case when p_size % 3 = 2 then null else ' ' || p_name end as h",
        "case when p_size % 3 = 0 then p_type || '  sale' end as p",
        "p_brand || ' ' || chr(10) || chr(10) || '  only  now' || chr(10) || p_type as t",
    )
    return df.select("p_partkey", text.promo_label("h", "p", "t").alias("label"))


# --- URLs and models ----------------------------------------------------------------------------

scalar(
    "product_code", EVENTS,
    {"u": "case when event_id % 3 = 0 then 'https://shop.example.com/o/' || cast(user_id as string) else "
          "'https://shop.example.com/x/dp/B' || lpad(cast(user_id as string), 9, '0') || '/ref=a' end"},
    lambda: {"code": urls.product_code("u")},
    {"code": "coalesce(nullif(regexp_extract(u, '/dp/([A-Z0-9]{10})', 1), ''), u)"},
)
scalar(
    "normalize_url", EVENTS,
    {"u": f"case event_id % 6 when 0 then '/ip/TV-' || {LABEL} || '/9?from=/search' when 1 then "
          f"'/sp/track?bt=1&rd=https%3A%2F%2Fshop.example.com%2Fip%2FTV%2F' || {LABEL} || '%3Fa%3Db&z=2' when 2 then "
          f"'https://shop.example.com/ip/TV/' || {LABEL} || '?q=1' when 3 then 'https://shop.example.com/other?id=' || {LABEL} "
          f"when 4 then '' else 'track-' || {LABEL} end"},
    lambda: {"clean": urls.normalize_url("u", HOST)},
    {"clean": "case event_id % 6 when 0 then 'https://shop.example.com' || split_part(u, '?', 1) when 1 then "
              "split_part(url_decode(regexp_extract(u, 'rd=([^&]*)', 1)), '?', 1) when 2 then split_part(u, '?', 1) "
              "else nullif(u, '') end"},
)
scalar(
    "absolute_url", EVENTS,
    {"u": f"case event_id % 4 when 0 then '/p/' || {LABEL} when 1 then 'https://x.example.com/' || {LABEL} when 2 then "
          f"'p/' || {LABEL} else null end"},
    lambda: {"slash": urls.absolute_url("u", HOST), "nonhttp": urls.absolute_url("u", HOST, unless_http=True)},
    {"slash": f"case when u like '/%' then '{HOST}' || u else u end", "nonhttp": f"case when u not like 'http%' then '{HOST}' || u else u end"},
)
MODEL_URL = (
    "case p_partkey % 6 when 0 then 'https://shop.example.com/ip/TV-' || cast(p_size as string) || '-Class-' || p_code || '-Smart/' || "
    "cast(p_partkey as string) when 1 then 'https://shop.example.com/ip/VIZIO-' || p_code || '-08/77' when 2 then "
    "'https://shop.example.com/ip/onn-HDR-1000' || lpad(cast(p_partkey as string), 6, '0') || '/77' when 3 then "
    "'https://shop.example.com/ip/' || p_code || '-AUS' when 4 then 'https://shop.example.com/browse/' || p_code || '/1' else "
    "'https://shop.example.com/ip/plain-words-only/1?x=1' end"
)
CODE = "'UN' || cast(p_size as string) || 'DU' || lpad(cast(p_partkey as string), 6, '0')"
scalar(
    "model_from_url", PART,
    {"u": MODEL_URL.replace("p_code", f"({CODE})"), "code": CODE},
    lambda: {"model": models.model_from_url("u"), "strict_model": models.model_from_url("u", strict=True)},
    {c: "case p_partkey % 6 when 0 then code when 1 then code || '-08' when 2 then '1000' || lpad(cast(p_partkey as string), 6, '0') "
        "when 3 then code end" for c in ("model", "strict_model")},
)
MODEL_NAME = (
    f"case p_partkey % 5 when 0 then p_name || ' TV , ' || {CODE} when 1 then p_name || ' (' || {CODE} || ') - LED, Dolby' when 2 then "
    f"p_name || ' Sound ' || {CODE} || '.' when 3 then p_name else null end"
)
scalar(
    "model_from_name", PART, {"n": MODEL_NAME, "code": CODE},
    lambda: {"model": models.model_from_name("n")},
    {"model": "case when p_partkey % 5 in (0, 1, 2) then code end"},
)
INVALID = (
    "case p_partkey % 9 when 0 then '4K UHD' when 1 then cast(p_size as string) || 'hz' when 2 then '3,840 x 2,160' when 3 then '1080I' "
    f"when 4 then '480p; 720p' when 5 then 'TV (2160p)' when 6 then ' ' when 7 then null else {CODE} end"
)
scalar(
    "is_invalid_model", PART, {"m": INVALID},
    lambda: {"invalid": models.is_invalid_model("m")},
    {"invalid": "p_partkey % 9 <> 8"},
)
scalar(
    "model_cascade", PART,
    {"a": "case when p_size % 4 = 0 then 'Sign in now' when p_size % 4 = 1 then '(SC-' || cast(p_size as string) || ')' else null end",
     "b": f"case when p_size % 3 = 0 then {CODE} else '1080p' end", "u": MODEL_URL.replace("p_code", f"({CODE})"), "n": MODEL_NAME,
     "code": CODE, "size": "p_size"},
    lambda: {"model": models.model("a", "b", "u", "n")},
    {"model": "case when size % 4 = 1 then case when length('(SC-' || size || ')') > 3 then 'SC-' || size end when size % 3 = 0 then code else "
              "coalesce(case p_partkey % 6 when 0 then code when 1 then code || '-08' when 2 then '1000' || "
              "lpad(cast(p_partkey as string), 6, '0') when 3 then code end, case when p_partkey % 5 in (0, 1, 2) then code end) end"},
)

# --- country shops ------------------------------------------------------------------------------

# The amount with a thousands separator, where it has four digits.
GROUPED = "case when length(plain) = 7 then substr(plain, 1, 1) || '{}' || substr(plain, 2) else plain end"
COMMA = "replace(plain, '.', ',')"
EUROPEAN = (
    "case when length(plain) = 7 then substr(plain, 1, 1) || '{}' || replace(substr(plain, 2), '.', ',') "
    "else replace(plain, '.', ',') end"
)
PRICE_TEXT = f"""case country
  when 'it' then case odd when 0 then 'was € ' || plain when 1 then {COMMA} || ' €' when 2 then '€ ' || {EUROPEAN.format('.')}
       when 3 then split_part(plain, '.', 1) || '.' when 4 then '99999' else plain end
  when 'de' then case odd when 0 then split_part(plain, '.', 1) when 1 then {EUROPEAN.format('.')} || ' €' when 2 then '12 Stück' else {COMMA} || '€' end
  when 'fr' then case odd when 0 then 'Achetez d''occasion ' || plain when 1 then {EUROPEAN.format(' ')} || ' €' else {COMMA} || '€' end
  when 'es' then case odd when 0 then '165' when 1 then '9,99€' when 2 then {EUROPEAN.format('.')} || ' €' else {COMMA} || ' €' end
  when 'in' then case odd when 0 then '₹ free' when 1 then '₹1,' || lpad(substr(plain, 1, 2), 2, '0') || ',000' else '₹' || {GROUPED.format(',')} end
  when 'nl' then case odd when 0 then 'gratis' when 1 then {EUROPEAN.format('.')} else {COMMA} || ' €' end
  when 'gb' then case odd when 0 then 'sold out' when 1 then '£' || {GROUPED.format(',')} else '£' || plain end
  when 'usa' then case odd when 0 then plain when 1 then 'Now $' || {GROUPED.format(',')} || ' each' else '$' || plain end
  else case odd when 0 then 'brak' when 1 then 'zł ' || plain when 2 then {GROUPED.format(' ')} || ' PLN' else {COMMA} || ' zł' end end"""
# What each rendering must be read as.
PRICE_READ = """case country
  when 'it' then case odd when 0 then null when 3 then floor(p) when 4 then null else p end
  when 'de' then case odd when 0 then case when length(plain) = 7 then cast(floor(p) / 100 as decimal(12,2)) else floor(p) end when 2 then null else p end
  when 'es' then case odd when 0 then null when 1 then null else p end
  when 'in' then case odd when 0 then null when 1 then 100000 + 1000 * cast(substr(plain, 1, 2) as int) else p end
  when 'nl' then case odd when 0 then null else p end
  else case odd when 0 then null else p end end"""


def _range_sql(value: str) -> str:
    return (
        f"cast(case when country = 'es' and not ({value} between 10 and 10000) then null when country in ('it', 'de', 'fr') and "
        f"not ({value} between 1 and 50000) then null else {value} end as decimal(12,2))"
    )


@query(
    "parse_price",
    check_sql(
        f"select partkey, country, {_range_sql('(' + PRICE_READ + ')')} as price from q", "price_text",
        extra="q as (select *, cast(plain as decimal(12,2)) as p from v_price_text)",
    ),
)
def parse_price(spark, folder):
    rows = view(spark, folder, "price_text").selectExpr("partkey", "country", f"{PRICE_TEXT} as t")
    return rows.select("partkey", "country", locale.parse_price("t", "country").alias("price"))


@query(
    "grouped_price",
    "select p_partkey, cast(case p_size % 3 when 0 then p_size * 1000 + 800 when 2 then p_partkey end as decimal(12,2)) as jp, "
    "cast(case p_size % 3 when 0 then p_size * 1000 + 800.5 when 2 then p_partkey + 0.5 end as decimal(12,2)) as en from part",
)
def grouped_price(spark, folder):
    df = spark.read.parquet(f"{folder}/part.parquet").selectExpr(
        "p_partkey",
        "case p_size % 3 when 0 then '¥' || cast(p_size as string) || ',800' when 1 then '¥12,80' else '￥' || cast(p_partkey as string) end as j",
        "case p_size % 3 when 0 then '$' || cast(p_size as string) || ',800.50' when 1 then '£12,99' else cast(p_partkey as string) || '.5' end as e",
    )
    return df.select("p_partkey", locale.parse_price("j", "jp").alias("jp"), locale.parse_price("e", "en_grouped").alias("en"))


scalar(
    "whole_and_fraction", PART,
    {"w": "case when p_size % 5 = 0 then 'x' else cast(p_size as string) || ',' end", "f": "'8' || cast(p_partkey % 10 as string)"},
    lambda: {"price": locale.parse_price(locale.whole_and_fraction("w", "f"), "it")},
    {"price": "try_cast(nullif(regexp_replace(w, '[^0-9]', '', 'g'), '') || '.' || f as decimal(12,2))"},
)
@query(
    "strip_label",
    "select p_partkey, case when p_size % 4 <> 1 then p_brand end as ships, case p_size % 4 when 1 then null when 2 then 'Amazon' "
    "else p_brand end as sold from part",
)
def strip_label(spark, folder):
    df = spark.read.parquet(f"{folder}/part.parquet").selectExpr(
        "p_partkey",
        "case p_size % 4 when 0 then 'Spedito da ' || p_brand when 1 then 'Fulfilled by' when 2 then 'x Ships From ' || p_brand else p_brand end as a",
        "case p_size % 4 when 0 then 'Verkauft von ' || p_brand when 1 then 'Sold by' when 2 then 'x sold by Amazon EU' else p_brand end as b",
    )
    return df.select(
        "p_partkey", locale.strip_label("a", "ships", "it").alias("ships"), locale.strip_label("b", "sold", "de").alias("sold")
    )


scalar(
    "in_stock", PART,
    {"t": "case p_size % 5 when 0 then 'Attualmente NON disponibile' when 1 then 'Disponibile' when 2 then null when 3 then "
          "'out of stock ' || p_name else 'vedi ' || p_name end"},
    lambda: {"there": locale.in_stock("t", "it")},
    {"there": "not coalesce(regexp_matches(lower(t), 'non disponibile|esaurito|unavailable|out of stock'), false)"},
)
_STOCK_INPUT = (
    "case p_size % 8 when 0 then 'NICHT verfügbar' when 1 then 'Rupture de stock ' || p_name when 2 then null when 3 then 'out of stock' when 4 then 'Agotado, no disponible' when 5 then 'Currently not available' "
    "when 6 then 'auf Lager' else 'nur ' || p_name end"
)
scalar(
    "in_stock_by_country", PART, {"t": _STOCK_INPUT},
    lambda: {cc: locale.in_stock("t", cc) for cc in ("de", "fr", "es", "in")},
    {
        "de": "not coalesce(t in ('NICHT verfügbar', 'out of stock'), false)", "fr": "not coalesce(t like 'Rupture de stock%' or t = 'out of stock', false)",
        "es": "not coalesce(t in ('Agotado, no disponible', 'out of stock'), false)", "in": "not coalesce(t in ('Currently not available', 'out of stock'), false)",
    },
)
_SOLD_INPUT = "case p_size % 4 when 0 then 'Sold by ' || p_brand when 1 then '{}' when 2 then 'x {} ' || p_brand else p_brand end"
_SHIP_INPUT = "case p_size % 4 when 0 then 'Ships from ' || p_brand when 1 then '{}' when 2 then 'x {} ' || p_brand else p_brand end"
scalar(
    "strip_label_by_country", PART,
    {"it_sold": _SOLD_INPUT.format("Venduto da", "venduto da"), "fr_sold": _SOLD_INPUT.format("Vendu par", "vendu par"), "fr_ships": _SHIP_INPUT.format("Expédié par", "expédié par"),
     "de_ships": _SHIP_INPUT.format("Versand durch", "versand durch")},
    lambda: {c: locale.strip_label(c, c[3:], c[:2]) for c in ("it_sold", "fr_sold", "fr_ships", "de_ships")},
    # German labels count at the start only.
    {c: f"case when {c} in ('Venduto da', 'Vendu par', 'Expédié par', 'Versand durch') then null when '{c}' = 'de_ships' and {c} like 'x %' then {c} else regexp_replace({c}, '^(Sold by|Ships from|x [a-zé]+ [a-z]+) ', '') end"
     for c in ("it_sold", "fr_sold", "fr_ships", "de_ships")},
)
scalar(
    "page_in_stock", ("pages", "page_id"),
    {"t": "html || case when page_id % 4 = 0 then '<b>Sold Out</b>' when page_id % 4 = 1 then 'sold out' else '' end"},
    lambda: {"there": locale.page_in_stock("t")},
    {"there": "not regexp_matches(t, 'Out of Stock|Sold Out|Currently unavailable|Temporarily out of stock')"},
)

# --- time ---------------------------------------------------------------------------------------


@query(
    "time_labels",
    "select event_id, strftime(ts, '%Y%m%d_%H%M%S') as batch_id, strftime(ts, '%Y%m%d%H%M%S') || substr(strftime(ts, '%f'), 1, 4) "
    "as strdatetime, strftime(ts, '%Y%m%d%H%M%S') || '0000' as strdatetime_padded, 'w' || extract(week from ts) as week_label, "
    "cast(extract(isoyear from ts) as int) as iso_year from events",
)
def time_labels(spark, folder):
    df = spark.read.parquet(f"{folder}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return df.select(
        "event_id",
        clock.batch_id("ts").alias("batch_id"),
        clock.strdatetime("ts").alias("strdatetime"),
        clock.strdatetime("ts", fraction=False).alias("strdatetime_padded"),
        clock.week_label("ts").alias("week_label"),
        clock.iso_year("ts").alias("iso_year"),
    )


scalar(
    "batch_seconds", EVENTS,
    {"b": "case event_id % 3 when 0 then @batch when 1 then cast(1700000000 + event_id as string) else 'bad' end", "c": "@crawl"},
    lambda: {"batch_at": clock.batch_seconds("b"), "crawled_at": clock.crawl_seconds("c")},
    {"batch_at": "case event_id % 3 when 0 then cast(epoch(strptime(b, '%Y%m%d_%H%M%S')) as bigint) when 1 then cast(b as bigint) end",
     "crawled_at": "cast(epoch(strptime(substr(c, 1, 14), '%Y%m%d%H%M%S')) as bigint)"},
)
scalar(
    "date_display", ("orders", "o_orderkey"),
    {"t": "case when o_orderkey % 7 = 0 then 'unknown date' else cast(cast(o_orderdate as date) as string) || ' 00:00:00' end"},
    lambda: {"day": clock.date_part("t"), "shown": clock.short_date("t")},
    {"day": "split_part(t, ' ', 1)", "shown": "case when o_orderkey % 7 = 0 then 'unknown date' else strftime(cast(split_part(t, ' ', 1) as date), '%b %d') end"},
)

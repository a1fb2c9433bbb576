"""Stored pages to rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.text import clean_markup
from shelfwise.operators import markup as M
from shelfwise.operators import pages as P
from shelfwise.operators.dml import norm_channel
from shelfwise.plans.registry import query

RULES = [
    P.Rule("title", r'(?s)<meta property="og:title" content="([^"]*)"', 1),
    P.Rule("title", r"(?s)<h1>(.*?)</h1>", 2),
    P.Rule("title", r"(?s)<title>(.*?)</title>", 3),
    P.Rule("language", r'<html lang="([^"]*)"', 1),
    P.Rule("language", r'<html xml:lang="([^"]*)"', 2, active=False),
    P.Rule("closing", r"(?s)<footer>([^<]*)<", 1),
    P.Rule("closing", r"(?s)<p>([^<]*)</p>", 2),
]


def _pages(spark, folder, extra: str = ""):
    html = f"html || {extra}" if extra else "html"
    return spark.read.parquet(f"{folder}/pages.parquet").selectExpr("page_id", "url", f"{html} as html")


def _source(extra: str = "") -> str:
    return f"with s as (select page_id, url, html{f' || {extra}' if extra else ''} as html from pages) "


def _cascade(field: str) -> str:
    rules = sorted((r for r in RULES if r.field == field and r.active), key=lambda r: r.priority)
    return "coalesce(" + ", ".join(f"nullif(trim(regexp_extract(html, '{r.pattern}', 1), ' '), '')" for r in rules) + ")"


@query("extract_fields", _source() + f"select page_id, {', '.join(f'{_cascade(f)} as {f}' for f in ('title', 'language', 'closing'))} from s")
def extract_fields(spark, folder):
    return P.extract(_pages(spark, folder), RULES, ["page_id"])


def _rule_table(spark):
    """The rules as a stored table would hold them, with those of another shop."""
    rows = [("shop", r.field, r.pattern, r.priority, r.active) for r in RULES] + [("other", "title", "<nav>(.)", 0, True)]
    return spark.createDataFrame(rows, "mall_name string, data_field string, pattern string, priority int, is_active boolean")


@query(
    "extract_by_rule_table",
    _source() + f"select page_id, {', '.join(f'case when page_id % 7 <> 3 then {_cascade(f)} end as {f}' for f in ('title', 'language', 'closing'))} from s",
)
def extract_by_rule_table(spark, folder):
    """Rules joined as data; one page in seven is of a shop without rules."""
    pages = _pages(spark, folder).withColumn("mall_name", F.expr("case when page_id % 7 = 3 then 'none' else 'shop' end"))
    return P.extract_by_rules(pages, _rule_table(spark), ["title", "language", "closing"], ["page_id"], ["mall_name"])


@query("extract_loaded_rules", _source() + f"select page_id, {', '.join(f'{_cascade(f)} as {f}' for f in ('title', 'language', 'closing'))} from s")
def extract_loaded_rules(spark, folder):
    """Rules read from their table as settings of the plan."""
    rules = P.load_rules(_rule_table(spark), F.col("mall_name") == "shop")
    return P.extract(_pages(spark, folder), rules, ["page_id"])


ITEM = r"(?s)<li><a href=.*?</li>"


@query(
    "containers",
    _source() + f"select page_id, unnest(l) as container, cast(generate_subscripts(l, 1) as int) as position from (select page_id, regexp_extract_all(html, '{ITEM}') as l from s)",
)
def containers(spark, folder):
    return P.containers(_pages(spark, folder), ITEM, ["page_id"])


@query(
    "container_links",
    _source() + r"""select page_id, cast(generate_subscripts(l, 1) as int) as position, regexp_extract(unnest(l), '<a href="([^"]*)"', 1) as link from """
    + f"(select page_id, regexp_extract_all(html, '{ITEM}') as l from s)",
)
def container_links(spark, folder):
    rows = P.containers(_pages(spark, folder), ITEM, ["page_id"])
    link = P.attribute(F.replace(F.col("container"), F.lit("<li>"), F.lit("")), "href")
    return rows.select("page_id", "position", link.alias("link"))


BLOCK = r"(?s)<(?:div|p|li)[^>]*>[^<]*"


@query(
    "exclude_areas",
    _source("case when page_id % 3 = 0 then '<div id=\"sponsored-1\">x' when page_id % 3 = 1 then '<div class=\"productSimilar\">y' else '<div class=\"aplus-v2\">z' end")
    + f"select page_id, position from (select page_id, unnest(l) as c, cast(generate_subscripts(l, 1) as int) as position from (select page_id, regexp_extract_all(html, '{BLOCK}') as l from s)) "
    + "where not regexp_matches(c, '(?i)" + "|".join(P.EXCLUDED_AREAS) + "')",
)
def exclude_areas(spark, folder):
    rows = _pages(
        spark, folder,
        "case when page_id % 3 = 0 then '<div id=\"sponsored-1\">x' when page_id % 3 = 1 then '<div class=\"productSimilar\">y' else '<div class=\"aplus-v2\">z' end",
    )
    return P.exclude_areas(P.containers(rows, BLOCK, ["page_id"]), "container").select("page_id", "position")


NOTICE = (
    "case page_id % 10 when 0 then '<b>Robot or human?</b>' when 1 then '<p>Verify you are human</p>' when 2 then "
    "'<p>Access denied</p><a>Continue shopping</a>' when 3 then '<p>Request was throttled.</p>' when 4 then '<p>Just a moment</p>' "
    "when 5 then '<p>Something went wrong</p>' when 6 then '<div id=\"centerCol\">robot check</div>' when 7 then '<p>Suspicious activity</p>' when 8 then '<p>Ci dispiace. Inserisci i caratteri</p>' else '' end"
)


def _has(c: str, words) -> str:
    return "(" + " or ".join("contains({}, '{}')".format(c, w.replace("'", "''")) for w in words) + ")"


def _status_sql(cc: str, away: str = "false") -> str:
    first, later = (away, "false") if cc in P.HOST_FIRST else ("false", away)
    texts = P.BLOCKED[cc]
    needed = f"contains(b, '{texts.needs}') and " if texts.needs else ""
    return (
        _source(NOTICE)
        + f"select page_id, case when {first} then 'blocked' when " + _has("html", P.NORMAL_MARKS) + " then 'ok' when " + _has("b", P.THROTTLE_TEXTS) + " then 'throttled' when "
        + _has("b", P.CHALLENGE_TEXTS) + " or " + _has("t", P.CHALLENGE_TEXTS) + " then 'challenge' when " + _has("b", P.ROBOT_TEXTS) + " or "
        + _has("t", P.SORRY_TEXTS) + " or " + _has("regexp_replace(b, '(?s)<script.*?</script>|<div[^>]*review[^>]*>.*?</div>|<section[^>]*review[^>]*>.*?</section>|<li[^>]*review[^>]*>.*?</li>|"
               "<span[^>]*review[^>]*>.*?</span>|<p[^>]*review[^>]*>.*?</p>', '', 'g')", P.SORRY_TEXTS) + " then 'robot' when " + _has("t", texts.title)
        + f" or ({needed}not " + _has("b", texts.links) + " and " + _has("b", texts.body) + f") or {later} then 'blocked' when " + _has("t", P.ERROR_TEXTS) + " or "
        + _has("b", P.ERROR_TEXTS) + " then 'error' else 'ok' end as status from (select page_id, url, html, lower(html) as b, "
        + "lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) as t from s)"
    )


STATUS = _status_sql("es")


@query("page_status_it", _status_sql("it"))
def page_status_it(spark, folder):
    return P.with_status(_pages(spark, folder, NOTICE), cc="it").select("page_id", "status")


@query("page_status", STATUS)
def page_status(spark, folder):
    return P.with_status(_pages(spark, folder, NOTICE)).select("page_id", "status")


_AWAY = "not coalesce(contains(lower(case page_id % 4 when 0 then url when 1 then null else 'https://www.Amazon.es/dp/' || page_id end), 'amazon'), false)"


def _visited(spark, folder, cc):
    pages = _pages(spark, folder, NOTICE).withColumn("url", F.expr("case page_id % 4 when 0 then url when 1 then null else 'https://www.Amazon.es/dp/' || page_id end"))
    return P.with_status(pages, cc=cc, url="url").select("page_id", "status")


@query("page_status_host", _status_sql("es", _AWAY))
def page_status_host(spark, folder):
    """Pages of another host are blocked, unless they show a product."""
    return _visited(spark, folder, "es")


@query("page_status_host_it", _status_sql("it", _AWAY))
def page_status_host_it(spark, folder):
    """Pages of another host are blocked, whatever they show."""
    return _visited(spark, folder, "it")


@query("status_counts", f"select status, count(*) as pages from ({STATUS}) group by status")
def status_counts(spark, folder):
    return P.status_counts(_pages(spark, folder, NOTICE))


ELEMENT = r"<nav>|<article>|<footer>|<li>|<p>"


@query(
    "attach_section",
    _source() + "select page_id, position, element, last_value(section ignore nulls) over (partition by page_id order by position) as nearest_section from "
    "(select page_id, position, c as element, case when c in ('<nav>', '<article>', '<footer>') then c end as section from (select page_id, unnest(l) as c, "
    f"cast(generate_subscripts(l, 1) as int) as position from (select page_id, regexp_extract_all(html, '{ELEMENT}') as l from s)))",
)
def attach_section(spark, folder):
    rows = P.containers(_pages(spark, folder), ELEMENT, ["page_id"]).withColumnRenamed("container", "element")
    rows = rows.withColumn("section", F.when(F.col("element").isin("<nav>", "<article>", "<footer>"), F.col("element")))
    return P.attach_section(rows, "page_id", "position", "section").drop("section")


SPEC_ROWS = (
    "'<tr><th>Model Number</th><td> M-' || cast(page_id as string) || ' </td></tr>' || case when page_id % 2 = 0 then '<tr><th>Screen Size Class</th><td><b>' || "
    "cast(page_id % 90 as string) || '</b> inches</td></tr>' else '' end"
)


@query(
    "specs",
    "select page_id, 'M-' || page_id as model_number, case when page_id % 2 = 0 then (page_id % 90) || ' inches' end as screen_size, cast(null as varchar) as energy from pages",
)
def specs(spark, folder):
    labels = {"model_number": "Model Number", "screen_size": "Screen Size Class", "energy": "Estimated Annual Electricity Use"}
    return P.specs(_pages(spark, folder, SPEC_ROWS), labels, ["page_id"], r"(?s)<th>{}</th>\s*", r"<td>(.*?)</td>")


EVENT_ROWS = (
    "'<li class=\"ad-scan\"><span class=\"name\">Sale ' || cast(page_id as string) || '</span><time datetime=\"2024-11-25 00:00:00\"></time>' || case when page_id % 3 = 0 "
    "then '' else '<time datetime=\"2024-12-0' || cast(page_id % 9 + 1 as string) || '\"></time>' end || '</li><li class=\"ad-scan\"><time datetime=\"2024-01-01\"></time></li>'"
)


@query(
    "sale_events",
    "select page_id, 1 as position, 'Sale ' || page_id as event_name, '2024-11-25' as event_start_date, '2024-12-0' || (page_id % 9 + 1) as event_end_date from pages where page_id % 3 <> 0",
)
def sale_events(spark, folder):
    rows = _pages(spark, folder, EVENT_ROWS)
    return P.events(rows, r'(?s)<li class="ad-scan">.*?</li>', r'(?s)<span class="name">(.*?)</span>', r'<time datetime="([^"]*)"', ["page_id"])


@query(
    "sale_events_channel",
    "select page_id, case page_id % 4 when 0 then 'Bestbuy' when 1 then 'Walmart' when 2 then 'Amazon' end as channel, 1 as position, 'Sale ' || page_id as event_name, '2024-11-25' as event_start_date, "
    "'2024-12-0' || (page_id % 9 + 1) as event_end_date from pages where page_id % 3 <> 0",
)
def sale_events_channel(spark, folder):
    """Events with the retailer's channel, 'Best Buy' in the channel's own spelling."""
    rows = _pages(spark, folder, EVENT_ROWS).withColumn("retailer", F.expr("case page_id % 4 when 0 then 'Best Buy' when 1 then 'Walmart' when 2 then 'Amazon' end"))
    found = P.events(
        rows, r'(?s)<li class="ad-scan">.*?</li>', r'(?s)<span class="name">(.*?)</span>', r'<time datetime="([^"]*)"', ["page_id"], channel=norm_channel("retailer"),
    )
    return found.select("page_id", "channel", "position", "event_name", "event_start_date", "event_end_date")


CONS = "'<i>slow ' || cast(page_id as string) || '</i><i>—</i><i></i><i>dear</i><i>more</i>'"


@query(
    "comparison",
    _source(CONS) + """select page_id, pos, case when pos = 1 then url else link end as product_url, nullif(trim(name), '') as product_name, nullif(trim(regexp_replace(regexp_replace(regexp_replace(pro, '<br\\s*/?>', ' ', 'g'), '<[^>]*>', '', 'g'), '[\\s\\x0b\\x85\\p{Z}]+', ' ', 'g')), '') as pros, """
    "case pos when 1 then 'slow ' || page_id when 4 then 'dear' when 5 then 'more' end as cons from (select page_id, url, pos, links[pos] as link, names[pos] as name, ps[pos] as pro from "
    """(select page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) as links, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) as names, """
    "regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) as ps from s), (select unnest(range(1, 1000)) as pos) where pos <= len(names))",
)
def comparison(spark, folder):
    rows = _pages(spark, folder, CONS)
    return P.comparison(rows, r'<li><a href="([^"]*)">([^<]*)</a></li>', r"(?s)<p>(.*?)</p>", r"<i>([^<]*)</i>", ["page_id"])


@query(
    "page_audit",
    _source() + "select page_id, cast(length(html) as int) as page_size, case when hit > 0 then substr(html, greatest(1, hit - 50), hit + 50 - greatest(1, hit - 50)) end as context, "
    "cast(len(regexp_extract_all(html, '<li>')) as int) as items, cast(len(regexp_extract_all(html, '<p>')) as int) as paragraphs from (select *, instr(html, '&middot;') as hit from s)",
)
def page_audit(spark, folder):
    return P.page_audit(_pages(spark, folder), "&middot;", {"items": "<li>", "paragraphs": "<p>"}, ["page_id"])


@query(
    "page_contexts",
    _source() + "select page_id, cast(occurrence as int) as occurrence, cast(place as int) as place, substr(html, greatest(1, place - 50), place + 4 + 50 - greatest(1, place - 50)) as context from "
    "(select page_id, html, cast(unnest(hits) as bigint) as place, unnest(range(1, len(hits) + 1)) as occurrence from (select page_id, html, [list_sum([len(t) for t in parts[1:i]]) + 4 * (i - 1) + 1 for i in range(1, len(parts))] as hits from "
    "(select page_id, html, string_split(html, '</p>') as parts from s)))",
)
def page_contexts(spark, folder):
    """Every end of a paragraph, the text around it included."""
    return P.page_contexts(_pages(spark, folder), "</p>", ["page_id"])


@query(
    "page_sections",
    _source() + "select page_id, keyword, count(*) as sections from (select page_id, unnest(regexp_extract_all(html, '(?s)<nav>.*?</nav>')) as section from s), (select unnest(['the', 'En', 'is']) as keyword) "
    "where contains(regexp_replace(section, '<[^>]*>', '', 'g'), keyword) group by all",
)
def page_sections(spark, folder):
    """Sections found by a word in their text."""
    return M.section_counts(_pages(spark, folder), "nav", ["the", "En", "is"])


@query(
    "markup_fields",
    _source() + r"select page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<br\s*/?>', ' ', 'g'), '<[^>]*>', '', 'g'), "
    r"'[\s\x0b\x85\p{Z}]+', ' ', 'g')) as body from s",
)
def markup_fields(spark, folder):
    rules = [P.Rule("body", r"(?s)<article>(.*?)</article>")]
    return P.extract(_pages(spark, folder), rules, ["page_id"], post={"body": clean_markup})


# --- nested elements ----------------------------------------------------------------------------

# Prices in the page's own area, in areas of other products at several depths of one tag, and after an element without end tag.
NESTED = (
    "'<div id=\"centerCol\"><div class=\"row\"><div class=\"price\"><span class=\"p\">' || cast(page_id as string) || '</span></div><!-- <div> --></div>' || case page_id % 3 "
    "when 0 then '<div class=\"x sponsored\"><div><div><span class=\"p\">s</span></div></div></div>' when 1 then '</section><section id=\"bundleV2-1\"><div><span class=\"p\">b</span></div>' else '' end "
    "|| '<span class=\"p\">in</span></div><div data-feature-name=\"sims-2\"><div><span class=\"p\">d</span></div></div><div class=\"wide\"><span class=\"p\">out</span>'"
)
_HAS = lambda name, parts: "(" + " or ".join(f"contains(regexp_extract(opening, '(?i)\\s{name}\\s*=\\s*\"[^\"]*\"'), '{p}')" for p in parts) + ")"
ELEMENTS = (
    _source(NESTED) + f", b as (select page_id, regexp_replace(html, '{M.NO_MARKUP}', '', 'g') as b from s), l as (select page_id, regexp_extract_all(b, '{M.mark_pattern()}') as l, "
    f"string_split_regex(b, '{M.mark_pattern()}') as g from b), m as (select page_id, mark, pos, tag, open, sum(len(gap) + len(mark)) over (partition by page_id order by pos) - len(mark) as pl from "
    "(select page_id, unnest(l) as mark, unnest(g[1:len(l)]) as gap, unnest(range(1, len(l) + 1)) as pos from l), lateral (select lower(regexp_extract(mark, '</?([a-zA-Z]+)', 1)) as tag, mark not like '</%' as open)), "
    "d as (select *, sum(case when open then 1 else -1 end) over (partition by page_id, tag order by pos) + case when open then 0 else 1 end as lv from m), "
    "c as (select o.page_id, o.tag, o.mark as opening, o.lv, o.pos as start, o.pl, min(z.pos) as stop, min(z.pl + len(z.mark)) as until from d o left join d z on z.page_id = o.page_id and z.tag = o.tag "
    "and z.lv = o.lv and z.pos > o.pos and not z.open where o.open group by all), "
    "e as (select c.page_id, c.tag, c.opening, c.start, c.pl, coalesce(c.stop, min(a.stop)) as stop, coalesce(c.until, min(a.until)) as until, c.lv - least(1, min(c.lv) over (partition by c.page_id, c.tag)) + 1 as level "
    "from c left join c a on a.page_id = c.page_id and a.start < c.start and a.stop > c.start group by c.page_id, c.tag, c.opening, c.start, c.pl, c.stop, c.until, c.lv), "
    "x as (select *, " + _HAS("id", M.EXCLUDED_IDS) + " or " + _HAS("class", M.EXCLUDED_CLASSES) + " or " + _HAS("data-component-type", ["sims"]) + " or " + _HAS("data-feature-name", ["sims"]) + " as bad from e) "
)
_AROUND = "select 1 from x a where a.page_id = x.page_id and a.start <= x.start and (a.stop is null or a.stop > x.start)"


@query(
    "page_elements",
    ELEMENTS + 'select page_id, tag, opening, cast(level as int) as level, cast(start as int) as start, cast(stop as int) as "end", cast(pl as bigint) as "at", cast(until as bigint) as until from e',
)
def page_elements(spark, folder):
    return M.elements(_pages(spark, folder, NESTED))


@query("exclude_by_ancestor", ELEMENTS + f"select page_id, cast(start as int) as start, opening from x where tag = 'span' and not exists ({_AROUND} and a.bad)")
def exclude_by_ancestor(spark, folder):
    found = M.elements(_pages(spark, folder, NESTED))
    return M.exclude_by_ancestor(found, F.col("tag") == "span").select("page_id", "start", "opening")


@query(
    "own_area_prices",
    ELEMENTS + "select page_id, cast(start as int) as start, opening from x where opening like '%class=\"p\"%' "
    f"and not exists ({_AROUND} and a.bad) and exists ({_AROUND} and a.opening like '%id=\"centerCol\"%')",
)
def own_area_prices(spark, folder):
    """Prices in the page's own area that are in no area of other products."""
    found = M.elements(_pages(spark, folder, NESTED))
    price, own = M.attribute_has("opening", "class", ["p"]) & (F.col("tag") == "span"), M.attribute_has("opening", "id", [M.OWN_AREA])
    return M.exclude_by_ancestor(found, price, within=own).select("page_id", "start", "opening")


@query(
    "nested_containers",
    ELEMENTS + "select page_id, cast(row_number() over (partition by page_id order by start) as int) as position, cast(level as int) as level, cast((select count(*) from x a where a.page_id = x.page_id "
    "and a.tag = 'div' and a.start < x.start and (a.stop is null or a.stop > x.start)) as int) as depth, substr(b, cast(pl as int) + 1, cast(coalesce(until, len(b)) - pl as int)) as container from x join b using (page_id) where tag = 'div'",
)
def nested_containers(spark, folder):
    return M.nested_containers(_pages(spark, folder, NESTED), F.col("tag") == "div")

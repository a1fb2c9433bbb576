"""Nested elements against a stack that reads each page."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import markup as M


def stack(page):
    """(tag, level among elements of its tag, mark number, number of the end mark or None) by walking along the marks."""
    out, open_ = [], []
    for pos, mark in enumerate(re.findall(M.mark_pattern().replace("(?i)", ""), re.sub(M.NO_MARKUP, "", page)), 1):
        tag = re.match("</?([a-z]+)", mark)[1]
        if not mark.startswith("</"):
            out.append([tag, 1 + sum(out[k][0] == tag for k in open_), pos, None])
            open_.append(len(out) - 1)
        else:
            mine = [k for k in open_ if out[k][0] == tag]
            if mine:
                out[mine[-1]][3] = pos
                open_.remove(mine[-1])
    for row in [r for r in out if r[3] is None]:
        row[3] = min((r[3] for r in out if r[3] is not None and r[2] < row[2] < r[3]), default=None)
    return sorted(map(tuple, out))


def trees(seed):
    r = random.Random(seed)

    def grow(depth):
        if depth > 5 or r.random() < 0.2:
            return r.choice(("text", "<!-- <div> -->", "<script>'</div>'</script>", "a < b", ""))
        tag = r.choice(("div", "div", "section", "span"))
        attributes = r.choice(("", ' class="row"', ' id="centerCol"', ' class="x sponsored"', ' data-feature-name="sims"'))
        return f"<{tag}{attributes}>" + "".join(grow(depth + 1) for _ in range(r.randint(0, 3))) + f"</{tag}>"

    return "".join(grow(0) for _ in range(4))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, trees(k)) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "no tags"), (103, "</div></div><div>a<div>b</div></div>"), (104, "<div>a<div>b</div>"), (105, "<section><div>x</section><div>y</div>")]
    rows += [(106, "<div>" * 3 + "x" + "</div>" * 3), (107, "<DIV CLASS='A'\n>x</DIV >")]
    return spark.createDataFrame(rows, "page_id int, html string")


def test_elements_are_those_of_a_stack(pages):
    got = {}
    for r in M.elements(pages).collect():
        got.setdefault(r["page_id"], []).append((r["tag"], r["level"], r["start"], r["end"]))
    for row in pages.collect():
        page = (row["html"] or "").replace("<DIV", "<div").replace("</DIV", "</div")
        assert sorted(got.get(row["page_id"], []), key=lambda x: x[2]) == sorted(stack(page), key=lambda x: x[2]), row["page_id"]


def test_areas_count_at_any_distance(pages):
    found = M.elements(pages)
    kept = {(r["page_id"], r["start"]) for r in M.exclude_by_ancestor(found, F.col("tag") == "span").collect()}
    rows = {}
    for r in found.collect():
        rows.setdefault(r["page_id"], []).append(r)
    bad = lambda r: "sponsored" in r["opening"] or "sims" in r["opening"]
    want = {
        (p, r["start"])
        for p, all_ in rows.items()
        for r in all_
        if r["tag"] == "span" and not any(bad(a) and a["start"] <= r["start"] and (a["end"] or 10**9) > r["start"] for a in all_)
    }
    assert kept == want and want


def test_containers_end_at_their_own_tag(pages):
    got = [tuple(r)[:1] + (r["level"], r["container"]) for r in M.nested_containers(pages.where("page_id in (103, 106, 105, 107)"), F.col("tag") == "div").collect()]
    assert sorted(got) == [
        (103, 1, "<div>a<div>b</div></div>"), (103, 2, "<div>b</div>"), (105, 1, "<div>x</section>"), (105, 2, "<div>y</div>"),
        (106, 1, "<div><div><div>x</div></div></div>"), (106, 2, "<div><div>x</div></div>"), (106, 3, "<div>x</div>"), (107, 1, "<DIV CLASS='A'\n>x</DIV >"),
    ]


def test_no_page_travels_and_no_pairs_are_made(pages):
    plan = M.exclude_by_ancestor(M.elements(pages), F.col("tag") == "span")._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert "Exchange" not in line or "_bare" not in line
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# (country, page, its URL or None, status), by hand from the texts that shops show.
STATUSES = [
    ("es", "<title>TV</title><p>plain page</p>", None, "ok"),
    ("es", "<p>Your request was throttled. Please wait a moment and refresh.</p>", None, "throttled"),
    ("es", "<title>Just a moment...</title>", None, "challenge"),
    ("es", "<p>Robot or human?</p>", None, "robot"),
    ("es", "<title>Sorry! Something is missing</title>", None, "robot"),
    ("es", "<script>say('sorry')</script><p>fine</p>", None, "ok"),
    ("es", "<div class='review'>sorry, it broke</div><p>fine</p>", None, "ok"),
    ("es", "<p>text</p><p>We are sorry</p>", None, "robot"),
    ("es", "<p>Access denied</p>", None, "blocked"),
    ("es", "<p>Access denied</p><a>Continue shopping</a>", None, "ok"),
    ("es", "<title>503</title>", None, "blocked"),
    ("es", "<p>algo salió mal</p>", None, "error"),
    ("es", "<span id='productTitle'>TV</span><p>Access denied</p>", None, "ok"),
    ("it", "<p>Accesso negato</p>", None, "ok"),
    ("it", "<p>Ci dispiace</p><p>Accesso negato</p>", None, "blocked"),
    ("it", "<title>Ci dispiace</title>", None, "blocked"),
    ("es", "<p>fine</p>", "https://elsewhere.example.com/", "blocked"),
    ("es", '<span id="productTitle">TV</span>', "https://elsewhere.example.com/", "ok"),
    ("it", '<span id="productTitle">TV</span>', "https://elsewhere.example.com/", "blocked"),
    ("it", '<span id="productTitle">TV</span>', "https://www.AMAZON.it/dp/B0", "ok"),
]


def test_status_of_pages(spark):
    from shelfwise.operators.pages import with_status

    for cc in ("es", "it"):
        for given in (True, False):
            some = [(k, page, url) for k, (c, page, url, _) in enumerate(STATUSES) if c == cc and (url is not None) == given]
            table = spark.createDataFrame(some, "k int, html string, url string")
            got = {r["k"]: r["status"] for r in with_status(table, cc=cc, url="url" if given else None).collect()}
            assert got == {k: STATUSES[k][3] for k, _, _ in some}

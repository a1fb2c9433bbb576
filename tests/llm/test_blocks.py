import html
import random
import re

import numpy as np
import pytest

from shelfwise.llm.blocks import BATCH, PATH, PLAIN, WORDS, Labeller, Layout, figures, main_text, op11_main_text, sample_of, taught, train
from shelfwise.llm.leaves import Leaf, leaves
from tests.test_queries import FOLDER


def article_of(page):
    """The article of the given tables' pages, which all have one layout."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", found[1] if found else ""))
    return "\n\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet").collect()


@pytest.fixture(scope="module")
def model(pages):
    return train([p["html"] for p in pages[::2]])


def test_leaves():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="Home page"><!-- <p>no</p> -->
    <nav id="topMenu"><ul><li><a href="/a">A &amp; B</a><li>two</ul></nav><div hidden><p>unseen</p></div>
    <p>one<br>line <b>bold&nbsp;text</b><p>next &lt;p&gt; a < b<script>var t="</p>";</script><table><tr><td>c1<td>c2</table><p title="a > b">last &am"""
    got = leaves(page)
    assert [(x.path, x.text) for x in got] == [
        (("html", "body home page", "nav top menu", "ul", "li"), "A & B"), (("html", "body home page", "nav top menu", "ul", "li"), "two"),
        (("html", "body home page", "p"), "one line bold text"), (("html", "body home page", "p"), "next <p> a < b"),
        (("html", "body home page", "table", "tr", "td"), "c1"), (("html", "body home page", "table", "tr", "td"), "c2"), (("html", "body home page", "p"), "last &am"),
    ]
    assert [x.linked > 0 for x in got] == [True] + [False] * 6
    assert leaves(None) == leaves("") == leaves("<p></p><br>") == [] and [x.text for x in leaves("plain")] == ["plain"]


@pytest.mark.parametrize("page", ["<" * 50_000, "<a '" * 20_000, "<div>" * 50_000 + "x", "<!--" * 20_000, "<p a=\"" * 20_000, "</p>" * 50_000, "<b>" * 50_000 + "y", "<script>" + "<" * 50_000])
def test_odd_markup_takes_little_time(page):
    leaves(page)


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(3)
    model = Labeller.fresh(1)
    model.weights = {k: v.astype("float64") for k, v in model.weights.items()}
    x = r.normal(size=(5, 3, PATH + WORDS + PLAIN)).astype("float64")
    mask, y = np.ones((5, 3)), (r.random((5, 3)) > 0.5).astype("float64")
    mask[3:, 1] = 0
    known = mask.copy()
    known[0, 0] = 0

    def loss():
        p, _ = model.forward(x, mask)
        return float(-(known * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / known.sum())

    g, _ = model.gradients(x, mask, y, known)
    for name, w in model.weights.items():
        for _ in range(4):
            at = tuple(int(r.integers(n)) for n in w.shape)
            keep, e = w[at], 1e-3
            w[at] = keep + e
            up = loss()
            w[at] = keep - e
            down = loss()
            w[at] = keep
            assert abs((up - down) / (2 * e) - g[name][at]) < 2e-3, name


def render(rows, r):
    """Markup that gives these blocks: elements are opened and closed as their paths ask."""
    out, open_ = ["<!DOCTYPE html>"], []
    for leaf in rows:
        keep = 0
        while keep < min(len(open_), len(leaf.path) - 1) and open_[keep] == leaf.path[keep]:
            keep += 1
        out += [f"</{k.split()[0]}>" for k in reversed(open_[keep:])]
        for key in leaf.path[keep:]:
            tag, *names = key.split()
            out.append(f'<{tag} {r.choice(("class", "id"))}="{" ".join(names)}">' if names else f"<{tag}>")
        text = html.escape(leaf.text)
        out.append(f'<a href="/x">{text}</a>' if leaf.linked * 2 > len(leaf.text) else text.replace(" ", r.choice((" ", "\n", " <b></b>")), 1))
        open_ = list(leaf.path)
    return "".join(out)


def test_held_out_layouts(spark, pages, model):
    """Pages laid out anew from articles that the labeller has not seen, as markup, through the operator."""
    rest = [leaves(p["html"]) for p in pages[1::2]]
    layout = Layout(12345, [[x.text for x in p if taught(x) == 1] for p in rest], [x.text for p in rest for x in p])
    r, rows = random.Random(5), []
    for k in range(300):
        blocks, y = layout.page()
        rows.append((k, render(blocks, r), [x.text for x, v in zip(blocks, y, strict=True) if v], [x.text for x, v in zip(blocks, y, strict=True) if not v]))
    table = spark.createDataFrame([row[:2] for row in rows], "page_id int, html string")
    got = {x["page_id"]: x["text"].split("\n\n") for x in main_text(table, model=model).collect()}
    words = lambda texts: sum(len(t.split()) for t in texts)
    found = {k: [t for t in good if t in got[k]] for k, _, good, _ in rows}
    wrong = {k: [t for t in bad if t in got[k] and t not in good] for k, _, good, bad in rows}
    assert sum(map(words, found.values())) > 0.96 * sum(words(good) for _, _, good, _ in rows)
    assert sum(map(words, wrong.values())) < 0.03 * sum(words(bad) for *_, bad in rows)


def test_all_pages(spark, pages):
    got = {r["page_id"]: r for r in op11_main_text(spark, FOLDER).collect()}
    assert len(got) == len(pages)
    same = sum(got[p["page_id"]]["text"] == article_of(p["html"]) for p in pages)
    assert same >= 0.98 * len(pages)
    assert all(got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"]) and got[p["page_id"]]["url"] == p["url"] for p in pages)


def test_odd_rows(spark, model):
    long = "<article>" + "".join(f"<p>Paragraph number {i} of a long and winding story, told at length.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, None), (2, "", "u"), (3, "<nav><a href='/'>Home</a></nav>", None), (None, "<article><p>A short article, but a text after all.</p></article>", "u"), (5, long, "u"), (5, long, "u")]
    table = spark.createDataFrame([(*r, "clash", 7) for r in rows], "page_id int, html string, url string, text string, _html int")
    got = main_text(table, model=model).collect()
    assert {c for c in got[0].asDict()} == {"page_id", "url", "_html", "text", "n_blocks", "n_kept"}
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[3]["text"] == "" and by[None]["text"].startswith("A short") and by[5]["n_blocks"] == 20_000
    assert by[5]["n_kept"] > 19_900 and len({r["text"] for r in got if r["page_id"] == 5}) == 1
    none = table.limit(0)
    assert main_text(none).collect() == [] and sample_of(none) == []


def test_sample_is_bounded_and_repeats(spark):
    table = spark.read.parquet(f"{FOLDER}/pages.parquet")
    some = sample_of(table, most=40)
    assert len(some) == 40 and some == sample_of(table.repartition(5), most=40)


def test_figures_have_a_row_a_block():
    assert figures([[Leaf(("p",), "a b", 0)] * 2, [], [Leaf(("p",), "c", 1)]]).shape == (3, PATH + WORDS + PLAIN) and BATCH > 0

"""Main text of web pages by a recurrent labeller of blocks."""

from __future__ import annotations

import random
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import query
from shelfwise.llm.leaves import Leaf, leaves
from shelfwise.llm.parts import chunks, starts

#: Numbers of the hashed vectors of a block's path and of its words, and of plain figures.
PATH, WORDS, PLAIN = 96, 32, 12
HIDDEN = 24
#: Pages of the table that the labeller learns from at most, their longest markup, and pages laid out anew from their blocks.
SAMPLE, LONGEST, LAID_OUT = 300, 40_000, 3000
EPOCHS, BATCH, LEARNED_BLOCKS = 8, 32, 200
#: Blocks from which pages count as equally long.
MANY = 150
#: Blocks times pages that are labelled together.
TOGETHER = 100_000

#: Words in tags, classes and ids of areas that are not the article, by kind of area.
AREAS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sitemap skip tabs",
    "header": "header masthead topbar branding toolbar",
    "footer": "footer copyright legal colophon imprint",
    "aside": "aside sidebar widget related recommended similar popular trending teaser more",
    "ad": "ad ads advert advertisement adsense banner promo promotion sponsor sponsored affiliate commercial",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog privacy paywall",
    "form": "form newsletter subscribe signup login search contact",
    "share": "share sharing social follow",
    "comments": "comment comments commentlist reply replies respond disqus discussion responses feedback reader",
}
#: Words in tags, classes and ids of the article.
MAIN = "article main content post entry story body text articlebody"
#: Texts often found in such areas.
PHRASES = {
    "nav": "Home|About us|Contact|News|Sport|Products|Next page|Previous|Startseite|Über uns|Kontakt|Accueil|À propos|Inicio|Noticias|Skip to content|Log in|Archive",
    "header": "Welcome to our site|The daily paper|Search|Menu|Your account|Willkommen|Bienvenue|Bienvenido",
    "footer": "© 2024 All rights reserved.|Terms of use|Privacy policy|Impressum|Alle Rechte vorbehalten.|Mentions légales|Tous droits réservés|Aviso legal|Powered by",
    "aside": "Related articles|Most read|You may also like|Popular posts|Meistgelesen|Articles liés|Más leídas|Recent posts|Categories|Tags",
    "ad": "Advertisement|Sponsored|Buy now and save|Anzeige|Publicité|Publicidad|Special offer, order today|Free shipping on all orders",
    "notice": "We use cookies to improve your experience.|Accept all|Decline|By using this site you agree to our cookie policy.|Wir verwenden Cookies.|Nous utilisons des cookies.|Utilizamos cookies.|Please enable notifications",
    "form": "Your name|Your email|Submit|Subscribe to our newsletter|Enter your email address|Password|Newsletter abonnieren|Abonnez-vous|Suscríbase|Send message",
    "share": "Share on|Tweet|Share this article|Follow us|Teilen|Partager|Compartir|Print|Email this",
    "comments": "Comments|Leave a reply|Reply|3 comments|Kommentare|Antworten|Commentaires|Répondre|Comentarios|Responder|posted 2 days ago|Great article, thanks!|I do not agree with this.",
}
_AREA_OF = {word: area for area, words in AREAS.items() for word in words.split()}
_MAIN = frozenset(MAIN.split())
_DIGITS = str.maketrans("", "", "0123456789")
_PLAIN_BOXES = ("div", "section", "div wrapper", "div container", "div row", "div col", "div inner", "div page", "div layout", "div grid", "td")


def taught(leaf: Leaf) -> int | None:
    """What the markup says of a block: 1 in an article, 0 in another area, None where it names neither."""
    inside = None
    for key in leaf.path:
        words = key.lstrip("!").split()
        if any(w in _AREA_OF for w in words) and not (inside and words[0] == "header"):
            return 0
        if any(w in _MAIN for w in words) and words[0] != "body":
            inside = 1
    return inside


def _bucket(token: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode("utf-8", "replace"))
    return h % size, 1.0 if h & 0x40000000 else -1.0


def path_vector(path: Sequence[str]):
    """Hashed vector of the elements around a block, nearer ones with more weight: tags, names, and the kinds of area that either tell of."""
    import numpy as np

    out, weight = np.zeros(PATH, "float32"), 1.0
    for depth, key in enumerate(reversed(path)):
        tag, *names = key.lstrip("!").split()
        kinds = {"+" + _AREA_OF[w] for w in (tag, *names) if w in _AREA_OF}
        kinds |= {"+area"} if kinds else {"+main" for w in (tag, *names) if w in _MAIN and tag != "body"}
        for token in (tag, *("." + n for n in names), *(("=" + tag,) if depth == 0 else ()), *sorted(kinds)):
            k, sign = _bucket(token, PATH)
            out[k] += sign * weight
        weight = max(0.3, weight * 0.85)
    return out


def figures(pages: Sequence[Sequence[Leaf]]):
    """Vectors of all blocks of some pages, one after another: hashed path, hashed words, plain figures."""
    import numpy as np
    import pyarrow as pa

    flat = [leaf for page in pages for leaf in page]
    n = len(flat)
    x = np.zeros((n, PATH + WORDS + PLAIN), "float32")
    if not n:
        return x
    paths: dict[tuple, int] = {}
    which = np.array([paths.setdefault(leaf.path, len(paths)) for leaf in flat])
    x[:, :PATH] = np.stack([path_vector(p) for p in paths])[which]

    words = [leaf.text.split() for leaf in flat]
    counts = np.array([len(w) for w in words], "float32")
    found = pa.array([w for some in words for w in some], pa.string()).dictionary_encode()
    names = [w.lower().strip(".,;:!?()\"'") for w in found.dictionary.to_pylist()]
    hashed = np.array([_bucket(w, WORDS) for w in names], "float64").reshape(-1, 2)[np.asarray(found.indices)]
    of = np.repeat(np.arange(n), counts.astype("int64"))
    bag = np.bincount(of * WORDS + hashed[:, 0].astype("int64"), weights=hashed[:, 1], minlength=n * WORDS).reshape(n, WORDS)
    x[:, PATH : PATH + WORDS] = bag / np.sqrt(np.maximum(counts, 1))[:, None]

    chars = np.array([len(leaf.text) for leaf in flat], "float32")
    share = lambda values: np.array(values, "float32") / np.maximum(chars, 1)
    sizes = np.array([len(page) for page in pages])
    place = np.concatenate([(np.arange(k) + 0.5) / k for k in sizes if k]) if n else np.zeros(0)
    total = np.repeat(np.bincount(np.repeat(np.arange(len(pages)), sizes), weights=chars, minlength=len(pages)), sizes)
    x[:, PATH + WORDS :] = np.stack([
        np.log1p(counts) / 4, np.log1p(chars) / 6, np.minimum(1, share([leaf.linked for leaf in flat])), chars / np.maximum(counts, 1) / 10,
        np.array([leaf.text[-1] in ".!?…。" for leaf in flat]), 10 * share([leaf.text.count(",") + leaf.text.count(".") for leaf in flat]),
        share([len(leaf.text) - len(leaf.text.translate(_DIGITS)) for leaf in flat]), np.array([leaf.text[0].isupper() for leaf in flat]),
        np.array(["©" in leaf.text or "|" in leaf.text for leaf in flat]), place, np.repeat(np.log1p(np.minimum(sizes, MANY)), sizes) / 6, chars / np.maximum(total, 1),
    ], axis=1).astype("float32")
    return x


@dataclass
class Labeller:
    """A bidirectional LSTM over a page's blocks with a logistic output for each block."""

    weights: dict

    @staticmethod
    def fresh(seed: int = 7) -> Labeller:
        import numpy as np

        r, size = np.random.default_rng(seed), PATH + WORDS + PLAIN
        w = {}
        for side in "fb":
            w[f"{side}x"] = r.normal(0, 1 / np.sqrt(size), (size, 4 * HIDDEN))
            w[f"{side}h"] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"{side}b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        w["o"], w["ox"], w["ob"] = r.normal(0, 0.2, 2 * HIDDEN), np.zeros(size), np.zeros(1)
        return Labeller({k: v.astype("float32") for k, v in w.items()})

    def _side(self, x, mask, side: str, keep: bool):
        """Hidden states (time, pages, HIDDEN) of one direction; padded steps carry the state on."""
        import numpy as np

        w, steps, pages = self.weights, *mask.shape
        into = x.reshape(-1, x.shape[-1]) @ w[f"{side}x"] + w[f"{side}b"]
        into = into.reshape(steps, pages, -1)
        h, c = np.zeros((pages, HIDDEN), "float32"), np.zeros((pages, HIDDEN), "float32")
        out, kept = np.zeros((steps, pages, HIDDEN), "float32"), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ w[f"{side}h"]
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g, m = np.tanh(z[:, 3 * HIDDEN :]), mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                kept.append((t, i, f, o, g, squashed, c, h, m))
            c, h = m * new + (1 - m) * c, m * (o * squashed) + (1 - m) * h
            out[t] = h
        return out, kept

    def forward(self, x, mask, keep: bool = False):
        import numpy as np

        (front, a), (back, b) = self._side(x, mask, "f", keep), self._side(x, mask, "b", keep)
        both, w = np.concatenate([front, back], axis=2), self.weights
        logit = both @ w["o"] + x @ w["ox"] + w["ob"]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), (both, a, b)

    def gradients(self, x, mask, y, known):
        """Gradients of the mean logistic loss over known blocks."""
        import numpy as np

        p, (both, *sides) = self.forward(x, mask, True)
        d = ((p - y) * known / max(1.0, float(known.sum()))).astype("float32")
        w, flat = self.weights, x.reshape(-1, x.shape[-1])
        g = {"o": np.einsum("tp,tph->h", d, both), "ox": flat.T @ d.ravel(), "ob": d.sum(keepdims=True).reshape(1)}
        for side, kept, part in zip("fb", sides, (slice(0, HIDDEN), slice(HIDDEN, None)), strict=True):
            dz_all = np.zeros((*mask.shape, 4 * HIDDEN), "float32")
            gh, dh, dc = np.zeros_like(w[f"{side}h"]), np.zeros((mask.shape[1], HIDDEN), "float32"), np.zeros((mask.shape[1], HIDDEN), "float32")
            for t, i, f, o, cand, squashed, c, h, m in reversed(kept):
                dh = dh + d[t][:, None] * w["o"][part]
                own = m * dh
                dcell = m * dc + own * o * (1 - squashed**2)
                dz = np.concatenate([dcell * cand * i * (1 - i), dcell * c * f * (1 - f), own * squashed * o * (1 - o), dcell * i * (1 - cand**2)], axis=1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh = (1 - m) * dh + dz @ w[f"{side}h"].T
                dc = (1 - m) * dc + dcell * f
            g[f"{side}x"], g[f"{side}h"], g[f"{side}b"] = flat.T @ dz_all.reshape(-1, 4 * HIDDEN), gh, dz_all.sum(axis=(0, 1))
        return g, p

    def label(self, pages: Sequence[Sequence[Leaf]]) -> list:
        """For each page, which of its blocks belong to the article."""
        import numpy as np

        x, at = figures(pages), starts([len(p) for p in pages])
        out: list = [np.zeros(len(p), bool) for p in pages]
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        while order:
            # Pages of about the same number of blocks.
            size = max(1, min(64, TOGETHER // len(pages[order[-1]])))
            some, order = order[-size:], order[:-size]
            steps = len(pages[some[-1]])
            block, mask = np.zeros((steps, len(some), x.shape[1]), "float32"), np.zeros((steps, len(some)), "float32")
            for j, k in enumerate(some):
                n = len(pages[k])
                block[:n, j], mask[:n, j] = x[at[k] : at[k + 1]], 1
            p, _ = self.forward(block, mask)
            for j, k in enumerate(some):
                out[k] = p[: len(pages[k]), j] > 0.5
        return out


def learn(examples: Sequence[tuple[Sequence[Leaf], Sequence[int | None]]], seed: int = 7) -> Labeller:
    """Fit a labeller by back-propagation through time with Adam; of long pages a stretch of blocks is learned from at a time."""
    import numpy as np

    model, r = Labeller.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    known = [(p, y) for p, y in examples if any(v is not None for v in y)]
    x, at, step = figures([p for p, _ in known]), starts([len(p) for p, _ in known]), 0
    for epoch in range(EPOCHS):
        # Pages of like length are learned together.
        length = np.array([len(p) for p, _ in known])
        order = np.argsort(length + r.random(len(known)) * 8, kind="stable")
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        r.shuffle(batches)
        for batch in batches:
            steps = min(LEARNED_BLOCKS, int(length[batch].max()))
            block = np.zeros((steps, len(batch), x.shape[1]), "float32")
            mask, y, sure = (np.zeros((steps, len(batch)), "float32") for _ in range(3))
            for j, k in enumerate(batch):
                low = int(r.integers(0, max(1, length[k] - steps + 1)))
                n = min(steps, int(length[k]))
                block[:n, j], mask[:n, j] = x[at[k] + low : at[k] + low + n], 1
                labels = known[k][1][low : low + n]
                y[:n, j], sure[:n, j] = [v or 0 for v in labels], [v is not None for v in labels]
            # Parts of the path are hidden now and then, so that the text and the context count as well.
            block[:, :, :PATH] *= (r.random((1, len(batch), PATH)) > 0.1).astype("float32")
            g, _ = model.gradients(block, mask, y, sure)
            step += 1
            norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
            rate = 0.01 * (1 - epoch / (EPOCHS + 1))
            for k, v in g.items():
                v = v * min(1.0, 2.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                model.weights[k] = (model.weights[k] - rate * change).astype("float32")
    return model


class Layout:
    """Pages laid out anew: the blocks of an article between areas with names, with other names, or with none."""

    def __init__(self, seed: int, articles: Sequence[Sequence[str]], texts: Sequence[str]):
        self.r, self.articles, self.texts = random.Random(seed), articles, texts

    def _noise(self) -> str:
        """A class name that says nothing."""
        return "".join(self.r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(self.r.randint(2, 7)))

    def _box(self) -> str:
        return self.r.choice(_PLAIN_BOXES) if self.r.random() < 0.6 else f"div {self._noise()}"

    def _some(self, most: int = 20) -> str:
        words = self.r.choice(self.texts).split()
        at = self.r.randrange(max(1, len(words) - 5))
        return " ".join(words[at : at + self.r.randint(1, most)])

    def _area(self, kind: str) -> list[Leaf]:
        """Blocks of an area: short linked ones, phrases, and texts that read like an article's."""
        r, style = self.r, self.r.random()
        word = r.choice(AREAS[kind].split())
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        if style < 0.35:
            key = f"{tag} {word}"
        elif style < 0.6:
            key = f"{r.choice(('div', 'section', 'ul', 'td', 'ol'))} {word} {self._noise()}"
        elif style < 0.75 and tag not in ("div", "section"):
            key = tag
        else:
            key = self._box()
        named = style < 0.75
        phrases, out = PHRASES[kind].split("|"), []
        link = lambda text, share=1.0: len(text) if r.random() < share else 0

        def add(inner: Sequence[str], text: str, linked: int = 0) -> None:
            out.append(Leaf((key, *inner), text, linked))

        if kind in ("nav", "share") or (kind in ("aside", "footer", "header") and r.random() < 0.5):
            if r.random() < 0.4 and kind != "nav":
                add((r.choice(("h2", "h3", "h4", "p")),), r.choice(phrases))
            inner = r.choice((("ul", "li"), ("ul", "li"), ("div",), ("p",), (f"div {word}",) if named else ("div",)))
            for _ in range(r.randint(2, 9)):
                text = r.choice(phrases) if r.random() < 0.4 else self._some(4)
                add(inner, text, link(text, 0.95))
        if kind == "comments":
            add((r.choice(("h2", "h3", "h4")),), r.choice(phrases[:1] + phrases[3:5] + phrases[6:7] + phrases[8:9]))
            item = r.choice((("ol", "li"), ("ul", "li comment"), ("div comment",), (f"div {self._noise()}",))) if named else r.choice((("ol", "li"), ("div",)))
            for _ in range(r.randint(1, 6)):
                if r.random() < 0.6:
                    add((*item, "div"), self._some(3), link("x", 0.3))
                add((*item, "p"), self._some(40))
                if r.random() < 0.4:
                    add((*item, "div"), r.choice(phrases), 5)
        if kind in ("form", "notice", "ad", "header", "footer", "aside"):
            for _ in range(r.randint(1, 3)):
                text = r.choice(phrases) if r.random() < (0.5 if named else 0.9) else self._some(30)
                if named and r.random() < 0.2:
                    text = f"{text} {self._some(12)}"
                add(r.choice(((), ("p",), ("div",), ("p",))), text, link(text, 0.15))
        return out

    def page(self) -> tuple[list[Leaf], list[int]]:
        """Blocks of a page and which of them are the article's."""
        r = self.r
        outer = [self._box() for _ in range(r.choice((0, 0, 1, 1, 2)))]
        style = r.random()
        if style < 0.3:
            main = [r.choice(("article", "main", "main|article", "article post", "main content"))]
        elif style < 0.75:
            main = [f"{r.choice(('div', 'section', 'td'))} {r.choice(MAIN.split())}" + (f" {self._noise()}" if r.random() < 0.5 else "")]
        else:
            main = [self._box()]
        main = main[0].split("|")
        if r.random() < 0.25:
            main.append(self._box())
        texts = r.choice(self.articles)
        if r.random() < 0.3:
            # Few blocks, so that long articles are not all there is.
            at = r.randrange(len(texts))
            texts = texts[at : at + r.randint(1, 6)]
        elif r.random() < 0.06:
            texts = [r.choice(texts) for _ in range(r.randint(60, 180))]
        article: list[tuple[Leaf, int]] = []
        for k, text in enumerate(texts):
            inner = ("h1",) if k == 0 and r.random() < 0.7 else r.choice((("p",),) * 10 + (("h2",), ("ul", "li"), ("blockquote", "p"), ("blockquote",), ("div",), ("pre",), ("ol", "li"), ("table", "tr", "td"), ("figure", "figcaption")))
            if inner[0] in ("h2", "li", "ul", "ol") and r.random() < 0.6:
                text = " ".join(text.split()[:8])
            if k == 0 and inner == ("h1",) and r.random() < 0.2:
                inner = ("header", "h1")
            article.append((Leaf((*main, *inner), text, len(text) // 5 if r.random() < 0.1 else 0), 1))
        for kind in ("ad", "share", "aside", "form", "notice"):
            if r.random() < 0.15:
                at = r.randint(1, len(article))
                article[at:at] = [(Leaf((*main, *leaf.path), leaf.text, leaf.linked), 0) for leaf in self._area(kind)]
        if r.random() < 0.15:
            article += [(Leaf((*main, *leaf.path), leaf.text, leaf.linked), 0) for leaf in self._area("comments")]
        area = lambda kinds, odds: [(leaf, 0) for kind in kinds if r.random() < odds for leaf in self._area(kind)]
        before = ["notice", "header", "nav", "nav", "ad", "form"]
        after = ["share", "ad", "aside", "comments", "form", "nav", "footer", "notice"]
        r.shuffle(before)
        r.shuffle(after)
        rows = area(before, 0.5) + (area(("aside",), 0.4)) + article + area(after, 0.5)
        if r.random() < 0.04:
            rows = area(before, 0.8) + area(after, 0.8) or rows
        end = ["html", "body", *outer]
        return [Leaf((*end, *leaf.path), leaf.text, leaf.linked) for leaf, _ in rows], [y for _, y in rows]


def train(sample: Sequence[str], seed: int = 7) -> Labeller:
    """A labeller from pages whose markup names their areas, and from as many laid out anew from their blocks as ``LAID_OUT`` says."""
    pages = [leaves(page) for page in sample]
    examples = [(p, [taught(leaf) for leaf in p]) for p in pages]
    articles = [[leaf.text for leaf, y in zip(p, ys, strict=True) if y == 1] for p, ys in examples]
    articles = [a for a in articles if a] or [[text] for words in PHRASES.values() for text in words.split("|")]
    texts = [leaf.text for p in pages for leaf in p] or [t for words in PHRASES.values() for t in words.split("|")]
    layout = Layout(seed, articles, texts)
    return learn(examples + [layout.page() for _ in range(LAID_OUT)], seed)


def sample_of(pages: DataFrame, html_col: str = "html", most: int = SAMPLE, longest: int = LONGEST) -> list[str]:
    """Markup of ``most`` pages at most, of ``longest`` characters at most, chosen by a hash of the markup."""
    rows = pages.select(F.col(html_col).cast("string").alias("_html")).where(f"length(_html) between 1 and {longest}")
    n = pages.count()
    if not n:
        return []
    # About twice as many as are wanted reach the order by hash, whatever the table's size.
    key = F.xxhash64("_html")
    some = rows.where(F.pmod(key, F.lit(1_000_000)) < F.lit(-(-2_000_000 * most // n)))
    return [r["_html"] for r in some.orderBy(F.xxhash64(key), "_html").limit(most).collect()]


def main_text(pages: DataFrame, html_col: str = "html", model: Labeller | None = None, out: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole page in place of its markup, ``n_blocks`` of the page and ``n_kept`` of them.

    A page becomes a sequence of leaf blocks (``leaves``). A bidirectional LSTM in numpy reads, for each block, a hashed vector
    of the tags and names around it, a hashed vector of its words and a few figures, and labels every block with the
    whole document in view, in both directions. Kept blocks are joined in page order by two line feeds.

    The labeller is trained on the driver on a bounded sample (``SAMPLE`` pages of ``LONGEST`` characters, chosen by hash) whose markup names
    areas (``taught``), and on ``LAID_OUT`` pages made of the sample's blocks with names changed, moved or left out (``Layout``).
    All pages are labelled, whole. Nothing is shuffled.

    Defined cases: null and empty pages, pages without blocks and pages without an article have an empty text; broken or
    cut markup is read as browsers would; repeated rows get equal texts; a very long page is labelled by itself; without any
    sample the labeller learns from the fixed phrases; no rows give none; other columns pass through (``out``, ``n_blocks`` and ``n_kept`` are replaced).
    """
    import pyarrow as pa

    model = model or train(sample_of(pages, html_col))
    weights = model.weights
    taken = [f for f in pages.schema.fields if f.name not in (html_col, out, "n_blocks", "n_kept")]
    # By place, so that no name can clash on the way in.
    rows = pages.select(F.col(f"`{html_col}`").cast("string").alias("_0"), *[F.col(f"`{f.name}`").alias(f"_{k}") for k, f in enumerate(taken, 1)])

    def run(batches):
        tool = Labeller(weights)
        for batch in batches:
            for i, n in chunks(batch.column(0), 4 << 20):
                some = batch.slice(i, n)
                blocks = [leaves(page) for page in some.column(0).to_pylist()]
                chosen = tool.label(blocks)
                text = ["\n\n".join(leaf.text for leaf, yes in zip(b, c, strict=True) if yes) for b, c in zip(blocks, chosen, strict=True)]
                arrays = [some.column(k + 1) for k in range(len(taken))]
                arrays += [pa.array(text, pa.string()), pa.array([len(b) for b in blocks], "int64"), pa.array([int(c.sum()) for c in chosen], "int64")]
                yield pa.RecordBatch.from_arrays(arrays, names=[*[f.name for f in taken], out, "n_blocks", "n_kept"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken)
    return rows.mapInArrow(run, f"{kinds}`{out}` string, n_blocks bigint, n_kept bigint")


@query("op11_main_text")
def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    found = main_text(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")

"""Main text of pages: a conditional random field over leaf blocks, trained on labelled pages."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import crf
from plumbline.llm.leafblocks import Block, leaf_blocks

#: Elements whose pages label themselves, and those inside them that are not the article.
MARKED, NOT_IN_IT = frozenset(("in:article", "in:main")), frozenset(("in:nav", "in:aside", "in:footer", "in:form", "in:menu", "in:button", "in:select"))
#: Words that made pages use in class, id and role, by what the element holds (fixed values of common page templates).
ARTICLE = "article post entry content main story body text page single hentry markdown prose blog news"
ASIDE = {
    "nav": "nav navigation navbar menu topnav breadcrumb breadcrumbs pagination pager tabs toolbar",
    "header": "header masthead banner top branding logo topbar",
    "footer": "footer bottom copyright colophon legal imprint credits",
    "aside": "sidebar aside widget related recommended trending popular tags archive secondary rail",
    "div": "ad ads advert advertisement sponsor sponsored promo adsbygoogle dfp",
    "section": "cookie consent notice alert gdpr popup modal overlay newsletter subscribe signup paywall share social toast",
    "form": "form search login contact comment-form respond",
    "ol": "comments comment replies reply discussion disqus responses thread",
}
ENDS_SENTENCE = frozenset(".!?…。！？؟।:;\"”»")
SIGNS = "©·|»›→"


def features(blocks: list[Block]) -> list[crf.Step]:
    """What the field sees of each block: the elements above it, the shape of its text, its place, and its neighbourhood."""
    total = sum(len(b.text) for b in blocks) or 1
    out, title, n = [], False, len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        size = len(b.text)
        title = title or b.tag == "h1"
        fs = [*b.above, f"tag:{b.tag}", *(f"own:{x}" for x in b.names), f"words:{min(8, words.bit_length())}", f"links:{_step(b.linked / size, (0.01, 0.3, 0.6, 0.9))}",
              f"commas:{min(3, b.text.count(','))}", f"end:{b.text[-1] in ENDS_SENTENCE}", f"title:{title}", f"first:{min(4, i)}", f"last:{min(4, n - 1 - i)}",
              f"share:{_step(size / total, (0.01, 0.05, 0.2, 0.5))}", f"digits:{_step(sum(map(str.isdigit, b.text[:200])) / min(200, size), (0.01, 0.1, 0.3))}", "all"]
        fs += [f"sign:{s}" for s in SIGNS if s in b.text]
        same = i > 0 and (blocks[i - 1].above is b.above or blocks[i - 1].above == b.above) and blocks[i - 1].tag == b.tag
        out.append((fs, int(same)))
    return out


def _step(x: float, bounds: tuple[float, ...]) -> int:
    return sum(x > b for b in bounds)


class Extractor:
    """A trained field; scores elements by the features it knows, so nested unknown names cost nothing."""

    def __init__(self, chain: crf.Chain):
        self.chain = chain
        self.known = frozenset(f for f in chain.weight if f.startswith(("in:", "of:")))

    def blocks(self, page: str) -> tuple[list[Block], list[int]]:
        """All leaf blocks and their labels, 1 for the article's."""
        blocks = leaf_blocks(page, self.known)
        above: dict[frozenset, float] = {}
        odds, kinds = [], []
        for b, (fs, kind) in zip(blocks, features(blocks), strict=True):
            if b.above not in above:
                above[b.above] = self.chain.odds(tuple(b.above))
            odds.append(above[b.above] + self.chain.odds(fs[len(b.above):]))
            kinds.append(kind)
        return blocks, self.chain.decode(odds, kinds)

    def text(self, page: str) -> str:
        blocks, labels = self.blocks(page)
        return "\n".join(b.text for b, y in zip(blocks, labels, strict=True) if y)


def labelled(page: str) -> tuple[list[crf.Step], list[int]] | None:
    """A page that marks its article by an element: its blocks' features and labels."""
    blocks = leaf_blocks(page)
    labels = [int(bool(b.above & MARKED) and not b.above & NOT_IN_IT) for b in blocks]
    return (features(blocks), labels) if any(labels) else None


def made_pages(n: int, seed: int = 0) -> list[tuple[list[crf.Step], list[int]]]:
    """Labelled pages by rule: an article in one of several layouts among menus, headers, notices, adverts, forms, comments.

    Each page draws its elements and names anew, marks its article by an element only at times, and writes in words of
    random syllables, so that the field learns from names, shapes and order rather than from one template. Texts of the
    article begin with a sign that tells the label and is taken off before the features are made.
    """
    r = random.Random(seed)
    return [_labels_off(leaf_blocks(_page(r))) for _ in range(n)]


MARK = "\u0001"


def _labels_off(blocks: list[Block]) -> tuple[list[crf.Step], list[int]]:
    labels = [int(b.text.startswith(MARK)) for b in blocks]
    return features([b._replace(text=b.text.lstrip(MARK) or "x", linked=max(0, b.linked)) for b in blocks]), labels


def _prose(r: random.Random, words: int) -> str:
    out = []
    for k in range(words):
        w = "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiouäéo") for _ in range(r.choice((1, 1, 2, 2, 3, 4))))
        out.append((w.capitalize() if k == 0 or out[-1].endswith(".") else w) + r.choice(("", "", "", "", "", "", ",", ".")))
    return " ".join(out).rstrip(",.") + r.choice((".", ".", ".", "!", "?"))


def _page(r: random.Random) -> str:
    def attrs(words: str, share: float = 0.85) -> str:
        if r.random() > share:
            return ""
        name = r.choice(words.split())
        name = r.choice((name, f"{name}-{r.choice(('box', 'wrapper', 'inner', 'area', 'x1'))}", f"{r.choice(('site', 'page', 'js', 'c'))}-{name}"))
        return f' {r.choice(("class", "class", "id"))}="{name}"'

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{_prose(r, r.choice((1, 1, 2, 3)))[:-1]}</a>{r.choice(("", "</li>"))}' for i in range(k)) + "</ul>"

    def other(kind: str) -> str:
        named = r.random() < 0.6 or kind in ("div", "section", "ol")
        tag = kind if kind in ("div", "section") or r.random() < 0.6 else "div"
        inside = {
            "nav": lambda: links(r.randrange(2, 9)),
            "header": lambda: f"<a href='/'>{_prose(r, 2)}</a>" + r.choice(("", links(4), f"<p>{_prose(r, 5)}</p>", f"<h1>{_prose(r, 2)}</h1>")),
            "footer": lambda: r.choice(("", "<p>")) + f"&copy; {r.choice(('', '2024 '))}{_prose(r, 1)} &middot; {_prose(r, r.randrange(2, 12))}" + r.choice(("", links(3))),
            "aside": lambda: f"<h3>{_prose(r, 2)}</h3>" + r.choice((links(5), f"<p>{_prose(r, 15)}</p>")),
            "div": lambda: r.choice((_prose(r, r.randrange(3, 25)), f"<p>{_prose(r, 14)}</p><a href='#'>{_prose(r, 2)}</a>")),
            "section": lambda: f"<p>{_prose(r, r.randrange(5, 30))}</p>" + r.choice(("", "<button>OK</button>")),
            "form": lambda: f"<label>{_prose(r, 2)}</label><input name=q><button>{_prose(r, 1)}</button>" + r.choice(("", f"<p>{_prose(r, 8)}</p>")),
            "ol": lambda: f"<h3>{_prose(r, 2)}</h3>" + "".join(f'<{r.choice(("li", "div", "article"))} class="comment"><p>{_prose(r, r.randrange(3, 30))}</p>' for _ in range(r.randrange(1, 4))),
        }[kind]()
        return f"<{tag}{attrs(ASIDE[kind], 1.0 if named or tag == 'div' else 0.0)}>{inside}</{tag}>"

    def article() -> str:
        body = [f"<h1>{MARK}{_prose(r, r.randrange(2, 12))[:r.choice((-1, 99))]}</h1>"] if r.random() < 0.9 else []
        for _ in range(r.choice((1, 2, 4, 7, 12))):
            kind = r.random()
            if kind < 0.72:
                a, b = _prose(r, r.choice((1, 2, 5, 15, 40, 90))), r.choice(("", "", f" <a href='/x'>{_prose(r, 2)}</a> {_prose(r, 6)}"))
                body.append(r.choice((f"<p>{MARK}{a}{b}</p>", f"<p>{MARK}<b>{a}{b}<br>", f"<p>{MARK}{a}{b}")))
            elif kind < 0.8:
                body.append(f"<h2>{MARK}{_prose(r, 3)[:-1]}</h2>")
            elif kind < 0.87:
                body.append("<ul>" + "".join(f"<li>{MARK}{_prose(r, 6)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.92:
                body.append(f"<blockquote>{MARK}{_prose(r, 20)}</blockquote>")
            else:
                body.append(other(r.choice(("div", "div", "aside", "section"))))
        if r.random() < 0.3:
            body.append(other("ol"))
        tag = r.choice(("article", "article", "main", "div", "div", "section"))
        return f"<{tag}{attrs(ARTICLE, 0.4 if tag in ('article', 'main') else 1.0)}>{''.join(body)}</{tag}>"

    top = [k for k in ("header", "nav", "section", "div", "form") if r.random() < 0.5]
    low = [k for k in ("ol", "aside", "form", "div", "section") if r.random() < 0.3] + ["footer"] * (r.random() < 0.9)
    r.shuffle(top)
    return "<html><body>" + "".join(map(other, top)) + article() + "".join(map(other, low)) + "</body></html>"


def train(pages: DataFrame, sample: int = 300, made: int = 500, longest: int = 200, largest: int = 1 << 18) -> Extractor:
    """Fit the field on ``made`` pages of rules and at most ``sample`` rows of ``pages`` that mark their article by an element.

    The sample are the distinct pages with the smallest hashes; pages over ``largest`` bytes or ``longest`` blocks are not
    learned from. These bounds are on labelled rows only: every page is read whole when its text is extracted. Tasks
    send the driver hashes to choose from, and then the pages of the chosen ones alone.
    """
    marked = pages.select("html", F.xxhash64("html").alias("h")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]") & (F.octet_length("html") <= largest))
    chosen = [r.h for r in marked.select("h").distinct().orderBy("h").limit(sample).collect()]
    rows = marked.where(F.col("h") <= chosen[-1]).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if chosen else []
    own = [x for r in rows if (x := labelled(r.html))]
    return Extractor(crf.fit([x for x in [*own, *made_pages(made)] if len(x[1]) <= longest]))


class _Texts:
    def __init__(self, extractor):
        self.extractor = extractor

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = self.extractor.value
        for b in batches:
            texts = [fit.text(x.as_py() or "") for x in b.column(b.num_columns - 1)]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], names=[*b.schema.names[:-1], "text", "n_chars"])


def main_text(pages: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """``pages`` without html, with ``text`` (the article's blocks, one a line) and ``n_chars``; other columns pass through.

    NULL and empty html, and pages without an article, give an empty text. Columns named text or n_chars are replaced.
    Rows are independent of each other, repeated or not; nothing is shuffled. ``extractor`` is trained on ``pages`` by default.
    """
    spark: SparkSession = pages.sparkSession
    fitted = spark.sparkContext.broadcast(extractor or train(pages))
    kept = pages.drop("html", "text", "n_chars")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "text string", "n_chars bigint"])
    return pages.select(*[F.col(f"`{c}`") for c in kept.columns], F.col("html").cast("string").alias("html")).mapInArrow(_Texts(fitted), schema)

"""Page extraction: raw HTML rows to posts, links, citations, images and figures.

Parsing is the one step that needs Python: it runs inside ``mapInPandas``, row by
row, and emits plain facts about elements. Choosing, filtering, classifying and
capping are DataFrame expressions over those facts, inside the page's own row
wherever possible, so page extraction shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline import constants as K
from plumbline.functions import links as L
from plumbline.functions import text as X

# Named entities the expression-only path decodes itself.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'",
    "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&deg;": "°", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&hellip;": "…", "&eacute;": "é",
}
# Blocks cut from a post body (tag, attribute, pattern).
BOILERPLATE = [
    ("style", None, None), ("script", None, None), ("link", None, None), ("meta", None, None),
    ("div", "class", "post-share-buttons"), ("div", "id", "comments"), ("div", "class", "comment-form"),
    ("a", "class", "jump-link"), ("div", "class", "post-footer"), ("div", "class", "breadcrumbs"),
    ("div", "class", "singleton-element"),
]
LINE_BREAK = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


# ── expression-only path ───────────────────────────────────────────────────
def drop_script_style(html) -> Column:
    h = X._col(html)
    for tag in ("script", "style"):
        h = F.regexp_replace(h, f"(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>", "")
    return F.regexp_replace(h, "(?s)<!--.*?-->", "")


def decode_entities(c) -> Column:
    c = X._col(c)
    for name, ch in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(ch))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def tidy_lines(text) -> Column:
    """Lines trimmed, runs of two spaces split, blanks dropped, joined by one space."""
    parts = F.transform(F.split(X._col(text), LINE_BREAK + "|  ", -1), X.strip)
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def canonical_text(html) -> Column:
    """Readable text of simple markup; exact when only ``ENTITIES`` and &amp; occur."""
    bare = F.regexp_replace(drop_script_style(html), "<[^>]*>", "")
    return tidy_lines(decode_entities(bare))


def article_texts(pages: DataFrame, tag: str = "article", id: str = "page_id", html: str = "html") -> DataFrame:
    """(id, canonical_text, error): the text of a page's articles; a page without one, or with an empty one, is an error row."""
    found = F.regexp_extract_all(html, F.lit(f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>"), F.lit(1))
    rows = pages.select(id, F.coalesce(found, X.strings([])).alias("_a"))
    rows = rows.select(id, F.size("_a").alias("_n"), canonical_text(F.array_join("_a", " ")).alias("canonical_text"))
    return rows.select(id, "canonical_text", F.when(F.col("_n") == 0, f"no {tag}").when(F.col("canonical_text") == "", f"empty {tag}").alias("error"))


def title_of(html) -> Column:
    """First non-empty h1, h2 or h3 text in document order, else ''."""
    heads = F.regexp_extract_all(X._col(html), F.lit("(?is)<h[123]\\b[^>]*>(.*?)</h[123]\\s*>"), F.lit(1))
    texts = F.filter(F.transform(heads, lambda h: X.strip(decode_entities(F.regexp_replace(h, "<[^>]*>", "")))), lambda t: t != "")
    return F.coalesce(F.get(texts, F.lit(0)), F.lit(""))


# ── parser path ────────────────────────────────────────────────────────────
ELEMENTS = "array<struct<kind:string,pos:int,url:string,text:string,note:string,mark:string>>"


def _classed(node, name):
    return node.get("class") == name or name in node.classes()


def _is_boilerplate(node):
    for tag, attr, pat in BOILERPLATE:
        if node.tag != tag:
            continue
        if attr is None or (attr == "id" and node.get("id") == pat):
            return True
        if attr == "class" and any(re.search(pat, c) for c in node.classes()):
            return True
    return False


def _post(source, url, names, closed_only=False):
    """The chosen container of one page, read off its one tree: (strategy, title, body source, text); strategy None without any."""
    from plumbline.functions import markup as M

    root = (M.parse_closed if closed_only else M.parse)(source)
    boxes = [box for name in names for box in root.all("div") if _classed(box, name)]
    if not boxes:
        return None, None, None, None

    def headline(box):
        return next((h for h in box.all("h3") if h.get("class") == "post-title entry-title"), None)

    linking = next((b for b in boxes if any(a.attrs.get("href") == url for a in b.all("a"))), None)
    plain = None if linking is not None else next((b for b in boxes if (h := headline(b)) is not None and h.first("a") is None), None)
    # of several of one length the first
    box = linking if linking is not None else plain if plain is not None else max(boxes, key=lambda b: sum(map(len, b.strings())))
    titled = next((d for d in box.all("div") if _classed(d, "post-title-container")), None)
    head = headline(titled) if titled is not None else None
    title = head.text(trim=True) if head is not None else ""
    title = title or next((t for t in (h.text(trim=True) for h in box.all("h1", "h2", "h3")) if t), "")
    entry = next((d for d in box.all("div") if d.get("class") == "post-body entry-content"), box)
    text = "".join(entry.strings(lambda n: n.tag in ("script", "style") or _is_boilerplate(n)))
    return 1 if linking is not None else 2 if plain is not None else 3, title, M.without(source, entry, _is_boilerplate), text


#: Pages whose results a task holds at a time.
PAGES = 32


def _by_page(pages: DataFrame, keep: Sequence[str], html: str, url: str, fn, made: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    """``fn`` (html, url) -> the values of ``made``, beside the ``keep`` columns; a task holds the results of ``PAGES`` pages."""
    n = len(keep)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                found = [fn(h.as_py(), u.as_py()) for h, u in zip(part.column(n), part.column(n + 1))]
                cols = [pa.array([f[k] for f in found], type=kind) for k, (_, kind) in enumerate(made)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *cols], names=[*keep, *(name for name, _ in made)])

    rows = pages.select(*keep, F.col(html).alias("_html"), F.col(url).alias("_url"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:n], *T.StructType.fromDDL(ddl).fields]))


def isolate_main(pages: DataFrame, names: Sequence[str] = ("post-body-container", "post-outer"),
                 id: str = "page_id", url: str = "url", html: str = "html", carry: Sequence[str] = (), closed_only: bool = False) -> DataFrame:
    """One post per page: (id, url, carry…, strategy, title, body_html, canonical_text); strategy NULL means no container.

    Order of choice: a container linking to the page itself, then one whose
    title is not a link, then the longest one. A page is parsed once, and only
    the chosen container leaves the task. Works on streams; ``carry`` columns go along. ``closed_only`` decodes
    only references that end in a semicolon, as ``canonical_text`` does.
    """
    names, keep = list(names), [id, url, *carry]
    posts = _by_page(pages, keep, html, url, lambda h, u: _post(h, u, names, closed_only),
                     [("strategy", pa.int32()), ("title", pa.string()), ("body_html", pa.string()), ("_text", pa.string())],
                     "strategy int, title string, body_html string, _text string")
    return posts.select(*keep, "strategy", "title", "body_html", tidy_lines("_text").alias("canonical_text"))


def quarantine(posts: DataFrame, id: str = "page_id", url: str = "url") -> DataFrame:
    return posts.where(F.col("strategy").isNull()).select(id, url, F.lit("no post container").alias("reason"))


def _elements(source, base, card_class, sup_class, closed_only=False):
    from urllib.parse import urljoin

    from plumbline.functions import markup as M

    root, out = (M.parse_closed if closed_only else M.parse)(source), []

    def put(kind, url="", text="", note="", mark=""):
        out.append({"kind": kind, "pos": sum(1 for e in out if e["kind"] == kind) if kind in ("citation",) else len(out),
                    "url": url, "text": text, "note": note, "mark": mark})

    def joined(u):
        try:
            return urljoin(base or "", u)
        except ValueError:
            return None

    order = list(root.walk())
    head = next((i for i, n in enumerate(order) if n.tag in ("h2", "h3", "h4", "h5", "h6")
                 and re.search("reference|source", n.text(trim=True).lower())), None)
    listing = next((n for n in order[head + 1:] if n.tag in ("ol", "ul")), None) if head is not None else None
    for li in (k for k in (listing.kids if listing else []) if isinstance(k, M.Node) and k.tag == "li"):
        a = next((x for x in li.all("a") if "href" in x.attrs), None)
        put("list_item", a.get("href") if a else "", "" if a is None else a.text(trim=True))
    for n in order:
        if n.tag == "sup" and _classed(n, sup_class) and n.first("a") is not None:
            a = n.first("a")
            put("sup", a.get("href"), a.text(trim=True))
        elif n.tag == "img":
            src = n.get("src")
            lazy = (n.get("src") or n.get("data-src")).strip()
            fig = n.up
            while fig is not None and fig.tag != "figure":
                fig = fig.up
            put("image", src, n.get("alt"), n.up.text(" ", trim=True), joined(src.strip()) or "")
            put("bare_figure", (joined(lazy) or "") if lazy and not lazy.startswith("data:") else "", n.get("alt").strip(),
                (n.get("alt") + " " + " ".join(n.classes())).lower())
        elif n.tag == "figure":
            img, cap = n.first("img"), n.first("figcaption")
            if img is not None:
                src = (img.get("src") or img.get("data-src") or img.get("data-lazy-src")).strip()
                put("figure", (joined(src) or "") if src and not src.startswith("data:") else "",
                    (cap.text(" ", trim=True) if cap is not None else img.get("alt")).strip())
        elif n.tag == "a" and "href" in n.attrs:
            put("link", n.get("href").strip(), n.text(trim=True))
        elif n.tag == "div" and card_class in n.get("class"):
            for li in n.all("li"):
                a = next((x for x in li.all("a") if "href" in x.attrs), None)
                if a is not None:
                    put("reference", a.get("href").strip(), a.text(" ", trim=True).lstrip("★ ").strip(),
                        "", "★" if li.text().lstrip().startswith("★") else "")
        elif n.tag == "meta" and (n.get("property") or n.get("name")) in ("og:image", "twitter:image", "og:title"):
            put("meta", "", n.get("content").strip(), n.get("property") or n.get("name"))
        elif n.tag == "title":
            put("title", "", n.text(trim=True))
    return out


def html_extract(pages: DataFrame, card_class: str = "source-card", sup_class: str = "citation",
                 id: str = "page_id", url: str = "url", html: str = "html", closed_only: bool = False) -> DataFrame:
    """(id, url, elements): every element the extraction operators look at, parsed once per page."""
    text = [(f, pa.string()) for f in ("url", "text", "note", "mark")]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("pos", pa.int32()), *text]))
    return _by_page(pages, [id, url], html, url, lambda h, u: (_elements(h, u, card_class, sup_class, closed_only),), [("elements", kind)], f"elements {ELEMENTS}")


def _of(kind: str) -> Column:
    return F.filter("elements", lambda e: e["kind"] == kind)


def _numbered(df: DataFrame, id: str, arr: Column, fields: Sequence[str]) -> DataFrame:
    return df.select(id, "url", F.posexplode(arr).alias("pos", "_e")).select(
        id, F.col("url").alias("page_url"), F.col("pos").cast("bigint").alias("pos"), *[F.col("_e")[f].alias(f) for f in fields])


def extract_citations(extracted: DataFrame, id: str = "page_id", strict: bool = False) -> DataFrame:
    """(id, marker, url, kind): the reference list, else the superscript markers."""
    listed = F.filter(_of("list_item"), lambda e: F.startswith(e["url"], F.lit("http")))
    numbered = F.transform(listed, lambda e, i: F.struct((i + 1).alias("marker"), e["url"].alias("url")))
    sups = F.transform(_of("sup"), lambda e: F.struct(X.strip(e["text"]).try_cast("int").alias("marker"), e["url"].alias("url")))
    sups = F.filter(sups, lambda e: e["marker"].isNotNull())
    rows = extracted.select(id, F.inline(F.when(F.size(listed) > 0, numbered).otherwise(sups)))
    return rows.withColumn("kind", L.classify_link("url", strict))


def extract_images(extracted: DataFrame, id: str = "page_id") -> DataFrame:
    """(id, pos, src, alt) of every image with a source."""
    imgs = F.filter(_of("image"), lambda e: e["url"] != "")
    return _numbered(extracted, id, imgs, ("url", "text")).select(id, "pos", F.col("url").alias("src"), F.col("text").alias("alt"))


def content_images(extracted: DataFrame, id: str = "page_id", context_chars: int | None = None) -> DataFrame:
    """(id, pos, url, alt, context): images that are not decoration, with absolute URLs; ``context`` is the whole text around one unless cut."""
    context = F.col("note") if context_chars is None else F.left("note", F.lit(context_chars))
    decorative = "(?i)" + K.DECORATIVE_NAME

    def keep(e):
        src = F.lower(e["url"])
        name = F.regexp_extract(F.regexp_replace(e["url"], r"(?s)\?.*$", ""), "([^/]*)$", 1)
        return ((X.strip(src) != "") & ~F.endswith(src, F.lit(".svg")) & ~F.contains(src, F.lit("image/svg"))
                & ~F.rlike(name, F.lit(decorative)) & ~F.rlike(e["text"], F.lit(decorative)) & (e["mark"] != ""))

    return _numbered(extracted, id, F.filter(_of("image"), keep), ("mark", "text", "note")).select(
        id, "pos", F.col("mark").alias("url"), F.col("text").alias("alt"), context.alias("context"))


def image_size_gate(w, h, n_bytes) -> Column:
    """True when an image is too small, too elongated or too light to use."""
    w, h = X._col(w), X._col(h)
    return (w < 300) | (h < 300) | (F.greatest(w, h) / F.greatest(F.lit(1), F.least(w, h)) > 5) | (X._col(n_bytes) < 5000)


def authority_links(extracted: DataFrame, id: str = "page_id") -> DataFrame:
    """(id, pos, url, text) of links to authority sources."""
    hits = F.filter(_of("link"), lambda e: L.is_authority(e["url"]))
    return _numbered(extracted, id, hits, ("url", "text")).select(id, "pos", "url", "text")


def reference_cards(extracted: DataFrame, internal_domains: Sequence[str] = (), id: str = "page_id") -> DataFrame:
    """(id, pos, url, title, authoritative) from reference cards, own hosts left out."""
    def keep(e):
        u = e["url"]
        inside = L.on_domain(F.lower(L.netloc(u)), internal_domains)
        return (u != "") & ~F.startswith(u, F.lit("#")) & ~F.startswith(u, F.lit("javascript:")) & ~inside

    rows = _numbered(extracted, id, F.filter(_of("reference"), keep), ("url", "text", "mark"))
    return rows.select(id, "pos", "url", F.when(F.col("text") != "", F.col("text")).otherwise(L.netloc("url")).alias("title"),
                       (F.col("mark") == "★").alias("authoritative"))


def social_preview(extracted: DataFrame, id: str = "page_id") -> DataFrame:
    """(id, image, title): preview image and title of a page; pages without an image are left out."""
    def meta(name):
        first = F.get(F.filter("elements", lambda e: (e["kind"] == "meta") & (e["note"] == name)), F.lit(0))["text"]
        return F.nullif(first, F.lit(""))

    title = F.get(_of("title"), F.lit(0))["text"]
    return extracted.select(id, F.coalesce(meta("og:image"), meta("twitter:image")).alias("image"),
                            F.coalesce(meta("og:title"), title, F.col("url")).alias("title")).where("image IS NOT NULL")


def page_figures(extracted: DataFrame, limit: int | None = None, id: str = "page_id") -> DataFrame:
    """(id, pos, url, caption): the figures, or the first ``limit``; bare images only where a page has no figure."""
    usable = lambda e: (e["url"] != "") & (e["text"] != "")
    figures = F.filter(_of("figure"), usable)
    bare = F.filter(_of("bare_figure"), lambda e: usable(e) & X.any_contains(e["note"], K.FIGURE_WORDS))
    chosen = F.when(F.size(figures) > 0, figures).otherwise(bare)
    chosen = chosen if limit is None else F.slice(chosen, 1, limit)
    return _numbered(extracted, id, chosen, ("url", "text")).select(id, "pos", "url", F.col("text").alias("caption"))


def page_source_table(extracted: DataFrame, rendered: DataFrame, id: str = "page_id", caption_chars: int | None = None) -> DataFrame:
    """Usable sources of a page: content images and rendered pages of authority PDFs.

    ``rendered`` holds (id, url, page_no) for every document page that could be rendered. An image without a text of
    its own is captioned by what stands around it, up to ``caption_chars`` if given.
    """
    around = F.col("context") if caption_chars is None else F.left("context", F.lit(caption_chars))
    imgs = content_images(extracted, id).select(
        id, F.lit("inline_image").alias("source_type"), F.col("url").alias("source_url"), F.col("pos"),
        F.when(F.col("alt") != "", F.col("alt")).otherwise(around).alias("caption"),
        X.tokens_alpha(F.concat_ws(" ", "alt", "context"), K.STOP_SOURCE).alias("tokens"))
    pdfs = authority_links(extracted, id).where(F.endswith(F.lower("url"), F.lit(".pdf"))).join(rendered, [id, "url"])
    pdfs = pdfs.select(id, F.lit("pdf_page").alias("source_type"), F.col("url").alias("source_url"), F.col("pos"),
                       F.when(F.col("text") != "", F.col("text")).otherwise(
                           F.concat(F.lit("Reference "), (F.col("pos") + 1).cast("string"))).alias("caption"))
    pdfs = pdfs.withColumn("tokens", X.tokens_alpha("caption", K.STOP_SOURCE))
    return imgs.unionByName(pdfs).withColumn("is_authority", L.is_authority("source_url"))


def page_source_warnings(extracted: DataFrame, sources: DataFrame, id: str = "page_id") -> DataFrame:
    """Pages with authority links of which none was rendered."""
    linked = extracted.select(id, F.size(F.filter(_of("link"), lambda e: L.is_authority(e["url"]))).cast("bigint").alias("n_links"))
    pdf_pages = sources.where("source_type = 'pdf_page'").select(id).distinct()
    return linked.where("n_links > 0").join(pdf_pages, id, "left_anti")


def lookup_metadata(pages: DataFrame, meta: DataFrame, url: str = "url", ordinal: str = "ord",
                    fields: Sequence[str] = ("region", "category"), ignore_slash: bool = False,
                    defaults: dict | None = None) -> DataFrame:
    """Left join on URL; of several matches the first by ``ordinal`` wins."""
    def key(c):
        return F.regexp_replace(c, "/+$", "") if ignore_slash else F.col(c)

    first = meta.groupBy(key(url).alias("_key")).agg(F.min_by(F.struct(*fields), ordinal).alias("_m"))
    out = pages.withColumn("_key", key(url)).join(first, "_key", "left").drop("_key")
    picked = [F.coalesce(F.col("_m")[f], F.lit((defaults or {}).get(f))).alias(f) for f in fields]
    return out.select(*[c for c in pages.columns], *picked)

"""Search responses of asset providers to one candidate table.

A response row is (provider, query, payload JSON). Each response is unpacked
inside its own row, so normalising shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions import text as X

ROW = "struct<url:string,caption:string,width:bigint,height:bigint,is_clip:boolean,duration_s:double,extra:map<string,string>>"
# Fixed values
CLIP_MIN_S, CLIP_MAX_S, CLIP_MIN_VIEWS = 30, 1200, 10000
WIKI_FILE = r"(?i)\.(jpg|jpeg|png|svg)$"
THUMB_HOSTS = ["encrypted-tbn", "gstatic.com"]
THUMB_MIN_WIDTH = 300
ARCHIVE_DETAILS = "https://archive.org/details"
ARCHIVE_DEFAULT_S = 120.0
CLIP_URL = "https://www.youtube.com/watch?v="


def _or(*cols) -> Column:
    """First non-empty text, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def _row(url, caption, width=None, height=None, is_clip=False, duration=None, **extra) -> Column:
    zero = F.lit(0).cast("bigint")
    parts = [x for k, v in extra.items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(F.coalesce(url, F.lit("")).alias("url"), F.coalesce(caption, F.lit("")).alias("caption"),
                    (zero if width is None else F.coalesce(width.cast("bigint"), zero)).alias("width"),
                    (zero if height is None else F.coalesce(height.cast("bigint"), zero)).alias("height"), F.lit(is_clip).alias("is_clip"),
                    (F.lit(None) if duration is None else duration).cast("double").alias("duration_s"),
                    (F.create_map(*parts) if parts else F.lit(None)).cast("map<string,string>").alias("extra")).cast(ROW)


@dataclass
class Provider:
    schema: str
    items: Callable[[Column], Column]
    row: Callable[[Column], Column]
    keep: Callable[[Column], Column] | None = None   # on items, before the limit
    limit_first: bool = True                         # cut the response before dropping rows without URL


def _upto(c, chars):
    return c if chars is None else F.left(c, F.lit(chars))


def _archive(d, chars=None):
    many = F.from_json(d["description"], "array<string>")
    desc = X.strip(F.when(F.startswith(F.coalesce(d["description"], F.lit("")), F.lit("[")), F.array_join(many, " ")).otherwise(F.coalesce(d["description"], F.lit(""))))
    title = _or(d["title"], d["identifier"])
    cap = F.when(desc != "", _upto(F.concat(title, F.lit(": "), desc), chars)).otherwise(title)
    secs = X.parse_runtime(d["runtime"])
    return _row(F.concat(F.lit(ARCHIVE_DETAILS + "/"), d["identifier"]), cap, is_clip=True, duration=F.when(secs > 0, secs).otherwise(ARCHIVE_DEFAULT_S))


def _clip(e, chars=None):
    cap = X.strip_chars(F.concat(F.coalesce(e["title"], F.lit("")), F.lit(" — "), _upto(F.coalesce(e["description"], F.lit("")), chars)), " —")
    return _row(F.concat(F.lit(CLIP_URL), F.coalesce(e["id"], F.lit(""))), cap, F.lit(1920), F.lit(1080), True, e["duration"],
                video_id=e["id"], view_count=e["view_count"], title=e["title"], channel=_or(e["channel"], e["uploader"]), thumbnail=e["thumbnail"])


def _clip_ok(e):
    d, views = F.coalesce(e["duration"], F.lit(0.0)), F.coalesce(e["view_count"], F.lit(0))
    junk = X.junk_title(F.coalesce(e["title"], F.lit(""))).isNotNull() | X.junk_title(_or(e["channel"], e["uploader"])).isNotNull()
    return d.between(CLIP_MIN_S, CLIP_MAX_S) & (views >= CLIP_MIN_VIEWS) & ~junk


def _image_items(p):
    """Known-small pictures out, each URL once, originals before thumbnails (those only if nothing else)."""
    rows = F.transform(p["items"], lambda d: F.struct(_or(d["original"], d["src"]).alias("url"), d["alt"].alias("alt"), F.coalesce(d["w"], F.lit(0)).alias("w"), F.coalesce(d["h"], F.lit(0)).alias("h")))
    rows = F.filter(rows, lambda d: (d["url"] != "") & ~((d["w"] > 0) & (d["w"] < THUMB_MIN_WIDTH)))
    once = F.filter(rows, lambda d, i: F.array_position(F.transform(rows, lambda r: r["url"]), d["url"]) == i + 1)
    thumb = lambda d: X.any_contains(d["url"], THUMB_HOSTS)
    full = F.filter(once, lambda d: ~thumb(d))
    return F.when(F.size(full) > 0, full).otherwise(once)


PROVIDERS: dict[str, Provider] = {
    "openverse": Provider("results array<struct<url:string,title:string,width:bigint,height:bigint,license:string,foreign_landing_url:string>>", lambda p: p["results"],
                          lambda r: _row(r["url"], r["title"], r["width"], r["height"], license=r["license"], foreign_landing_url=r["foreign_landing_url"])),
    "pexels": Provider("photos array<struct<src:struct<large2x:string,original:string>,alt:string,photographer:string,width:bigint,height:bigint>>", lambda p: p["photos"],
                       lambda r: _row(_or(r["src"]["large2x"], r["src"]["original"]), _or(r["alt"], r["photographer"]), r["width"], r["height"], photographer=r["photographer"])),
    "pixabay": Provider("hits array<struct<largeImageURL:string,webformatURL:string,tags:string,imageWidth:bigint,imageHeight:bigint>>", lambda p: p["hits"],
                        lambda r: _row(_or(r["largeImageURL"], r["webformatURL"]), r["tags"], r["imageWidth"], r["imageHeight"])),
    "pixabay_video": Provider("hits array<struct<videos:struct<large:struct<url:string>,medium:struct<url:string>>,tags:string,duration:double>>", lambda p: p["hits"],
                              lambda r: _row(F.coalesce(r["videos"]["large"], r["videos"]["medium"])["url"], r["tags"], is_clip=True, duration=F.coalesce(r["duration"], F.lit(0.0)))),
    "unsplash": Provider("results array<struct<urls:struct<raw:string>,alt_description:string,width:bigint,height:bigint,user:struct<name:string>>>", lambda p: p["results"],
                         lambda r: _row(r["urls"]["raw"], r["alt_description"], r["width"], r["height"], author=r["user"]["name"])),
    "bing": Provider("value array<struct<contentUrl:string,name:string,width:bigint,height:bigint>>", lambda p: p["value"],
                     lambda r: _row(r["contentUrl"], r["name"], r["width"], r["height"])),
    "wikimedia": Provider("query struct<pages:map<string,struct<title:string,imageinfo:array<struct<url:string,width:bigint,height:bigint,extmetadata:struct<ImageDescription:struct<value:string>>>>>>>",
                          lambda p: F.map_values(p["query"]["pages"]),
                          lambda r: _row(F.get(r["imageinfo"], F.lit(0))["url"], _or(F.get(r["imageinfo"], F.lit(0))["extmetadata"]["ImageDescription"]["value"], r["title"]),
                                         F.get(r["imageinfo"], F.lit(0))["width"], F.get(r["imageinfo"], F.lit(0))["height"]),
                          keep=lambda r: F.rlike(r["title"], F.lit(WIKI_FILE))),
    "archive_org": Provider("response struct<docs:array<struct<identifier:string,title:string,description:string,runtime:string>>>", lambda p: p["response"]["docs"], _archive,
                            keep=lambda d: F.coalesce(d["identifier"], F.lit("")) != "", limit_first=False),
    "youtube": Provider("entries array<struct<id:string,title:string,description:string,channel:string,uploader:string,duration:double,view_count:bigint,thumbnail:string>>", lambda p: p["entries"], _clip,
                        keep=_clip_ok, limit_first=False),
    "duckduckgo": Provider("items array<struct<image:string,title:string,width:bigint,height:bigint>>", lambda p: p["items"],
                           lambda r: _row(r["image"], r["title"], r["width"], r["height"])),
    "google_images": Provider("items array<struct<src:string,original:string,alt:string,w:bigint,h:bigint>>", _image_items,
                              lambda r: _row(r["url"], r["alt"], r["w"], r["h"]), limit_first=False),
}


def _row_of(p: Provider, caption_chars: int | None) -> Callable[[Column], Column]:
    return (lambda r: p.row(r, caption_chars)) if p.row in (_archive, _clip) else (lambda r: p.row(r))


def normalize_candidates(responses: DataFrame, limit: int | None = None, caption_chars: int | None = None) -> DataFrame:
    """(query, source, ord, url, caption, width, height, file_size, is_clip, duration_s, extra); unreadable payloads give no rows.

    Every item with a URL is a row, with its whole caption. ``limit`` cuts each response, for most providers before
    items without a URL go; ``caption_chars`` cuts the captions that are made of descriptions.
    """
    rows = F.expr(f"cast(array() as array<{ROW}>)")
    for name, p in PROVIDERS.items():
        items = p.items(F.from_json("payload", p.schema))
        if p.keep is not None:
            items = F.filter(items, p.keep)
        if p.limit_first and limit is not None:
            items = F.slice(items, 1, limit)
        made = F.filter(F.transform(items, _row_of(p, caption_chars)), lambda r: r["url"] != "")
        rows = F.when(F.col("provider") == name, made if limit is None else F.slice(made, 1, limit)).otherwise(rows)
    source = F.when(F.col("provider") == "pixabay_video", "pixabay").otherwise(F.col("provider"))
    out = responses.select("query", source.alias("source"), F.posexplode(rows).alias("ord", "_r"))
    return out.select("query", "source", F.col("ord").cast("bigint").alias("ord"), "_r.url", "_r.caption", "_r.width", "_r.height",
                      F.lit(0).cast("bigint").alias("file_size"), "_r.is_clip", "_r.duration_s", "_r.extra")

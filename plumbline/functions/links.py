"""Column functions over URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline import constants as K
from plumbline.functions.text import _col, any_contains

_AUTHORITY = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def netloc(url) -> Column:
    return F.regexp_extract(_col(url), _AUTHORITY, 1)


def path(url) -> Column:
    """Path without query, fragment and last-segment parameters."""
    p = F.regexp_extract(_col(url), r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(p, ";[^/]*$", "")


def host(url) -> Column:
    """Lower-case host without port."""
    return F.regexp_replace(F.lower(netloc(url)), "(?s):.*$", "")


def slug(url) -> Column:
    """Last path part, extension cut, spaces to dashes, lower case."""
    last = F.regexp_extract(F.regexp_replace(path(url), "^/+|/+$", ""), "([^/]*)$", 1)
    return F.lower(F.replace(F.regexp_replace(last, r"\.[^.]*$", ""), F.lit(" "), F.lit("-")))


def slug_strict(url, default: str = "video", limit: int = 60) -> Column:
    """Last part of the whole URL reduced to a-z, 0-9 and single dashes."""
    last = F.regexp_extract(F.regexp_replace(_col(url), "/+$", ""), "([^/]*)$", 1)
    s = F.regexp_replace(F.regexp_replace(F.lower(last), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    s = F.left(s, F.lit(limit))
    return F.when(s == "", default).otherwise(s)


def domain(url) -> Column:
    return F.regexp_replace(netloc(url), r"^www\.", "")


def on_domain(host_col, domains) -> Column:
    """True when the host is one of ``domains`` or a subdomain of one."""
    if not domains:
        return F.lit(False)
    names = "|".join(d.replace(".", "[.]") for d in domains)
    return F.rlike(_col(host_col), F.lit(f"^(?:.*[.])?(?:{names})$"))


def classify_link(url, strict: bool = False) -> Column:
    """'paper', 'standard' or 'web'; ``strict`` compares hosts instead of substrings."""
    if strict:
        h = host(url)
        return (F.when(on_domain(h, K.PAPER_DOMAINS), "paper")
                .when(on_domain(h, K.STANDARD_DOMAINS), "standard").otherwise("web"))
    low = F.lower(_col(url))
    return (F.when(any_contains(low, K.PAPER_DOMAINS), "paper")
            .when(any_contains(low, K.STANDARD_DOMAINS), "standard").otherwise("web"))


def is_pdf_url(url) -> Column:
    p, h = F.lower(path(url)), F.lower(netloc(url))
    hosts = F.lit(False)
    for x in K.PDF_HOSTS:
        hosts = hosts | F.endswith(h, F.lit(x))
    return F.endswith(p, F.lit(".pdf")) | ((F.contains(p, F.lit("/pdf/")) | F.endswith(p, F.lit("/pdf"))) & hosts)


def is_authority(url) -> Column:
    return F.rlike(_col(url), F.lit("(?i)" + K.AUTHORITY_LINK))


def blacklisted(url) -> Column:
    return on_domain(host(url), K.STOCK_DOMAINS)


def citation_chip(marker, url, known, default: str = "Source") -> Column:
    return F.when(known, F.concat(F.lit("Source ["), _col(marker).cast("string"), F.lit("] — "), domain(url))).otherwise(default)

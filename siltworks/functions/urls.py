"""URLs and HTML, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

#: Image types by extension.
MIME_BY_EXT = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif",
    "webp": "image/webp", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff",
}
#: Parts of URLs that tell decoration from content.
DECORATION = (
    "icon", "logo", "avatar", "emoji", "banner", "ad", "btn", "sprite",
    "bg", "arrow", "nav", "footer", "header", "qrcode", "wechat", "badge",
    "loading", "placeholder", "default", "thumb_s", "-gray",
    "play", "ico", "pixel", "counter", "stat",
)
_IMAGE = r"(?i)\.(?:jpg|jpeg|png|webp)"


def scheme(url) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(_c(url), F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url) -> Column:
    """Lower-case host with port, or an empty text."""
    return F.lower(F.regexp_extract(F.coalesce(_c(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def host_in(url, suffixes: list[str], media_wildcard: bool = False) -> Column:
    """Whether the host is one of the suffixes or below one; ``*`` among them allows any if ``media_wildcard``."""
    if media_wildcard and "*" in suffixes:
        return F.lit(True)
    h = host(url)
    return F.exists(F.array(*(F.lit(s) for s in suffixes)), lambda s: (h == s) | h.endswith(F.concat(F.lit("."), s))) if suffixes else F.lit(False)


def extension(url) -> Column:
    """What follows the last dot, up to a question mark, in lower case."""
    return F.lower(F.substring_index(F.substring_index(F.coalesce(_c(url), F.lit("")), ".", -1), "?", 1))


def mime_by_extension(key, url=None, more: dict[str, str] | None = None) -> Column:
    """The type that a field's extension names, else that of a URL's extension, else null."""
    table = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    first = table(MIME_BY_EXT | (more or {}))[F.lower(F.coalesce(_c(key).cast("string"), F.lit("")))]
    return F.coalesce(first, table(MIME_BY_EXT)[extension(url)]) if url is not None else first


def query_dims(url) -> Column:
    """``struct(w, h)`` from a URL's query, in either order; null unless both are there."""
    number = lambda k: F.regexp_extract(F.coalesce(_c(url), F.lit("")), rf"[?&]{k}=(\d+)", 1).try_cast("bigint")
    return F.when(number("w").isNotNull() & number("h").isNotNull(), F.struct(number("w").alias("w"), number("h").alias("h")))


def to_https(url) -> Column:
    return F.regexp_replace(_c(url), "(?i)^http://", "https://")


def original_size(url, variants: str = "square|small|medium|large") -> Column:
    """A photo URL's size variant replaced by the original."""
    return F.regexp_replace(_c(url), rf"/(?:{variants})\.", "/original.")


def images(page, hints: tuple[str, ...] = (), cap: int = 40, exclude: tuple[str, ...] = (), upgrade: bool = False) -> Column:
    """Image URLs of a page, in order: of each img tag the leftmost source attribute, then srcset entries.

    With ``hints``, URLs that hold one of them come first.  URLs without an
    image extension, with a decoration's name or an excluded part go; repeats
    go; at most ``cap`` stay.
    """
    page = F.coalesce(_c(page), F.lit(""))
    # fixed values: the attributes of an image's source, in this order
    tags = F.regexp_extract_all(page, F.lit(r"(?i)(<img\b[^>]*>)"), F.lit(1))
    clean = lambda u: F.replace(F.trim(u), F.lit("&amp;"), F.lit("&"))
    source = r"""(?i)(?:data-original|data-src|data-ori|data-lazy-src|src)\s*=\s*["']([^"']+)["']"""
    plain = F.transform(tags, lambda t: clean(F.regexp_extract(t, source, 1)))
    sets = F.regexp_extract_all(page, F.lit(r"""(?i)srcset\s*=\s*["']([^"']+)["']"""), F.lit(1))
    entries = F.transform(F.flatten(F.transform(sets, lambda s: F.split(s, ","))), lambda p: clean(F.regexp_extract(F.trim(p), r"^(\S+)", 1)))
    found = F.filter(F.concat(plain, entries), lambda u: F.lower(u).startswith("http") & u.rlike(_IMAGE))
    if upgrade:
        found = F.transform(found, to_https)
    unwanted = F.array(*(F.lit(p) for p in (*DECORATION, *exclude)))
    found = F.filter(found, lambda u: ~F.exists(unwanted, lambda p: F.lower(u).contains(p)))
    if hints:
        hinted = lambda u: F.exists(F.array(*(F.lit(h) for h in hints)), lambda h: F.lower(u).contains(h))
        found = F.concat(F.filter(found, hinted), F.filter(found, lambda u: ~hinted(u)))
    return F.slice(F.array_distinct(found), 1, cap)


def links(page) -> Column:
    """The href values of a page, distinct, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(_c(page), F.lit("")), F.lit(r"""(?i)href\s*=\s*["']([^"']+)["']"""), F.lit(1)))


#: The endings of image URLs in a sample.
IMAGE_ENDINGS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".tif", ".tiff")


def ends_as_image(url) -> Column:
    """Whether a URL, up to a question mark, ends as an image's does."""
    plain = F.substring_index(F.lower(_c(url)), "?", 1)
    return F.exists(F.array(*(F.lit(e) for e in IMAGE_ENDINGS)), lambda e: plain.endswith(e))


def media_hosts(sample) -> Column:
    """The distinct hosts of https image URLs among the values of a JSON text, sorted."""
    texts = F.regexp_extract_all(F.coalesce(_c(sample), F.lit("")), F.lit(r'"(https://(?:[^"\\]|\\.)*)"'), F.lit(1))
    found = F.filter(F.transform(texts, lambda u: F.replace(u, F.lit("\\/"), F.lit("/"))), ends_as_image)
    return F.array_sort(F.array_distinct(F.transform(found, host)))


def robots_allow(path, disallowed) -> Column:
    """Whether no disallowed prefix (an array) starts a path."""
    return ~F.exists(_c(disallowed), lambda p: (p != "") & _c(path).startswith(p))

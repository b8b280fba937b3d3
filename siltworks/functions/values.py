"""Numbers, content and parsed model replies, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def safe_int(x, default: int | None = None) -> Column:
    n = F.trim(_c(x).cast("string")).try_cast("bigint")
    return n if default is None else F.coalesce(n, F.lit(default))


def clamp(x, low: int = 0, high: int = 10) -> Column:
    """Null stays null: an unknown score is not a low one."""
    return F.when(_c(x).isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), _c(x))))


def page_size(n, factor: float, low: int, high: int) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), (_c(n) * factor).cast("int")))


def backoff(attempt, base: float = 5.0, most: float = 120.0) -> Column:
    """Seconds before the next try, doubling."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), _c(attempt) - 1), F.lit(most))


def signature(fields: dict[str, object], secret: str = "") -> Column:
    """The md5 of a request's fields as ``name=value``, in order of name, joined by ampersands, with a secret behind."""
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(F.coalesce(_c(fields[k]).cast("string"), F.lit("")))) for k in sorted(fields)]
    return F.md5(F.concat(F.concat_ws("&", *pairs), F.lit(secret)))


def mirror_loss(own, mirror) -> Column:
    """By what share, in per cent, a mirror beats the origin."""
    return F.round((1 - _c(own) / F.nullif(_c(mirror), F.lit(0.0))) * 100, 1)


def within(a, b, share: float = 0.03, least: int = 8) -> Column:
    """Whether two sizes differ by at most a share of the second, or a few pixels."""
    return F.abs(_c(a) - _c(b)) <= F.greatest(F.abs(_c(b)) * share, F.lit(least))


def shard_of(key, shards) -> Column:
    return F.crc32(_c(key).cast("binary")) % shards


def timestamp_of(seconds) -> Column:
    return F.timestamp_seconds(_c(seconds))


def dot(a, b) -> Column:
    """The inner product of two arrays, in double precision."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a, b) -> Column:
    """Cosine of two arrays, in double precision, with a small term against zero length."""
    a, b = _c(a), _c(b)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)


def square_distance(a, b) -> Column:
    gap = F.zip_with(_c(a), _c(b), lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double")))
    return F.aggregate(gap, F.lit(0.0), lambda s, v: s + v)


def content_hash(data) -> Column:
    return F.sha2(_c(data).cast("binary"), 256)


def blob_path(sha, ext) -> Column:
    """Where a blob lies: a folder for the first two digits, and the extension, jpg if unknown."""
    ext = F.coalesce(F.nullif(F.ltrim(_c(ext), F.lit(".")), F.lit("")), F.lit("jpg"))
    return F.concat(F.lit("blobs/"), F.left(_c(sha), F.lit(2)), F.lit("/"), _c(sha), F.lit("."), ext)


def sniffed(data) -> Column:
    """An image's type by its first bytes, or null."""
    starts = lambda digits, at=1: F.substring(_c(data), at, len(digits) // 2) == F.to_binary(F.lit(digits), F.lit("hex"))
    return (
        F.when(starts("FFD8FF"), "image/jpeg")
        .when(starts("89504E470D0A1A0A"), "image/png")
        .when(starts("474946383761") | starts("474946383961"), "image/gif")
        .when(starts("52494646") & starts("57454250", 9), "image/webp")
        .when(starts("49492A00") | starts("4D4D002A"), "image/tiff")
        .when(starts("424D"), "image/bmp")
    )


def extension_of_mime(mime) -> Column:
    names = {"image/jpeg": "jpg", "image/png": "png", "image/gif": "gif", "image/webp": "webp", "image/tiff": "tiff", "image/bmp": "bmp"}
    return F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[_c(mime)]


def json_object(reply, key: str) -> Column:
    """The first flat JSON object in a free text that has a key, or null."""
    return F.nullif(F.regexp_extract(F.coalesce(_c(reply), F.lit("")), rf'(\{{[^{{}}]*"{key}"[^{{}}]*\}})', 1), F.lit(""))


def annotation(reply, least_caption: int = 40, need_identity: bool = False) -> Column:
    """``struct(kb_match, richness, caption, identity)``; null if a score or the caption is missing, or the caption short.

    With ``need_identity`` a reply also needs a true or false; a text such as "yes" fails.
    """
    body = json_object(reply, "kb_match")
    field = lambda k: F.get_json_object(body, f"$.{k}")
    score = lambda k: clamp(field(k).try_cast("double").cast("int"))
    caption = F.trim(field("caption"))
    identity = F.regexp_extract(body, r'"identity"\s*:\s*(true|false)\b', 1)
    good = score("kb_match").isNotNull() & score("richness").isNotNull() & (F.length(caption) >= least_caption)
    if need_identity:
        good &= identity != ""
    flag = F.when(identity != "", identity == "true")
    return F.when(good, F.struct(score("kb_match").alias("kb_match"), score("richness").alias("richness"), caption.alias("caption"), flag.alias("identity")))


def verdict(reply) -> Column:
    """``struct(verdict, score, issues, reason)``; an unknown verdict is ``uncertain``, missing issues are none."""
    body = json_object(reply, "verdict")
    said = F.lower(F.trim(F.get_json_object(body, "$.verdict")))
    return F.when(
        body.isNotNull(),
        F.struct(
            F.when(said.isin("keep", "drop", "uncertain"), said).otherwise("uncertain").alias("verdict"),
            safe_int(F.get_json_object(body, "$.score")).cast("int").alias("score"),
            F.coalesce(F.from_json(F.get_json_object(body, "$.issues"), "array<string>"), F.array().cast("array<string>")).alias("issues"),
            F.get_json_object(body, "$.reason").alias("reason"),
        ),
    )


def nearest_rank(values, share: float) -> Column:
    """The element of the sorted values at the rounded place share * (n - 1), halves to even; null if empty."""
    ordered = F.array_sort(_c(values))
    return F.get(ordered, F.bround(F.lit(share) * (F.size(ordered) - 1), 0).cast("int"))


def upper_median(values) -> Column:
    """Element n // 2 of the sorted values."""
    ordered = F.array_sort(_c(values))
    return F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))

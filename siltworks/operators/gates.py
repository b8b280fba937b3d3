"""Filters and gates: predicates, and reasons for the first failing check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls

#: The default types and licences that pass.
MIMES = ["image/jpeg", "image/png", "image/webp", "image/gif", "image/tiff", "image/bmp"]
LICENSES = ["CC BY", "CC BY-SA", "CC0", "Public domain", "CC BY 4.0", "CC BY-SA 4.0", "CC BY-NC", "CC BY-NC-SA", "CC BY-ND", "CC BY-NC-ND"]
MAX_FILE_BYTES = 10 << 20


def select_where(
    df: DataFrame,
    columns: list[str] | None = None,
    min_width: int = 0,
    min_height: int = 0,
    sources: list[str] | None = None,
    authorized: bool | None = None,
    licenses: list[str] | None = None,
    where: str | None = None,
    order_by: str | None = None,
    descending: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Filter, order, limit and project a manifest-like table.

    Zero, empty and None turn a filter off; ``where`` is SQL text and is added
    to the others.  Nulls come last in either direction, and a limit is taken
    after the order, so Spark plans a top-k.  Filters and columns reach the scan.
    """
    keep = F.lit(True)
    if min_width:
        keep &= F.col("width") >= min_width
    if min_height:
        keep &= F.col("height") >= min_height
    if sources:
        keep &= F.col("source").isin(sources)
    if authorized is not None:
        keep &= F.col("source_authorized") == authorized
    if licenses:
        keep &= F.col("license").isin(licenses)
    df = df.where(keep)
    if where:
        df = df.where(where)
    if order_by:
        df = df.orderBy(F.col(order_by).desc_nulls_last() if descending else F.col(order_by).asc_nulls_last())
    if limit is not None:
        df = df.limit(limit)
    return df.select(*columns) if columns else df


def plain_license(x: Column) -> Column:
    return F.trim(F.replace(F.lower(F.coalesce(x, F.lit(""))), F.lit("-"), F.lit(" ")))


def license_allowed(x: Column, allowed: list[str]) -> Column:
    """Whether an allowed term is part of the licence, both in plain form; so CC BY allows all its variants."""
    terms = F.array(*(plain_license(F.lit(a)) for a in allowed))
    return F.exists(terms, lambda a: plain_license(x).contains(a))


def _url_reason(url: Column, hosts: list[str] | None) -> Column:
    reason = F.when(F.coalesce(url, F.lit("")) == "", "no_url").when(urls.scheme(url) != "https", "not_https")
    return reason if hosts is None else reason.when(~urls.host_in(url, hosts), "host_not_allowed")


def authorized_reason(url, mime, size, license_, hosts: list[str] | None, mimes: list[str] = MIMES, max_bytes: int = MAX_FILE_BYTES, licenses: list[str] = LICENSES) -> Column:
    """Why a candidate of an authorised source fails, or null: URL, type, declared size (null passes), licence, in this order."""
    return (
        _url_reason(url, hosts)
        .when(F.coalesce(mime, F.lit("")) == "", "no_mime")
        .when(~mime.isin(mimes), "mime_not_allowed")
        .when(F.coalesce(size > max_bytes, F.lit(False)), "too_large")
        .when(F.coalesce(license_, F.lit("")) == "", "no_license")
        .when(~license_allowed(license_, licenses), "license_not_allowed")
    )


def unauthorized_reason(url, mime, size, hosts: list[str] | None = None, mimes: list[str] = MIMES, max_bytes: int = MAX_FILE_BYTES) -> Column:
    """The same for other sources: a missing type passes and the licence isn't asked for."""
    return _url_reason(url, hosts).when((F.coalesce(mime, F.lit("")) != "") & ~mime.isin(mimes), "mime_not_allowed").when(F.coalesce(size > max_bytes, F.lit(False)), "too_large")


def split(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``reject_reason``)."""
    marked = df.withColumn("reject_reason", reason)
    return marked.where("reject_reason IS NULL").drop("reject_reason"), marked.where("reject_reason IS NOT NULL")


def resolution_status(width, height, min_width: int = 0, min_height: int = 0) -> Column:
    """``gate_rejected`` if a side is under its least; 0 is off, and an unknown side counts as 0."""
    low = lambda x, least: F.coalesce(x, F.lit(0)) < least
    return F.when(low(width, min_width) | low(height, min_height), "gate_rejected").otherwise("ok")


def auto_keep(width, height, least: int) -> Column:
    """Whether an image is too small to be sent to a model, and so is kept as it is."""
    return F.least(F.coalesce(width, F.lit(0)), F.coalesce(height, F.lit(0))) < least


def declared_mismatch(declared_mime, actual_mime, declared_size, actual_size) -> Column:
    """``mime`` or ``size`` (off by more than half and 1 MiB), or null."""
    off = F.abs(actual_size - declared_size) > F.greatest(declared_size * 0.5, F.lit(float(1 << 20)))
    return F.when((F.coalesce(declared_mime, F.lit("")) != "") & (declared_mime != actual_mime), "mime").when(F.coalesce(off, F.lit(False)), "size")


def ordered_reason(gates: list[tuple[str, Column]]) -> Column:
    """The first gate whose condition holds (a null one does not), or null."""
    reason = None
    for name, failing in gates:
        failing = F.coalesce(failing, F.lit(False))
        reason = F.when(failing, name) if reason is None else reason.when(failing, name)
    return reason if reason is not None else F.lit(None).cast("string")


#: Ratings, formats and tags of bulk posts that pass or, the last, don't.
POST_RATINGS = ("g",)
POST_FORMATS = ("jpg", "jpeg", "png", "gif", "webp", "bmp")
BAD_TAGS = (
    "lowres", "bad_id", "bad_link", "bad_pixiv_id", "bad_twitter_id",
    "watermark", "watermarked", "translated", "commentary",
    "third-party_edit", "censored", "spoilers", "downscaled",
)


def post_gates(min_score: int | None = 0, min_side: int = 0, ratings: tuple[str, ...] = POST_RATINGS, formats: tuple[str, ...] = POST_FORMATS, bad_tags: tuple[str, ...] = BAD_TAGS) -> list[tuple[str, Column]]:
    """The value gates of bulk posts, in order.  A score or side of zero or None is no gate."""
    tags = F.split(F.coalesce("tag_string", F.lit("")), r"\s+")
    gates = [
        ("rating", ~F.coalesce("rating", F.lit("")).isin(*ratings)),
        ("deleted", F.col("is_deleted")),
        ("flagged", F.col("is_flagged") | F.col("is_pending")),
        ("score", F.coalesce("score", F.lit(0)) < (min_score or 0)),
        ("format", ~F.lower(F.coalesce("file_ext", F.lit(""))).isin(*formats)),
        ("small", F.least(F.coalesce("image_width", F.lit(0)), F.coalesce("image_height", F.lit(0))) < min_side),
        ("bad_tag", F.arrays_overlap(tags, F.array(*(F.lit(t) for t in bad_tags))) if bad_tags else F.lit(False)),
    ]
    return [g for g in gates if (min_score or g[0] != "score") and (min_side or g[0] != "small")]


def funnel(df: DataFrame, reason: Column) -> DataFrame:
    """``(reason, n)``: how many rows each gate takes; ``accepted`` for those that pass."""
    return df.groupBy(F.coalesce(reason, F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def instance_filter(name, substrings: list[str] | None = None, exact: list[str] | None = None) -> Column:
    """Any of the substrings and one of the exact names; an empty list is off."""
    keep = F.lit(True)
    if substrings:
        keep &= F.exists(F.array(*(F.lit(s) for s in substrings)), lambda s: name.contains(s))
    if exact:
        keep &= name.isin(exact)
    return keep


def weak_source(ok, fail, dead, timeout) -> Column:
    """Thirty tries or more, none good, and dead ends or time-outs for 60 % of failures; an unknown ``fail`` counts as 1 there."""
    n = lambda x: F.coalesce(x, F.lit(0))
    tried = n(ok) + n(fail) + n(dead) >= 30
    return tried & (n(ok) == 0) & (n(dead) + n(timeout) >= 0.6 * F.greatest(F.coalesce(fail, F.lit(1)), F.lit(1)))


def congested(kind) -> Column:
    return F.coalesce(kind.isin("timeout", "network_error", "http_429", "http_500", "http_502", "http_503", "http_504"), F.lit(False))


def status_class(code) -> Column:
    """``ok`` (under 400), ``transient`` (429 and from 500: try again) or ``deterministic`` of an HTTP status; none at all is transient."""
    return F.when(code < 400, "ok").when(code.isNull() | (code == 429) | (code >= 500), "transient").otherwise("deterministic")


def usable(lifecycle) -> Column:
    return lifecycle.isin("active", "probation")


def relative_path(path, root: str) -> Column:
    """An absolute path below a root as a relative one; others as they are."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).when(path.startswith("/") & path.contains("/blobs/"), F.concat(F.lit("blobs/"), F.substring_index(path, "/blobs/", -1))).otherwise(path)


def pools(df: DataFrame, control: int = 5000, key: str = "sha256", score: str = "kb_match", caption: str = "caption") -> DataFrame:
    """Rows with ``pool``: ``anom`` for scores up to 3, ``ctrl`` for the first ``control`` keys with 7 or more; captions must not be blank."""
    rows = df.where(F.trim(F.coalesce(caption, F.lit(""))) != "")
    low = rows.where(F.col(score) <= 3).withColumn("pool", F.lit("anom"))
    high = rows.where(F.col(score) >= 7).orderBy(key).limit(control).withColumn("pool", F.lit("ctrl"))
    return low.unionByName(high)


def structure(rows: DataFrame, width: str = "width", height: str = "height", url: str = "content_url", mime: str = "mime") -> DataFrame:
    """One row on a source's sample: count, shares with sizes and with an image's ending or type, and whether it passes (3 rows, half, half)."""
    sized = F.avg(((F.coalesce(width, F.lit(0)) != 0) & (F.coalesce(height, F.lit(0)) != 0)).cast("double"))
    looks = F.avg((F.coalesce(urls.ends_as_image(url), F.lit(False)) | F.coalesce(F.col(mime).startswith("image/"), F.lit(False))).cast("double"))
    out = rows.agg(F.count("*").alias("n"), F.coalesce(sized, F.lit(0.0)).alias("with_size"), F.coalesce(looks, F.lit(0.0)).alias("with_image_url"))
    return out.withColumn("passes", (F.col("n") >= 3) & (F.col("with_size") >= 0.5) & (F.col("with_image_url") >= 0.5))


def resolved(job: dict[str, object], defaults: dict[str, object]) -> dict[str, object]:
    """A job's settings, where it has any, over the defaults."""
    return {k: job[k] if job.get(k) is not None else v for k, v in defaults.items()}

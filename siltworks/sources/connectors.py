"""Connectors: search replies into candidates, and the seam to the network.

Fetching is a function that the caller injects; a Python data source calls it
on executors, one partition a job.  What a site's reply means is a projection
below, over replies that are already there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text, urls, values
from ..operators.ranking import first_of, top_n
from .spec import items

Fetch = Callable[[dict], list[dict]]
_REGISTRY: dict[str, Fetch] = {}


def register(name: str, fetch: Fetch) -> None:
    """Name a fetcher: one job to a list of ``{"source", "instance", "query", "document"}``."""
    _REGISTRY[name] = fetch


def registered() -> list[str]:
    return sorted(_REGISTRY)


class SearchSource(DataSource):
    """``spark.read.format("search")`` with options ``fetcher`` and ``jobs`` (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "search"

    def schema(self) -> str:
        return "source string, instance string, query string, document string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        name = options["fetcher"]
        if name not in _REGISTRY:
            raise ValueError(f"no fetcher is registered as {name}")
        self.fetch, self.jobs = _REGISTRY[name], json.loads(options["jobs"])

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(job) for job in self.jobs]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        job = partition.value
        for reply in self.fetch(job):
            yield tuple(reply.get(k, job.get(k)) for k in ("source", "instance", "query", "document"))


def paged_rows(fetch: Callable[[int, int], list[dict]], offset: int, most: int, page: int = 100) -> Iterator[dict]:
    """Rows of a paged service from an offset, at most ``most``; a short page ends it."""
    while most > 0:
        rows = fetch(offset, min(page, most))
        yield from rows
        if len(rows) < min(page, most):
            return
        offset, most = offset + len(rows), most - len(rows)


def listed(replies: DataFrame, path: str, cap: int | None = None, document: str = "document") -> DataFrame:
    """Replies exploded to their items (JSON texts), with their place as ``source_rank``."""
    found = items(F.col(document), path)
    found = F.slice(found, 1, cap) if cap else found
    rest = [c for c in replies.columns if c != document]
    return replies.select(*rest, F.posexplode(found).alias("source_rank", "item"))


def _get(path: str, item: str = "item") -> Column:
    return F.get_json_object(item, f"$.{path}")


def _https(url: Column) -> Column:
    return urls.to_https(url)


def once(rows: DataFrame, key: str = "content_url", by: tuple[str, ...] = ("source", "instance")) -> DataFrame:
    """Rows with a key, the first of each."""
    return first_of(rows.where(F.coalesce(key, F.lit("")) != ""), [*by, key], ["source_rank"])


def file_pages(replies: DataFrame, cap: int = 50) -> DataFrame:
    """File pages with image info: sorted by the reply's own index, without those that have no size, once a title."""
    rows = listed(replies, "$.query.pages")
    # pages come as an object keyed by id, or as a list
    keyed = replies.select("*", F.explode_outer(F.map_values(F.from_json(F.get_json_object("document", "$.query.pages"), "map<string,string>"))).alias("item")).where("item IS NOT NULL").drop("document").withColumn("source_rank", F.lit(0))
    rows = rows.unionByName(keyed.select(*rows.columns))
    info = "imageinfo[0]"
    meta = lambda k: text.strip_tags(_get(f"{info}.extmetadata.{k}.value"))
    out = rows.select(
        "source", "instance", "query",
        values.safe_int(_get("index"), 0).alias("source_rank"), _get("title").alias("asset_id"), _get(f"{info}.url").alias("content_url"), _get(f"{info}.descriptionurl").alias("landing_url"),
        values.safe_int(_get(f"{info}.width")).alias("declared_width"), values.safe_int(_get(f"{info}.height")).alias("declared_height"), values.safe_int(_get(f"{info}.size")).alias("declared_size"),
        _get(f"{info}.mime").alias("declared_mime"), meta("Artist").alias("author"), F.coalesce(F.nullif(meta("LicenseShortName"), F.lit("")), meta("UsageTerms")).alias("license_raw"),
    )
    out = once(out.where("declared_width IS NOT NULL AND declared_height IS NOT NULL"), "asset_id")
    return top_n(out, ["source", "instance"], ["source_rank", "asset_id"], cap)


def observations(replies: DataFrame) -> DataFrame:
    """Observations with photos: a row for each photo, the photo's licence before the observation's, the original's URL."""
    rows = listed(replies, "$.results").select("*", F.posexplode(F.from_json(_get("photos"), "array<variant>")).alias("at", "p"))
    photo = lambda k: F.try_variant_get("p", F.lit(f"$.{k}"), "string")
    return once(rows.select(
        "source", "instance", "query", F.col("source_rank"), photo("id").alias("asset_id"), urls.original_size(photo("url")).alias("content_url"), _get("uri").alias("landing_url"),
        F.coalesce(photo("license_code"), _get("license_code")).alias("license_raw"), photo("attribution").alias("credit"), _get("user.login").alias("author"),
        values.safe_int(_get("cached_votes_total"), 0).cast("double").alias("source_score"),
    ))


def image_results(replies: DataFrame, path: str = "$.data", url_fields: tuple[str, ...] = ("hoverURL", "middleURL", "objURL", "thumbURL"), cap: int = 40) -> DataFrame:
    """Image search replies: the first URL field that has one, sizes from fields or the URL's query, once each."""
    rows = listed(replies, path, cap)
    url = _https(F.coalesce(*(F.nullif(_get(f), F.lit("")) for f in url_fields)))
    dims = urls.query_dims(url)
    return once(rows.select(
        "source", "instance", "query", "source_rank", url.alias("content_url"), _get("fromURL").alias("landing_url"),
        F.coalesce(F.nullif(values.safe_int(_get("width"), 0), F.lit(0)), dims["w"]).alias("declared_width"), F.coalesce(F.nullif(values.safe_int(_get("height"), 0), F.lit(0)), dims["h"]).alias("declared_height"),
    ))


def page_images(replies: DataFrame, hints: tuple[str, ...] = (), cap: int = 40, exclude: tuple[str, ...] = (), document: str = "document") -> DataFrame:
    """Images of result pages in HTML: see :func:`siltworks.functions.urls.images`."""
    found = urls.images(F.col(document), hints, cap, exclude, upgrade=True)
    return replies.select("source", "instance", "query", F.posexplode(found).alias("source_rank", "content_url"))


def pattern_images(replies: DataFrame, pattern: str, cap: int = 40, document: str = "document") -> DataFrame:
    """URLs that a pattern's first group finds in a reply of any form, with escaped slashes undone."""
    found = F.transform(F.regexp_extract_all(F.col(document), F.lit(pattern), F.lit(1)), lambda u: _https(F.replace(F.replace(u, F.lit("\\/"), F.lit("/")), F.lit("&amp;"), F.lit("&"))))
    return replies.select("source", "instance", "query", F.posexplode(F.slice(F.array_distinct(found), 1, cap)).alias("source_rank", "content_url"))


#: The ratings that pass, by board.
SAFE = {"danbooru": ("g",), "gelbooru": ("general", "safe")}


def posts(replies: DataFrame, path: str = "$", ratings: tuple[str, ...] | None = None, cap: int = 40) -> DataFrame:
    """Image board posts of a safe rating with an https file, at most ``cap``.  By default a board's own ratings pass, any board's for one not named."""
    rows = listed(replies, path)
    url = F.coalesce(_get("file_url"), _get("large_file_url"))
    safe = _get("rating").isin(*(ratings or {r for own in SAFE.values() for r in own}))
    if ratings is None:
        for board, own in SAFE.items():
            safe = F.when(F.col("source") == board, _get("rating").isin(*own)).otherwise(safe)
    out = rows.where(safe & F.coalesce(url.startswith("https://"), F.lit(False)))
    out = out.select("source", "instance", "query", "source_rank", _get("id").alias("asset_id"), url.alias("content_url"), values.safe_int(F.coalesce(_get("image_width"), _get("width"))).alias("declared_width"),
                     values.safe_int(F.coalesce(_get("image_height"), _get("height"))).alias("declared_height"), values.safe_int(_get("score"), 0).cast("double").alias("source_score"), F.coalesce(_get("tag_string"), _get("tags")).alias("evidence"))
    return top_n(out, ["source", "instance"], ["source_rank"], cap)


def captioned(rows: DataFrame, jobs: DataFrame, target: int, factor: int = 3, floor: int = 4) -> DataFrame:
    """Rows of a captioned set whose caption has all tokens of a job's query, at most ``max(floor, factor * target)`` a job.

    Jobs and rows meet on the query's first token, so it is an equi-join.
    """
    j = jobs.withColumn("_t", F.get(text.tokens("query"), F.lit(0))).where("_t IS NOT NULL")
    r = rows.withColumn("_t", F.explode(F.array_distinct(text.tokens("caption"))))
    out = r.join(j, "_t").where(text.all_tokens_in("query", "caption")).drop("_t")
    return top_n(out, ["instance"], ["asset_id"], max(floor, factor * target))


def wiki_shards(instance: Column, shards: Column) -> Column:
    """Which of a rotating list of wikis comes first for an instance."""
    return values.shard_of(instance, shards)


def seeds(entities: DataFrame, chosen: DataFrame) -> DataFrame:
    """Two seeds for each entity: its own name, and the Latin name that a judge chose among its aliases.

    ``chosen`` is a cache (name, latin, judged).  A chosen name that is not
    among the entity's Latin candidates was made up and gives no seed; so does
    a null one.
    """
    pool = text.latin_candidates(F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("query", F.array().cast("array<string>"))))
    rows = entities.select("name", pool.alias("pool"))
    own = rows.select("name", F.col("name").alias("query"), F.when(text.has_cjk("name"), "zh").otherwise("latin").alias("lang"))
    other = rows.join(chosen, "name").where(F.array_contains("pool", F.col("latin"))).select("name", F.col("latin").alias("query"), F.lit("latin").alias("lang"))
    return own.union(other).distinct()

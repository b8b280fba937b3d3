"""Probes of retrieval and identity: pairs, rule verdicts, rates by band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def pairs(manifest: DataFrame, payloads: DataFrame, source: str) -> DataFrame:
    """``(sha256, instance, kb_match, query, characters)`` of a source's images, each with its instances."""
    rows = manifest.where(F.col("source") == source).select("sha256", F.explode("instances").alias("instance"), "kb_match", "queries", "asset_ids")
    rows = rows.select("sha256", "instance", "kb_match", F.col("queries")[F.col("instance")].alias("query"), F.col("asset_ids")[F.col("instance")].alias("asset_id"))
    return rows.join(payloads.select("asset_id", "characters"), "asset_id").drop("asset_id")


def payload_field(payload: str, name: str) -> Column:
    return F.get_json_object(payload, f"$.{name}")


def ruled(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs with ``verdict``: match by rule, or null for a judge.  ``names`` is (instance, names) in plain form."""
    tags = F.filter(F.split(F.coalesce("characters", F.lit("")), " "), lambda t: t != "")
    return rows.join(names, "instance", "left").withColumn("verdict", F.when(text.names_match(tags, F.coalesce("names", F.array().cast("array<string>"))), "match")).drop("names")


def shares(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    """One row: pairs, matches, mismatches, undecided, and the match rate among the judged."""
    said = lambda v: F.count_if(F.col(verdict) == v)
    judged = F.nullif(said("match") + said("mismatch"), F.lit(0))
    return rows.agg(F.count("*").alias("n"), said("match").alias("match"), said("mismatch").alias("mismatch"), said("inconclusive").alias("inconclusive"), F.round(said("match") / judged, 3).alias("match_rate"))


def by_image(rows: DataFrame, key: str, verdict: str = "verdict") -> DataFrame:
    """``(key, outcome)``: any match; else a mismatch; else all undecided."""
    said = F.collect_set(verdict)
    outcome = F.when(F.array_contains(said, "match"), "match").when(F.size(F.array_except(said, F.array(F.lit("inconclusive")))) == 0, "inconclusive").otherwise("mismatch")
    return rows.groupBy(key).agg(outcome.alias("outcome"))


def match_band(score: Column) -> Column:
    """An unknown score is in the lowest band."""
    s = F.coalesce(score, F.lit(0))
    return F.when(s <= 3, "0-3").when(s <= 6, "4-6").otherwise("7-10")


def rates(rows: DataFrame, by: list[Column], hit: Column) -> DataFrame:
    """Count, hits and rate among rows where ``hit`` is known, for each band."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"), F.round(F.count_if(hit) / F.nullif(F.count(hit), F.lit(0)), 3).alias("rate"))


def commonest(rows: DataFrame, what: Column, n: int, name: str = "value") -> DataFrame:
    return rows.groupBy(what.alias(name)).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), name).limit(n)


def identities(meta: DataFrame, manifest: DataFrame) -> DataFrame:
    """Post data joined to images by the post id in the landing page's URL."""
    post = F.regexp_extract(F.coalesce("landing_url", F.lit("")), r"/posts/(\d+)", 1).try_cast("bigint")
    return manifest.withColumn("post_id", post).join(meta.withColumnRenamed("id", "post_id"), "post_id")


def retrieval(manifest: DataFrame, payloads: DataFrame, source: str, names: DataFrame, judge: Column) -> DataFrame:
    """The whole retrieval probe: a source's pairs, decided by rule or else by the judge, and match rates among the judged by band of score."""
    rows = ruled(pairs(manifest, payloads, source), names)
    rows = rows.withColumn("verdict", F.coalesce("verdict", judge))
    hit = F.when(F.col("verdict") != "inconclusive", F.col("verdict") == "match")
    return rates(rows, [match_band(F.col("kb_match")).alias("band")], hit)


def identity(meta: DataFrame, manifest: DataFrame, recognised: Column, by: list[Column]) -> DataFrame:
    """The whole identity probe: posts joined to images, and recognition rates by band among the rows where it is known."""
    return rates(identities(meta, manifest), by, recognised)

"""A batch of collection, from retrieved candidates to rows for the manifest.

Fetching lies between :func:`planned` and :func:`persisted`; both sides are
plain plans, so the steps run as one query up to the fetch and one after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import gates, manifest, ranking
from . import coverage


@dataclass(frozen=True)
class Planned:
    """Candidates by what becomes of them."""

    fetch: DataFrame
    reuse: DataFrame
    rejected: DataFrame
    leftover: DataFrame


def reason(hosts: list[str] | None, **limits) -> Column:
    """Why a candidate is rejected: the gate of its source's kind."""
    url, mime, size = F.col("content_url"), F.col("declared_mime"), F.col("declared_size")
    strict = gates.authorized_reason(url, mime, size, F.col("license_raw"), hosts, **limits)
    limits.pop("licenses", None)
    loose = gates.unauthorized_reason(url, mime, size, None, **limits)
    return F.when(F.coalesce("source_authorized", F.lit(False)), strict).otherwise(loose)


def planned(candidates: DataFrame, jobs: DataFrame, known: DataFrame, hosts: list[str] | None, cap: int, enough: float, **limits) -> Planned:
    """Candidates ranked, gated, cut off once an instance has ``enough``, capped by source, and held against known URLs.

    ``candidates`` have ``batch``, the place of the search that found them.
    """
    rows = ranking.with_rank(candidates, ["instance", "source"], ["batch", "asset_id"])
    rows = ranking.first_of(rows, ["instance", "content_url"], ["source_rank", "source", "asset_id"])
    marked = coverage.with_jobs(rows, jobs, reason(hosts, **limits))
    good = marked.where("reject_reason IS NULL").drop("reject_reason")
    found = good.groupBy("instance", "batch").agg(F.count("*").alias("n"))
    searches = ranking.early_stop(found, ["instance"], ["batch"], F.col("n"), enough).drop("n")
    good = good.join(searches, ["instance", "batch"], "left_semi")
    place = F.row_number().over(Window.partitionBy("instance", "source").orderBy(F.coalesce("source_rank", F.lit(0)), "asset_id"))
    placed = good.withColumn("_k", place)
    reuse, fetch = coverage.reuse(placed.where(F.col("_k") <= cap).drop("_k"), known)
    return Planned(fetch, reuse, marked.where("reject_reason IS NOT NULL"), placed.where(F.col("_k") > cap).drop("_k"))


def persisted(fetched: DataFrame, min_width: int = 0, min_height: int = 0) -> tuple[DataFrame, DataFrame]:
    """(manifest rows, failed candidates) of fetched ones: those with content of the least size, and the rest with ``status``."""
    status = F.when(F.col("sha256").isNull(), "failed").otherwise(gates.resolution_status(F.col("actual_width"), F.col("actual_height"), min_width, min_height))
    rows = fetched.withColumn("status", status)
    return manifest.row_of_candidate(rows.where("status = 'ok'")), rows.where("status <> 'ok'")


def retry(failed: DataFrame, hosts: list[str] | None, **limits) -> tuple[DataFrame, DataFrame]:
    """(failed candidates that pass today's gates, those that don't): each under its own source's gate."""
    return gates.split(failed.drop("reject_reason"), reason(hosts, **limits))


def run_stats(rows: DataFrame) -> DataFrame:
    """One row on a run: authorised and other images, bytes, rows kept out by a cap or a gate."""
    ok = F.col("status") == "ok"
    own = F.coalesce("source_authorized", F.lit(False))
    return rows.agg(
        F.count_if(ok & own).alias("authorized"), F.count_if(ok & ~own).alias("unauthorized"), F.coalesce(F.sum(F.when(ok, F.col("size_bytes"))), F.lit(0)).alias("bytes"),
        F.count_if(F.col("status") == "capped").alias("capped"), F.count_if(F.col("status") == "gate_rejected").alias("gate_rejected"), F.count_if(F.col("status") == "failed").alias("failed"),
    )


def proposals(rows: DataFrame, allowed: list[str], known: DataFrame) -> DataFrame:
    """Proposed sources with only the allowed columns and ``reject_reason``: no name, a name in use, or no https URL."""
    named = rows.join(known.select(F.col("name"), F.lit(True).alias("_known")), "name", "left")
    why = F.when(F.coalesce("name", F.lit("")) == "", "no_name").when(F.col("_known"), "name_in_use").when(~F.coalesce(F.col("url").startswith("https://"), F.lit(False)), "not_https")
    return named.select(*(c for c in rows.columns if c in allowed), why.alias("reject_reason"))


def deltas(snapshots: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Snapshots with ``delta``, the change since the one before (the first has none)."""
    return snapshots.withColumn("delta", F.col(value) - F.lag(value).over(Window.partitionBy(key).orderBy(at)))

"""Coverage: which entities lack images, and which to collect next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators.ranking import cap_per_source


def gaps(entities: DataFrame, counts: DataFrame, threshold: int) -> DataFrame:
    """Entities ``(name, cluster)`` under the threshold, with ``have`` and ``need``.  ``counts`` is (name, have)."""
    have = F.coalesce("have", F.lit(0))
    rows = entities.join(counts, "name", "left").withColumn("have", have)
    return rows.where(F.col("have") < threshold).withColumn("need", F.lit(threshold) - F.col("have"))


def gap_report(entities: DataFrame, counts: DataFrame, threshold: int) -> DataFrame:
    """``(cluster, gap_instances, total_need)``, most needed first."""
    rows = gaps(entities, counts, threshold).groupBy("cluster").agg(F.count("*").alias("gap_instances"), F.sum("need").alias("total_need"))
    return rows.orderBy(F.col("total_need").desc(), "cluster")


def gap_totals(entities: DataFrame, counts: DataFrame, threshold: int) -> DataFrame:
    """One row: all entities, achieved, in a gap, and the total need."""
    have = F.coalesce("have", F.lit(0))
    lack = have < threshold
    rows = entities.join(counts, "name", "left")
    return rows.agg(F.count("*").alias("total_instances"), F.count_if(~lack).alias("achieved"), F.count_if(lack).alias("gap_instances"), F.coalesce(F.sum(F.when(lack, F.lit(threshold) - have)), F.lit(0)).alias("total_need"))


def most_starved(entities: DataFrame, counts: DataFrame, threshold: int, n: int) -> DataFrame:
    """The ``n`` entities of each cluster with the least images."""
    place = F.row_number().over(Window.partitionBy("cluster").orderBy("have", "name"))
    return gaps(entities, counts, threshold).withColumn("rank", place).where(F.col("rank") <= n)


def classify(jobs: DataFrame, counts: DataFrame, mode: str, least: int) -> DataFrame:
    """Jobs with ``status`` and ``existing``, by what is there under the same path, or the same parent and leaf.

    ``delta`` takes new ones only; ``replay`` tops up those found by path that
    are under ``least``; ``replay-rules`` also knows a moved path by its last
    two segments.  ``counts`` is (instance, have).
    """
    if mode not in ("delta", "replay", "replay-rules"):
        raise ValueError(f"unknown mode: {mode}")
    key = lambda c: F.struct(text.parent(c), text.leaf(c))
    exact = counts.where("have > 0").select("instance", F.col("have").alias("exact"))
    fuzzy = counts.groupBy(key("instance").alias("k")).agg(F.sum("have").alias("fuzzy"))
    rows = jobs.join(exact, "instance", "left").withColumn("k", key("instance")).join(fuzzy, "k", "left").drop("k")
    found, near = F.coalesce("exact", F.lit(0)), F.coalesce("fuzzy", F.lit(0))
    if mode == "delta":
        status = F.when(found > 0, "skip_exact").when(near > 0, "skip_delta_fuzzy").otherwise("new")
        existing = F.lit(0).cast("bigint")
    else:
        status = F.when(found >= least, F.when(found > 0, "skip_exact").otherwise("new")).when(found > 0, "topup")
        existing = found
        if mode == "replay-rules":
            status = status.when(near >= least, F.when(near > 0, "skip_fuzzy").otherwise("new")).when(near > 0, "topup")
            existing = F.when(found > 0, found).otherwise(near)
        status = status.otherwise("new")
    return rows.withColumns({"status": status, "existing": F.when(status == "topup", existing).otherwise(F.lit(0))}).drop("exact", "fuzzy")


def second_pass(candidates: DataFrame, used: DataFrame, counts: DataFrame, weak: DataFrame, least: int, cap: int, attempts: int = 3) -> DataFrame:
    """Left-over candidates of starved instances: unused URLs, no weak source, few tries, under a wider cap."""
    starved = counts.where(F.col("have") < least).select("instance")
    rows = candidates.join(used.select("content_url"), "content_url", "left_anti").join(weak.select("source"), "source", "left_anti")
    rows = rows.join(starved, "instance", "left_semi").where(F.coalesce("attempts", F.lit(0)) < attempts)
    return cap_per_source(rows, cap, tie="content_url")


def route(seeds: DataFrame, table: DataFrame) -> DataFrame:
    """Seeds with every source of their language; a language without a source gives no row."""
    return seeds.join(table, "lang")


def with_jobs(candidates: DataFrame, jobs: DataFrame, reason: Column) -> DataFrame:
    """Candidates with their job's columns and ``reject_reason``; without a job that is ``no_job``."""
    rows = candidates.join(jobs.withColumn("_job", F.lit(True)), "instance", "left")
    return rows.withColumn("reject_reason", F.when(F.col("_job").isNull(), "no_job").otherwise(reason)).drop("_job")


def reuse(candidates: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates whose URL is known, with its content's hash; those to fetch)."""
    urls = known.select("content_url", "sha256").dropDuplicates(["content_url"])
    return candidates.join(urls, "content_url"), candidates.join(urls, "content_url", "left_anti")

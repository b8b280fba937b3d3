"""Sources: their ledger, lifecycle and queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import backoff
from ..operators.gates import weak_source
from ..operators.ranking import overlay

#: Thresholds of the lifecycle.
MIN_RUNS, PROMOTE_SEARCHES, PROMOTE_FAILURES, DEGRADE_SEARCHES, DEGRADE_FAILURES = 3, 5, 0.1, 20, 0.5


def merge_ledger(runs: DataFrame, key: str = "source", counters: Sequence[str] = ("search_ok", "search_fail", "candidates", "dl_ok", "dl_fail", "dl_dead", "dl_timeout")) -> DataFrame:
    """One row for each source: counters added up, the number of runs, the last update."""
    return runs.groupBy(key).agg(*(F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c) for c in counters), F.count("*").alias("runs"), F.max("updated_at").alias("updated_at"))


def moves(cards: DataFrame, ledger: DataFrame, promote: int = 2, retire: int = 5, max_repairs: int = 2) -> DataFrame:
    """``(name, before, after)`` of sources that change state.

    Cards are ``(name, lifecycle, provenance, has_proposal, repairs)``.  Of those
    due, ``promote`` go up and ``retire`` retire in a round, in order of name.  A
    source on probation that is due but not let up stays, unless it is weak or
    failing.
    """
    rows = cards.join(ledger.withColumnRenamed("source", "name"), "name", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    searches = n("search_ok") + n("search_fail")
    failing = F.when(searches > 0, n("search_fail") / searches).otherwise(0.0)
    weak = weak_source(n("dl_ok"), F.col("dl_fail"), n("dl_dead"), n("dl_timeout")) & F.col("runs").isNotNull()
    proven = n("runs") >= MIN_RUNS
    up = proven & (F.col("lifecycle") == "probation") & (searches >= PROMOTE_SEARCHES) & (failing < PROMOTE_FAILURES) & ~weak
    down = proven & F.col("lifecycle").isin("probation", "active") & (((searches >= DEGRADE_SEARCHES) & (failing >= DEGRADE_FAILURES)) | weak)
    out = (F.col("lifecycle") == "degraded") & F.col("provenance").startswith("llm") & (~F.coalesce("has_proposal", F.lit(False)) | (n("repairs") >= max_repairs))
    rows = rows.select("name", F.col("lifecycle").alias("before"), F.when(up, "active").when(down, "degraded").when(out, "retired").alias("after")).where("after IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("after").orderBy("name"))
    limit = F.when(F.col("after") == "active", promote).when(F.col("after") == "retired", retire)
    return rows.withColumn("_k", place).where(limit.isNull() | (F.col("_k") <= limit)).drop("_k")


def registry(builtin: DataFrame, events: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Built-in cards under the field-wise overlay of events; names that only events know are cards too."""
    over = overlay(events, "name", ["seq"], fields)
    base = builtin.select("name", *(F.col(f).alias(f"_b_{f}") for f in fields))
    return over.join(base, "name", "full").select("name", *(F.coalesce(f, f"_b_{f}").alias(f) for f in fields))


def newest_specs(paths: DataFrame, path: str = "path") -> DataFrame:
    """``(name, version, path)``: the highest version of each spec file ``name.vN.json``."""
    rows = paths.select(F.col(path).alias("path"), F.regexp_extract(path, r"([^/]+)\.v(\d+)\.json$", 1).alias("name"), F.regexp_extract(path, r"\.v(\d+)\.json$", 1).try_cast("int").alias("version"))
    return rows.where("name <> ''").groupBy("name").agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))


def aimd(outcomes: DataFrame, key: Sequence[str], order: Sequence[str], ok: Column, start: float = 4, low: float = 1, high: float = 32) -> DataFrame:
    """The cap of each key after its outcomes in order: one more for a good one, half for a bad one, within bounds.

    A fold has an order, so one key's outcomes (two small fields each) meet in
    one task; streams keep the cap as state instead.
    """
    seq = F.array_sort(F.collect_list(F.struct(*order, ok.alias("_ok"))))
    step = lambda cap, e: F.when(e["_ok"], F.least(F.lit(float(high)), cap + 1)).otherwise(F.greatest(F.lit(float(low)), cap * 0.5))
    return outcomes.groupBy(*key).agg(F.aggregate(seq, F.lit(float(start)), step).alias("cap"))


def claim(queue: DataFrame, caps: DataFrame, now: float, n: int = 8, sources: int = 8, stale: float = 600.0) -> DataFrame:
    """The next items to work on: sources with the least in flight first, below their caps, no URL that is in flight already.

    Claims older than ``stale`` seconds count as pending.
    """
    held = (F.col("status") == "claimed") & (F.col("claimed_at") >= now - stale)
    waiting = ((F.col("status") == "pending") | ((F.col("status") == "claimed") & ~held)) & (F.coalesce("next_try", F.lit(0.0)) <= now) & (F.col("attempts") < 3)
    flight = queue.where(held).groupBy("source").agg(F.count("*").alias("in_flight"))
    round_ = queue.where(waiting).select("source").distinct().join(flight, "source", "left").join(caps.select("source", "cap"), "source", "left")
    round_ = round_.withColumn("in_flight", F.coalesce("in_flight", F.lit(0))).where(F.col("in_flight") < F.coalesce("cap", F.lit(4.0)))
    round_ = round_.orderBy("in_flight", "source").limit(sources)
    rows = queue.where(waiting).join(round_.select("source"), "source", "left_semi").join(queue.where(held & F.col("content_url").isNotNull()).select("content_url"), "content_url", "left_anti")
    return rows.orderBy("wave", "rank", "id").limit(n)


def outcome(queue: DataFrame, ok: Column, now: float, most: int = 3) -> DataFrame:
    """Claimed items after a try: done; pending again later, with a doubling wait; or skipped at the last try."""
    mine = F.col("status") == "claimed"
    tries = F.when(mine, F.col("attempts") + 1).otherwise(F.col("attempts"))
    status = F.when(~mine, F.col("status")).when(ok, "done").when(tries >= most, "skipped").otherwise("pending")
    return queue.withColumns({"status": status, "attempts": tries, "next_try": F.when(mine & (status == "pending"), F.lit(now) + backoff(tries)).otherwise(F.col("next_try"))})

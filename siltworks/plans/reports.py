"""Reports: counts, rates, histograms, dashboards and the viewer's index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import without_shard
from ..operators.ranking import viewer_order


def instance_totals(rows: DataFrame, instance: str, special: Column) -> DataFrame:
    """For each instance and for TOTAL: candidates, special ones, their share (0 when empty)."""
    n, own = F.count("*"), F.count_if(special)
    out = rows.rollup(instance).agg(F.grouping(instance).alias("_all"), n.alias("candidates"), own.alias("special"), F.round(F.coalesce(own / F.nullif(n, F.lit(0)), F.lit(0.0)), 3).alias("share"))
    return out.withColumn(instance, F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col(instance))).drop("_all")


def distribution(rows: DataFrame, by: Column, name: str) -> DataFrame:
    """``(name, n, percent)``; the total comes from the groups, not from a second scan."""
    counts = rows.groupBy(by.alias(name)).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def issues(rows: DataFrame, array: str, name: str = "issue") -> DataFrame:
    return rows.select(F.explode(array).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def caption_lengths(rows: DataFrame, n: Column) -> DataFrame:
    """One row: count, least, upper median, greatest.

    The median is the element at n // 2, found by counts of equal values, so
    only distinct values are ranked.
    """
    counts = rows.groupBy(n.alias("v")).agg(F.count("*").alias("c")).where("v IS NOT NULL")
    ranked = counts.withColumns({"upto": F.sum("c").over(Window.partitionBy().orderBy("v").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("c").over(Window.partitionBy())})
    return ranked.agg(F.max("total").alias("n"), F.min("v").alias("least"), F.min(F.when(F.col("upto") > F.floor(F.col("total") / 2), F.col("v"))).alias("median"), F.max("v").alias("greatest"))


def queue_status(queue: DataFrame, by: str = "wave", statuses: list[str] | None = None) -> DataFrame:
    return queue.groupBy(by).pivot("status", statuses or ["pending", "claimed", "done", "skipped"]).agg(F.count(F.lit(1)))


def source_progress(queue: DataFrame) -> DataFrame:
    """For each source: items, done, and exhausted (skipped or three tries)."""
    return queue.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "done").alias("done"), F.count_if((F.col("status") == "skipped") | ((F.col("status") != "done") & (F.col("attempts") >= 3))).alias("exhausted"))


def done_since(queue: DataFrame, since: float) -> DataFrame:
    return queue.where((F.col("status") == "done") & (F.col("updated_at") >= since)).groupBy("instance", "source").agg(F.count("*").alias("n"))


def drained(queue: DataFrame) -> bool:
    """Whether nothing is pending or claimed."""
    return queue.where(F.col("status").isin("pending", "claimed")).isEmpty()


def dashboard(found: DataFrame, queue: DataFrame) -> DataFrame:
    """Candidates found and items done, for each shard prefix and source."""
    a = found.groupBy(without_shard("shard").alias("prefix"), "source").agg(F.count("*").alias("found"))
    b = queue.where("status = 'done'").groupBy(without_shard("shard").alias("prefix"), "source").agg(F.count("*").alias("done"))
    return a.join(b, ["prefix", "source"], "left").withColumn("done", F.coalesce("done", F.lit(0)))


def throughput(rows: DataFrame, by: str) -> DataFrame:
    """For each level: units, good ones, bytes, MB a second of the wall time, success rate."""
    ok = F.count_if("ok")
    size = F.sum(F.when(F.col("ok"), F.col("bytes")).otherwise(0))
    return rows.groupBy(by).agg(F.count("*").alias("units"), ok.alias("ok"), size.alias("bytes"), F.round(size / 1e6 / F.nullif(F.max("finished") - F.min("started"), F.lit(0.0)), 3).alias("agg_mbps"), F.round(ok / F.count("*"), 3).alias("success_rate"))


def latencies(rows: DataFrame, ms: str, by: str) -> DataFrame:
    """For each group the nearest-rank 50th, 95th and 99th percentiles: the element at the rounded place p * (n - 1), halves to even.

    Equal values are counted first, and only distinct ones are ranked, in a
    window that can spill.
    """
    counts = rows.where(F.col(ms).isNotNull()).groupBy(by, ms).agg(F.count("*").alias("c"))
    group = Window.partitionBy(by)
    upto = group.orderBy(ms).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"upto": F.sum("c").over(upto), "total": F.sum("c").over(group)})
    place = lambda p: F.bround(F.lit(p / 100) * (F.col("total") - 1), 0)
    return ranked.groupBy(by).agg(*(F.min(F.when(F.col("upto") > place(p), F.col(ms))).alias(f"p{p}") for p in (50, 95, 99)))


def viewer_index(rows: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """``(group, n, items)``: each group's rows, best first, as a JSON text."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*viewer_order(rows)))
    item = F.struct(F.lit(0).alias("_"), *fields)
    ordered = F.array_sort(F.collect_list(F.struct("_at", item.alias("x"))))
    out = rows.withColumn("_at", place).groupBy(group).agg(F.count("*").alias("n"), ordered.alias("o"))
    return out.select(group, "n", F.to_json(F.transform("o", lambda o: o["x"].dropFields("_"))).alias("items"))


def by_branch(tree: DataFrame, path: str = "path") -> DataFrame:
    """Nodes for each second segment of the path, most first."""
    return tree.groupBy(F.split_part(F.col(path), F.lit("/"), F.lit(2)).alias("branch")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "branch")


def searched(entities: DataFrame, word: str, key: str, limit: int = 20) -> DataFrame:
    """Entities whose name or description holds a word, or that have it as an alias; the first by name, null ones last, ties by key."""
    hit = F.col("name").contains(word) | F.coalesce(F.col("desc").contains(word), F.lit(False)) | F.coalesce(F.array_contains("aliases", word), F.lit(False))
    return entities.where(hit).orderBy(F.col("name").asc_nulls_last(), key).limit(limit)


def alias_like(entities: DataFrame, pattern: str) -> DataFrame:
    return entities.select("name", F.explode("aliases").alias("alias")).where(F.col("alias").ilike(pattern))


def text_table(df: DataFrame, title: str, limit: int = 50) -> str:
    """The first rows of a report as Markdown, for a reader."""
    rows = df.limit(limit).collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + "-|" * len(df.columns)
    return f"## {title}\n\n{head}\n" + "\n".join("| " + " | ".join(str(v) for v in r) + " |" for r in rows)


def request_rates(rows: DataFrame, by: str, at: str, failure: str, classes: list[str]) -> DataFrame:
    """For each group the requests, how many a second between the first and the last (``at`` in seconds), and how many failed by class."""
    span = F.nullif(F.max(at) - F.min(at), F.lit(0.0))
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.round(F.count("*") / span, 3).alias("qps"), *(F.count_if(F.col(failure) == c).alias(c) for c in classes))


def lowest(rows: DataFrame, score: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` rows of the least known score, ties by key."""
    return rows.where(F.col(score).isNotNull()).orderBy(score, key).limit(n)

"""Order-dependent operators, on explicit orders."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import folder


def _cols(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_n(df: DataFrame, by: Sequence, order: Sequence, n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group; Spark limits groups before and after the shuffle."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*_cols(order)))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_of(df: DataFrame, by: Sequence, order: Sequence) -> DataFrame:
    """One row for each key, the first in the order; which one survives is defined, unlike with dropDuplicates."""
    return top_n(df, by, order, 1)


def cap_per_source(df: DataFrame, cap: int, instance: str = "instance", source: str = "source", rank: str = "source_rank", tie: str = "asset_id") -> DataFrame:
    """At most ``cap`` candidates of each instance and source, by rank (unknown as 0)."""
    return top_n(df, [instance, source], [F.coalesce(F.col(rank), F.lit(0)), F.col(tie)], cap)


def with_rank(df: DataFrame, by: Sequence, order: Sequence, rank: str = "source_rank") -> DataFrame:
    """``rank`` filled, where null, with the row's place in its group, from 0."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*_cols(order))) - 1
    return df.withColumn(rank, F.coalesce(F.col(rank), place.cast("bigint")))


def early_stop(df: DataFrame, by: Sequence, order: Sequence, amount: Column, enough: float, kept: str | None = None) -> DataFrame:
    """Batches of a group in order, until those before one add up to ``enough``."""
    before = Window.partitionBy(*by).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    name = kept or "_before"
    out = df.withColumn(name, F.coalesce(F.sum(amount).over(before), F.lit(0))).where(F.col(name) < enough)
    return out if kept else out.drop(name)


def overlay(events: DataFrame, key: str, order: Sequence, fields: Sequence[str]) -> DataFrame:
    """For each key the latest value of every field that some event has set."""
    latest = [F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(*_cols(order)))).alias(f) for f in fields]
    return events.groupBy(key).agg(*latest)


def latest(df: DataFrame, key: Sequence, order: Sequence) -> DataFrame:
    return first_of(df, key, [c.desc() for c in _cols(order)])


def saturation(levels: DataFrame, order: str, value: str, factor: float = 1.1) -> DataFrame:
    """Levels with ``saturated``: under ``factor`` times the last known value before."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(value, ignorenulls=True).over(before)
    return levels.withColumn("saturated", F.coalesce(F.col(value) < factor * last, F.lit(False)))


def hysteresis(levels: DataFrame, by: Sequence, order: Sequence, level: str, high: float = 2000, low: float = 500) -> DataFrame:
    """Rows with ``paused``: from a level of ``high`` or more on, until one of ``low`` or less."""
    turned = F.when(F.col(level) >= high, F.lit(True)).when(F.col(level) <= low, F.lit(False))
    so_far = Window.partitionBy(*by).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    return levels.withColumn("paused", F.coalesce(F.last(turned, ignorenulls=True).over(so_far), F.lit(False)))


def in_flushes(df: DataFrame, by: Sequence, order: Sequence, at: str, most: int = 50, seconds: float = 60) -> DataFrame:
    """Rows with ``flush``, from 0: a buffer is written when it holds ``most`` rows, or ``seconds`` after its first.

    A buffer's start depends on the one before, so a key's rows are gone through
    in order, by one task, an Arrow batch at a time: it is for keys of bounded
    size, such as one worker's results.
    """
    rows = df.repartition(*_cols(by)).sortWithinPartitions(*_cols(by), *_cols(order))
    keys = [df.columns.index(c) for c in by]
    time, names = df.columns.index(at), [*df.columns, "flush"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, opened, held, flush = None, 0.0, 0, 0
        for b in batches:
            out = []
            times = pc.cast(b.column(time), pa.timestamp("us", b.column(time).type.tz)).cast(pa.int64()).to_pylist() if pa.types.is_timestamp(b.column(time).type) else [t * 1e6 for t in b.column(time).to_pylist()]
            for key, t in zip(zip(*(b.column(k).to_pylist() for k in keys), strict=True), times, strict=True):
                if key != own:
                    own, opened, held, flush = key, t, 0, 0
                elif held >= most or t - opened >= seconds * 1e6:
                    opened, held, flush = t, 0, flush + 1
                held += 1
                out.append(flush)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names)

    return rows.mapInArrow(run, StructType([*df.schema.fields]).add("flush", "long"))


def renumbered(sizes: DataFrame, by: Sequence, size: str = "size", key: str = "cluster_id", name: str = "rank") -> DataFrame:
    """Clusters numbered from 0 by falling size, then key."""
    return sizes.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(F.col(size).desc(), F.col(key))) - 1)


def numbered(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Rows with their place in the order, from 0.

    Rows are dealt to ranges of the order and written with their place in their
    range; with the ranges' sizes that gives the place among all, and no task
    holds more than a range.  Ties of the whole order fall as they come.
    """
    cols, path = _cols(order), folder(df.sparkSession, "numbered")
    dealt = df.repartitionByRange(*cols).withColumn("_p", F.spark_partition_id())
    dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*cols)) - 1).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sizes = rows.groupBy("_p").agg(F.count("*").alias("n")).select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return rows.join(sizes, "_p").withColumn(name, F.col("_i") + F.col("_before")).select(*df.columns, name)


def round_robin(df: DataFrame, order: Sequence, shards: int, shard: int) -> DataFrame:
    """The rows whose place in the order, modulo ``shards``, is the shard's (from 1)."""
    return numbered(df, order, "_k").where(F.col("_k") % shards == shard - 1).drop("_k")


def stratified(df: DataFrame, key: str, score: str, strata: Sequence[tuple[float, float, float]], n: int, seed: int = 0) -> DataFrame:
    """About ``n`` rows: of each band [low, high) its share, at least one, by a seeded hash of the key."""
    band, quota = F.lit(None), F.lit(0)
    for i, (low, high, share) in enumerate(strata):
        inside = (F.col(score) >= low) & (F.col(score) < high)
        band = F.when(inside, i).otherwise(band)
        quota = F.when(inside, max(1, int(n * share))).otherwise(quota)
    rows = df.withColumns({"stratum": band.cast("int"), "_quota": quota}).where("stratum IS NOT NULL")
    drawn = Window.partitionBy("stratum").orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key))
    return rows.withColumn("_k", F.row_number().over(drawn)).where("_k <= _quota").drop("_k", "_quota")


def batches(df: DataFrame, group: str, item: str, size: int = 80) -> DataFrame:
    """Rows with ``batch``: groups over half a batch in batches of their own, smaller ones filled up in order of group.

    A batch's start depends on the one before, so one task goes through the
    sizes of small groups in order, an Arrow batch at a time; rows don't reach it.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") <= size // 2).repartition(1).sortWithinPartitions(group)

    def fill(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = number = 0
        for b in parts:
            out = []
            for n in b.column(1).to_pylist():
                if held and held + n > size:
                    number, held = number + 1, 0
                held += n
                out.append(f"small-{number}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [group, "own"])

    filled = small.mapInArrow(fill, small.select(group).schema.add("own", "string"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(item)) - 1
    alone = F.concat_ws("-", F.col(group), F.floor(place / size).cast("string"))
    return df.withColumn("_alone", alone).join(filled, group, "left").withColumn("batch", F.coalesce("own", "_alone")).drop("_alone", "own")


def viewer_order(df: DataFrame) -> list[Column]:
    """Best first: match, richness (unknown last), then source rank, least tier, hash."""
    return [F.col("kb_match").desc_nulls_last(), F.col("richness").desc_nulls_last(), F.coalesce("source_rank", F.lit(99)), F.coalesce(F.array_min("tiers"), F.lit(99)), F.col("sha256")]

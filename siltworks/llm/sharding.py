"""Sharding by sampled splitters: key ranges of near equal bytes.

Records are ordered by a hash of their text, then by id, so equal texts are
neighbours; a random number, written once, orders rows that repeat both.  Keys
are drawn with a chance in proportion to size.  A first draw gives a fixed
number of coarse ranges.  Any range that holds too many bytes or rows is drawn
again and subdivided, until none is overfull.  Every range is then sorted and
summed by a task of its own, and with the ranges' totals each record knows how
many bytes and rows stand before it.  Shards are cut at equal shares of all
bytes: groups of equal texts stay whole, unless one holds more than ``whole``
of a shard; that one is cut between records.

All of it is DataFrame operations.  The driver gets the coarse draw, the large
groups and one place a shard, whose numbers don't depend on the rows.  Splitters
of subdivided ranges are a table with an array for each coarse range; it and
the ranges' totals hold a row or key for each ``rows_per_range`` records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, discard

#: Keys drawn for each range, and times its fair share at which a range is overfull.
_DRAWN, _OVERFULL = 24, 2.5
#: Coarse ranges for each shard.
_COARSE = 32
_KEY = ("h", "id", "tie")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, h)``: UTF-8 bytes plus 1, checksum and hash of each text; a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))


def _key() -> Column:
    return F.struct(*_KEY)


def _drawn(per_byte: Column, seed: int) -> Column:
    """Whether a record's key is drawn, with the chance ``per_byte`` for each of its bytes."""
    return F.pmod(F.xxhash64(*_KEY, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40) < F.col("size") * per_byte


def _place(bounds: Column, count: Column, steps: Column) -> Column:
    """The number of ``bounds`` (an array of keys in order) at or below a record's key, by binary search."""

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.get(bounds, mid) <= _key()
        done = acc["lo"] >= acc["hi"]
        return F.struct(F.when(~done & below, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(~done & ~below, mid).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), steps), F.struct(F.lit(0).alias("lo"), count.cast("int").alias("hi")), step, lambda acc: acc["lo"])


def _quantiles(keys: Column, every: Column | int) -> Column:
    """Every so manieth of an array of drawn keys, in order."""
    ordered = F.array_sort(F.array_distinct(keys))
    return F.filter(ordered, lambda k, i: (i > 0) & (i % every == 0))


def _coarse(rows: DataFrame, ranges: int, total: int) -> DataFrame:
    """``rows`` with ``c``, the number of their coarse range; the bounds are literals, ``ranges`` of them at any size."""
    drawn = rows.where(_drawn(F.lit(_DRAWN * ranges / total), 1)).select(_key().alias("k"))
    kind = drawn.schema["k"].dataType
    bounds = drawn.agg(_quantiles(F.collect_list("k"), _DRAWN).alias("b")).first()["b"]
    if not bounds:
        return rows.withColumn("c", F.lit(0))
    listed = F.array(*(F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, kind.fields, strict=True))) for b in bounds))
    return rows.withColumn("c", _place(listed, F.lit(len(bounds)), F.lit(len(bounds).bit_length())))


def _in_ranges(rows: DataFrame, bounds: DataFrame | None) -> DataFrame:
    """``rows`` (with ``c``) with ``s``, the number of their subrange by ``bounds(c, keys)``."""
    if bounds is None:
        return rows.withColumn("s", F.lit(0))
    found = rows.join(bounds, "c", "left")
    n = F.size("keys")
    sub = _place(F.col("keys"), n, F.greatest(F.lit(1), F.ceil(F.log2(n + 1)).cast("int")))
    return found.withColumn("s", F.when(F.col("keys").isNull(), 0).otherwise(sub)).drop("keys")


def _split(rows: DataFrame, bytes_per_range: float, rows_per_range: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with ``c``) in subranges, none of which is overfull, and the ranges' totals, in order by ``(c, s)``."""
    bounds, seed = None, 2
    while True:
        placed = _in_ranges(rows, bounds)
        ranges = cut(placed.groupBy("c", "s").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("h").alias("lo"), F.max("size").alias("most")), "ranges")
        parts = F.ceil(F.greatest(F.col("bytes") / bytes_per_range, F.col("rows") / rows_per_range))
        over = ranges.where((F.col("rows") > 1) & ((F.col("bytes") - F.col("most") > _OVERFULL * bytes_per_range) | (F.col("rows") > _OVERFULL * rows_per_range)))
        over = cut(over.select("c", "s", parts.alias("parts"), (parts * _DRAWN / F.col("bytes")).alias("rate")), "overfull")
        if over.isEmpty():
            discard(over)
            return placed, ranges
        keys = placed.join(F.broadcast(over) if over.count() <= 1 << 16 else over, ["c", "s"]).where(_drawn(F.col("rate"), seed)).select("c", "s", "parts", _key().alias("k"))
        every = F.greatest(F.lit(1), F.floor(F.size(F.collect_list("k")) / F.first("parts")))
        more = keys.groupBy("c", "s").agg(F.collect_list("k").alias("keys"), every.alias("every")).select("c", F.explode(_quantiles(F.col("keys"), F.col("every"))).alias("k"))
        if bounds is not None:
            more = more.unionByName(bounds.select("c", F.explode("keys").alias("k")))
        after = cut(more.groupBy("c").agg(F.array_sort(F.array_distinct(F.collect_list("k"))).alias("keys")), "bounds")
        discard(over), discard(ranges)
        if bounds is not None:
            discard(bounds)
        bounds, seed = after, seed + 1


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 1_000_000, whole: float = 0.01) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for each row; slots count from 0 in each shard.

    Ranges number at least 32 a shard and one for ``rows_per_range`` rows.
    Shards differ by at most ``2 * whole`` of a shard, and by the size of one
    record where that is more.  A group of equal texts of at most ``whole`` of a
    shard is in one shard; a larger one may lie across the borders of shards.  A
    null text is empty; a null id sorts first in its group.  Rows that repeat id
    and text take neighbouring places.  Of a text only its size and hashes go
    on, however long it is.  Other columns are not read.  An empty table gives
    an empty result.
    """
    rows = cut(sized(docs, id_col, text_col).withColumn("tie", F.rand(7)), "sizes")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    # fewer than shards / whole groups can be that large, at any number of rows
    large = [r[0] for r in rows.groupBy("h").agg(F.sum("size").alias("s")).where(F.col("s") > whole * total / shards).select("h").collect()]
    coarse = _COARSE * shards
    placed, ranges = _split(_coarse(rows, coarse, total), total / coarse, rows_per_range)

    # what stands before each range, and where the group starts that its first record belongs to
    inside = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("*", *(F.coalesce(F.sum(x).over(inside), F.lit(0)).alias(f"{x}_inside") for x in ("bytes", "rows")))
    blocks = ranges.groupBy("c").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n"))
    ahead = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)  # over the coarse ranges, a fixed number
    blocks = blocks.select("c", *(F.coalesce(F.sum(x).over(ahead), F.lit(0)).alias(f"{x}_ahead") for x in "bn"))
    ranges = cut(ranges.join(blocks, "c").select("c", "s", "lo", (F.col("b_ahead") + F.col("bytes_inside")).alias("bytes_before"), (F.col("n_ahead") + F.col("rows_inside")).alias("rows_before")), "before")

    in_range = Window.partitionBy("c", "s").orderBy(*_KEY)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns({"end": F.sum("size").over(so_far), "at": F.row_number().over(in_range)})
    placed = placed.withColumn("first", F.min(F.col("end") - F.col("size")).over(Window.partitionBy("c", "s", "h")))
    placed = cut(placed.join(ranges, ["c", "s"]).select("id", "size", "text_crc32", "h", *((F.col("bytes_before") + F.col(x)).alias(x) for x in ("first", "end")), (F.col("rows_before") + F.col("at") - 1).alias("place")), "places")
    # the group of a range's first record may have begun in an earlier one
    began = placed.join(ranges.select(F.col("lo").alias("h")).distinct(), "h", "left_semi").groupBy("h").agg(F.min("first").alias("began"))
    began = cut(began, "began")
    alone = F.col("h").isin(large) if large else F.lit(False)
    start = F.when(alone, F.col("end") - F.col("size") / 2).otherwise(F.coalesce("began", "first"))
    placed = placed.join(began, "h", "left").select("id", "size", "text_crc32", F.least(F.lit(shards - 1), F.floor(start * shards / total)).cast("int").alias("shard"), "place")
    placed = cut(placed, "places")
    first = dict(placed.groupBy("shard").agg(F.min("place")).collect())
    start = F.create_map(*(F.lit(x) for kv in first.items() for x in kv))[F.col("shard")]
    return placed.select("id", "size", "text_crc32", "shard", (F.col("place") - start).cast("long").alias("slot"))

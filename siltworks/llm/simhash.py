"""Near-duplicate documents by SimHash, linked by tiled exact comparison.

1. One Arrow pass turns whole texts into 64-bit fingerprints; only
   ``(id, fingerprint)`` is kept.
2. Equal fingerprints collapse to one node each, with map-side combining, so a
   group of copies costs one row per task from there on.
3. Two fingerprints that differ in at most ``radius`` bits agree on at least
   one of ``radius + 1`` blocks of bits.  Nodes meet under ``(block, value)``.
   A bucket of more than ``tile`` nodes is laid out in tiles by population
   count; a pair of tiles whose counts differ by more than the radius is never
   made.  Each pair of tiles is a work item of its own, so a hot bucket is
   spread over many tasks.
4. A work item is compared exactly with numpy exclusive-or and bit counts, and
   gives a spanning forest of its links instead of all of them.
5. Connected components over these links.

What a join reads beside a key's many rows is written first, so that both sides
are plain shuffles, of which Spark can split a hot key's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import cut, discard

#: Shingles whose bits are added up at a time, which bounds memory for very long texts.
_CHUNK = 65_536


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """The fingerprint of a UTF-8 text; zero where there is no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        n = len(words) - width + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    hashes = (digest(s, seed) for s in shingles)
    for at in range(0, n, _CHUNK):
        h = np.fromiter(hashes, "<u8", min(_CHUNK, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id, key, node)`` for each row: a hash of id and text, and the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), width) for x in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["id", "key", "node"])

    return rows.mapInArrow(run, rows.select("id", "key").schema.add("node", "long"))


def row_key(id_col: str, text_col: str) -> Column:
    """A row's id and text as one long."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _blocks(parts: int) -> list[tuple[int, int]]:
    """(shift, bits) of the blocks into which 64 bits are cut."""
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def forest(x: np.ndarray, y: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links, as places in x and then y, of the graph of rows within ``radius`` bits: inside x, or between x and y."""
    n = len(x) + (0 if y is None else len(y))
    other = x if y is None else y
    near = np.empty((len(x), len(other)), bool)
    for i in range(0, len(x), 256):
        near[i : i + 256] = np.bitwise_count(x[i : i + 256, None] ^ other[None, :]) <= radius
    label = np.arange(n, dtype=np.int32)
    far = np.int32(n)
    rows = np.flatnonzero(near.any(1))
    cols = np.flatnonzero(near.any(0))
    near = near[np.ix_(rows, cols)]
    cols = cols if y is None else cols + len(x)
    while len(rows):
        before = label.copy()
        for a, b, m in ((rows, cols, near), (cols, rows, near.T)):
            for i in range(0, len(a), 256):
                best = np.where(m[i : i + 256], label[b][None, :], far).min(1)
                np.minimum.at(label, a[i : i + 256], best)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def lay_out(rows: DataFrame, bucket: list[str], level: Column, weight: Column, tile: int, reach: int) -> DataFrame:
    """``rows`` (with ``node``) dealt to work items: columns ``item`` and ``side`` in place of the bucket's.

    A bucket of at most ``tile`` weight is one item, all of side 2.  A larger
    one is cut into tiles of one level and about so much weight each; an item
    is a pair of tiles whose levels differ by at most ``reach`` (sides 0 and
    1), or a tile by itself (side 2).
    """
    own = [c for c in rows.columns if c not in bucket]
    rows = rows.withColumns({"_level": level.cast("int"), "_weight": weight})
    sizes = rows.groupBy(*bucket, "_level").agg(F.sum("_weight").alias("_n"))
    # hot buckets only: their lists of levels and tiles are together at most the weight of all rows / tile
    hot = sizes.groupBy(*bucket).agg(F.sum("_n").alias("_all"), F.map_from_entries(F.collect_list(F.struct("_level", F.ceil(F.col("_n") / tile).cast("int")))).alias("_parts"))
    hot = hot.where(F.col("_all") > tile).select(*bucket, "_parts")
    hot = cut(hot, "hot")
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("_parts")[F.col("_level")]).cast("int")
    mine = F.struct(F.col("_level").alias("level"), part.alias("part"))
    partners = F.flatten(
        F.transform(
            F.filter(F.map_entries("_parts"), lambda e: F.abs(e["key"] - F.col("_level")) <= reach),
            lambda e: F.transform(F.sequence(F.lit(0), e["value"] - 1), lambda p: F.struct(e["key"].alias("level"), p.cast("int").alias("part"))),
        )
    )
    alone = F.array(F.struct(F.lit(0).alias("level"), F.lit(0).alias("part")))
    cold = F.col("_parts").isNull()
    laid = rows.join(hot, bucket, "left").select(*own, *bucket, F.when(cold, alone[0]).otherwise(mine).alias("_own"), F.explode(F.when(cold, alone).otherwise(partners)).alias("_other"))
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    item = F.xxhash64(*bucket, F.least("_own", "_other"), F.greatest("_own", "_other"))
    return laid.select(item.alias("item"), side.cast("int").alias("side"), *own)


def by_item(work: DataFrame, link: Callable[..., tuple[list, list]]) -> DataFrame:
    """Links ``(a, b)``, by calling ``link(side, node, ...)`` with the columns of each item of ``work(item, side, node, ...)``.

    A task holds one item and one Arrow batch.  A column of arrays comes as an
    object array of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not kept:
                return
            item, *cols = (np.concatenate(c) for c in zip(*kept, strict=True))
            kept.clear()
            starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
            a, b = [], []
            for s, e in zip(starts, np.r_[starts[1:], len(item)], strict=True):
                if e - s > 1:
                    p, q = link(*(c[s:e] for c in cols))
                    a.append(p), b.append(q)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last item may go on in the next batch
            if last:
                kept.append(tuple(c[:last] for c in cols))
                yield from flush()
            kept.append(tuple(c[last:] for c in cols))
        yield from flush()

    return work.repartition("item").sortWithinPartitions("item", "side", "node").mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, radius: int = 2, tile: int = 2048) -> DataFrame:
    """Links ``(a, b)`` that connect just what chains of links of ``nodes(node)`` connect; none is lost."""

    def block(i: int, shift: int, bits: int) -> Column:
        value = F.shiftrightunsigned("node", shift).bitwiseAND(F.lit((1 << bits) - 1))
        return F.struct(F.lit(i).alias("block"), value.cast("long").alias("value"))

    def link(side: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits, k = node.view(np.uint64), int(np.searchsorted(side, 1))
        if side[0] == 2:  # a tile by itself
            p, q = forest(bits, None, radius)
        elif k in (0, len(side)):
            return node[:0], node[:0]
        else:
            p, q = forest(bits[:k], bits[k:], radius)
        return node[p], node[q]

    blocks = [block(i, *r) for i, r in enumerate(_blocks(radius + 1))]
    rows = nodes.select("node", F.explode(F.array(*blocks)).alias("k")).select("node", "k.block", "k.value")
    return by_item(lay_out(rows, ["block", "value"], F.bit_count("node"), F.lit(1), tile, radius), link)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, tile: int = 2048) -> DataFrame:
    """``(id, key, node, root, component)`` for each row of ``docs``: see :func:`near_duplicates`; rows of one component have one root."""
    marked = cut(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = marked.groupBy("node").agg(F.min("id").alias("least"))
    found = components(links(marked.select("node").distinct(), radius, tile)).withColumnRenamed("node", "_n")
    grouped = cut(nodes.join(found, nodes["node"] == found["_n"], "left").select("node", F.coalesce("root", "node").alias("root"), "least"), "nodes")
    discard(found)
    least = cut(grouped.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = cut(grouped.join(least, "root").select("node", "root", "component"), "named")
    discard(grouped), discard(least)
    return marked.join(named, "node").select("id", "key", "node", "root", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, tile: int = 2048) -> DataFrame:
    """``(id, fp, component)`` for each row of ``docs``; fp is the fingerprint.

    component is the least id among the rows reachable by links of at most
    ``radius`` differing bits.  A null text has no words: its fingerprint is 0,
    which links like any other.  Rows with a null id take part but never lend
    their id; a component of such rows alone has a null component.  Repeated
    rows are kept, each with its own fingerprint.  Of very long texts the bits
    of 65,536 shingles are held at a time.  Other columns of ``docs`` are not
    read, so their names can't clash.  An empty table gives an empty result.
    """
    return groups(docs, id_col, text_col, width, radius, tile).select("id", F.col("node").alias("fp"), "component")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def pick(docs: DataFrame, grouped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each root of ``grouped(id, key, root)``, that with the least id; columns as in ``docs``.

    A row is named by its id and text, so rows that share an id but not a text
    are each judged by their own.  Of rows that repeat both one stays.  Rows
    without an id can't be named as a group's document, so they all stay.  What
    is joined to the texts are the rows that go, and the few that come twice.
    The rows that go grow with the corpus, so that join is never a broadcast.
    """
    own = cut(grouped.where("id IS NOT NULL").groupBy("id", "key").agg(F.min("root").alias("root"), F.count("*").alias("n")), "rows")
    stay = cut(own.groupBy("root").agg(F.min(F.struct("id", "key")).alias("own")).select("own.*", F.lit(True).alias("stays")), "stay")
    marks = own.join(stay, ["id", "key"], "left").where("stays IS NULL OR n > 1")
    marks = cut(marks.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("stays").alias("_stays")), "marks")
    twice = cut(marks.where("_stays").select("_id", "_key"), "twice")  # a table of its own, so that Spark knows how small it is
    discard(own), discard(stay), discard(grouped)
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_key"))
    single = rows.join(marks.select("_id", "_key").hint("merge"), ["_id", "_key"], "left_anti")  # rows without an id among them
    repeated = rows.join(twice, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return single.select("_row.*").union(repeated.select("_row.*"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each component of near-duplicates, as :func:`pick` chooses it."""
    return pick(docs, groups(docs, id_col, text_col, **kw), id_col, text_col)

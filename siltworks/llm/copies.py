"""Near-copies: SimHash fingerprints compared in tiles, each link checked exactly.

The tiled comparison of :mod:`simhash`, for a similarity in place of a radius.

1. One Arrow pass hashes the shingles of whole texts.  Rows with one set of
   shingles are one node.  A node has a SimHash fingerprint of 256 bits of its
   set.
2. All nodes are laid out in tiles by the sets' sizes.  Each pair of tiles is
   compared by exclusive-or and bit counts, but for those whose sizes rule the
   similarity out; there are no buckets that a pair could miss.  An item gives
   a spanning forest of the pairs within ``radius`` bits, and connected
   components over these are what is checked from here on: a pair within the
   radius lies in one component.  Of two sets at 0.8 a bit differs with a chance
   of 0.19 at most (sets of four and five; 0.152 for large ones), so 80 bits
   of 256 are exceeded with a chance of 6e-7 at most.
3. In its component each node is held against one node, so that a large group
   of copies costs one comparison for each.
4. Components that then still hold several groups are laid out in tiles by the
   sets' sizes.  In a tile sets are compared by parities with exclusive-or and bit
   counts: of each of many classes of hashes, whether a set holds an odd number.
   Two sets differ in at least as many elements as parities, so none at the
   similarity is dismissed.  A tile gives a spanning forest of what passes, and
   those links are checked.
5. What a tile's parities then still can't part is decided in the tile itself
   by whole sets, again as a spanning forest.  So no candidate that could join
   two groups is left out, and no group gives all its pairs.
6. Connected components over the links; one row of each stays.

A link is checked by the Jaccard similarity of the two whole sets of (64-bit
hashes of) shingles.  The pairs of step 2 grow with the square of the distinct
texts; what is shuffled for them does not, since tiles are a share of all nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .simhash import by_item, lay_out, pick, row_key
from .store import cut, discard

#: Longs of a fingerprint.
_UNITS = 4
#: Shingles whose bits are added up at a time.
_CHUNK = 8192
#: Fingerprints of either side that are compared at a time.
_BLOCK = (8, 4096)
#: Longs that a comparison of parities makes at a time.
_WORK = 1 << 22


def shingle_hashes(text: bytes | None, width: int = 5, seed: int = 42) -> np.ndarray:
    """The distinct hashes, in order, of a text's shingles of ``width`` words; a shorter text is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) <= width else map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(p, seed) for p in parts), np.uint64))


def node_of(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes())


def _mixed(hashes: np.ndarray, unit: int) -> np.ndarray:
    """Another 64 bits from each hash; the hash itself for unit 0."""
    if not unit:
        return hashes
    x = hashes + np.uint64(unit * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of a set: of each bit of its hashes, whether it is set in over half of them."""
    ones = np.zeros((_UNITS, 64), np.int64)
    for at in range(0, len(hashes), _CHUNK):
        for u in range(_UNITS):
            h = _mixed(hashes[at : at + _CHUNK], u)
            ones[u] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").view(np.uint64)[:, 0]


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``(id, key, node, size, u0, u1, ...)`` for each row: the fingerprint in longs."""
    own = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("t"))
    units = [f"u{u}" for u in range(_UNITS)]
    out = own.select("id", "key").schema.add("node", "long").add("size", "integer")
    for u in units:
        out = out.add(u, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, prints = [], [], []
            for x in b.column(2):
                hashes = shingle_hashes(x.as_py(), width)
                sizes.append(len(hashes)), nodes.append(node_of(hashes)), prints.append(fingerprint(hashes))
            marks = np.array(prints, np.uint64).reshape(-1, _UNITS).view(np.int64)
            cols = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), *(pa.array(marks[:, u]) for u in range(_UNITS))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["id", "key", "node", "size", *units])

    return own.mapInArrow(run, out)


def _level(similarity: float) -> Column:
    """The level of a set's size; levels of sets at the similarity are at most one apart."""
    return F.floor(F.log(F.greatest("size", F.lit(1))) / -math.log(similarity) + 1e-9)


def _within(radius: int):
    """A spanning forest of the pairs of an item whose fingerprints differ in at most ``radius`` bits."""

    def link(side: np.ndarray, node: np.ndarray, *units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(node), int(np.searchsorted(side, 1))
        alone = side[0] == 2  # a tile by itself
        if not alone and k in (0, n):
            return node[:0], node[:0]
        bits = [u.view(np.uint64) for u in units]
        label, a, b = np.arange(n), [], []
        for i in range(0, n if alone else k, _BLOCK[0]):
            rows = slice(i, min(i + _BLOCK[0], n if alone else k))
            for j in range(i if alone else k, n, _BLOCK[1]):
                cols = slice(j, j + _BLOCK[1])
                apart = np.zeros(1, np.uint8)  # 256 bits apart come as 0, which the check of links sets right
                for u in bits:
                    apart = apart + np.bitwise_count(u[rows, None] ^ u[None, cols])
                near = apart <= radius
                for r in np.flatnonzero(near.any(1)).tolist():
                    found = j + np.flatnonzero(near[r])
                    found = found[label[found] != label[i + r]]
                    if len(found):
                        others, first = np.unique(label[found], return_index=True)
                        a += [i + r] * len(others)
                        b += found[first].tolist()
                        label[np.isin(label, others)] = label[i + r]
        return node[np.array(a, np.int64)], node[np.array(b, np.int64)]

    return link


def near_links(nodes: DataFrame, similarity: float = 0.8, radius: int = 80, tiles: int = 64) -> DataFrame:
    """Links ``(a, b)`` that connect just what chains of pairs of ``nodes(node, size, u0, ...)`` within the radius connect, where sizes don't rule the similarity out.

    Every pair of tiles with such sizes is compared.  A tile holds a share of
    all nodes, so that a row is dealt to as many items in a table of any size.
    """
    tile = max(256, -(-nodes.count() // tiles))
    rows = nodes.select("node", "size", *(f"u{u}" for u in range(_UNITS)), F.lit(0).alias("bucket"))
    return by_item(lay_out(rows, ["bucket"], _level(similarity), F.lit(1), tile, 1).drop("size"), _within(radius))


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether a set holds an odd number of the hashes of each class: as many bits as elements or more, a power of two."""
    classes = max(256, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """``(node, size, odd, hashes)`` of each row of ``texts(t)``."""
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                sets = [shingle_hashes(x.as_py(), width) for x in b.column(0)[at : at + 256]]
                nodes = np.array([node_of(s) for s in sets], np.uint64).view(np.int64)
                cols = [pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), pa.array([parities(s).view(np.int64) for s in sets], longs), pa.array([s.view(np.int64) for s in sets], longs)]
                yield pa.RecordBatch.from_arrays(cols, ["node", "size", "odd", "hashes"])

    return texts.mapInArrow(run, "node long, size int, odd array<long>, hashes array<long>")


def _near(side: np.ndarray, size: np.ndarray, odd: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of an item the rows (of its other side, or after it) that may have the similarity, by their parities."""
    share = (1 - similarity) / (1 + similarity)  # of both sizes together, the elements in which sets at the similarity differ
    words = np.array([len(x) for x in odd])
    alone = side[0] == 2
    for w in np.unique(words):
        x_rows = np.flatnonzero((words == w) & (side != 1))
        for v in (w, 2 * w) if alone else (w // 2, w, 2 * w):  # the similarity bounds the sizes' ratio by two, and so that of the bits
            y_rows = np.flatnonzero((words == v) & (side != 0))
            if not len(x_rows) or not len(y_rows):
                continue
            narrow = min(w, v)
            x, y = (np.stack([odd[i] if len(odd[i]) == narrow else odd[i][:narrow] ^ odd[i][narrow:] for i in rows]).view(np.uint64) for rows in (x_rows, y_rows))
            step = max(1, _WORK // (len(y_rows) * narrow))
            across = max(1, _WORK // narrow)
            for i in range(0, len(x_rows), step):
                apart = np.concatenate([np.bitwise_count(x[i : i + step, None] ^ y[None, j : j + across]).sum(2, np.int64) for j in range(0, len(y_rows), across)], axis=1)
                near = apart <= share * (size[x_rows[i : i + step], None] + size[None, y_rows]) + 1e-6
                for p, may in zip(x_rows[i : i + step].tolist(), near, strict=True):
                    found = y_rows[may]
                    yield p, found[found > p] if alone and v == w else found


def _may_link(similarity: float):
    """A spanning forest, over the roots, of the pairs of an item that may have the similarity."""

    def link(side: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label, a, b = root.copy(), [], []
        for p, found in _near(side, size, odd, similarity):
            found = found[label[found] != label[p]]
            if len(found):
                others, first = np.unique(label[found], return_index=True)
                a += [p] * len(others)
                b += found[first].tolist()
                label[np.isin(label, others)] = label[p]
        return node[np.array(a, np.int64)], node[np.array(b, np.int64)]

    return link


def _still_near(similarity: float):
    """The nodes of an item that may have the similarity to one of another root, each twice."""

    def link(side: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        held = np.zeros(len(node), bool)
        for p, found in _near(side, size, odd, similarity):
            found = found[root[found] != root[p]]
            held[found] = True
            held[p] |= len(found) > 0
        return node[held], node[held]

    return link


def _link(similarity: float):
    """A spanning forest, over the roots, of the pairs of an item that have the similarity, by parities and then whole sets."""

    def link(side: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, odd: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label, a, b = root.copy(), [], []
        for p, others in _near(side, size, odd, similarity):
            while len(others := others[label[others] != label[p]]):
                q, others = int(others[0]), others[1:]
                both = len(np.intersect1d(hashes[p], hashes[q], assume_unique=True))
                if both >= similarity * (size[p] + size[q] - both) - 1e-9:
                    a.append(p), b.append(q)
                    label[label == label[q]] = label[p]
        return node[np.array(a, np.int64)], node[np.array(b, np.int64)]

    return link


def _items(members: DataFrame, sets: DataFrame, similarity: float, tile: int, columns: list[str], used: list[DataFrame], weight: Column | None = None) -> DataFrame | None:
    """Work items of the buckets of ``members(bucket, node, root)`` that hold several roots, with columns of the sets; nothing, if there are none."""
    mixed = members.groupBy("bucket").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p < q")
    mixed = cut(mixed.select("bucket"), "buckets")
    used.append(mixed)
    if mixed.isEmpty():
        return None
    rows = members.join(mixed, "bucket", "left_semi").join(sets.select("node", "size"), "node").select("bucket", "node", "root", "size")
    rows = cut(rows, "work")
    laid = cut(lay_out(rows.select("bucket", "node", "root", "size"), ["bucket"], _level(similarity), F.lit(1) if weight is None else weight, tile, 1).drop("size"), "items")
    used += [rows, laid]
    return laid.join(sets.select("node", *columns), "node").select("item", "side", "node", "root", *columns)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have at least the similarity."""
    one, two = (sets.select(F.col("node").alias(n), F.col("hashes").alias(f"of_{n}")) for n in ("a", "b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("of_a") + F.size("of_b")).alias("sum"))
    return rows.where(F.col("both") >= similarity * (F.col("sum") - F.col("both")) - 1e-9).select("a", "b")


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members(bucket, node)`` with the root of each node by the links."""
    found, members = components(links), members.select("bucket", "node")
    roots = found.withColumnRenamed("node", "_n")
    out = cut(members.join(roots, members["node"] == roots["_n"], "left").select("bucket", "node", F.coalesce("root", "node").alias("root")), "members")
    discard(found)
    return out


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, width: int = 5, radius: int = 80, tile: int = 512, shingles: int = 1 << 18) -> DataFrame:
    """``(id, key, node, root)`` for each row of ``docs``; rows in one connected component of near-copies have one root.

    ``radius``, of 256 bits, has to leave room for chance at the similarity.
    Where sets are compared, a tile holds about ``tile`` nodes, or ``shingles``
    where they are whole.  Memory for a long text grows with the number of its
    shingles.
    """
    units = [f"u{u}" for u in range(_UNITS)]
    marked = cut(_sketches(docs, id_col, text_col, width), "sketches")
    # smaller sets have the similarity to none but themselves
    large = marked.where(F.col("size") >= similarity / (1 - similarity) - 1e-9)
    nodes = cut(large.groupBy("node").agg(F.min("key").alias("key"), *(F.first(c).alias(c) for c in ("size", *units))), "nodes")
    close = cut(near_links(nodes, similarity, radius), "near")
    found = components(close)
    buckets = found.union(found.select("root", "root").distinct()).toDF("node", "bucket")
    members = cut(nodes.select("node", "key").join(buckets, "node"), "members")
    discard(nodes), discard(close), discard(found)
    wanted = members.select("key").distinct()  # grows with the corpus: never a broadcast
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("t")).join(wanted.hint("merge"), "key", "left_semi").dropDuplicates(["key"])
    sets = cut(_sets(texts.select("t"), width), "sets")

    first = members.where("node <> bucket").select(F.col("bucket").alias("a"), F.col("node").alias("b"))
    links = cut(_confirmed(first, sets, similarity), "links")
    now = _rooted(members, links)
    used = [sets, links, members, now]

    # the links that parities let through, one for each two components of a tile
    work = _items(now, sets, similarity, tile, ["size", "odd"], used)
    if work is not None:
        more = by_item(work, _may_link(similarity)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        more = cut(_confirmed(more, sets, similarity), "links")
        now, links = _rooted(now, links.union(more)), links.union(more)
        used += [more, now]
        # what is still not parted: whole sets, of those nodes alone
        work = _items(now, sets, similarity, tile, ["size", "odd"], used)
    if work is not None:
        near = cut(by_item(work, _still_near(similarity)).select(F.col("a").alias("node")).distinct(), "near")
        used.append(near)
        work = _items(now.join(near, "node", "left_semi"), sets, similarity, shingles, ["size", "odd", "hashes"], used, F.col("size"))
    if work is not None:
        last = cut(by_item(work, _link(similarity)).distinct(), "links")
        links = links.union(last)
        used.append(last)

    found = components(links)
    roots = found.withColumnRenamed("node", "_n")
    out = cut(marked.join(roots, marked["node"] == roots["_n"], "left").select("id", "key", "node", F.coalesce("root", "node").alias("root")), "groups")
    for x in [*used, marked, found]:
        discard(x)
    return out


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each component of near-copies, that with the least id; columns as in ``docs``.

    Of rows with one id and text one stays; rows with one id and different
    texts are judged each by its own text.  Texts without words, null ones
    included, are copies of each other.  Rows without an id can't be named as a
    group's document, so they all stay.  An empty table stays empty.
    """
    return pick(docs, groups(docs, id_col, text_col, **kw), id_col, text_col)

"""Passages that documents share, by content-defined chunking.

A gear hash rolls over a text's bytes (white space made one space); a word end
at which its upper bits are small is a cut, so cuts depend on the last 16 bytes
alone and come back into step right after an insertion.  A chunk is what lies
between cuts; since short chunks repeat by chance, a chunk is digested together
with those that follow it until it holds ``least`` words.  Digests that occur
in two documents or more are duplicates; in each document, duplicates that
touch or overlap join into runs.

Chunk rows are written once.  Digests are counted with map-side combining, and
those that documents share are written before they are joined back: both sides
of the join are then plain shuffles, of which Spark can split a hot digest's
chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

#: The gear table: one 16-bit value a byte, none for the padding byte.
GEAR = np.array([0] + [xxhash.xxh32_intdigest(bytes([b]), 0) & 0xFFFF for b in range(1, 256)], np.uint16)
_PAD = bytes(16)
_WORK = 1 << 22


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash's low 16 bits at each byte: the sum of the last 16 bytes' values, each shifted by its distance."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint16(step)
    return h


def chunks(texts: list[bytes], one_in: int = 4, most: int = 24, least: int = 12) -> tuple[np.ndarray, ...]:
    """(text, first word, words, digest) of every digested chunk of the texts."""
    words = [t.replace(b"\0", b" ").split() for t in texts]
    data = b"".join(x for ws in words for x in (_PAD, b" ".join(ws), b" "))
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw == 32)  # a space after each word
    ends = ends[raw[ends - 1] != 0] if len(ends) else ends
    count = np.array([len(w) for w in words])
    base = np.cumsum(count) - count  # number of each text's first word
    if not len(ends):
        return (np.empty(0, np.int64),) * 4
    lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64, len(ends))
    starts = ends - lengths
    is_cut = (gear(raw)[ends] >> np.uint16(8)) < 256 // one_in
    is_cut[(base + count - 1)[count > 0]] = True
    cuts = np.flatnonzero(is_cut) + 1  # each chunk is up to here
    begin = np.concatenate([[0], cuts[:-1]])
    long = np.flatnonzero(cuts - begin > most)
    forced = [np.arange(begin[i] + most, cuts[i], most) for i in long]
    cuts = np.sort(np.concatenate([cuts, *forced]))
    begin = np.concatenate([[0], cuts[:-1]])
    owner = np.searchsorted(base + count, begin, "right")
    until = np.searchsorted(cuts, begin + least)
    keep = until < len(cuts)
    keep[keep] = cuts[until[keep]] <= (base + count)[owner[keep]]
    begin, owner, end = begin[keep], owner[keep], cuts[until[keep]]
    view, digest = memoryview(data), xxhash.xxh64_intdigest
    found = np.fromiter((digest(view[a:b]) for a, b in zip(starts[begin].tolist(), ends[end - 1].tolist(), strict=True)), np.uint64, len(begin))
    return owner, begin - base[owner], end - begin, found.view(np.int64)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``(id, first, words, digest)``: the digested chunks of all rows with an id."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            while at < b.num_rows:
                texts, size = [], 0
                while at + len(texts) < b.num_rows and size < _WORK:
                    texts.append(b.column(1)[at + len(texts)].as_py())
                    size += len(texts[-1])
                owner, first, words, digest = chunks(texts, **kw)
                ids = b.column(0).take(pa.array(owner + at))
                yield pa.RecordBatch.from_arrays([ids, pa.array(first, pa.int32()), pa.array(words, pa.int32()), pa.array(digest)], ["id", "first", "words", "digest"])
                at += len(texts)

    return rows.mapInArrow(run, rows.select("id").schema.add("first", "integer").add("words", "integer").add("digest", "long"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_run: int = 24, **kw) -> DataFrame:
    """``(id, first_word, n_words, first_id)``: runs of at least ``least_run`` words that other documents have too.

    A passage shows from its first to its last cut, so runs are shorter than
    passages: one of 51 words shows 24 or more with a chance of 0.997, by the
    cuts' geometric distances, and near-copies with an edit every few
    words show few.  ``first_id`` is the least id among the documents that share a chunk of the
    run; where it is the row's own id, the run is what stays.  Rows with a null
    id or text have no chunks.  Rows that repeat an id are one document, and
    repeats inside a document don't count.  A NUL byte parts words as a space
    does, here and in the numbers of words.  A very long text is chunked whole,
    by one task, which holds its bytes, words and hashes.  Other columns are not
    read.  An empty table gives no rows.
    """
    found = cut(digests(docs, id_col, text_col, **kw), "chunks")
    shared = found.groupBy("digest").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id <> last_id").drop("last_id")
    shared = cut(shared, "shared")
    hits = found.join(shared, "digest").select("id", F.col("first").alias("start"), (F.col("first") + F.col("words")).alias("stop"), "first_id").distinct()
    before = Window.partitionBy("id").orderBy("start", "stop", "first_id").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("id").orderBy("start", "stop", "first_id").rowsBetween(Window.unboundedPreceding, 0)
    apart = hits.withColumn("new", F.when(F.col("start") <= F.max("stop").over(before), 0).otherwise(1)).withColumn("run", F.sum("new").over(through))
    runs = apart.groupBy("id", "run").agg(F.min("start").alias("first_word"), (F.max("stop") - F.min("start")).alias("n_words"), F.min("first_id").alias("first_id"))
    return runs.where(F.col("n_words") >= least_run).select("id", "first_word", "n_words", "first_id")

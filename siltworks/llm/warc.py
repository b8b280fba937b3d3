"""Web archives: writing them, and reading them back by their chain of records.

Writing.  Equal payloads are kept once: the record with the least page id is a
response, the others are revisits of it.  A record is a gzip member of its own,
so readers can seek to it.  Members are lines of Spark's text writer with a zero
byte as the line's end: a member ends with its record's length, whose last byte
is zero up to 16 MB (beyond, the zero is padding, which readers skip).  So any
store that Spark can write will do, and its commit protocol guards against lost
tasks.

Reading.  A payload may hold what looks like the start of a record.  Tasks emit
every candidate start with the offset that its own length field leads to, and
the archive's end; in each archive, pointer jumping from offset 0 marks what the
chain reaches, and only those candidates are records.  An archive whose chain
doesn't reach its end is not whole, and its records say so.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import cut, discard, new_path

END = "\r\n\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed value: the profile of revisits of equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_CANDIDATE = "archive string, offset long, successor long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, intact boolean"
_RECORD = f"{_CANDIDATE}, whole boolean"


def digest(payload: Column) -> Column:
    """SHA-1 as 32 characters of upper-case base32."""
    sha = F.sha1(payload)
    parts = []
    for i in range(8):  # five hex digits are four base32 characters
        n = F.conv(F.substring(sha, 5 * i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(_ALPHABET), F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def _payload(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _key(page_id: Column, payload_digest: Column) -> Column:
    return F.concat_ws(":", page_id.cast("string"), payload_digest)


def mark(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", text_col: str = "html") -> DataFrame:
    """``(key, page_id, payload_bytes, payload_digest, n, record_type, refers_to, known)`` for each page and payload, once.

    A null payload is empty.  Payloads under ``least_bytes`` are always
    responses.  Of equal payloads, rows of the least id are responses; a row
    without an id is a revisit if any other row of the payload has an id.  ``n``
    rows repeat a page and payload; ``known`` says that one row alone is the
    response that is referred to.  Payloads themselves are not shuffled.  The
    payloads that come again are written before they are joined, so that Spark
    can split the pages of one that many share.
    """
    payload = _payload(text_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.octet_length(payload).cast("long").alias("payload_bytes"), digest(payload).alias("payload_digest"))
    rows = cut(rows.groupBy("page_id", "payload_bytes", "payload_digest").agg(F.count("*").alias("n")), "digests")
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.min_by("n", "page_id").alias("first_n"), F.sum("n").alias("all"))
    first = cut(first.where("all > 1").select("payload_digest", "first", (F.col("first_n") == 1).alias("known")), "first")
    again = (F.col("payload_bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(first, "payload_digest", "left")
    marked = marked.select(_key(F.col("page_id"), F.col("payload_digest")).alias("key"), "page_id", "payload_bytes", "payload_digest", "n", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"), (again & F.col("known")).alias("known"))
    marked = cut(marked, "marks")
    discard(rows), discard(first)
    return marked


def _record_id(page_id: Column, payload_digest: Column, count: Column) -> Column:
    """A name of its own for each record, from what it holds: the same for page and payload wherever they come once."""
    m = F.md5(F.concat_ws(":", page_id.cast("string"), payload_digest, count.cast("string")))
    parts = [F.substring(m, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _members(records: DataFrame) -> DataFrame:
    """``value``: each of ``records(head, payload)`` as a gzip member, without the zero byte at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for head, payload in zip(b.column(0), b.column(1), strict=True):
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(head.as_py()) + z.compress(payload.as_py()) + z.compress(END.encode()) + z.flush()
                out.append(member[:-1] if member[-1] == 0 else member)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return records.select(F.col("head").cast("binary"), F.col("payload").cast("binary")).mapInArrow(run, "value binary")


def write(pages: DataFrame, path: str, archive_bytes: int = 16 << 20, least_bytes: int = 0, id_col: str = "page_id", text_col: str = "html", url_col: str = "url", date: datetime | None = None) -> None:
    """Write archives of about ``archive_bytes`` (before compression, at most half of Spark's 2 GB a value) to ``path``.

    Pages are shuffled once, by id and digest; that shuffle's tasks write them.
    Rows that repeat a page and its payload are records of their own, and meet
    in one task.  A page without a URL is named ``urn:page:`` and its id.
    ``date`` (now, if not given) stands in every record.
    """
    marked = mark(pages, least_bytes, id_col, text_col)
    total = marked.agg(F.sum((F.col("payload_bytes") + 600) * F.col("n"))).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    payload = _payload(text_col)
    rows = pages.select(_key(F.col(id_col).cast("long"), digest(payload)).alias("key"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.repartition(archives, "key").join(marked.repartition(archives, "key").hint("merge"), "key")
    kept = F.col("record_type") == "response"
    text = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    number = lambda name, value: F.when(value.isNull(), "").otherwise(text(name, value.cast("string")))
    url = F.coalesce(F.nullif(F.regexp_replace("url", "[\r\n]", "%0A"), F.lit("")), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    count = F.when(F.col("n") == 1, F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        text("WARC-Type", F.col("record_type")),
        text("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"), count)),
        text("WARC-Date", F.lit((date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ"))),
        F.when(kept, "").otherwise(text("WARC-Profile", F.lit(PROFILE))),
        F.when(F.col("known"), text("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("payload_digest"), F.lit(0)))).otherwise(""),
        text("WARC-Target-URI", url),
        text("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        number("X-Page-ID", F.col("page_id")),
        number("X-Refers-To-Page", F.col("refers_to")),
        number("X-Payload-Length", F.col("payload_bytes")),
        text("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "),
        F.when(kept, F.col("payload_bytes")).otherwise(0).cast("string"),
        F.lit(END),
    )
    records = _members(rows.select(head.alias("head"), F.when(kept, F.col("payload")).otherwise("").alias("payload")))
    records.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none").text(path)
    discard(marked)


def plain(data: bytes) -> tuple[bytes, bool]:
    """An archive's bytes without compression, and whether that could be undone to the end."""
    if data[:2] != b"\x1f\x8b":
        return data, True
    out, at, view = [], 0, memoryview(data)
    while at < len(data):
        z = zlib.decompressobj(31)
        try:
            while not z.eof and at < len(data):  # piece by piece, as what a member leaves over is copied
                piece = view[at : at + (1 << 14)]
                out.append(z.decompress(piece))
                at += len(piece) - len(z.unused_data)
        except zlib.error:
            return b"".join(out), False
        if not z.eof:
            return b"".join(out), False
        while at < len(data) and data[at] == 0:
            at += 1
    return b"".join(out), True


def _number(digits: bytes | None) -> int | None:
    """A long in decimal digits, or nothing."""
    if digits is None or not re.fullmatch(rb"-?\d{1,19}", digits):
        return None
    n = int(digits)
    return n if -(1 << 63) <= n < 1 << 63 else None


def _page(head: dict[bytes, bytes], own: bytes, urn: bytes) -> int | None:
    """A page's number from a header of its own, or from an id of the form ``<urn:page:N>``."""
    if own in head:
        return _number(head[own])
    found = re.fullmatch(rb"<urn:page:(.*)>", head.get(urn, b""))
    return _number(found[1]) if found else None


def parse(archive: str, data: bytes, sound: bool = True) -> Iterator[tuple]:
    """Every candidate of an archive's bytes, as a row of ``_CANDIDATE``, and its end, with the record type ``end``."""
    for m in _MAGIC.finditer(data):
        body = data.find(b"\r\n\r\n", m.end())
        if body < 0:
            continue
        head = dict(x.partition(b": ")[::2] for x in data[m.end() : body].split(b"\r\n"))
        length = _number(head.get(b"Content-Length"))
        if length is None or length < 0:
            continue
        successor = body + 4 + length + 4
        if successor > len(data) or data[successor - 4 : successor] != b"\r\n\r\n":
            continue
        kind = head.get(b"WARC-Type", b"").decode(errors="replace")
        said = head.get(b"WARC-Payload-Digest", b"").removeprefix(b"sha1:").decode(errors="replace")
        if kind == "revisit":
            size, found = _number(head.get(b"X-Payload-Length")), said
        else:
            size, found = length, base64.b32encode(hashlib.sha1(data[body + 4 : successor - 4]).digest()).decode()
        page, refers = _page(head, b"X-Page-ID", b"WARC-Record-ID"), _page(head, b"X-Refers-To-Page", b"WARC-Refers-To")
        url = head.get(b"WARC-Target-URI", b"").decode(errors="replace")
        yield archive, m.start(), successor, page, None if url.startswith("urn:page:") else url, size, found, kind, refers, head.get(b"WARC-Record-ID", b"").decode(errors="replace"), found == said
    yield archive, len(data), None, None, None, None, None, "end", None, None, sound


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate records of all archives under ``path`` (gzipped or not), with their successors' offsets, and each archive's end."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    kinds = {name: _KINDS[kind] for name, kind in (x.split() for x in _CANDIDATE.split(", "))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                cols = list(zip(*parse(archive, *plain(content.as_py())), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], list(kinds))

    return files.mapInArrow(run, _CANDIDATE)


def reachable(offset: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which of the sorted offsets the chain from offset 0 reaches, by pointer jumping."""
    n = len(offset)
    at = np.searchsorted(offset, successor)
    jump = np.where((at < n) & (offset[np.minimum(at, n - 1)] == successor), at, n) if n else at
    jump = np.append(jump, n)
    reach = np.zeros(n + 1, bool)
    if n and offset[0] == 0:
        reach[0] = True
    while (jump[:n] < n).any():
        reach[jump[reach]] = True
        jump = jump[jump]
    reach[jump[reach]] = True
    return reach[:n]


def _chained(found: DataFrame) -> DataFrame:
    """The candidates and ends that their archive's chain reaches, with ``whole``.  A group is one archive's candidates, bounded by its size."""

    def chain(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("offset").combine_chunks()
        reach = reachable(rows["offset"].to_numpy(), rows["successor"].fill_null(-1).to_numpy())
        end = np.array(rows["record_type"].to_pylist()) == "end"
        whole = bool((reach & end & rows["intact"].to_numpy()).any())
        rows = rows.filter(pa.array(reach | end))
        return rows.append_column("whole", pa.array([whole] * len(rows), pa.bool_()))

    return found.groupBy("archive").applyInArrow(chain, _RECORD)


def _with_responses(records: DataFrame) -> DataFrame:
    """A revisit is intact if the page that it refers to has an intact response of its digest."""
    there = records.where("record_type = 'response' AND intact").select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest")).distinct()
    there = cut(there.withColumn("_there", F.lit(True)), "responses")
    rows = records.join(there, (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return rows.withColumn("intact", F.when(F.col("record_type") == "revisit", F.coalesce("_there", F.lit(False))).otherwise(F.col("intact"))).drop("_page", "_digest", "_there")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path`` that their archives' chains reach.

    ``intact`` says whether a payload has the digest that its header names, and
    for a revisit whether there is such a response; ``whole`` whether the
    archive's chain reaches its end.  What lies behind a break can't be told
    from a payload, so it isn't given; :func:`archives` names such archives, also
    those without any record.
    """
    chained = cut(_chained(candidates(spark, path)), "records")
    return _with_responses(chained.where("record_type <> 'end'"))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``(archive, bytes, records, whole)`` of every archive under ``path`` that isn't empty; bytes are without compression."""
    rows = _chained(candidates(spark, path))
    return rows.groupBy("archive").agg(F.max(F.when(F.col("record_type") == "end", F.col("offset"))).alias("bytes"), F.count_if(F.col("record_type") != "end").alias("records"), F.first("whole").alias("whole"))


def round_trip(pages: DataFrame, **kw) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back.

    A null payload is empty, a null URL comes back as null, a null page id as
    well.  Repeated rows come back as often as they were there.  Columns other
    than id, URL and payload are not read.  An empty table gives an empty result.
    """
    path = new_path(pages.sparkSession, "warc")
    write(pages, path, **kw)
    return read(pages.sparkSession, path)


def _sql() -> str:
    digit = "substr('{0}', ((('0x' || substr(s, {1}, 5))::INTEGER >> {2}) & 31) + 1, 1)"
    name = " || ".join(digit.format(_ALPHABET, 5 * i + 1, shift) for i in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS s FROM pages),
f AS (SELECT s, min(page_id) AS first FROM p GROUP BY s)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {name} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
FROM p JOIN f USING (s)"""


#: SQL for the round trip: what comes back is what went in.
SQL = _sql()

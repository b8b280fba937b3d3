"""Scans: manifests, logs, dumps, listings, blobs."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ranking import first_of, latest
from ..schemas import CANDIDATE, MANIFEST


def read_manifest(spark: SparkSession, path: str, schema: StructType = MANIFEST, tolerant: bool = False) -> DataFrame:
    """JSON lines with an explicit schema.  Blank lines are skipped; a torn line stops the query, or is skipped if ``tolerant``."""
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    wide = StructType([*schema.fields]).add("_corrupt", "string")
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("_corrupt IS NULL").drop("_corrupt")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates; unknown fields are dropped, an unknown original width is the declared one."""
    rows = read_manifest(spark, path, CANDIDATE)
    return rows.withColumn("orig_width", F.coalesce("orig_width", "declared_width"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The columnar mirror; filters, columns and limits reach its scan."""
    return spark.read.parquet(path)


def _member_lines(lines: Iterator[bytes], member: str) -> Iterator[bytes]:
    """The lines of one member of a tar, from all lines of the archive; headers and padding are parts of lines."""
    inside = False
    for line in lines:
        while (at := _header(line)) >= 0:
            before, head, line = line[:at].rstrip(b"\0"), line[at : at + 512], line[at + 512 :]
            if inside and before:
                yield before  # the member before has no newline at its end
            name = head[:100].rstrip(b"\0").decode("utf-8", "replace")
            inside = head[156:157] in (b"0", b"\0") and name.rpartition("/")[2] == member
        if inside and (line := line.rstrip(b"\0")):
            yield line


def _header(line: bytes) -> int:
    """Where a tar header starts in a line, told by its mark and checksum, or -1."""
    at = line.find(b"ustar")
    while at >= 0:
        head = line[at - 257 : at + 255] if at >= 257 else b""
        digits = head[148:156].strip(b"\0 ")
        if len(head) == 512 and digits.isdigit() and int(digits, 8) == sum(head) - sum(head[148:156]) + 8 * 32:
            return at - 257
        at = line.find(b"ustar", at + 1)
    return -1


def read_dump(spark: SparkSession, path: str, member: str, schema: StructType) -> DataFrame:
    """JSON lines of one member of gzipped tars, of any size; a stream that is cut short ends the scan without an error.

    Spark's text reader undoes the compression as it reads (names must end in
    ``.gz``) and gives the archive's lines, with headers and padding among them.
    A gzip stream can't be split, so an archive is one task, which holds a batch
    of lines at a time.  A member is named by the last part of its path.  Lines
    that aren't objects are skipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_lines() -> Iterator[tuple[str, bytes]]:
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)

        for _, own in groupby(all_lines(), key=itemgetter(0)):
            found = (x for x in _member_lines(map(itemgetter(1), own), member) if x.rstrip().endswith(b"}"))
            while some := list(islice(found, 5000)):
                yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace") for x in some], pa.string())], ["line"])

    lines = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", "true").text(path)
    rows = lines.select(F.col("_metadata.file_path").alias("f"), F.col("value").cast("binary").alias("value")).mapInArrow(run, "line string")
    return rows.select(F.from_json("line", schema).alias("r")).where("r IS NOT NULL").select("r.*")


def read_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files of many runs with ``run``, the folder above each, whose names sort in order of time."""
    rows = spark.read.schema(schema).json(path)
    return rows.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def first_per_instance(runs: DataFrame, value: str) -> DataFrame:
    """``(sha256, instance, value)``: the first non-empty value in order of runs."""
    rows = runs.where(F.coalesce(value, F.lit("")) != "")
    return rows.groupBy("sha256", "instance").agg(F.min_by(value, "run").alias(value))


def read_recent(spark: SparkSession, path: str, since: str, fmt: str = "parquet") -> DataFrame:
    """Only files modified after ``since`` (ISO time)."""
    return spark.read.format(fmt).option("modifiedAfter", since).load(path)


def text_counts(spark: SparkSession, path: str, field: str) -> DataFrame:
    """Rows by a string field of JSON lines, taken by pattern, without parsing them."""
    pattern = rf'"{field}"\s*:\s*"((?:[^"\\]|\\.)*)"'
    return spark.read.text(path).where(F.col("value").contains(f'"{field}"')).groupBy(F.regexp_extract("value", pattern, 1).alias(field)).agg(F.count("*").alias("n"))


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """The entities of one document ``{instances: [...]}``; a lone query is a list of one; of equal names the first."""
    schema = "instances array<struct<name:string,query:string,aliases:array<string>,desc:string,source:string>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.posexplode("instances").alias("at", "e")).select("at", "e.*").where("name IS NOT NULL")
    listed = F.when(F.col("query").startswith("["), F.from_json("query", "array<string>")).otherwise(F.when(F.col("query").isNotNull(), F.array("query")))
    return first_of(rows.withColumn("query", listed), ["name"], ["at"]).drop("at")


def done_keys(log: DataFrame, key: str = "key") -> DataFrame:
    """Keys that a cache has a good record of."""
    return log.where("ok").select(key).distinct()


def latest_records(log: DataFrame, key: str, order: Column) -> DataFrame:
    return latest(log, [key], [order])


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """``url`` of each line: plain, or a JSON object with ``url`` or ``content_url``; blank lines and comments are skipped."""
    line = F.trim("value")
    url = F.when(line.startswith("{"), F.coalesce(F.get_json_object(line, "$.url"), F.get_json_object(line, "$.content_url"))).otherwise(line)
    return spark.read.text(path).where((line != "") & ~line.startswith("#")).select(url.alias("url")).where("url IS NOT NULL")


def read_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The files below a path, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "modificationTime", "length")


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content", "length")


def category_index(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """``(category, image_id, file_name)`` of an annotated image set: each image once a category.

    Plural and singular of a name are found by :func:`category_of`.
    """
    rows = annotations.select("image_id", "category_id").distinct().join(categories.select(F.col("id").alias("category_id"), F.lower("name").alias("category")), "category_id")
    return rows.join(images.select(F.col("id").alias("image_id"), "file_name"), "image_id").select("category", "image_id", "file_name")


def category_of(query: Column) -> Column:
    """The names under which a query may be a category: itself, without or with a plural s."""
    q = F.trim(F.lower(query))
    return F.array_distinct(F.array(q, F.when(q.endswith("s"), F.substr(q, F.lit(1), F.length(q) - 1)).otherwise(F.concat(q, F.lit("s")))))


def tail(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stream of the rows that appear below a folder of JSON lines; torn lines are skipped."""
    wide = StructType([*schema.fields]).add("_corrupt", "string")
    rows = spark.readStream.schema(wide).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("_corrupt IS NULL").drop("_corrupt")


def as_json_lines(rows: list[dict]) -> str:
    return "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)

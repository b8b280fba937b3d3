"""Sinks: JSON lines, tables, blobs, snapshots that replace one another, reports."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import blob_path
from ..operators import manifest
from ..operators.gates import relative_path
from ..operators.ranking import first_of
from ..plans.emerge import checked


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", blobs: DataFrame | None = None) -> None:
    """The columnar mirror; with ``blobs(path, content)`` each row takes its bytes along as ``blob``."""
    if blobs is not None:
        name = F.regexp_extract("path", r"(blobs/[^/]+/[^/]+)$", 1)
        data = blobs.select(name.alias("_p"), F.col("content").alias("blob"))
        df = df.withColumn("_p", blob_path("sha256", "ext")).join(data, "_p", "left").drop("_p")
    df.write.mode(mode).parquet(path)


class Snapshots:
    """A table as sets of files, and a numbered list of the sets that hold.

    A new set is written aside; then a list with it is written under the next
    number.  Readers take the highest number, so they see the old table or the
    new one and nothing between.  An append writes its own rows alone; a
    replacement starts a list anew.  Plain Parquet has no merge of its own.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root.getFileSystem(conf), root

    def _lists(self) -> list[int]:
        jvm, fs, _ = self._fs()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_lists")
        if not fs.exists(folder):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _sets(self, number: int) -> list[str]:
        jvm, fs, _ = self._fs()
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_lists/{number:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self) -> DataFrame | None:
        """The table as it is now; columns that some sets lack are null there."""
        numbers = self._lists()
        if not numbers:
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(*(f"{self.path}/{name}" for name in self._sets(numbers[-1])))

    def _commit(self, df: DataFrame, keep: bool) -> None:
        numbers = self._lists()
        name, number = f"data-{uuid.uuid4().hex}", (numbers or [0])[-1] + 1
        df.write.parquet(f"{self.path}/{name}")
        sets = [*(self._sets(numbers[-1]) if keep and numbers else []), name]
        jvm, fs, _ = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        fs.create(path(f"{self.path}/_claims/{number}"), False).close()  # fails if another writer has this number
        aside = path(f"{self.path}/_lists/.{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps(sets).encode()))
        stream.close()
        fs.rename(aside, path(f"{self.path}/_lists/{number:020d}.json"))

    def replace(self, df: DataFrame) -> None:
        """Make ``df``, which may come from the present table, the next one.  Of two writers at a time one fails."""
        self._commit(df, keep=False)

    def append(self, df: DataFrame) -> None:
        """Add ``df`` as a set of its own; nothing else is written again."""
        self._commit(df, keep=True)

    def vacuum(self, keep: int = 2) -> None:
        """Delete the sets that none of the last ``keep`` lists names; readers of older lists must be done, and no writer at work."""
        jvm, fs, root = self._fs()
        numbers = self._lists()
        held = {name for n in numbers[-keep:] for name in self._sets(n)}
        for x in fs.listStatus(root):
            if (name := x.getPath().getName()).startswith("data-") and name not in held:
                fs.delete(x.getPath(), True)
        for n in numbers[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_lists/{n:020d}.json"), False)


def upsert(table: Snapshots, new: DataFrame, key: str = "sha256", arrays: Sequence[str] = ("instances", "tiers"), maps: Sequence[str] = ("queries", "query_langs", "asset_ids"), order: Sequence[str] = ()) -> None:
    """Merge rows into the manifest by hash: old scalars hold, arrays and maps are united; sorted by hash within files."""
    old = table.read()
    place = F.row_number().over(Window.partitionBy(key).orderBy(*(order or [F.xxhash64(*[c for c in new.columns if c not in maps])])))
    rows = new.withColumn("_seq", place)
    if old is not None:
        rows = old.withColumn("_seq", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    merged = manifest.merge(rows, key, "_seq", [a for a in arrays if a in rows.columns], [m for m in maps if m in rows.columns]).drop("_seq")
    table.replace(merged.sortWithinPartitions(key))


def append_unseen(table: Snapshots, new: DataFrame, key: str = "sha256", order: Sequence[str] = ()) -> None:
    """Append rows of new keys, and write nothing else; others are skipped, not merged.  Rows without a key are skipped too."""
    old, new = table.read(), new.where(F.col(key).isNotNull())
    table.append(first_of(new, [key], order or [key]) if old is None else manifest.unseen(new, old.select(key), key, order or [key]))


def merge_annotations(table: Snapshots, annotations: DataFrame, key: str = "sha256", fields: Sequence[str] = ("kb_match", "richness", "caption")) -> None:
    table.replace(manifest.update_columns(table.read(), annotations, key, fields))


def write_blobs(df: DataFrame, path: str) -> None:
    """``data`` under its content's name, below a folder for the first two digits: one file a blob.

    Spark has no writer of loose files, so a task opens them itself through
    the cluster's file system.  A file is written aside and renamed, and one
    that is there already is left, so a task can be repeated.
    """
    if not path.startswith(("file:", "/")):
        raise ValueError("loose files are written on file systems that are mounted on every executor")
    root = path.removeprefix("file://").removeprefix("file:")

    def run(rows) -> None:
        for r in rows:
            to = os.path.join(root, r["_path"])
            if os.path.exists(to):
                continue
            os.makedirs(os.path.dirname(to), exist_ok=True)
            aside = f"{to}.{uuid.uuid4().hex}"
            with open(aside, "wb") as f:
                f.write(r["data"])
            os.replace(aside, to)

    df.where("data IS NOT NULL").select(blob_path("sha256", "ext").alias("_path"), "data").foreachPartition(run)


def rewrite_lines(spark: SparkSession, path: str, out: str, change: Column, where: Column) -> None:
    """JSON lines with ``change`` applied to the text of those that parse and match; all others stay as they are.

    The order of all lines is kept, by file, then place in it: lines go to the
    output's files in ranges of that order, and files' names sort in it.
    """
    where_from = {"_f": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}
    rows = spark.read.text(path).withColumns(where_from)
    good = F.try_parse_json("value").isNotNull() & where
    changed = rows.withColumn("value", F.when(F.coalesce(good, F.lit(False)), change).otherwise(F.col("value")))
    changed.orderBy("_f", "_block", "_at").select("value").write.text(out)


def repaired(spark: SparkSession, path: str, out: str, root: str, field: str = "path") -> None:
    """JSON lines whose absolute blob paths are made relative; the file that was there stays as the backup.

    Only the field's text changes, so all else of a line stays as it was written.
    """
    own = F.get_json_object("value", f"$.{field}")
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    rewrite_lines(spark, path, out, F.replace(F.col("value"), quoted(own), quoted(relative_path(own, root))), own.isNotNull())


def write_by_status(df: DataFrame, path: str, status: str = "status") -> None:
    """A run's products in a folder for each status."""
    df.write.mode("overwrite").partitionBy(status).json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_vectors(df: DataFrame, path: str, size: int, vector: str = "embedding") -> None:
    """Append vectors next to their keys; one of another length stops the write."""
    checked(df, size, vector).write.mode("append").parquet(path)


def write_index(index: DataFrame, path: str) -> None:
    """The viewer's index: one JSON object for each group, a line each."""
    index.write.mode("overwrite").json(path)


def write_page(index: DataFrame, template: str, path: str, mark: str = "/*INDEX*/") -> None:
    """A viewer's page that stands by itself: ``window.__IMGS__ =`` and the whole index in the place of a mark, as one text file.

    A page is one file, so one task writes it: it is for an index that a browser
    can hold.  ``</`` is broken up, so no text can end the script.
    """
    whole = index.select(F.to_json(F.struct("*")).alias("j")).agg(F.array_sort(F.collect_list("j")).alias("js"))
    data = F.replace(F.concat(F.lit("window.__IMGS__ = ["), F.concat_ws(",", "js"), F.lit("];")), F.lit("</"), F.lit("<\\/"))
    before, _, after = template.partition(mark)
    whole.select(F.concat(F.lit(before), data, F.lit(after)).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)

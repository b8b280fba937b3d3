"""The manifest: projections into it, merges by content hash, appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import blob_path
from .ranking import first_of


def _element(name: str, part):
    return lambda x, i: part(name, x, F.lit(None), i)


def _entry(name: str, part):
    return lambda e: part(name, e["key"], e["value"], F.lit(0))


def merge(rows: DataFrame, key: str, seq: str, arrays: Sequence[str] = (), maps: Sequence[str] = ()) -> DataFrame:
    """One row for each key: scalars of the first row in ``seq``, arrays as ordered unions, maps with the first of each key.

    Elements and entries are first reduced to the distinct ones of each key,
    with map-side combining, so a key that holds a large share of all rows
    gathers no more than its distinct elements.  A null array is an empty one.
    """
    scalars = [c for c in rows.columns if c not in (key, *arrays, *maps)]
    merged = rows.groupBy(key).agg(F.min_by(F.struct(*scalars), F.col(seq)).alias("_first"))
    if arrays or maps:
        part = lambda n, k, v, i: F.struct(F.lit(n).alias("n"), k.cast("string").alias("k"), v.cast("string").alias("v"), i.cast("int").alias("i"))
        none = F.array().cast("array<struct<n:string,k:string,v:string,i:int>>")
        lists = [F.coalesce(F.transform(a, _element(a, part)), none) for a in arrays]
        lists += [F.coalesce(F.transform(F.map_entries(m), _entry(m, part)), none) for m in maps]
        items = rows.select(key, F.col(seq).alias("_s"), F.explode(F.concat(*lists)).alias("e")).select(key, "_s", "e.*")
        at = F.struct("_s", "i")
        items = items.groupBy(key, "n", "k").agg(F.min(at).alias("at"), F.min_by("v", at).alias("v"))
        gathered = [F.array_sort(F.collect_list(F.when(F.col("n") == c, F.struct("at", "k", "v")))).alias(f"_{c}") for c in (*arrays, *maps)]
        items = items.groupBy(F.col(key).alias("_key")).agg(*gathered)
        merged = merged.join(items, merged[key].eqNullSafe(items["_key"]), "left")
    kind = {f.name: f.dataType for f in rows.schema}
    made = {a: F.coalesce(F.transform(f"_{a}", lambda x: x["k"]), F.array().cast("array<string>")).cast(kind[a]) for a in arrays}
    pairs = lambda c: F.coalesce(F.transform(f"_{c}", lambda x: F.struct(x["k"], x["v"])), F.array().cast("array<struct<k:string,v:string>>"))
    made |= {m: F.map_from_entries(pairs(m)).cast(kind[m]) for m in maps}
    return merged.select(*(made[c].alias(c) if c in made else F.col(key) if c == key else F.col(f"_first.{c}") for c in rows.columns))


def fill_nulls(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str], blank: Sequence[str] = ()) -> DataFrame:
    """``old`` with null fields (for ``blank`` ones, empty too) taken from ``new``, which has one row a key."""
    other = new.select(F.col(key), *(F.col(f).alias(f"_new_{f}") for f in fields))
    own = lambda f: F.nullif(F.col(f), F.lit("")) if f in blank else F.col(f)
    out = old.join(other, key, "left").withColumns({f: F.coalesce(own(f), F.col(f"_new_{f}")) for f in fields})
    return out.select(*old.columns)


def update_columns(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``old`` with fields replaced by the new ones where those aren't null."""
    other = new.select(F.col(key), *(F.col(f).alias(f"_new_{f}") for f in fields))
    return old.join(other, key, "left").select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in old.columns))


def unseen(new: DataFrame, old: DataFrame, key: str, order: Sequence | None = None) -> DataFrame:
    """The new rows whose key is not among the old ones; with ``order`` only the first of each key."""
    rows = new.join(old.select(key), key, "left_anti")
    return first_of(rows, [key], order) if order else rows


def pending(rows: DataFrame, log: DataFrame, key: str, only_ok: bool = True) -> DataFrame:
    """Rows that a log has not done; with ``only_ok`` a failed try doesn't count as done."""
    return rows.join((log.where("ok") if only_ok else log).select(key), key, "left_anti")


def row_of_candidate(c: DataFrame) -> DataFrame:
    """Fetched candidates as manifest rows."""
    ext = F.ltrim(F.regexp_extract(F.coalesce("local_path", F.lit("")), r"\.([A-Za-z0-9]+)$", 1), F.lit("."))
    one = lambda v: F.when(F.col("instance").isNotNull() & F.col(v).isNotNull(), F.create_map("instance", v))
    return c.select(
        "sha256", ext.alias("ext"), "source", "source_kind", "source_authorized", F.col("license_raw").alias("license"), "author", "credit",
        F.col("actual_width").alias("width"), F.col("actual_height").alias("height"), F.coalesce("orig_width", "declared_width").alias("orig_width"), "orig_height",
        F.col("actual_size").alias("size_bytes"), F.col("actual_mime").alias("mime"), F.array_compact(F.array("instance")).alias("instances"), F.array_compact(F.array("tier")).alias("tiers"),
        "source_rank", "source_score", one("query").alias("queries"), one("query_lang").alias("query_langs"), one("asset_id").alias("asset_ids"),
        "landing_url", "content_url", "fetched_at", blob_path("sha256", ext).alias("path"),
    )


def candidate_of_row(m: DataFrame) -> DataFrame:
    """Manifest rows as candidates, one for each instance."""
    one = m.withColumn("instance", F.explode_outer("instances"))
    return one.select(
        "source", "source_kind", F.col("asset_ids")[F.col("instance")].alias("asset_id"), "instance", F.col("queries")[F.col("instance")].alias("query"), F.col("query_langs")[F.col("instance")].alias("query_lang"),
        "landing_url", "content_url", F.col("license").alias("license_raw"), "author", "credit", "source_authorized", "orig_width", "orig_height", "source_rank", "source_score", "fetched_at", "sha256",
        F.col("path").alias("local_path"), F.col("mime").alias("actual_mime"), F.col("width").alias("actual_width"), F.col("height").alias("actual_height"), F.col("size_bytes").alias("actual_size"), F.lit("reused").alias("status"),
    )


def row_of_item(i: DataFrame) -> DataFrame:
    """Items of the operator chain as manifest rows; scores that no model gave stay null."""
    return i.select(
        "sha256", "ext", "source", "license", "author", F.col("actual_width").alias("width"), F.col("actual_height").alias("height"), "size_bytes", "mime",
        F.array_compact(F.array("instance")).alias("instances"), F.col("rank").cast("bigint").alias("source_rank"), F.when(F.col("instance").isNotNull() & F.col("query").isNotNull(), F.create_map("instance", "query")).alias("queries"),
        "landing_url", "content_url", "fetched_at", blob_path("sha256", "ext").alias("path"), "kb_match", "richness", "caption", "identity",
    )


def backfill(manifest: DataFrame, by_hash: DataFrame, by_url: DataFrame, fields: Sequence[str], key: str = "sha256", url: str = "content_url") -> DataFrame:
    """``manifest`` with null fields from the row of the same hash, and only without one from that of the same URL."""
    pack = lambda d, k, n: d.select(F.col(k), F.struct(*fields).alias(n))
    out = manifest.join(pack(by_hash, key, "_h"), key, "left").join(pack(by_url, url, "_u"), url, "left").withColumn("_x", F.coalesce("_h", "_u"))
    return out.select(*(F.coalesce(c, f"_x.{c}").alias(c) if c in fields else F.col(c) for c in manifest.columns))


def instance_counts(manifest: DataFrame, distinct: bool = False) -> DataFrame:
    """``(instance, have)``: images of each instance, by rows or by distinct hash."""
    rows = manifest.select("sha256", F.explode("instances").alias("instance"))
    return rows.groupBy("instance").agg((F.countDistinct("sha256") if distinct else F.count("*")).alias("have"))

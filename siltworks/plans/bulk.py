"""Bulk selection from a metadata dump of posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.gates import ordered_reason, post_gates
from ..operators.ranking import first_of, top_n


def words(tags: str) -> Column:
    return F.filter(F.split(F.coalesce(tags, F.lit("")), " "), lambda t: t != "")


def tag_index(entities: DataFrame) -> DataFrame:
    """``(tag, instance)`` for every name, query and alias of an entity that can be a tag."""
    terms = F.concat(F.array("name"), F.coalesce("query", F.array().cast("array<string>")), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = entities.select(F.explode(F.transform(terms, text.tag_name)).alias("tag"), F.col("name").alias("instance"))
    return rows.where(text.is_tag("tag")).distinct()


def matched(posts: DataFrame, index: DataFrame, key: str = "id", tags: str = "tag_string") -> DataFrame:
    """Posts with each instance that a tag of theirs names; of several such tags the least."""
    one = posts.select(key, F.explode(F.array_distinct(words(tags))).alias("tag")).join(index, "tag").groupBy(key, "instance").agg(F.min("tag").alias("matched_tag"))
    return posts.join(one, key)


def by_instance(posts: DataFrame, index: DataFrame, k: int, **gates) -> DataFrame:
    """The best ``k`` posts of each instance past the value gates; then, of each pixel hash (md5, where there is none), the best row of all instances.

    Rows with neither hash all stay.  Groups are not refilled after that.  Of
    rows with one score and post the least instance comes first.
    """
    good = posts.where(ordered_reason(post_gates(**gates)).isNull())
    best = top_n(matched(good, index), ["instance"], [F.coalesce("score", F.lit(0)).desc(), F.col("id")], k)
    own = F.concat_ws(":", F.lit("row"), F.col("id").cast("string"), "instance")
    best = best.withColumn("_pixels", F.coalesce(F.nullif("media_asset.pixel_hash", F.lit("")), F.nullif("md5", F.lit("")), own))
    return first_of(best, ["_pixels"], [F.coalesce("score", F.lit(0)).desc(), F.col("id"), F.col("instance")]).drop("_pixels")


def representatives(posts: DataFrame, vocabulary: DataFrame, min_score: int = 10, min_side: int = 768, **gates) -> DataFrame:
    """For each character the post of the highest score (then least id), if that is ``min_score`` or more.

    A post's character is its first tag in the vocabulary (tag).  The score is
    no gate before that.
    """
    good = posts.where(ordered_reason(post_gates(min_score=None, min_side=min_side, **gates)).isNull())
    each = good.select("id", F.coalesce("score", F.lit(0)).alias("score"), F.posexplode(words("tag_string_character")).alias("at", "character"))
    first = first_of(each.join(vocabulary.select(F.col("tag").alias("character")), "character", "left_semi"), ["id"], ["at"])
    return first_of(first.drop("at"), ["character"], [F.col("score").desc(), F.col("id")]).where(F.col("score") >= min_score)


def band(score: Column) -> Column:
    return F.when(score >= 100, ">=100").when(score >= 30, "30-99").when(score >= 10, "10-29").when(score >= 1, "1-9").otherwise("<=0")


def bands(rows: DataFrame, score: str = "score") -> DataFrame:
    return rows.groupBy(band(F.col(score)).alias("band")).agg(F.count("*").alias("n"))


def per_content(selected: DataFrame, key: str = "md5") -> DataFrame:
    """``(key, instances)``: all instances of one content, sorted."""
    return selected.groupBy(key).agg(F.array_sort(F.collect_set("instance")).alias("instances"))


def still_wanted(dump: DataFrame, wanted: DataFrame, have: DataFrame, key: str = "id") -> DataFrame:
    """The dump's rows that are wanted and not there yet."""
    return dump.join(wanted.join(have, key, "left_anti").select(key), key, "left_semi")

"""Concepts from vectors: centroids, representatives, nearest entities, alignment.

Clusters come in as labels; :func:`clusters` offers seeded k-means where there are none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators.ranking import renumbered, top_n


def centroids(vectors: DataFrame, by: str = "label", vector: str = "embedding") -> DataFrame:
    """``(by, size, centroid)``: mean vectors, summed place by place with map-side combining."""
    rows = vectors.select(by, F.posexplode(vector).alias("i", "x"))
    means = rows.groupBy(by, "i").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return means.groupBy(by).agg(F.max("n").alias("size"), F.transform(ordered, lambda x: x["m"]).alias("centroid"))


def nearest_members(vectors: DataFrame, n: int, by: str = "label", vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The ``n`` members of each cluster that are nearest to its centroid.  Centroids are one small row a cluster."""
    rows = vectors.join(centroids(vectors, by, vector), by).withColumn("distance", values.square_distance(vector, "centroid"))
    return top_n(rows.select(by, key, "distance"), [by], ["distance", key], n, "rank").withColumn("distance", F.round("distance", 6))


def nearest_entities(queries: DataFrame, entities: DataFrame, k: int, query_key: str, entity_key: str, vector: str = "embedding", blocks: int = 64) -> DataFrame:
    """For each query vector the ``k`` entities of the highest cosine.

    Every query is held against all entities, in blocks: queries are sent to
    each block of entities, which gives its own best ``k``; then the blocks'
    best are ranked.  Neither side need fit in memory.
    """
    length = F.sqrt(values.dot(vector, vector))  # once a vector, not once a pair
    q = queries.select(query_key, F.col(vector).alias("_q"), length.alias("_ql")).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    e = entities.select(entity_key, F.col(vector).alias("_e"), length.alias("_el")).withColumn("_b", F.pmod(F.xxhash64(entity_key), F.lit(blocks)).cast("int"))
    rows = q.join(e, "_b").select("_b", query_key, entity_key, (values.dot("_q", "_e") / (F.col("_ql") * F.col("_el") + 1e-9)).alias("similarity"))
    order = [F.col("similarity").desc(), F.col(entity_key)]
    best = top_n(top_n(rows, ["_b", query_key], order, k).drop("_b"), [query_key], order, k, "rank")
    return best.withColumn("similarity", F.round("similarity", 6))


def named_entities(concepts: DataFrame, entities: DataFrame) -> DataFrame:
    """Concepts with the least entity whose normal name or alias is the same."""
    terms = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    index = entities.select(F.explode(terms).alias("t"), "name").select(text.concept_name("t").alias("k"), "name").groupBy("k").agg(F.min("name").alias("matched_instance"))
    return concepts.withColumn("k", text.concept_name("concept")).join(index, "k", "left").drop("k")


def alignment(rows: DataFrame, pool: str = "pool", verdict: str = "verdict", size: str = "size", existing: str = "existing") -> DataFrame:
    """``(pool, clusters, images, align_rate)``: the share of images in clusters that match a known entity."""
    known = F.sum(F.when(F.col(verdict) == existing, F.col(size)).otherwise(0))
    return rows.groupBy(pool).agg(F.count("*").alias("clusters"), F.sum(size).alias("images"), F.round(known / F.greatest(F.sum(size), F.lit(1)), 3).alias("align_rate"))


def by_verdict(rows: DataFrame, pool: str = "pool", verdict: str = "verdict", size: str = "size") -> DataFrame:
    return rows.groupBy(pool, verdict).agg(F.count("*").alias("clusters"), F.sum(size).alias("images"))


def noise(rows: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """One row: members, clusters, and the share of members in none (-1)."""
    out = F.col(cluster) < 0
    return rows.agg(F.count("*").alias("members"), F.countDistinct(F.when(~out, F.col(cluster))).alias("clusters"), F.round(F.avg(out.cast("double")), 3).alias("noise_share"))


def query_counts(members: DataFrame, manifest: DataFrame, by: list[str], n: int) -> DataFrame:
    """The ``n`` commonest queries of the members' images in each group."""
    rows = members.join(manifest.select("sha256", F.explode("queries").alias("instance", "query")), "sha256")
    return top_n(rows.groupBy(*by, "query").agg(F.count("*").alias("n")), by, [F.col("n").desc(), F.col("query")], n, "rank")


def missing_vectors(rows: DataFrame, vectors: DataFrame, key: str = "sha256") -> DataFrame:
    return rows.join(vectors.select(key), key, "left_anti")


def checked(vectors: DataFrame, size: int, vector: str = "embedding") -> DataFrame:
    """The same rows; one of another length stops the query."""
    return vectors.withColumn(vector, F.when(F.assert_true(F.size(vector) == size, F.lit("vector of another length")).isNull(), F.col(vector)))


def clusters(vectors: DataFrame, k: int, vector: str = "embedding", seed: int = 0) -> DataFrame:
    """``cluster_id`` by seeded k-means; not the density clustering of the usual tools, which has no fixed result."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.withColumn("_v", array_to_vector(vector))
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster_id").fit(rows).transform(rows).drop("_v")


def concepts(vectors: DataFrame, entities: DataFrame, least: float, by: str = "cluster_id", name: str = "name", vector: str = "embedding") -> DataFrame:
    """The whole of emergence behind the clustering: ``(cluster_id, size, rank, nearest, similarity, verdict)`` of each cluster.

    Clusters (other than noise, below 0) are numbered by size; a centroid's
    nearest entity by cosine makes it ``existing``, if that is at least
    ``least``, else it is ``new``.
    """
    own = centroids(vectors.where(F.col(by) >= 0), by, vector)
    near = nearest_entities(own.select(by, F.col("centroid").alias(vector)), entities, 1, by, name, vector).select(by, F.col(name).alias("nearest"), "similarity")
    rows = own.select(by, "size").join(near, by, "left")
    verdict = F.when(F.col("similarity") >= least, "existing").otherwise("new")
    return renumbered(rows, [], key=by).withColumn("verdict", verdict)

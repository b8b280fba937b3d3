"""All named queries over the standard tables, with the SQL that checks each.

The lake's own tables don't come with the standard ones, so each query sets a
standard table in the place of one of them: customers are entities and their
orders images, event types are source counters, pages are search results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls, values
from ..operators import gates, manifest, ranking
from ..sources import spec
from . import bulk, collect, coverage, emerge, health, probes, reports, tree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(c) -> F.Column:
    return F.concat_ws("|", c)


# --- coverage -----------------------------------------------------------------


def _entities(s, d) -> DataFrame:
    return read(s, d, "customer").select(F.col("c_custkey").alias("name"), F.col("c_mktsegment").alias("cluster"))


def _have(s, d) -> DataFrame:
    return read(s, d, "orders").groupBy(F.col("o_custkey").alias("name")).agg(F.count("*").alias("have"))


_GAPS = """
    SELECT c_custkey AS name, c_mktsegment AS cluster, coalesce(have, 0) AS have
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS have FROM orders GROUP BY 1) ON o_custkey = c_custkey"""


@query(f"""SELECT cluster, count(*) AS gap_instances, CAST(sum(12 - have) AS BIGINT) AS total_need
FROM ({_GAPS}) WHERE have < 12 GROUP BY 1""")
def gap_report(s, d):
    return coverage.gap_report(_entities(s, d), _have(s, d), 12)


@query(f"""SELECT count(*) AS total_instances, count(*) FILTER (have >= 12) AS achieved, count(*) FILTER (have < 12) AS gap_instances,
CAST(sum(greatest(0, 12 - have)) AS BIGINT) AS total_need FROM ({_GAPS})""")
def gap_totals(s, d):
    return coverage.gap_totals(_entities(s, d), _have(s, d), 12)


@query(f"""SELECT name, cluster, have, need, CAST(rank AS INTEGER) AS rank FROM (
SELECT name, cluster, have, 12 - have AS need, row_number() OVER (PARTITION BY cluster ORDER BY have, name) AS rank FROM ({_GAPS}) WHERE have < 12) WHERE rank <= 5""")
def gap_top_starved(s, d):
    return coverage.most_starved(_entities(s, d), _have(s, d), 12, 5)


def _classify(mode: str) -> tuple[Query, str]:
    def run(s, d):
        jobs = read(s, d, "customer").select(F.concat(F.lit("root / n"), F.col("c_nationkey"), F.lit(" / c"), F.col("c_custkey") % 1000).alias("instance")).distinct()
        moved = F.when(F.col("o_custkey") % 3 == 0, "old").otherwise("root")
        names = read(s, d, "orders").join(read(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        counts = names.groupBy(F.concat(moved, F.lit(" / n"), F.col("c_nationkey"), F.lit(" / c"), F.col("c_custkey") % 1000).alias("instance")).agg(F.count("*").alias("have"))
        return coverage.classify(jobs, counts, mode, 10).select("instance", "status", "existing")

    state = """
    WITH j AS (SELECT DISTINCT 'root / n' || c_nationkey || ' / c' || (c_custkey % 1000) AS instance FROM customer),
    s AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 'old' ELSE 'root' END || ' / n' || c_nationkey || ' / c' || (c_custkey % 1000) AS instance, count(*) AS have
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
    f AS (SELECT split_part(instance, ' / ', 2) AS a, split_part(instance, ' / ', 3) AS b, CAST(sum(have) AS BIGINT) AS have FROM s GROUP BY 1, 2),
    x AS (SELECT j.instance, coalesce(s.have, 0) AS e, coalesce(f.have, 0) AS z FROM j LEFT JOIN s USING (instance)
          LEFT JOIN f ON f.a = split_part(j.instance, ' / ', 2) AND f.b = split_part(j.instance, ' / ', 3))"""
    cases = {
        "delta": "CASE WHEN e > 0 THEN 'skip_exact' WHEN z > 0 THEN 'skip_delta_fuzzy' ELSE 'new' END",
        "replay": "CASE WHEN e >= 10 THEN 'skip_exact' WHEN e > 0 THEN 'topup' ELSE 'new' END",
        "replay-rules": "CASE WHEN e >= 10 THEN 'skip_exact' WHEN e > 0 THEN 'topup' WHEN z >= 10 THEN 'skip_fuzzy' WHEN z > 0 THEN 'topup' ELSE 'new' END",
    }
    return run, f"{state} SELECT instance, status, CASE WHEN status = 'topup' THEN CASE WHEN e > 0 THEN e ELSE z END ELSE 0 END AS existing FROM (SELECT *, {cases[mode]} AS status FROM x)"


for _mode in ("delta", "replay", "replay-rules"):
    _name = f"incremental_{_mode.replace('-', '_')}"
    QUERIES[_name], ORACLES[_name] = _classify(_mode)


@query("""SELECT lang, source, doc_id FROM (VALUES ('en', 'a'), ('en', 'b'), ('fr', 'c')) r(lang, source) JOIN (SELECT doc_id, lang FROM documents) USING (lang)""")
def seed_route(s, d):
    table = s.createDataFrame([("en", "a"), ("en", "b"), ("fr", "c")], "lang string, source string")
    return coverage.route(read(s, d, "documents").select("doc_id", "lang"), table).select("lang", "source", "doc_id")


@query("""WITH c AS (SELECT l_orderkey AS instance, l_suppkey % 7 AS source, l_partkey AS content_url, l_linenumber AS rank, l_linenumber % 4 AS attempts FROM lineitem),
r AS (SELECT c.*, row_number() OVER (PARTITION BY instance, source ORDER BY rank, content_url) AS k FROM c
 WHERE content_url NOT IN (SELECT p_partkey FROM part WHERE p_size < 10) AND source <> 3
   AND instance IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) < 4) AND attempts < 3)
SELECT instance, source, content_url, rank FROM r WHERE k <= 2""")
def starved_second_pass(s, d):
    lines = read(s, d, "lineitem")
    c = lines.select(F.col("l_orderkey").alias("instance"), (F.col("l_suppkey") % 7).alias("source"), F.col("l_partkey").alias("content_url"), F.col("l_linenumber").alias("source_rank"), (F.col("l_linenumber") % 4).alias("attempts"))
    counts = lines.groupBy(F.col("l_orderkey").alias("instance")).agg(F.count("*").alias("have"))
    used = read(s, d, "part").where("p_size < 10").select(F.col("p_partkey").alias("content_url"))
    weak = s.range(1).select(F.lit(3).cast("bigint").alias("source"))
    return coverage.second_pass(c, used, counts, weak, 4, 2).select("instance", "source", "content_url", F.col("source_rank").alias("rank"))


# --- selection and gates ------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity >= 30 AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_returnflag IN ('R', 'A')
ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber LIMIT 50""")
def select_where_topk(s, d):
    rows = read(s, d, "lineitem").where("l_shipdate >= TIMESTAMP_NTZ '1997-01-01'").withColumnsRenamed({"l_returnflag": "source", "l_quantity": "width"})
    rows = gates.select_where(rows, min_width=30, sources=["R", "A"])
    return rows.orderBy(F.col("l_extendedprice").desc_nulls_last(), "l_orderkey", "l_linenumber").limit(50).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT count(*) AS n FROM lineitem WHERE l_discount > 0.05 AND l_quantity < 24")
def select_count(s, d):
    return gates.select_where(read(s, d, "lineitem"), where="l_discount > 0.05 AND l_quantity < 24").agg(F.count("*").alias("n"))


_CANDIDATES = """
    SELECT page_id, CASE page_id % 7 WHEN 0 THEN '' WHEN 1 THEN replace(url, 'https:', 'http:') ELSE replace(url, 'http:', 'https:') END AS u,
           CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'image/svg+xml' ELSE 'image/png' END AS mime,
           CASE page_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 20000000 ELSE length(html) END AS size,
           CASE page_id % 4 WHEN 0 THEN 'CC-BY-SA 4.0' WHEN 1 THEN 'All rights reserved' WHEN 2 THEN NULL ELSE 'Public-Domain' END AS lic
    FROM pages"""


def _candidates(s, d) -> DataFrame:
    k = F.col("page_id")
    return read(s, d, "pages").select(
        "page_id",
        F.when(k % 7 == 0, "").when(k % 7 == 1, F.replace(F.col("url"), F.lit("https:"), F.lit("http:"))).otherwise(F.replace(F.col("url"), F.lit("http:"), F.lit("https:"))).alias("u"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "image/svg+xml").otherwise("image/png").alias("mime"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 11 == 1, 20000000).otherwise(F.length("html")).alias("size"),
        F.when(k % 4 == 0, "CC-BY-SA 4.0").when(k % 4 == 1, "All rights reserved").when(k % 4 == 3, "Public-Domain").alias("lic"),
    )


_GATE = "WHEN coalesce(u, '') = '' THEN 'no_url' WHEN u NOT LIKE 'https:%' THEN 'not_https'"


@query(f"""SELECT page_id, CASE {_GATE}
WHEN NOT (regexp_extract(u, 'https://([^/?#]*)', 1) = 'example.com' OR regexp_extract(u, 'https://([^/?#]*)', 1) LIKE '%.example.com' OR regexp_extract(u, 'https://([^/?#]*)', 1) LIKE '%.org') THEN 'host_not_allowed'
WHEN mime IS NULL THEN 'no_mime' WHEN mime NOT IN ('image/png', 'image/jpeg') THEN 'mime_not_allowed' WHEN size > 10485760 THEN 'too_large'
WHEN lic IS NULL THEN 'no_license' WHEN NOT (contains(replace(lower(lic), '-', ' '), 'cc by') OR contains(replace(lower(lic), '-', ' '), 'public domain') OR contains(replace(lower(lic), '-', ' '), 'cc0')) THEN 'license_not_allowed' END AS reason FROM ({_CANDIDATES})""")
def gate_authorized(s, d):
    c = _candidates(s, d)
    return c.select("page_id", gates.authorized_reason(c["u"], c["mime"], c["size"], c["lic"], ["example.com", "org"]).alias("reason"))


@query(f"SELECT page_id, CASE {_GATE} WHEN mime IS NOT NULL AND mime <> 'image/png' THEN 'mime_not_allowed' WHEN size > 10485760 THEN 'too_large' END AS reason FROM ({_CANDIDATES})")
def gate_unauthorized(s, d):
    c = _candidates(s, d)
    return c.select("page_id", gates.unauthorized_reason(c["u"], c["mime"], c["size"]).alias("reason"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT coalesce(CASE {_GATE} WHEN mime IS NOT NULL AND mime <> 'image/png' THEN 'mime_not_allowed' WHEN size > 10485760 THEN 'too_large' END, 'accepted') AS reason FROM ({_CANDIDATES})) GROUP BY 1")
def gate_funnel(s, d):
    c = _candidates(s, d)
    return gates.funnel(c, gates.unauthorized_reason(c["u"], c["mime"], c["size"]))


@query("SELECT p_partkey, CASE WHEN coalesce(p_size, 0) < 20 OR coalesce(p_retailprice, 0) < 1200 THEN 'gate_rejected' ELSE 'ok' END AS status, least(p_size, p_retailprice) < 10 AS auto_keep FROM part")
def resolution_gate(s, d):
    size, price = F.col("p_size"), F.col("p_retailprice")
    return read(s, d, "part").select("p_partkey", gates.resolution_status(size, price, 20, 1200).alias("status"), gates.auto_keep(size.cast("double"), price, 10).alias("auto_keep"))


@query("""SELECT p_partkey, CASE WHEN p_brand <> 'Brand#1' AND p_brand <> 'Brand#2' AND p_size % 3 = 0 THEN 'mime' WHEN abs(p_retailprice * 5000 - p_size * 100000) > greatest(p_size * 50000.0, 1048576) THEN 'size' END AS mismatch FROM part""")
def declared_mismatch(s, d):
    other = (F.col("p_brand") != "Brand#1") & (F.col("p_brand") != "Brand#2") & (F.col("p_size") % 3 == 0)
    return read(s, d, "part").select("p_partkey", gates.declared_mismatch(F.lit("a"), F.when(other, "b").otherwise("a"), F.col("p_size") * 100000, F.col("p_retailprice") * 5000).alias("mismatch"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'rating' WHEN user_id % 10 = 0 THEN 'deleted' WHEN event_id % 9 = 0 OR event_id % 8 = 0 THEN 'flagged'
WHEN coalesce(value, 0) < 20 THEN 'score' WHEN event_type = 'view' THEN 'format' ELSE 'accepted' END AS reason FROM events) GROUP BY 1""")
def value_gate_funnel(s, d):
    rows = read(s, d, "events")
    steps = [
        ("rating", F.col("event_type") == "error"),
        ("deleted", F.col("user_id") % 10 == 0),
        ("flagged", (F.col("event_id") % 9 == 0) | (F.col("event_id") % 8 == 0)),
        ("score", F.coalesce("value", F.lit(0.0)) < 20),
        ("format", F.col("event_type") == "view"),
    ]
    return gates.funnel(rows, gates.ordered_reason(steps))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view') AND (contains(props, '1') OR contains(props, '2')) GROUP BY 1")
def instance_filter(s, d):
    rows = read(s, d, "events")
    keep = gates.instance_filter(F.col("event_type"), None, ["click", "view"]) & gates.instance_filter(F.col("props"), ["1", "2"])
    return rows.where(keep).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN quality <= 0 THEN 'anom' ELSE 'ctrl' END AS pool FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS k FROM labels) WHERE quality = 0 OR k <= 100""")
def pool_assign(s, d):
    rows = read(s, d, "labels").select("doc_id", (F.col("quality") * 7).alias("kb"), F.lit("x").alias("caption"))
    return gates.pools(rows, 100, "doc_id", "kb").select("doc_id", "pool")


# --- content, manifest --------------------------------------------------------


@query("SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, count(*) AS copies FROM documents GROUP BY 1")
def dedup_by_hash(s, d):
    return read(s, d, "documents").groupBy(values.content_hash("text").alias("sha256")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))


@query("""WITH r AS (SELECT sha256(text) AS sha256, doc_id AS seq, lang, source FROM documents),
u AS (SELECT sha256, source, min(seq) AS pos FROM r GROUP BY 1, 2),
m AS (SELECT sha256, source, lang, min(seq) AS pos FROM r GROUP BY 1, 2, 3),
f AS (SELECT sha256, source, arg_min(lang, pos) AS lang FROM m GROUP BY 1, 2)
SELECT r.sha256, min(seq) AS seq, arg_min(lang, seq) AS lang,
 (SELECT string_agg(source, '|' ORDER BY pos) FROM u WHERE u.sha256 = r.sha256) AS instances,
 (SELECT string_agg(source || '=' || lang, '|' ORDER BY source || '=' || lang) FROM f WHERE f.sha256 = r.sha256) AS queries
FROM r GROUP BY 1""")
def manifest_merge(s, d):
    rows = read(s, d, "documents").select(values.content_hash("text").alias("sha256"), F.col("doc_id").alias("seq"), "lang", F.array("source").alias("instances"), F.create_map("source", "lang").alias("queries"))
    out = manifest.merge(rows, "sha256", "seq", ["instances"], ["queries"])
    entries = F.array_sort(F.transform(F.map_entries("queries"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return out.select("sha256", "seq", "lang", joined("instances").alias("instances"), joined(entries).alias("queries"))


@query("SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 2 = 0 THEN d.source END, 'q' || l.quality) AS source, coalesce(nullif(CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE d.lang END, ''), 't' || l.toxic) AS lang FROM documents d LEFT JOIN labels l USING (doc_id)")
def manifest_fill_nulls(s, d):
    old = read(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("lang"))
    new = read(s, d, "labels").select("doc_id", F.concat(F.lit("q"), "quality").alias("source"), F.concat(F.lit("t"), "toxic").alias("lang"))
    return manifest.fill_nulls(old, new, "doc_id", ["source", "lang"], ["lang"])


@query("SELECT doc_id, coalesce(l.quality, 5) AS kb_match, l.toxic AS richness FROM documents d LEFT JOIN labels l USING (doc_id)")
def annotation_update(s, d):
    old = read(s, d, "documents").select("doc_id", F.lit(5).alias("kb_match"), F.lit(None).cast("int").alias("richness"))
    new = read(s, d, "labels").select("doc_id", F.col("quality").alias("kb_match"), F.col("toxic").alias("richness"))
    return manifest.update_columns(old, new, "doc_id", ["kb_match", "richness"])


@query("""SELECT min(doc_id) AS doc_id, sha256(text) AS sha256 FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src1') GROUP BY 2""")
def sink_skip_existing(s, d):
    rows = read(s, d, "documents").select("doc_id", values.content_hash("text").alias("sha256"), "source")
    return manifest.unseen(rows, rows.where("source = 'src1'"), "sha256", ["doc_id"]).select("doc_id", "sha256")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def pending_ok_only(s, d):
    log = read(s, d, "labels").select("doc_id", (F.col("quality") == 1).alias("ok"))
    return manifest.pending(read(s, d, "documents"), log, "doc_id").select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_any_logged(s, d):
    log = read(s, d, "labels").select("doc_id", (F.col("quality") == 1).alias("ok"))
    return manifest.pending(read(s, d, "documents"), log, "doc_id", only_ok=False).select("doc_id")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'h' || l.quality ELSE u.mark END AS mark FROM documents d LEFT JOIN labels l USING (doc_id)
LEFT JOIN (SELECT source, 'u' || max(lang) AS mark FROM documents GROUP BY 1) u ON u.source = d.source""")
def provenance_backfill(s, d):
    docs = read(s, d, "documents")
    base = docs.select("doc_id", "source", F.lit(None).cast("string").alias("mark"))
    by_hash = read(s, d, "labels").select("doc_id", F.concat(F.lit("h"), "quality").alias("mark"))
    by_url = docs.groupBy("source").agg(F.concat(F.lit("u"), F.max("lang")).alias("mark"))
    return manifest.backfill(base, by_hash, by_url, ["mark"], "doc_id", "source").select("doc_id", "mark")


@query("SELECT source AS instance, count(DISTINCT sha256(text)) AS have FROM documents GROUP BY 1")
def instance_counts(s, d):
    rows = read(s, d, "documents").select(values.content_hash("text").alias("sha256"), F.array("source").alias("instances"))
    return manifest.instance_counts(rows, distinct=True)


@query("SELECT doc_id, 'blobs/' || left(sha256(text), 2) || '/' || sha256(text) || '.' || lang AS path FROM documents")
def blob_paths(s, d):
    return read(s, d, "documents").select("doc_id", values.blob_path(values.content_hash("text"), F.col("lang")).alias("path"))


# --- ranks and windows --------------------------------------------------------


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY n_chars, doc_id) AS k FROM documents) WHERE k <= 2")
def cap_per_group(s, d):
    return ranking.cap_per_source(read(s, d, "documents"), 2, "lang", "source", "n_chars", "doc_id").select("doc_id", "lang", "source")


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem),
u AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS j FROM t WHERE k <= 20)
SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM u WHERE j = 1""")
def topk_per_group_dedup(s, d):
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    best = ranking.top_n(read(s, d, "lineitem"), ["l_suppkey"], order, 20)
    return ranking.first_of(best, ["l_suppkey", "l_partkey"], order).select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def representative_per_key(s, d):
    return ranking.first_of(read(s, d, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT band, count(*) AS n FROM (SELECT CASE WHEN p >= 300 THEN '>=100' WHEN p >= 200 THEN '30-99' ELSE '10-29' END AS band FROM (SELECT floor(max(o_totalprice) / 1000) AS p FROM orders GROUP BY o_custkey)) GROUP BY 1""")
def representative_bands(s, d):
    best = read(s, d, "orders").groupBy("o_custkey").agg(F.floor(F.max("o_totalprice") / 1000).alias("p"))
    score = F.when(F.col("p") >= 300, 100).when(F.col("p") >= 200, 30).otherwise(10)
    return bulk.bands(best.withColumn("score", score))


@query("""SELECT user_id, event_id FROM (SELECT *, coalesce(sum(event_id % 5) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM events) WHERE b < 20""")
def early_stop(s, d):
    return ranking.early_stop(read(s, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_id") % 5, 20).select("user_id", "event_id")


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN n_chars END, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) AS source_rank FROM documents")
def source_rank(s, d):
    rows = read(s, d, "documents").withColumn("source_rank", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")))
    return ranking.with_rank(rows, ["source"], ["doc_id"]).select("doc_id", "source_rank")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_event_per_key(s, d):
    return ranking.latest(read(s, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (event_type <> 'view') AS lifecycle, arg_max(event_id, (ts, event_id)) FILTER (event_id % 3 = 0) AS version FROM events GROUP BY 1""")
def fieldwise_overlay(s, d):
    rows = read(s, d, "events").select("user_id", "ts", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("lifecycle"), F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("version"))
    return ranking.overlay(rows, "user_id", ["ts", "event_id"], ["lifecycle", "version"])


@query("""SELECT day, n, coalesce(n < 1.02 * last_n, false) AS saturated FROM (SELECT day, n, lag(n) OVER (ORDER BY day) AS last_n FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1))""")
def saturation_point(s, d):
    days = read(s, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return ranking.saturation(days, "day", "n", 1.02)


@query("SELECT label, size, row_number() OVER (ORDER BY size DESC, label) - 1 AS rank FROM (SELECT label, count(*) AS size FROM embeddings GROUP BY 1)")
def cluster_renumber(s, d):
    sizes = read(s, d, "embeddings").groupBy("label").agg(F.count("*").alias("size")).withColumn("pool", F.lit(0))
    return ranking.renumbered(sizes, ["pool"], "size", "label").select("label", "size", F.col("rank").cast("bigint").alias("rank"))


@query("SELECT s_suppkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS k FROM supplier) WHERE k % 4 = 1")
def round_robin_shard(s, d):
    return ranking.round_robin(read(s, d, "supplier"), ["s_suppkey"], 4, 2).select("s_suppkey")


@query()
def stratified_sample(s, d):
    return ranking.stratified(read(s, d, "documents"), "doc_id", "n_chars", [(10, 1000, 0.5), (1000, 5000, 0.35), (5000, 10**9, 0.15)], 200).select("doc_id", "stratum", "n_chars")


@query("""WITH RECURSIVE r AS (SELECT 'n' || c_nationkey AS parent, c_name AS name FROM customer), g AS (SELECT parent, count(*) AS n FROM r GROUP BY 1),
s AS (SELECT parent, n, row_number() OVER (ORDER BY parent) AS k FROM g WHERE n <= 40),
f AS (SELECT parent, k, 0 AS number, n AS held FROM s WHERE k = 1 UNION ALL
SELECT s.parent, s.k, CASE WHEN f.held + s.n > 80 THEN f.number + 1 ELSE f.number END, CASE WHEN f.held + s.n > 80 THEN s.n ELSE f.held + s.n END FROM f JOIN s ON s.k = f.k + 1),
p AS (SELECT parent, row_number() OVER (PARTITION BY parent ORDER BY name) - 1 AS place FROM r)
SELECT coalesce('small-' || f.number, p.parent || '-' || (place // 80)) AS batch, count(*) AS n, count(DISTINCT p.parent) AS parents FROM p LEFT JOIN f USING (parent) GROUP BY 1""")
def audit_batches(s, d):
    rows = read(s, d, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey")).alias("parent"), F.col("c_name").alias("name"))
    return ranking.batches(rows, "parent", "name", 80).groupBy("batch").agg(F.count("*").alias("n"), F.countDistinct("parent").alias("parents"))


@query("SELECT p_partkey, p_size FROM part ORDER BY p_size DESC NULLS LAST, p_retailprice DESC, p_partkey LIMIT 40")
def viewer_topk(s, d):
    rows = read(s, d, "part").select("p_partkey", "p_size", F.col("p_size").alias("kb_match"), F.col("p_retailprice").alias("richness"), F.lit(0).alias("source_rank"), F.array(F.lit(1)).alias("tiers"), F.col("p_partkey").alias("sha256"))
    return rows.orderBy(*ranking.viewer_order(rows)).limit(40).select("p_partkey", "p_size")


# --- URLs, HTML, JSON, names --------------------------------------------------


@query("""SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_replace(url, '^[hH][tT][tT][pP]://', 'https://') AS safe,
lower(regexp_extract(url, '([^.?]*)(\\?[^.]*)?$', 1)) AS ext FROM pages""")
def url_parts(s, d):
    return read(s, d, "pages").select("page_id", urls.host("url").alias("host"), urls.to_https("url").alias("safe"), urls.extension("url").alias("ext"))


@query("""WITH l AS (SELECT page_id, unnest(ls) AS link, generate_subscripts(ls, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"'']+)["'']', 1) AS ls FROM pages)),
f AS (SELECT page_id, link, min(i) AS i FROM l GROUP BY 1, 2)
SELECT p.page_id, coalesce(n, 0) AS n, coalesce(x, '') AS links FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n, string_agg(link, '|' ORDER BY i) AS x FROM f GROUP BY 1) USING (page_id)""")
def html_links(s, d):
    return read(s, d, "pages").select("page_id", urls.links("html").alias("l")).select("page_id", F.size("l").cast("bigint").alias("n"), joined("l").alias("links"))


@query("SELECT page_id, 'https://pic.example.com/' || page_id || '.jpg|https://b.com/1.webp|https://b.com/2.webp' AS images FROM pages")
def html_images(s, d):
    """The pages have no images of their own, so each gets some ahead of its text."""
    page = F.concat(F.lit('<img class="a" data-src="http://pic.example.com/'), F.col("page_id"), F.lit('.jpg" src="/x.png"><img src="https://e.com/icon.png"><source srcset="https://b.com/1.webp 1x, https://b.com/2.webp 2x">'), F.col("html"))
    return read(s, d, "pages").select("page_id", joined(urls.images(page, upgrade=True)).alias("images"))


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) > 0 AS has_text, sha256(trim(regexp_replace(html, '<[^>]+>', '', 'g'), ' ')) AS digest FROM pages")
def strip_html(s, d):
    bare = text.strip_tags("html")
    return read(s, d, "pages").select("page_id", (F.length(F.regexp_replace("html", "<[^>]+>", "")) > 0).alias("has_text"), F.sha2(bare, 256).alias("digest"))


@query("""SELECT event_id, TRY_CAST(coalesce(props->>'$.missing.deep', props->>'$.k') AS BIGINT) AS width, 'user ' || user_id || ' did ' || event_type AS author, 'web' AS license FROM events
WHERE event_type IN ('click', 'view') AND props->>'$.k' IS NOT NULL AND starts_with(props->>'$.k', '1')""")
def json_path_chain(s, d):
    made = F.to_json(F.struct("event_id", "user_id", "event_type", F.from_json("props", "map<string,string>").alias("p")))
    rows = read(s, d, "events").select(made.alias("item"))
    plan = {
        "filters": [{"path": "$.event_type", "in": ["click", "view"]}, {"path": "$.p.k", "exists": True}, {"path": "$.p.k", "startswith": "1"}],
        "fields": {
            "asset_id": {"path": "$.event_id", "transform": "int"},
            "width": {"path": "$.p.missing.deep | $.p.k", "transform": "int"},
            "author": {"template": "user {user_id} did {event_type}"},
            "license": {"const": "web"},
        },
    }
    out = spec.project(rows, plan, "item")
    return out.select(F.col("asset_id").cast("bigint").alias("event_id"), "width", "author", "license")


@query("""SELECT p_partkey, regexp_replace(lower(trim(p_name)), '[\\s-]+', '_', 'g') AS tag, lower(regexp_replace(trim(regexp_replace(p_type, '[_\\-]+', ' ', 'g')), '\\s+', ' ', 'g')) AS plain,
lower(regexp_replace(p_name, '\\s+', '', 'g')) AS concept, regexp_replace(lower(p_brand), '[^a-z0-9]+', '', 'g') AS alnum FROM part""")
def name_forms(s, d):
    return read(s, d, "part").select("p_partkey", text.tag_name("p_name").alias("tag"), text.plain_name("p_type").alias("plain"), text.concept_name("p_name").alias("concept"), text.alnum("p_brand").alias("alnum"))


@query("""SELECT p_partkey, len(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda x: length(x) >= 2)) AS n_tokens, contains(lower(p_name), 'part') AND contains(lower(p_name), '1') AND false = false AND contains(lower(p_name), '11') AS hit FROM part""")
def token_all_match(s, d):
    return read(s, d, "part").select("p_partkey", F.size(text.tokens("p_name")).cast("bigint").alias("n_tokens"), text.all_tokens_in(F.lit("Part 11"), "p_name").alias("hit"))


@query("""SELECT n_nationkey, r_regionkey, contains(a, b) OR contains(b, a) AS same, CASE WHEN a = '' THEN false WHEN contains(a, b) THEN true ELSE NULL END AS answer
FROM (SELECT n_nationkey, r_regionkey, lower(n_name) AS a, lower(r_name) AS b FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def rule_match(s, d):
    rows = read(s, d, "nation").join(read(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", "r_regionkey", text.names_match(F.array("n_name"), F.array(F.lower("r_name"))).alias("same"), text.answer_match("n_name", "r_name").alias("answer"))


@query("""SELECT band, kind, count(*) AS n, count(*) FILTER (h) AS hits, round(count(*) FILTER (h) / nullif(count(h), 0), 3) AS rate FROM (
SELECT CASE WHEN coalesce(quality, 0) * 5 <= 3 THEN '0-3' WHEN quality * 5 <= 6 THEN '4-6' ELSE '7-10' END AS band,
 CASE WHEN regexp_matches(coalesce(text, ''), '[\\x{4E00}-\\x{9FFF}]') THEN 'cjk' WHEN regexp_matches(coalesce(text, ''), '[_(]') THEN 'tag' ELSE 'plain' END AS kind, toxic = 1 AS h
FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1, 2""")
def query_kind_bands(s, d):
    rows = read(s, d, "documents").join(read(s, d, "labels"), "doc_id", "left")
    return probes.rates(rows, [probes.match_band(F.col("quality") * 5).alias("band"), text.query_kind("text").alias("kind")], F.col("toxic") == 1)


# --- reports ------------------------------------------------------------------


@query("""SELECT EXTRACT(YEAR FROM o_orderdate)::INTEGER AS wave, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS "F", nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS "O", nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS "P" FROM orders GROUP BY 1""")
def status_pivot(s, d):
    rows = read(s, d, "orders").select(F.year("o_orderdate").alias("wave"), F.col("o_orderstatus").alias("status"))
    return reports.queue_status(rows, statuses=["F", "O", "P"])


@query("""SELECT source, count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'skipped' OR (status <> 'done' AND attempts >= 3)) AS exhausted
FROM (SELECT o_orderpriority AS source, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'skipped' END AS status, o_orderkey % 5 AS attempts FROM orders) GROUP BY 1""")
def source_progress(s, d):
    return reports.source_progress(_queue(s, d))


def _queue(s, d) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("skipped")
    return read(s, d, "orders").select(F.col("o_orderpriority").alias("source"), F.col("o_custkey").alias("instance"), status.alias("status"), (F.col("o_orderkey") % 5).alias("attempts"), (F.col("o_orderkey") * 1.0).alias("updated_at"))


@query("SELECT o_custkey AS instance, o_orderpriority AS source, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderkey >= 500 GROUP BY 1, 2")
def done_since(s, d):
    return reports.done_since(_queue(s, d), 500.0)


@query("""SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'TOTAL' ELSE l_returnflag END AS l_returnflag, count(*) AS candidates, count(*) FILTER (l_linestatus = 'F') AS special, round(count(*) FILTER (l_linestatus = 'F') / count(*), 3) AS share
FROM lineitem GROUP BY ROLLUP (l_returnflag)""")
def source_rollup(s, d):
    return reports.instance_totals(read(s, d, "lineitem"), "l_returnflag", F.col("l_linestatus") == "F")


@query("SELECT verdict, n, round(100.0 * n / sum(n) OVER (), 2) AS percent FROM (SELECT CASE WHEN toxic = 1 THEN 'drop' WHEN quality = 1 THEN 'keep' ELSE 'uncertain' END AS verdict, count(*) AS n FROM labels GROUP BY 1)")
def verdict_distribution(s, d):
    return reports.distribution(read(s, d, "labels"), F.when(F.col("toxic") == 1, "drop").when(F.col("quality") == 1, "keep").otherwise("uncertain"), "verdict")


@query("""SELECT issue, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN l.quality = 0 THEN 'low' END, CASE WHEN l.toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 500 THEN 'short' END], lambda x: x IS NOT NULL)) AS issue FROM documents JOIN labels l USING (doc_id)) GROUP BY 1""")
def issue_histogram(s, d):
    found = F.array_compact(F.array(F.when(F.col("quality") == 0, "low"), F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("n_chars") < 500, "short")))
    return reports.issues(read(s, d, "documents").join(read(s, d, "labels"), "doc_id").withColumn("issues", found), "issues")


@query("SELECT CAST(least(10, floor(n_chars / 500)) AS BIGINT) AS score, count(*) AS n FROM documents GROUP BY 1")
def score_histogram(s, d):
    return read(s, d, "documents").groupBy(values.clamp(F.floor(F.col("n_chars") / 500)).alias("score")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, min(n_chars) AS least, list_sort(list(n_chars))[count(*) // 2 + 1] AS median, max(n_chars) AS greatest FROM documents")
def upper_median(s, d):
    return reports.caption_lengths(read(s, d, "documents"), F.col("n_chars"))


@query("""SELECT outcome, count(*) AS n FROM (SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R') THEN 'match' WHEN bool_and(l_returnflag = 'N') THEN 'inconclusive' ELSE 'mismatch' END AS outcome FROM lineitem GROUP BY 1) GROUP BY 1""")
def image_level_rollup(s, d):
    said = F.when(F.col("l_returnflag") == "R", "match").when(F.col("l_returnflag") == "N", "inconclusive").otherwise("mismatch")
    return probes.by_image(read(s, d, "lineitem").withColumn("verdict", said), "l_orderkey").groupBy("outcome").agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n, count(*) FILTER (quality = 1) AS match, count(*) FILTER (quality = 0 AND toxic = 0) AS mismatch, count(*) FILTER (quality = 0 AND toxic = 1) AS inconclusive,
round(count(*) FILTER (quality = 1) / nullif(count(*) FILTER (quality = 1 OR toxic = 0), 0), 3) AS match_rate FROM labels""")
def judged_match_rate(s, d):
    return probes.shares(read(s, d, "labels").withColumn("verdict", F.when(F.col("quality") == 1, "match").when(F.col("toxic") == 0, "mismatch").otherwise("inconclusive")))


@query("SELECT w AS value, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS w FROM part) GROUP BY 1 ORDER BY n DESC, w LIMIT 20")
def commonest_tokens(s, d):
    return probes.commonest(read(s, d, "part").select(F.explode(F.split("p_type", " ")).alias("w")), F.col("w"), 20)


@query("""SELECT l_returnflag, list_sort(list(l_extendedprice))[CAST(round_even(0.5 * (count(*) - 1), 0) AS BIGINT) + 1] AS p50, list_sort(list(l_extendedprice))[CAST(round_even(0.95 * (count(*) - 1), 0) AS BIGINT) + 1] AS p95,
list_sort(list(l_extendedprice))[CAST(round_even(0.99 * (count(*) - 1), 0) AS BIGINT) + 1] AS p99 FROM lineitem GROUP BY 1""")
def nearest_rank_percentile(s, d):
    return reports.latencies(read(s, d, "lineitem"), "l_extendedprice", "l_returnflag")


@query("""SELECT l_linenumber, count(*) AS units, count(*) FILTER (l_returnflag = 'N') AS ok, CAST(coalesce(sum(l_partkey) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS bytes,
round(CAST(coalesce(sum(l_partkey) FILTER (l_returnflag = 'N'), 0) AS DOUBLE) / 1e6 / nullif(max(l_quantity) - min(l_quantity), 0), 3) AS agg_mbps, round(count(*) FILTER (l_returnflag = 'N') / count(*), 3) AS success_rate FROM lineitem GROUP BY 1""")
def throughput_levels(s, d):
    rows = read(s, d, "lineitem").select("l_linenumber", (F.col("l_returnflag") == "N").alias("ok"), F.col("l_partkey").alias("bytes"), F.col("l_quantity").alias("finished"), F.col("l_quantity").alias("started"))
    return reports.throughput(rows, "l_linenumber")


@query("SELECT max(ts) AS at, count(*) FILTER (ts >= m - INTERVAL 1 DAY) AS last_day, count(*) FILTER (ts >= m - INTERVAL 6 HOUR) AS last_hours FROM events, (SELECT max(ts) AS m FROM events)")
def status_recent(s, d):
    rows = read(s, d, "events").select("ts")
    rows = rows.crossJoin(rows.agg(F.max("ts").alias("m")))  # one row
    since = lambda span: F.count_if(F.col("ts") >= F.col("m") - F.expr(f"INTERVAL {span}"))
    return rows.agg(F.max("ts").alias("at"), since("1 DAY").alias("last_day"), since("6 HOUR").alias("last_hours"))


@query("""SELECT o_custkey AS customer, count(*) AS n, string_agg(o_orderkey, ',' ORDER BY o_totalprice DESC, o_orderkey) AS items FROM orders GROUP BY 1""")
def viewer_index(s, d):
    rows = read(s, d, "orders")
    rows = rows.select(F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("kb_match"), F.lit(0).alias("richness"), F.lit(0).alias("source_rank"), F.array(F.lit(1)).alias("tiers"), F.col("o_orderkey").alias("sha256"))
    out = reports.viewer_index(rows, "customer", ["sha256"])
    keys = F.transform(F.from_json("items", "array<struct<sha256:bigint>>"), lambda x: x["sha256"].cast("string"))
    return out.select("customer", "n", F.concat_ws(",", keys).alias("items"))


@query("""SELECT count(*) FILTER (st = 'ok' AND l_returnflag = 'N') AS authorized, count(*) FILTER (st = 'ok' AND l_returnflag <> 'N') AS unauthorized, CAST(coalesce(sum(l_partkey) FILTER (st = 'ok'), 0) AS BIGINT) AS bytes,
count(*) FILTER (st = 'capped') AS capped, count(*) FILTER (st = 'gate_rejected') AS gate_rejected, count(*) FILTER (st = 'failed') AS failed
FROM (SELECT *, CASE l_linenumber WHEN 1 THEN 'capped' WHEN 2 THEN 'gate_rejected' WHEN 3 THEN 'failed' ELSE 'ok' END AS st FROM lineitem)""")
def run_stats(s, d):
    n = F.col("l_linenumber")
    status = F.when(n == 1, "capped").when(n == 2, "gate_rejected").when(n == 3, "failed").otherwise("ok")
    return collect.run_stats(read(s, d, "lineitem").select(status.alias("status"), (F.col("l_returnflag") == "N").alias("source_authorized"), F.col("l_partkey").alias("size_bytes")))


@query("""SELECT event_type, day, n, n - lag(n) OVER (PARTITION BY event_type ORDER BY day) AS delta FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)""")
def baseline_delta(s, d):
    days = read(s, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return collect.deltas(days, "event_type", "day", "n")


@query("""WITH c AS (SELECT l_orderkey AS instance, l_suppkey % 5 AS source, 'https://x/' || l_partkey AS url, l_linenumber AS batch, l_quantity FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY instance, source ORDER BY batch, url) - 1 AS source_rank FROM c),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instance, url ORDER BY source_rank, source) AS k FROM r) WHERE k = 1),
j AS (SELECT u.*, o_orderkey IS NULL AS lost FROM u LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0) ON o_orderkey = instance),
x AS (SELECT *, CASE WHEN lost THEN 'no_job' WHEN l_quantity > 45 THEN 'too_large' END AS reason FROM j),
g AS (SELECT *, count(*) OVER (PARTITION BY instance, batch) AS n FROM x WHERE reason IS NULL),
b AS (SELECT instance, batch FROM (SELECT instance, batch, coalesce(sum(n) OVER (PARTITION BY instance ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT DISTINCT instance, batch, n FROM g)) WHERE before < 4),
p AS (SELECT g.*, row_number() OVER (PARTITION BY instance, source ORDER BY source_rank, url) AS place FROM g JOIN b USING (instance, batch))
SELECT fate, count(*) AS n FROM (SELECT CASE WHEN place > 1 THEN 'leftover' WHEN url IN (SELECT 'https://x/' || p_partkey FROM part WHERE p_size < 15) THEN 'reuse' ELSE 'fetch' END AS fate FROM p UNION ALL SELECT 'rejected' FROM x WHERE reason IS NOT NULL) GROUP BY 1""")
def collection_batch(s, d):
    url = F.concat(F.lit("https://x/"), F.col("l_partkey"))
    c = read(s, d, "lineitem").select(
        F.col("l_orderkey").alias("instance"), (F.col("l_suppkey") % 5).alias("source"), url.alias("content_url"), url.alias("asset_id"), F.col("l_linenumber").alias("batch"), F.lit(None).cast("bigint").alias("source_rank"),
        F.lit("image/png").alias("declared_mime"), F.col("l_quantity").alias("declared_size"), F.lit(None).cast("string").alias("license_raw"), F.lit(False).alias("source_authorized"),
    )
    jobs = read(s, d, "orders").where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("instance"))
    known = read(s, d, "part").where("p_size < 15").select(F.concat(F.lit("https://x/"), F.col("p_partkey")).alias("content_url"), F.lit("h").alias("sha256"))
    p = collect.planned(c, jobs, known, None, 1, 4, max_bytes=45)
    parts = [f.select(F.lit(n).alias("fate")) for n, f in (("fetch", p.fetch), ("reuse", p.reuse), ("rejected", p.rejected), ("leftover", p.leftover))]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3]).groupBy("fate").agg(F.count("*").alias("n"))


@query("""SELECT prefix, source, found, coalesce(done, 0) AS done FROM (SELECT 'n' || (c_nationkey % 5) AS prefix, c_mktsegment AS source, count(*) AS found FROM customer GROUP BY 1, 2)
LEFT JOIN (SELECT 'n' || (c_nationkey % 5) AS prefix, c_mktsegment AS source, count(*) AS done FROM customer WHERE c_acctbal > 5000 GROUP BY 1, 2) USING (prefix, source)""")
def status_dashboard(s, d):
    rows = read(s, d, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey") % 5, F.lit("_s"), F.col("c_custkey") % 3).alias("shard"), F.col("c_mktsegment").alias("source"), F.when(F.col("c_acctbal") > 5000, "done").otherwise("pending").alias("status"))
    return reports.dashboard(rows, rows)


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, '77') OR p_brand = 'Brand#11' ORDER BY p_name LIMIT 20")
def entity_search(s, d):
    rows = read(s, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.lit(None).cast("string").alias("desc"), F.when(F.col("p_brand") == "Brand#11", F.array(F.lit("77"))).alias("aliases"))
    return reports.searched(rows, "77", "p_partkey").select("p_partkey", F.col("name").alias("p_name"))


@query("SELECT name, alias FROM (SELECT p_name AS name, unnest(string_split(p_type, ' ')) AS alias FROM part) WHERE alias ILIKE '%st%'")
def alias_ilike(s, d):
    return reports.alias_like(read(s, d, "part").select(F.col("p_name").alias("name"), F.split("p_type", " ").alias("aliases")), "%st%")


# --- sources and queues -------------------------------------------------------


_LEDGER = """SELECT user_id % 12 AS source, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS search_ok, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS search_fail,
CAST(sum(CASE WHEN event_type = 'purchase' AND user_id % 12 <> 4 THEN 1 ELSE 0 END) AS BIGINT) AS dl_ok, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS dl_fail, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS dl_dead, count(*) AS runs, max(event_id) * 1.0 AS updated_at FROM events GROUP BY 1"""


def _ledger(s, d) -> DataFrame:
    one = lambda kind: (F.col("event_type") == kind).cast("bigint")
    rows = read(s, d, "events").select(
        (F.col("user_id") % 12).alias("source"), one("click").alias("search_ok"), one("error").alias("search_fail"),
        (one("purchase") * (F.col("user_id") % 12 != 4).cast("bigint")).alias("dl_ok"), one("signup").alias("dl_fail"), one("view").alias("dl_dead"), F.col("event_id").cast("double").alias("updated_at"),
    )
    return health.merge_ledger(rows, "source", ("search_ok", "search_fail", "dl_ok", "dl_fail", "dl_dead"))


@query(f"SELECT source, search_ok, search_fail, dl_ok, dl_fail, dl_dead, runs, CAST(updated_at AS DOUBLE) AS updated_at FROM ({_LEDGER})")
def health_ledger(s, d):
    return _ledger(s, d)


@query(f"SELECT source FROM ({_LEDGER}) WHERE dl_ok + dl_fail + dl_dead >= 30 AND dl_ok = 0 AND dl_dead >= 0.6 * greatest(dl_fail, 1)")
def weak_sources(s, d):
    rows = _ledger(s, d)
    return rows.where(gates.weak_source(rows["dl_ok"], rows["dl_fail"], rows["dl_dead"], F.lit(0))).select("source")


@query(f"""WITH r AS (SELECT source, 's' || lpad(CAST(source AS VARCHAR), 2, '0') AS name, CASE source % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'probation' WHEN 2 THEN 'degraded' ELSE 'probation' END AS before,
  search_ok + search_fail AS n, search_fail * 1.0 / (search_ok + search_fail) AS f, dl_ok + dl_fail + dl_dead >= 30 AND dl_ok = 0 AND dl_dead >= 0.6 * greatest(dl_fail, 1) AS weak FROM ({_LEDGER})),
m AS (SELECT name, before, CASE WHEN before = 'probation' AND n >= 5 AND f < 0.1 AND NOT weak THEN 'active' WHEN before IN ('active', 'probation') AND ((n >= 20 AND f >= 0.5) OR weak) THEN 'degraded'
  WHEN before = 'degraded' AND source % 3 <> 0 THEN 'retired' END AS after FROM r)
SELECT name, before, after FROM (SELECT *, row_number() OVER (PARTITION BY after ORDER BY name) AS k FROM m WHERE after IS NOT NULL) WHERE k <= CASE after WHEN 'active' THEN 2 WHEN 'retired' THEN 5 ELSE 999 END""")
def governance_moves(s, d):
    name = F.concat(F.lit("s"), F.lpad(F.col("source").cast("string"), 2, "0"))
    ledger = _ledger(s, d).withColumn("dl_timeout", F.lit(0))
    k = F.col("source") % 4
    cards = ledger.select(name.alias("name"), F.when(k == 0, "active").when(k == 2, "degraded").otherwise("probation").alias("lifecycle"), F.lit("llm:x").alias("provenance"), (F.col("source") % 3 == 0).alias("has_proposal"), F.lit(0).alias("repairs"))
    return health.moves(cards, ledger.withColumn("source", name))


@query("""WITH RECURSIVE e AS (SELECT user_id, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
c AS (SELECT user_id, 0 AS i, CAST(4 AS DOUBLE) AS cap FROM (SELECT DISTINCT user_id FROM events) UNION ALL
 SELECT c.user_id, c.i + 1, CASE WHEN e.ok THEN least(32, cap + 1) ELSE greatest(1, cap * 0.5) END FROM c JOIN e ON e.user_id = c.user_id AND e.i = c.i + 1)
SELECT user_id, arg_max(cap, i) AS cap FROM c GROUP BY 1""")
def aimd_cap(s, d):
    return health.aimd(read(s, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error")


@query("SELECT CASE WHEN event_id % 6 = 0 THEN 'http_503' WHEN event_id % 6 = 1 THEN 'timeout' ELSE 'http_404' END AS kind, event_id % 6 < 2 AS congested, CASE WHEN event_id % 6 = 0 THEN 'transient' WHEN event_id % 6 = 1 THEN 'transient' ELSE 'deterministic' END AS class, count(*) AS n FROM events GROUP BY 1, 2, 3")
def failure_classes(s, d):
    k = F.col("event_id") % 6
    kind = F.when(k == 0, "http_503").when(k == 1, "timeout").otherwise("http_404")
    code = F.regexp_extract(kind, r"http_(\d+)", 1).try_cast("int")
    return read(s, d, "events").groupBy(kind.alias("kind"), gates.congested(kind).alias("congested"), gates.status_class(code).alias("class")).agg(F.count("*").alias("n"))


# --- bulk, vectors, tree ------------------------------------------------------


@query("""WITH i AS (SELECT DISTINCT lower(p_type_word) AS tag, 'i_' || lower(p_type_word) AS instance FROM (SELECT unnest(string_split(p_type, ' ')) AS p_type_word FROM part) WHERE length(p_type_word) >= 3),
t AS (SELECT p_partkey AS id, lower(unnest(string_split(p_type, ' '))) AS tag FROM part) SELECT id, instance, min(tag) AS matched_tag FROM t JOIN i USING (tag) GROUP BY 1, 2""")
def bulk_tag_join(s, d):
    part = read(s, d, "part")
    word = part.select(F.explode(F.split(F.lower("p_type"), " ")).alias("tag")).where(text.is_tag("tag")).distinct()
    posts = part.select(F.col("p_partkey").alias("id"), F.lower("p_type").alias("tag_string"))
    return bulk.matched(posts, word.withColumn("instance", F.concat(F.lit("i_"), "tag"))).select("id", "instance", "matched_tag")


@query("SELECT md5(text) AS md5, string_agg(DISTINCT source, '|' ORDER BY source) AS instances FROM documents GROUP BY 1")
def bulk_per_content(s, d):
    rows = read(s, d, "documents").select(F.md5("text").alias("md5"), F.col("source").alias("instance"))
    return bulk.per_content(rows).select("md5", joined("instances").alias("instances"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def bulk_still_wanted(s, d):
    c = read(s, d, "customer").withColumnRenamed("c_custkey", "id")
    return bulk.still_wanted(read(s, d, "orders").withColumnRenamed("o_custkey", "id"), c.where("c_acctbal > 0"), c.where("c_nationkey = 3"), "id").select("o_orderkey")


_VECTORS = "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings"


@query(f"""WITH v AS ({_VECTORS}), q AS (SELECT vec_id, v FROM v WHERE vec_id % 50 = 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, v.v), lambda z: z[1] * z[2])) / (sqrt(list_sum(list_transform(q.v, lambda x: x * x))) * sqrt(list_sum(list_transform(v.v, lambda x: x * x))) + 1e-9) AS similarity FROM q, v)
SELECT query_id, vec_id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM p) WHERE rank <= 3""")
def cosine_topk(s, d):
    rows = read(s, d, "embeddings").select("vec_id", "embedding")
    return emerge.nearest_entities(rows.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), rows, 3, "query_id", "vec_id")


@query("""WITH e AS (SELECT label, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2),
s AS (SELECT e.label, vec_id, sum((x - m) * (x - m)) AS distance FROM e JOIN m ON e.label = m.label AND e.i = m.i GROUP BY 1, 2)
SELECT label, vec_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rank FROM s) WHERE rank <= 5""")
def centroid_representatives(s, d):
    return emerge.nearest_members(read(s, d, "embeddings"), 5)


@query("""SELECT pool, count(*) AS clusters, CAST(sum(size) AS BIGINT) AS images, round(CAST(sum(CASE WHEN verdict = 'existing' THEN size ELSE 0 END) AS DOUBLE) / greatest(sum(size), 1), 3) AS align_rate FROM (
SELECT label % 2 AS pool, CASE WHEN label % 3 = 0 THEN 'new' ELSE 'existing' END AS verdict, count(*) AS size FROM embeddings GROUP BY label) GROUP BY 1""")
def align_rate(s, d):
    sizes = read(s, d, "embeddings").groupBy("label").agg(F.count("*").alias("size"))
    return emerge.alignment(sizes.select((F.col("label") % 2).alias("pool"), F.when(F.col("label") % 3 == 0, "new").otherwise("existing").alias("verdict"), "size"))


@query("SELECT count(*) AS members, count(DISTINCT CASE WHEN label > 1 THEN label END) AS clusters, round(avg(CASE WHEN label <= 1 THEN 1.0 ELSE 0.0 END), 3) AS noise_share FROM embeddings")
def noise_share(s, d):
    return emerge.noise(read(s, d, "embeddings").select(F.when(F.col("label") > 1, F.col("label")).otherwise(-1).alias("cluster_id")))


def _tree(s, d) -> DataFrame:
    region, nation = read(s, d, "region"), read(s, d, "nation")
    customers = read(s, d, "customer").where("c_nationkey % 4 <> 0").groupBy("c_nationkey").agg(F.collect_list("c_name").alias("instances"))
    none, blank = F.array().cast("array<string>"), F.lit(None).cast("string")
    top = region.select(F.col("r_name").alias("path"), blank.alias("parent_path"), F.col("r_name").alias("name"), F.lit(1).alias("depth"), none.alias("instances"))
    low = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    low = low.select(F.concat_ws(" / ", "r_name", "n_name").alias("path"), F.col("r_name").alias("parent_path"), F.col("n_name").alias("name"), F.lit(2).alias("depth"), F.coalesce("instances", none).alias("instances"))
    empty = {"knowledge_intro": blank, "aliases": none, "representative_cases": none, "related_tags": none}
    return top.unionByName(low).withColumns(empty)


@query("""SELECT r_name || ' / ' || n_name AS path, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey % 4 <> 0)""")
def dead_leaves(s, d):
    return tree.dead_leaves(_tree(s, d)).select("path", "name")


@query("""SELECT c_name AS name, r_name || ' / ' || n_name AS paths, n_name AS cluster FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_nationkey % 4 <> 0""")
def tree_mounts(s, d):
    rows = tree.mounts(_tree(s, d))
    return rows.select("name", joined("paths").alias("paths"), text.cluster_of("paths").alias("cluster"))


@query("SELECT r_name AS parent_path, count(*) AS n, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0 GROUP BY 1")
def delete_report(s, d):
    rows = read(s, d, "nation").join(read(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(F.col("r_name").alias("parent_path"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "delete").otherwise("keep").alias("verdict"))
    return tree.delete_report(rows).select("parent_path", "n", joined("names").alias("names"))


@query("SELECT ' n' || (c_nationkey % 6) || ' ' AS branch, count(*) AS n FROM customer GROUP BY 1")
def tree_branches(s, d):
    return reports.by_branch(read(s, d, "customer").select(F.concat(F.lit("root / n"), F.col("c_nationkey") % 6, F.lit(" / c")).alias("path")))

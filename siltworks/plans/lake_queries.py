"""Named queries for scans, sinks, streams, rules and composed plans, with the SQL that checks each.

What a scan reads is first written to a folder of its own in shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls, values
from ..operators import gates, manifest, ranking
from ..schemas import MANIFEST, POST, schema
from ..sources import connectors, files, sinks, spec
from ..sources.scratch import folder
from ..streaming import jobs
from . import collect, coverage, emerge, health, probes, reports, tree
from .catalog import joined, query, read


def lines(rows: DataFrame, name: str, value) -> str:
    """Rows as lines of text in a folder; its path."""
    path = folder(rows.sparkSession, name)
    rows.select(value.alias("value")).write.text(path)
    return path


# --- scans ---------------------------------------------------------------------


def _manifest(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select(F.sha2("text", 256).alias("sha256"), F.col("lang").alias("ext"), "source", F.col("n_chars").alias("size_bytes"), F.array("source").alias("instances"), F.col("doc_id").cast("double").alias("fetched_at"))


@query("SELECT sha256(text) AS sha256, lang AS ext, source, n_chars AS size_bytes, source AS instances FROM documents")
def manifest_scan(s, d):
    path = folder(s, "manifest")
    sinks.write_json_lines(_manifest(s, d), path)
    return files.read_manifest(s, path).select("sha256", "ext", "source", "size_bytes", joined("instances").alias("instances"))


@query("SELECT sha256(text) AS sha256, n_chars AS size_bytes FROM documents WHERE doc_id % 7 <> 0")
def torn_manifest_scan(s, d):
    whole = F.to_json(F.struct("sha256", "size_bytes"))
    torn = F.col("fetched_at") % 7 == 0
    value = F.when(torn, F.left(whole, F.floor(F.length(whole) / 2).cast("int"))).otherwise(F.concat(whole, F.when(F.col("fetched_at") % 5 == 0, "\n\n").otherwise("")))
    return files.read_manifest(s, lines(_manifest(s, d), "torn", value), tolerant=True).select("sha256", "size_bytes")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS asset_id, l_partkey AS declared_width, coalesce(CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END, l_partkey) AS orig_width FROM lineitem")
def candidates_scan(s, d):
    rows = read(s, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("asset_id"), F.col("l_partkey").alias("declared_width"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).alias("orig_width"), F.lit(1).alias("no_such_field"))
    path = folder(s, "candidates")
    sinks.write_json_lines(rows, path)
    return files.read_candidates(s, path).select("asset_id", "declared_width", "orig_width")


@query("SELECT doc_id AS id, CAST(n_chars AS INTEGER) AS score FROM documents WHERE n_chars > 500")
def selected_rows_scan(s, d):
    path = folder(s, "selected")
    sinks.write_json_lines(read(s, d, "documents").where("n_chars > 500").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("score")), path)
    return files.read_manifest(s, path, POST).select("id", "score")


def _tar_header(name: str, size: int) -> str:
    """One block of a tar, of format ustar."""
    head = name.ljust(100, "\0") + "0000644\0" + "0000000\0" * 2 + f"{size:011o}\0" + "00000000000\0" + " " * 8 + "0" + "\0" * 100 + "ustar\x0000" + "\0" * 247
    return head[:148] + f"{sum(head.encode()):06o}\0 " + head[156:]


@query("SELECT doc_id AS id, CAST(n_chars AS INTEGER) AS score FROM documents")
def dump_scan(s, d):
    """A gzipped tar with two members, of which one is read; a tar is one stream, so one task writes it."""
    rows = read(s, d, "documents").select("doc_id", F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("score"))).alias("j"))
    size, first = rows.agg(F.sum(F.octet_length("j") + 1), F.min("doc_id")).first()
    other = '{"id": -1}\n'
    head = _tar_header("./dump/other.json", len(other)) + other + "\0" * (512 - len(other)) + _tar_header("./dump/posts.json", size or 0)
    value = F.when(F.col("doc_id") == first, F.concat(F.lit(head), "j")).otherwise(F.col("j"))
    path = folder(s, "dump")
    rows.repartition(1).sortWithinPartitions("doc_id").select(value.alias("value")).write.option("compression", "gzip").text(path)
    return files.read_dump(s, path, "posts.json", POST).select("id", "score")


@query("""SELECT sha256, lang AS instance, arg_min(v, source) AS value FROM (SELECT doc_id % 50 || '' AS sha256, lang, source, min(CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'v' || n_chars END) AS v FROM documents GROUP BY 1, 2, 3)
WHERE v <> '' GROUP BY 1, 2""")
def runs_scan(s, d):
    rows = read(s, d, "documents").groupBy((F.col("doc_id") % 50).cast("string").alias("sha256"), F.col("lang").alias("instance"), "source").agg(F.min(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("v"), "n_chars"))).alias("value"))
    path = folder(s, "runs")
    sinks.write_by_status(rows, path, "source")
    return files.first_per_instance(files.read_runs(s, f"{path}/*/*.json", schema("sha256 string, instance string, value string")), "value").select("sha256", "instance", "value")


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def text_count_scan(s, d):
    path = folder(s, "counts")
    sinks.write_json_lines(read(s, d, "documents").select("doc_id", "source", "lang"), path)
    return files.text_counts(s, path, "source")


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'a|' || n_name ELSE n_name END AS query FROM nation")
def entities_scan(s, d):
    listed = F.to_json(F.array(F.lit("a"), F.col("n_name")))
    one = F.struct(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, listed).otherwise(F.col("n_name")).alias("query"))
    rows = read(s, d, "nation").agg(F.collect_list(one).alias("instances"))
    return files.read_entities(s, lines(rows, "entities", F.to_json(F.struct("instances")))).select("name", joined("query").alias("query"))


@query("""SELECT user_id, arg_max(event_type, event_id) AS latest, bool_or(event_type <> 'error') AS done FROM events GROUP BY 1""")
def cache_scan(s, d):
    path = folder(s, "cache")
    sinks.append_log(read(s, d, "events").select("event_id", "user_id", "event_type", (F.col("event_type") != "error").alias("ok")), path)
    log = s.read.schema("event_id long, user_id long, event_type string, ok boolean").json(path)
    done = files.done_keys(log, "user_id").withColumn("done", F.lit(True))
    last = files.latest_records(log, "user_id", F.col("event_id"))
    return last.join(done, "user_id", "left").select("user_id", F.col("event_type").alias("latest"), F.coalesce("done", F.lit(False)).alias("done"))


@query("SELECT url FROM pages WHERE page_id % 4 <> 3")
def url_list_scan(s, d):
    k = F.col("page_id") % 4
    value = F.when(k == 0, F.col("url")).when(k == 1, F.to_json(F.struct("url"))).when(k == 2, F.to_json(F.struct(F.col("url").alias("content_url")))).when(F.col("page_id") % 8 == 3, F.concat(F.lit("# "), "url")).otherwise("  ")
    return files.read_urls(s, lines(read(s, d, "pages"), "urls", value))


@query("SELECT (SELECT count(*) FROM events) AS since_then, 0 AS since_later")
def recent_files_scan(s, d):
    path = folder(s, "recent")
    sinks.write_table(read(s, d, "events").select("event_id"), path)
    then = files.read_recent(s, path, "2001-01-01T00:00:00").agg(F.count("*").alias("since_then"))
    later = s.read.schema("event_id long").option("modifiedAfter", "2999-01-01T00:00:00").parquet(path).agg(F.count("*").cast("int").alias("since_later"))
    return then.crossJoin(later)  # one row each


@query("""SELECT DISTINCT lower(n_name) AS category, o_orderkey AS image_id, 'f' || o_custkey AS file_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN nation ON n_nationkey = l_suppkey % 25""")
def annotated_images(s, d):
    images = read(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("f"), "o_custkey").alias("file_name"))
    notes = read(s, d, "lineitem").select(F.col("l_orderkey").alias("image_id"), (F.col("l_suppkey") % 25).cast("int").alias("category_id"))
    return files.category_index(images, notes, read(s, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))


@query("SELECT n AS name, CAST(max(v) AS INTEGER) AS version FROM (SELECT c_mktsegment AS n, c_nationkey % 7 AS v FROM customer) GROUP BY 1")
def newest_specs(s, d):
    paths = read(s, d, "customer").select(F.concat(F.lit("/specs/"), "c_mktsegment", F.lit(".v"), (F.col("c_nationkey") % 7).cast("string"), F.lit(".json")).alias("path"))
    return health.newest_specs(paths).select("name", "version")


# --- sinks ---------------------------------------------------------------------


@query("SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0")
def table_append(s, d):
    path, rows = folder(s, "table"), read(s, d, "documents").select("doc_id", "lang")
    sinks.write_table(rows, path)
    sinks.write_table(rows.where("doc_id % 2 = 0"), path, "append")
    return files.read_table(s, path)


@query("""SELECT sha256(text) AS sha256, string_agg(DISTINCT source, '|' ORDER BY source) AS instances, coalesce(min(doc_id) FILTER (doc_id % 2 = 0), min(doc_id)) AS first_doc FROM documents GROUP BY 1""")
def manifest_upsert(s, d):
    table = sinks.Snapshots(s, folder(s, "upsert"))
    rows = read(s, d, "documents").select(F.sha2("text", 256).alias("sha256"), F.array("source").alias("instances"), F.col("doc_id").alias("first_doc"))
    for part in ("first_doc % 2 = 0", "first_doc % 2 = 1"):
        sinks.upsert(table, rows.where(part), arrays=("instances",), maps=(), order=("first_doc",))
    return table.read().select("sha256", joined(F.array_sort("instances")).alias("instances"), "first_doc")


@query("SELECT sha256(text) AS sha256, coalesce(min(doc_id) FILTER (doc_id % 2 = 0), min(doc_id)) AS doc_id FROM documents GROUP BY 1")
def manifest_append(s, d):
    table = sinks.Snapshots(s, folder(s, "append"))
    rows = read(s, d, "documents").select(F.sha2("text", 256).alias("sha256"), "doc_id")
    for part in ("doc_id % 2 = 0", "true"):
        sinks.append_unseen(table, rows.where(part), order=("doc_id",))
    return table.read()


@query("""SELECT sha256(text) AS sha256, CAST(coalesce(l.quality, 5) AS INTEGER) AS kb_match FROM documents d LEFT JOIN labels l USING (doc_id)""")
def manifest_annotate(s, d):
    table = sinks.Snapshots(s, folder(s, "annotate"))
    table.replace(read(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.lit(5).alias("kb_match")))
    sinks.merge_annotations(table, read(s, d, "labels").select("doc_id", F.col("quality").alias("kb_match")), "doc_id", ["kb_match"])
    return table.read().select("sha256", "kb_match")


@query("""SELECT CASE WHEN doc_id % 5 = 0 THEN '{broken ' || doc_id WHEN doc_id % 5 = 1 THEN '{"id":' || doc_id || ',"path":"blobs/ab/' || doc_id || '.jpg"}' ELSE '{"id":' || doc_id || ',"path":"blobs/cd/' || doc_id || '.jpg"}' END AS value FROM documents""")
def path_repair(s, d):
    k = F.col("doc_id") % 5
    where = F.when(k == 1, "/data/lake/blobs/ab/").when(k == 2, "/old/root/blobs/cd/").otherwise("blobs/cd/")
    whole = F.concat(F.lit('{"id":'), "doc_id", F.lit(',"path":"'), where, "doc_id", F.lit('.jpg"}'))
    path, out = lines(read(s, d, "documents"), "paths", F.when(k == 0, F.concat(F.lit("{broken "), "doc_id")).otherwise(whole)), folder(s, "repaired")
    sinks.repaired(s, path, out, "/data/lake")
    return s.read.text(out)


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def products_by_status(s, d):
    path = folder(s, "products")
    sinks.write_by_status(read(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), path)
    return s.read.schema("o_orderkey long, status string").json(path).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT vec_id, label FROM embeddings")
def vector_append(s, d):
    path, rows = folder(s, "vectors"), read(s, d, "embeddings")
    size = rows.select(F.size("embedding")).first()
    for k in (0, 1):
        sinks.append_vectors(rows.where(F.col("vec_id") % 2 == k), path, size[0] if size else 0)
    return files.read_table(s, path).where(F.size("embedding") > 0).select("vec_id", "label")


@query("""SELECT '<script>window.__IMGS__ = [' || string_agg('{"name":"' || n_name || '","n":' || n_nationkey || '}', ',' ORDER BY '{"name":"' || n_name || '","n":' || n_nationkey || '}') || '];<' || chr(47) || 'script>' AS value FROM nation""")
def viewer_page(s, d):
    path = folder(s, "page")
    sinks.write_page(read(s, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("n")), "<script>/*INDEX*/</script>", path)
    return s.read.text(path)


# --- rules and functions ---------------------------------------------------------


@query("""SELECT p_partkey, p_partkey % 3 = 0 AS cjk, CASE WHEN p_partkey % 3 = 0 THEN '红' || p_name ELSE p_name END AS entity, replace(lower(trim(' ' || p_name || ' ')), ' ', '_') AS form FROM part""")
def name_rules(s, d):
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("红"), "p_name")).otherwise(F.col("p_name"))
    dressed = F.concat(F.lit(" 《"), name, F.lit("》（x y）"))
    return read(s, d, "part").select("p_partkey", text.has_cjk(name).alias("cjk"), text.entity_name(dressed).alias("entity"), text.query_form(F.concat(F.lit(" "), "p_name", F.lit(" ")), "lower_underscore").alias("form"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN page_id END AS w, CASE WHEN page_id % 3 = 0 THEN 7 END AS h, 'https://h/photos/' || page_id || '/original.jpg' AS original,
CASE page_id % 3 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' END AS mime, page_id % 2 = 0 AS allowed, page_id % 2 = 1 OR page_id % 5 = 0 AS in_scope, page_id % 3 = 0 AS any_host FROM pages""")
def url_rules(s, d):
    k = F.col("page_id")
    sized = F.concat(F.lit("https://h/x?"), F.when(k % 2 == 0, F.concat(F.lit("h=7&w="), k)).otherwise(F.concat(F.lit("w="), k, F.when(k % 3 == 0, "&h=7").otherwise(""))))
    sized = F.when(k % 3 == 0, sized).otherwise(F.concat(F.lit("https://h/x?w="), k))
    photo = F.concat(F.lit("https://h/photos/"), k, F.when(k % 2 == 0, "/square.jpg").otherwise("/medium.jpg"))
    ext = F.when(k % 3 == 0, "png")
    other = F.when(k % 3 == 1, "https://h/x.JPG?y=1").otherwise("https://h/x.txt")
    host = F.concat(F.lit("https://"), F.when(k % 2 == 1, "media.site.org").when(k % 5 == 0, "site.org").otherwise("othersite.org"), F.lit("/x"))
    dims = urls.query_dims(sized)
    return read(s, d, "pages").select(
        "page_id", dims["w"].alias("w"), F.when(dims.isNotNull(), dims["h"]).cast("int").alias("h"), urls.original_size(photo).alias("original"), urls.mime_by_extension(ext, other).alias("mime"),
        urls.robots_allow(F.when(k % 2 == 0, "/open/x").otherwise("/closed/x"), F.array(F.lit("/closed"), F.lit(""))).alias("allowed"),
        urls.host_in(host, ["site.org"]).alias("in_scope"), (urls.host_in(host, ["*"], media_wildcard=True) & (k % 3 == 0)).alias("any_host"),
    )


@query("""SELECT p_partkey, CAST(least(40, greatest(10, p_size * 6)) AS INTEGER) AS page, abs(p_size - 25) <= greatest(0.75, 8) AS near, least(5.0 * power(2, p_size % 8), 120) AS wait,
round((1 - p_size / nullif(p_partkey % 9, 0)::DOUBLE) * 100, 1) AS loss, CASE p_size % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'transient' WHEN 3 THEN 'transient' ELSE 'deterministic' END AS class,
md5('page=' || p_size || '&q=' || replace(p_name, ' ', '+') || 'key') AS signature FROM part""")
def value_rules(s, d):
    k = F.col("p_size") % 5
    code = F.when(k == 0, 200).when(k == 1, 304).when(k == 2, 429).when(k == 3, 503).otherwise(408)
    return read(s, d, "part").select(
        "p_partkey", values.page_size("p_size", 6, 10, 40).alias("page"), values.within("p_size", F.lit(25)).alias("near"), values.backoff(F.col("p_size") % 8 + 1).alias("wait"),
        values.mirror_loss(F.col("p_size").cast("double"), (F.col("p_partkey") % 9).cast("double")).alias("loss"), gates.status_class(code).alias("class"), values.signature({"q": "p_name", "page": "p_size"}, "key").alias("signature"),
    )


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(least(10, doc_id % 13) AS INTEGER) END AS kb_match, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'a caption that is long enough to be kept, ' || doc_id END AS caption,
CASE doc_id % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'drop' ELSE 'uncertain' END AS verdict, CASE WHEN doc_id % 2 = 0 THEN 'blur|text' ELSE '' END AS issues FROM documents""")
def reply_rules(s, d):
    k = F.col("doc_id")
    caption = F.when(k % 8 == 0, F.lit("short")).otherwise(F.concat(F.lit("a caption that is long enough to be kept, "), k))
    said = F.concat(F.lit('Sure: {"kb_match": '), F.when(k % 8 == 4, F.lit("null")).otherwise((k % 13).cast("string")), F.lit(', "richness": 3, "caption": "'), caption, F.lit('"} Done.'))
    word = F.when(k % 3 == 0, "KEEP").when(k % 3 == 1, "drop").otherwise("maybe")
    ruled = F.concat(F.lit('{"verdict": "'), word, F.lit('", "score": 4'), F.when(k % 2 == 0, ', "issues": ["blur", "text"]').otherwise(""), F.lit("}"))
    a, v = values.annotation(said), values.verdict(ruled)
    return read(s, d, "documents").select("doc_id", a["kb_match"].alias("kb_match"), a["caption"].alias("caption"), v["verdict"].alias("verdict"), joined(v["issues"]).alias("issues"))


@query("SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/gif' WHEN 3 THEN 'image/webp' WHEN 4 THEN 'image/tiff' WHEN 5 THEN 'image/bmp' END AS mime, CASE p_partkey % 7 WHEN 0 THEN 'jpg' WHEN 1 THEN 'png' WHEN 2 THEN 'gif' WHEN 3 THEN 'webp' WHEN 4 THEN 'tiff' WHEN 5 THEN 'bmp' END AS ext FROM part")
def magic_bytes(s, d):
    starts = ["FFD8FFE0", "89504E470D0A1A0A", "474946383961", "524946460000000057454250", "49492A00", "424D", "00010203"]
    data = F.unhex(F.array(*(F.lit(x) for x in starts))[(F.col("p_partkey") % 7).cast("int")])
    return read(s, d, "part").select("p_partkey", values.sniffed(data).alias("mime"), values.extension_of_mime(values.sniffed(data)).alias("ext"))


@query("""SELECT p_partkey, p_name || chr(10) || 'aliases: ' || 'A1, B2, C3, D4, E5' || chr(10) || repeat('d', 250) || '…' AS block, 'red|blue' AS cleaned, 'Anna|b2' AS latin, 'Short|Longer Name|[x] y' AS pool_latin, '红|' || p_name AS pool_cjk FROM part""")
def alias_rules(s, d):
    array = lambda *xs: F.array(*(F.lit(x) for x in xs))
    pools = text.alias_pools("p_name", array("Longer Name", "红", "Short"), array("[x] y", " Short ", ""))
    return read(s, d, "part").select(
        "p_partkey", text.knowledge_block("p_name", array("A1", "B2", "C3", "D4", "E5", "F6"), F.lit("d" * 251)).alias("block"), joined(text.clean_list(array(" red", "blue ", "red", "", "green"), ["red", "blue"])).alias("cleaned"),
        joined(text.latin_candidates(array("Anna", "红", "ANNA", "b2", "12"))).alias("latin"), joined(pools["latin"]).alias("pool_latin"), joined(pools["cjk"]).alias("pool_cjk"),
    )


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN '$.results' WHEN 1 THEN '$' WHEN 2 THEN '$.data.items' WHEN 3 THEN '$.docs' WHEN 4 THEN '$.data' END AS container, 'a.org|c.org' AS hosts FROM events""")
def reply_shapes(s, d):
    shapes = ['{"items": [1], "results": []}', "[{}]", '{"data": {"items": [1], "total": 3}}', '{"docs": [1], "hits": {}}', '{"posts": [1], "data": [2]}', '{"other": [1]}']
    document = F.array(*(F.lit(x) for x in shapes))[(F.col("event_id") % 6).cast("int")]
    sample = '{"u": "https://c.org/x.TIFF?s=1", "v": ["http://b.org/y.png", "https://a.org/z.jpg"], "w": "https://d.org/page.html", "t": "see https://e.org/a.png"}'
    return read(s, d, "events").select("event_id", spec.container(document).alias("container"), joined(urls.media_hosts(F.lit(sample))).alias("hosts"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'rating' WHEN p_partkey % 11 = 0 THEN 'flagged' WHEN p_size < 5 THEN 'score' WHEN p_partkey % 7 = 0 THEN 'format' WHEN p_size * 30 < 300 THEN 'small'
WHEN p_brand = 'Brand#13' THEN 'bad_tag' ELSE 'accepted' END AS reason FROM part) GROUP BY 1""")
def post_funnel(s, d):
    k = F.col("p_partkey")
    posts = read(s, d, "part").select(
        F.when(k % 10 == 0, "s").otherwise("g").alias("rating"), F.lit(False).alias("is_deleted"), F.lit(False).alias("is_flagged"), (k % 11 == 0).alias("is_pending"), F.col("p_size").alias("score"),
        F.when(k % 7 == 0, "mp4").otherwise("PNG").alias("file_ext"), (F.col("p_size") * 30).alias("image_width"), F.lit(900).alias("image_height"), F.when(F.col("p_brand") == "Brand#13", "a  third-party_edit").otherwise("comic sketch").alias("tag_string"),
    )
    return gates.funnel(posts, gates.ordered_reason(gates.post_gates(min_score=5, min_side=300)))


@query("""SELECT c_mktsegment AS source, count(*) AS n, avg(CASE WHEN c_nationkey % 3 > 0 THEN 1.0 ELSE 0 END) AS with_size, avg(CASE WHEN c_nationkey % 4 > 0 THEN 1.0 ELSE 0 END) AS with_image_url,
count(*) >= 3 AND avg(CASE WHEN c_nationkey % 3 > 0 THEN 1.0 ELSE 0 END) >= 0.5 AND avg(CASE WHEN c_nationkey % 4 > 0 THEN 1.0 ELSE 0 END) >= 0.5 AS passes FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def structural_gate(s, d):
    k = F.col("c_nationkey")
    url = F.when(k % 4 == 1, "https://x/a.TIF?x").otherwise("https://x/a")
    rows = read(s, d, "customer").where("c_mktsegment = 'BUILDING'").select((k % 3).alias("width"), F.lit(9).alias("height"), url.alias("content_url"), F.when(k % 4 > 1, "image/x-own").alias("mime"))
    return gates.structure(rows).where("n > 0").withColumn("source", F.lit("BUILDING"))


@query("""SELECT nullif(CASE WHEN s_suppkey % 5 > 0 THEN s_name ELSE '' END, '') AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'no_name' WHEN s_suppkey % 5 = 1 THEN 'name_in_use' WHEN s_suppkey % 5 = 2 THEN 'not_https' END AS reject_reason FROM supplier""")
def proposal_gate(s, d):
    k = F.col("s_suppkey") % 5
    rows = read(s, d, "supplier").select(F.when(k > 0, F.col("s_name")).alias("name"), F.when(k == 2, "http://x").otherwise("https://x").alias("url"), F.lit("x").alias("code"))
    known = read(s, d, "supplier").where(k == 1).select(F.col("s_name").alias("name")).distinct()
    return collect.proposals(rows, ["name", "reject_reason"], known).select("name", "reject_reason")


@query("SELECT s_name AS name, CASE s_suppkey % 4 WHEN 0 THEN 'active' ELSE 'probation' END AS lifecycle FROM supplier WHERE s_suppkey % 4 < 2")
def usable_sources(s, d):
    states = F.array(*(F.lit(x) for x in ("active", "probation", "retired", "draft")))
    return read(s, d, "supplier").select(F.col("s_name").alias("name"), states[(F.col("s_suppkey") % 4).cast("int")].alias("lifecycle")).where(gates.usable(F.col("lifecycle")))


# --- projections and joins ---------------------------------------------------------


def _fetched(s, d) -> DataFrame:
    """Line items as fetched candidates."""
    rows = read(s, d, "lineitem")
    null = lambda *names: {n: F.lit(None).cast("string") for n in names}
    return rows.select(
        F.concat(F.lit("h"), "l_partkey").alias("sha256"), F.concat(F.lit("i"), F.col("l_suppkey") % 9).alias("instance"), F.concat(F.lit("q"), "l_linenumber").alias("query"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("asset_id"),
        F.concat(F.lit("/x/h"), "l_partkey", F.lit(".png")).alias("local_path"), F.col("l_returnflag").alias("source"), F.lit(True).alias("source_authorized"), F.col("l_partkey").alias("actual_width"), F.lit(9).cast("long").alias("actual_height"),
        F.col("l_partkey").alias("declared_width"), F.lit(None).cast("long").alias("orig_width"), F.lit(None).cast("long").alias("orig_height"), F.col("l_suppkey").alias("actual_size"), F.lit("image/png").alias("actual_mime"),
        F.lit(1).cast("long").alias("tier"), F.col("l_linenumber").cast("long").alias("source_rank"), F.lit(0.5).alias("source_score"), F.lit(1.0).alias("fetched_at"), F.concat(F.lit("u"), "l_partkey").alias("content_url"),
    ).withColumns(null("source_kind", "license_raw", "author", "credit", "query_lang", "landing_url"))


@query("""SELECT 'h' || l_partkey AS sha256, 'png' AS ext, 'i' || (l_suppkey % 9) AS instances, 'q' || l_linenumber AS query, l_partkey AS width, l_partkey AS orig_width, 'blobs/' || left('h' || l_partkey, 2) || '/h' || l_partkey || '.png' AS path FROM lineitem""")
def manifest_rows(s, d):
    m = manifest.row_of_candidate(_fetched(s, d))
    return m.select("sha256", "ext", joined("instances").alias("instances"), F.map_values("queries")[0].alias("query"), "width", "orig_width", "path")


@query("""SELECT 'h' || l_partkey AS sha256, 'i' || (l_suppkey % 9) AS instance, 'q' || l_linenumber AS query, l_orderkey || '-' || l_linenumber AS asset_id, l_suppkey AS actual_size, 'reused' AS status FROM lineitem""")
def candidates_of_manifest(s, d):
    return manifest.candidate_of_row(manifest.row_of_candidate(_fetched(s, d))).select("sha256", "instance", "query", "asset_id", "actual_size", "status")


@query("""SELECT 'h' || l_partkey AS sha256, 'i' || (l_suppkey % 9) AS instances, CAST(l_linenumber AS BIGINT) AS source_rank, CAST(NULL AS INTEGER) AS kb_match FROM lineitem""")
def manifest_of_items(s, d):
    null = lambda kind, *names: {n: F.lit(None).cast(kind) for n in names}
    items = _fetched(s, d).withColumns({"ext": F.lit("png"), "license": F.lit("x"), "size_bytes": F.col("actual_size"), "mime": F.col("actual_mime"), "rank": F.col("source_rank").cast("int")} | null("int", "kb_match", "richness") | null("string", "caption") | null("boolean", "identity"))
    return manifest.row_of_item(items).select("sha256", joined("instances").alias("instances"), "source_rank", "kb_match")


@query("""SELECT l_orderkey AS sha256, 'i' || (l_suppkey % 9) AS instance, 'q' || l_linenumber AS query, p_name AS characters FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'A'""")
def dlq_pairs(s, d):
    rows = read(s, d, "lineitem")
    one = F.concat(F.lit("i"), F.col("l_suppkey") % 9)
    m = rows.select(F.col("l_orderkey").alias("sha256"), F.array(one).alias("instances"), F.lit(5).alias("kb_match"), F.col("l_returnflag").alias("source"), F.create_map(one, F.concat(F.lit("q"), "l_linenumber")).alias("queries"), F.create_map(one, F.col("l_partkey").cast("string")).alias("asset_ids"))
    payload = F.to_json(F.struct(F.col("p_name").alias("characters"), F.lit(1).alias("other")))
    payloads = read(s, d, "part").select(F.col("p_partkey").cast("string").alias("asset_id"), payload.alias("payload")).select("asset_id", probes.payload_field("payload", "characters").alias("characters"))
    return probes.pairs(m, payloads, "A").select("sha256", "instance", "query", "characters")


@query("SELECT o_orderkey AS sha256, c_custkey AS post_id, c_name AS tags FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 3 > 0")
def post_identities(s, d):
    url = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("https://b/posts/"), "o_custkey", F.lit("?q=1")))
    m = read(s, d, "orders").select(F.col("o_orderkey").alias("sha256"), url.alias("landing_url"))
    return probes.identities(read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("tags")), m).select("sha256", "post_id", "tags")


@query("SELECT lower(replace(n_name, ' ', '')) AS concept, min(CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'other ' || n_name END) AS matched_instance FROM nation GROUP BY 1")
def concept_names(s, d):
    even = F.col("n_nationkey") % 2 == 0
    entities = read(s, d, "nation").select(F.when(even, F.col("n_name")).otherwise(F.concat(F.lit("other "), "n_name")).alias("name"), F.when(~even, F.array(F.upper("n_name"))).alias("aliases"))
    concepts = read(s, d, "nation").select(F.lower(F.replace("n_name", F.lit(" "), F.lit(""))).alias("concept")).distinct()
    return emerge.named_entities(concepts, entities)


@query("""SELECT label, query, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, query) AS rank FROM (
SELECT label, 'q' || (vec_id % 13) AS query, count(*) AS n FROM embeddings GROUP BY 1, 2)) WHERE rank <= 8""")
def cluster_queries(s, d):
    rows = read(s, d, "embeddings").select(F.col("vec_id").alias("sha256"), "label")
    m = rows.select("sha256", F.create_map(F.lit("i"), F.concat(F.lit("q"), F.col("sha256") % 13)).alias("queries"))
    return emerge.query_counts(rows, m, ["label"], 8)


@query("SELECT vec_id FROM embeddings WHERE vec_id % 3 > 0")
def vector_sync(s, d):
    rows = read(s, d, "embeddings")
    return emerge.missing_vectors(rows, rows.where("vec_id % 3 = 0"), "vec_id").select("vec_id")


@query("""SELECT c_custkey AS name, coalesce(have, 0) AS have, 2 AS wave FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS have FROM orders GROUP BY 1) ON o_custkey = c_custkey
WHERE coalesce(have, 0) < 12 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def next_wave(s, d):
    orders = read(s, d, "orders")
    counts = orders.groupBy(F.col("o_custkey").alias("name")).agg(F.count("*").alias("have"))
    queue = orders.select(F.col("o_custkey").alias("instance"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done").alias("status"))
    entities = read(s, d, "customer").select(F.col("c_custkey").alias("name"), F.col("c_mktsegment").alias("cluster"))
    return jobs.missing_work(entities, counts, queue, 12, 2).select("name", "have", "wave")


def _work(s, d) -> DataFrame:
    o = read(s, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"), (k % 3).cast("int").alias("wave"), (k % 10).cast("int").alias("rank"), F.col("o_orderpriority").alias("source"), F.concat(F.lit("u"), k % 500).alias("content_url"), F.lit(0).alias("attempts"),
        F.when(k % 7 == 0, "claimed").when(k % 2 == 0, "pending").otherwise("done").alias("status"), F.lit(None).cast("double").alias("next_try"), F.when(k % 7 == 0, F.lit(1000.0) - (k % 2) * 700).alias("claimed_at"),
    )


@query("""WITH q AS (SELECT o_orderkey AS id, o_orderkey % 3 AS wave, o_orderkey % 10 AS rank, o_orderpriority AS source, 'u' || (o_orderkey % 500) AS url, CASE WHEN o_orderkey % 7 = 0 THEN 'claimed' WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'done' END AS status, 1000.0 - (o_orderkey % 2) * 700 AS since FROM orders),
held AS (SELECT * FROM q WHERE status = 'claimed' AND since >= 400), waiting AS (SELECT * FROM q WHERE status = 'pending' OR (status = 'claimed' AND since < 400)),
r AS (SELECT w.source FROM (SELECT DISTINCT source FROM waiting) w LEFT JOIN (SELECT source, count(*) AS n FROM held GROUP BY 1) h USING (source) WHERE coalesce(n, 0) < 1000000 ORDER BY coalesce(n, 0), source LIMIT 3)
SELECT id, source FROM waiting WHERE source IN (SELECT source FROM r) AND url NOT IN (SELECT url FROM held) ORDER BY wave, rank, id LIMIT 50""")
def queue_claim(s, d):
    work = _work(s, d)
    caps = work.select("source").distinct().withColumn("cap", F.lit(1000000.0))
    return health.claim(work, caps, 1000.0, n=50, sources=3).select("id", "source")


@query("SELECT count(*) = 0 AS drained FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 2 = 0")
def queue_drained(s, d):
    return s.createDataFrame([(reports.drained(_work(s, d)),)], "drained boolean")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'done' END WHEN o_orderkey % 3 = 0 THEN 'done' ELSE 'pending' END AS status,
CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 3 > 0 THEN 1005.0::DOUBLE END AS next_try FROM orders""")
def queue_outcome(s, d):
    return health.outcome(_work(s, d), F.col("id") % 3 == 0, 1000.0).select("id", "status", "next_try")


@query("""SELECT s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'retired' ELSE 'active' END AS lifecycle, CASE WHEN s_suppkey % 2 = 0 THEN 'zh' ELSE 'en' END AS lang FROM supplier""")
def source_registry(s, d):
    base = read(s, d, "supplier")
    builtin = base.select(F.col("s_name").alias("name"), F.lit("active").alias("lifecycle"), F.lit("en").alias("lang"))
    even = base.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("name"), F.lit("probation").alias("lifecycle"), F.lit("zh").alias("lang"))
    later = base.select((F.col("s_suppkey") + 10**9).alias("seq"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, "retired").otherwise("active").alias("lifecycle"), F.lit(None).cast("string").alias("lang"))
    return health.registry(builtin, even.union(later), ["lifecycle", "lang"]).select("name", "lifecycle", "lang")


@query("""SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'a|' || c_mktsegment ELSE 'a' END AS aliases, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'found' WHEN c_custkey % 3 = 0 THEN '' ELSE 'own' END AS "desc" FROM customer""")
def knowledge_merge(s, d):
    c, k = read(s, d, "customer"), F.col("c_custkey")
    rows = c.select("c_custkey", F.col("c_name").alias("name"), F.array(F.lit("a")).alias("aliases"), F.when(k % 3 == 0, "").otherwise("own").alias("desc"))
    found = c.where(k % 2 == 0).select("c_custkey", F.array(F.lit("a"), "c_mktsegment").alias("aliases"), F.lit("found").alias("desc"))
    out = tree.enriched(rows, found, "c_custkey", ["aliases"], ["desc"])
    return out.select("name", joined("aliases").alias("aliases"), F.coalesce("desc", F.lit("")).alias("desc"))


@query("""SELECT asset_id, reject_reason FROM (SELECT l_orderkey || '-' || l_linenumber AS asset_id, CASE WHEN l_linenumber = 1 THEN 'not_https' WHEN l_linenumber = 2 THEN 'mime_not_allowed' WHEN l_linenumber = 3 THEN 'no_license' END AS reject_reason FROM lineitem)""")
def retry_failed(s, d):
    n = F.col("l_linenumber")
    rows = read(s, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("asset_id"), F.when(n == 1, "http://a.org/x").otherwise("https://a.org/x").alias("content_url"), F.when(n == 2, "text/html").otherwise("image/png").alias("declared_mime"),
        F.lit(None).cast("long").alias("declared_size"), F.when(n != 3, "CC BY").alias("license_raw"), F.lit(True).alias("source_authorized"), F.lit("old").alias("reject_reason"),
    )
    good, bad = collect.retry(rows, ["a.org"])
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad).select("asset_id", "reject_reason")


@query("""SELECT o_custkey AS instance, 's' || (o_orderkey % 3) AS source, o_orderkey AS asset_id, CAST(row_number() OVER (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY o_orderkey) - 1 AS INTEGER) AS source_rank FROM orders WHERE o_orderkey % 4 = 0""")
def board_posts(s, d):
    """Replies of image boards as candidates: one reply for each job, its posts in order."""
    o = read(s, d, "orders")
    rating = F.when(F.col("o_orderkey") % 4 == 0, "g").when(F.col("o_orderkey") % 4 == 1, "s").when(F.col("o_orderkey") % 4 == 2, "q")
    post = F.struct(F.col("o_orderkey").alias("id"), rating.alias("rating"), F.lit("https://x/y.jpg").alias("file_url"))
    replies = o.groupBy(F.col("o_custkey").alias("instance"), F.concat(F.lit("s"), F.col("o_orderkey") % 3).alias("source")).agg(F.to_json(F.array_sort(F.collect_list(post))).alias("document")).withColumn("query", F.lit("q"))
    rows = connectors.posts(replies, ratings=("g",), cap=10**6)
    place = ranking.with_rank(rows.withColumn("asset_id", F.col("asset_id").cast("long")).withColumn("source_rank", F.lit(None).cast("bigint")), ["instance", "source"], ["asset_id"])
    return place.select("instance", "source", "asset_id", F.col("source_rank").cast("int").alias("source_rank"))


# --- streams ---------------------------------------------------------------------


def _stream(s, d) -> DataFrame:
    """Events as a stream of a folder's files."""
    path = folder(s, "events")
    read(s, d, "events").write.parquet(path)
    return jobs.source(s, path, read(s, d, "events").schema)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(s, d):
    out = folder(s, "deduplicated")
    keys = jobs.deduplicated(_stream(s, d).select("user_id", "event_type"), ["user_id", "event_type"])
    jobs.flush(keys, lambda rows, _: rows.write.mode("append").parquet(out), folder(s, "checkpoint"), every=None).awaitTermination()
    return files.read_table(s, out)


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def stream_append(s, d):
    table = sinks.Snapshots(s, folder(s, "appended"))
    write = jobs.idempotent(table, "user_id", ["event_id"])

    def twice(rows: DataFrame, n: int) -> None:
        write(rows, n)
        write(rows, n)  # a batch that comes again changes nothing

    jobs.flush(_stream(s, d).select("user_id", "event_id"), twice, folder(s, "checkpoint"), every=None).awaitTermination()
    return table.read().select("user_id", "event_id")


@query("SELECT DISTINCT user_id AS sha256, true AS ok FROM events")
def stream_annotate(s, d):
    log = folder(s, "annotations")
    annotate = jobs.annotator(lambda rows: rows.select("sha256", F.lit(True).alias("ok")).distinct(), log)
    stream = _stream(s, d).select(F.col("user_id").alias("sha256"))
    jobs.flush(stream, lambda rows, n: (annotate(rows, n), annotate(rows, n)), folder(s, "checkpoint"), every=None).awaitTermination()
    return files.read_table(s, log)


@query("""SELECT event_type, event_id, coalesce(last_value(p IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), false) AS paused
FROM (SELECT *, CASE WHEN value * 20 >= 2000 THEN true WHEN value * 20 <= 500 THEN false END AS p FROM events)""")
def stream_backpressure(s, d):
    rows = read(s, d, "events").withColumn("level", F.col("value") * 20)
    return ranking.hysteresis(rows, ["event_type"], ["ts", "event_id"], "level").select("event_type", "event_id", "paused")


@query("""SELECT user_id, CAST((k - 1) // 50 AS BIGINT) AS flush, count(*) AS n FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) GROUP BY 1, 2""")
def flush_by_count(s, d):
    return ranking.in_flushes(read(s, d, "events"), ["user_id"], ["ts", "event_id"], "ts", 50, 10**9).groupBy("user_id", "flush").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (SELECT user_id, k, t AS opened, 1 AS n, 0 AS flush FROM e WHERE k = 1 UNION ALL
SELECT e.user_id, e.k, CASE WHEN r.n >= 5 OR e.t - r.opened >= 600 THEN e.t ELSE r.opened END, CASE WHEN r.n >= 5 OR e.t - r.opened >= 600 THEN 1 ELSE r.n + 1 END, CASE WHEN r.n >= 5 OR e.t - r.opened >= 600 THEN r.flush + 1 ELSE r.flush END
FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)
SELECT user_id, CAST(flush AS BIGINT) AS flush, count(*) AS n FROM r GROUP BY 1, 2""")
def flush_by_count_or_time(s, d):
    return ranking.in_flushes(read(s, d, "events"), ["user_id"], ["ts", "event_id"], "ts", 5, 600).groupBy("user_id", "flush").agg(F.count("*").alias("n"))


@query("SELECT event_type AS kind, count(*) AS n, round(count(*) / nullif(epoch(max(ts)) - epoch(min(ts)), 0), 3) AS qps, count(*) FILTER (event_id % 6 = 0) AS http_503, count(*) FILTER (event_id % 6 = 1) AS timeout FROM events GROUP BY 1")
def request_rates(s, d):
    k = F.col("event_id") % 6
    rows = read(s, d, "events").select(F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").cast("double").alias("at"), F.when(k == 0, "http_503").when(k == 1, "timeout").alias("failure"))
    return reports.request_rates(rows, "kind", "at", "failure", ["http_503", "timeout"])


# --- composed plans ---------------------------------------------------------------


@query("""WITH v AS (SELECT l_orderkey, l_partkey, CASE WHEN contains(p_name, 'red') THEN 'match' ELSE CASE l_linenumber % 3 WHEN 0 THEN 'match' WHEN 1 THEN 'mismatch' ELSE 'inconclusive' END END AS verdict, l_linenumber, l_returnflag, l_suppkey
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'A')
SELECT CASE WHEN l_linenumber <= 3 THEN '0-3' WHEN l_linenumber <= 6 THEN '4-6' ELSE '7-10' END AS band, count(*) AS n, count(*) FILTER (verdict = 'match') AS hits, round(count(*) FILTER (verdict = 'match') / nullif(count(*) FILTER (verdict <> 'inconclusive'), 0), 3) AS rate FROM v GROUP BY 1""")
def retrieval_probe(s, d):
    rows = read(s, d, "lineitem")
    one = F.concat(F.lit("i"), F.col("l_suppkey") % 9)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    m = rows.select(key.alias("sha256"), F.array(one).alias("instances"), F.col("l_linenumber").alias("kb_match"), F.col("l_returnflag").alias("source"), F.create_map(one, F.lit("q")).alias("queries"), F.create_map(one, F.col("l_partkey").cast("string")).alias("asset_ids"))
    payloads = read(s, d, "part").select(F.col("p_partkey").cast("string").alias("asset_id"), F.when(F.col("p_name").contains("red"), "red").otherwise("zzz").alias("characters"))
    names = s.createDataFrame([(f"i{i}", ["red"]) for i in range(9)], "instance string, names array<string>")
    judge = F.when(F.col("kb_match") % 3 == 0, "match").when(F.col("kb_match") % 3 == 1, "mismatch").otherwise("inconclusive")
    return probes.retrieval(m, payloads, "A", names, judge)


@query("""WITH e AS (SELECT label, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2),
c AS (SELECT label, list(m ORDER BY i) AS v FROM m GROUP BY 1), t AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE vec_id % 50 = 0),
p AS (SELECT c.label, t.vec_id, list_sum(list_transform(list_zip(c.v, t.v), lambda z: z[1] * z[2])) / (sqrt(list_sum(list_transform(c.v, lambda x: x * x))) * sqrt(list_sum(list_transform(t.v, lambda x: x * x))) + 1e-9) AS s FROM c, t),
b AS (SELECT label, arg_max(vec_id, (s, -vec_id)) AS vec_id, max(s) AS s FROM p GROUP BY 1), z AS (SELECT label, count(*) AS size FROM embeddings GROUP BY 1)
SELECT label, size, CAST(row_number() OVER (ORDER BY size DESC, label) - 1 AS INTEGER) AS rank, vec_id AS nearest, CASE WHEN s >= 0.5 THEN 'existing' ELSE 'new' END AS verdict FROM b JOIN z USING (label)""")
def emergence(s, d):
    v = read(s, d, "embeddings").withColumnRenamed("label", "cluster_id")
    known = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("name"), "embedding")
    out = emerge.concepts(v, known, least=0.5)
    return out.select(F.col("cluster_id").alias("label"), "size", "rank", "nearest", "verdict")

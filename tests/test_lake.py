"""Sources, sinks, merges and plans on small tables."""

import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from siltworks.operators import gates, manifest, ranking
from siltworks.plans import bulk, coverage, emerge, health, probes, reports, tree
from siltworks.schemas import ENTITY, MANIFEST, POST, schema
from siltworks.sources import connectors, files, sinks, spec


def lines(path, rows, tail=""):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows) + tail)
    return f"file://{path}"


def test_manifest_scan_and_torn_line(spark, tmp_path):
    p = lines(tmp_path / "m.jsonl", [{"sha256": "a", "width": 3, "other": 1}, {"sha256": "b"}], '\n{"sha256": "c", "wid')
    assert {r["sha256"] for r in files.read_manifest(spark, p, tolerant=True).select("sha256", "width").collect()} == {"a", "b"}
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_manifest(spark, p).collect()


def test_dump_of_a_cut_archive(spark, tmp_path):
    body = "".join(json.dumps({"id": i, "rating": "g", "score": i}) + "\n" for i in range(3000)).encode()
    whole = io.BytesIO()
    with tarfile.open(fileobj=whole, mode="w:gz") as t:
        for name, data in (("readme", b"x"), ("./posts.json", body)):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    (tmp_path / "d.tar.gz").write_bytes(whole.getvalue())
    assert files.read_dump(spark, f"file://{tmp_path}/d.tar.gz", "posts.json", POST).count() == 3000
    (tmp_path / "e.tar.gz").write_bytes(whole.getvalue()[: len(whole.getvalue()) // 2])
    assert 0 < files.read_dump(spark, f"file://{tmp_path}/e.tar.gz", "posts.json", POST).count() < 3000


def test_entities_urls_and_runs(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps({"instances": [{"name": "a", "query": ["q", "r"], "aliases": ["x"]}, {"name": "a", "query": ["s"]}, {"name": "b", "query": "one"}, {"query": ["z"]}]}))
    assert {(r["name"], tuple(r["query"])) for r in files.read_entities(spark, f"file://{tmp_path}/i.json").collect()} == {("a", ("q", "r")), ("b", ("one",))}
    (tmp_path / "u.txt").write_text('# c\nhttps://a\n\n{"url": "https://b"}\n{"content_url": "https://c"}\n')
    assert [r[0] for r in files.read_urls(spark, f"file://{tmp_path}/u.txt").collect()] == ["https://a", "https://b", "https://c"]
    for run, v in (("r2", "late"), ("r1", "")):
        (tmp_path / "runs" / run).mkdir(parents=True)
        lines(tmp_path / "runs" / run / "ok.jsonl", [{"sha256": "a", "instance": "i", "query": v}])
    rows = files.read_runs(spark, f"file://{tmp_path}/runs/*/ok.jsonl", schema("sha256 string, instance string, query string"))
    assert files.first_per_instance(rows, "query").first()["query"] == "late"
    assert files.text_counts(spark, f"file://{tmp_path}/runs/*/ok.jsonl", "instance").first()["n"] == 2


def test_upsert_merges_and_append_skips(spark, tmp_path):
    new = lambda *rows: spark.createDataFrame([{"sha256": s, "source": o, "instances": i, "queries": q} for s, o, i, q in rows], schema("sha256 string, source string, instances array<string>, queries map<string,string>"))
    table = sinks.Snapshots(spark, f"file://{tmp_path}/t")
    assert table.read() is None
    sinks.upsert(table, new(("a", "one", ["x"], {"x": "1"}), ("b", "one", None, None)))
    sinks.upsert(table, new(("a", "two", ["y", "x"], {"x": "2", "y": "3"}), ("c", "two", ["z"], {"z": "4"})))
    got = {r["sha256"]: r for r in table.read().collect()}
    assert (got["a"]["source"], got["a"]["instances"], got["a"]["queries"]) == ("one", ["x", "y"], {"x": "1", "y": "3"})
    assert set(got) == {"a", "b", "c"} and got["b"]["instances"] == []
    sinks.append_unseen(table, new(("a", "three", ["w"], {}), ("d", "three", ["w"], {})))
    got = {r["sha256"]: r["source"] for r in table.read().collect()}
    assert got == {"a": "one", "b": "one", "c": "two", "d": "three"}
    sinks.append_unseen(table, new(("d", "four", ["w"], {})))
    assert table.read().count() == 4
    sets = lambda: {p.name: {f.name for f in p.iterdir()} for p in (tmp_path / "t").glob("data-*")}
    before = sets()
    sinks.append_unseen(table, new(("e", "five", ["w"], {}), (None, "five", None, None)))
    after = sets()
    assert before.items() < after.items()  # nothing written again
    assert table.read().count() == 5
    table.vacuum(1)
    assert table.read().count() == 5 and len(sets()) < len(after)


def test_blobs_and_table(spark, tmp_path):
    df = spark.createDataFrame([("abcd", "png", b"1"), ("abce", "", b"2"), ("zz", "gif", None)], "sha256 string, ext string, data binary")
    for _ in range(2):
        sinks.write_blobs(df, str(tmp_path))
    found = files.read_blobs(spark, f"file://{tmp_path}/blobs")
    assert found.count() == 2
    sinks.write_table(df.drop("data"), f"file://{tmp_path}/mirror", blobs=found)
    assert {(r["sha256"], bytes(r["blob"]) if r["blob"] else None) for r in files.read_table(spark, f"file://{tmp_path}/mirror").collect()} == {("abcd", b"1"), ("abce", b"2"), ("zz", None)}


def test_rewrite_keeps_bad_lines(spark, tmp_path):
    p = lines(tmp_path / "m.jsonl", [{"a": 1}, {"a": 2}], "bad line\n")
    sinks.rewrite_lines(spark, p, f"file://{tmp_path}/out", F.lit('{"a": 9}'), F.get_json_object("value", "$.a") == "2")
    assert [r[0] for r in spark.read.text(f"file://{tmp_path}/out").collect()] == ['{"a": 1}', '{"a": 9}', "bad line"]
    many = tmp_path / "many"
    many.mkdir()
    for k in (2, 0, 1):
        lines(many / f"{k}.jsonl", [{"a": 1000 * k + i} for i in range(50)], "torn {\n")
    sinks.rewrite_lines(spark, f"file://{many}", f"file://{tmp_path}/all", F.lit("{}"), F.get_json_object("value", "$.a") == "1007")
    got = "".join(p.read_text() for p in sorted((tmp_path / "all").glob("part-*")))
    want = "".join((many / f"{k}.jsonl").read_text() for k in range(3))
    assert got == want.replace('{"a": 1007}', "{}")


def test_gates_in_order(spark):
    rows = [(None, "image/png", 1, "CC0"), ("http://a.com/x", "image/png", 1, "CC0"), ("https://b.org/x", "image/png", 1, "CC0"), ("https://x.a.com/x", None, 1, "CC0"), ("https://a.com/x", "text/html", 1, "CC0"),
            ("https://a.com/x", "image/png", 1 << 30, "CC0"), ("https://a.com/x", "image/png", None, ""), ("https://a.com/x", "image/png", 1, "ARR"), ("https://a.com/x", "image/png", 1, "cc-by-nc 2.0")]
    df = spark.createDataFrame(rows, "u string, m string, s long, l string").coalesce(1)
    got = [r[0] for r in df.select(gates.authorized_reason(F.col("u"), F.col("m"), F.col("s"), F.col("l"), ["a.com"])).collect()]
    assert got == ["no_url", "not_https", "host_not_allowed", "no_mime", "mime_not_allowed", "too_large", "no_license", "license_not_allowed", None]
    good, bad = gates.split(df, gates.unauthorized_reason(F.col("u"), F.col("m"), F.col("s")))
    assert (good.count(), bad.count()) == (5, 4)


def test_select_puts_nulls_last_and_limits_after_the_order(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, 7)], "id int, width int")
    assert [r["id"] for r in gates.select_where(df, order_by="width", descending=True, limit=2).collect()] == [3, 4]
    assert [r["id"] for r in gates.select_where(df, order_by="width", descending=True).collect()][-1] == 2
    plan = gates.select_where(df, order_by="width", limit=2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_spec(spark):
    reply = {"data": {"hits": [{"id": 1, "img": {"url": ""}, "alt": "https://x.com/a.png?z", "tags": ["t", "u"], "safe": "y"}, {"id": "x", "img": {"url": "https://y.com/b"}, "ext": "JPG", "safe": "y", "tags": []}, {"id": 3, "safe": "n"}, "text"]}}
    plan = {"record": {"items": "$.data.hits[*]", "filters": [{"path": "$.safe", "in": ["y"]}], "fields": {
        "asset_id": "$.id", "content_url": "$.img.url | $.alt", "width": {"path": "$.id", "transform": "int"}, "author": {"path": "$.tags", "transform": "first"},
        "landing_url": {"template": "https://s.com/{id}/{img.none}"}, "license": {"const": "CC0"}, "mime": {"by": "$.ext", "transform": "mime_by_ext", "fallback_ext_of": "$.alt"}}}}
    df = spark.createDataFrame([("s", json.dumps(reply))], "source string, document string")
    got = [(r["asset_id"], r["content_url"], r["width"], r["author"], r["landing_url"], r["license"], r["mime"]) for r in spec.compile_source(df, plan).orderBy("source_rank").collect()]
    assert got == [("1", "https://x.com/a.png?z", 1, "t", "https://s.com/1/", "CC0", "image/png"), ("x", "https://y.com/b", None, None, "https://s.com/x/", "CC0", "image/jpeg")]
    with pytest.raises(ValueError):
        spec.project(df, {"fields": {"nonsense": "$"}}, "document")
    r = spark.range(1).select(spec.request(F.lit("Big Dog"), F.lit(30), {"search": {"url": "https://s.com/q", "params": {"q": "{query}"}, "query_transform": "lower_underscore", "page_size": {"param": "n", "factor": 2, "floor": 5, "cap": 50}}}).alias("r")).first()["r"]
    assert (r["url"], r["page_size"]) == ("https://s.com/q?q=big_dog&n=50", 50)


def test_connectors(spark):
    reply = lambda d: spark.createDataFrame([("s", "i", "q", json.dumps(d))], "source string, instance string, query string, document string")
    info = lambda w, u: {"width": w, "height": 5, "url": u, "extmetadata": {"Artist": {"value": "<b>A</b>"}, "LicenseShortName": {"value": "CC0"}}}
    wiki = {"query": {"pages": {"1": {"index": 2, "title": "B", "imageinfo": [info(4, "https://b")]}, "2": {"index": 1, "title": "A", "imageinfo": [info(4, "https://a")]}, "3": {"index": 3, "title": "C"}}}}
    assert [(r["asset_id"], r["author"], r["license_raw"]) for r in connectors.file_pages(reply(wiki)).orderBy("source_rank").collect()] == [("A", "A", "CC0"), ("B", "A", "CC0")]
    nature = {"results": [{"license_code": "cc0", "photos": [{"id": 1, "url": "https://p/1/square.jpg", "license_code": "cc-by"}, {"id": 2, "url": "https://p/2/square.jpg"}]}]}
    assert {(r["content_url"], r["license_raw"]) for r in connectors.observations(reply(nature)).collect()} == {("https://p/1/original.jpg", "cc-by"), ("https://p/2/original.jpg", "cc0")}
    board = [{"id": 1, "rating": "g", "file_url": "https://f/1.png"}, {"id": 2, "rating": "e", "file_url": "https://f/2.png"}, {"id": 3, "rating": "s", "file_url": "http://f/3.png"}]
    assert [r["asset_id"] for r in connectors.posts(reply(board)).collect()] == ["1"]
    ratings = [{"id": i, "rating": r, "file_url": "https://f/1.png"} for i, r in enumerate(["g", "s", "general", "safe", "sensitive", "q"])]
    for board, want in (("danbooru", {"0"}), ("gelbooru", {"2", "3"})):
        got = connectors.posts(reply(ratings).withColumn("source", F.lit(board)))
        assert {r["asset_id"] for r in got.collect()} == want
    found = {"data": [{"hoverURL": "", "middleURL": "http://m/x.jpg?w=10&h=20", "width": 0}, {"objURL": "https://o/y.jpg", "width": 3, "height": 4}, {"objURL": "https://o/y.jpg"}, {}]}
    assert {(r["content_url"], r["declared_width"]) for r in connectors.image_results(reply(found)).collect()} == {("https://m/x.jpg?w=10&h=20", 10), ("https://o/y.jpg", 3)}
    jobs = spark.createDataFrame([("i", "red dog"), ("j", "cat")], "instance string, query string")
    rows = spark.createDataFrame([(str(k), c) for k, c in enumerate(["a red big dog", "red cat", "cats", "blue"])], "asset_id string, caption string")
    assert {(r["instance"], r["asset_id"]) for r in connectors.captioned(rows, jobs, 1).collect()} == {("i", "0"), ("j", "1")}
    assert list(connectors.paged_rows(lambda o, n: [{"o": i} for i in range(o, min(o + n, 250))], 0, 1000))[-1] == {"o": 249}


def test_search_source(spark):
    connectors.register("stub", lambda job: [{"document": job["query"].upper()}])
    spark.dataSource.register(connectors.SearchSource)
    jobs = json.dumps([{"source": "s", "instance": "i", "query": q} for q in ("a", "b")])
    assert {r["document"] for r in spark.read.format("search").option("fetcher", "stub").option("jobs", jobs).load().collect()} == {"A", "B"}


def test_seeds(spark):
    e = spark.createDataFrame([("名", ["Na me"], ["x"], None, None), ("Two", [], [], None, None)], ENTITY)
    chosen = spark.createDataFrame([("名", "Na me"), ("Two", "made up")], "name string, latin string")
    assert {tuple(r) for r in connectors.seeds(e, chosen).collect()} == {("名", "名", "zh"), ("名", "Na me", "latin"), ("Two", "Two", "latin")}


def test_tree(spark, tmp_path):
    doc = {"tree": {"name": "r", "children": [{"name": "a", "instances": ["x", {"name": "y"}], "children": [{"name": "dead"}]}, {"name": "b", "instances": ["x"], "knowledge_intro": "k"}]}}
    (tmp_path / "t.json").write_text(json.dumps(doc))
    t = tree.read_tree(spark, f"file://{tmp_path}/t.json").cache()
    assert {r["path"] for r in t.collect()} == {"r", "r / a", "r / a / dead", "r / b"}
    assert {r["name"]: r["paths"] for r in tree.mounts(t).collect()} == {"x": ["r / a", "r / b"], "y": ["r / a"]}
    assert [r["path"] for r in tree.dead_leaves(t).collect()] == ["r / a / dead"]
    verdicts = spark.createDataFrame([("r / a / dead", "delete"), ("r / b", "delete")], "path string, verdict string")
    assert tree.pruned(t, verdicts).count() == 3
    found = spark.createDataFrame([("r / b", ["n"] * 2 + [str(i) for i in range(20)], "new")], "path string, aliases array<string>, knowledge_intro string")
    r = tree.enriched(t, found, "path", ["aliases"], ["knowledge_intro"]).where("path = 'r / b'").first()
    assert len(r["aliases"]) == 10 and r["knowledge_intro"] == "k"


def test_health(spark):
    ledger = spark.createDataFrame([("weak", 9, 0, 0, 40, 30, 0, 5), ("ok", 9, 0, 5, 0, 0, 0, 5), ("bad", 5, 20, 5, 0, 0, 0, 5), ("new", 9, 0, 0, 0, 0, 0, 1)], "source string, search_ok long, search_fail long, dl_ok long, dl_fail long, dl_dead long, dl_timeout long, runs long")
    cards = spark.createDataFrame([("weak", "probation", "llm", True, 0), ("ok", "probation", "llm", True, 0), ("bad", "active", "hand", True, 0), ("new", "probation", "llm", True, 0), ("gone", "degraded", "llm:x", False, 0), ("hand", "degraded", "hand", False, 0)], "name string, lifecycle string, provenance string, has_proposal boolean, repairs int")
    assert {(r["name"], r["after"]) for r in health.moves(cards, ledger).collect()} == {("weak", "degraded"), ("ok", "active"), ("bad", "degraded"), ("gone", "retired")}
    paths = spark.createDataFrame([("d/a.v2.json",), ("d/a.v10.json",), ("d/readme",)], "path string")
    assert [tuple(r) for r in health.newest_specs(paths).collect()] == [("a", 10, "d/a.v10.json")]
    events = spark.createDataFrame([(1, "a", "probation", "x"), (2, "a", None, "y"), (3, "b", "active", None)], "seq int, name string, lifecycle string, lang string")
    builtin = spark.createDataFrame([("a", "active", "z"), ("c", "active", "z")], "name string, lifecycle string, lang string")
    assert {tuple(r) for r in health.registry(builtin, events, ["lifecycle", "lang"]).collect()} == {("a", "probation", "y"), ("b", "active", None), ("c", "active", "z")}


def test_queue(spark):
    q = "id long, wave int, instance string, source string, content_url string, rank int, attempts int, status string, next_try double, claimed_at double, updated_at double"
    rows = [(1, 0, "i", "a", "u1", 0, 0, "pending", 0.0, None, 0.0), (2, 0, "i", "a", "u2", 1, 3, "pending", 0.0, None, 0.0), (3, 0, "j", "b", "u3", 0, 1, "claimed", 0.0, 100.0, 0.0), (4, 0, "j", "b", "u4", 2, 0, "claimed", 0.0, 950.0, 0.0),
            (5, 1, "j", "c", "u4", 0, 0, "pending", 0.0, None, 0.0), (6, 0, "k", "d", "u6", 0, 0, "pending", 2000.0, None, 0.0)]
    df = spark.createDataFrame(rows, q)
    caps = spark.createDataFrame([("a", 4.0)], "source string, cap double")
    assert [r["id"] for r in health.claim(df, caps, 1000.0).collect()] == [1, 3]
    after = {r["id"]: (r["status"], r["attempts"]) for r in health.outcome(df, F.col("id") == 4, 1000.0).collect()}
    assert after[4] == ("done", 1) and after[3] == ("pending", 2) and after[1] == ("pending", 0)
    assert not reports.drained(df)


def test_bulk(spark):
    e = spark.createDataFrame([("Big Dog", ["big dog"], ["hound"], None, None), ("红", None, ["red_one"], None, None)], ENTITY)
    p = lambda i, score, tags, pix, **kw: {"id": i, "rating": "g", "score": score, "file_ext": "png", "image_width": 900, "image_height": 900, "tag_string": tags, "tag_string_character": kw.get("c"), "media_asset": {"pixel_hash": pix}, "is_deleted": False, "is_flagged": False, "is_pending": False}
    posts = spark.createDataFrame([p(1, 50, "hound big_dog", "A", c="x hound"), p(2, 40, "hound", "A", c="hound"), p(3, 30, "hound", "B"), p(4, 20, "hound", "C"), p(5, 5, "hound", "D"), p(6, 60, "lowres red_one", "E"), p(8, 49, "red_one", "A"), p(9, 14, "sketch red_one", "F"), p(7, 15, "red_one", None)], POST)
    index = bulk.tag_index(e)
    assert {r["tag"] for r in index.collect()} == {"big_dog", "hound", "red_one"}
    got = {(r["instance"], r["id"], r["matched_tag"]) for r in bulk.by_instance(posts, index, 3).collect()}
    assert got == {("Big Dog", 1, "big_dog"), ("Big Dog", 3, "hound"), ("红", 7, "red_one"), ("红", 9, "red_one")}  # 8 has the pixels of 1
    assert {(r["character"], r["id"]) for r in bulk.representatives(posts, index).collect()} == {("hound", 1)}


def test_manifest_projections(spark):
    m = spark.createDataFrame([{"sha256": "ab", "ext": "png", "source": "s", "instances": ["i", "j"], "queries": {"i": "q"}, "path": "/old/root/blobs/ab/ab.png", "kb_match": 5}], MANIFEST)
    back = manifest.candidate_of_row(m)
    assert {(r["instance"], r["query"]) for r in back.select("instance", "query").collect()} == {("i", "q"), ("j", None)}
    assert m.select(gates.relative_path(F.col("path"), "/new")).first()[0] == "blobs/ab/ab.png"
    assert manifest.row_of_candidate(back.withColumns({c: F.lit(None).cast("string") for c in ("source_kind", "landing_url")} | {"declared_width": F.lit(3), "tier": F.lit(1).cast("long")})).count() == 2


def test_probes_and_reports(spark):
    names = spark.createDataFrame([("i", ["anya"])], "instance string, names array<string>")
    rows = spark.createDataFrame([("a", "i", "anya_(x)"), ("a", "i", "yor"), ("b", "z", "yor")], "sha256 string, instance string, characters string")
    assert sorted(str(r["verdict"]) for r in probes.ruled(rows, names).collect()) == ["None", "None", "match"]
    assert "| a |" in reports.text_table(spark.createDataFrame([(1,)], "a int"), "t")
    sizes = spark.createDataFrame([("a", x) for x in [5, 1, 3, 2]], "g string, n int")
    assert tuple(reports.caption_lengths(sizes, F.col("n")).first()) == (4, 1, 3, 5)


def test_vectors(spark):
    v = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(20)], "vec_id long, embedding array<float>")
    assert emerge.checked(v, 2).count() == 20
    with pytest.raises(Exception, match="another length"):
        emerge.checked(v, 3).collect()
    assert emerge.clusters(v, 5).select("cluster_id").distinct().count() == 5
    e = spark.createDataFrame([("A b", ["x"], ["C"], None, None)], ENTITY)
    c = spark.createDataFrame([("ab",), ("c",), ("no",)], "concept string")
    assert {tuple(r) for r in emerge.named_entities(c, e).collect()} == {("ab", "A b"), ("c", "A b"), ("no", None)}


def test_stratified_and_batches(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 120).alias("score"))
    got = ranking.stratified(df, "k", "score", [(10, 30, 0.5), (30, 100, 0.35), (100, 10**9, 0.15)], 40)
    assert {r["stratum"]: r["n"] for r in got.groupBy("stratum").agg(F.count("*").alias("n")).collect()} == {0: 20, 1: 14, 2: 6}
    rows = spark.createDataFrame([(f"g{g}", i) for g, n in enumerate([100, 30, 30, 30, 5]) for i in range(n)], "g string, i int")
    sizes = sorted(r["n"] for r in ranking.batches(rows, "g", "i").groupBy("batch").agg(F.count("*").alias("n")).collect())
    assert sizes == [20, 35, 60, 80]


def test_coverage_modes_reject_unknown(spark):
    with pytest.raises(ValueError):
        coverage.classify(spark.range(1), spark.range(1), "other", 1)


def test_structure_and_containers(spark):
    rows = spark.createDataFrame([(1, 1, "https://x/a.TIFF?y", None), (1, None, "https://x/a", "image/x"), (3, 4, "https://x/a.html", None)], "width int, height int, content_url string, mime string")
    r = gates.structure(rows).first()
    assert (r["n"], round(r["with_size"], 3), round(r["with_image_url"], 3), r["passes"]) == (3, 0.667, 0.667, True)
    shapes = {'{"data": [1], "results": [2]}': "$.results", '{"docs": []}': "$.docs", "[]": "$", '{"data": {"hits": [1]}, "items": [2]}': "$.data.hits", '{"list": [1]}': None, '{"results": {"x": 1}, "posts": [3]}': "$.posts"}
    got = {r[0]: r[1] for r in spark.createDataFrame([(s,) for s in shapes], "d string").select("d", spec.container(F.col("d"))).collect()}
    assert got == shapes


def test_flushes_and_pauses(spark):
    rows = [("a", i, float(t)) for i, t in enumerate([0, 1, 2, 70, 71, 140, 141, 142, 143])] + [("b", i, float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, i int, t double")
    got = {(r["k"], r["i"]): r["flush"] for r in ranking.in_flushes(df, ["k"], ["i"], "t", 3, 60).collect()}
    assert [got["a", i] for i in range(9)] == [0, 0, 0, 1, 1, 2, 2, 2, 3]
    assert [got["b", i] for i in range(7)] == [0, 0, 0, 1, 1, 1, 2]
    levels = spark.createDataFrame([(0, i, v) for i, v in enumerate([100, 1999, 2000, 1500, 501, 500, 1999, 2500])], "g int, i int, v int")
    assert [r["paused"] for r in ranking.hysteresis(levels, ["g"], ["i"], "v").orderBy("i").collect()] == [False, False, True, True, True, False, False, True]


def test_lowest_scores(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", 1), ("d", 1)], "k string, v int")
    assert [r["k"] for r in reports.lowest(df, "v", "k", 2).collect()] == ["c", "d"]

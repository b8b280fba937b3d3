import html
import struct

from pyspark.sql import functions as F

from siltworks.functions import media, text, urls, values
from siltworks.operators import gates


def one(spark, **cols):
    return tuple(spark.range(1).select(*(c.alias(k) for k, c in cols.items())).first())


def col(values_):
    return F.array(*(F.lit(v) for v in values_))


def test_names(spark):
    assert one(spark, a=text.entity_name(F.lit(" 《红楼梦》（电视剧） ")), b=text.has_cjk(F.lit("a红")), c=text.has_cjk(F.lit("abc")), d=text.query_kind(F.lit("anya_(x)")), e=text.query_kind(F.lit("红")), f=text.query_kind(F.lit("plain"))) == ("红楼梦", True, False, "tag", "cjk", "plain")
    assert one(spark, a=text.tag_name(F.lit(" Big-Red  Dog ")), b=text.bare_name(F.lit("anya_(spy_x_family)")), c=text.plain_name(F.lit("A__b-c")), d=text.is_tag(F.lit("ab")), e=text.is_tag(F.lit("abc_1")), f=text.is_tag(F.lit("12345"))) == ("big_red_dog", "anya", "a b c", False, True, False)


def test_matches(spark):
    names = col(["anya forger", "loid"])
    assert one(spark, a=text.names_match(col(["anya_(spy_x_family)"]), names), b=text.names_match(col(["yor"]), names), c=text.names_match(col([""]), names)) == (True, False, False)
    judge = lambda a, t: text.answer_match(F.lit(a), F.lit(t))
    assert one(spark, a=judge("", "asuna"), b=judge("Asuna SAO", "asuna_(sao)"), c=judge("someone", "asuna"), d=judge("yuuki asuna", "asuna")) == (False, True, None, True)


def test_aliases(spark):
    pools = text.alias_pools(F.lit("《名》(注)"), col(["b c", "《a》", "中"]), col(["zz", "b c", " "]))
    assert one(spark, a=pools["latin"], b=pools["cjk"]) == (["zz", "b c", "《a》"], ["中", "名"])
    assert one(spark, a=text.latin_candidates(col(["Ab", "中", "aB", "c", "1"]), 8))[0] == ["Ab", "c"]
    assert one(spark, a=text.clean_list(text.split_list(F.lit("a、b/ a,c")), ["a", "c"], 1))[0] == ["a"]
    assert one(spark, a=text.knowledge_block(F.lit("n"), col(["x", "y"]), F.lit("d" * 300)))[0] == "n\naliases: x, y\n" + "d" * 250 + "…"


def test_paths(spark):
    assert one(spark, a=text.leaf(F.lit("r / p / l")), b=text.parent(F.lit("r / p / l")), c=text.parent(F.lit("l")), d=text.cluster_of(col(["r / c / x"])), e=text.cluster_of(F.array().cast("array<string>"))) == ("l", "p", "", "c", "(unmounted)")


def test_html(spark):
    page = '<IMG data-src="http://x.com/a.jpg?x=1&amp;y" src="https://x.com/b.png"><img src="https://x.com/logo.png"><img src="/rel.png"><source srcset="https://x.com/c.webp 1x, https://x.com/d.gif 2x"><img src="https://y.com/e.jpeg"><img src="https://y.com/e.jpeg">'
    assert one(spark, a=urls.images(F.lit(page)))[0] == ["http://x.com/a.jpg?x=1&y", "https://y.com/e.jpeg", "https://x.com/c.webp"]
    assert one(spark, a=urls.images(F.lit(page), ("y.com",), 2, upgrade=True))[0] == ["https://y.com/e.jpeg", "https://x.com/a.jpg?x=1&y"]
    coded = "a &amp; b &#39;c&#39; &eacute;"
    assert spark.createDataFrame([(coded,), (None,)], "s string").select(text.unescape("s")).collect()[0][0] == html.unescape(coded)


def test_urls(spark):
    u = F.lit("https://Img.Example.com/a/square.JPG?w=10&h=20")
    dims = urls.query_dims(u)
    assert one(spark, a=urls.host(u), b=urls.extension(u), c=dims["w"], d=dims["h"], e=urls.host_in(u, ["example.com"]), f=urls.host_in(u, ["ample.com"]), g=urls.mime_by_extension(F.lit(None), u)) == ("img.example.com", "jpg", 10, 20, True, False, "image/jpeg")
    sample = '{"u":"https://z.com/x.jpg","v":["https://b.com/y.TIFF?q=1","http://c.com/y.png","https://b.com/w.bmp"],"w":"https://d.com/page"}'
    assert one(spark, a=urls.media_hosts(F.lit(sample)))[0] == ["b.com", "z.com"]
    assert one(spark, a=urls.media_hosts(F.lit('{"u":"https://a.com/x.jpg","v":"https://b.com/y.png"}')), b=urls.robots_allow(F.lit("/x/y"), col(["/x"])))[0] == ["a.com", "b.com"]


def test_values(spark):
    assert one(spark, a=values.safe_int(F.lit(" 7 ")), b=values.safe_int(F.lit("x")), c=values.safe_int(F.lit("x"), 0), d=values.clamp(F.lit(12)), e=values.clamp(F.lit(None).cast("int"))) == (7, None, 0, 10, None)
    assert one(spark, a=values.nearest_rank(col([4, 1, 3, 2]), 0.5), b=values.upper_median(col([4, 1, 3, 2])), c=values.nearest_rank(F.array().cast("array<int>"), 0.5), d=values.backoff(F.lit(9)), e=values.mirror_loss(F.lit(8.0), F.lit(10.0))) == (3, 3, None, 120.0, 20.0)
    assert one(spark, a=values.blob_path(F.lit("abcd"), F.lit(".png")), b=values.blob_path(F.lit("abcd"), F.lit(""))) == ("blobs/ab/abcd.png", "blobs/ab/abcd.jpg")
    assert round(one(spark, a=values.cosine(col([1.0, 0.0]), col([1.0, 1.0])))[0], 6) == 0.707107


def test_replies(spark):
    caption = "c" * 45
    good = 'well {"kb_match": 12, "richness": 3, "caption": "%s", "identity": true} end' % caption
    r = values.annotation(F.lit(good), need_identity=True)
    assert one(spark, a=r["kb_match"], b=r["richness"], c=r["caption"], d=r["identity"]) == (10, 3, caption, True)
    assert one(spark, a=values.annotation(F.lit(good.replace("true", '"yes"')), need_identity=True), b=values.annotation(F.lit(good.replace(caption, "short"))), c=values.annotation(F.lit("nothing"))) == (None, None, None)
    v = values.verdict(F.lit('x {"verdict": "DROP", "score": "3", "issues": ["a"], "reason": "r"}'))
    w = values.verdict(F.lit('{"verdict": "perhaps"}'))
    assert one(spark, a=v["verdict"], b=v["score"], c=v["issues"], d=w["verdict"], e=w["issues"]) == ("drop", 3, ["a"], "uncertain", [])


PNG = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480) + b"rest"
JPEG = b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"J" * 14 + b"\xff\xc0" + struct.pack(">HBHH", 17, 8, 48, 64) + b"more data"


def test_media(spark):
    df = spark.createDataFrame([(1, PNG), (2, JPEG), (3, b"GIF89a" + struct.pack("<HH", 5, 6)), (4, b"no image"), (5, None)], "i int, data binary")
    got = {r["i"]: (r["m"]["mime"], r["m"]["width"], r["m"]["height"], r["s"]) for r in df.select("i", media.inspect("data").alias("m"), values.sniffed("data").alias("s")).collect()}
    assert got[1] == ("image/png", 640, 480, "image/png") and got[2] == ("image/jpeg", 64, 48, "image/jpeg") and got[3][:3] == ("image/gif", 5, 6)
    assert got[4][3] is None and got[5][0] is None


def test_models(spark):
    rows = spark.createDataFrame([(i, f"p{i % 3}") for i in range(10)], "i int, p string")
    answer = lambda batch: [None if x == "p1" else x.upper() for x in batch]
    assert {(r["p"], r["reply"]) for r in media.call_model(rows, "p", answer).collect()} == {("p0", "P0"), ("p1", None), ("p2", "P2")}
    assert media.call_once(rows, ["p"], "p", answer).count() == 10

    def fails(batch):
        raise OSError

    assert media.call_model(rows, "p", fails).where("reply IS NULL").count() == 10
    assert [len(r["embedding"]) for r in media.embed(rows, "p", lambda b: [[1.0, 2.0]] * len(b), 2).collect()] == [2] * 10


def test_tags_and_retries(spark):
    tags = ["abc", "a.b!?", "a-b", "a(b)", "re:zero", "it's", "a+b", "ab", "123"]
    assert one(spark, **{f"t{i}": text.is_tag(F.lit(t)) for i, t in enumerate(tags)}) == (True, True, True, True, True, False, False, False, False)
    assert one(spark, **{f"n{n}": values.backoff(F.lit(n)) for n in (1, 2, 3, 9)}) == (5.0, 10.0, 20.0, 120.0)
    codes = [200, 304, 399, 400, 404, 408, 425, 429, 500, 503, None]
    want = ("ok", "ok", "ok", "deterministic", "deterministic", "deterministic", "deterministic", "transient", "transient", "transient", "transient")
    assert one(spark, **{f"c{i}": gates.status_class(F.lit(c).cast("int")) for i, c in enumerate(codes)}) == want


def test_signature(spark):
    import hashlib

    got = one(spark, a=values.signature({"b": F.lit("x y"), "a": F.lit(1)}, "k"))[0]
    assert got == hashlib.md5(b"a=1&b=x+yk").hexdigest()

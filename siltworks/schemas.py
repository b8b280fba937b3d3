"""The row types of the data lake, as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_PLAIN = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "float": T.FloatType(), "boolean": T.BooleanType(), "binary": T.BinaryType(),
}


def _parts(s: str) -> list[str]:
    """A text cut at the commas outside angle brackets."""
    out, depth = [""], 0
    for c in s:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def _type(s: str) -> T.DataType:
    if s.startswith("array<"):
        return T.ArrayType(_type(s[6:-1]))
    if s.startswith("map<"):
        return T.MapType(*map(_type, _parts(s[4:-1])))
    if s.startswith("struct<"):
        return T.StructType([T.StructField(n, _type(t)) for n, t in (x.split(":", 1) for x in _parts(s[7:-1]))])
    return _PLAIN[s]


def schema(ddl: str) -> T.StructType:
    """A schema from text, without a session."""
    return T.StructType([T.StructField(n, _type(t)) for n, t in (x.split(" ", 1) for x in _parts(ddl))])


#: One row for each distinct image content, by its hash.
MANIFEST = schema(
    "sha256 string, ext string, source string, source_kind string, source_authorized boolean, license string, author string, credit string, "
    "width bigint, height bigint, orig_width bigint, orig_height bigint, size_bytes bigint, mime string, instances array<string>, tiers array<bigint>, "
    "source_rank bigint, source_score double, queries map<string,string>, query_langs map<string,string>, asset_ids map<string,string>, "
    "landing_url string, content_url string, fetched_at double, path string, kb_match int, richness int, caption string, identity boolean"
)
#: A retrieval hit before its content is fetched.
CANDIDATE = schema(
    "source string, source_kind string, asset_id string, instance string, query string, landing_url string, content_url string, query_lang string, "
    "declared_mime string, declared_width bigint, declared_height bigint, declared_size bigint, author string, credit string, license_raw string, "
    "source_authorized boolean, evidence string, tier bigint, selected_tier bigint, orig_width bigint, orig_height bigint, resize_widths array<bigint>, "
    "source_rank bigint, source_score double, status string, fetched_at double, reject_reason string, fail_reason string, fail_kind string, sha256 string, "
    "local_path string, actual_mime string, actual_width bigint, actual_height bigint, actual_size bigint"
)
SEED = schema("name string, query string, lang string")
#: The one row type of the operator chain; operators only fill in fields.
ITEM = schema(
    "instance string, query string, lang string, source string, rank int, content_url string, landing_url string, declared_width bigint, declared_height bigint, "
    "mime string, license string, author string, native string, data binary, sha256 string, ext string, actual_width bigint, actual_height bigint, size_bytes bigint, "
    "kb_match int, richness int, caption string, identity boolean, local_path string, fetched_at double"
)
ENTITY = schema("name string, query array<string>, aliases array<string>, desc string, source string")
NODE = schema("path string, parent_path string, name string, depth int, instances array<string>, knowledge_intro string, aliases array<string>, representative_cases array<string>, related_tags array<string>")
QUEUE_ITEM = schema(
    "id bigint, wave int, instance string, source string, content_url string, rank int, cap int, instance_min int, attempts int, status string, "
    "payload string, rec string, next_try double, claimed_at double, updated_at double"
)
ANNOTATION = schema("sha256 string, path string, instances array<string>, ok boolean, parse_error boolean, kb_match int, richness int, caption string, error string, attempts int, elapsed_ms bigint")
VERDICT = schema("sha256 string, path string, instances array<string>, width bigint, height bigint, verdict string, score int, issues array<string>, reason string, ok boolean, attempts int, elapsed_ms bigint")
HEALTH = schema("source string, search_ok bigint, search_fail bigint, candidates bigint, dl_ok bigint, dl_fail bigint, dl_dead bigint, dl_timeout bigint, runs bigint, updated_at double")
EVENT = schema("seq bigint, name string, lifecycle string, provenance string, kind string, lang string, authorized boolean, version int, capabilities array<string>, spec string, ts double")
POST = schema(
    "id bigint, rating string, is_deleted boolean, is_flagged boolean, is_pending boolean, score int, fav_count int, file_ext string, file_url string, md5 string, "
    "image_width bigint, image_height bigint, tag_string string, tag_string_character string, tag_string_copyright string, media_asset struct<pixel_hash:string>"
)
VECTOR = schema("pool string, sha256 string, caption string, kb_match int, instances array<string>, embedding array<float>")

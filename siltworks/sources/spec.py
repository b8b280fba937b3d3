"""Declarative sources: a closed specification compiled to columns, without code in it.

A record is a JSON text.  Paths are ``$``, ``$.a.b`` and, at the end, ``[*]``;
alternatives are parted by ``|`` and the first that is neither null, an empty
text nor an empty list holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls, values
from ..functions.text import query_form

#: The fields that a specification may fill, and their types.
FIELDS = {
    "asset_id": "string", "content_url": "string", "landing_url": "string", "width": "bigint", "height": "bigint",
    "size": "bigint", "mime": "string", "author": "string", "credit": "string", "license": "string", "score": "double",
}


def lookup(item: Column, dotted: str) -> Column:
    """A dotted name in a JSON text; absent, null, empty texts and lists are null."""
    path = "$" + "".join(f"['{p}']" for p in dotted.split(".") if p)
    found = F.get_json_object(item, path)
    return F.when(~found.isin("", "[]"), found)


def resolve(item: Column, path: str) -> Column:
    """The value at the first alternative that has one, as text; lists and objects as JSON."""
    options = []
    for part in (p.strip() for p in (path or "").split("|")):
        if part == "$":
            options.append(item)
        elif part.endswith("[*]"):
            found = lookup(item, part[:-3].removeprefix("$").lstrip("."))
            options.append(F.when(found.startswith("["), found))
        elif part:
            options.append(lookup(item, part.removeprefix("$.")))
    return F.coalesce(*options) if options else F.lit(None).cast("string")


def items(document: Column, path: str | None) -> Column:
    """The objects of a list, or one object, at a path, as an array of JSON texts."""
    found = document if not path or path.strip() == "$" else resolve(document, path)
    listed = F.when(F.ltrim(found).startswith("{"), F.array(found)).otherwise(F.transform(F.from_json(found, "array<variant>"), lambda v: F.to_json(v)))
    return F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda x: x.startswith("{"))


def template(item: Column, pattern: str) -> Column:
    """Names in braces replaced by their values, unknown ones by nothing; trimmed, null if empty."""
    parts, at = [], 0
    for m in re.finditer(r"\{([a-zA-Z0-9_.]+)\}", pattern):
        parts += [F.lit(pattern[at : m.start()]), F.coalesce(lookup(item, m[1]), F.lit(""))]
        at = m.end()
    return F.nullif(F.trim(F.concat(*parts, F.lit(pattern[at:]))), F.lit(""))


def field(item: Column, how: str | dict | None) -> Column:
    """One field: a path, or an object with path, template or const and a transform (first, int, str, mime_by_ext)."""
    if how is None:
        return F.lit(None).cast("string")
    if isinstance(how, str):
        return resolve(item, how)
    value = F.lit(None).cast("string")
    if "const" in how:
        value = F.lit(how["const"])
    elif "template" in how:
        value = template(item, how["template"])
    elif "path" in how:
        value = resolve(item, how["path"])
    kind = how.get("transform")
    if kind == "first":
        return F.when(value.startswith("["), F.get_json_object(value, "$[0]")).otherwise(value)
    if kind == "int":
        return values.safe_int(value)
    if kind == "str":
        return value.cast("string")
    if kind == "mime_by_ext":
        by = resolve(item, how["by"]) if how.get("by") else F.lit("")
        other = resolve(item, how["fallback_ext_of"]) if how.get("fallback_ext_of") else F.lit("")
        return urls.mime_by_extension(by, other, how.get("map"))
    return value


def passes(item: Column, filters: list[dict] | None) -> Column:
    keep = F.lit(True)
    for f in filters or []:
        value = resolve(item, f.get("path", ""))
        if "in" in f:
            keep &= F.coalesce(value.isin([str(x) for x in f["in"] or []]), F.lit(False))
        if f.get("exists"):
            keep &= value.isNotNull()
        if "startswith" in f:
            keep &= F.coalesce(value.startswith(f["startswith"]), F.lit(False))
    return keep


def project(rows: DataFrame, record: dict, item: str = "item") -> DataFrame:
    """Rows of JSON items as candidate fields, filtered; all other columns go along."""
    unknown = set(record.get("fields", {})) - set(FIELDS)
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    it = F.col(item)
    rest = [c for c in rows.columns if c != item]
    made = [field(it, record.get("fields", {}).get(k)).try_cast(t).alias(k) for k, t in FIELDS.items()]
    return rows.where(passes(it, record.get("filters"))).select(*rest, *made)


def compile_source(documents: DataFrame, spec: dict, document: str = "document") -> DataFrame:
    """Search replies (one JSON document a row) as candidates: items, the first ``max_records``, filters, fields."""
    record = spec.get("record", {})
    found = items(F.col(document), record.get("items"))
    most = record.get("max_records")
    found = F.slice(found, 1, most) if most else found
    rest = [c for c in documents.columns if c != document]
    return project(documents.select(*rest, F.posexplode(found).alias("source_rank", "item")), record)


def request(job_query: Column, wanted: Column, spec: dict) -> Column:
    """``struct(url, query, page_size)`` of the one GET that a specification makes for a job."""
    search = spec.get("search", {})
    size = search.get("page_size") or {}
    n = values.page_size(wanted, size.get("factor", 1), size.get("floor", 1), size.get("cap", 50))
    q = query_form(job_query, search.get("query_transform"))
    parts = [F.lit(search.get("url", "")), F.lit("?")]
    for k, v in (search.get("params") or {}).items():
        parts += [F.lit(f"{k}="), F.url_encode(q) if v == "{query}" else F.url_encode(F.lit(str(v))), F.lit("&")]
    if size.get("param"):
        parts += [F.lit(f"{size['param']}="), n.cast("string")]
    return F.struct(F.regexp_replace(F.concat(*parts), "[?&]$", "").alias("url"), q.alias("query"), n.alias("page_size"))


#: The keys under which replies hold their items, in this order.
ITEM_KEYS = ("results", "data", "items", "hits", "posts", "images", "docs")


def container(document: Column, keys: tuple[str, ...] = ITEM_KEYS) -> Column:
    """The path of the first key, in order, that holds a list, or an object that holds one under a key; ``$`` if the document is a list; else null."""

    def is_list(path: str) -> Column:
        return F.get_json_object(document, path).startswith("[")

    options = [F.when(is_list("$"), "$")]
    for k in keys:
        options += [F.when(is_list(f"$.{p}"), f"$.{p}") for p in (k, *(f"{k}.{inner}" for inner in keys))]
    return F.coalesce(*options)

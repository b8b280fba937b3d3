"""Names, tags, queries and other short texts, as column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_CJK = r"[\x{4e00}-\x{9fff}]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_cjk(s) -> Column:
    """Whether a text has an ideograph of the basic block."""
    return F.coalesce(_c(s).rlike(_CJK), F.lit(False))


def entity_name(s) -> Column:
    """Trimmed, without title marks and without notes in brackets, full-width ones too."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(_c(s)), "[《》]", ""), r"[（(].*?[)）]", ""))


def concept_name(s) -> Column:
    """Lower case without any white space."""
    return F.regexp_replace(F.lower(_c(s)), r"\s+", "")


def tag_name(s) -> Column:
    """Trimmed lower case, with runs of spaces and hyphens as one underscore."""
    return F.regexp_replace(F.lower(F.trim(_c(s))), r"[\s-]+", "_")


#: Fixed value: the characters of a tag.
TAG = r"^[a-z0-9_:()!?.\-]+$"


def is_tag(s, pattern: str = TAG) -> Column:
    """Whether a text can be a tag of the closed vocabulary: its characters, three or more, one of them a letter."""
    return F.coalesce(_c(s).rlike(pattern) & (F.length(_c(s)) >= 3) & _c(s).rlike("[a-z]"), F.lit(False))


def plain_name(s) -> Column:
    """Lower case, with underscores, hyphens and runs of space as one space."""
    spaced = F.regexp_replace(F.coalesce(_c(s), F.lit("")), r"[_\-]+", " ")
    return F.lower(F.regexp_replace(F.trim(spaced), r"\s+", " "))


def bare_name(s) -> Column:
    """:func:`plain_name` without a series suffix in brackets."""
    return plain_name(F.regexp_replace(F.coalesce(_c(s), F.lit("")), r"\s*\([^)]*\)", ""))


def query_kind(q) -> Column:
    """``cjk``, ``tag`` or ``plain``."""
    q = F.coalesce(_c(q), F.lit(""))
    return F.when(has_cjk(q), "cjk").when(q.rlike("[_(]"), "tag").otherwise("plain")


def names_match(tags, names) -> Column:
    """Whether any tag, plain or bare, contains or is contained in any of the (plain) names."""
    forms = F.filter(F.flatten(F.transform(_c(tags), lambda t: F.array(plain_name(t), bare_name(t)))), lambda f: f != "")
    return F.coalesce(F.exists(forms, lambda f: F.exists(_c(names), lambda n: n.contains(f) | f.contains(n))), F.lit(False))


def answer_match(answer, truth) -> Column:
    """True or false where rules decide; null where a judge must: an answer that neither is nor holds the tag's name."""
    a, full, bare = plain_name(answer), plain_name(truth), bare_name(truth)
    held = lambda c: (c != "") & a.contains(c)
    return F.when(a == "", False).when(held(full) | held(bare), True).when(a.contains(" ") & (F.substring_index(a, " ", 1) == bare), True)


def path_parts(path) -> Column:
    return F.filter(F.split(F.coalesce(_c(path), F.lit("")), " / "), lambda p: p != "")


def leaf(path) -> Column:
    """The last segment of a path, the whole of a plain name, or an empty text."""
    return F.coalesce(F.try_element_at(path_parts(path), F.lit(-1)), F.lit(""))


def parent(path) -> Column:
    """The segment before the last, or an empty text."""
    return F.coalesce(F.try_element_at(path_parts(path), F.lit(-2)), F.lit(""))


def cluster_of(paths) -> Column:
    """The second segment of the first mount path (its only one, if there is one)."""
    parts = path_parts(F.get(_c(paths), F.lit(0)))
    return F.coalesce(F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(1)), F.lit("(unmounted)"))


def strip_tags(s) -> Column:
    """HTML tags removed and white space trimmed; entities stay (see :func:`unescape`)."""
    return F.trim(F.regexp_replace(F.coalesce(_c(s), F.lit("")), "<[^>]+>", ""))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """Named and numeric HTML entities as characters, which no built-in does."""
    return s.map(html.unescape, na_action="ignore")


def tokens(s) -> Column:
    """Lower-case runs of ASCII letters and digits, of two characters or more."""
    return F.filter(F.split(F.lower(F.coalesce(_c(s), F.lit(""))), "[^a-z0-9]+"), lambda t: F.length(t) >= 2)


def all_tokens_in(query, text) -> Column:
    """Whether every token of the query is somewhere in the text; false without tokens."""
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    return (F.size(tokens(query)) > 0) & F.forall(tokens(query), lambda t: low.contains(t))


def alnum(s) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(_c(s), F.lit(""))), "[^a-z0-9]+", "")


def query_form(q, kind: str | None) -> Column:
    """A source's form of a query, from a closed list: as it is, or lower case with underscores."""
    if kind in (None, "", "none"):
        return F.coalesce(_c(q), F.lit(""))
    if kind == "lower_underscore":
        return F.regexp_replace(F.lower(F.trim(F.coalesce(_c(q), F.lit("")))), r"\s+", "_")
    raise ValueError(f"unknown query form: {kind}")


def without_shard(s) -> Column:
    return F.regexp_replace(_c(s), r"_s\d+$", "")


def alias_pools(name, queries, aliases) -> Column:
    """``struct(latin, cjk)`` of distinct trimmed search terms; latin ones undecorated and short first."""
    both = F.concat(F.coalesce(_c(queries), F.array()), F.coalesce(_c(aliases), F.array()))
    terms = F.array_distinct(F.filter(F.transform(both, lambda t: F.trim(F.coalesce(t, F.lit("")))), lambda t: t != ""))
    latin = F.filter(terms, lambda t: ~has_cjk(t))
    marks = lambda t: F.length(t) - F.length(F.translate(t, "《》()（）[]", ""))
    words = lambda t: F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    keyed = F.array_sort(F.transform(latin, lambda t, i: F.struct(marks(t).alias("m"), words(t).alias("w"), F.length(t).alias("l"), i.alias("i"), t.alias("t"))))
    own = entity_name(name)
    ideographs = F.filter(terms, has_cjk)
    fallback = F.when((own != "") & ~F.array_contains(terms, own), F.array(own)).otherwise(F.array().cast("array<string>"))
    return F.struct(F.transform(keyed, lambda k: k["t"]).alias("latin"), F.concat(ideographs, fallback).alias("cjk"))


def latin_candidates(terms, cap: int = 8) -> Column:
    """The first terms with an ASCII letter, without regard to case in telling repeats, at most ``cap``."""
    own = F.filter(_c(terms), lambda t: t.rlike("[A-Za-z]"))
    lows = F.transform(own, lambda t: F.lower(t))
    firsts = F.filter(own, lambda t, i: F.array_position(lows, F.lower(t)) == i + 1)
    return F.slice(firsts, 1, cap)


def knowledge_block(name, aliases, desc, most_aliases: int = 5, cut: int = 250) -> Column:
    """One entity as text for a prompt: name, a few aliases, a shortened description."""
    named = F.concat_ws(", ", F.slice(F.coalesce(_c(aliases), F.array().cast("array<string>")), 1, most_aliases))
    text = F.coalesce(_c(desc), F.lit(""))
    short = F.when(F.length(text) > cut, F.concat(F.left(text, F.lit(cut)), F.lit("…"))).otherwise(text)
    return F.concat_ws("\n", _c(name), F.when(named != "", F.concat(F.lit("aliases: "), named)), F.when(short != "", short))


def clean_list(values, allowed: list[str] | None = None, cap: int = 10) -> Column:
    """A text split at commas or list marks, or a list: trimmed, distinct in order, of the allowed ones, at most ``cap``."""
    trimmed = F.filter(F.transform(_c(values), lambda v: F.trim(v)), lambda v: v != "")
    if allowed is not None:
        trimmed = F.filter(trimmed, lambda v: v.isin(allowed))
    return F.slice(F.array_distinct(trimmed), 1, cap)


def split_list(s) -> Column:
    return F.split(F.coalesce(_c(s), F.lit("")), "[、/,，]")

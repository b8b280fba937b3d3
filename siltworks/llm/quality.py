"""Quality by weak supervision: rules vote or abstain, and a latent class model weighs them.

Each rule looks at one statistic of a whole text and votes for (+1) or against
(-1) it, or abstains (0).  Rules with R votes give at most 3**R patterns; only
the patterns' counts reach the driver, where expectation-maximisation estimates
how often each rule votes each way on good and on bad texts.  The weights go
back into the plan as literals, and a row's posterior probability of quality is
an expression on its votes.

Statistics are array functions on one row; nothing is shuffled but patterns.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import cut

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_WINDOW = 8
#: The columns that :func:`with_statistics` adds.
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _removed(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeat_words(words: Column) -> Column:
    """Words in 8-word windows found twice or more; windows are told apart by a hash of their words.

    Words are hashed once; hashes of two, four and eight words are each made of two of the last kind.
    """

    def doubled(h: Column, step: int) -> Column:
        n = F.size(h) - step
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))

    single = F.transform(words, lambda w: F.xxhash64(w))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            at = F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]))
            places = F.array_sort(F.filter(at, lambda x: x.isNotNull()))
            gaps = lambda p: F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(_WINDOW)), F.lit(_WINDOW)))
            return _let(places, lambda p: F.aggregate(gaps(p), F.lit(0), lambda a, b: a + b))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(ordered, again))

    hashes = _let(single, lambda h: _let(doubled(h, 1), lambda h2: _let(doubled(h2, 2), lambda h4: _let(doubled(h4, 4), covered))))
    return F.when(F.size(words) > _WINDOW, hashes).otherwise(F.lit(0))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``STATISTICS``, all long.  A null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_removed(x, SPACE)) > 0)
    of_words = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("again")))
    of_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    long = lambda c, name: c.cast("long").alias(name)
    length = F.length(text)
    rows = docs.select("*", of_words.alias("_w"), of_lines.alias("_l"))
    made = {
        "n_words": F.col("_w.n"),
        "word_chars": F.length(_removed(text, SPACE)),
        "n_symbols": length - F.length(_removed(text, "#*$%&|<>")),
        "n_dup_lines": F.col("_l.again"),
        "n_repeat_words": F.col("_w.again"),
        "n_lines": F.col("_l.n"),
        "n_upper": length - F.length(_removed(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        "n_letters": F.length(_removed(text, "0123456789.,;:!?'\"()[]{}#*$%&|<>@/\\_-+=~^`" + SPACE)),  # what is neither digit, mark nor space
        "n_marks": length - F.length(_removed(text, "!?")),
    }
    return rows.select(*docs.columns, *(long(c, n) for n, c in made.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vote(value: Column, bad: Column, good: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def _rules() -> dict[str, Column]:
    words, lines = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("n_lines"), F.lit(0))
    word = F.col("word_chars") / words
    symbols, marks, repeats = (F.col(c) / words for c in ("n_symbols", "n_marks", "n_repeat_words"))
    doubled = F.col("n_dup_lines") / lines
    upper, letters = (F.col(c) / F.nullif(F.col("word_chars"), F.lit(0)) for c in ("n_upper", "n_letters"))
    return {
        "length": _vote(words, words < 40, words >= 80),
        "word_length": _vote(word, (word < 2.5) | (word > 12), (word >= 3) & (word <= 10)),
        "symbols": _vote(symbols, symbols > 0.1, symbols < 0.02),
        "marks": _vote(marks, marks > 0.2, marks < 0.05),
        "lines": F.when(lines >= 2, _vote(doubled, doubled > 0.3, doubled < 0.05)).otherwise(0),
        "repeats": _vote(repeats, repeats > 0.2, repeats < 0.05),
        "case": _vote(upper, upper > 0.3, upper < 0.15),
        "letters": _vote(letters, letters < 0.8, letters > 0.9),
    }


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 500) -> tuple[float, list[dict[int, float]]]:
    """Prior log odds of quality, and for each rule the log odds that each of its votes adds.

    Expectation-maximisation of a two-class model in which rules vote
    independently, so no two rules read the same statistic.  It starts from a
    vote in which one against outweighs three for, since a text has many ways
    to be bad and each shows in few statistics.  Each rule's shares of votes
    have a prior: a good text is mostly voted for, a bad one is voted against by
    every other rule.  It weighs as much as a thousandth of the texts, enough to
    keep a share off 0 and too little to hold against counts.  A rule's vote
    against may not become likelier on good texts than on bad ones, so the
    classes can't change places.  Votes that never happen add nothing.  It ends
    when posteriors move by under a millionth on average, or with a warning
    after ``rounds``.
    """
    rules = len(next(iter(patterns), ()))
    total = sum(patterns.values())
    good = {p: 1 / (1 + math.exp(3 * p.count(-1) - p.count(1))) for p in patterns}
    prior, odds = 0.0, [{-1: 0.0, 0: 0.0, 1: 0.0} for _ in range(rules)]
    for _ in range(rounds if total else 0):
        n = {1: sum(c * good[p] for p, c in patterns.items())}
        n[0] = total - n[1]
        prior = math.log((n[1] + 1) / (n[0] + 1))
        for j in range(rules):
            share = {}
            for kind in (0, 1):
                usual = {-1: 0.05, 0: 0.15, 1: 0.8} if kind else {-1: 0.5, 0: 0.15, 1: 0.35}
                strength = 2 + 0.001 * total  # as if so many texts had been seen with the usual shares
                held = {v: strength * usual[v] for v in (-1, 0, 1)}
                for p, c in patterns.items():
                    held[p[j]] += c * (good[p] if kind else 1 - good[p])
                share[kind] = {v: x / (n[kind] + strength) for v, x in held.items()}
            odds[j] = {v: math.log(share[1][v] / share[0][v]) for v in (-1, 0, 1)}
            odds[j][-1], odds[j][1] = min(odds[j][-1], 0.0), max(odds[j][1], 0.0)
            odds[j][0] = 0.0  # no vote, no say
        before, good = good, {p: 1 / (1 + math.exp(-max(-50.0, min(50.0, prior + sum(odds[j][v] for j, v in enumerate(p)))))) for p in patterns}
        if sum(c * abs(good[p] - before[p]) for p, c in patterns.items()) < 1e-6 * total:
            break
    else:
        if total:
            warnings.warn(f"rule estimates still moved after {rounds} rounds", stacklevel=2)
    return prior, odds


def judge(measured: DataFrame, least: float = 0.5) -> DataFrame:
    """``measured`` (with the statistics) with base_failed, ``p_quality`` and ``kept``."""
    rules = _rules()
    votes = F.struct(*(v.alias(k) for k, v in rules.items()))
    patterns = {tuple(r["v"]): r["count"] for r in measured.where(~base_failed()).groupBy(votes.alias("v")).count().collect()}
    prior, odds = estimate(patterns)
    logit = F.lit(prior)
    for (_, vote), weights in zip(rules.items(), odds, strict=False):
        logit = logit + F.when(vote == 1, weights[1]).when(vote == -1, weights[-1]).otherwise(0.0)
    p = 1 / (1 + F.exp(-logit))
    return measured.withColumns({"base_failed": base_failed(), "p_quality": p}).withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= least))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The statistics, ``base_failed``, ``p_quality`` and ``kept`` of every row, with its id.

    A null text counts as empty, so it has no words and fails.  Repeated rows
    are judged alike, each on its own.  A posterior of exactly ``least`` is
    kept.  A very long text is measured whole, by one task.  Other columns are
    not read.  An empty table gives an empty result.  Texts are read once: the
    statistics are written as a narrow table.
    """
    measured = with_statistics(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")), "_text").drop("_text")
    return judge(cut(measured, "statistics"))


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Rows and statistics are written together once, so neither repeated rows
    nor rows without an id need a join.
    """
    own = {c: f"_{i}_{c}" for i, c in enumerate(docs.columns)}  # free of clashes with the statistics
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()))
    judged = judge(cut(with_statistics(rows, own[text_col]), "measured"))
    return judged.where("kept").select(*(F.col(n).alias(c) for c, n in own.items()))


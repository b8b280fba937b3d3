"""Secret scans over an incremental ledger of blobs.

Every version of every file is a blob, named by the SHA-256 of its text.  The
ledger holds the (blob, rule, version) triples that were scanned.  A scan works
on the unseen ones alone: equal texts are scanned once, however many paths hold
them, and a new version of a rule scans old blobs for that rule only.  Findings
are per blob, are kept with the triples, and join back to all paths.

All of it is DataFrame operations.  Offsets come from splitting a text at a
rule's matches: a running sum over the lengths of pieces and matches, in a
window over one blob and rule.  Findings are written before they are joined
back, so that Spark can split the paths of a blob that many share; they grow
with the corpus, so they are never a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import cut, new_path


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that don't overlap, of which those stay whose ``group`` has ``least`` code points or more."""

    name: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: The base rules.  For the runs of one class, a least length in the pattern finds the same spans.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)


def unseen(docs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """``(blob, text, rules)``: each blob with the rules (in their versions) that ``ledger(blob, rules)`` lacks, once.  A null text is empty."""
    rows = docs.select(_blob(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = F.array(*(F.lit(r.key) for r in rules))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        rows = rows.join(seen, "blob", "left").select("blob", "text", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules"))
        rows = rows.where(F.size("rules") > 0)
    else:
        rows = rows.withColumn("rules", wanted)
    return rows.groupBy("blob").agg(F.first("text").alias("text"), F.first("rules").alias("rules"))


def _matches(rule: Rule, number: int) -> Column:
    """A struct for each match of a rule in ``text``: characters before it since the last, its length, and whether it stays."""
    pattern = F.lit(rule.pattern)
    lengths = lambda x: F.transform(x, F.length)
    all_of = F.arrays_zip(
        lengths(F.split("text", rule.pattern, -1)).alias("gap"),
        lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("size"),
        lengths(F.regexp_extract_all("text", pattern, F.lit(rule.group))).alias("held"),
    )
    made = F.transform(all_of, lambda m, i: F.struct(F.lit(number).alias("rule"), i.alias("i"), m["gap"].alias("gap"), m["size"].alias("size"), (m["held"] >= rule.least).alias("stays")))
    none = F.array().cast("array<struct<rule:int,i:int,gap:int,size:int,stays:boolean>>")
    return F.when(F.array_contains("rules", rule.key) & F.col("text").rlike(rule.pattern), made).otherwise(none)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = BASE) -> DataFrame:
    """``(blob, rules, spans)`` of every blob: what it was scanned for, and ``struct(start, end, rule)`` of every finding.

    Offsets are code points, the end exclusive; ``rule`` has its version.
    """
    rows = blobs.select("blob", "rules", F.inline_outer(F.concat(*(_matches(r, k) for k, r in enumerate(rules)))))
    so_far = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(so_far))
    key = F.array(*(F.lit(r.key) for r in rules))[F.col("rule")]
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "end", key.alias("rule"))
    return rows.groupBy("blob").agg(F.first("rules").alias("rules"), F.collect_list(F.when(F.col("stays"), span)).alias("spans"))


def by_blob(scanned: DataFrame, rules: tuple[Rule, ...] = BASE) -> DataFrame:
    """``(blob, n_<rule>, found)`` of each blob with findings by ``rules``: counts, and spans in order of start, then rule."""
    keys, names = (F.array(*(F.lit(x) for x in xs)) for xs in ([r.key for r in rules], [r.name for r in rules]))
    rows = scanned.where(F.size("spans") > 0).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    place = lambda s: F.array_position(keys, s["rule"]).cast("int")
    placed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), place(s).alias("number"), s["end"].alias("end")))
    ordered = F.array_sort(F.filter(placed, lambda s: s["number"] > 0))
    found = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["number"].alias("number"), s["end"].alias("end"), F.get(names, s["number"] - 1).alias("rule")))
    rows = rows.select("blob", found.alias("found")).where(F.size("found") > 0)
    of_rule = F.transform("found", lambda s: s["rule"])
    return rows.select("blob", *((F.size("found") - F.size(F.array_remove(of_rule, r.name))).cast("long").alias(f"n_{r.name}") for r in rules), "found")


class Ledger:
    """What was scanned and found, as a table in a shared folder that each scan appends to.

    A row is a blob with the rules (in their versions) that it was scanned for,
    and their findings; so a scan that dies leaves either both or neither.  Two
    scans at a time may scan a blob twice, which changes no result.
    """

    SCHEMA = "blob string, rules array<string>, spans array<struct<start:bigint,end:bigint,rule:string>>"

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        """``path`` is that of an earlier ledger; without one it starts empty, in a folder of its own."""
        self.spark, self.path = spark, path or new_path(spark, "ledger")

    def table(self) -> DataFrame | None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        there = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path) if there else None

    def scan(self, docs: DataFrame, rules: tuple[Rule, ...] = BASE, text_col: str = "text") -> DataFrame:
        """Scan what is unseen of ``docs``, append it, and give ``(blob, n_<rule>, found)`` of all blobs with findings."""
        known = self.table()
        scan(unseen(docs, rules, None if known is None else known.select("blob", "rules"), text_col), rules).write.mode("append").parquet(self.path)
        return by_blob(self.table(), rules)


def _blob(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def _rows_with_findings(docs: DataFrame, rules: tuple[Rule, ...], ledger: Ledger | None, text_col: str) -> DataFrame:
    """``(_row, n_<rule>, found)``: rows as structs, so that no name of theirs can clash, with their blobs' findings."""
    ledger = ledger or Ledger(docs.sparkSession)
    found = cut(ledger.scan(docs, rules, text_col), "findings")
    rows = docs.select(F.struct("*").alias("_row"), _blob(text_col).alias("blob")).join(found.hint("merge"), "blob", "left")
    none = F.array().cast(found.schema["found"].dataType)
    return rows.select("_row", *(F.coalesce(f"n_{r.name}", F.lit(0).cast("long")).alias(f"n_{r.name}") for r in rules), F.coalesce("found", none).alias("found"))


def findings_of(docs: DataFrame, rules: tuple[Rule, ...] = BASE, ledger: Ledger | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with counts ``n_<rule>`` and ``found``, an array of spans, for every path.

    With a ``ledger`` only what it lacks is scanned, and it grows by that;
    without one a new ledger is kept for this scan alone.  A null text is
    scanned as an empty one.  Repeated rows each get the findings of their
    text; spans with one start stand in the order of the rules.  A long text is
    scanned whole, by one task.  Columns of ``docs`` by an added name give way
    to it.  An empty table gives an empty result.
    """
    rows = _rows_with_findings(docs, rules, ledger, text_col)
    own = [c for c in docs.columns if c not in rows.columns]
    return rows.select(*(F.col("_row")[c].alias(c) for c in own), *rows.columns[1:])


def as_text(found: Column) -> Column:
    """Spans as ``rule:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE, text_col: str = "text", mask: str = "[SECRET]", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mask``; spans that overlap or touch share one.

    Columns as in ``docs``; ``length_col`` follows where a text changes.
    Texts without findings, null ones included, stay as they are.
    """
    rows = _rows_with_findings(docs, rules, None, text_col)
    pair = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (s["start"] <= F.get(acc, F.size(acc) - 1)["end"]), joined).otherwise(F.concat(acc, F.array(s)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    merged = F.aggregate(F.transform("found", pair), empty, merge)
    whole = F.col("_row")[text_col]
    cut = lambda a, b: F.substring(whole, (a + 1).cast("int"), (b - a).cast("int"))
    built = F.transform(F.array(merged), lambda m: F.concat(
        F.concat_ws("", F.transform(m, lambda s, i: F.concat(cut(F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0)), s["start"]), F.lit(mask)))),
        F.substring(whole, (F.element_at(m, -1)["end"] + 1).cast("int"), F.lit(2**31 - 1)),
    ))[0]
    rows = rows.withColumn("_new", F.when(F.size("found") > 0, built).otherwise(whole))
    made = {text_col: F.col("_new")}
    if length_col:
        kind = docs.schema[length_col].dataType
        made[length_col] = F.when(F.size("found") > 0, F.length("_new").cast(kind)).otherwise(F.col("_row")[length_col])
    return rows.select(*(made.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


_PARTS = """
    SELECT doc_id, {number} AS number, '{name}' AS kind,
           generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(vs) AS v,
           unnest(ps[1:len(ms)]) AS p
    FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms,
                 regexp_extract_all(text, '{pattern}', {group}) AS vs,
                 string_split_regex(text, '{pattern}') AS ps FROM texts)"""


def _sql() -> str:
    parts = []
    for number, rule in enumerate(BASE):
        pattern = rule.pattern
        for word in ("password", "passwd", "secret", "token", "api", "key"):  # ASCII letters in either case, and no others
            pattern = pattern.replace(word, "".join(f"[{c.upper()}{c}]" for c in word))
        parts.append(_PARTS.format(number=number, name=rule.name, pattern=pattern.replace("(?i:", "(?:").replace("'", "''"), group=rule.group))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, CAST(sum(length(p) + length(m)) OVER (PARTITION BY doc_id, number ORDER BY i) AS BIGINT) AS stop FROM parts),
kept AS (SELECT doc_id, number, kind, stop - length(m) AS start, stop FROM placed
         WHERE length(v) >= CASE kind {" ".join(f"WHEN '{r.name}' THEN {r.least}" for r in BASE)} END),
found AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans
          FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (doc_id)"""


SQL = _sql()

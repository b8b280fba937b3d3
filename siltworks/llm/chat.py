"""Chat logs: cumulative snapshots collapse to maximal conversations, which are rendered.

A logger that saves a conversation after every turn leaves many that are
prefixes of a longer one.  A prefix's hash is the exclusive-or of its turns'
hashes, each salted with its place, so it rolls along a window; two 64-bit
halves are kept.  A conversation is dropped if its whole hash is a proper
prefix of another (an anti-join against the distinct prefix hashes), and of
equal ones the least id stays.  Rendering reads the turns of those that stay,
in parts of bounded length.  What is joined to a conversation's turns is written
first, so that Spark can split the turns of a very long one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut


def placed(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", bucket: int = 256) -> DataFrame:
    """``(conv, i, role, text digest halves, px, py)``: places from 1, and the hash of the prefix up to each place.

    Ties in the turn number go by role, then text.  A conversation is ranked in
    buckets of turn numbers, and the buckets' sums are added up in turn, so a
    very long one is not ranked in one task.  Turns with one number (or none)
    share a bucket: they are ranked by role and text together.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(conv_col).alias("conv"), F.floor(F.coalesce(F.col(turn_col), F.lit(-1)) / bucket).alias("b"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("digest", F.md5(F.concat_ws("\x1f", "role", "text")))
    local = Window.partitionBy("conv", "b").orderBy("turn", "role", "digest")
    rows = rows.withColumn("at", F.row_number().over(local))
    sizes = rows.groupBy("conv", "b").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("conv").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv").alias("_c"), F.col("b").alias("_b"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("skip"))
    rows = rows.join(sizes, rows["conv"].eqNullSafe(sizes["_c"]) & (rows["b"] == sizes["_b"])).withColumn("i", (F.col("at") + F.col("skip")).cast("long"))
    salted = [F.xxhash64(F.lit(seed), "i", "digest") for seed in (1, 2)]
    rows = rows.select("conv", "b", "i", "role", "text", salted[0].alias("x"), salted[1].alias("y"))
    so_far = Window.partitionBy("conv", "b").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"lx": F.bit_xor("x").over(so_far), "ly": F.bit_xor("y").over(so_far)})
    totals = rows.groupBy("conv", "b").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    totals = totals.select(F.col("conv").alias("_c"), F.col("b").alias("_b"), *(F.coalesce(F.bit_xor(c).over(ahead), F.lit(0)).alias(f"a{c}") for c in "xy"))
    rows = rows.join(totals, rows["conv"].eqNullSafe(totals["_c"]) & (rows["b"] == totals["_b"]))
    return rows.select("conv", "i", "role", "text", F.col("lx").bitwiseXOR(F.col("ax")).alias("px"), F.col("ly").bitwiseXOR(F.col("ay")).alias("py"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """``(conv, n, copies)`` of conversations that are no proper prefix of another; of equal ones the least id, a null id last."""
    whole = cut(prefixes.groupBy("conv").agg(F.max_by(F.struct("i", "px", "py"), "i").alias("w")).select("conv", "w.*"), "whole")
    distinct = whole.groupBy("i", "px", "py").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    longer = prefixes.join(whole.select(F.col("conv").alias("_c"), F.col("i").alias("n")), F.col("conv").eqNullSafe(F.col("_c"))).where("i < n")
    proper = longer.groupBy("i", "px", "py").agg(F.lit(True).alias("seen"))
    return distinct.join(proper, ["i", "px", "py"], "left_anti").select("conv", F.col("i").alias("n"), "copies")


def template(role: Column, text: Column) -> Column:
    """One turn in the common im_start / im_end form."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def render(turns: DataFrame, part_turns: int = 64, **cols: str) -> DataFrame:
    """``(conv, part, n_turns, copies, rendered)`` of all maximal conversations.

    Parts hold ``part_turns`` turns; a conversation's parts in order are its
    rendering.  ``n_turns`` is the whole conversation's length and ``copies``
    how many logged ones equal it.  Null roles and texts are empty.  Turns with
    a null number come first; turns without a conversation id are one
    conversation.  Repeated rows are turns of their own.  A very long text is
    part of one rendered part, whole.  Other columns are not read.  An empty
    table gives no rows.
    """
    rows = cut(placed(turns, **cols), "turns")
    stay = cut(maximal(rows.select("conv", "i", "px", "py")), "maximal").withColumnRenamed("conv", "_c")
    rows = rows.select("conv", "i", "role", "text").join(stay, F.col("conv").eqNullSafe(F.col("_c")))
    piece = F.struct("i", template(F.col("role"), F.col("text")).alias("t"))
    rows = rows.groupBy("conv", F.floor((F.col("i") - 1) / part_turns).alias("part")).agg(F.first("n").alias("n_turns"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(piece)).alias("p"))
    return rows.select("conv", "part", "n_turns", "copies", F.concat_ws("", F.transform("p", lambda x: x["t"])).alias("rendered"))


SQL = """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(concat(coalesce(role, ''), chr(31), coalesce(text, '')))) AS i
    FROM conversations),
p AS (SELECT conv_id, i, md5(string_agg(md5(concat(role, chr(31), text)), '' ORDER BY i) OVER (PARTITION BY conv_id ORDER BY i)) AS h FROM t),
w AS (SELECT conv_id, max(i) AS n, arg_max(h, i) AS h FROM p GROUP BY conv_id),
d AS (SELECT n, h, min(conv_id) AS conv_id, count(*) AS copies FROM w GROUP BY n, h),
m AS (SELECT * FROM d WHERE NOT EXISTS (
    SELECT 1 FROM p JOIN w ON p.conv_id = w.conv_id AND p.i < w.n WHERE p.i = d.n AND p.h = d.h))
SELECT t.conv_id, (t.i - 1) // 64 AS part, any_value(m.n) AS n_turns, any_value(m.copies) AS copies,
       string_agg('<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10), '' ORDER BY t.i) AS rendered
FROM t JOIN m ON t.conv_id = m.conv_id GROUP BY t.conv_id, (t.i - 1) // 64
"""

"""The taxonomy tree, flattened, its audit and its enrichment."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import NODE


def nodes(document: dict) -> Iterator[dict]:
    """The nodes of a tree document as rows, without recursion; mounted entities may be names or objects with one."""
    todo = [(document.get("tree", document), None, 0)]
    while todo:
        node, above, depth = todo.pop()
        path = node.get("path") or (f"{above} / {node.get('name')}" if above else node.get("name"))
        names = [x.get("name") if isinstance(x, dict) else x for x in node.get("instances") or []]
        yield {"path": path, "parent_path": above, "name": node.get("name"), "depth": int(node.get("depth", depth)), "instances": [x for x in names if x]} | {
            k: node.get(k) for k in ("knowledge_intro", "aliases", "representative_cases", "related_tags")
        }
        todo += [(child, path, depth + 1) for child in reversed(node.get("children") or [])]


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """One tree file (a small document, by its nature) as node rows."""
    texts = [r[0] for r in spark.read.text(path, wholetext=True).collect()]
    return spark.createDataFrame([n for t in texts for n in nodes(json.loads(t))], NODE)


def mounts(tree: DataFrame) -> DataFrame:
    """``(name, paths)``: where each entity hangs, in order of path."""
    return tree.select(F.explode("instances").alias("name"), "path").groupBy("name").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def dead_leaves(tree: DataFrame, least_depth: int = 2) -> DataFrame:
    """Nodes without children, entities and knowledge, from a depth on."""
    bare = F.lit(True)
    for c in ("instances", "aliases", "representative_cases", "related_tags"):
        bare &= F.coalesce(F.size(c), F.lit(0)) <= 0
    bare &= F.coalesce("knowledge_intro", F.lit("")) == ""
    above = tree.where("parent_path IS NOT NULL").select(F.col("parent_path").alias("path"))
    return tree.where(bare & (F.col("depth") >= least_depth)).join(above, "path", "left_anti")


def pruned(tree: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The tree without nodes whose verdict is delete and that are still dead leaves."""
    doomed = dead_leaves(tree).join(verdicts.where("verdict = 'delete'").select("path"), "path", "left_semi")
    return tree.join(doomed.select("path"), "path", "left_anti")


def delete_report(verdicts: DataFrame) -> DataFrame:
    """``(parent_path, n, names)`` of nodes to delete, most first."""
    rows = verdicts.where("verdict = 'delete'").groupBy("parent_path").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("name")).alias("names"))
    return rows.orderBy(F.col("n").desc(), "parent_path")


def enriched(rows: DataFrame, found: DataFrame, key: str, lists: Sequence[str], texts: Sequence[str] = (), cap: int = 10) -> DataFrame:
    """Rows with list fields extended (distinct, in order, capped) and empty text fields filled from what was found."""
    other = found.select(key, *(F.col(c).alias(f"_new_{c}") for c in (*lists, *texts)))
    none = F.array().cast("array<string>")
    made = {c: F.slice(F.array_distinct(F.concat(F.coalesce(c, none), F.coalesce(f"_new_{c}", none))), 1, cap) for c in lists}
    made |= {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_new_{c}")) for c in texts}
    return rows.join(other, key, "left").withColumns(made).select(*rows.columns)

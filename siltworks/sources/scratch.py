"""Folders for what a query writes and reads again, in storage that the whole cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; else one of its own for a local session, and the warehouse for any other."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        if "dir" not in _own:
            _own["dir"] = tempfile.mkdtemp(prefix="siltworks-")
            atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
        return "file://" + _own["dir"]
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A path that nothing has yet."""
    return f"{shared_dir(spark)}/siltworks-{name}-{uuid.uuid4().hex}"

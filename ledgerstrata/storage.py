"""Where intermediate tables and files of an application lie."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL_ROOT: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a scratch folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="run-ledgerstrata-"))
    return _LOCAL_ROOT[0]

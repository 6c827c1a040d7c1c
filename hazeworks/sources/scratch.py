"""Folders for intermediate files."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared one the cluster names; a temporary one only in local mode."""
    shared = spark.conf.get(_SETTING, None)
    if shared:
        return f"{shared.rstrip('/')}/readings-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="readings-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder

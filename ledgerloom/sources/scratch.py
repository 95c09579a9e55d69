"""Places for intermediate tables that must survive a lost executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """``name`` below the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting only a local-mode session gets a path, in a new
    temporary folder that goes when the process ends: on a cluster the
    executors would not share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/{name}"

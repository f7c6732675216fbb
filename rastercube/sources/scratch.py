"""A folder for tables that a session writes for itself and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master without that setting gets a temporary folder; a cluster's local disks
    are not shared, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="rastercube-")
    return f"{found.rstrip('/')}/rastercube/{name}-{uuid.uuid4().hex}"

"""Working folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one the cluster names.

    Without that setting only a local session gets a folder of its own.
    """
    shared = spark.conf.get(SETTING, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{SETTING} must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="bazaarflow-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4()}"

"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local one would be out of the other machines' reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyline-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

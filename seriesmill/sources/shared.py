"""The folder all executors share, for checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def use_shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set if it was not.

    ``spark.checkpoint.dir`` names it on a cluster. Only in local mode without it
    (single-machine tests) is a temporary one made.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="seriesmill-"))
    return named or context.getCheckpointDir()


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{use_shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

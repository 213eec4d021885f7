"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings that hold from a laptop to a large cluster. Sizes of shuffles are
# left to adaptive execution: many initial partitions, coalesced at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``DEFAULTS``; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a ``local[...]`` session may go without the setting; it then gets a
    folder of its own. Anywhere else a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="marketloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage on storage that outlives executors, and gives every later
    use of the table the very same rows. Runs a job.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

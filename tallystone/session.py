"""Session settings and the one place where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "tallystone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; every operator also runs on a session made elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a folder that
    is removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="tallystone-")
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tallystone/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it back.

    Used where a later step must see exactly the rows of this one (partition
    ids, sampled values), and to cut lineage so that a lost executor costs one
    re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

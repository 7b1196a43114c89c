"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "playcohort", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster settings win over these defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a master inside one JVM may run without that setting: a machine-local folder is invisible to the
    executors of a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="playcohort-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

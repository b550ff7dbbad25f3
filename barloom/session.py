"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates of bars are UTC dates, so the session has to run in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is used, but only by a local session:
    on a cluster a machine-local folder would be lost together with its executor.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":  # local-cluster is a cluster
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="barloom-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, compression: str | None = None, **options: str) -> DataFrame:
    """Write ``df``, with the writer's ``options``, to the shared work folder and read it back, cutting its lineage."""
    path = work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Tables in the folder that driver and executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where it is unset a temporary folder is set, but only in local mode, where all tasks run on this machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df as Parquet to the shared folder (in folders by the columns `by`) and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def drop_saved(df: DataFrame) -> None:
    """Empty a table of save() that nothing reads any more."""
    path = getattr(df, "_saved_at", None)
    if path:
        df.sparkSession.range(0).coalesce(1).write.mode("overwrite").parquet(path)

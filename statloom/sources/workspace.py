"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


OWN = "statloom.work.dir"  # the folder this session made for itself


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session without the setting, and on one machine, gets a folder of its own.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir") or spark.conf.get(OWN, None))
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="statloom-")
    spark.conf.set(OWN, folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run."""
    return f"{shared_root(spark)}/statloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table that several later tables read, and read it back.

    The written files, not a chain of recomputed stages, back the result, so losing an
    executor costs nothing already computed.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.parquet(path)

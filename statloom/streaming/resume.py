"""Resume a download folder: each run takes in only the files it has not seen, or replaces what was revised."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cols import named


def land_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str,
    schema: T.StructType | str, fmt: str = "csv",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: list[str] | None = None, files_per_batch: int = 1_000,
) -> None:
    """Append the rows of new files below `source` to parquet at `target`, then stop.

    The checkpoint remembers finished files and makes each file land exactly once, also
    when a run dies halfway. The batch size bounds the work of one commit.
    """
    stream = (
        spark.readStream.format(fmt).schema(schema).option("header", True)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
        .load(source))
    if transform:
        stream = transform(stream)
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))
    query.awaitTermination()


def newest_revision(rows: DataFrame, vintage: Sequence[str], folder: str, modified: str) -> DataFrame:
    """Of each vintage the rows of the folder whose files were changed last; missing keys are a vintage too."""
    last = rows.groupBy(*[named(v).alias(f"__{v}") for v in vintage]).agg(
        F.max(F.struct(named(modified), named(folder))).alias("__last"))
    same = F.col(f"__last.{folder}") == named(folder)
    for v in vintage:
        same = same & named(v).eqNullSafe(named(f"__{v}"))
    return rows.join(last, same).drop("__last", *[f"__{v}" for v in vintage])


def land_vintages(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType | str, vintage: Sequence[str],
    fmt: str = "csv", transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Land new files; a vintage (the partition columns) that comes again replaces the one that was there, and no other.

    All files that are new to a run are one batch, so a vintage must be there whole when the run
    starts. Two revisions of a vintage lie in folders of their own; the one changed last counts. A
    batch overwrites just the partitions that it holds. So a run that dies between the write and
    its commit is repeated with the same files and leaves the same rows: nothing doubles and nothing is lost.
    """
    if not vintage:
        raise ValueError("name the columns of a vintage")
    stream = (
        spark.readStream.format(fmt).schema(schema).option("header", True).option("recursiveFileLookup", True).load(source)
        .withColumns({
            "__modified": F.col("_metadata.file_modification_time"),
            "__folder": F.regexp_replace("_metadata.file_path", "/[^/]*$", "")}))
    if transform:
        stream = transform(stream)

    def put(batch: DataFrame, batch_id: int) -> None:
        newest_revision(batch, vintage, "__folder", "__modified").drop("__folder", "__modified").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*vintage).parquet(target)

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

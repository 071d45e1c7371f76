"""Publish finished stores to another folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sinks.objects import copy_files
from gridloom.sinks.publish import plan_copy, upload_targets
from gridloom.sources.manifest import require_files, scan_files


def publish(
    spark: SparkSession, stores_root: str, stores: list[str], dest_root: str
) -> DataFrame:
    """Copy every file of the named stores; one status row per file.

    Stores that do not exist are left out; nothing at all to send is an error,
    a failed file is not.
    """
    requested = spark.createDataFrame([(s,) for s in stores], "store string")
    sent = upload_targets(requested, scan_files(spark, stores_root), dest_root)
    require_files(sent, 1, "no files to transfer")
    return copy_files(sent.select(F.col("path").alias("source"), "target"))


def stage(spark: SparkSession, source: DataFrame, target_root: str, act: bool = True) -> DataFrame:
    """Copy the files of a manifest that ``target_root`` lacks; without ``act``
    the list of files that would be sent."""
    todo = plan_copy(source, scan_files(spark, target_root)).select(
        F.col("path").alias("source"),
        F.concat(F.lit(target_root.rstrip("/") + "/"), "rel_path").alias("target"),
    )
    return copy_files(todo) if act else todo

"""Per-file results of a run, its summary, and the gate before publishing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RunFailed(RuntimeError):
    """At least one file could not be prepared."""


def file_results(
    work: DataFrame,
    chunks: DataFrame,
    expected: DataFrame,
    ledger: DataFrame | None = None,
    file: str = "file",
) -> DataFrame:
    """One row per work item. It succeeded when it was read, has as many chunk rows
    as ``expected`` (dataset, file, chunks, variables) and none carries an error.
    ``ledger`` (see ``sources.ledger``) says what was read and how many cells that
    gave; all of them must be in the chunks. A file that was never read, or has no
    stated size, is a failure."""
    found = chunks.groupBy("dataset", file).agg(
        F.min("error").alias("bad"),
        F.count_if(F.col("error").isNull()).alias("written"),
        F.sum("n_cells").alias("packed"),
    )
    joined = work.join(found, ["dataset", file], "left").join(expected, ["dataset", file], "left")
    unread = F.lit(None).cast("string")
    lost = F.lit(False)
    if ledger is not None:
        read = ledger.select(
            "dataset", file, "status", F.col("error").alias("reason"), F.col("cells").alias("seen")
        )
        joined = joined.join(read, ["dataset", file], "left")
        status = F.coalesce("status", F.lit("missing"))
        unread = F.when(status == "missing", F.lit("it was not read")).when(
            status != "read", F.coalesce("reason", F.lit("it could not be read"))
        )
        lost = F.col("packed") != F.col("seen") * F.col("variables")
    lacking = F.coalesce(F.col("written") != F.col("chunks"), F.lit(True))
    error = F.coalesce(
        "bad",
        unread,
        F.when(lacking, F.lit("not all of its chunks were written")),
        F.when(lost, F.lit("not all of its cells were written")),
    )
    joined = joined.withColumn("error", error)
    failed = F.col("error").isNotNull()
    return joined.select(
        "dataset",
        (~failed).alias("ok"),
        "in_path",
        "out_path",
        F.when(failed, F.concat_ws("", "in_path", F.lit(" failed, "), "error"))
        .otherwise(F.concat_ws("", "in_path", F.lit(" is at "), "out_path"))
        .alias("message"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("submitted"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def fail_fast(results: DataFrame) -> DataFrame:
    """The results, unless one failed: then the run ends here."""
    first = results.filter(~F.col("ok")).select("message").first()
    if first is not None:
        raise RunFailed(first[0])
    return results

"""Order and running totals without pulling a table into one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import materialized

BROADCAST_ROWS = 100_000


def broadcast_within(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, rows: int | None = None
) -> DataFrame:
    """Mark ``df`` for broadcast when it is counted to be small; otherwise leave
    the join to the optimizer. For narrow tables; ``rows`` if already counted."""
    if rows is None:
        rows = df.limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df


def with_running_total(
    df: DataFrame, order: list[Column], out: str, size: Column | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``size`` (1 if not given) over all earlier rows.

    Rows are range-sorted over the cluster and written once. Only one total per
    sorted partition is then summed in order, and each partition adds its own
    running sum, so no task sees more than one range of the rows.
    """
    counting = size is None
    size = F.lit(1).cast("bigint") if counting else size.cast("bigint")
    # sort by columns: a sort expression would be evaluated at every comparison
    keys = {f"_key{k}": expr for k, expr in enumerate(order)}
    placed = materialized(
        df.withColumns({**keys, "_size": size})
        .orderBy(*keys)
        .drop(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy("_part")
        .agg(F.sum("_size").alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    if counting:
        # the low 33 bits of the id count the rows of a partition from 0
        local = F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    else:
        inside = Window.partitionBy("_part").orderBy("_seq")
        inside = inside.rowsBetween(Window.unboundedPreceding, -1)
        local = F.coalesce(F.sum("_size").over(inside), F.lit(0))
    return (
        placed.withColumn("_local", local)
        # one row per sorted partition, so never more than the shuffle partitions
        .join(F.broadcast(totals), "_part")
        .withColumn(out, F.col("_base") + F.col("_local"))
        .drop("_size", "_part", "_seq", "_local", "_base")
    )


def is_ascending(df: DataFrame, position: str, label: str, bucket: int = 65_536) -> bool:
    """Whether ``label`` never falls as ``position`` grows.

    Neighbours are compared inside buckets of positions, then the bucket edges
    are compared with each other.
    """
    index = df.groupBy(position).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    index = index.withColumn("_bucket", F.expr(f"{position} div {bucket}"))
    near = Window.partitionBy("_bucket").orderBy(position)
    falls = F.coalesce(F.lag("_hi").over(near) > F.col("_lo"), F.lit(False))
    edges = (
        index.withColumn("_falls", falls)
        .groupBy("_bucket")
        .agg(
            F.max("_falls").alias("_falls"),
            F.min_by("_lo", position).alias("_first"),
            F.max_by("_hi", position).alias("_last"),
        )
    )
    across = F.coalesce(
        F.lag("_last").over(Window.orderBy("_bucket")) > F.col("_first"), F.lit(False)
    )
    row = edges.withColumn("_falls", F.col("_falls") | across).agg(F.max("_falls")).first()
    return not row[0]

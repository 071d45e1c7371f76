"""Layout plans: chunk and shard shapes per variable, from catalog and contract.

A catalog has one row per (dataset, file, var, dim). The contract is the small
table of ``contract_table``; a stage has a handful of dims.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.ordering import broadcast_within
from gridloom.operators.selecting import data_vars_only

_KEYS = ["dataset", "file", "var"]


def _in_dim_order(length: Column) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct("dim_pos", length.alias("n"))))
    return F.transform(ordered, lambda x: x["n"])


def _with_contract(catalog: DataFrame, contract: DataFrame, stage: str) -> DataFrame:
    wanted = contract.filter(F.col("stage") == stage).drop("stage")
    return data_vars_only(catalog).join(broadcast_within(wanted), ["dataset", "dim"], "left")


def plan_rechunk(
    catalog: DataFrame, contract: DataFrame, level: int, stage: str = "rechunk"
) -> DataFrame:
    """Shape, chunk shape and zlib settings of every data variable."""
    plan = _with_contract(catalog, contract, stage).groupBy(*_KEYS)
    return plan.agg(
        F.max("dtype").alias("dtype"),
        _in_dim_order(F.col("dim_size")).alias("shape"),
        _in_dim_order(F.coalesce("chunk", "dim_size")).alias("chunksizes"),
    ).select(
        *_KEYS,
        "dtype",
        "shape",
        "chunksizes",
        F.lit(True).alias("zlib"),
        F.lit(level).alias("complevel"),
        F.lit(True).alias("shuffle"),
    )


def plan_store(
    catalog: DataFrame,
    contract: DataFrame,
    fill: Column,
    codec: dict,
    stage: str = "store",
) -> DataFrame:
    """Chunk and shard shapes, compressor and fill of every data variable."""
    plan = _with_contract(catalog, contract, stage).groupBy(*_KEYS)
    compressor = F.struct(*[F.lit(v).alias(k) for k, v in codec.items()])
    return plan.agg(
        _in_dim_order(F.coalesce("chunk", "dim_size")).alias("chunks"),
        _in_dim_order(F.coalesce("shard", "dim_size")).alias("shards"),
    ).select(*_KEYS, "chunks", "shards", compressor.alias("compressor"), fill.alias("fill_value"))


def uneven_shards(store_plan: DataFrame) -> DataFrame:
    """Plans whose shards do not hold whole chunks, per offending dim position."""
    pairs = store_plan.select(*_KEYS, F.posexplode(F.arrays_zip("chunks", "shards")))
    return pairs.select(
        *_KEYS,
        F.col("pos").alias("dim_pos"),
        F.col("col.chunks").alias("chunk"),
        F.col("col.shards").alias("shard"),
    ).filter(F.col("shard") % F.col("chunk") != 0)

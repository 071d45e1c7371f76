"""Reports on stored arrays: sizes, layouts, and what changed between two copies."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.values import element_count, item_size

# Growth beyond which an array is flagged, and how many are shown.
GROWTH_LIMIT = 1.05
SHOWN = 3


def storage_stats(
    chunks: DataFrame, dims: tuple[str, ...], by: tuple[str, ...] = ()
) -> DataFrame:
    """Per stored array, coordinates too: shape, dtype, chunk shape, codec, filters
    and bytes, from the chunk rows alone (payloads are not read). Shape and chunk
    shape are the declared ones, whatever was left out as empty or stored in slabs;
    a chunk without a payload is not counted. ``dims`` are those of all arrays."""
    place = F.array(
        *(F.expr(f"o_{d} div get(chunk, cast(array_position(dims, '{d}') - 1 as int))") for d in dims)
    )
    return (
        chunks.groupBy(*by, "var")
        .agg(
            F.max("shape").alias("shape"),
            F.max("chunk").alias("chunks"),
            F.max("dtype").alias("dtype"),
            F.max("codec").alias("compression"),
            F.max("level").alias("level"),
            F.bool_and("shuffle").alias("shuffle"),
            F.countDistinct(F.when(F.col("stored_bytes") > 0, place)).alias("n_chunks"),
            F.sum("raw_bytes").alias("raw_bytes"),
            F.sum("stored_bytes").alias("storage"),
        )
        .withColumnRenamed("var", "name")
        .withColumn("filters", applied_filters())
    )


def applied_filters() -> Column:
    """What is done to the bytes of a chunk, in order: ``shuffle`` over the items,
    then the compressor with its level."""
    packed = F.when(F.col("compression") != "none", F.concat_ws(":", "compression", "level"))
    return F.array_compact(F.array(F.when(F.col("shuffle"), F.lit("shuffle")), packed))


def storage_totals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bytes over all arrays of each side, matched or not, and their ratio."""
    sides = old.select(F.col("storage").alias("o"), F.lit(0).cast("bigint").alias("n")).unionByName(
        new.select(F.lit(0).cast("bigint").alias("o"), F.col("storage").alias("n"))
    )
    return sides.agg(F.sum("o").alias("old_total"), F.sum("n").alias("new_total")).withColumn(
        "ratio", F.col("new_total").cast("double") / F.col("old_total").cast("double")
    )


def common_arrays(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.select("name").intersect(new.select("name"))


def compare_storage(
    old: DataFrame, new: DataFrame, also: tuple[str, ...] = ()
) -> DataFrame:
    """Arrays of both sides with their ratio, and whether to flag them. Arrays
    that stored nothing before are left out. ``also``: further columns of the
    statistics to show for both sides, such as codec, level and shuffle."""
    cols = ["name", "storage", "chunks", "dtype", *also]
    o = old.filter(F.col("storage") != 0).select(
        "name", *[F.col(c).alias(f"old_{c}") for c in cols[1:]]
    )
    n = new.select("name", *[F.col(c).alias(f"new_{c}") for c in cols[1:]])
    ratio = F.col("new_storage").cast("double") / F.col("old_storage").cast("double")
    changed = ~(
        F.col("old_chunks").eqNullSafe(F.col("new_chunks"))
        & F.col("old_dtype").eqNullSafe(F.col("new_dtype"))
    )
    return (
        o.join(n, "name")
        .withColumn("ratio", ratio)
        .withColumn("flagged", (F.col("ratio") > GROWTH_LIMIT) | changed)
    )


def flagged_first(compared: DataFrame, n: int = SHOWN) -> DataFrame:
    """The first ``n`` flagged arrays by name."""
    return compared.filter("flagged").orderBy("name").limit(n)


def flag_count(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count_if("flagged").alias("flagged"))


def encoding_diff(source: DataFrame, converted: DataFrame) -> DataFrame:
    """Source and converted encodings, entry by entry, as (var, key, value)."""
    s = source.withColumnRenamed("value", "source_value")
    c = converted.withColumnRenamed("value", "converted_value")
    same = F.col("source_value").eqNullSafe(F.col("converted_value"))
    return s.join(c, ["var", "key"], "full_outer").withColumn("same", same)


def chunk_size_mb(
    arrays: DataFrame,
    encoded_chunks: Column,
    memory_chunks: Column,
    shape: Column,
    encoded_dtype: Column,
    dtype: Column,
) -> DataFrame:
    """Chunk shape in use and its size in MiB: the stored chunk shape if there
    is one, else the first in-memory chunk per dim, else the whole array."""
    first = F.transform(memory_chunks, lambda lens: lens[0])
    return (
        arrays.withColumn("chunk_shape", F.coalesce(encoded_chunks, first, shape))
        .withColumn("size_dtype", F.coalesce(encoded_dtype, dtype))
        .withColumn(
            "mb",
            (element_count(F.col("chunk_shape")) * item_size(F.col("size_dtype"))).cast("double")
            / F.lit(1048576.0),
        )
    )


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.withColumn("label", F.lit("BEFORE")).unionByName(
        after.withColumn("label", F.lit("AFTER"))
    )

"""Column helpers and small Spark building blocks shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import materialized

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "[\\x20\\x09-\\x0D]+"


def fold(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, separators: str = SPACES) -> Column:
    """Non-empty runs between separators; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows; past
    that the join is left to the optimizer and shuffles both sides."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def giving_back(body: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A mapInArrow body whose worker hands freed memory back to the system when its
    task ends: workers live on and wait, and several stages of a job would otherwise
    hold the greatest need of each of them."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from body(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where there is one
            if trim:
                trim(0)

    return run


def free_shuffles(spark) -> None:
    """Let Spark delete the shuffle files of queries that are done with: it does so
    when the driver's objects of them are collected, which may be much later on a
    driver with little to do. Written tables stay."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


ID_BITS = 1 << 25  # places of the filter on wanted ids: 4 MB


def id_bits(keys: DataFrame, *columns: str, by: tuple[str, ...] = ()) -> DataFrame:
    """bucket and bits, 4 KB of the bitmap of the hashes of ``columns``: at most 1024
    rows for each value of ``by``, none for buckets without a key."""
    return (
        keys.select(*by, id_spot(*columns).alias("spot"))
        .groupBy(*by, F.expr("spot div 32768").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(spot % 32768)").alias("bits"))
    )


def id_bitmap(keys: DataFrame, *columns: str) -> np.ndarray:
    """A bitmap of fixed size of the hashes of ``columns``: a filter that lets all
    wanted keys through and few others. When it fills up, it only drops fewer."""
    return id_bitmaps(keys.withColumn("side", F.lit(0)), *columns, sides=1)[0]


def id_bitmaps(keys: DataFrame, *columns: str, sides: int) -> list[np.ndarray]:
    """A bitmap for each value of the column ``side``, 0 to ``sides`` - 1. All parts,
    4 MB a bitmap, come in one job; row by row, each partition would be one."""
    held = np.zeros((sides, ID_BITS // 32768, 4096), np.uint8)
    for row in id_bits(keys, *columns, by=("side",)).collect():
        held[row["side"], row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return [h.ravel() for h in held]


def id_spot(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(ID_BITS))


def in_bitmap(held: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (held[spots >> 3] >> (spots & 7)) & 1 == 1


def likely_among(keys: DataFrame, *columns: Column) -> Column:
    """Whether a row whose key is ``columns`` may be among ``keys`` (its columns, in
    that order): true for all that are, and for few others. Rows that cannot be need
    no join, so that only the others are shuffled, texts and all. SQL functions only:
    the bitmap, 4 MB at most, is a scalar subquery."""
    # as text, so that types of ids that compare as equal are one
    known = keys.select(*[F.col(c).cast("string") for c in keys.columns])
    held = id_bits(known, *keys.columns).agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("held")
    )
    spot = id_spot(*[c.cast("string") for c in columns])
    bits = F.element_at(materialized(held).scalar(), F.shiftright(spot, 15))
    byte = F.substring(bits, F.shiftright(spot.bitwiseAND(32767), 3).cast("int") + 1, 1)
    byte = F.conv(F.hex(byte), 16, 10).cast("int")
    bit = F.bit_get(byte, spot.bitwiseAND(7).cast("int"))
    return F.coalesce(bit == 1, F.lit(False))


def likely_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the rows whose doc_id may be among ``ids`` (column
    doc_id): all that are, and few others. Meant before a join that shuffles
    texts."""
    shared = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids, "doc_id"))

    def maybe(batches):
        for batch in batches:
            good = in_bitmap(shared.value, batch.column(2).to_numpy())
            yield batch.select([0, 1]).filter(pa.array(good))

    rows = docs.where("doc_id is not null").select("doc_id", "text", id_spot("doc_id"))
    return rows.mapInArrow(giving_back(maybe), "doc_id long, text string")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges``: columns ``a`` and ``b`` of one sortable type, each edge once or
    more in any direction. Returns ``node`` and ``root``. Every round points
    each node at the smallest root among its neighbours and then at the root of
    that root, so path lengths about halve; rounds are written to the shared
    folder. No group of neighbours is gathered: both steps are joins and minima.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = materialized(both)
    label = materialized(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
    )
    while True:
        near = (
            both.join(label.select(F.col("node").alias("b"), F.col("root").alias("seen")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        # hooking the old root as well joins whole trees, not only single nodes
        best = label.join(near, "node").select(
            "node", "root", F.least("root", "seen").alias("seen")
        )
        hooks = best.groupBy("root").agg(F.min("seen").alias("hook"))
        moved = best.join(hooks, "root").select(
            "node", F.col("root").alias("old"), F.least("seen", "hook").alias("next")
        )
        up = label.select(F.col("node").alias("next"), F.col("root").alias("above"))
        new = materialized(
            moved.join(up, "next", "left").select(
                "node", "old", F.least("next", F.coalesce("above", "next")).alias("root")
            )
        )
        changed = new.where("old <> root").limit(1).count()
        label = new.select("node", "root")
        if not changed:
            return label

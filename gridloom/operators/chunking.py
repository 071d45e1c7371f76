"""Assign cells to chunks and shards, and summarise chunks, in plain SQL."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.model import Grid


def _div(col: Column, n: int) -> Column:
    # index columns are never negative, so floor and truncation agree
    return F.call_function("div", col.cast("bigint"), F.lit(n).cast("bigint"))


def assign_chunks(cells: DataFrame, grid: Grid) -> DataFrame:
    """Add ``<dim>_c``; a dim outside the chunk map is one chunk, index 0."""
    return cells.withColumns(
        {
            f"{d}_c": _div(F.col(f"{d}_i"), grid.chunk[d])
            if d in grid.chunk
            else F.lit(0).cast("bigint")
            for d in grid.dims
        }
    )


def assign_shards(cells: DataFrame, grid: Grid) -> DataFrame:
    """Add ``<dim>_s`` and ``<dim>_inner``: the shard, and the chunk within it."""
    added = {}
    for d in grid.dims:
        i = F.col(f"{d}_i").cast("bigint")
        if d in grid.shard:
            added[f"{d}_s"] = _div(i, grid.shard[d])
            i = i % F.lit(grid.shard[d]).cast("bigint")
        else:
            added[f"{d}_s"] = F.lit(0).cast("bigint")
        added[f"{d}_inner"] = (
            _div(i, grid.chunk[d]) if d in grid.chunk else F.lit(0).cast("bigint")
        )
    return cells.withColumns(added)


def chunk_stats(cells: DataFrame, grid: Grid, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Cell count, min, max and NaN count per chunk; partial sums run map-side."""
    v = F.col(value)
    keys = [*by, *(f"{d}_c" for d in grid.dims)]
    return (
        assign_chunks(cells, grid)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.min(v).alias("min_v"),
            F.max(v).alias("max_v"),
            F.count_if(F.isnan(v)).alias("n_nan"),
        )
    )


def nonempty_chunks(
    cells: DataFrame,
    grid: Grid,
    value: str,
    by: tuple[str, ...] = (),
    fill: float = float("nan"),
) -> DataFrame:
    """Chunks with at least one cell that is present and differs from ``fill``, and
    how many positions they have. Only present cells are needed: absent ones are
    the fill."""
    present = F.col(value).isNotNull()
    present &= ~F.isnan(value) if fill != fill else (F.col(value) != F.lit(fill))
    keys = [*by, *(f"{d}_c" for d in grid.dims)]
    chunks = assign_chunks(cells.where(present), grid).select(*keys).distinct()
    lengths = (
        f"(least({grid.sizes[d]}L, ({d}_c + 1) * {grid.chunk_len(d)}L) - {d}_c * {grid.chunk_len(d)}L)"
        for d in grid.dims
    )
    return chunks.withColumn("n_cells", F.expr(" * ".join(lengths)))

"""Read stored arrays back: a store is opened by its path alone."""

from collections.abc import Iterator
from functools import reduce
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import blocks
from gridloom.functions.values import resolve_fill
from gridloom.model import Grid
from gridloom.operators.boxes import Boxes
from gridloom.operators.codec import (
    _VALUE_TYPES,
    CELL_ROWS,
    MAX_BOX_ELEMENTS,
    chunk_schema,
    decode_chunks,
    spark_type,
)
from gridloom.session import few_listers
from gridloom.sinks import commits
from gridloom.sinks.chunks import current_version, store_table


def store_record(spark: SparkSession, path: str) -> dict:
    """What is stored at ``path``, from the record its writer left."""
    record = commits.record_of(spark, path) or commits.set_record(spark, path)
    if record is None:
        raise FileNotFoundError(f"{path} holds no store")
    return record


def store_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per variable of a store: name, whether it is a coordinate, dims,
    sizes, chunk, shard and slab lengths, dtype, fill and codec."""
    return commits.description(spark, store_record(spark, path))


def _variables(spark, path: str, names) -> dict[str, dict]:
    """Entries of the named variables, or of all but the coordinates."""
    known = {v["name"]: v for v in store_record(spark, path)["variables"]}
    if names is None:
        return {n: v for n, v in known.items() if not v["coordinate"]}
    lacking = [n for n in names if n not in known]
    if lacking:
        raise KeyError(f"{path} has no variable {', '.join(lacking)}")
    return {n: known[n] for n in names}


def _dims(variables) -> tuple[str, ...]:
    return tuple(dict.fromkeys(d for v in variables for d in v["dims"]))


def _by(spark, path: str) -> tuple[str, ...]:
    """What separates the files of a set; a store has none."""
    record = commits.record_of(spark, path) or commits.set_record(spark, path) or {}
    return tuple(record.get("by", ()))


def read_chunks(
    spark: SparkSession,
    path: str,
    dims: tuple[str, ...] | None = None,
    by: tuple[str, ...] | None = None,
) -> DataFrame:
    """Chunk table at ``path``, of a store its current version. The schema is
    stated, so folder names such as shard labels keep their type and no file is
    opened to infer it. ``dims`` of all variables and ``by`` are those of the
    record, unless given."""
    if dims is None:
        dims = _dims(store_record(spark, path)["variables"])
    by = _by(spark, path) if by is None else by
    path = current_version(spark, path)
    with few_listers(spark):
        return spark.read.schema(chunk_schema([(n, "string") for n in by], dims)).parquet(path)


def overlapping(chunks: DataFrame, dim: str, lo: int, hi: int) -> DataFrame:
    """Chunks holding any position in ``[lo, hi)`` of ``dim``."""
    return chunks.filter((F.col(f"o_{dim}") < hi) & (F.col(f"o_{dim}") + F.col(f"n_{dim}") > lo))


def in_shards(
    chunks: DataFrame, dims: tuple[str, ...], dim: str, shard_len: int, lo: int, hi: int
) -> DataFrame:
    """Chunks in the shards that reach into ``[lo, hi)``: only their folders are listed."""
    index = F.split("shard", "[.]")[dims.index(dim)].cast("bigint")
    return chunks.filter(index.between(lo // shard_len, (hi - 1) // shard_len))


def holding(chunks: DataFrame, low=None, high=None) -> DataFrame:
    """Chunks that may hold a value in ``[low, high]``, by their zone maps: plain
    columns, so this filter is pushed to the scan and payloads of others stay
    unread. Text has no zones (``n_nan`` is null) and keeps all chunks."""
    unknown = F.col("n_nan").isNull()
    if low is not None:
        chunks = chunks.filter(unknown | (F.col("v_max") >= low))
    if high is not None:
        chunks = chunks.filter(unknown | (F.col("v_min") <= high))
    return chunks


def read_cells(
    spark: SparkSession,
    path: str,
    dims: tuple[str, ...] | None = None,
    by: tuple[str, ...] | None = None,
    variables: list[str] | None = None,
    window: dict[str, tuple[int, int]] | None = None,
    shard: dict[str, int] | None = None,
    without_fill: bool = False,
    kind: str | None = None,
    which: str | None = None,
    values: tuple | None = None,
) -> DataFrame:
    """Cells of the data variables of a store, or of those named.

    Variables, position windows and ranges of values cut down the chunks read, and
    windows the shard folders too. ``which`` is that of ``decode_chunks``. Dims,
    shard lengths, and the type of ``v``, are those the store states, unless given;
    variables that no one type holds have to be read one by one. ``values`` is a
    closed range of numbers; either end may be None. A variable without a dim of a
    window has no place in it and gives no cells.
    """
    if dims is None or kind is None and commits.record_of(spark, path):
        stored = _variables(spark, path, variables)
        dims = dims or _dims(stored.values())
        kind = kind or spark_type(v["dtype"] for v in stored.values())
        variables = list(stored)
        if shard is None and len({tuple(v["dims"]) for v in stored.values()}) == 1:
            known = next(iter(stored.values()))
            shard = dict(zip(known["dims"], known["shard"] or [])) if not by else None
    by = _by(spark, path) if by is None else by
    chunks = read_chunks(spark, path, dims, by)
    if variables is not None:
        chunks = chunks.filter(F.col("var").isin(variables))
    for dim, (lo, hi) in (window or {}).items():
        chunks = overlapping(chunks, dim, lo, hi)
        if (shard or {}).get(dim):
            chunks = in_shards(chunks, dims, dim, shard[dim], lo, hi)
    low, high = values or (None, None)
    cells = decode_chunks(holding(chunks, low, high), dims, by, without_fill, kind or "double", which)
    for dim, (lo, hi) in (window or {}).items():
        cells = cells.filter((F.col(f"{dim}_i") >= lo) & (F.col(f"{dim}_i") < hi))
    if low is not None:
        cells = cells.filter(~F.isnan("v") & (F.col("v") >= low))
    if high is not None:
        cells = cells.filter(F.col("v") <= high)
    return cells


def read_coordinate(spark: SparkSession, path: str, dim: str) -> DataFrame:
    """``<dim>_i`` and ``label`` of a store's coordinate."""
    cells = read_cells(spark, path, variables=[dim], which="present")
    return cells.select(f"{dim}_i", F.col("v").alias("label"))


def read_labelled(
    spark: SparkSession,
    path: str,
    dim: str,
    first,
    last,
    variables: list[str] | None = None,
) -> DataFrame:
    """Cells whose label along ``dim`` lies in ``[first, last]``, with the label.

    The coordinate is read through its own zone maps and gives the span of
    positions, so only the chunks of that span are read; labels need not ascend.
    Without a match, no rows.
    """
    label = F.col("label")
    wanted = read_coordinate(spark, path, dim).where(label.between(F.lit(first), F.lit(last)))
    lo, hi = wanted.agg(F.min(f"{dim}_i"), F.max(f"{dim}_i")).first()
    window = {dim: (lo, hi + 1) if lo is not None else (0, 0)}
    cells = read_cells(spark, path, variables=variables, window=window, which="present")
    return cells.join(wanted, f"{dim}_i")


def chunk_zones(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """Statistics of each chunk of a variable as they were written: its place, cells,
    present values, NaN, smallest and largest value. Payloads are not read. Slabs of
    a chunk come as one row."""
    entry = _variables(spark, path, [variable])[variable]
    chunks = read_chunks(spark, path).filter(F.col("var") == variable)
    index = [
        F.expr(f"o_{d} div {n}").alias(f"{d}_c") for d, n in zip(entry["dims"], entry["chunk"])
    ]
    return chunks.groupBy(*_by(spark, path), *index).agg(
        F.sum("n_cells").alias("n_cells"),
        F.sum("n_present").alias("n_present"),
        F.sum("n_nan").alias("n_nan"),
        F.min("v_min").alias("min_v"),
        F.max("v_max").alias("max_v"),
    )


def _filled(dims, every_dim, fills: dict, kind: str):
    """mapInArrow body: boxes that are not stored to cells of their fill."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shape = [row[f"n_{d}"] for d in dims]
                count = prod(shape)
                for lo in range(0, count, CELL_ROWS):
                    flat = np.arange(lo, min(lo + CELL_ROWS, count))
                    out = {"var": pa.repeat(pa.scalar(row["var"], pa.string()), len(flat))}
                    at = dict(zip(dims, np.unravel_index(flat, shape)))
                    for d in every_dim:
                        where = pa.array(at[d] + row[f"o_{d}"]) if d in at else None
                        out[f"{d}_i"] = pa.nulls(len(flat), pa.int64()) if where is None else where
                    given = np.full(len(flat), *fills[row["var"]])
                    out["v"] = pa.array(blocks.convert(given, _VALUE_TYPES[kind]))
                    yield pa.RecordBatch.from_pydict(out)

    return fill


def _absent(spark, entry: dict, chunks: DataFrame, every_dim, kind: str) -> DataFrame:
    """All cells of the boxes of a variable that are not stored."""
    dims, name = tuple(entry["dims"]), entry["name"]
    grid = Grid(dims, dict(zip(dims, entry["sizes"])), dict(zip(dims, entry["chunk"])))
    boxes = Boxes(grid, MAX_BOX_ELEMENTS, lens=tuple(entry["slab"]))
    stored = chunks.filter(F.col("var") == name).select(F.expr(boxes.number("o_", "")).alias("_box"))
    lacking = boxes.every(None, spark).select("_box").join(stored, "_box", "left_anti")
    fill = resolve_fill(entry["fill"], entry["dtype"]), blocks.held_as(entry["dtype"])
    columns = ["var", *(f"{d}_i" for d in every_dim)]
    schema = ", ".join(["var string", *(f"{c} bigint" for c in columns[1:]), f"v {kind}"])
    bounds = boxes.with_bounds(lacking).withColumn("var", F.lit(name)).drop("_box")
    return bounds.mapInArrow(_filled(dims, every_dim, {name: fill}, kind), schema)


def read_array(
    spark: SparkSession,
    path: str,
    grid: Grid | None = None,
    variables: dict[str, float] | list[str] | None = None,
) -> DataFrame:
    """Every cell of the data variables of a store, or of those named: chunks left
    out as empty are made again, with the fill the store states. A ``grid`` that is
    given is checked against the store. Chunks may be stored in slabs of any size."""
    stored = _variables(spark, path, None if variables is None else list(variables))
    for entry in stored.values():
        if grid and (entry["sizes"], entry["chunk"]) != (
            [grid.sizes[d] for d in grid.dims],
            list(grid.chunk_lens()),
        ):
            raise ValueError(f"the store holds sizes {entry['sizes']} in chunks {entry['chunk']}")
        if None in entry["sizes"]:
            raise ValueError(f"{entry['name']} has another size in each file")
    dims = _dims(stored.values())
    kind = spark_type(v["dtype"] for v in stored.values())
    chunks = read_chunks(spark, path).filter(F.col("var").isin(list(stored)))
    cells = decode_chunks(chunks, dims, kind=kind)
    absent = [_absent(spark, v, chunks, dims, kind) for v in stored.values()]
    return reduce(DataFrame.unionByName, absent, cells)

"""Vectors as whole numbers, packed into blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20  # whole numbers of one block
EXACT = 1 << 53  # whole numbers that a double tells apart


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite entries only."""
    bad = f"exists(`{vector}`, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return vectors.where(f"`{vector}` is not null and not {bad}")


def floored(vector: str, scale: int, shift: int = 0) -> str:
    """SQL: every entry as floor(scale * x) + shift; one too large to be a whole
    number of a double fails the job."""
    wide = "raise_error(concat('entry too large: ', cast(x as string)))"
    whole = f"cast(floor({scale} * cast(x as double)) as bigint) + {shift}L"
    fits = f"abs({scale} * cast(x as double)) < {EXACT}D"
    return f"transform(`{vector}`, x -> case when {fits} then {whole} else cast({wide} as bigint) end)"


def matrix(column, dims: int) -> np.ndarray:
    """Rows of a list column as one matrix; missing last entries are 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def in_blocks(
    rows: DataFrame,
    dims: int,
    schema: str,
    block: Callable[[list[np.ndarray | pa.Array], np.ndarray], dict],
) -> DataFrame:
    """One row for each block of at most ``BLOCK_BYTES`` of vectors. The last
    column of ``rows`` is the vector; ``block`` makes the columns of a row from
    the other columns (Arrow arrays) and the matrix."""
    limit = max(64, BLOCK_BYTES // (8 * max(dims, 1)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            *others, x = [c.chunk(0) for c in table.columns]
            return pa.RecordBatch.from_pylist([block(others, matrix(x, dims))])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, limit - sum(b.num_rows for b in held))
                batch = batch.slice(part.num_rows)
                held.append(part)
                if sum(b.num_rows for b in held) == limit:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return rows.mapInArrow(cut, schema)


def dims_of(rows: DataFrame, vector: str) -> int:
    """The length of the longest vector; 0 without rows."""
    return rows.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]

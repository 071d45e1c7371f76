"""What was read: one row per file of a run, beside the cells it gave.

A ledger has ``dataset``, ``file``, ``status`` (``read``, ``missing`` or
``failed``), ``error`` and ``cells``. It tells an empty array, read and without
cells, from input that never arrived, and carries the reason of a failed read to
the results of the run instead of ending it.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import materialized
from gridloom.sources.manifest import scan_files

_KEYS = ("dataset", "file")
LEDGER = "dataset string, file string, status string, error string, cells bigint"


def counted(cells: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger of ``files`` (dataset, file) where no reader kept one: a file without
    any cell counts as never read. One count per file, partial in each task."""
    seen = cells.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("cells"))
    return files.select(*_KEYS).join(seen, list(_KEYS), "left").select(
        *_KEYS,
        F.when(F.col("cells") > 0, "read").otherwise("missing").alias("status"),
        F.lit(None).cast("string").alias("error"),
        F.coalesce("cells", F.lit(0)).cast("bigint").alias("cells"),
    )


def read_files(
    spark: SparkSession, files: DataFrame, root: str, schema: str
) -> tuple[DataFrame, DataFrame]:
    """Cells of Parquet files below ``root``, and the ledger of reading them.

    ``files`` has ``dataset``, ``file`` and ``rel_path``, the place below ``root``;
    ``schema`` names the cell columns. Every file is parsed in a task of its own
    batch of files: one that is broken, or lacks a column, gives a ledger row with
    the reason and no cells, and one that is not there is ``missing``. Both tables
    come from one written pass, so a file is opened once. A file must fit into a
    task; Spark's ``binaryFile`` source holds up to 2 GB.
    """
    names = [c.strip().split(" ")[0].strip("`") for c in schema.split(",")]
    wanted = files.select(*_KEYS, "rel_path")
    content = scan_files(spark, root, content=True).select("rel_path", "content")
    target = spark.createDataFrame([], schema).schema
    arrow = pa.schema([(f.name, _ARROW_TYPES[f.dataType.simpleString()]) for f in target])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dataset, file, data in zip(*(batch.column(c) for c in (*_KEYS, "content"))):
                status, error, cells = "read", None, 0
                try:
                    table = pq.read_table(pa.BufferReader(data.as_buffer())).select(names)
                    parts = table.cast(arrow).to_batches(max_chunksize=65_536)
                except Exception as exc:  # whatever a broken file makes the parser say
                    status, error, parts = "failed", f"{type(exc).__name__}: {exc}".splitlines()[0], []
                for part in parts:
                    cells += part.num_rows
                    yield _rows(part, dataset, file, None, None, None)
                yield _rows(_blank(arrow), dataset, file, status, error, cells)

    found = wanted.join(content, "rel_path").select(*_KEYS, "content")
    out = f"dataset string, file string, {schema}, _status string, _error string, _cells bigint"
    rows = materialized(found.mapInArrow(parse, out))
    done = rows.where("_status is not null").selectExpr(
        *_KEYS, "_status AS status", "_error AS error", "_cells AS cells"
    )
    ledger = wanted.join(done, list(_KEYS), "left").select(
        *_KEYS,
        F.coalesce("status", F.lit("missing")).alias("status"),
        "error",
        F.coalesce("cells", F.lit(0)).cast("bigint").alias("cells"),
    )
    return rows.where("_status is null").select(*_KEYS, *names), ledger


_ARROW_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "smallint": pa.int16(),
    "tinyint": pa.int8(),
    "double": pa.float64(),
    "float": pa.float32(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp_ntz": pa.timestamp("us"),
}


def _blank(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in schema], schema=schema)


def _rows(part: pa.RecordBatch, dataset, file, status, error, cells) -> pa.RecordBatch:
    n = part.num_rows
    columns = [pa.repeat(dataset, n), pa.repeat(file, n), *part.columns]
    columns += [pa.array([status] * n, pa.string()), pa.array([error] * n, pa.string())]
    columns += [pa.array([cells] * n, pa.int64())]
    names = [*_KEYS, *part.schema.names, "_status", "_error", "_cells"]
    return pa.RecordBatch.from_arrays(columns, names=names)

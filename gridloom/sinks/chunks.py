"""Write chunk tables."""

import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import materialized, qualified, rows_only_batches, scratch_folder
from gridloom.sinks import commits
from gridloom.sinks.objects import open_path

# A chunk row can be tens of megabytes: check sizes per row, and do not
# compress payloads a second time.
_LAYOUT = {
    "compression": "none",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "8",
    "parquet.page.size.row.check.min": "1",
    "parquet.enable.dictionary#payload": "false",
}
KEPT = 2  # versions of a store that stay: the current one and the one before


def _write(chunks: DataFrame, path: str, scope: str, by: tuple[str, ...] = ()) -> str:
    writer = chunks.write.mode("overwrite").options(**_LAYOUT)
    with rows_only_batches(chunks.sparkSession):
        writer.option("partitionOverwriteMode", scope).partitionBy(*by).parquet(path)
    return path


def packed(chunks: DataFrame) -> DataFrame:
    """``chunks`` packed once, as a table in the shared folder with many files of the
    array in each of its own."""
    folder = _write(chunks, scratch_folder(chunks.sparkSession, "packed"), "static")
    return chunks.sparkSession.read.schema(chunks.schema).parquet(folder)


def _folder(path: str, prefix: str, number: int) -> str:
    return f"{path.rstrip('/')}/{prefix}{number:08d}"


def current_version(spark: SparkSession, path: str) -> str:
    """Where the newest committed version of a store is; other tables are as they
    are."""
    record = commits.record_of(spark, path)
    return _folder(path, commits.VERSION, record["number"]) if record else path


def write_store(
    chunks: DataFrame,
    path: str,
    tables: dict[str, DataFrame] | None = None,
    variables: list[dict] | None = None,
) -> str:
    """A new version of the store at ``path``; a shard is one folder per variable.

    Readers see it once its commit record is written, which is the last step, and
    then all of it. Until then, and after a failure, they read the version before,
    which is kept until the next good write. ``tables`` go with the version, such
    as ``attributes``. ``variables`` describe what is stored (see
    ``commits.describe``); without them they are taken from the rows, which know no
    shard lengths and no variable without chunks. One writer at a time.
    """
    spark = chunks.sparkSession
    number = commits.next_number(spark, path)
    for name, table in (tables or {}).items():
        table.write.mode("overwrite").parquet(f"{_folder(path, commits.TABLES, number)}/{name}")
    folder = _write(chunks, _folder(path, commits.VERSION, number), "static", ("var", "shard"))
    if variables is None:
        variables = _found(spark.read.schema(chunks.schema).parquet(folder))
    commits.commit(
        spark, path, number, {"variables": variables, "tables": sorted(tables or {})}
    )
    _forget(spark, path)
    return path


def _found(chunks: DataFrame) -> list[dict]:
    """Variables as their chunk rows state them."""
    facts = ("dims", "shape", "chunk", "slab", "dtype", "fill", "codec", "level", "shuffle")
    rows = chunks.groupBy("var").agg(*(F.first(c).alias(c) for c in facts)).collect()
    return [
        {"name": r["var"], "sizes": r["shape"], "shard": None, "coordinate": False}
        | {c: r[c] for c in facts if c != "shape"}
        for r in rows
    ]


def _forget(spark: SparkSession, path: str) -> None:
    """Drop versions older than the last ``KEPT`` committed ones, record first, and
    folders of writes that never were committed."""
    known = commits.numbers(spark, path)
    files, make = commits.file_system(spark, path)
    for number in known[:-KEPT]:
        files.delete(make(f"{path.rstrip('/')}/commits/{number:08d}.json"), False)
    for number, name in commits.numbered(spark, path):
        if number < known[-1] and number not in known[-KEPT:]:
            files.delete(make(f"{path.rstrip('/')}/{name}"), True)


def store_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table that was written with the current version of a store."""
    record = commits.record_of(spark, path)
    if not record or name not in record["tables"]:
        raise FileNotFoundError(f"{path} has no table {name}")
    return spark.read.parquet(f"{_folder(path, commits.TABLES, record['number'])}/{name}")


def replace_files(chunks: DataFrame, path: str, by: tuple[str, ...] = ("file",)) -> str:
    """Replace only the files present in ``chunks``, a written table, once the job has
    succeeded; a failed job leaves every earlier output as it was.

    A file is a folder, named as Spark's ``partitionBy`` names it. In a local or mounted
    folder the tasks write its rows themselves, under a hidden name first: for each file
    that Spark writes there, Hadoop starts four programs to set permissions, which takes
    longer than all else.
    """
    spark = chunks.sparkSession
    base = qualified(spark, path).rstrip("/")
    if not base.startswith("file:"):
        return _write(chunks, path, "dynamic", by)
    files, make = commits.file_system(spark, path)
    files.mkdirs(make(path))
    hidden = f"{base}/.staged-{uuid.uuid4().hex}"
    keys = ", ".join(f"`{name}` string" for name in by)
    try:
        # what a failed attempt wrote is in no row, and stays behind
        written = materialized(
            chunks.sortWithinPartitions(*by).mapInArrow(_staging(hidden, by), f"{keys}, _name string")
        )
        # an empty name and none are one folder
        folders = [F.expr(f"nullif(`{name}`, '')").alias(name) for name in by]
        parts = written.groupBy(*folders).agg(F.collect_list("_name").alias("_names"))
        materialized(parts.mapInArrow(_placing(hidden, base, by), "_files bigint"))
    finally:
        files.delete(make(hidden), True)
    return path


def _staging(hidden: str, by: tuple[str, ...]):
    """mapInArrow body over rows sorted by ``by``: a Parquet file for each value."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_path(hidden)
        fs.create_dir(folder, recursive=True)
        attempt, numbers = uuid.uuid4().hex, count()
        held, writer = None, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                done = []
                rows = batch.drop_columns(list(by))
                for start, end in _spans([batch.column(c) for c in by]):
                    key = tuple(batch.column(c)[start].as_py() for c in by)
                    if writer is None or key != held:
                        if writer is not None:
                            writer.close()
                        held, name = key, f"part-{attempt}-{next(numbers):06d}.parquet"
                        writer = _writer(fs, f"{folder}/{name}", rows.schema)
                        done.append((*key, name))
                    writer.write_batch(rows.slice(start, end - start))
                columns = zip(*done) if done else [[]] * (len(by) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns], names=[*by, "_name"]
                )
        finally:
            if writer is not None:
                writer.close()

    return stage


def _spans(columns: list[pa.Array]) -> list[tuple[int, int]]:
    """Where runs of equal values of all columns begin and end."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], len(new)]))


def _writer(fs, path: str, schema: pa.Schema) -> pq.ParquetWriter:
    plain = [f.name for f in schema if not pa.types.is_binary(f.type)]
    flat = [name for name in plain if not pa.types.is_list(schema.field(name).type)]
    return pq.ParquetWriter(
        path, schema, filesystem=fs, compression="none", use_dictionary=plain, write_statistics=flat
    )


def _placing(hidden: str, base: str, by: tuple[str, ...]):
    """mapInArrow body: move what was written for each file into its folder, in place of
    what is there. Safe to repeat."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_path(base)
        staged = open_path(hidden)[1]
        for batch in batches:
            for *key, names in zip(*(batch.column(c).to_pylist() for c in range(len(by) + 1))):
                folder = "/".join([root, *(f"{n}={_escaped(v)}" for n, v in zip(by, key))])
                fs.create_dir(folder, recursive=True)
                there = {f.base_name: f for f in fs.get_file_info(pafs.FileSelector(folder))}
                for name, info in there.items():
                    if name not in names:
                        (fs.delete_dir if info.type == pafs.FileType.Directory else fs.delete_file)(info.path)
                for name in names:
                    if name not in there:
                        fs.move(f"{staged}/{name}", f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["_files"])

    return place


_UNSAFE = {chr(c) for c in range(1, 32)} | set("\"#%'*/:=?\\\x7f{[]^")


def _escaped(value: str | None) -> str:
    """A value in the name of a folder, as Spark's ``partitionBy`` writes it."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in _UNSAFE else c for c in value)

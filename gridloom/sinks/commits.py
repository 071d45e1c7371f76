"""Commit records: what a store holds, written as the last step of a write.

A record is one small JSON file below ``commits``, numbered upwards; the newest one
says which folder holds the chunks and describes every variable. A version without
a record does not exist for readers, whatever Spark's committer leaves behind, and
its folder is never written again. One writer at a time.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from gridloom.model import Arrays
from gridloom.operators.boxes import Boxes

_FOLDER = "commits"
VERSION = "version-"
TABLES = "tables-"
DESCRIPTION = (
    "name string, coordinate boolean, dims array<string>, sizes array<bigint>, "
    "chunk array<bigint>, shard array<bigint>, slab array<bigint>, dtype string, "
    "fill string, codec string, level int, shuffle boolean"
)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its way to make a path."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _children(spark, path: str) -> list[str]:
    files, make = file_system(spark, path)
    if not files.exists(make(path)):
        return []
    return [s.getPath().getName() for s in files.listStatus(make(path))]


def numbers(spark, path: str) -> list[int]:
    """Numbers of the committed versions of a store, oldest first."""
    found = _children(spark, f"{path.rstrip('/')}/{_FOLDER}")
    return sorted(int(n.removesuffix(".json")) for n in found if n[:1].isdigit() and n.endswith(".json"))


def numbered(spark, path: str) -> list[tuple[int, str]]:
    """Folders of all versions of a store, committed or not, with their numbers."""
    found = []
    for name in _children(spark, path):
        for prefix in (VERSION, TABLES):
            rest = name.removeprefix(prefix)
            if rest != name and rest.isdigit():
                found.append((int(rest), name))
    return found


def next_number(spark, path: str) -> int:
    """A number that no commit and no folder, finished or not, has."""
    used = [0, *numbers(spark, path), *(number for number, _ in numbered(spark, path))]
    return max(used) + 1


def _text(spark, path: str) -> str:
    files, make = file_system(spark, path)
    stream = files.open(make(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark, path: str, text: str, replace: bool = False) -> None:
    """Write a small file under another name and move it into place: it is there
    whole or not at all. Without ``replace`` an existing one is an error."""
    files, make = file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    hidden = make(f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = files.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(make(path)):
        if not replace:
            files.delete(hidden, False)
            raise FileExistsError(f"{path} was written by another job")
        files.delete(make(path), False)
    if not files.rename(hidden, make(path)):
        raise OSError(f"{path} could not be written")


def commit(spark, path: str, number: int, record: dict) -> None:
    put_text(spark, f"{path.rstrip('/')}/{_FOLDER}/{number:08d}.json", json.dumps(record))


def record_of(spark, path: str, number: int | None = None) -> dict | None:
    """The newest record of a store, or that of one version; none where nothing was
    committed."""
    if number is None:
        known = numbers(spark, path)
        if not known:
            return None
        number = known[-1]
    record = json.loads(_text(spark, f"{path.rstrip('/')}/{_FOLDER}/{number:08d}.json"))
    return record | {"number": number}


# The record of a set of files replaced one by one lies beside their folders.
_SET = "_set.json"


def put_set_record(spark, path: str, record: dict) -> None:
    put_text(spark, f"{path.rstrip('/')}/{_SET}", json.dumps(record), replace=True)


def set_record(spark, path: str) -> dict | None:
    files, make = file_system(spark, path)
    at = f"{path.rstrip('/')}/{_SET}"
    return json.loads(_text(spark, at)) if files.exists(make(at)) else None


def forget_folder(spark, path: str) -> None:
    files, make = file_system(spark, path)
    files.delete(make(path), True)


def describe(
    arrays: list[Arrays], fills: dict, codec: str, level: int, shuffle: bool, max_box_elements: int
) -> list[dict]:
    """Entries of a record for the variables of ``arrays``."""
    out = []
    for given in arrays:
        grid = given.grid
        for name, dtype in given.variables.items():
            out.append(
                {
                    "name": name,
                    "coordinate": given.coordinate,
                    "dims": list(grid.dims),
                    "sizes": [grid.sizes.get(d) for d in grid.dims],
                    "chunk": list(grid.chunk_lens()),
                    "shard": [grid.shard.get(d, grid.sizes.get(d)) for d in grid.dims],
                    "slab": list(Boxes(grid, max_box_elements).lens),
                    "dtype": dtype,
                    "fill": str(fills[name]),
                    "codec": codec,
                    "level": level,
                    "shuffle": shuffle,
                }
            )
    return out


def description(spark: SparkSession, record: dict) -> DataFrame:
    """The variables of a record as a table, one row each."""
    names = [c.strip().split(" ")[0] for c in DESCRIPTION.split(",")]
    rows = [tuple(v[n] for n in names) for v in record["variables"]]
    return spark.createDataFrame(rows, DESCRIPTION)

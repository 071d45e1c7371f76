"""Rechunk and compress every file of a work list, one output per input."""

from math import ceil

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.contract import RECHUNK_CODEC
from gridloom.functions.ordering import broadcast_within
from gridloom.model import Arrays, Grid
from gridloom.operators.boxes import Boxes
from gridloom.operators.codec import MAX_BOX_ELEMENTS, encode_arrays, every_dim, fills_of
from gridloom.operators.selecting import strip_global_attrs
from gridloom.plans.store import coordinate
from gridloom.session import few_listers, materialized
from gridloom.sinks.chunks import KEPT, packed, replace_files
from gridloom.sinks.commits import describe, file_system, forget_folder, put_set_record, set_record
from gridloom.sinks.results import RunFailed, file_results
from gridloom.sources.ledger import counted
from gridloom.sources.store import read_chunks

BY = ("dataset", "file")
_ATTRIBUTES = "_attributes"
_DESCRIBED = "scope string, key string, value string, dataset string, file string"
# Files whose attributes, a few rows each, one task writes.
TASK_FILES = 10_000


def _expected(arrays, sizes: DataFrame) -> DataFrame:
    """Chunk rows each file must have, and its data variables."""
    spark, total = sizes.sparkSession, None
    for given in arrays:
        grid = given.grid
        longest = {
            d: sizes.agg(F.max(f"size_{d}")).first()[0] or 0 for d in grid.dims if d not in grid.sizes
        }
        some = Boxes(grid, MAX_BOX_ELEMENTS, longest).every(sizes, spark)
        some = some.select(*BY, F.lit(len(given.variables)).alias("rows"))
        total = some if total is None else total.unionByName(some)
    data = sum(len(a.variables) for a in arrays if not a.coordinate)
    return total.groupBy(*BY).agg(F.sum("rows").alias("chunks")).withColumn("variables", F.lit(data))


def rechunk(
    cells: DataFrame,
    sizes: DataFrame,
    work: DataFrame,
    grid: Grid,
    variables: dict[str, str],
    level: int,
    out: str,
    stop_on_error: bool = True,
    fill=float("nan"),
    ledger: DataFrame | None = None,
    coordinates: dict[str, DataFrame] | None = None,
    attributes: DataFrame | None = None,
) -> DataFrame:
    """Write chunk rows of each file below ``out`` and return the result rows.

    ``sizes`` names the files of this run: each that was read gets all of its
    chunks, empty ones too, so that it always replaces its earlier output. What was
    read is told by ``ledger``; without one, a file that gave no cells was not. A
    file that was not read is a failure and its earlier output stays.

    ``coordinates`` by dim (dataset, file, ``<dim>_i``, label) go into the files as
    1-D variables, and ``attributes`` beside them, without the global ones of the
    datasets that drop those.

    With ``stop_on_error`` the first bad file fails the job before anything is
    replaced. Otherwise chunks are written to the scratch folder first, and
    only files without errors replace their earlier output.
    """
    spark = cells.sparkSession
    if ledger is None:
        ledger = counted(cells, sizes)
    ledger = materialized(ledger)
    arrays = [Arrays(cells, grid, variables)]
    arrays += [coordinate(t, d, grid.sizes, {"chunk_map": grid.chunk | _whole(sizes, grid)})
               for d, t in (coordinates or {}).items()]
    expected = _expected(arrays, sizes)
    dims = every_dim(arrays)
    fill = fill if isinstance(fill, dict) else dict.fromkeys(variables, fill)
    encoded = encode_arrays(
        arrays,
        by=BY,
        sizes=sizes,
        level=level,
        fill=fill,
        drop_empty=False,
        strict=stop_on_error,
        **RECHUNK_CODEC,
    )
    unread = sizes.select(*BY).join(ledger.where("status = 'read'"), list(BY), "left_anti")
    if stop_on_error:
        lost = unread.join(ledger, list(BY), "left").select("file", "error").first()
        if lost is not None:
            raise RunFailed(f"{lost['file']} was not read: {lost['error'] or 'no such input'}")
        try:
            replace_files(packed(encoded), out, BY)
        except PySparkException as exc:
            raise RunFailed(str(exc)) from exc
        good = sizes.select(*BY)
        written = read_chunks(spark, out, dims, BY).join(good, list(BY), "semi")
        results = file_results(work, _data_only(written, arrays), expected, ledger)
    else:
        chunks = packed(encoded)
        bad = chunks.filter(F.col("error").isNotNull()).select(*BY).union(unread).distinct()
        bad = broadcast_within(materialized(bad))
        replace_files(chunks.join(bad, list(BY), "left_anti"), out, BY)
        good = sizes.select(*BY).join(bad, list(BY), "left_anti")
        results = file_results(work, _data_only(chunks, arrays), expected, ledger)
    record = {"by": list(BY), "attributes": (set_record(spark, out) or {}).get("attributes", [])}
    if attributes is not None:
        kept = strip_global_attrs(attributes).join(good, list(BY), "semi")
        record["attributes"] = _describe(spark, out, kept, record["attributes"], sizes.count())
    fills = {}
    for given in arrays:
        fills |= fills_of(given.variables, fill if not given.coordinate else
                          {v: "0" for v, d in given.variables.items() if d[0] in "iub"})
    entries = describe(arrays, fills, level=level, max_box_elements=MAX_BOX_ELEMENTS, **RECHUNK_CODEC)
    put_set_record(spark, out, record | {"variables": entries})
    if len(old := record["attributes"][:-KEPT]):
        forget_folder(spark, f"{out.rstrip('/')}/{_attributes_folder(old[-1])}")
    return results


def _attributes_folder(number: int) -> str:
    return f"{_ATTRIBUTES}-{number:08d}"


def _describe(spark, out: str, given: DataFrame, numbers: list[int], files: int) -> list[int]:
    """Write the attributes of all files below ``out`` as one table: those ``given``,
    and for files that these do not name the ones they had. A folder for each file
    would cost more than all of its attributes. Readers see the table once the set's
    record names its number, which is last of those returned."""
    given = materialized(given.select(*[c.split(" ")[0] for c in _DESCRIBED.split(", ")]))
    system, make = file_system(spark, out)
    if numbers or system.exists(make(_attributes_at(spark, out))):
        before = file_attributes(spark, out)
        given = given.unionByName(before.join(given.select(*BY).distinct(), list(BY), "left_anti"))
        files = max(files, before.select(*BY).distinct().count())
    number = max(numbers, default=0) + 1
    table = given.repartition(max(1, ceil(files / TASK_FILES)), *BY)
    table.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{_attributes_folder(number)}")
    return [*numbers, number]


def _whole(sizes: DataFrame, grid: Grid) -> dict[str, int]:
    """A coordinate of a dim that is not chunked is one chunk; a dim of open size
    always is chunked."""
    return {d: grid.sizes[d] for d in grid.dims if d not in grid.chunk and d in grid.sizes}


def _data_only(chunks: DataFrame, arrays) -> DataFrame:
    """Chunk rows with the cells of coordinates counted as none: the ledger counts
    cells of the data."""
    labels = [v for a in arrays if a.coordinate for v in a.variables]
    if not labels:
        return chunks
    cells = F.when(F.col("var").isin(labels), F.lit(0)).otherwise(F.col("n_cells"))
    return chunks.withColumn("n_cells", cells.cast("bigint"))


def _attributes_at(spark, out: str) -> str:
    """The newest table of attributes, or the folder that held one for each file."""
    numbers = (set_record(spark, out) or {}).get("attributes")
    return f"{out.rstrip('/')}/{_attributes_folder(numbers[-1]) if numbers else _ATTRIBUTES}"


def file_attributes(spark, out: str) -> DataFrame:
    """Attributes of the files below ``out`` as rechunking left them."""
    with few_listers(spark):
        return spark.read.schema(_DESCRIBED).parquet(_attributes_at(spark, out))

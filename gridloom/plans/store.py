"""Build one sharded store per dataset."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.contract import STORE_CODEC
from gridloom.functions.values import resolve_fill
from gridloom.model import Arrays, Grid
from gridloom.operators.codec import (
    MAX_BOX_ELEMENTS,
    _VALUE_TYPES,
    encode_arrays,
    fills_of,
)
from gridloom.session import materialized
from gridloom.sinks.chunks import write_store
from gridloom.sinks.commits import describe
from gridloom.sources.cells import concat, file_offsets, label_dictionary, place_by_labels
from gridloom.sources.manifest import in_order, sample_file


def _grid(dims, sizes, spec) -> Grid:
    """Grid of arrays over ``dims``; entries of other dims do not concern them."""
    chunk, shard = (
        {d: n for d, n in spec[key].items() if d in dims} for key in ("chunk_map", "shard_map")
    )
    return Grid(dims, {d: sizes[d] for d in dims}, chunk, shard)


def coordinate(labels: DataFrame, dim: str, sizes: dict[str, int], spec: dict | None = None) -> Arrays:
    """A coordinate as a 1-D array: ``labels`` has ``<dim>_i`` and one label column.
    It is chunked like its dim, and one shard."""
    label = next(c for c in labels.columns if c not in (f"{dim}_i", "file", "dataset"))
    chunk = {dim: spec["chunk_map"][dim]} if spec and dim in spec["chunk_map"] else {}
    grid = Grid((dim,), {dim: sizes[dim]} if dim in sizes else {}, chunk)
    kind = dict(labels.dtypes)[label]
    return Arrays(labels.withColumnRenamed(label, dim), grid, {dim: _VALUE_TYPES[kind]}, True)


def fill_map(arrays: list[Arrays], spec: dict) -> dict:
    """Fill of each variable: the one named in ``fill_values``, or the one of the
    contract, which is meant for numbers; text and times fall back on their own."""
    named, one = spec.get("fill_values", {}), None
    if "fill_value" in spec:
        one = resolve_fill(spec["fill_value"], spec["fill_value_dtype"])
    out = {}
    for given in arrays:
        for v, dtype in given.variables.items():
            if v in named:
                out[v] = named[v]
            elif given.coordinate:
                out |= {v: "0"} if dtype[0] in "iub" else {}
            elif one is not None and (dtype[0] in "iuf" or isinstance(one, str) and dtype == "str"):
                out[v] = one
    return out


def write_arrays(
    arrays: list[Arrays],
    spec: dict,
    out: str,
    attributes: DataFrame | None = None,
    codec: dict = STORE_CODEC,
    max_box_elements: int = MAX_BOX_ELEMENTS,
) -> str:
    """Store of variables over any dims, coordinates among them, packed behind one
    shuffle and committed as one version; replaces what is at ``out``."""
    fill = fill_map(arrays, spec)
    chunks = encode_arrays(arrays, fill=fill, max_box_elements=max_box_elements, **codec)
    fills = {}
    for given in arrays:
        fills |= fills_of(given.variables, fill)
    tables = {"attributes": attributes} if attributes is not None else {}
    return write_store(chunks, out, tables, describe(arrays, fills, max_box_elements=max_box_elements, **codec))


def store_name(dataset: str, dry_run: bool) -> str:
    return f"{dataset}_dryrun" if dry_run else dataset


def single_source_store(
    cells: DataFrame,
    dims: tuple[str, ...],
    sizes: dict[str, int],
    variables: dict[str, str],
    spec: dict,
    out: str,
    coordinates: dict[str, DataFrame] | None = None,
    attributes: DataFrame | None = None,
    others: list[tuple[DataFrame, tuple[str, ...], dict[str, str]]] = (),
) -> str:
    """Store of one source: its array, its coordinates by dim, its attributes, and
    ``others``, variables over other dims (cells, dims, dtypes)."""
    arrays = [Arrays(cells, _grid(dims, sizes, spec), variables)]
    arrays += [Arrays(c, _grid(d, sizes, spec), v) for c, d, v in others]
    arrays += [coordinate(t, dim, sizes, spec) for dim, t in (coordinates or {}).items()]
    return write_arrays(arrays, spec, out, attributes)


def many_files_store(
    cells: DataFrame,
    files: DataFrame,
    dims: tuple[str, ...],
    sizes: dict[str, int],
    variables: dict[str, str],
    spec: dict,
    out: str,
    along: str = "time",
    dry_run: bool = False,
    coordinates: dict[str, DataFrame] | None = None,
    attributes: DataFrame | None = None,
) -> str:
    """Join all files along ``along`` and store the result as one array, with its
    coordinates and attributes.

    ``files`` has one row per file: ``file`` and ``size_<along>``. The coordinate
    of ``along`` is given per file (``file``, ``<along>_i``, label) and joined like
    the cells; others are those of the whole store. ``attributes`` with a ``file``
    column are those of the first file, as when files are opened one behind the
    other. A dry run takes the tenth file only and never touches the store itself:
    it writes beside it, under a name of its own. Returns where the store is.
    """
    placed = file_offsets(files, along)
    found = placed.agg(F.count(F.lit(1)), F.sum(f"size_{along}")).first()
    n_files, length = found[0], found[1]
    if n_files < 2:
        raise FileNotFoundError("a store of many files needs at least two")
    coordinates = dict(coordinates or {})
    if dry_run:
        # the tenth file on its own, from the start of the array
        placed = sample_file(in_order(placed, "file")).withColumn(
            "offset", F.lit(0).cast("bigint")
        )
        n_files, length = 1, placed.first()[f"size_{along}"]
        only = F.broadcast(placed.select("file"))
        cells = cells.join(only, "file", "semi")
        if along in coordinates:
            coordinates[along] = coordinates[along].join(only, "file", "semi")
    joined = concat(cells, placed, along, files=n_files)
    if along in coordinates:
        coordinates[along] = concat(coordinates[along], placed, along, files=n_files).drop("file")
    if attributes is not None and "file" in attributes.columns:
        first = placed.orderBy("offset", F.col(f"size_{along}")).limit(1).select("file")
        attributes = attributes.join(F.broadcast(first), "file", "semi").drop("file")
    return single_source_store(
        joined,
        dims,
        {**sizes, along: length},
        variables,
        spec,
        store_name(out.rstrip("/"), dry_run),
        coordinates,
        attributes,
    )


def outer_files_store(
    cells: DataFrame,
    labels: dict[str, str],
    variables: dict[str, str],
    spec: dict,
    out: str,
    attributes: DataFrame | None = None,
) -> str:
    """Join files whose labels differ in any of several dims: each dim runs over the
    sorted union of its labels. ``labels`` maps dims, in the order of the array, to
    label columns. One dictionary of all labels, made in one pass, gives the sizes,
    the coordinates of the store and the place of every cell; cells that two files
    both give are an error."""
    dictionary = materialized(label_dictionary(cells, labels))
    counts = dictionary.groupBy("dim").count().collect()  # one row per dim
    sizes = {r["dim"]: r["count"] for r in counts}
    coordinates = {
        d: dictionary.where(F.col("dim") == d).select(
            F.col("position").alias(f"{d}_i"), F.col(f"label_{d}").alias("label")
        )
        for d in labels
    }
    placed = place_by_labels(cells, labels, dictionary)
    return single_source_store(
        placed, tuple(labels), sizes, variables, spec, out, coordinates, attributes
    )

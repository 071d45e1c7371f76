"""Cell tables: arrays as rows of positions and values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import paths
from gridloom.functions.ordering import broadcast_within, with_running_total


def explode_array(df: DataFrame, row: str, array: str, dims: tuple[str, str]) -> DataFrame:
    """Rows holding an array column, as 2-D cells."""
    outer, inner = dims
    return df.select(
        F.col(row).cast("bigint").alias(f"{outer}_i"),
        F.posexplode(array).alias("_at", "v"),
    ).select(f"{outer}_i", F.col("_at").cast("bigint").alias(f"{inner}_i"), "v")


def file_extents(cells: DataFrame, dim: str, by: tuple[str, ...] = ("file",)) -> DataFrame:
    """Length of ``dim`` in each file, where no file header states it."""
    return cells.groupBy(*by).agg((F.max(f"{dim}_i") + 1).alias(f"size_{dim}"))


def file_offsets(
    files: DataFrame, dim: str, file: str = "file", order: list[Column] | None = None
) -> DataFrame:
    """Add ``offset``: where each file starts along ``dim`` once all are joined."""
    order = order or [paths.parts(F.col(file))]
    return with_running_total(files, order, "offset", size=F.col(f"size_{dim}"))


def concat(
    cells: DataFrame, offsets: DataFrame, dim: str, file: str = "file", files: int | None = None
) -> DataFrame:
    """Join files end to end along ``dim``: positions move by the file's offset.
    Nothing is sorted by label or dropped as a repeat; cells of a file without an
    offset are an error. ``files`` is the number of files, if known."""
    start = broadcast_within(offsets.select(file, "offset"), rows=files)
    unknown = F.raise_error(F.concat(F.lit("no offset for "), F.coalesce(F.col(file), F.lit("a file without a name"))))
    moved = F.coalesce("offset", unknown.cast("bigint")) + F.col(f"{dim}_i")
    return cells.join(start, file, "left").withColumn(f"{dim}_i", moved).drop("offset")


def label_positions(cells: DataFrame, label: str, dim: str) -> DataFrame:
    """Give ``dim`` positions over the sorted union of the labels of all files,
    so files with differing labels line up and gaps stay absent. A NULL label has
    no place in that order and is an error."""
    known = cells.select(label).where(F.col(label).isNotNull()).distinct()
    index = with_running_total(known, [F.col(label)], "_place")
    missing = F.raise_error(F.lit(f"a cell has no {label}")).cast("bigint")
    placed = cells.drop(f"{dim}_i").join(broadcast_within(index), label, "left")
    return placed.withColumn(f"{dim}_i", F.coalesce("_place", missing)).drop("_place")


def label_dictionary(cells: DataFrame, labels: dict[str, str]) -> DataFrame:
    """``dim``, ``position`` and ``label_<dim>``: the sorted union of the labels of
    all files, for several dims in one pass over the cells. ``labels`` maps each dim
    to its label column; a cell without a label is an error."""
    kinds = dict(cells.dtypes)

    def entry(dim: str):
        missing = F.raise_error(F.lit(f"a cell has no {labels[dim]}"))
        own = F.coalesce(F.col(labels[dim]), missing.cast(kinds[labels[dim]]))
        held = [
            (own if d == dim else F.lit(None).cast(kinds[label])).alias(f"label_{d}")
            for d, label in labels.items()
        ]
        return F.struct(F.lit(dim).alias("dim"), *held)

    known = cells.select(F.explode(F.array(*map(entry, labels))).alias("r")).select("r.*").distinct()
    # one sort of all dims; each starts at its own first place
    order = [F.col("dim"), *(F.col(f"label_{d}") for d in labels)]
    placed = with_running_total(known, order, "_place")
    first = placed.groupBy("dim").agg(F.min("_place").alias("_first"))
    return placed.join(F.broadcast(first), "dim").select(
        "dim", (F.col("_place") - F.col("_first")).alias("position"), *(f"label_{d}" for d in labels)
    )


def place_by_labels(
    cells: DataFrame, labels: dict[str, str], dictionary: DataFrame
) -> DataFrame:
    """Cells at the positions their labels have in ``dictionary``, in every dim of
    ``labels``: an outer join of all files, gaps stay absent."""
    for dim, label in labels.items():
        own = dictionary.where(F.col("dim") == dim).select(
            F.col(f"label_{dim}").alias(label), F.col("position").alias("_place")
        )
        cells = cells.drop(f"{dim}_i").join(broadcast_within(own), label)
        cells = cells.withColumnRenamed("_place", f"{dim}_i")
    return cells

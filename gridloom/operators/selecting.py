"""Choose rows, variables and attributes."""

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.ordering import broadcast_within, is_ascending

# Fixed value: datasets whose dataset-level attributes are dropped on rechunking.
STRIPPED_DATASETS = ["dpird"]


def strip_global_attrs(attrs: DataFrame, datasets: list[str] = STRIPPED_DATASETS) -> DataFrame:
    """Drop dataset-level attributes of the given datasets; variables keep theirs."""
    return attrs.filter(~(F.col("dataset").isin(datasets) & (F.col("scope") == "global")))


def data_vars_only(catalog: DataFrame) -> DataFrame:
    return catalog.filter(~F.col("is_coord"))


def select_variable(cells: DataFrame, dims: tuple[str, ...], variable: str) -> DataFrame:
    return cells.select(*(f"{d}_i" for d in dims), variable)


def select_day(
    cells: DataFrame,
    day: str,
    time: str = "time",
    position: str = "time_i",
    labels: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """Cells of one day, and whether that fell back to all cells.

    The fallback applies without a time label, and when the labels ascend and
    the day lies before the first or after the last. A day inside the range
    with no cells gives no rows. ``labels``, the coordinate (``position`` and
    ``time``, one row for each position), decides this without a look at the cells,
    and labels cells that have positions only.
    """
    if labels is not None and time not in cells.columns:
        cells = cells.join(broadcast_within(labels.select(position, time)), position)
    if time not in cells.columns:
        return cells, True
    start = date.fromisoformat(day)
    end = start + timedelta(days=1)
    begins, ends = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (start, end))
    inside = cells.filter((F.col(time) >= begins) & (F.col(time) < ends))
    known = cells if labels is None else labels
    span = known.agg(
        (F.min(time) >= ends).alias("before"), (F.max(time) < begins).alias("after")
    ).first()
    if (span["before"] or span["after"]) and is_ascending(known, position, time):
        return cells, True
    return inside, False

"""Number the boxes of an array: the units packed by one task.

A box is a chunk, or a slab of a chunk too large for one task. Its number and
the row-major position in it make one bigint per cell, which is all that has to
travel with the values. Expressions are SQL text over bigint columns.
"""

from math import ceil, prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.model import Grid


class Boxes:
    """Box arithmetic of one grid. ``longest``: the greatest length of each dim
    that differs from file to file. ``lens``: lengths of a box, where a store
    states them."""

    def __init__(
        self,
        grid: Grid,
        max_elements: int,
        longest: dict[str, int] | None = None,
        lens: tuple[int, ...] | None = None,
    ):
        self.grid, self.longest = grid, longest or {}
        self.lens = lens or grid.box_lens(max_elements)
        self.elements = prod(self.lens)
        self._len = dict(zip(grid.dims, self.lens))
        whole = {d: min(grid.chunk_len(d), grid.sizes.get(d, grid.chunk_len(d))) for d in grid.dims}
        self._slabs = {d: ceil(whole[d] / self._len[d]) for d in grid.dims}
        open_dims = [d for d in grid.dims if d not in grid.sizes]
        self._order = open_dims + [d for d in grid.dims if d in grid.sizes]

    def _radix(self, dim: str) -> int:
        return ceil(self._most(dim) / self.grid.chunk_len(dim)) * self._slabs[dim]

    def _most(self, dim: str) -> int:
        return self.grid.sizes[dim] if dim in self.grid.sizes else self.longest[dim]

    def _one_chunk(self, dim: str) -> bool:
        return dim in self.grid.sizes and self.grid.chunk_len(dim) >= self.grid.sizes[dim]

    def size(self, dim: str) -> str:
        sizes = self.grid.sizes
        return f"{sizes[dim]}L" if dim in sizes else f"size_{dim}"

    def number(self, prefix: str = "", suffix: str = "_i") -> str:
        """Box number of the cell whose positions are ``<prefix><dim><suffix>``."""
        number = "0L"
        for d in self._order:
            i, chunk, slabs = f"{prefix}{d}{suffix}", self.grid.chunk_len(d), self._slabs[d]
            index = "0L" if self._one_chunk(d) else f"({i} div {chunk}L) * {slabs}L"
            if slabs > 1:
                index += f" + ({i} % {chunk}L) div {self._len[d]}L"
            number = f"({number}) * {self._radix(d)}L + {index}"
        return number

    def outside(self) -> str:
        """Whether a cell lies in no box of any file, a missing position included."""
        fits = (f"{d}_i >= 0 AND {d}_i < {self._most(d)}L" for d in self.grid.dims)
        return f"NOT coalesce({' AND '.join(fits)}, false)"

    def _inside(self, dim: str) -> str:
        """Position in the box. One outside the array fails the job, since its
        number would be that of another box. A file shorter than the longest one
        is looked at again when its boxes are packed."""
        i, chunk = f"{dim}_i", self.grid.chunk_len(dim)
        wrong = f"raise_error(concat('position ', coalesce(CAST({i} AS STRING), 'NULL'), ' is outside {dim}'))"
        fits = f"{i} >= 0 AND {i} < {self._most(dim)}L"
        i = f"CASE WHEN {fits} THEN {i} ELSE CAST({wrong} AS BIGINT) END"
        if not self._one_chunk(dim):
            i = f"({i}) % {chunk}L"
        return f"({i}) % {self._len[dim]}L" if self._slabs[dim] > 1 else i

    def cell(self) -> str:
        """Box number and position in one bigint."""
        cell = self.number()
        for d in self.grid.dims:
            cell = f"({cell}) * {self._len[d]}L + ({self._inside(d)})"
        return cell

    def bounds(self) -> dict[str, str]:
        """``o_<dim>`` and ``n_<dim>``: origin and clipped lengths of ``_box``."""
        rest, out = "_box", {}
        for k, d in enumerate(reversed(self._order)):
            lead = k == len(self._order) - 1
            index = rest if lead else f"({rest}) % {self._radix(d)}L"
            rest = f"({rest}) div {self._radix(d)}L"
            chunk, slabs, n = self.grid.chunk_len(d), self._slabs[d], self._len[d]
            start = f"(({index}) div {slabs}L) * {chunk}L"
            origin = f"{start} + (({index}) % {slabs}L) * {n}L"
            end = f"least({self.size(d)}, {start} + {chunk}L, {origin} + {n}L)"
            if d not in self.grid.sizes:  # least() would pass over a missing size
                end = f"if({self.size(d)} IS NULL, NULL, {end})"
            out |= {f"o_{d}": origin, f"n_{d}": f"{end} - ({origin})"}
        return out

    def with_bounds(self, boxes: DataFrame) -> DataFrame:
        return boxes.selectExpr("*", *(f"{sql} AS {name}" for name, sql in self.bounds().items()))

    def with_positions(self, cells: DataFrame) -> DataFrame:
        """Add ``<dim>_i`` of the row-major position ``_at`` of a box row."""
        rest, out = "_at", []
        for d in reversed(self.grid.dims):
            out.append(f"o_{d} + ({rest}) % n_{d} AS {d}_i")
            rest = f"({rest}) div n_{d}"
        return cells.selectExpr("*", *out)

    def every(self, sizes: DataFrame | None, spark) -> DataFrame:
        """One row per box of the array, with or without cells, made in parallel
        over the files, or over the dim with most chunks."""
        lead, frame = None, sizes
        if sizes is None:
            of = self.grid.sizes
            lead = max(self.grid.dims, key=lambda d: of[d] / self.grid.chunk_len(d))
            starts = spark.range(0, of[lead], self.grid.chunk_len(lead))
            frame = starts.withColumnRenamed("id", f"_c_{lead}")
        for d in self.grid.dims:
            size, chunk = self.size(d), self.grid.chunk_len(d)
            if d != lead:
                frame = frame.selectExpr("*", f"explode(sequence(0L, {size} - 1, {chunk}L)) AS _c_{d}")
            last = f"least(_c_{d} + {chunk}L, {size}) - 1"
            slabs = f"explode(sequence(_c_{d}, {last}, {self._len[d]}L)) AS _at_{d}"
            frame = frame.selectExpr("*", slabs)
        return frame.withColumn("_box", F.expr(self.number("_at_", "")))

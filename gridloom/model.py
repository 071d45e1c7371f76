"""Row shapes shared by the operators, and the grid that chunks an array."""

from dataclasses import dataclass, field
from math import prod

from pyspark.sql import DataFrame

ITEM_SIZES = {
    # Bytes per element of each storable dtype.
    "int8": 1,
    "int16": 2,
    "int32": 4,
    "int64": 8,
    "uint8": 1,
    "uint16": 2,
    "uint32": 4,
    "uint64": 8,
    "float32": 4,
    "float64": 8,
    "bool": 1,
    "datetime64[us]": 8,
    "datetime64[D]": 8,
}
# Text has no fixed size; plans take this many bytes for a value.
TEXT_SIZE = 16


def item_bytes(dtype: str) -> int:
    return TEXT_SIZE if dtype == "str" else ITEM_SIZES[dtype]


@dataclass(frozen=True)
class Grid:
    """Dims in row-major order with partial chunk and shard maps.

    A dim missing from a map takes the whole dim; a mapped length is used as
    given, never clipped to the dim size. ``sizes`` may leave out dims whose
    length differs from file to file; those come from a per-file table.
    """

    dims: tuple[str, ...]
    sizes: dict[str, int] = field(default_factory=dict)
    chunk: dict[str, int] = field(default_factory=dict)
    shard: dict[str, int] = field(default_factory=dict)

    def chunk_len(self, dim: str) -> int:
        return self.chunk[dim] if dim in self.chunk else self.sizes[dim]

    def shard_len(self, dim: str) -> int:
        return self.shard[dim] if dim in self.shard else self.sizes[dim]

    def chunk_lens(self) -> tuple[int, ...]:
        return tuple(self.chunk_len(d) for d in self.dims)

    def shard_lens(self) -> tuple[int, ...]:
        return tuple(self.shard_len(d) for d in self.dims)

    def check(self) -> None:
        """Each shard must hold whole chunks."""
        for d in self.dims:
            if d in self.shard and self.shard[d] % self.chunk_len(d):
                raise ValueError(f"{d}: shard {self.shard[d]} does not hold whole chunks")

    def box_lens(self, max_elements: int) -> tuple[int, ...]:
        """Lengths of the unit packed by one task: the part of a chunk that lies
        in the array, or, when that has more than ``max_elements``, slabs cut
        from its leading dims."""
        lens = [min(n, self.sizes.get(d, n)) for d, n in zip(self.dims, self.chunk_lens())]
        for k in range(len(lens)):
            rest = prod(lens[k + 1 :])
            lens[k] = min(lens[k], max(1, max_elements // max(rest, 1)))
            if prod(lens) <= max_elements:
                break
        return tuple(lens)


@dataclass(frozen=True)
class Arrays:
    """Variables over the same dims: their cells, grid and stored dtypes. A
    coordinate is a variable over the one dim it is named after."""

    cells: DataFrame
    grid: Grid
    variables: dict[str, str]
    coordinate: bool = False

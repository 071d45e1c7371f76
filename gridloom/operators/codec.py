"""Pack cells into compressed chunk rows, and read them back as cells.

Packing has one shuffle, also for variables over different dims. Map tasks first
gather the cells of a box they have seen into compact binary pieces (an int32
position and the values of each variable), so what is shuffled and sorted is a few
rows per box instead of one row per cell. A group is one box of a bounded number of
elements of one set of arrays, or several small ones.
"""

from collections.abc import Iterator
from math import ceil, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import blocks
from gridloom.functions.ordering import broadcast_within
from gridloom.functions.values import resolve_fill
from gridloom.model import Arrays, Grid, item_bytes
from gridloom.operators.boxes import Boxes

# What a task packs at once. A larger chunk is stored in slabs; its rows state
# the declared chunk shape beside their own.
MAX_BOX_ELEMENTS = 8 * 1024 * 1024
# Dense bytes one task packs and writes: a larger shard or file gets several
# writers. Less data is spread over the shuffle partitions, down to the smaller.
WRITER_BYTES = (32 * 1024 * 1024, 256 * 1024 * 1024)
# Elements of small boxes that are packed in one call: each call costs more than
# such a box.
BUNDLE_ELEMENTS = 256 * 1024
# Cells gathered in a map task before its pieces are sent on.
GATHER_ROWS = 1_000_000
# Cells per Arrow batch when boxes are expanded again.
CELL_ROWS = 65_536


def _pieces_schema(by: list[tuple[str, str]], variables) -> str:
    cols = [f"`{name}` {kind}" for name, kind in by]
    cols += ["_box bigint", "_pos binary", "_twice boolean"]
    for v in variables:
        # values, and which are not null (empty: all of them)
        cols += [f"`{v}` binary", f"`_ok_{v}` binary"]
    return ", ".join(cols)


# NumPy names of the Spark types a value column can have.
_VALUE_TYPES = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "boolean": "bool",
    "string": "str",
    "date": "datetime64[D]",
    "timestamp_ntz": "datetime64[us]",
    "timestamp": "datetime64[us]",
}
# Spark types that hold every value of a stored dtype.
_SPARK_TYPES = {
    "int64": "bigint",
    "uint32": "bigint",
    "bool": "boolean",
    "str": "string",
    "datetime64[D]": "date",
    "datetime64[us]": "timestamp_ntz",
}


def spark_type(dtypes) -> str:
    """The Spark type of a value column that holds variables of ``dtypes``; those
    that no type holds together are an error. Unsigned 64 bits come as doubles."""
    kinds = {_SPARK_TYPES.get(d, "double") for d in dtypes}
    if kinds <= {"bigint", "double"} and len(kinds) > 1:
        kinds = {"double"}
    if len(kinds) > 1:
        raise ValueError(f"no column holds {', '.join(sorted(set(dtypes)))}: name the variables")
    return kinds.pop() if kinds else "double"


def _value_types(cells: DataFrame, variables: dict[str, str]) -> dict[str, str]:
    kinds = dict(cells.dtypes)
    return {v: _VALUE_TYPES[kinds[v]] for v in variables}


def _cut(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary for each run of fixed values, which follow each other from the
    first value on: the bytes as they lie, since a run can be as short as one cell
    and an object for each takes many times its size."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype("<i4")
    content = np.ascontiguousarray(values).view(np.uint8)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(content)]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _cutter(column, order: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Values in ``order``, one binary for each run: their bytes, or for text the
    length of each and then the content."""
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        return _cut(column.to_numpy()[order], starts)
    starts, ends = starts.tolist(), [*starts[1:].tolist(), len(order)]
    texts = column.cast(pa.large_string()).combine_chunks().take(pa.array(order))
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    content = memoryview(texts.buffers()[2] or b"")
    lengths = np.diff(offsets).astype("<i4")
    return pa.array(
        [
            lengths[a:b].tobytes() + bytes(content[offsets[a] : offsets[b]])
            for a, b in zip(starts, ends)
        ],
        pa.binary(),
    )


def _gather(by, box_elements: int, variables, limit):
    """mapInArrow body: cells to pieces."""

    def flush(batches):
        table = pa.Table.from_batches(batches)
        owner = np.zeros(table.num_rows, np.int64)
        for name in by:
            codes = table.column(name).combine_chunks().dictionary_encode()
            owner = owner * len(codes.dictionary) + codes.indices.to_numpy()
        cell = table.column("_cell").to_numpy()
        order, starts = blocks.runs(owner, cell, box_elements)
        # a position given again is told apart here and not sent on, so a box
        # never receives more values from a flush than it has positions
        again = np.zeros(len(order), bool)
        again[1:] = cell[order][1:] == cell[order][:-1]
        again[starts] = False
        twice = np.logical_or.reduceat(again, starts)
        starts, order = starts - np.cumsum(again)[starts], order[~again]
        first, cell = pa.array(order[starts]), cell[order]
        number = cell[starts] // box_elements
        pos = (cell % box_elements).astype("<i4")
        out = {name: table.column(name).take(first) for name in by}
        out |= {"_box": pa.array(number), "_pos": _cut(pos, starts), "_twice": pa.array(twice)}
        every = pa.repeat(pa.scalar(b"", pa.binary()), len(starts))
        for v in variables:
            column, valid = table.column(v), None
            if column.null_count:
                valid = pc.is_valid(column).to_numpy()[order]
                column = _without_nulls(column)
            out[v] = _cutter(column, order, starts)
            out[f"_ok_{v}"] = _cut(valid, starts) if valid is not None else every
        yield from pa.table(out).combine_chunks().to_batches(max_chunksize=1024)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= limit:
                yield from flush(held)
                held, rows = [], 0
        if held:
            yield from flush(held)

    return gather


def _without_nulls(column):
    kind = column.type
    if pa.types.is_temporal(kind):
        return column.cast(pa.int64() if kind.bit_width == 64 else pa.int32()).fill_null(0).cast(kind)
    blank = "" if pa.types.is_string(kind) else False if pa.types.is_boolean(kind) else 0
    return column.fill_null(blank)


def chunk_schema(by: list[tuple[str, str]], dims) -> str:
    """Columns of a chunk table. ``dims`` are those of all its variables; a variable
    has null bounds for dims it lacks and names its own in ``dims``."""
    cols = [f"`{name}` {kind}" for name, kind in by]
    cols += ["var string", "shard string"]
    cols += [f"o_{d} bigint" for d in dims] + [f"n_{d} bigint" for d in dims]
    cols += [f"{name} {kind}" for name, kind in _FACTS]
    return ", ".join(cols)


_FACTS = [
    ("dims", "array<string>"),
    ("dtype", "string"),
    ("codec", "string"),
    ("level", "int"),
    ("shuffle", "boolean"),
    ("fill", "string"),
    ("shape", "array<bigint>"),
    ("chunk", "array<bigint>"),
    ("slab", "array<bigint>"),
    ("n_cells", "bigint"),  # positions named by a cell, with or without a value
    ("n_present", "bigint"),  # and with one
    ("v_min", "double"),  # of the present values, NaN left out
    ("v_max", "double"),
    ("n_nan", "bigint"),
    ("raw_bytes", "bigint"),
    ("stored_bytes", "bigint"),
    ("valid", "binary"),  # which positions are present; null: all
    ("payload", "binary"),
    ("error", "string"),
]
_ARROW = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
    "array<bigint>": pa.list_(pa.int64()),
}


def _dense(table, var: str, held: str, dtype: str, box, inside, fill):
    """One variable of a box from its pieces: the block, where it has values, and
    its number of cells. Where it is null the fill stays."""
    if pc.any(table.column("_twice")).as_py():
        raise ValueError("duplicate cells")
    pieces = []
    for pos, values, ok in zip(*(table.column(c) for c in ("_pos", var, f"_ok_{var}"))):
        pos = np.frombuffer(pos.as_buffer(), "<i4")
        raw = values.as_buffer()
        values = blocks.texts_of(raw, len(pos)) if held == blocks.TEXT else np.frombuffer(raw, held)
        ok = np.frombuffer(ok.as_buffer(), bool)
        pieces.append((pos, values, ok if ok.size else None))
    return blocks.scatter(box, inside, dtype, fill, pieces)


def _each_box(table: pa.Table) -> Iterator[pa.Table]:
    """The pieces of each box, in one table of several."""
    box = table.column("_box").to_numpy()
    if (box == box[0]).all():
        yield table
        return
    order = np.argsort(box, kind="stable")
    starts = np.flatnonzero(np.diff(box[order], prepend=-1)).tolist()
    table = table.take(pa.array(order)).combine_chunks()
    for start, end in zip(starts, [*starts[1:], len(box)]):
        yield table.slice(start, end - start)


def _place(table: pa.Table, by, dims) -> dict:
    names = [*by, *(f"o_{d}" for d in dims), *(f"n_{d}" for d in dims)]
    return {c: table.column(c)[0].as_py() for c in names}


def _inside(place: dict, dims) -> tuple[slice, ...]:
    """The part of a box that lies in its array."""
    lengths = [place[f"n_{d}"] for d in dims]
    if None in lengths:
        raise ValueError("no size is stated for this file")
    if min(lengths) <= 0:
        raise ValueError("cells beyond the size of the array")
    return tuple(slice(0, n) for n in lengths)


def _pack(by, parts, every_dim, codec, level, shuffle, drop_empty, strict):
    """Grouped-map body: the pieces of a few boxes to one row per box and variable."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for table in _each_box(pa.Table.from_batches(list(batches))):
            rows += pack_box(table)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def pack_box(table: pa.Table) -> list[dict]:
        part = parts[table.column("_part")[0].as_py()]
        grid, dims = part["grid"], part["grid"].dims
        place = _place(table, by, dims) | {"shard": table.column("shard")[0].as_py()}
        shape = [
            grid.sizes[d] if d in grid.sizes else table.column(f"size_{d}")[0].as_py()
            for d in dims
        ]
        place |= {"dims": list(dims), "shape": shape}
        place |= {"chunk": list(grid.chunk_lens()), "slab": list(part["box"])}
        rows = []
        for var, dtype in part["variables"].items():
            fill = part["fills"][var]
            row = place | {"var": var, "dtype": dtype, "codec": codec, "level": level}
            row |= {"shuffle": shuffle, "fill": str(fill)}
            try:
                inside = _inside(place, dims)
                dense, valid, cells = _dense(
                    table, var, part["held"][var], dtype, part["box"], inside, fill
                )
                if drop_empty and not valid.any():
                    continue
                low, high, n_nan = blocks.zone(dense[valid])
                row |= {"n_cells": cells, "n_present": int(np.count_nonzero(valid))}
                row |= {"v_min": low, "v_max": high, "n_nan": n_nan}
                row |= {"raw_bytes": blocks.raw_size(dense), "stored_bytes": 0}
                row |= {"valid": blocks.encode_valid(valid)}
                if not drop_empty or not blocks.equals_fill(dense, fill).all():
                    payload = blocks.encode(dense, codec, level, shuffle)
                    row |= {"stored_bytes": len(payload), "payload": payload}
            except ValueError as exc:
                if strict:
                    raise
                row |= {"n_cells": 0, "n_present": 0, "error": str(exc)}
            rows.append(row)
        return rows

    whole = pa.int64()
    schema = pa.schema(
        [(name, pa.string()) for name in [*by, "var", "shard"]]
        + [(f"{side}_{d}", whole) for side in ("o", "n") for d in every_dim]
        + [(name, _ARROW[kind]) for name, kind in _FACTS]
    )
    return pack


def _cells_schema(by, dims, kind: str = "double", valid: bool = False) -> str:
    cols = [f"`{name}` string" for name in by] + ["var string"]
    cols += [f"{d}_i bigint" for d in dims] + [f"v {kind}"]
    return ", ".join(cols + ["present boolean"] * valid)


def _cell_batches(by, dims, every_dim, place: dict, var: str, values, wanted, kind, valid=None):
    """Cells of one box at the flat positions ``wanted``, a slice at a time."""
    shape = [place[f"n_{d}"] for d in dims]
    for lo in range(0, len(wanted), CELL_ROWS):
        flat = wanted[lo : lo + CELL_ROWS]
        out = {n: pa.repeat(pa.scalar(place[n], pa.string()), len(flat)) for n in by}
        out["var"] = pa.repeat(pa.scalar(var, pa.string()), len(flat))
        at = dict(zip(dims, np.unravel_index(flat, shape)))
        for d in every_dim:
            where = pa.array(at[d] + place[f"o_{d}"]) if d in at else pa.nulls(len(flat), pa.int64())
            out[f"{d}_i"] = where
        out["v"] = pa.array(blocks.convert(values[flat], _VALUE_TYPES[kind]))
        if valid is not None:
            out["present"] = pa.array(valid[flat])
        yield pa.RecordBatch.from_pydict(out)


def _expand(by, dims, variables, held, box, fills, kind):
    """Grouped-map body: the pieces of one box to all of its cells."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        place = _place(table, by, dims)
        inside = _inside(place, dims)
        for var, dtype in variables.items():
            dense, _, _ = _dense(table, var, held[var], dtype, box, inside, fills[var])
            values = dense.reshape(-1)
            every = np.arange(values.size)
            yield from _cell_batches(by, dims, dims, place, var, values, every, kind)

    return expand


def _shard_label(grid: Grid) -> str:
    parts = [f"o_{d} div {grid.shard[d]}" if d in grid.shard else "'0'" for d in grid.dims]
    return f"concat_ws('.', {', '.join(parts)})"


def _plain_times(cells: DataFrame, variables) -> DataFrame:
    """Times without a zone, as they are stored, in the session's zone."""
    zoned = [v for v, kind in cells.dtypes if v in variables and kind == "timestamp"]
    return cells.withColumns({v: F.col(f"`{v}`").cast("timestamp_ntz") for v in zoned})


def _gathered(cells, boxes, variables, by, sizes, files, every_box) -> DataFrame:
    """Pieces with the bounds of their box, before the shuffle. ``every_box``
    adds an empty piece for each box, so that boxes without cells appear too."""
    names = list(variables)
    quoted = [f"`{v}`" for v in names]
    placed = _plain_times(cells, variables).select(
        *by, F.expr(boxes.cell()).alias("_cell"), *quoted
    )
    pieces = placed.mapInArrow(
        _gather(by, boxes.elements, names, GATHER_ROWS),
        _pieces_schema([(name, "string") for name in by], names),
    )
    if every_box:
        blank = ["X'' AS _pos", "false AS _twice"]
        for v in names:
            blank += [f"X'' AS `{v}`", f"X'' AS `_ok_{v}`"]
        every = boxes.every(sizes, cells.sparkSession)
        pieces = pieces.unionByName(every.selectExpr(*by, "_box", *blank))
    if sizes is not None:
        # a file without a size keeps its pieces, and packing them is an error
        pieces = pieces.join(broadcast_within(sizes, rows=files), list(by), "left")
    return boxes.with_bounds(pieces)


def _default_fill(dtype: str):
    """What a variable without a stated fill takes: empty text, no time, or NaN,
    which only floats can hold."""
    return {"str": "", "datetime64[us]": "NaT", "datetime64[D]": "NaT"}.get(dtype, "nan")


def fills_of(variables: dict[str, str], fill) -> dict:
    """The fill of each variable in its dtype. ``fill`` is one for all or a map;
    a variable it does not name takes NaN, empty text or no time, and is an error
    where none of them fits."""
    given = fill if isinstance(fill, dict) else dict.fromkeys(variables, fill)
    return {
        v: resolve_fill(given.get(v, _default_fill(dtype)), dtype)
        for v, dtype in variables.items()
    }


def every_dim(arrays: list[Arrays]) -> tuple[str, ...]:
    """The dims of all arrays, in the order they are first met."""
    return tuple(dict.fromkeys(d for a in arrays for d in a.grid.dims))


def encode_chunks(
    cells: DataFrame, grid: Grid, variables: dict[str, str], **options
) -> DataFrame:
    """Chunk table of variables over the same dims; see ``encode_arrays``."""
    return encode_arrays([Arrays(cells, grid, variables)], **options)


def encode_arrays(
    arrays: list[Arrays],
    *,
    by: tuple[str, ...] = (),
    sizes: DataFrame | None = None,
    codec: str = "zlib",
    level: int = 7,
    shuffle: bool = True,
    fill=float("nan"),
    drop_empty: bool = True,
    strict: bool = True,
    max_box_elements: int = MAX_BOX_ELEMENTS,
    writer_bytes: tuple[int, int] = WRITER_BYTES,
) -> DataFrame:
    """Chunk table of ``arrays``, which may lie over different dims: one compressed
    row per chunk and variable, all packed behind one shuffle.

    The variables of each map value columns to stored dtypes. ``by`` names string
    columns that separate files or datasets; ``sizes`` is a table of ``by`` and
    ``size_<dim>`` for dims that the sizes of a grid leave open. Absent cells take
    ``fill``, one for all variables or one by name, in the dtype of the variable,
    and a bitmap tells them from values equal to it. Unless ``drop_empty`` is off,
    boxes without any value are left out, and those whose values all equal the fill
    have no payload. Cells that name a position twice or one
    outside the array, values that their dtype cannot hold, and files without a
    size, fail the job, or give a row with ``error`` set when ``strict`` is off.
    """
    names = [v for a in arrays for v in a.variables]
    if len(set(names)) < len(names):
        raise ValueError("a variable is given twice")
    dims = every_dim(arrays)
    boxes = [Boxes(a.grid, max_box_elements) for a in arrays]
    spark = arrays[0].cells.sparkSession
    files, tasks, share = _spread(
        spark, [(b, a.variables) for b, a in zip(boxes, arrays)], sizes, writer_bytes
    )
    pieces, parts, wrong = None, [], []
    for k, (box, given) in enumerate(zip(boxes, arrays)):
        given.grid.check()
        cells = given.cells
        if not strict:
            wrong.append(cells.where(box.outside()).select(*by))
            cells = cells.where(f"NOT ({box.outside()})")
        unit = _dense_bytes(box, given.variables, given.grid.shard)
        writers = f"CAST(greatest(ceil(({unit}) / {share}D), 1) AS INT)"
        some = _gathered(cells, box, given.variables, by, sizes, files, not drop_empty)
        some = some.selectExpr("*", f"{_shard_label(given.grid)} AS shard", f"{k} AS _part")
        some = some.selectExpr("*", f"pmod(hash(_box), {writers}) AS _writer")
        some = some.selectExpr("*", f"_box div {max(1, BUNDLE_ELEMENTS // box.elements)}L AS _bundle")
        pieces = some if pieces is None else pieces.unionByName(some, allowMissingColumns=True)
        parts.append(
            {
                "grid": given.grid,
                "box": box.lens,
                "variables": given.variables,
                "held": _value_types(given.cells, given.variables),
                "fills": fills_of(given.variables, _fill_for(given, fill)),
            }
        )
    place = [*by, "_part", "shard", "_writer"]
    packed = (
        pieces.repartition(tasks, *place)
        .groupBy(*place, "_bundle")
        .applyInArrow(
            _pack(by, parts, dims, codec, level, shuffle, drop_empty, strict),
            chunk_schema([(name, "string") for name in by], dims),
        )
    )
    for outside in wrong:
        message = F.lit("cells outside the array").alias("error")
        packed = packed.unionByName(
            outside.distinct().select(*by, message), allowMissingColumns=True
        )
    return packed


def _fill_for(given: Arrays, fill):
    """One fill for all is meant for data; a coordinate without one of its own keeps
    its kind's, or 0 where that is a whole number: every position has a label."""
    if not given.coordinate:
        return fill
    stated = fill if isinstance(fill, dict) else {}
    return {
        v: stated[v] if v in stated else "0" if np.dtype(object if d == "str" else d).kind in "iub" else _default_fill(d)
        for v, d in given.variables.items()
    }


def _dense_bytes(boxes: Boxes, variables: dict[str, str], extent: dict[str, int]) -> str:
    """Bytes of all variables over ``extent``, whole dims where it names none."""
    lengths = (f"{extent[d]}" if d in extent else boxes.size(d) for d in boxes.grid.dims)
    item = sum(item_bytes(t) for t in variables.values())
    return " * ".join([f"{item}D", *lengths])


def _spread(spark, parts, sizes: DataFrame | None, bounds) -> tuple[int, int, float]:
    """Files, tasks for packing, and the dense bytes of each task. Sparse cells
    are few bytes in the shuffle but full boxes once packed, so the number of
    tasks must not be left to the size of the shuffle."""
    total, files, open_dims = 0.0, 1, []
    if sizes is None:
        for boxes, variables in parts:
            of = boxes.grid.sizes
            item = sum(item_bytes(t) for t in variables.values())
            total += item * float(prod(of[d] for d in boxes.grid.dims))
    else:
        grids = [boxes.grid for boxes, _ in parts]
        open_dims = list(dict.fromkeys(d for g in grids for d in g.dims if d not in g.sizes))
        dense = " + ".join(_dense_bytes(boxes, variables, {}) for boxes, variables in parts)
        longest = [f"coalesce(max(size_{d}), 0L)" for d in open_dims]
        files, total, *longest = sizes.selectExpr(
            "count(1)", f"coalesce(sum({dense}), 0D)", *longest
        ).first()
        for boxes, _ in parts:
            mine = (d for d in open_dims if d in boxes.grid.dims and d not in boxes.grid.sizes)
            boxes.longest = {d: longest[open_dims.index(d)] for d in mine}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least, most = bounds
    share = float(min(most, max(least, total / partitions)))
    return files, max(partitions, ceil(total / share)), share


def dense_cells(
    cells: DataFrame,
    grid: Grid,
    variables: dict[str, str],
    *,
    fill=float("nan"),
    by: tuple[str, ...] = (),
    sizes: DataFrame | None = None,
    max_box_elements: int = MAX_BOX_ELEMENTS,
) -> DataFrame:
    """Every cell of the array, absent ones with ``fill``."""
    boxes, kind = Boxes(grid, max_box_elements), spark_type(variables.values())
    files, tasks, _ = _spread(cells.sparkSession, [(boxes, variables)], sizes, WRITER_BYTES)
    pieces = _gathered(cells, boxes, variables, by, sizes, files, True)
    held, fills = _value_types(cells, variables), fills_of(variables, fill)
    return pieces.repartition(tasks, *by, "_box").groupBy(*by, "_box").applyInArrow(
        _expand(by, grid.dims, variables, held, boxes.lens, fills, kind),
        _cells_schema(by, grid.dims, kind),
    )


def _unpack(by, every_dim, which, kind):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch.column("payload")
            facts = batch.drop_columns(["payload"]).to_pylist()
            for row, payload in zip(facts, payloads):
                dims = row["dims"] or every_dim
                count = prod(row[f"n_{d}"] for d in dims)
                fill = resolve_fill(row["fill"], row["dtype"])
                if payload.is_valid:
                    values = blocks.decode(
                        payload.as_buffer(),
                        row["dtype"],
                        row["codec"],
                        row["shuffle"],
                        count,
                        row["raw_bytes"],
                    )
                else:  # all of it is the fill
                    values = np.full(count, fill, blocks.held_as(row["dtype"]))
                wanted, valid = np.arange(count), None
                if which == "present":
                    wanted = np.flatnonzero(blocks.decode_valid(row["valid"], count))
                elif which == "not fill":
                    wanted = np.flatnonzero(~blocks.equals_fill(values, fill))
                elif which == "marked":
                    valid = blocks.decode_valid(row["valid"], count)
                yield from _cell_batches(
                    by, dims, every_dim, row, row["var"], values, wanted, kind, valid
                )

    return unpack


def decode_chunks(
    chunks: DataFrame,
    dims: tuple[str, ...],
    by: tuple[str, ...] = (),
    without_fill: bool = False,
    kind: str = "double",
    which: str | None = None,
) -> DataFrame:
    """Cells of a chunk table over ``dims``; a variable has null positions for dims
    it lacks. ``v`` is of the Spark type ``kind``: double holds any mix of numbers
    but whole ones past 2^53, for which ``bigint`` is exact.

    ``which``: "all" positions; "present", those that were given a value, whatever
    it was; "not fill" (``without_fill``), those that differ from the fill; or
    "marked", all of them with a column ``present``.
    """
    which = which or ("not fill" if without_fill else "all")
    need = [*by, "var", *(f"o_{d}" for d in dims), *(f"n_{d}" for d in dims), "dims"]
    need += ["dtype", "codec", "shuffle", "fill", "raw_bytes", "valid", "payload"]
    return chunks.select(*need).mapInArrow(
        _unpack(by, dims, which, kind), _cells_schema(by, dims, kind, which == "marked")
    )

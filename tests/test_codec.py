"""Packing and unpacking: exact round trips against NumPy."""

import tracemalloc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from gridloom.functions import blocks
from gridloom.model import Grid
from gridloom.operators import codec
from gridloom.operators.codec import _gather, decode_chunks, dense_cells, encode_chunks
from gridloom.operators.reports import storage_stats
from gridloom.sinks.chunks import write_store
from gridloom.sources.store import read_array, read_cells, read_chunks

DIMS = ("time", "latitude", "longitude")


def cells_of(spark, array: np.ndarray, keep=None, names=DIMS):
    rows = [
        (*map(int, at), float(array[at]))
        for at in np.ndindex(array.shape)
        if keep is None or keep[at]
    ]
    schema = ", ".join(f"{d}_i bigint" for d in names) + ", v double"
    return spark.createDataFrame(rows, schema)


def sizes(array, names=DIMS):
    return dict(zip(names, array.shape))


def as_array(frame, shape, names=DIMS, fill=np.nan):
    out = np.full(shape, fill)
    for row in frame.collect():
        out[tuple(row[f"{d}_i"] for d in names)] = row["v"]
    return out


@pytest.mark.parametrize("codec,level", [("zlib", 7), ("zstd", 5), ("none", 0)])
@pytest.mark.parametrize("dtype", ["float32", "float64", "int16", "int8"])
@pytest.mark.parametrize("shuffle", [True, False])
def test_block_round_trip(codec, level, dtype, shuffle):
    block = np.arange(-60, 60).reshape(4, 5, 6).astype(dtype)
    packed = blocks.encode(block, codec, level, shuffle)
    flat = blocks.decode(packed, dtype, codec, shuffle, block.size)
    assert np.array_equal(flat, block.reshape(-1))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    shape=st.tuples(*[st.integers(1, 7)] * 3),
    chunk=st.dictionaries(st.sampled_from(DIMS), st.integers(1, 9)),
    limit=st.sampled_from([1, 3, 10, 1000]),
    seed=st.integers(0, 99),
)
def test_any_chunking_is_exact(spark, shape, chunk, limit, seed):
    rng = np.random.default_rng(seed)
    array, keep = rng.normal(size=shape), rng.random(shape) < 0.6
    keep.flat[0] = True
    grid = Grid(DIMS, sizes(array), chunk)
    chunks = encode_chunks(
        cells_of(spark, array, keep), grid, {"v": "float64"}, max_box_elements=limit
    )
    got = decode_chunks(chunks, DIMS, without_fill=True)
    assert got.count() == keep.sum()
    assert np.array_equal(as_array(got, shape), np.where(keep, array, np.nan), equal_nan=True)


def test_small_boxes_are_packed_together(spark, monkeypatch):
    """The same rows as box by box, with slabs, several variables and errors in some boxes."""
    rows = [(t, x, float(t + x) if t % 3 else None, t) for t in range(40) for x in range(9) if (t + x) % 4]
    rows += [(5, 2, 1.0, 1), (7, 300, 1.0, 1)]
    cells = spark.createDataFrame(rows, "time_i bigint, lat_i bigint, v double, n int")
    grid = Grid(("time", "lat"), {"time": 40, "lat": 9}, {"time": 3, "lat": 4})
    calls = spark.sparkContext.accumulator(0)

    def packed(bundle):
        monkeypatch.setattr("gridloom.operators.codec.BUNDLE_ELEMENTS", bundle)
        monkeypatch.setattr(codec, "_pack", counted(codec._pack, calls))
        found = encode_chunks(
            cells.union(cells.where("time_i = 8")), grid, {"v": "float64", "n": "int16"},
            max_box_elements=6, strict=False, fill={"n": -1},
        )
        found = sorted((tuple(r) for r in found.collect()), key=repr)
        monkeypatch.undo()
        return found, calls.value

    alone, every = packed(1)
    together, all_calls = packed(60)
    assert alone == together and len(alone) > 80 and sum(r[-1] is not None for r in alone) > 4
    assert all_calls - every < every / 3


def counted(pack, calls):
    def made(*args):
        body = pack(*args)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            calls.add(1)
            return body(batches)

        return run

    return made


def test_dense_cells_cover_the_array(spark):
    array = np.arange(5 * 3 * 4, dtype=float).reshape(5, 3, 4)
    keep = np.zeros(array.shape, bool)
    keep[0, 0, 0] = keep[4, 2, 3] = True
    for limit in (1, 7, 1000):
        grid = Grid(DIMS, sizes(array), {"time": 2, "longitude": 3})
        dense = dense_cells(
            cells_of(spark, array, keep), grid, {"v": "float64"}, fill=-1.0, max_box_elements=limit
        )
        assert dense.count() == array.size
        assert np.array_equal(as_array(dense, array.shape), np.where(keep, array, -1.0))


def test_empty_chunks_are_left_out_or_kept(spark):
    array = np.ones((6, 2, 2))
    keep = np.zeros(array.shape, bool)
    keep[0] = True
    grid = Grid(DIMS, sizes(array), {"time": 2})
    cells = cells_of(spark, array, keep)
    kept = encode_chunks(cells, grid, {"v": "float32"})
    assert [r["o_time"] for r in kept.collect()] == [0]
    every = encode_chunks(cells, grid, {"v": "float32"}, drop_empty=False)
    assert sorted(r["o_time"] for r in every.collect()) == [0, 2, 4]
    assert decode_chunks(every, DIMS).count() == array.size


def test_absent_values_of_one_variable_take_the_fill(spark):
    cells = spark.createDataFrame(
        [(0, 1.0, None), (1, None, 5), (2, 3.0, 6)], "time_i bigint, a double, b int"
    )
    grid = Grid(("time",), {"time": 4}, {"time": 4})
    chunks = encode_chunks(cells, grid, {"a": "float64", "b": "int32"}, fill=-9)
    facts = {r["var"]: r["n_present"] for r in chunks.select("var", "n_present").collect()}
    assert facts == {"a": 2, "b": 2}
    got = {
        (r["var"], r["time_i"]): r["v"] for r in decode_chunks(chunks, ("time",)).collect()
    }
    assert [got["a", t] for t in range(4)] == [1.0, -9.0, 3.0, -9.0]
    assert [got["b", t] for t in range(4)] == [-9.0, 5.0, 6.0, -9.0]


def test_ragged_sizes_per_file(spark):
    rows = [("a", 0, 0, 1.0), ("a", 4, 1, 2.0), ("b", 1, 1, 3.0)]
    cells = spark.createDataFrame(rows, "file string, time_i bigint, lon_i bigint, v double")
    lengths = spark.createDataFrame([("a", 5), ("b", 2)], "file string, size_time bigint")
    for dims in (("time", "lon"), ("lon", "time")):
        grid = Grid(dims, {"lon": 2}, {"time": 3})
        chunks = encode_chunks(
            cells, grid, {"v": "float64"}, by=("file",), sizes=lengths, drop_empty=False
        )
        shapes = {(r["file"], r["o_time"]): (r["n_time"], r["n_lon"]) for r in chunks.collect()}
        assert shapes == {("a", 0): (3, 2), ("a", 3): (2, 2), ("b", 0): (2, 2)}
        back = decode_chunks(chunks, dims, ("file",), without_fill=True)
        assert {tuple(r[c] for c in ("file", "time_i", "lon_i", "v")) for r in back.collect()} == set(rows)


def test_duplicate_cells(spark):
    cells = spark.createDataFrame([(0, 1.0), (0, 2.0), (3, 1.0)], "time_i bigint, v double")
    grid = Grid(("time",), {"time": 4}, {"time": 2})
    with pytest.raises(Exception, match="duplicate cells"):
        encode_chunks(cells, grid, {"v": "float64"}).collect()
    rows = encode_chunks(cells, grid, {"v": "float64"}, strict=False).collect()
    assert {r["o_time"]: r["error"] for r in rows} == {0: "duplicate cells", 2: None}


def test_cells_outside_the_array_are_refused(spark):
    cells = spark.createDataFrame([("a", 0, 1.0), ("a", 5, 2.0)], "file string, time_i bigint, v double")
    with pytest.raises(Exception, match="position 5 is outside time"):
        encode_chunks(cells, Grid(("time",), {"time": 4}, {"time": 2}), {"v": "float64"}).collect()
    with pytest.raises(Exception, match="position 5 is outside time"):
        encode_chunks(cells, Grid(("time",), {"time": 4}, {}), {"v": "float64"}).collect()
    lengths = spark.createDataFrame([("a", 5)], "file string, size_time bigint")
    with pytest.raises(Exception, match="outside time|beyond the size"):
        encode_chunks(
            cells, Grid(("time",), chunk={"time": 3}), {"v": "float64"}, by=("file",), sizes=lengths
        ).collect()


def test_values_an_integer_dtype_cannot_hold_are_refused(spark):
    cells = spark.createDataFrame([(0, 300.0), (1, 1.9)], "time_i bigint, v double")
    grid = Grid(("time",), {"time": 2}, {"time": 1})
    rows = encode_chunks(cells, grid, {"v": "int8"}, fill=-1, strict=False)
    assert {r["o_time"]: r["error"] for r in rows.collect()} == {
        0: "value out of range for int8",
        1: None,
    }
    kept = decode_chunks(rows.filter("error IS NULL"), ("time",)).collect()
    assert [r["v"] for r in kept] == [1.0]


def test_left_out_chunks_are_made_again(spark, folder):
    array = np.arange(5 * 3 * 4, dtype=float).reshape(5, 3, 4)
    keep = np.zeros(array.shape, bool)
    keep[2, 1, 3] = True
    for limit in (4, 1000):
        grid = Grid(DIMS, sizes(array), {"time": 2, "longitude": 3}, {"time": 4})
        chunks = encode_chunks(
            cells_of(spark, array, keep), grid, {"v": "float64"}, max_box_elements=limit
        )
        out = write_store(chunks, folder(f"s{limit}"))
        got = read_array(spark, out, grid, {"v": np.nan})
        assert got.count() == array.size
        want = np.where(keep, array, np.nan)
        assert np.array_equal(as_array(got, array.shape), want, equal_nan=True)


def test_writers_split_a_large_shard(spark):
    array = np.arange(64.0).reshape(16, 2, 2)
    grid = Grid(DIMS, sizes(array), {"time": 2}, {"time": 8})
    cells = cells_of(spark, array)
    chunks = encode_chunks(cells, grid, {"v": "float64"}, writer_bytes=(64, 64))
    assert chunks.rdd.getNumPartitions() == 8
    got = decode_chunks(chunks, DIMS)
    assert np.array_equal(as_array(got, array.shape), array)


def test_store_reads_only_what_is_asked(spark, folder):
    array = np.arange(8 * 2 * 3, dtype=float).reshape(8, 2, 3)
    cells = cells_of(spark, array).selectExpr("*", "v * 2 AS w")
    grid = Grid(DIMS, sizes(array), {"time": 2}, {"time": 4})
    out = write_store(encode_chunks(cells, grid, {"v": "float64", "w": "float64"}), folder("s"))
    chunks = read_chunks(spark, out, DIMS)
    assert sorted(r["shard"] for r in chunks.select("shard").distinct().collect()) == ["0.0.0", "1.0.0"]
    for lo, hi in ((3, 5), (5, 8), (0, 4)):
        part = read_cells(
            spark, out, DIMS, variables=["w"], window={"time": (lo, hi)}, shard=grid.shard
        )
        plan = part._jdf.queryExecution().toString()
        pruned = [line for line in plan.splitlines() if "PartitionFilters" in line]
        assert all("split(shard" in line and f"LessThan(o_time,{hi})" in line for line in pruned)
        assert pruned
        assert {(r["var"], r["time_i"]) for r in part.collect()} == {("w", t) for t in range(lo, hi)}
        assert part.count() == (hi - lo) * 2 * 3


def test_store_is_replaced_as_a_whole(spark, folder):
    grid = Grid(("time",), {"time": 8}, {"time": 2}, {"time": 4})
    many = cells_of(spark, np.arange(8.0), names=("time",))
    out = write_store(encode_chunks(many, grid, {"v": "float64"}), folder("s"))
    few = many.filter("time_i < 2")
    write_store(encode_chunks(few, grid, {"v": "float64"}), out)
    assert read_cells(spark, out, ("time",), without_fill=True).count() == 2


def test_packing_has_one_exchange(spark):
    grid = Grid(("time",), {"time": 8}, {"time": 2}, {"time": 4})
    chunks = encode_chunks(cells_of(spark, np.arange(8.0), names=("time",)), grid, {"v": "float64"})
    assert chunks._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_positions_outside_the_array_are_refused(spark):
    open_time = Grid(("time",), {}, {"time": 7})
    sizes_ = spark.createDataFrame([("a", 5), ("b", 9)], "file string, size_time bigint")
    for file, at in (("a", 7), ("a", 5), ("a", -1), ("b", 9), ("c", 0), ("a", None)):
        cells = spark.createDataFrame([("a", 1, 1.0), (file, at, 2.0)], "file string, time_i bigint, v double")
        packed = lambda strict: encode_chunks(
            cells, open_time, {"v": "float64"}, by=("file",), sizes=sizes_, strict=strict
        )
        with pytest.raises(PySparkException):
            packed(True).collect()
        rows = packed(False).collect()
        assert {r["file"] for r in rows if r["error"]} == {file}


def test_boxes_of_two_open_dims_do_not_run_together(spark):
    grid = Grid(("x", "y"), {}, {"x": 1, "y": 1})
    sizes_ = spark.createDataFrame([("a", 2, 1 << 21)], "file string, size_x bigint, size_y bigint")
    cells = spark.createDataFrame(
        [("a", 0, 1 << 20, 1.0), ("a", 1, 0, 2.0)], "file string, x_i bigint, y_i bigint, v double"
    )
    chunks = encode_chunks(cells, grid, {"v": "float64"}, by=("file",), sizes=sizes_)
    got = {(r["x_i"], r["y_i"], r["v"]) for r in decode_chunks(chunks, ("x", "y"), ("file",)).collect()}
    assert got == {(0, 1 << 20, 1.0), (1, 0, 2.0)}


def test_slabs_keep_the_declared_chunk(spark, folder):
    grid = Grid(("time",), {"time": 16}, {"time": 8})
    cells = cells_of(spark, np.arange(8.0), names=("time",))
    out = write_store(encode_chunks(cells, grid, {"v": "float64"}, max_box_elements=3), folder("s"))
    stats = storage_stats(read_chunks(spark, out, ("time",)), ("time",)).first()
    assert (stats["shape"], stats["chunks"], stats["n_chunks"]) == ([16], [8], 1)
    assert read_array(spark, out, grid, {"v": np.nan}).count() == 16
    with pytest.raises(ValueError):
        read_array(spark, out, Grid(("time",), {"time": 16}, {"time": 4}), {"v": np.nan})


def test_whole_numbers_need_a_fill_and_stay_exact(spark):
    grid = Grid(("time",), {"time": 3}, {"time": 3})
    cells = spark.createDataFrame([(0, 2**53 + 1)], "time_i bigint, v bigint")
    with pytest.raises(ValueError):
        encode_chunks(cells, grid, {"v": "int64"})
    chunks = encode_chunks(cells, grid, {"v": "int64"}, fill={"v": -9})
    got = decode_chunks(chunks, ("time",), kind="bigint").orderBy("time_i").collect()
    assert [r["v"] for r in got] == [2**53 + 1, -9, -9]


def test_repeats_are_not_sent_on(spark):
    grid = Grid(("time",), {"time": 4}, {"time": 4})
    cells = spark.range(200_000).selectExpr("id % 2 AS time_i", "1D AS v")
    rows = encode_chunks(cells, grid, {"v": "float64"}, strict=False)
    assert [r["error"] for r in rows.collect()] == ["duplicate cells"]
    gather = _gather((), 4, ["v"], 1_000_000)
    batch = pa.record_batch({"_cell": pa.array([1, 0, 1, 1]), "v": pa.array([1.0, 2, 3, 4])})
    pieces = list(gather(iter([batch])))[0].to_pylist()
    assert len(pieces) == 1 and len(pieces[0]["_pos"]) == 2 * 4 and pieces[0]["_twice"]


def test_scattered_cells_take_no_object_each():
    """Every cell in a box of its own: the pieces are cut from the bytes as they lie."""
    n = 100_000
    cell = np.random.default_rng(0).permutation(n) * 4 + 1
    v = pa.array(np.where(np.arange(n) % 7, cell / 2, 0), mask=np.arange(n) % 7 == 0)
    day = pa.array(cell.astype("datetime64[D]"))
    batch = pa.record_batch({"_cell": pa.array(cell), "v": v, "day": day})
    gather = _gather((), 4, ["v", "day"], n)
    tracemalloc.start()
    pieces = pa.Table.from_batches(list(gather(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces["_box"].to_pylist() == list(range(n))
    assert set(pieces["_pos"].to_pylist()) == {np.int32(1).tobytes()}
    order = np.argsort(cell)
    held = np.frombuffer(b"".join(pieces["_ok_v"].to_pylist()), bool)
    assert (held == (order % 7 > 0)).all() and not any(pieces["_ok_day"].to_pylist())
    values = np.frombuffer(b"".join(pieces["v"].to_pylist()), "f8")
    assert (values[held] == cell[order][held] / 2).all()
    assert (np.frombuffer(b"".join(pieces["day"].to_pylist()), "i8") == cell[order]).all()
    assert peak < 100 * n


def test_payload_is_plain_zlib_of_shuffled_bytes():
    block = np.arange(6, dtype="<i2").reshape(2, 3)
    payload = blocks.encode(block, "zlib", 9, True)
    assert zlib.decompress(payload) == bytes([0, 1, 2, 3, 4, 5] + [0] * 6)
    assert payload[:2] == b"\x78\xda"  # the mark of level 9


def test_failed_write_keeps_the_store(spark, folder):
    grid = Grid(("time",), {"time": 4}, {"time": 2})
    good = cells_of(spark, np.arange(4.0), names=("time",))
    out = write_store(encode_chunks(good, grid, {"v": "float64"}), folder("s"))
    with pytest.raises(PySparkException):
        write_store(encode_chunks(good.union(good), grid, {"v": "float64"}), out)
    assert read_cells(spark, out, ("time",)).count() == 4
    write_store(encode_chunks(good.filter("time_i = 0"), grid, {"v": "float64"}), out)
    assert read_cells(spark, out, ("time",)).count() == 2

"""Stores: commits, records, several dims, kinds of values, zones and bitmaps."""

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import blocks
from gridloom.functions.values import resolve_fill, resolve_fill_column
from gridloom.model import Arrays, Grid
from gridloom.operators.codec import decode_chunks, encode_arrays, encode_chunks, spark_type
from gridloom.operators.reports import storage_stats
from gridloom.operators.selecting import select_day
from gridloom.plans.rechunk import file_attributes, rechunk
from gridloom.plans.store import many_files_store, outer_files_store, single_source_store
from gridloom.queries.stores import without_markers
from gridloom.sinks import commits
from gridloom.sinks.chunks import store_table, write_store
from gridloom.sinks.publish import plan_copy, verify_copy
from gridloom.sinks.results import RunFailed
from gridloom.sources.digest import file_digests
from gridloom.sources.ledger import read_files
from gridloom.sources.manifest import scan_files
from gridloom.sources.store import (
    chunk_zones,
    read_array,
    read_cells,
    read_chunks,
    read_coordinate,
    read_labelled,
    store_catalog,
)

SPEC = {"chunk_map": {"time": 2, "lon": 3}, "shard_map": {"time": 4},
        "fill_value": "nan", "fill_value_dtype": "float64"}
LINE = Grid(("time",), {"time": 8}, {"time": 2}, {"time": 4})


def line(spark, *values, start=0):
    rows = [(start + k, float(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "time_i bigint, v double")


def values(frame):
    return {r["time_i"]: r["v"] for r in frame.collect()}


def write(spark, out, *given):
    return write_store(encode_chunks(line(spark, *given), LINE, {"v": "float64"}), out)


def test_versions_need_no_success_marker(spark, folder):
    out = folder("s")
    with without_markers(spark):
        write(spark, out, 1, 2)
        write(spark, out, 5, 6, 7)
        with pytest.raises(Exception, match="duplicate cells"):
            write_store(
                encode_chunks(line(spark, 1, 1).union(line(spark, 9)), LINE, {"v": "float64"}), out
            )
        assert values(read_cells(spark, out, which="present")) == {0: 5, 1: 6, 2: 7}
        assert commits.numbers(spark, out) == [1, 2]
        # what the failed write left behind is neither read nor written again
        write(spark, out, 8)
    assert commits.numbers(spark, out) == [2, 4]
    assert values(read_cells(spark, out, which="present")) == {0: 8}
    assert sorted(n for n in os.listdir(out) if n.startswith("version")) == [
        "version-00000002", "version-00000004",
    ]


def test_a_version_is_committed_once(spark, folder):
    out = write(spark, folder("s"), 1)
    with pytest.raises(FileExistsError):
        commits.commit(spark, out, 1, {"variables": [], "tables": []})
    assert values(read_cells(spark, out, which="present")) == {0: 1}
    assert [n for n in os.listdir(f"{out}/commits") if not n.startswith(".")] == ["00000001.json"]
    with open(f"{out}/commits/00000001.json") as record:
        assert json.load(record)["variables"][0]["dims"] == ["time"]
    with pytest.raises(FileNotFoundError):
        read_cells(spark, folder("nothing"))
    with pytest.raises(KeyError):
        read_cells(spark, out, variables=["w"])


def mixed(spark, folder, **options):
    cells = spark.createDataFrame(
        [(t, x, t * 10.0 + x) for t in range(5) for x in range(4) if (t + x) % 3],
        "time_i bigint, lon_i bigint, t2m double",
    )
    height = spark.createDataFrame([(0, 5), (3, -7)], "lon_i bigint, height int")
    note = spark.createDataFrame([(1, "windy"), (4, "schön")], "time_i bigint, note string")
    times = spark.range(5).selectExpr(
        "id AS time_i", "timestamp_ntz'2024-02-28 12:00:00' + make_dt_interval(id) AS at"
    )
    names = spark.range(4).selectExpr("id AS lon_i", "concat('east ', id) AS name")
    return single_source_store(
        cells, ("time", "lon"), {"time": 5, "lon": 4}, {"t2m": "float32"},
        SPEC | {"fill_values": {"height": -1, "note": "calm"}}, folder("mixed"),
        {"time": times, "lon": names},
        others=[(height, ("lon",), {"height": "int16"}), (note, ("time",), {"note": "str"})],
        **options,
    )


def test_a_store_of_several_dims_is_opened_by_its_path(spark, folder):
    attributes = spark.createDataFrame([("global", "source", "x")], "scope string, key string, value string")
    out = mixed(spark, folder, attributes=attributes)
    known = {r["name"]: r for r in store_catalog(spark, out).collect()}
    assert set(known) == {"t2m", "height", "note", "time", "lon"}
    assert known["t2m"]["sizes"] == [5, 4] and known["t2m"]["shard"] == [4, 4]
    assert known["note"]["fill"] == "calm" and known["time"]["dtype"] == "datetime64[us]"
    assert [n for n, r in known.items() if r["coordinate"]] == ["time", "lon"]
    numbers = read_cells(spark, out, variables=["t2m", "height"], which="present").collect()
    assert {(r["time_i"], r["lon_i"], r["v"]) for r in numbers if r["var"] == "height"} == {
        (None, 0, 5.0), (None, 3, -7.0),
    }
    assert len(numbers) == 2 + sum((t + x) % 3 > 0 for t in range(5) for x in range(4))
    notes = read_array(spark, out, variables=["note"]).orderBy("time_i").collect()
    assert [r["v"] for r in notes] == ["calm", "windy", "calm", "calm", "schön"]
    with pytest.raises(ValueError, match="no column holds"):
        read_cells(spark, out)
    assert read_array(spark, out, variables=["t2m"]).count() == 20
    labels = {r["lon_i"]: r["label"] for r in read_coordinate(spark, out, "lon").collect()}
    assert labels == {k: f"east {k}" for k in range(4)}
    first, last = (F.lit(f"2024-{d} 00:00:00").cast("timestamp_ntz") for d in ("02-29", "03-02"))
    found = read_labelled(spark, out, "time", first, last, ["t2m"])
    assert {r["time_i"] for r in found.collect()} == {1, 2}
    assert store_table(spark, out, "attributes").first()["value"] == "x"
    stats = {r["name"]: r for r in storage_stats(read_chunks(spark, out), ("time", "lon")).collect()}
    assert set(stats) == set(known) and all(r["storage"] > 0 for r in stats.values())
    assert stats["t2m"]["n_chunks"] == 6 and stats["time"]["n_chunks"] == 3
    assert stats["lon"]["filters"] == ["shuffle", "zstd:5"]
    # a window along a dim that a variable lacks leaves it out
    part = read_cells(spark, out, variables=["t2m", "height"], window={"time": (0, 2)}, which="present")
    assert {r["var"] for r in part.collect()} == {"t2m"}


def test_several_dims_are_packed_behind_one_shuffle(spark):
    two = [
        Arrays(line(spark, 1, 2), LINE, {"v": "float64"}),
        Arrays(
            line(spark, 3).withColumnsRenamed({"time_i": "lon_i", "v": "w"}),
            Grid(("lon",), {"lon": 9}, {"lon": 4}), {"w": "float32"},
        ),
    ]
    chunks = encode_arrays(two)
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FlatMapGroupsInArrow") == 1
    rows = {r["var"]: r for r in chunks.collect()}
    assert (rows["v"]["dims"], rows["w"]["dims"]) == (["time"], ["lon"])
    assert rows["v"]["o_lon"] is None and rows["w"]["n_lon"] == 4
    with pytest.raises(ValueError, match="given twice"):
        encode_arrays([two[0], two[0]])


def test_given_nan_and_absent_cells_are_told_apart(spark, folder):
    nan = float("nan")
    rows = [(0, 1.0), (1, nan), (2, nan), (3, None), (5, nan)]
    cells = spark.createDataFrame(rows, "time_i bigint, v double")
    out = write_store(encode_chunks(cells, LINE, {"v": "float64"}), folder("s"))
    found = values(read_cells(spark, out, which="present"))
    assert set(found) == {0, 1, 2, 5} and found[0] == 1.0 and all(np.isnan(found[k]) for k in (1, 2, 5))
    marked = {r["time_i"]: r["present"] for r in read_cells(spark, out, which="marked").collect()}
    assert marked == {0: True, 1: True, 2: True, 3: False, 4: False, 5: True}
    facts = {r["o_time"]: r for r in read_chunks(spark, out).collect()}
    assert facts[0]["valid"] is None and facts[2]["n_present"] == 1 and facts[2]["n_cells"] == 2
    # nothing but the fill is stored as no payload, and is there all the same
    assert facts[4]["payload"] is None and facts[4]["stored_bytes"] == 0
    assert read_array(spark, out).count() == 8


@given(st.lists(st.booleans(), min_size=1, max_size=70))
def test_bitmaps_round_trip(valid):
    valid = np.array(valid)
    assert np.array_equal(blocks.decode_valid(blocks.encode_valid(valid), len(valid)), valid)


@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=9))
def test_zones_hold_whole_numbers_that_doubles_round(given_):
    low, high, n_nan = blocks.zone(np.array(given_, np.int64))
    assert low <= min(given_) and high >= max(given_) and n_nan == 0


def test_zones_of_other_kinds():
    assert blocks.zone(np.array([np.nan, 2, -1.5])) == (-1.5, 2.0, 1)
    assert blocks.zone(np.array([np.nan])) == (None, None, 1)
    assert blocks.zone(np.array(["a"], object)) == (None, None, None)
    days = np.array(["1970-01-03", "NaT"], "datetime64[D]")
    assert blocks.zone(days) == (2.0, 2.0, 1)


def test_zone_maps_are_pushed_to_the_scan(spark, folder):
    out = write(spark, folder("s"), 1, 2, 50, float("nan"), 3, 70, 4, 5)
    zones = {r["time_c"]: r for r in chunk_zones(spark, out, "v").collect()}
    assert (zones[1]["min_v"], zones[1]["max_v"], zones[1]["n_nan"]) == (50, 50, 1)
    assert zones[2]["n_cells"] == 2
    found = read_cells(spark, out, values=(49, 60))
    assert values(found) == {2: 50}
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(v_max,49" in plan and "LessThanOrEqual(v_min,60" in plan
    kept = read_chunks(spark, out).filter("n_nan IS NULL OR v_max >= 49").filter("v_min <= 60")
    assert [r["o_time"] for r in kept.collect() if r["v_min"] <= 60 <= r["v_max"] or r["v_max"] == 50]
    assert values(read_cells(spark, out, values=(None, 1))) == {0: 1}
    everything = read_cells(spark, mixed(spark, folder), variables=["note"], which="present")
    assert everything.count() == 2  # text has no zones


def test_texts_flags_and_times_round_trip(spark, folder):
    rows = [(k, "" if k % 4 == 0 else "ä\n" * k, None if k % 5 == 0 else bool(k % 2), k) for k in range(9)]
    cells = spark.createDataFrame(rows, "time_i bigint, t string, f boolean, n int").selectExpr(
        "time_i", "t", "f", "IF(n % 3 = 0, NULL, date_add(DATE'1969-12-30', n)) AS d",
        "timestamp_ntz'2262-01-01 00:00:00.000001' + make_dt_interval(n) AS s",
        "CAST(timestamp'2024-01-01 10:00:00' AS timestamp) AS z",
    )
    kinds = {"t": "str", "f": "bool", "d": "datetime64[D]", "s": "datetime64[us]", "z": "datetime64[us]"}
    grid = Grid(("time",), {"time": 11}, {"time": 4})
    for codec, shuffle, limit in (("zlib", True, 100), ("zstd", True, 3), ("none", False, 2)):
        chunks = encode_chunks(
            cells, grid, kinds, codec=codec, level=3, shuffle=shuffle, max_box_elements=limit,
            fill={"f": True, "t": "none", "d": "2000-01-01"},
        )
        out = write_store(chunks, folder(f"{codec}"))
        for name, kind in kinds.items():
            want = {r["time_i"]: r[name] for r in cells.collect() if r[name] is not None}
            assert values(read_cells(spark, out, variables=[name], which="present")) == want
        assert values(read_array(spark, out, variables=["f"]))[10] is True
        assert values(read_array(spark, out, variables=["t"]))[9] == "none"
        assert str(values(read_array(spark, out, variables=["d"]))[10]) == "2000-01-01"
        assert values(read_array(spark, out, variables=["s"]))[10] is None
    assert spark_type(["int32", "float32"]) == "double" and spark_type([]) == "double"
    with pytest.raises(Exception, match="are no float64"):
        encode_chunks(cells, grid, {"t": "float64"}).collect()


def test_numbers_beyond_a_dtype_are_refused(spark):
    grid = Grid(("time",), {"time": 2}, {"time": 1})
    for given_, dtype in ((1e39, "float32"), (2.0, "bool"), (-1.0, "uint8"), (float("nan"), "int32")):
        cells = spark.createDataFrame([(0, given_), (1, 1.0)], "time_i bigint, v double")
        rows = encode_chunks(cells, grid, {"v": dtype}, fill=0, strict=False).collect()
        assert {r["o_time"]: r["error"] for r in rows} == {
            0: f"value out of range for {dtype}", 1: None,
        }
    inf = spark.createDataFrame([(0, float("inf"))], "time_i bigint, v double")
    got = decode_chunks(encode_chunks(inf, grid, {"v": "float32"}), ("time",))
    assert values(got) == {0: float("inf")}


FILLS = [
    ("nan", "float32"), ("-inf", "float64"), ("1e40", "float32"), ("1e40", "float64"), ("3", "int8"),
    ("3.0", "int16"), ("3.5", "int16"), ("300", "int8"), ("300", "uint8"), ("200", "uint8"),
    ("-1", "uint32"), ("18446744073709551615", "uint64"), ("9223372036854775807", "int64"),
    ("9223372036854775808", "int64"), ("nan", "int32"), ("true", "bool"), ("0", "bool"), ("2", "bool"),
    ("2024-02-30", "datetime64[D]"), ("2024-02-29", "datetime64[D]"), ("word", "float64"),
    ("NaT", "datetime64[us]"), ("2024-02-29 10:00:00", "datetime64[us]"), ("word", "str"),
]


@pytest.mark.parametrize("text,dtype", FILLS)
def test_fill_rules_of_values_and_columns_agree(spark, text, dtype):
    frame = spark.createDataFrame([(text,)], "text string")
    column = frame.select(resolve_fill_column(F.col("text"), dtype).alias("f"))
    try:
        want = resolve_fill(text, dtype)
    except (ValueError, OverflowError, TypeError):
        with pytest.raises(Exception):
            column.collect()
        return
    got = column.first()["f"]
    if dtype.startswith("datetime"):
        assert got is None if np.isnat(want) else np.datetime64(got) == want
    elif want != want:
        assert got != got
    else:
        assert got == (want if isinstance(want, str) else want.item())


def test_fills_of_wrong_kinds():
    for value, dtype in ((1.5, "bool"), (3, "datetime64[us]"), (1e40, "float32"), (True, "int8"), (0, "str")):
        with pytest.raises((TypeError, ValueError, OverflowError)):
            resolve_fill(value, dtype)
    with pytest.raises(ValueError, match="no rule"):
        resolve_fill("1", "complex64")
    assert resolve_fill(float("nan"), "datetime64[D]") != resolve_fill("2024-01-01", "datetime64[D]")


FILE_GRID = Grid(("time", "lon"), {"lon": 2}, {"time": 2})


def run_of(spark, files, listed=None):
    cells = spark.createDataFrame(
        [("ecmwf", f, t, 0, v) for f, values_ in files.items() for t, v in enumerate(values_)],
        "dataset string, file string, time_i bigint, lon_i bigint, v double",
    )
    names = listed or sorted(files)
    sizes = spark.createDataFrame([("ecmwf", f, 3) for f in names], "dataset string, file string, size_time bigint")
    work = sizes.selectExpr("dataset", "file", "concat('raw/', file) AS in_path", "concat('out/', file) AS out_path")
    return cells, sizes, work


def held(spark, out):
    found = {}
    for r in read_cells(spark, out, which="present").collect():
        found.setdefault(r["file"], {})[r["time_i"]] = r["v"]
    return found


def test_a_file_that_was_not_read_keeps_its_output(spark, folder):
    out, kind = folder("r"), {"v": "float64"}
    rechunk(*run_of(spark, {"a": [1.0, 2.0], "b": [3.0]}), FILE_GRID, kind, 7, out)
    late = run_of(spark, {"a": [9.0]}, ["a", "b"])
    results = rechunk(*late, FILE_GRID, kind, 7, out, stop_on_error=False).collect()
    assert {r["in_path"]: r["message"] for r in results} == {
        "raw/a": "raw/a is at out/a", "raw/b": "raw/b failed, it was not read",
    }
    assert held(spark, out) == {"a": {0: 9.0}, "b": {0: 3.0}}
    with pytest.raises(RunFailed, match="b was not read"):
        rechunk(*late, FILE_GRID, kind, 7, out)
    assert held(spark, out) == {"a": {0: 9.0}, "b": {0: 3.0}}


def test_a_ledger_tells_empty_missing_and_broken_files_apart(spark, folder, tmp_path):
    columns = "time_i bigint, lon_i bigint, v double"
    raw, out = tmp_path / "raw", folder("r")
    raw.mkdir()

    def put(name, rows, **more):
        table = pa.table(
            {"time_i": pa.array(range(len(rows)), pa.int64()), "lon_i": pa.array([0] * len(rows), pa.int64()),
             "v": pa.array(rows, pa.float64())} | more
        )
        pq.write_table(table, raw / name)

    put("a.parquet", [1.0, 2.0])
    put("b.parquet", [], other=pa.array([], pa.string()))
    (raw / "c.parquet").write_bytes(b"no parquet")
    pq.write_table(pa.table({"time_i": [0]}), raw / "e.parquet")
    names = ["a", "b", "c", "d", "e"]
    files = spark.createDataFrame([("ecmwf", n, f"{n}.parquet") for n in names], "dataset string, file string, rel_path string")
    cells, ledger = read_files(spark, files, str(raw), columns)
    rows = {r["file"]: r for r in ledger.collect()}
    assert {n: (r["status"], r["cells"]) for n, r in rows.items()} == {
        "a": ("read", 2), "b": ("read", 0), "c": ("failed", 0), "d": ("missing", 0), "e": ("failed", 0),
    }
    _, sizes, work = run_of(spark, {}, names)
    rechunk(*run_of(spark, {n: [5.0] for n in names}), FILE_GRID, {"v": "float64"}, 7, out)
    results = rechunk(cells, sizes, work, FILE_GRID, {"v": "float64"}, 7, out, stop_on_error=False, ledger=ledger)
    told = {r["in_path"][4:]: (r["ok"], r["message"]) for r in results.collect()}
    assert {n: ok for n, (ok, _) in told.items()} == {"a": True, "b": True, "c": False, "d": False, "e": False}
    assert "it was not read" in told["d"][1] and "ArrowInvalid" in told["c"][1] and "lon_i" in told["e"][1]
    assert held(spark, out) == {"a": {0: 1.0, 1: 2.0}} | {n: {0: 5.0} for n in "cde"}
    # cells that got lost between reading and packing are no success either
    fewer = rechunk(cells.where("time_i = 0"), sizes, work, FILE_GRID, {"v": "float64"}, 7, folder("x"),
                    stop_on_error=False, ledger=ledger)
    assert "not all of its cells" in {r["in_path"]: r["message"] for r in fewer.collect()}["raw/a"]


def test_rechunked_files_hold_coordinates_and_attributes(spark, folder):
    out = folder("r")
    cells, sizes, work = run_of(spark, {"a": [1.0], "b": [2.0, 3.0]})
    hours = sizes.select("dataset", "file", F.explode(F.expr("sequence(0L, 2L)")).alias("time_i")).withColumn(
        "hour", F.concat("file", F.lit(" "), "time_i")
    )
    rows = [(d, f, s, "k", "x") for d, f in (("ecmwf", "a"), ("ecmwf", "b"), ("ecmwf", "z"), ("dpird", "a")) for s in ("global", "v")]
    attributes = spark.createDataFrame(rows, "dataset string, file string, scope string, key string, value string")
    options = {"coordinates": {"time": hours}, "attributes": attributes}
    results = rechunk(cells, sizes, work, FILE_GRID, {"v": "float64"}, 7, out, **options)
    assert results.filter("ok").count() == 2
    labels = read_cells(spark, out, variables=["time"], kind="string", which="present").collect()
    assert {(r["file"], r["time_i"], r["v"]) for r in labels} == {
        (f, t, f"{f} {t}") for f in "ab" for t in range(3)
    }
    assert held(spark, out) == {"a": {0: 1.0}, "b": {0: 2.0, 1: 3.0}}
    kept = {(r["dataset"], r["file"], r["scope"]) for r in file_attributes(spark, out).collect()}
    assert kept == {("ecmwf", f, s) for f in "ab" for s in ("global", "v")}
    stations = [t.replace({"ecmwf": "dpird"}, subset=["dataset"]) for t in (cells, sizes, work)]
    rechunk(*stations, FILE_GRID, {"v": "float64"}, 7, folder("d"), attributes=attributes)
    kept = {(r["file"], r["scope"]) for r in file_attributes(spark, folder("d")).collect()}
    assert kept == {("a", "v")}


def test_many_files_keep_their_labels(spark, folder):
    files = spark.createDataFrame([("b", 2), ("a", 3)], "file string, size_time bigint")
    cells = spark.createDataFrame([("a", 2, 1.0), ("b", 0, 2.0)], "file string, time_i bigint, v double")
    labels = files.select("file", F.explode(F.expr("sequence(0L, size_time - 1)")).alias("time_i")).withColumn(
        "label", F.concat("file", "time_i")
    )
    attributes = spark.createDataFrame([("a", "global", "k", "first"), ("b", "global", "k", "second")],
                                       "file string, scope string, key string, value string")
    out = many_files_store(cells, files, ("time",), {}, {"v": "float64"}, SPEC, folder("m"),
                           coordinates={"time": labels}, attributes=attributes)
    found = {r["time_i"]: r["label"] for r in read_coordinate(spark, out, "time").collect()}
    assert found == {0: "a0", 1: "a1", 2: "a2", 3: "b0", 4: "b1"}
    assert values(read_cells(spark, out, which="present")) == {2: 1.0, 3: 2.0}
    assert [tuple(r) for r in store_table(spark, out, "attributes").collect()] == [("global", "k", "first")]


def test_labels_of_several_dims_are_joined(spark, folder):
    rows = [("x", 3, 1.0), ("x", 1, 2.0), ("a", 7, 3.0), ("m", 1, 4.0)]
    cells = spark.createDataFrame(rows, "name string, year int, v double")
    out = outer_files_store(cells, {"time": "year", "lon": "name"}, {"v": "float64"}, SPEC, folder("o"))
    years = {r["time_i"]: r["label"] for r in read_coordinate(spark, out, "time").collect()}
    names = {r["lon_i"]: r["label"] for r in read_coordinate(spark, out, "lon").collect()}
    assert years == {0: 1, 1: 3, 2: 7} and names == {0: "a", 1: "m", 2: "x"}
    found = read_cells(spark, out, which="present").collect()
    assert {(names[r["lon_i"]], years[r["time_i"]], r["v"]) for r in found} == set(rows)
    assert read_array(spark, out).count() == 9
    with pytest.raises(Exception, match="duplicate cells"):
        outer_files_store(cells.union(cells), {"time": "year", "lon": "name"}, {"v": "float64"}, SPEC, folder("p"))
    none = cells.union(spark.createDataFrame([(None, 1, 1.0)], cells.schema))
    with pytest.raises(Exception, match="has no name"):
        outer_files_store(none, {"time": "year", "lon": "name"}, {"v": "float64"}, SPEC, folder("q"))


def test_copies_of_equal_length_are_told_apart(spark, tmp_path):
    for side, last in (("source", b"same"), ("target", b"some")):
        (tmp_path / side).mkdir()
        (tmp_path / side / "a").write_bytes(b"0123456789")
        (tmp_path / side / "b").write_bytes(b"0123456" + last)
    (tmp_path / "source" / "new").write_bytes(b"x")
    sides = [
        file_digests(scan_files(spark, str(tmp_path / side)), block=4) for side in ("source", "target")
    ]
    assert sorted(r["rel_path"] for r in plan_copy(*sides, by="digest").collect()) == ["b", "new"]
    assert [r["rel_path"] for r in plan_copy(*sides).collect()] == ["new"]
    counts = verify_copy(*sides).first().asDict()
    assert counts == {"matched": 1, "missing": 1, "size_differs": 0, "extra": 0, "content_differs": 1}
    gone = scan_files(spark, str(tmp_path / "source")).withColumn("path", F.concat("path", F.lit("x")))
    lost = file_digests(gone).collect()
    assert all(r["digest"] is None and r["unread"] for r in lost) and len(lost) == 3


def test_a_day_is_chosen_by_the_coordinate(spark):
    days = spark.range(4).selectExpr(
        "id AS time_i", "timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(id) AS time"
    )
    cells = line(spark, 1, 2, 3)
    for day, want, whole in (("2024-01-02", 1, False), ("2024-01-04", 0, False), ("2025-01-01", 3, True)):
        found, fell_back = select_day(cells, day, labels=days)
        assert (found.count(), fell_back) == (want, whole)

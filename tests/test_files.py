"""Manifests, selection, results and copies on small files."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from gridloom.functions import paths
from gridloom.functions.ordering import broadcast_within, is_ascending, with_running_total
from gridloom.model import Grid
from gridloom.operators.reports import compare_storage, flag_count, flagged_first, storage_totals
from gridloom.operators.selecting import select_day, strip_global_attrs
from gridloom.plans.publish import publish, stage
from gridloom.plans.rechunk import BY, file_attributes, rechunk
from gridloom.plans.store import many_files_store, store_name
from gridloom.session import few_listers
from gridloom.sinks.chunks import replace_files
from gridloom.sinks.objects import copy_files, write_objects
from gridloom.sinks.publish import verify_copy
from gridloom.sinks.results import RunFailed, fail_fast, run_summary
from gridloom.sources.cells import concat, file_offsets, label_positions
from gridloom.sources.digest import file_digests
from gridloom.sources.manifest import (
    in_order,
    include,
    require_files,
    sample_file,
    scan_files,
    work_list,
)
from gridloom.sources.store import read_cells


def put(root, name, data=b"x"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def names(frame, column="rel_path"):
    return sorted(r[column] for r in frame.select(column).collect())


def test_scan_finds_files_at_any_depth(spark, folder):
    root = folder("raw")
    for name in ("ECMWF/2024/02/06.nc", "ECMWF/2024/02/07.nc", "ECMWF/top.nc", "README.txt"):
        put(root, name)
    put(root, "ECMWF/2024/02/.06.nc.tmp")
    found = scan_files(spark, root, "ECMWF/**/*.nc")
    assert names(found) == ["ECMWF/2024/02/06.nc", "ECMWF/2024/02/07.nc", "ECMWF/top.nc"]
    assert names(scan_files(spark, root, "README.txt")) == ["README.txt"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_scan_of_a_missing_root_is_empty(spark, folder):
    assert scan_files(spark, folder("nothing"), "**/*.nc").isEmpty()


@pytest.mark.parametrize(
    "pattern,path,hit",
    [
        ("ECMWF/**/*.nc", "ECMWF/06.nc", True),
        ("ECMWF/**/*.nc", "ECMWF/a/b/06.nc", True),
        ("ECMWF/**/*.nc", "x/ECMWF/06.nc", False),
        ("[0-9][0-9].nc", "06.nc", True),
        ("[0-9][0-9].nc", "a6.nc", False),
        ("a?.n*", "ab.nc", True),
        ("a.nc", "abnc", False),
        ("/DPIRD/**", "DPIRD/a/b", True),
    ],
)
def test_globs(spark, pattern, path, hit):
    frame = spark.createDataFrame([(path,)], "rel_path string")
    assert include(frame, [pattern]).count() == hit


def test_paths(spark):
    frame = spark.createDataFrame([("raw/ECMWF/2025/01/31.nc",)], "path string")
    path = F.col("path")
    row = frame.select(
        paths.rebase(path, "raw", "out").alias("out"), paths.date_of(path).alias("day")
    ).first()
    assert (row["out"], row["day"]) == ("out/ECMWF/2025/01/31.nc", "2025-01-31")
    with pytest.raises(Exception, match="is not below"):
        frame.select(paths.rebase(path, "elsewhere", "out")).collect()


def test_order_is_by_path_component(spark):
    listed = ["a/b-c/x", "a/b/x", "a/b", "a/c", "a/b/x/y"]
    frame = spark.createDataFrame([(p,) for p in listed], "path string")
    got = [r["path"] for r in in_order(frame).orderBy("ord").collect()]
    assert got == sorted(listed, key=lambda p: p.split("/"))
    assert sample_file(in_order(frame), 2).first()["path"] == "a/b/x"
    with pytest.raises(IndexError):
        sample_file(in_order(frame))


def test_running_totals_over_many_partitions(spark):
    frame = spark.range(1000).selectExpr("id", "id % 7 AS n").repartition(9)
    got = with_running_total(frame, [F.col("id")], "before", F.col("n")).orderBy("id").collect()
    total = 0
    for row in got:
        assert row["before"] == total
        total += row["n"]


def test_broadcast_only_within_its_bound(spark):
    frame = spark.range(50)
    hinted = broadcast_within(frame, 50)._jdf.queryExecution().logical().toString()
    plain = broadcast_within(frame, 49)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_ascending_labels(spark):
    rows = [(k, k * 2) for k in range(50)]
    up = spark.createDataFrame(rows, "p bigint, v bigint")
    assert is_ascending(up, "p", "v", bucket=8)
    for at in (7, 8, 49):
        bad = [(k, -1 if k == at else v) for k, v in rows]
        assert not is_ascending(spark.createDataFrame(bad, "p bigint, v bigint"), "p", "v", bucket=8)


def test_select_day(spark):
    def cells(days):
        rows = [(k, f"2024-01-{d:02d} 06:00:00") for k, d in enumerate(days)]
        return spark.createDataFrame(rows, "time_i bigint, t string").selectExpr(
            "time_i", "CAST(t AS timestamp_ntz) AS time"
        )

    def picked(days, day):
        found, fell_back = select_day(cells(days), day)
        return found.count(), fell_back

    assert picked([1, 2, 2, 4], "2024-01-02") == (2, False)
    assert picked([1, 2, 4], "2024-01-03") == (0, False)
    assert picked([1, 2, 4], "2024-02-01") == (3, True)
    assert picked([1, 2, 4], "2023-12-31") == (3, True)
    assert picked([4, 1, 2], "2024-02-01") == (0, False)
    assert picked([4, 1, 2], "2024-01-04") == (1, False)
    untimed, fell_back = select_day(cells([1]).drop("time"), "2024-01-01")
    assert (untimed.count(), fell_back) == (1, True)


def test_attributes_are_stripped_for_one_dataset(spark):
    rows = [(d, "f", s, "source", "station notes") for d in ("dpird", "ecmwf") for s in ("global", "t2m")]
    attrs = spark.createDataFrame(rows, "dataset string, file string, scope string, key string, value string")
    left = {(r["dataset"], r["scope"]) for r in strip_global_attrs(attrs).collect()}
    assert left == {("dpird", "t2m"), ("ecmwf", "global"), ("ecmwf", "t2m")}


def test_concat_and_labels(spark):
    files = spark.createDataFrame([("b", 2), ("a", 3)], "file string, size_time bigint")
    cells = spark.createDataFrame([("a", 0), ("a", 2), ("b", 1)], "file string, time_i bigint")
    joined = concat(cells, file_offsets(files, "time"), "time")
    assert sorted((r["file"], r["time_i"]) for r in joined.collect()) == [("a", 0), ("a", 2), ("b", 4)]
    labelled = spark.createDataFrame([("x", 0), ("z", 1), ("y", 0)], "lat string, lat_i bigint")
    got = {r["lat"]: r["lat_i"] for r in label_positions(labelled, "lat", "lat").collect()}
    assert got == {"x": 0, "y": 1, "z": 2}


def test_storage_comparison(spark):
    def stats(rows):
        return spark.createDataFrame(rows, "name string, storage bigint, chunks array<bigint>, dtype string")

    old = stats([
        ("edge", 100, [2], "f4"), ("above", 100, [2], "f4"), ("chunks", 100, [2], "f4"),
        ("dtype", 100, [2], "f4"), ("zero", 0, [2], "f4"), ("old", 50, [2], "f4"),
        ("null", 10, None, "f4"),
    ])
    new = stats([
        ("edge", 105, [2], "f4"), ("above", 106, [2], "f4"), ("chunks", 100, [3], "f4"),
        ("dtype", 100, [2], "f8"), ("zero", 9, [9], "f8"), ("new", 30, [2], "f4"),
        ("null", 10, None, "f4"),
    ])
    compared = compare_storage(old, new)
    assert names(compared.filter("flagged"), "name") == ["above", "chunks", "dtype"]
    assert "zero" not in names(compared, "name")
    assert flag_count(compared).first()[0] == 3
    assert [r["name"] for r in flagged_first(compared, 2).collect()] == ["above", "chunks"]
    assert storage_totals(old, new).first()[:2] == (460, 460)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        storage_totals(old.filter("storage = 0"), new).collect()


GRID = Grid(("time", "lon"), {"lon": 2}, {"time": 2})


def prepared(spark, rows):
    cells = spark.createDataFrame(
        [("ecmwf", *r) for r in rows],
        "dataset string, file string, time_i bigint, lon_i bigint, v double",
    )
    listed = sorted({r[0] for r in rows})
    sizes = spark.createDataFrame(
        [("ecmwf", f, 3) for f in listed], "dataset string, file string, size_time bigint"
    )
    work = spark.createDataFrame(
        [("ecmwf", f, f"raw/{f}", f"out/{f}") for f in listed],
        "dataset string, file string, in_path string, out_path string",
    )
    return cells, sizes, work


def contents(spark, out):
    read = read_cells(spark, out, GRID.dims, BY, without_fill=True)
    return {(r["file"], r["time_i"], r["lon_i"], r["v"]) for r in read.collect()}


def test_rechunk_replaces_only_its_files_and_survives_failures(spark, folder):
    out = folder("rechunked")
    first = [("a/1.nc", 0, 0, 1.0), ("a/2.nc", 2, 1, 2.0)]
    results = rechunk(*prepared(spark, first), GRID, {"v": "float64"}, 7, out)
    assert results.filter("ok").count() == 2
    again = [("a/2.nc", 0, 1, 9.0)]
    rechunk(*prepared(spark, again), GRID, {"v": "float64"}, 7, out)
    assert contents(spark, out) == {first[0], again[0]}
    broken = [("a/1.nc", 0, 0, 5.0), ("a/2.nc", 0, 0, 5.0), ("a/2.nc", 0, 0, 6.0)]
    with pytest.raises(RunFailed, match="duplicate cells"):
        rechunk(*prepared(spark, broken), GRID, {"v": "float64"}, 7, out)
    assert contents(spark, out) == {first[0], again[0]}
    results = rechunk(
        *prepared(spark, broken), GRID, {"v": "float64"}, 7, out, stop_on_error=False
    )
    told = {r["in_path"]: (r["ok"], r["out_path"], r["message"]) for r in results.collect()}
    assert told["raw/a/1.nc"] == (True, "out/a/1.nc", "raw/a/1.nc is at out/a/1.nc")
    assert told["raw/a/2.nc"][:2] == (False, "out/a/2.nc")
    assert "duplicate cells" in told["raw/a/2.nc"][2]
    assert contents(spark, out) == {broken[0], again[0]}
    assert run_summary(results).first()[1:] == (2, 1, 1)
    with pytest.raises(RunFailed, match="raw/a/2.nc"):
        fail_fast(results)


def test_store_of_many_files(spark, folder):
    spec = {
        "chunk_map": {"time": 2}, "shard_map": {"time": 4},
        "fill_value": "nan", "fill_value_dtype": "float64",
    }
    listed = [f"2024/01/{d:02d}.nc" for d in range(1, 13)]
    rows = [(f, t, 0, d * 10.0 + t) for d, f in enumerate(listed) for t in range(3)]
    cells = spark.createDataFrame(rows, "file string, time_i bigint, lon_i bigint, v double")
    files = spark.createDataFrame([(f, 3) for f in reversed(listed)], "file string, size_time bigint")

    def store(name, **kw):
        out = many_files_store(
            cells, files, ("time", "lon"), {"lon": 2}, {"v": "float64"}, spec, folder(name), **kw
        )
        read = read_cells(spark, out, ("time", "lon"), without_fill=True).orderBy("time_i")
        return [(r["time_i"], r["v"]) for r in read.collect()]

    assert store("all") == [(d * 3 + t, d * 10.0 + t) for d in range(12) for t in range(3)]
    assert store("dry", dry_run=True) == [(t, 90.0 + t) for t in range(3)]
    assert (store_name("ecmwf", True), store_name("ecmwf", False)) == ("ecmwf_dryrun", "ecmwf")
    few = files.limit(1)
    with pytest.raises(FileNotFoundError):
        many_files_store(cells, few, ("time", "lon"), {"lon": 2}, {"v": "float64"}, spec, folder("x"))


def test_guards(spark):
    none = spark.createDataFrame([], "path string, length bigint")
    with pytest.raises(FileNotFoundError, match="nothing here"):
        require_files(none, 1, "nothing here")
    assert work_list({"d": (none, "in", "out")}).isEmpty()


def test_copies_replace_and_report(spark, folder):
    source, target = folder("source"), folder("target")
    put(source, "a.zarr/c/0", b"new")
    put(source, "loose", b"no store")
    put(target, "a.zarr/c/0", b"old content")
    put(target, "a.zarr/c/.0.tmp", b"left by a failed attempt, longer than the content")
    status = publish(spark, source, ["a.zarr", "absent.zarr"], target).collect()
    assert [r["ok"] for r in status] == [True]
    with open(f"{target}/a.zarr/c/0", "rb") as f:
        assert f.read() == b"new"
    assert sorted(os.listdir(f"{target}/a.zarr/c")) == ["0"]
    with pytest.raises(FileNotFoundError):
        publish(spark, source, ["absent.zarr"], target)
    pairs = spark.createDataFrame(
        [(f"{source}/missing", f"{target}/missing"), (f"{source}/loose", f"{target}/loose")],
        "source string, target string",
    )
    done = {os.path.basename(r["source"]): r["ok"] for r in copy_files(pairs).collect()}
    assert done == {"missing": False, "loose": True}


def test_staging_sends_what_the_target_lacks(spark, folder):
    source, target = folder("source"), folder("target")
    objects = spark.createDataFrame(
        [("d/1.nc", b"one"), ("d/2.nc", b"two"), ("d/3.nc", b"three")], "rel_path string, payload binary"
    )
    assert write_objects(objects, source).agg(F.sum("length")).first()[0] == 11
    put(target, "d/1.nc", b"one")
    put(target, "d/2.nc", b"old text")
    listed = scan_files(spark, source)
    planned = stage(spark, listed, target, act=False)
    assert [os.path.basename(s) for s in names(planned, "source")] == ["2.nc", "3.nc"]
    assert stage(spark, listed, target).filter("ok").count() == 2
    counts = verify_copy(listed, scan_files(spark, target)).first().asDict()
    assert counts == {"matched": 3, "missing": 0, "size_differs": 0, "extra": 0}


def test_odd_names_and_relative_roots(spark, folder, monkeypatch, tmp_path):
    names_ = ["a b.nc", "c%20d.nc", "e#f.nc", "g?h.nc"]
    for name in names_:
        put(folder("odd"), name, name.encode())
    pairs = spark.createDataFrame(
        [(f"{folder('odd')}/{n}", f"{folder('sent')}/{n}") for n in names_]
        + [("nowhere://x/y", f"{folder('sent')}/z")],
        "source string, target string",
    )
    status = copy_files(pairs)
    assert {r["ok"] for r in status.filter("source LIKE '/%'").collect()} == {True}
    assert [r["ok"] for r in status.filter("source LIKE 'nowhere%'").collect()] == [False]
    for name in names_:
        with open(f"{folder('sent')}/{name}", "rb") as f:
            assert f.read() == name.encode()
        os.remove(f"{folder('sent')}/{name}")
    assert status.count() == 5 and os.listdir(folder("sent")) == []  # copied once
    relative = os.path.relpath(folder("odd"), os.getcwd())
    assert scan_files(spark, relative).count() == 4


def test_files_that_were_never_read_fail(spark, folder):
    cells, sizes, work = prepared(spark, [("a/1.nc", 0, 0, 1.0), ("a/2.nc", 5, 0, 1.0)])
    lost = spark.createDataFrame(
        [("ecmwf", "a/3.nc", "raw/a/3.nc", "out/a/3.nc")], work.schema
    )
    unsized = [("a/4.nc", 0, 0, 1.0)]
    cells = cells.union(prepared(spark, unsized)[0])
    work = work.union(lost).union(prepared(spark, unsized)[2])
    results = rechunk(
        cells, sizes, work, GRID, {"v": "float64"}, 7, folder("r"), stop_on_error=False
    )
    assert {r["in_path"]: r["ok"] for r in results.collect()} == {
        "raw/a/1.nc": True, "raw/a/2.nc": False, "raw/a/3.nc": False, "raw/a/4.nc": False,
    }
    assert contents(spark, folder("r")) == {("a/1.nc", 0, 0, 1.0)}


def test_a_run_on_nothing_ends_well(spark, folder):
    nothing = [frame.limit(0) for frame in prepared(spark, [("a/1.nc", 0, 0, 1.0)])]
    for strict in (True, False):
        out = folder(f"n{strict}")
        assert rechunk(*nothing, GRID, {"v": "float64"}, 7, out, stop_on_error=strict).count() == 0


def test_nothing_is_lost_on_the_way(spark):
    cells = spark.createDataFrame([("a", 0, "x"), ("b", 0, None)], "file string, time_i bigint, label string")
    offsets = spark.createDataFrame([("a", 0)], "file string, offset bigint")
    with pytest.raises(Exception, match="no offset for b"):
        concat(cells, offsets, "time").collect()
    with pytest.raises(Exception, match="no label"):
        label_positions(cells, "label", "time").collect()


def test_attributes_of_many_files_have_many_writers(spark, folder, monkeypatch):
    monkeypatch.setattr("gridloom.plans.rechunk.TASK_FILES", 2)
    cells = [(f"a/{k}.nc", 0, 0, float(k)) for k in range(30)]
    given = [("ecmwf", f, "values", "units", f) for f, *_ in cells]
    attributes = spark.createDataFrame(
        given, "dataset string, file string, scope string, key string, value string"
    ).coalesce(1)
    out = folder("r")
    rechunk(*prepared(spark, cells), GRID, {"v": "float64"}, 7, out, attributes=attributes)
    found = file_attributes(spark, out)
    assert sorted(r["file"] for r in found.where("file = value").collect()) == sorted(f for f, *_ in cells)
    writers = {os.path.basename(f)[:10] for f in found.inputFiles()}
    assert len(writers) > 4


def test_attributes_of_many_files_are_one_table(spark, folder):
    schema = "dataset string, file string, scope string, key string, value string"
    cells = [(f"a/{k}.nc", 0, 0, float(k)) for k in range(30)]
    out, given = folder("r"), [("ecmwf", f, "values", "units", "old") for f, *_ in cells]
    run = lambda rows, **more: rechunk(*prepared(spark, rows), GRID, {"v": "float64"}, 7, out, **more)
    run(cells, attributes=spark.createDataFrame(given, schema))
    assert len(file_attributes(spark, out).inputFiles()) < 4
    # a later run replaces those of its own files that it has some for; others stay
    newer = [("ecmwf", f"a/{k}.nc", "values", "units", "new") for k in (3, 5, 29)]
    run(cells[:4] + cells[5:6], attributes=spark.createDataFrame(newer, schema))
    run(cells[:2])
    found = {r["file"]: r["value"] for r in file_attributes(spark, out).collect()}
    assert found == {f: "new" if f in ("a/3.nc", "a/5.nc") else "old" for f, *_ in cells}
    for _ in range(3):
        run(cells[:1], attributes=spark.createDataFrame(newer, schema))
    assert len([n for n in os.listdir(out) if n.startswith("_attributes")]) == 2
    assert file_attributes(spark, out).count() == 30
    # a set that has a folder for each file, as they were written before
    held = file_attributes(spark, out).collect()
    for name in [n for n in os.listdir(out) if n.startswith("_attributes")]:
        shutil.rmtree(f"{out}/{name}")
    spark.createDataFrame(held).write.partitionBy("dataset", "file").parquet(f"{out}/_attributes")
    with open(f"{out}/_set.json") as record:
        was = {k: v for k, v in json.load(record).items() if k != "attributes"}
    os.remove(f"{out}/._set.json.crc") if os.path.exists(f"{out}/._set.json.crc") else None
    with open(f"{out}/_set.json", "w") as record:
        json.dump(was, record)
    assert sorted(file_attributes(spark, out).collect()) == sorted(held)
    run(cells[5:6], attributes=spark.createDataFrame(given[5:6], schema))
    found = {r["file"]: r["value"] for r in file_attributes(spark, out).collect()}
    assert found == {f: "new" if f == "a/3.nc" else "old" for f, *_ in cells}


def test_files_are_folders_as_spark_names_them(spark, folder):
    """Each file has its own folder, replaced as a whole and only by a job that succeeds;
    Spark's writer, which takes tens of milliseconds for each, wrote none of them."""
    names = ["plain.nc", "a/b=c%d.nc", "sp ace:*?.nc", "x{y}[z]^\\\"'#.nc", "ümläut-\t~.nc", "100%"]
    rows = [(d, f, k, bytes([k % 7]) * k) for k in range(300) for d in ("p", "q/r") for f in names]
    chunks = spark.createDataFrame(rows, "dataset string, file string, n int, payload binary").repartition(5)
    mine, spark_s = replace_files(chunks, folder("m"), BY), folder("s")
    chunks.write.partitionBy(*BY).parquet(spark_s)
    folders = lambda top: {os.path.relpath(d, top) for d, _, files in os.walk(top) if d != top and any(f[:5] == "part-" for f in files)}
    assert folders(mine) == folders(spark_s) and len(folders(mine)) == 12
    assert not any(f.endswith(".crc") for _, _, files in os.walk(mine) for f in files)
    read = lambda top: sorted(tuple(r) for r in spark.read.schema(chunks.schema).parquet(top).select(*chunks.columns).collect())
    assert read(mine) == read(spark_s) == sorted(rows)
    # over what Spark wrote: one file replaced, the others as they were
    later = chunks.where("file = 'plain.nc' and n < 7").withColumn("n", F.col("n") + 1000)
    replace_files(later, spark_s, BY)
    want = [r for r in rows if r[1] != "plain.nc"] + [
        (d, f, n + 1000, p) for d, f, n, p in rows if f == "plain.nc" and n < 7
    ]
    assert read(spark_s) == sorted(want)
    broken = chunks.withColumn("n", F.expr("if(n = 299 and file = '100%', raise_error('broken'), 5)").cast("int"))
    with pytest.raises(Exception, match="broken"):
        replace_files(broken, spark_s, BY)
    assert read(spark_s) == sorted(want)
    assert not any(n.startswith(".staged") for n in os.listdir(spark_s))
    assert replace_files(chunks.limit(0), folder("e"), BY) and read(folder("e")) == []
    nameless = spark.createDataFrame([("p", None, 1, b""), ("p", "", 2, b"")], chunks.schema).repartition(2, "n")
    assert sorted(r[2] for r in spark.read.schema(chunks.schema).parquet(replace_files(nameless, folder("n"), BY)).select(*chunks.columns).collect()) == [1, 2]


def test_folders_are_listed_by_few_tasks(spark, folder):
    spark.range(60).selectExpr("cast(id as string) file", "1 n").write.partitionBy("file").parquet(folder("l"))
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    with few_listers(spark):
        assert int(spark.conf.get(key)) <= 4 * spark.sparkContext.defaultParallelism
        assert spark.read.parquet(folder("l")).count() == 60
    assert spark.conf.get(key) == before


def test_digests_list_files_once(spark, folder):
    os.makedirs(folder("d"))
    for k in range(5):
        with open(f"{folder('d')}/{k}.nc", "w") as file:
            file.write("x" * (k + 1))
    listed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            listed.add(batch.num_rows)
            yield batch

    manifest = scan_files(spark, folder("d")).drop("modified")
    manifest = manifest.mapInArrow(count, manifest.schema)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    rows = file_digests(manifest, block=2).orderBy("length").collect()
    assert [r["length"] for r in rows] == [1, 2, 3, 4, 5]
    assert len({r["digest"] for r in rows}) == 5 and not any(r["unread"] for r in rows)
    assert listed.value == 5
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before

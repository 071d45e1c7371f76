"""Queries that pack, write and read back chunk tables."""

from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridloom.contract import STORE_CODEC
from gridloom.model import Grid
from gridloom.operators.codec import decode_chunks, encode_chunks
from gridloom.operators.reports import compare_storage, storage_stats
from gridloom.operators.selecting import select_day
from gridloom.plans.rechunk import BY, file_attributes, rechunk
from gridloom.plans.store import many_files_store, outer_files_store, single_source_store
from gridloom.queries import inputs as I
from gridloom.session import materialized, scratch_folder
from gridloom.sinks.chunks import write_store
from gridloom.sinks.results import RunFailed, fail_fast, run_summary
from gridloom.sources import store as S
from gridloom.sources.ledger import counted
from gridloom.sources.store import read_array, read_cells, read_chunks, read_labelled

STATION_SPEC = {
    "chunk_map": I.STATION_CHUNK,
    "shard_map": I.STATION_SHARD,
    "fill_value": "nan",
    "fill_value_dtype": "float64",
}
JOINED_SPEC = {
    "chunk_map": I.JOINED_CHUNK,
    "shard_map": I.JOINED_SHARD,
    "fill_value": "nan",
    "fill_value_dtype": "float64",
}


def chunk_pack(spark, sf):
    """One row-major block per chunk: its place, size, and first and last value."""
    cells = I.vectors(spark, sf)
    grid = I.vector_grid(cells)
    chunks = materialized(
        encode_chunks(cells, grid, {"v": "float32"}, codec="none", level=0, shuffle=False)
    )
    at = F.struct("vec_i", "d_i")
    ends = (
        decode_chunks(chunks, grid.dims)
        .withColumn("o_vec", F.col("vec_i") - F.col("vec_i") % I.VECTOR_CHUNK["vec"])
        .withColumn("o_d", F.col("d_i") - F.col("d_i") % I.VECTOR_CHUNK["d"])
        .groupBy("o_vec", "o_d")
        .agg(F.min_by("v", at).alias("first_v"), F.max_by("v", at).alias("last_v"))
    )
    place = chunks.select("o_vec", "o_d", "n_vec", "n_d", "n_present", "raw_bytes")
    return place.join(ends, ["o_vec", "o_d"])


def _round_trip(spark, sf, **codec):
    cells = I.vectors(spark, sf)
    grid = I.vector_grid(cells)
    chunks = encode_chunks(cells, grid, {"v": "float32"}, **codec)
    return decode_chunks(chunks, grid.dims).drop("var")


def encode_zlib(spark, sf):
    return _round_trip(spark, sf, codec="zlib", level=7, shuffle=True)


def encode_zstd(spark, sf):
    return _round_trip(spark, sf, **STORE_CODEC)


def _station_store(spark, sf, **more) -> str:
    cells = I.stations(spark, sf)
    return single_source_store(
        cells,
        I.STATION_DIMS,
        I.station_sizes(spark, sf),
        I.STATION_VARS,
        STATION_SPEC,
        scratch_folder(spark, "stations"),
        **more,
    )


def _station_labels(spark, sf) -> dict:
    """Coordinates of the stations: a date for each day, a name for each station."""
    sizes = I.station_sizes(spark, sf)
    day = F.date_add(F.lit(I.SHIP_START).cast("date"), F.col("id").cast("int"))
    return {
        "time": spark.range(sizes["time"]).select(F.col("id").alias("time_i"), day.alias("day")),
        "station": spark.range(sizes["station"]).select(
            F.col("id").alias("station_i"), F.concat(F.lit("station "), "id").alias("name")
        ),
    }


def shard_write_2d(spark, sf):
    store = _station_store(spark, sf)
    return read_cells(spark, store, I.STATION_DIMS, without_fill=True)


def chunk_store_scan(spark, sf):
    """One variable of the station store, every cell, absent ones as NaN."""
    store = _station_store(spark, sf)
    grid = Grid(I.STATION_DIMS, I.station_sizes(spark, sf), I.STATION_CHUNK, I.STATION_SHARD)
    cells = read_array(spark, store, grid, {"rainfall": float("nan")})
    return cells.select(
        "station_i",
        "time_i",
        F.isnan("v").alias("absent"),
        F.nanvl("v", F.lit(0.0)).alias("v"),
    )


def joined_store(spark, sf, dry_run=False) -> str:
    cells = I.day_files(spark, sf)
    files = I.day_manifest(spark, sf)
    return many_files_store(
        cells,
        files,
        I.GRID_DIMS,
        I.day_sizes(spark, sf),
        {"v": "float64"},
        JOINED_SPEC,
        scratch_folder(spark, "joined"),
        dry_run=dry_run,
    )


def shard_write_4d(spark, sf):
    store = joined_store(spark, sf)
    return read_cells(spark, store, I.GRID_DIMS, without_fill=True).drop("var")


def dry_run_store(spark, sf):
    store = joined_store(spark, sf, dry_run=True)
    return read_cells(spark, store, I.GRID_DIMS, without_fill=True).drop("var")


def _file_grid(spark, sf) -> Grid:
    return Grid(I.GRID_DIMS, I.day_sizes(spark, sf), chunk=I.FILE_CHUNK)


def _day_sizes(spark, sf):
    """Length of time in each day file, written once."""
    dataset = F.lit("ecmwf").alias("dataset")
    return materialized(I.day_manifest(spark, sf).select(dataset, "file", "size_time"))


def _work(sizes):
    return sizes.select(
        *BY,
        F.concat(F.lit("raw/"), "file").alias("in_path"),
        F.concat(F.lit("rechunked/"), "file").alias("out_path"),
    )


def rechunk_write(spark, sf):
    cells = I.day_files(spark, sf).withColumn("dataset", F.lit("ecmwf"))
    sizes = _day_sizes(spark, sf)
    out = scratch_folder(spark, "rechunked")
    rechunk(cells, sizes, _work(sizes), _file_grid(spark, sf), {"v": "float64"}, 7, out)
    read = read_cells(spark, out, I.GRID_DIMS, BY, without_fill=True)
    return read.drop("var", "dataset")


def atomic_replace(spark, sf):
    """All files written; those from the 16th on replaced; then a run in which
    every file is broken, which must change nothing."""
    cells = I.day_files(spark, sf).withColumn("dataset", F.lit("ecmwf"))
    sizes = _day_sizes(spark, sf)
    grid, out = _file_grid(spark, sf), scratch_folder(spark, "replaced")
    work, variables = _work(sizes), {"v": "float64"}
    rechunk(cells, sizes, work, grid, variables, 7, out)
    late = F.col("file") >= "ECMWF/2024/01/16.nc"
    later = cells.filter(late).withColumn("v", F.col("v") + 1000)
    rechunk(later, sizes.filter(late), work.filter(late), grid, variables, 7, out)
    try:
        rechunk(cells.unionByName(cells), sizes, work, grid, variables, 7, out)
    except RunFailed:
        pass
    read = read_cells(spark, out, I.GRID_DIMS, BY, without_fill=True)
    return read.drop("var", "dataset")


def _results(spark, sf):
    """Rechunk the per-minute readings; a file that gives a cell twice fails."""
    cells = I.readings(spark, sf)
    sizes = _day_sizes(spark, sf)
    grid = Grid(
        I.GRID_DIMS,
        I.sizes_of(cells, I.GRID_DIMS[1:]),
        chunk={"time": 7, "step": 60, "latitude": 37, "longitude": 15},
    )
    out = scratch_folder(spark, "checked")
    return rechunk(
        cells, sizes, _work(sizes), grid, {"v": "float64"}, 7, out, stop_on_error=False
    )


def process_results(spark, sf):
    return _results(spark, sf)


def summary(spark, sf):
    return run_summary(_results(spark, sf))


def gate(spark, sf):
    """Whether the run is stopped before publishing, and what it had done."""
    results = materialized(_results(spark, sf))
    try:
        fail_fast(results)
        stopped = False
    except RunFailed:
        stopped = True
    return run_summary(results).withColumn("stopped", F.lit(stopped))


def stats(spark, sf):
    """Storage statistics of the compressed station store, its coordinates among
    them, whose bytes count."""
    store = _station_store(spark, sf, coordinates=_station_labels(spark, sf))
    chunks = read_chunks(spark, store)
    found = storage_stats(chunks, I.STATION_DIMS)
    text = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("shape", "chunks")}
    held = chunks.groupBy(F.col("var").alias("name")).agg(F.sum(F.length("payload")).alias("held"))
    return (
        found.withColumns({**text, "level": F.col("level").cast("bigint")})
        .withColumn("filters", F.array_join("filters", ","))
        .join(held, "name")
        .withColumn("all_counted", F.col("storage") == F.col("held"))
        .select("name", "shape", "chunks", "dtype", "compression", "level", "shuffle", "filters",
                "n_chunks", F.when(F.col("dtype") != "str", F.col("raw_bytes")).alias("raw_bytes"),
                "all_counted")
    )


def chunk_slabs(spark, sf):
    """Chunks larger than what a task packs: stored in slabs, reported as declared."""
    grid = Grid(
        I.STATION_DIMS, I.station_sizes(spark, sf), I.STATION_CHUNK, I.STATION_SHARD
    )
    chunks = encode_chunks(
        I.stations(spark, sf), grid, I.STATION_VARS, max_box_elements=4000, **STORE_CODEC
    )
    store = write_store(chunks, scratch_folder(spark, "slabs"))
    found = storage_stats(read_chunks(spark, store, I.STATION_DIMS), I.STATION_DIMS)
    cells = read_array(spark, store, grid, dict.fromkeys(I.STATION_VARS, float("nan")))
    counted = cells.groupBy(F.col("var").alias("name")).agg(
        F.count("*").alias("n_cells"), F.round(F.sum(F.nanvl("v", F.lit(0.0))), 1).alias("total")
    )
    text = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("shape", "chunks")}
    described = found.withColumns(text).select("name", "shape", "chunks", "n_chunks")
    return described.join(counted, "name")


@contextmanager
def without_markers(spark):
    """Jobs that leave no ``_SUCCESS`` behind, as some committers do."""
    conf, key = spark.sparkContext._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    before = conf.get(key, "true")
    conf.set(key, "false")
    try:
        yield
    finally:
        conf.set(key, before)


def store_replace(spark, sf):
    """A good write, a second one over it, then one that fails: readers keep the
    second. None of them leaves success markers."""
    cells, sizes = I.stations(spark, sf), I.station_sizes(spark, sf)

    def write(given, out):
        return single_source_store(
            given, I.STATION_DIMS, sizes, I.STATION_VARS, STATION_SPEC, out
        )

    with without_markers(spark):
        store = write(cells.where("station_i % 2 = 0"), scratch_folder(spark, "stations"))
        write(cells, store)
        try:
            write(cells.unionByName(cells), store)
        except PySparkException:
            pass
    return read_cells(spark, store, I.STATION_DIMS, without_fill=True)


def store_compare(spark, sf):
    """The same stations written plainly and compressed, compared as stored."""
    grid = Grid(
        I.STATION_DIMS, I.station_sizes(spark, sf), I.STATION_CHUNK, I.STATION_SHARD
    )
    sides = []
    for codec in ({"codec": "none", "level": 0, "shuffle": False}, {"codec": "zlib", "level": 7}):
        chunks = encode_chunks(I.stations(spark, sf), grid, I.STATION_VARS, **codec)
        store = write_store(chunks, scratch_folder(spark, "compared"))
        sides.append(storage_stats(read_chunks(spark, store, I.STATION_DIMS), I.STATION_DIMS))
    compared = compare_storage(*sides, also=("compression", "level", "shuffle", "filters"))
    return compared.select(
        "name",
        F.array_join(F.col("old_chunks").cast("array<string>"), ",").alias("chunks"),
        "old_compression",
        "new_compression",
        F.col("old_level").cast("bigint").alias("old_level"),
        F.col("new_level").cast("bigint").alias("new_level"),
        "old_shuffle",
        "new_shuffle",
        F.array_join("old_filters", ",").alias("old_filters"),
        F.array_join("new_filters", ",").alias("new_filters"),
        (F.col("ratio") < 1).alias("smaller"),
        "flagged",
    )


_DAYS = ("1995-03-10", "1995-03-12")


def store_select_day(spark, sf):
    """Three days of a store, chosen by the date label of its time coordinate."""
    store = _station_store(spark, sf, coordinates=_station_labels(spark, sf))
    first, last = (F.to_date(F.lit(d)) for d in _DAYS)
    cells = read_labelled(spark, store, "time", first, last, ["rainfall"])
    return cells.select("station_i", F.col("label").cast("string").alias("day"), "v")


def store_catalog(spark, sf):
    """What a store holds, told by its path alone."""
    store = _station_store(spark, sf, coordinates=_station_labels(spark, sf))
    found = S.store_catalog(spark, store)
    joined = {c: F.array_join(c, ",") for c in ("dims", "sizes", "chunk", "shard")}
    return found.withColumns(joined).withColumn("level", F.col("level").cast("bigint")).drop("slab")


def store_open(spark, sf):
    """Every cell of every data variable of a store opened by its path alone."""
    cells = read_array(spark, _station_store(spark, sf, coordinates=_station_labels(spark, sf)))
    return cells.select(
        "var", "station_i", "time_i", F.isnan("v").alias("absent"),
        F.nanvl("v", F.lit(0.0)).alias("v"),
    )


def store_mixed_dims(spark, sf):
    """Variables over station and time, over station, and over time, in one store
    and packed behind one shuffle."""
    rows = I.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station_i"),
        F.datediff("l_shipdate", F.lit(I.SHIP_START)).cast("bigint").alias("time_i"),
        "l_tax",
    )
    by_station = rows.groupBy("station_i").agg(F.max("l_tax").alias("tax"))
    by_day = rows.groupBy("time_i").agg(F.count("*").alias("items"))
    spec = STATION_SPEC | {"fill_values": {"items": -1}}
    store = single_source_store(
        I.stations(spark, sf), I.STATION_DIMS, I.station_sizes(spark, sf), I.STATION_VARS, spec,
        scratch_folder(spark, "mixed"), _station_labels(spark, sf),
        others=[
            (by_station, ("station",), {"tax": "float64"}),
            (by_day, ("time",), {"items": "int32"}),
        ],
    )
    return read_cells(spark, store, which="present")


def rechunk_attrs(spark, sf):
    """Attributes after both datasets were rechunked, with the files they describe:
    global ones of the stations are gone."""
    days = _day_sizes(spark, sf)
    out = scratch_folder(spark, "described")
    attributes = I.attributes(spark, sf)
    rechunk(
        I.day_files(spark, sf).withColumn("dataset", F.lit("ecmwf")), days, _work(days),
        _file_grid(spark, sf), {"v": "float64"}, 7, f"{out}/ecmwf", attributes=attributes,
    )
    cells = materialized(I.station_files(spark, sf))  # read for sizes, ledger and chunks
    sizes = materialized(
        cells.groupBy(*BY).agg(
            *[(F.max(f"{d}_i") + 1).alias(f"size_{d}") for d in I.STATION_DIMS]
        )
    )
    rechunk(
        cells, sizes, _work(sizes), Grid(I.STATION_DIMS, chunk={"station": 4, "time": 625}),
        {"v": "float64"}, 7, f"{out}/dpird", attributes=attributes,
    )
    found = [file_attributes(spark, f"{out}/{name}") for name in ("ecmwf", "dpird")]
    return found[0].unionByName(found[1])


def rechunk_coordinates(spark, sf):
    """The hour of each position of the time dim, read back from every file."""
    sizes = _day_sizes(spark, sf)
    hours = sizes.select(*BY, F.explode(F.expr("sequence(0L, size_time - 1)")).alias("time_i"))
    start = F.to_timestamp_ntz(F.substring("file", 7, 10), F.lit("yyyy/MM/dd"))
    hours = hours.withColumn("hour", start + F.make_dt_interval(F.lit(0), F.col("time_i")))
    out = scratch_folder(spark, "timed")
    rechunk(
        I.day_files(spark, sf).withColumn("dataset", F.lit("ecmwf")), sizes, _work(sizes),
        _file_grid(spark, sf), {"v": "float64"}, 7, out, coordinates={"time": hours},
    )
    read = read_cells(spark, out, variables=["time"], kind="timestamp_ntz", which="present")
    return read.select("file", "time_i", F.date_format("v", "yyyy-MM-dd HH:mm").alias("hour"))


def _late():
    return F.col("file") >= "ECMWF/2024/01/16.nc"


def unread_files(spark, sf):
    """All files rechunked; then a run that is given the early ones only, changed,
    though the sizes of all are known: the late ones fail and keep their output."""
    cells = I.day_files(spark, sf).withColumn("dataset", F.lit("ecmwf"))
    sizes, grid = _day_sizes(spark, sf), _file_grid(spark, sf)
    out, variables = scratch_folder(spark, "unread"), {"v": "float64"}
    rechunk(cells, sizes, _work(sizes), grid, variables, 7, out)
    changed = cells.filter(~_late()).withColumn("v", F.col("v") + 1000)
    results = rechunk(
        changed, sizes, _work(sizes), grid, variables, 7, out, stop_on_error=False
    )
    told = results.select(F.substring_index("in_path", "raw/", -1).alias("file"), "ok", "message")
    held = read_cells(spark, out, without_fill=True).groupBy("file")
    return told.join(held.agg(F.min("v").alias("least"), F.count("*").alias("cells")), "file", "left")


def empty_files(spark, sf):
    """Files that a ledger says were read without giving a cell are no failure:
    their output is replaced by empty arrays. Those it does not name fail."""
    cells = I.day_files(spark, sf).withColumn("dataset", F.lit("ecmwf"))
    sizes, grid = _day_sizes(spark, sf), _file_grid(spark, sf)
    out, variables = scratch_folder(spark, "emptied"), {"v": "float64"}
    rechunk(cells, sizes, _work(sizes), grid, variables, 7, out)
    early = cells.filter(~_late())
    last = F.col("file") >= "ECMWF/2024/01/24.nc"
    ledger = counted(early, sizes).withColumn(
        "status", F.when(_late() & ~last, "read").otherwise(F.col("status"))
    )
    results = rechunk(
        early, sizes, _work(sizes), grid, variables, 7, out, stop_on_error=False, ledger=ledger
    )
    told = results.select(F.substring_index("in_path", "raw/", -1).alias("file"), "ok")
    held = read_cells(spark, out, without_fill=True).groupBy("file").agg(F.count("*").alias("n"))
    return told.join(held, "file", "left").select("file", "ok", F.coalesce("n", F.lit(0)).alias("cells"))


def float_range(spark, sf):
    """Doubles of even days are too large for float32: those files fail."""
    wide = F.expr("CASE WHEN day(to_date(substr(file, 7, 10), 'yyyy/MM/dd')) % 2 = 0 THEN 1e39D ELSE 1D END")
    cells = I.day_files(spark, sf).select(
        F.lit("ecmwf").alias("dataset"), "file", *(f"{d}_i" for d in I.GRID_DIMS),
        ((F.abs("v") + 1) * wide).alias("v"),
    )
    sizes = _day_sizes(spark, sf)
    return rechunk(
        cells, sizes, _work(sizes), _file_grid(spark, sf), {"v": "float32"}, 7,
        scratch_folder(spark, "wide"), stop_on_error=False,
    )


def store_present_cells(spark, sf):
    """NaN that was given is read back; positions that were not given are not."""
    odd = F.when(F.col("station_i") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("rainfall"))
    store = single_source_store(
        I.stations(spark, sf).withColumn("rainfall", odd), I.STATION_DIMS,
        I.station_sizes(spark, sf), {"rainfall": "float64"}, STATION_SPEC,
        scratch_folder(spark, "present"),
    )
    cells = read_cells(spark, store, which="present")
    return cells.select(
        "station_i", "time_i", F.isnan("v").alias("is_nan"), F.nanvl("v", F.lit(0.0)).alias("v")
    )


def _grid_store(spark, sf) -> str:
    grid = I.grid_layout(spark, sf)
    spec = JOINED_SPEC | {"chunk_map": I.GRID_CHUNK, "shard_map": I.GRID_SHARD}
    return single_source_store(
        I.grid(spark, sf), grid.dims, grid.sizes, {"v": "float64"}, spec, scratch_folder(spark, "zones")
    )


def chunk_stats_store(spark, sf):
    """Statistics of each chunk as its writer left them; nothing is decoded."""
    found = S.chunk_zones(spark, _grid_store(spark, sf), "v")
    return found.select(*(f"{d}_c" for d in I.GRID_DIMS), "n_cells", "min_v", "max_v", "n_nan")


_RANGE = (95.0, 101.0)


def select_values(spark, sf):
    """Cells of a store within a range of values; chunks outside it stay unread."""
    cells = read_cells(spark, _grid_store(spark, sf), values=_RANGE)
    return cells.drop("var")


def round_trip_text(spark, sf):
    """Text of any length, with a fill of text, over one dim."""
    cells = I.table(spark, sf, "documents").select(
        F.col("doc_id").alias("doc_i"), F.substring("text", 1, 80).alias("head"),
        F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("origin"),
        (F.col("lang") == "en").alias("english"),
    )
    spec = {"chunk_map": {"doc": 64}, "shard_map": {"doc": 256},
            "fill_values": {"origin": "none", "head": "", "english": False}}
    store = single_source_store(
        cells, ("doc",), I.sizes_of(cells, ("doc",)),
        {"head": "str", "origin": "str", "english": "bool"}, spec, scratch_folder(spark, "texts"),
    )
    text = read_array(spark, store, variables=["head", "origin"])
    flags = read_array(spark, store, variables=["english"])
    return text.unionByName(flags.withColumn("v", F.col("v").cast("string")))


def round_trip_time(spark, sf):
    """Times as epoch microseconds and days, absent ones as no time."""
    cells = I.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_i"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate").cast("date")).alias("day"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, o_orderkey % 1000 / 1000)")).alias("at"),
    )
    spec = {"chunk_map": {"order": 500}, "shard_map": {"order": 2000}}
    store = single_source_store(
        cells, ("order",), I.sizes_of(cells, ("order",)),
        {"day": "datetime64[D]", "at": "datetime64[us]"}, spec, scratch_folder(spark, "times"),
    )
    days = read_cells(spark, store, variables=["day"], which="present")
    times = read_cells(spark, store, variables=["at"], which="present")
    return days.withColumn("v", F.col("v").cast("string")).unionByName(
        times.withColumn("v", F.date_format("v", "yyyy-MM-dd HH:mm:ss.SSS"))
    )


def concat_outer(spark, sf):
    """Day files whose hours and users differ, over the union of both."""
    rows = I.table(spark, sf, "events").select(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour"),
        F.concat(F.lit("u"), "user_id").alias("user"), "value",
    )
    cells = rows.groupBy("hour", "user").agg(F.max("value").alias("v"))
    spec = JOINED_SPEC | {"chunk_map": {"time": 96, "user": 50}, "shard_map": {"time": 192}}
    store = outer_files_store(
        cells, {"time": "hour", "user": "user"}, {"v": "float64"}, spec, scratch_folder(spark, "outer")
    )
    hours = S.read_coordinate(spark, store, "time").withColumnRenamed("label", "hour")
    users = S.read_coordinate(spark, store, "user").withColumnRenamed("label", "user")
    found = read_cells(spark, store, which="present").join(hours, "time_i").join(users, "user_i")
    return found.select(
        "time_i", "user_i", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "user", "v"
    )


def _timed_store(spark, sf) -> str:
    """The joined day files with the hour of every position, given per file."""
    manifest = materialized(I.day_manifest(spark, sf))
    hours = manifest.select("file", F.explode(F.expr("sequence(0L, size_time - 1)")).alias("time_i"))
    start = F.to_timestamp_ntz(F.substring("file", 7, 10), F.lit("yyyy/MM/dd"))
    return many_files_store(
        I.day_files(spark, sf), manifest, I.GRID_DIMS, I.day_sizes(spark, sf), {"v": "float64"},
        JOINED_SPEC, scratch_folder(spark, "timed"),
        coordinates={"time": hours.withColumn("hour", start + F.make_dt_interval(F.lit(0), F.col("time_i")))},
        attributes=I.attributes(spark, sf).where("dataset = 'ecmwf'").drop("dataset"),
    )


def joined_day(spark, sf):
    """One day of the store of all day files, by the dates of its coordinate."""
    store = _timed_store(spark, sf)
    bounds = (F.lit(f"2024-01-05 {t}").cast("timestamp_ntz") for t in ("00:00:00", "23:59:59"))
    cells = read_labelled(spark, store, "time", *bounds)
    return cells.select(
        F.date_format("label", "yyyy-MM-dd HH").alias("hour"),
        "step_i", "latitude_i", "longitude_i", "v",
    )


def joined_attrs(spark, sf):
    """The attributes of the first file are those of the joined store."""
    return S.store_table(spark, _timed_store(spark, sf), "attributes")


def select_day_store(spark, sf):
    """A day before the first of a store: decided from the coordinate, and all cells
    are taken, as their labels ascend."""
    store = _timed_store(spark, sf)
    labels = S.read_coordinate(spark, store, "time").withColumnRenamed("label", "time")
    cells, fell_back = select_day(read_cells(spark, store, which="present"), "2023-06-01", labels=labels)
    return cells.agg(F.count("*").alias("cells"), F.max("v").alias("most")).withColumn(
        "fell_back", F.lit(fell_back)
    )


def round_trip_int64(spark, sf):
    """Whole numbers that a double cannot hold."""
    cells = I.vectors(spark, sf).withColumn("v", F.expr("9007199254740993 + vec_i * 64 + d_i"))
    grid = I.vector_grid(cells)
    chunks = encode_chunks(cells, grid, {"v": "int64"}, fill=-1, **STORE_CODEC)
    return decode_chunks(chunks, grid.dims, kind="bigint").drop("var")


QUERIES = {
    "chunk_slabs": (
        chunk_slabs,
        f"""WITH {I.STATIONS},
        n AS (SELECT max(station_i) + 1 AS s, max(time_i) + 1 AS t FROM stations)
        SELECT name, any_value(s || ',' || t) AS shape, '48,625' AS chunks,
            count(DISTINCT (station_i // 48, time_i // 625)) AS n_chunks,
            CAST(any_value(s * t) AS BIGINT) AS n_cells,
            round(sum(CASE name WHEN 'rainfall' THEN rainfall ELSE airTemperature END), 1) AS total
        FROM stations, n, (VALUES ('airTemperature'), ('rainfall')) AS v(name) GROUP BY name""",
    ),
    "store_replace": (
        store_replace,
        f"""WITH {I.STATIONS}
        SELECT 'airTemperature' AS var, station_i, time_i, airTemperature AS v FROM stations
        UNION ALL SELECT 'rainfall', station_i, time_i, rainfall FROM stations""",
    ),
    "store_compare": (
        store_compare,
        """SELECT name, '48,625' AS chunks, 'none' AS old_compression, 'zlib' AS new_compression,
            CAST(0 AS BIGINT) AS old_level, CAST(7 AS BIGINT) AS new_level,
            false AS old_shuffle, true AS new_shuffle, '' AS old_filters,
            'shuffle,zlib:7' AS new_filters, true AS smaller, false AS flagged
        FROM (VALUES ('airTemperature'), ('rainfall')) AS v(name)
        WHERE EXISTS (SELECT 1 FROM lineitem)""",
    ),
    "store_select_day": (
        store_select_day,
        f"""SELECT l_suppkey AS station_i, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
            max(l_quantity) AS v
        FROM lineitem
        WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{_DAYS[0]}' AND DATE '{_DAYS[1]}'
        GROUP BY ALL""",
    ),
    "rechunk_attrs": (
        rechunk_attrs,
        f"""WITH {I.ATTRIBUTES} SELECT * FROM attrs
        WHERE NOT (dataset = 'dpird' AND scope = 'global')""",
    ),
    "rechunk_coordinates": (
        rechunk_coordinates,
        f"""WITH {I.DAY_MANIFEST} SELECT file, time_i,
            replace(file[7:16], '/', '-') || ' ' || lpad(CAST(time_i AS VARCHAR), 2, '0') || ':00' AS hour
        FROM day_manifest, LATERAL (SELECT unnest(range(size_time)) AS time_i)""",
    ),
    "unread_files": (
        unread_files,
        f"""WITH {I.DAY_FILES}, kept AS (SELECT file, file >= 'ECMWF/2024/01/16.nc' AS late,
            min(v) AS least, count(*) AS cells FROM day_files GROUP BY file)
        SELECT file, NOT late AS ok, CASE WHEN late THEN 'raw/' || file || ' failed, it was not read'
              ELSE 'raw/' || file || ' is at rechunked/' || file END AS message,
            least + CASE WHEN late THEN 0 ELSE 1000 END AS least, cells FROM kept""",
    ),
    "empty_files": (
        empty_files,
        f"""WITH {I.DAY_FILES} SELECT file, file < 'ECMWF/2024/01/24.nc' AS ok,
            CASE WHEN file >= 'ECMWF/2024/01/16.nc' AND file < 'ECMWF/2024/01/24.nc' THEN 0
              ELSE count(*) END AS cells
        FROM day_files GROUP BY file""",
    ),
    "float_range": (
        float_range,
        """WITH files AS (SELECT DISTINCT CAST(ts AS DATE) AS day,
            'ECMWF/' || strftime(ts, '%Y/%m/%d') || '.nc' AS file FROM events)
        SELECT 'ecmwf' AS dataset, day(day) % 2 = 1 AS ok, 'raw/' || file AS in_path,
            'rechunked/' || file AS out_path,
            CASE WHEN day(day) % 2 = 0
              THEN 'raw/' || file || ' failed, value out of range for float32'
              ELSE 'raw/' || file || ' is at rechunked/' || file END AS message
        FROM files""",
    ),
    "store_catalog": (
        store_catalog,
        f"""WITH {I.STATIONS},
        n AS (SELECT max(station_i) + 1 AS s, max(time_i) + 1 AS t FROM stations)
        SELECT name, coordinate, dims, sizes, chunk, shard, dtype, fill, 'zstd' AS codec,
            CAST(5 AS BIGINT) AS level, true AS shuffle
        FROM n, LATERAL (VALUES
            ('airTemperature', false, 'station,time', s || ',' || t, '48,625', '96,2500', 'float64', 'nan'),
            ('rainfall', false, 'station,time', s || ',' || t, '48,625', '96,2500', 'float64', 'nan'),
            ('time', true, 'time', CAST(t AS VARCHAR), '625', CAST(t AS VARCHAR), 'datetime64[D]', 'NaT'),
            ('station', true, 'station', CAST(s AS VARCHAR), '48', CAST(s AS VARCHAR), 'str', ''))
          AS v(name, coordinate, dims, sizes, chunk, shard, dtype, fill)""",
    ),
    "store_open": (
        store_open,
        f"""WITH {I.STATIONS},
        n AS (SELECT max(station_i) + 1 AS s, max(time_i) + 1 AS t FROM stations),
        cells AS (SELECT station_i, time_i FROM n,
            LATERAL (SELECT unnest(range(s)) AS station_i),
            LATERAL (SELECT unnest(range(t)) AS time_i))
        SELECT 'rainfall' AS var, station_i, time_i, rainfall IS NULL AS absent, coalesce(rainfall, 0) AS v
        FROM cells LEFT JOIN stations USING (station_i, time_i)
        UNION ALL SELECT 'airTemperature', station_i, time_i, airTemperature IS NULL,
            coalesce(airTemperature, 0)
        FROM cells LEFT JOIN stations USING (station_i, time_i)""",
    ),
    "store_mixed_dims": (
        store_mixed_dims,
        f"""WITH {I.STATIONS}
        SELECT 'airTemperature' AS var, station_i, time_i, airTemperature AS v FROM stations
        UNION ALL SELECT 'rainfall', station_i, time_i, rainfall FROM stations
        UNION ALL SELECT 'tax', l_suppkey, NULL, max(l_tax) FROM lineitem GROUP BY l_suppkey
        UNION ALL SELECT 'items', NULL, date_diff('day', DATE '{I.SHIP_START}', CAST(l_shipdate AS DATE)),
            CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY 3""",
    ),
    "store_present_cells": (
        store_present_cells,
        f"""WITH {I.STATIONS} SELECT station_i, time_i, station_i % 3 = 0 AS is_nan,
            CASE WHEN station_i % 3 = 0 THEN 0 ELSE rainfall END AS v FROM stations""",
    ),
    "chunk_stats_store": (
        chunk_stats_store,
        f"""WITH {I.GRID} SELECT time_i // 7 AS time_c, step_i // 24 AS step_c,
            latitude_i // 4 AS latitude_c, longitude_i // 15 AS longitude_c,
            count(*) AS n_cells, min(v) AS min_v, max(v) AS max_v,
            count(*) FILTER (isnan(v)) AS n_nan
        FROM grid GROUP BY 1, 2, 3, 4""",
    ),
    "select_values": (
        select_values,
        f"""WITH {I.GRID} SELECT time_i, step_i, latitude_i, longitude_i, v FROM grid
        WHERE v BETWEEN {_RANGE[0]} AND {_RANGE[1]}""",
    ),
    "round_trip_text": (
        round_trip_text,
        """WITH every AS (SELECT unnest(range((SELECT max(doc_id) + 1 FROM documents))) AS doc_i),
        held AS (SELECT doc_i, d.* FROM every LEFT JOIN documents d ON d.doc_id = doc_i)
        SELECT 'head' AS var, doc_i, coalesce(text[:80], '') AS v FROM held
        UNION ALL SELECT 'origin', doc_i, coalesce(CASE WHEN doc_id % 3 > 0 THEN source END, 'none') FROM held
        UNION ALL SELECT 'english', doc_i, CASE WHEN lang = 'en' THEN 'true' ELSE 'false' END FROM held""",
    ),
    "round_trip_time": (
        round_trip_time,
        """SELECT 'day' AS var, o_orderkey AS order_i, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS v
        FROM orders WHERE o_orderkey % 5 > 0
        UNION ALL SELECT 'at', o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:')
            || lpad(CAST(o_orderkey % 1000 // 1000 AS VARCHAR), 2, '0') || '.'
            || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') FROM orders""",
    ),
    "concat_outer": (
        concat_outer,
        """WITH cells AS (SELECT date_trunc('hour', ts) AS h, 'u' || user_id AS user, max(value) AS v
            FROM events GROUP BY 1, 2)
        SELECT dense_rank() OVER (ORDER BY h) - 1 AS time_i,
            dense_rank() OVER (ORDER BY user) - 1 AS user_i,
            strftime(h, '%Y-%m-%d %H') AS hour, user, v FROM cells""",
    ),
    "joined_day": (
        joined_day,
        f"""WITH {I.DAY_FILES} SELECT '2024-01-05 ' || lpad(CAST(time_i AS VARCHAR), 2, '0') AS hour,
            step_i, latitude_i, longitude_i, v FROM day_files WHERE file = 'ECMWF/2024/01/05.nc'""",
    ),
    "joined_attrs": (
        joined_attrs,
        f"""WITH {I.ATTRIBUTES} SELECT scope, key, value FROM attrs
        WHERE dataset = 'ecmwf' AND file = (SELECT min(file) FROM attrs WHERE dataset = 'ecmwf')""",
    ),
    "select_day_store": (
        select_day_store,
        f"""WITH {I.DAY_FILES} SELECT count(*) AS cells, max(v) AS most, true AS fell_back
        FROM day_files""",
    ),
    "round_trip_int64": (
        round_trip_int64,
        f"""WITH {I.VECTORS} SELECT vec_i, d_i, 9007199254740993 + vec_i * 64 + d_i AS v
        FROM vectors""",
    ),
    "chunk_pack": (
        chunk_pack,
        f"""WITH {I.VECTORS}, n AS (SELECT max(vec_i) + 1 AS vec, max(d_i) + 1 AS d FROM vectors)
        SELECT vec_i // 96 * 96 AS o_vec, d_i // 16 * 16 AS o_d,
            least(any_value(vec), vec_i // 96 * 96 + 96) - vec_i // 96 * 96 AS n_vec,
            least(any_value(d), d_i // 16 * 16 + 16) - d_i // 16 * 16 AS n_d,
            count(*) AS n_present, n_vec * n_d * 4 AS raw_bytes,
            CAST(arg_min(v, (vec_i, d_i)) AS DOUBLE) AS first_v,
            CAST(arg_max(v, (vec_i, d_i)) AS DOUBLE) AS last_v
        FROM vectors, n GROUP BY vec_i // 96, d_i // 16""",
    ),
    "encode_zlib": (
        encode_zlib,
        f"WITH {I.VECTORS} SELECT vec_i, d_i, CAST(v AS DOUBLE) AS v FROM vectors",
    ),
    "encode_zstd": (
        encode_zstd,
        f"WITH {I.VECTORS} SELECT vec_i, d_i, CAST(v AS DOUBLE) AS v FROM vectors",
    ),
    "shard_write_2d": (
        shard_write_2d,
        f"""WITH {I.STATIONS}
        SELECT 'airTemperature' AS var, station_i, time_i, airTemperature AS v FROM stations
        UNION ALL SELECT 'rainfall', station_i, time_i, rainfall FROM stations""",
    ),
    "chunk_store_scan": (
        chunk_store_scan,
        f"""WITH {I.STATIONS},
        n AS (SELECT max(station_i) + 1 AS s, max(time_i) + 1 AS t FROM stations),
        cells AS (SELECT station_i, time_i FROM n,
            LATERAL (SELECT unnest(range(s)) AS station_i),
            LATERAL (SELECT unnest(range(t)) AS time_i))
        SELECT station_i, time_i, rainfall IS NULL AS absent, coalesce(rainfall, 0) AS v
        FROM cells LEFT JOIN stations USING (station_i, time_i)""",
    ),
    "shard_write_4d": (
        shard_write_4d,
        f"""WITH {I.DAY_FILES}, {I.DAY_MANIFEST},
        placed AS (SELECT file, CAST(coalesce(sum(size_time) OVER (
            ORDER BY string_split(file, '/') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS start FROM day_manifest)
        SELECT start + time_i AS time_i, step_i, latitude_i, longitude_i, v
        FROM day_files JOIN placed USING (file)""",
    ),
    "dry_run_store": (
        dry_run_store,
        f"""WITH {I.DAY_FILES}, {I.DAY_MANIFEST},
        tenth AS (SELECT file FROM day_manifest ORDER BY string_split(file, '/') LIMIT 1 OFFSET 9)
        SELECT time_i, step_i, latitude_i, longitude_i, v
        FROM day_files SEMI JOIN tenth USING (file)""",
    ),
    "rechunk_write": (
        rechunk_write,
        f"""WITH {I.DAY_FILES} SELECT file, time_i, step_i, latitude_i, longitude_i, v
        FROM day_files""",
    ),
    "atomic_replace": (
        atomic_replace,
        f"""WITH {I.DAY_FILES} SELECT file, time_i, step_i, latitude_i, longitude_i,
            v + CASE WHEN file >= 'ECMWF/2024/01/16.nc' THEN 1000 ELSE 0 END AS v
        FROM day_files""",
    ),
    "process_results": (
        process_results,
        """WITH cells AS (SELECT 'ECMWF/' || strftime(ts, '%Y/%m/%d') || '.nc' AS file,
            count(*) AS n FROM events GROUP BY 1, date_trunc('minute', ts), user_id),
        files AS (SELECT file, max(n) > 1 AS bad FROM cells GROUP BY 1)
        SELECT 'ecmwf' AS dataset, NOT bad AS ok, 'raw/' || file AS in_path,
            'rechunked/' || file AS out_path,
            CASE WHEN bad THEN 'raw/' || file || ' failed, duplicate cells'
              ELSE 'raw/' || file || ' is at rechunked/' || file END AS message
        FROM files""",
    ),
    "run_summary": (
        summary,
        """WITH cells AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n
            FROM events GROUP BY 1, date_trunc('minute', ts), user_id),
        files AS (SELECT day, max(n) > 1 AS bad FROM cells GROUP BY 1)
        SELECT 'ecmwf' AS dataset, count(*) AS submitted,
            count(*) FILTER (NOT bad) AS succeeded, count(*) FILTER (bad) AS failed FROM files""",
    ),
    "fail_fast": (
        gate,
        """WITH cells AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n
            FROM events GROUP BY 1, date_trunc('minute', ts), user_id),
        files AS (SELECT day, max(n) > 1 AS bad FROM cells GROUP BY 1)
        SELECT 'ecmwf' AS dataset, count(*) AS submitted,
            count(*) FILTER (NOT bad) AS succeeded, count(*) FILTER (bad) AS failed,
            count(*) FILTER (bad) > 0 AS stopped FROM files""",
    ),
    "storage_stats": (
        stats,
        f"""WITH {I.STATIONS},
        n AS (SELECT max(station_i) + 1 AS s, max(time_i) + 1 AS t FROM stations),
        kept AS (SELECT DISTINCT station_i // 48 * 48 AS os, time_i // 625 * 625 AS ot FROM stations),
        boxes AS (SELECT os, ot, least(s, os + 48) - os AS ns, least(t, ot + 625) - ot AS nt
            FROM kept, n)
        SELECT name, (SELECT s || ',' || t FROM n) AS shape, '48,625' AS chunks, 'float64' AS dtype,
            'zstd' AS compression, CAST(5 AS BIGINT) AS level, true AS shuffle,
            'shuffle,zstd:5' AS filters, count(*) AS n_chunks,
            CAST(sum(ns * nt * 8) AS BIGINT) AS raw_bytes, true AS all_counted
        FROM boxes, (VALUES ('airTemperature'), ('rainfall')) AS v(name) GROUP BY name
        UNION ALL SELECT 'time', CAST(t AS VARCHAR), '625', 'datetime64[D]', 'zstd', 5, true,
            'shuffle,zstd:5', CAST(ceil(t / 625) AS BIGINT), t * 8, true FROM n
        UNION ALL SELECT 'station', CAST(s AS VARCHAR), '48', 'str', 'zstd', 5, true,
            'shuffle,zstd:5', CAST(ceil(s / 48) AS BIGINT), NULL, true FROM n""",
    ),
}

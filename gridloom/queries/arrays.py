"""Queries on cells: scans, concatenation, selection, chunk assignment, fills."""

from pyspark.sql import functions as F

from gridloom.functions.values import cf_decode, resolve_fill_column
from gridloom.model import Grid
from gridloom.operators.chunking import (
    assign_chunks,
    assign_shards,
    chunk_stats,
    nonempty_chunks,
)
from gridloom.operators.codec import dense_cells
from gridloom.operators.selecting import select_day, select_variable
from gridloom.queries import inputs as I
from gridloom.sources.cells import concat, file_offsets, label_positions

CELL = "time_i, step_i, latitude_i, longitude_i"


def array_scan(spark, sf):
    return I.vectors(spark, sf).withColumn("v", F.col("v").cast("double"))


def concat_time(spark, sf):
    cells = I.day_files(spark, sf)
    offsets = file_offsets(I.day_manifest(spark, sf), "time")
    return concat(cells, offsets, "time")


def concat_labels(spark, sf):
    """Stations labelled by name, joined over yearly files with differing stations."""
    cells = (
        I.table(spark, sf, "lineitem")
        .groupBy(
            F.year("l_shipdate").cast("bigint").alias("year"),
            F.concat(F.lit("S"), "l_suppkey").alias("station"),
        )
        .agg(F.max("l_extendedprice").alias("v"))
    )
    return label_positions(cells, "station", "station")


def shard_assign(spark, sf):
    grid = Grid(("vec", "d"), chunk=I.VECTOR_CHUNK, shard=I.VECTOR_SHARD)
    return assign_shards(I.vectors(spark, sf).drop("v"), grid)


def chunk_assign(spark, sf):
    grid = Grid(("vec", "d"), chunk=I.VECTOR_CHUNK)
    return assign_chunks(I.vectors(spark, sf).drop("v"), grid)


def chunk_stats_vectors(spark, sf):
    grid = Grid(("vec", "d"), chunk=I.VECTOR_CHUNK)
    stats = chunk_stats(I.vectors(spark, sf), grid, "v")
    return stats.withColumns({c: F.col(c).cast("double") for c in ("min_v", "max_v")})


def chunk_stats_grid(spark, sf):
    return chunk_stats(I.grid(spark, sf), Grid(I.GRID_DIMS, chunk=I.GRID_CHUNK), "v")


def fill_missing(spark, sf):
    layout = I.grid_layout(spark, sf)
    return dense_cells(I.grid(spark, sf), layout, {"v": "float64"}).drop("var")


def fill_missing_int(spark, sf):
    """Whole numbers, absent ones as -9."""
    layout = I.grid_layout(spark, sf)
    cells = I.grid(spark, sf).withColumn("v", F.floor("v").cast("int"))
    filled = dense_cells(cells, layout, {"v": "int32"}, fill={"v": -9}).drop("var")
    return filled.withColumn("v", F.col("v").cast("bigint"))


def drop_empty_chunks(spark, sf):
    sizes = I.grid_layout(spark, sf).sizes
    fine = Grid(I.GRID_DIMS, sizes, {"time": 1, "step": 2, "latitude": 2, "longitude": 5})
    return nonempty_chunks(I.grid(spark, sf), fine, "v")


def variable(spark, sf):
    return select_variable(I.stations(spark, sf), I.STATION_DIMS, "airTemperature")


def decoded(spark, sf):
    events = I.table(spark, sf, "events")
    raw = (
        F.when(F.col("event_type") == "error", -32768)
        .otherwise(F.floor(F.col("value") * 10))
        .cast("int")
    )
    packed = events.select("event_id", raw.alias("raw"))
    return packed.select(
        "event_id",
        cf_decode(F.col("raw"), -32768, 0.1, 2.5).alias("decoded"),
        cf_decode(F.col("raw"), -32768, 0.1, 2.5, decode=False).cast("bigint").alias("stored"),
    )


def _timed(spark, sf):
    """Events labelled by time; a position is an hour."""
    position = F.datediff("ts", F.lit(I.START)) * 24 + F.hour("ts")
    return I.table(spark, sf, "events").select(
        "event_id",
        position.cast("bigint").alias("time_i"),
        F.col("ts").alias("time"),
        F.col("value").alias("v"),
    )


def day_hit(spark, sf):
    cells, fell_back = select_day(_timed(spark, sf), "2024-01-06")
    return cells.drop("time").withColumn("fell_back", F.lit(fell_back))


def day_outside(spark, sf):
    cells, fell_back = select_day(_timed(spark, sf), "2024-03-01")
    return cells.drop("time").withColumn("fell_back", F.lit(fell_back))


def day_gap(spark, sf):
    with_gap = _timed(spark, sf).filter(F.to_date("time") != F.lit("2024-01-06").cast("date"))
    cells, fell_back = select_day(with_gap, "2024-01-06")
    return cells.agg(F.count(F.lit(1)).alias("n_cells")).withColumn("fell_back", F.lit(fell_back))


def fills(spark, sf):
    """Fill values given as text, one per event, resolved for four dtypes."""
    events = I.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "click", "nan").otherwise(F.col("value").cast("string"))
    whole = F.floor("value").cast("string")
    return events.select(
        "event_id",
        resolve_fill_column(text, "float64").alias("fill_f64"),
        resolve_fill_column(text, "float32").cast("double").alias("fill_f32"),
        resolve_fill_column(whole, "int").alias("fill_int"),
        resolve_fill_column(F.col("event_type"), "str", F.lit(True)).alias("fill_str"),
    )


_TIMED = f"""timed AS (
  SELECT event_id, date_diff('day', DATE '{I.START}', CAST(ts AS DATE)) * 24 + hour(ts) AS time_i,
         ts AS time, value AS v
  FROM events)"""

QUERIES = {
    "array_scan": (
        array_scan,
        f"WITH {I.VECTORS} SELECT vec_i, d_i, CAST(v AS DOUBLE) AS v FROM vectors",
    ),
    "concat_time": (
        concat_time,
        f"""WITH {I.DAY_FILES}, {I.DAY_MANIFEST},
        placed AS (SELECT file, CAST(coalesce(sum(size_time) OVER (
            ORDER BY string_split(file, '/') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS start FROM day_manifest)
        SELECT file, start + time_i AS time_i, step_i, latitude_i, longitude_i, v
        FROM day_files JOIN placed USING (file)""",
    ),
    "concat_labels": (
        concat_labels,
        """WITH cells AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS year,
            'S' || l_suppkey AS station, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
        labels AS (SELECT station, row_number() OVER (ORDER BY station) - 1 AS station_i
            FROM (SELECT DISTINCT station FROM cells))
        SELECT station, year, v, station_i FROM cells JOIN labels USING (station)""",
    ),
    "chunk_assign": (
        chunk_assign,
        f"WITH {I.VECTORS} SELECT vec_i, d_i, vec_i // 96 AS vec_c, d_i // 16 AS d_c FROM vectors",
    ),
    "shard_assign": (
        shard_assign,
        f"""WITH {I.VECTORS} SELECT vec_i, d_i, vec_i // 192 AS vec_s,
            (vec_i % 192) // 96 AS vec_inner, d_i // 16 AS d_s, (d_i % 16) // 16 AS d_inner
        FROM vectors""",
    ),
    "chunk_stats": (
        chunk_stats_grid,
        f"""WITH {I.GRID} SELECT time_i // 7 AS time_c, step_i // 24 AS step_c,
            latitude_i // 4 AS latitude_c, longitude_i // 15 AS longitude_c,
            count(*) AS n_cells, min(v) AS min_v, max(v) AS max_v,
            count(*) FILTER (isnan(v)) AS n_nan
        FROM grid GROUP BY 1, 2, 3, 4""",
    ),
    "chunk_stats_dense": (
        chunk_stats_vectors,
        f"""WITH {I.VECTORS} SELECT vec_i // 96 AS vec_c, d_i // 16 AS d_c, count(*) AS n_cells,
            CAST(min(v) AS DOUBLE) AS min_v, CAST(max(v) AS DOUBLE) AS max_v,
            count(*) FILTER (isnan(v)) AS n_nan
        FROM vectors GROUP BY 1, 2""",
    ),
    "fill_missing": (
        fill_missing,
        f"""WITH {I.GRID},
        n AS (SELECT max(time_i) + 1 AS t, max(step_i) + 1 AS s, max(latitude_i) + 1 AS a,
            max(longitude_i) + 1 AS o FROM grid),
        index AS (SELECT time_i, step_i, latitude_i, longitude_i FROM n,
            LATERAL (SELECT unnest(range(t)) AS time_i),
            LATERAL (SELECT unnest(range(s)) AS step_i),
            LATERAL (SELECT unnest(range(a)) AS latitude_i),
            LATERAL (SELECT unnest(range(o)) AS longitude_i))
        SELECT {CELL}, coalesce(v, CAST('nan' AS DOUBLE)) AS v
        FROM index LEFT JOIN grid USING ({CELL})""",
    ),
    "fill_missing_int": (
        fill_missing_int,
        f"""WITH {I.GRID},
        n AS (SELECT max(time_i) + 1 AS t, max(step_i) + 1 AS s, max(latitude_i) + 1 AS a,
            max(longitude_i) + 1 AS o FROM grid),
        index AS (SELECT time_i, step_i, latitude_i, longitude_i FROM n,
            LATERAL (SELECT unnest(range(t)) AS time_i),
            LATERAL (SELECT unnest(range(s)) AS step_i),
            LATERAL (SELECT unnest(range(a)) AS latitude_i),
            LATERAL (SELECT unnest(range(o)) AS longitude_i))
        SELECT {CELL}, coalesce(CAST(floor(v) AS BIGINT), -9) AS v
        FROM index LEFT JOIN grid USING ({CELL})""",
    ),
    "drop_empty_chunks": (
        drop_empty_chunks,
        f"""WITH {I.GRID},
        n AS (SELECT max(time_i) + 1 AS t, max(step_i) + 1 AS s, max(latitude_i) + 1 AS a,
            max(longitude_i) + 1 AS o FROM grid),
        kept AS (SELECT DISTINCT time_i AS time_c, step_i // 2 AS step_c,
            latitude_i // 2 AS latitude_c, longitude_i // 5 AS longitude_c FROM grid)
        SELECT kept.*, (least(s, step_c * 2 + 2) - step_c * 2)
            * (least(a, latitude_c * 2 + 2) - latitude_c * 2)
            * (least(o, longitude_c * 5 + 5) - longitude_c * 5) AS n_cells
        FROM kept, n""",
    ),
    "select_variable": (
        variable,
        f"WITH {I.STATIONS} SELECT station_i, time_i, airTemperature FROM stations",
    ),
    "cf_decode": (
        decoded,
        """WITH packed AS (SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN -32768
            ELSE floor(value * 10) END AS INTEGER) AS raw FROM events)
        SELECT event_id, CASE WHEN raw = -32768 THEN CAST('nan' AS DOUBLE)
            ELSE raw * CAST(0.1 AS DOUBLE) + CAST(2.5 AS DOUBLE) END AS decoded,
            CAST(raw AS BIGINT) AS stored FROM packed""",
    ),
    "select_day": (
        day_hit,
        f"""WITH {_TIMED} SELECT event_id, time_i, v, false AS fell_back FROM timed
        WHERE time >= TIMESTAMP '2024-01-06' AND time < TIMESTAMP '2024-01-07'""",
    ),
    "select_day_outside": (
        day_outside,
        f"WITH {_TIMED} SELECT event_id, time_i, v, true AS fell_back FROM timed",
    ),
    "select_day_gap": (
        day_gap,
        f"""WITH {_TIMED} SELECT count(*) AS n_cells, false AS fell_back FROM timed
        WHERE CAST(time AS DATE) <> DATE '2024-01-06'
          AND time >= TIMESTAMP '2024-01-06' AND time < TIMESTAMP '2024-01-07'""",
    ),
    "resolve_fill": (
        fills,
        """SELECT event_id,
            CASE WHEN event_type = 'click' THEN CAST('nan' AS DOUBLE) ELSE value END AS fill_f64,
            CAST(CAST(CASE WHEN event_type = 'click' THEN CAST('nan' AS DOUBLE) ELSE value END
                AS FLOAT) AS DOUBLE) AS fill_f32,
            CAST(floor(value) AS BIGINT) AS fill_int, event_type AS fill_str
        FROM events""",
    ),
}

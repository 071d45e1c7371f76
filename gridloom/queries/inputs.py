"""Arrays, catalogs and manifests read from the given tables, and their SQL.

``vectors``   embeddings as a dense 2-D array
``grid``      events as a sparse 4-D array (day, hour, user row, user column)
``day_files`` events as one 4-D array per day file
``readings``  the same per minute, repeats kept
``stations``  line items as a station x day array with two variables
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.model import Grid
from gridloom.sources.cells import explode_array

START = "2024-01-01"
SHIP_START = "1995-01-01"

VECTOR_CHUNK = {"vec": 96, "d": 16}
VECTOR_SHARD = {"vec": 192, "d": 16}
GRID_DIMS = ("time", "step", "latitude", "longitude")
GRID_CHUNK = {"time": 7, "step": 24, "latitude": 4, "longitude": 15}
GRID_SHARD = {"time": 14, "step": 24, "latitude": 4, "longitude": 15}
FILE_CHUNK = {"time": 7, "step": 4, "latitude": 37, "longitude": 15}
JOINED_CHUNK = {"time": 48, "step": 4, "latitude": 20, "longitude": 15}
JOINED_SHARD = {"time": 240, "step": 4, "latitude": 20, "longitude": 15}
STATION_DIMS = ("station", "time")
STATION_CHUNK = {"station": 48, "time": 625}
STATION_SHARD = {"station": 96, "time": 2500}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sizes_of(rows: DataFrame, dims) -> dict[str, int]:
    """Dim lengths, where no file header states them: partial maxima of the
    positions, without grouping the rows to cells first."""
    row = rows.agg(*[(F.max(f"{d}_i") + 1).alias(d) for d in dims]).first()
    return {d: int(row[d]) for d in dims}


def vectors(spark, sf) -> DataFrame:
    return explode_array(table(spark, sf, "embeddings"), "vec_id", "embedding", ("vec", "d"))


VECTORS = """vectors AS (
  SELECT vec_id AS vec_i, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS d_i,
         unnest(embedding) AS v
  FROM embeddings)"""


def vector_grid(cells: DataFrame) -> Grid:
    return Grid(("vec", "d"), sizes_of(cells, ("vec", "d")), VECTOR_CHUNK, VECTOR_SHARD)


def _user_cell() -> list:
    return [
        F.expr("user_id div 15").alias("latitude_i"),
        (F.col("user_id") % 15).alias("longitude_i"),
    ]


def _day():
    return F.to_date("ts").alias("day")


def _day_path():
    """File of a day; rows are grouped by the day itself, which is the shorter key."""
    path = F.concat(F.lit("ECMWF/"), F.date_format("day", "yyyy/MM/dd"), F.lit(".nc"))
    return path.alias("file")


def _station_path():
    return F.concat(F.lit("DPIRD/"), "l_suppkey", F.lit(".nc")).alias("file")


def grid_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.datediff("ts", F.lit(START)).cast("bigint").alias("time_i"),
        F.hour("ts").cast("bigint").alias("step_i"),
        *_user_cell(),
        F.col("value").alias("v"),
    )


def grid(spark, sf) -> DataFrame:
    rows = grid_rows(spark, sf)
    return rows.groupBy(*(f"{d}_i" for d in GRID_DIMS)).agg(F.max("v").alias("v"))


def grid_layout(spark, sf) -> Grid:
    return Grid(GRID_DIMS, sizes_of(grid_rows(spark, sf), GRID_DIMS), GRID_CHUNK, GRID_SHARD)


GRID = f"""grid AS (
  SELECT date_diff('day', DATE '{START}', CAST(ts AS DATE)) AS time_i,
         CAST(hour(ts) AS BIGINT) AS step_i,
         user_id // 15 AS latitude_i, user_id % 15 AS longitude_i, max(value) AS v
  FROM events GROUP BY ALL)"""


def day_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        _day(),
        F.hour("ts").cast("bigint").alias("time_i"),
        F.expr("minute(ts) div 15").cast("bigint").alias("step_i"),
        *_user_cell(),
        F.col("value").alias("v"),
    )


def day_files(spark, sf) -> DataFrame:
    keys = [f"{d}_i" for d in GRID_DIMS]
    cells = day_rows(spark, sf).groupBy("day", *keys).agg(F.max("v").alias("v"))
    return cells.select(_day_path(), *keys, "v")


def day_sizes(spark, sf) -> dict[str, int]:
    """Lengths of the dims that all day files share."""
    return sizes_of(day_rows(spark, sf), GRID_DIMS[1:])


DAY_FILES = """day_files AS (
  SELECT 'ECMWF/' || strftime(ts, '%Y/%m/%d') || '.nc' AS file,
         CAST(hour(ts) AS BIGINT) AS time_i, CAST(minute(ts) // 15 AS BIGINT) AS step_i,
         user_id // 15 AS latitude_i, user_id % 15 AS longitude_i, max(value) AS v
  FROM events GROUP BY ALL)"""


def readings(spark, sf) -> DataFrame:
    return table(spark, sf, "events").withColumn("day", _day()).select(
        F.lit("ecmwf").alias("dataset"),
        _day_path(),
        F.hour("ts").cast("bigint").alias("time_i"),
        F.minute("ts").cast("bigint").alias("step_i"),
        *_user_cell(),
        F.col("value").alias("v"),
    )


def station_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station_i"),
        F.datediff("l_shipdate", F.lit(SHIP_START)).cast("bigint").alias("time_i"),
        F.col("l_extendedprice").alias("airTemperature"),
        F.col("l_quantity").alias("rainfall"),
    )


def stations(spark, sf) -> DataFrame:
    rows = station_rows(spark, sf)
    return rows.groupBy("station_i", "time_i").agg(
        *[F.max(v).alias(v) for v in ("airTemperature", "rainfall")]
    )


def station_files(spark, sf) -> DataFrame:
    """Line items as one line x day array per supplier."""
    keys = ["dataset", "file", "station_i", "time_i"]
    rows = table(spark, sf, "lineitem").select(
        F.lit("dpird").alias("dataset"),
        _station_path(),
        (F.col("l_linenumber") - 1).cast("bigint").alias("station_i"),
        F.datediff("l_shipdate", F.lit(SHIP_START)).cast("bigint").alias("time_i"),
        F.col("l_quantity").alias("v"),
    )
    return rows.groupBy(*keys).agg(F.max("v").alias("v"))


def station_sizes(spark, sf) -> dict[str, int]:
    return sizes_of(station_rows(spark, sf), STATION_DIMS)


STATIONS = f"""stations AS (
  SELECT l_suppkey AS station_i,
         date_diff('day', DATE '{SHIP_START}', CAST(l_shipdate AS DATE)) AS time_i,
         max(l_extendedprice) AS airTemperature, max(l_quantity) AS rainfall
  FROM lineitem GROUP BY ALL)"""

STATION_VARS = {"airTemperature": "float64", "rainfall": "float64"}


def _catalog_rows(files: DataFrame, dataset: str, var: str, dtype: str, dims) -> DataFrame:
    """A data variable over ``dims`` and one coordinate per dim, per file."""

    def row(name, kind, is_coord, dim, pos):
        return F.struct(
            F.lit(name).alias("var"),
            F.lit(kind).alias("dtype"),
            F.lit(is_coord).alias("is_coord"),
            F.lit(dim).alias("dim"),
            F.lit(pos).alias("dim_pos"),
            F.col(dim).alias("dim_size"),
        )

    rows = [row(var, dtype, False, d, k) for k, d in enumerate(dims)]
    rows += [row(d, "int64", True, d, 0) for d in dims]
    return files.select(
        F.lit(dataset).alias("dataset"), "file", F.explode(F.array(*rows)).alias("r")
    ).select("dataset", "file", "r.*")


def catalog(spark, sf) -> DataFrame:
    """Dims of every array: one grid file per event day, one station file per supplier."""
    days = (
        table(spark, sf, "events")
        .groupBy(_day())
        .agg(
            (F.max(F.hour("ts")) + 1).cast("bigint").alias("time"),
            (F.max(F.minute("ts")) + 1).cast("bigint").alias("step"),
            F.max(F.expr("user_id div 15 + 1")).alias("latitude"),
            (F.max(F.col("user_id") % 15) + 1).alias("longitude"),
        )
        .withColumn("file", _day_path())
    )
    suppliers = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.max("l_linenumber").cast("bigint").alias("station"),
            (F.max(F.datediff("l_shipdate", F.lit(SHIP_START))) + 1).cast("bigint").alias("time"),
        )
        .withColumn("file", _station_path())
    )
    return _catalog_rows(days, "ecmwf", "t2m", "float32", GRID_DIMS).unionByName(
        _catalog_rows(suppliers, "dpird", "airTemperature", "float64", STATION_DIMS)
    )


def _catalog_sql(source, dataset, var, dtype, dims) -> list[str]:
    rows = [f"('{var}', '{dtype}', false, '{d}', {k}, {d})" for k, d in enumerate(dims)]
    rows += [f"('{d}', 'int64', true, '{d}', 0, {d})" for d in dims]
    return [
        f"""SELECT '{dataset}' AS dataset, file, r.*
    FROM {source}, LATERAL (VALUES {', '.join(rows)})
      AS r(var, dtype, is_coord, dim, dim_pos, dim_size)"""
    ]


CATALOG = f"""days AS (
  SELECT 'ECMWF/' || strftime(ts, '%Y/%m/%d') || '.nc' AS file,
         CAST(max(hour(ts)) + 1 AS BIGINT) AS time, CAST(max(minute(ts)) + 1 AS BIGINT) AS step,
         max(user_id // 15) + 1 AS latitude, max(user_id % 15) + 1 AS longitude
  FROM events GROUP BY 1),
suppliers AS (
  SELECT 'DPIRD/' || l_suppkey || '.nc' AS file, CAST(max(l_linenumber) AS BIGINT) AS station,
         max(date_diff('day', DATE '{SHIP_START}', CAST(l_shipdate AS DATE))) + 1 AS time
  FROM lineitem GROUP BY 1),
catalog AS (
  {_catalog_sql("days", "ecmwf", "t2m", "float32", GRID_DIMS)[0]}
  UNION ALL
  {_catalog_sql("suppliers", "dpird", "airTemperature", "float64", STATION_DIMS)[0]})"""


def attributes(spark, sf) -> DataFrame:
    """Dataset-level and variable-level attributes of every file."""
    days = (
        table(spark, sf, "events")
        .groupBy(_day())
        .agg(F.min("event_type").alias("source"), F.max("event_type").alias("units"))
        .select(F.lit("ecmwf").alias("dataset"), _day_path(), "source", "units")
    )
    suppliers = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.min("l_returnflag").alias("source"), F.max("l_linestatus").alias("units"))
        .select(F.lit("dpird").alias("dataset"), _station_path(), "source", "units")
    )
    rows = days.unionByName(suppliers)
    return rows.selectExpr(
        "dataset",
        "file",
        "stack(2, 'global', 'source', source, 'values', 'units', units) as (scope, key, value)",
    )


ATTRIBUTES = """described AS (
  SELECT 'ecmwf' AS dataset, 'ECMWF/' || strftime(ts, '%Y/%m/%d') || '.nc' AS file,
         min(event_type) AS source, max(event_type) AS units FROM events GROUP BY ALL
  UNION ALL
  SELECT 'dpird', 'DPIRD/' || l_suppkey || '.nc', min(l_returnflag), max(l_linestatus)
  FROM lineitem GROUP BY ALL),
attrs AS (
  SELECT dataset, file, 'global' AS scope, 'source' AS key, source AS value FROM described
  UNION ALL SELECT dataset, file, 'values', 'units', units FROM described)"""


def old_stats(spark, sf) -> DataFrame:
    """Storage statistics of one array per part, from its line items."""
    lengths = F.array(F.max("l_linenumber").cast("bigint"))
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.when(F.max("l_discount") < 0.1, 0)
            .otherwise(F.sum("l_quantity"))
            .cast("bigint")
            .alias("storage"),
            F.when(F.min("l_linenumber") == 1, lengths).alias("chunks"),
            F.array(F.count(F.lit(1)), F.max("l_linenumber").cast("bigint")).alias("shape"),
            F.when(F.max("l_tax") > 0.07, "float64").otherwise("float32").alias("dtype"),
        )
        .select(
            F.concat(F.lit("part_"), "l_partkey").alias("name"),
            "storage",
            "chunks",
            "shape",
            "dtype",
        )
    )


def new_stats(spark, sf) -> DataFrame:
    """Statistics of the same arrays after conversion, from the part table."""
    extra = F.when(F.col("p_brand") == "Brand#7", "extra_").otherwise("part_")
    return table(spark, sf, "part").select(
        F.concat(extra, "p_partkey").alias("name"),
        (F.col("p_size") * 25).cast("bigint").alias("storage"),
        F.when(F.col("p_type") == "LARGE", None)
        .when(F.col("p_type") == "ECONOMY", F.array(F.lit(7).cast("bigint")))
        .otherwise(F.array(F.lit(6).cast("bigint")))
        .alias("chunks"),
        F.when(F.col("p_size") > 45, "float32").otherwise("float64").alias("dtype"),
    )


STATS = """old_stats AS (
  SELECT 'part_' || l_partkey AS name,
         CAST(CASE WHEN max(l_discount) < 0.1 THEN 0 ELSE sum(l_quantity) END AS BIGINT) AS storage,
         CASE WHEN min(l_linenumber) = 1 THEN [CAST(max(l_linenumber) AS BIGINT)] END AS chunks,
         [count(*), CAST(max(l_linenumber) AS BIGINT)] AS shape,
         CASE WHEN max(l_tax) > 0.07 THEN 'float64' ELSE 'float32' END AS dtype
  FROM lineitem GROUP BY 1),
new_stats AS (
  SELECT CASE WHEN p_brand = 'Brand#7' THEN 'extra_' ELSE 'part_' END || p_partkey AS name,
         CAST(p_size * 25 AS BIGINT) AS storage,
         CASE WHEN p_type = 'LARGE' THEN NULL
              WHEN p_type = 'ECONOMY' THEN [CAST(7 AS BIGINT)] ELSE [CAST(6 AS BIGINT)] END AS chunks,
         CASE WHEN p_size > 45 THEN 'float32' ELSE 'float64' END AS dtype
  FROM part)"""


def order_files(spark, sf) -> DataFrame:
    """A manifest with one file per order, in three folders by order status."""
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    status = F.col("o_orderstatus")
    name = (
        F.when(status == "O", F.concat(F.lit("ECMWF/"), day, F.lit("/"), "o_orderkey", F.lit(".nc")))
        .when(status == "F", F.concat(F.lit("DPIRD/"), "o_orderkey", F.lit(".nc")))
        .otherwise(F.concat(F.lit("notes/"), "o_orderkey", F.lit(".txt")))
    )
    return table(spark, sf, "orders").select(
        F.concat(F.lit("/data/raw/"), name).alias("path"),
        name.alias("rel_path"),
        F.floor("o_totalprice").alias("length"),
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
        "o_orderkey",
    )


ORDER_FILES = """order_files AS (
  SELECT '/data/raw/' || rel_path AS path, * FROM (
    SELECT CASE o_orderstatus
             WHEN 'O' THEN 'ECMWF/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || o_orderkey || '.nc'
             WHEN 'F' THEN 'DPIRD/' || o_orderkey || '.nc'
             ELSE 'notes/' || o_orderkey || '.txt' END AS rel_path,
           CAST(floor(o_totalprice) AS BIGINT) AS length,
           o_orderstatus, o_orderpriority, o_orderdate, o_orderkey
    FROM orders))"""


def day_manifest(spark, sf) -> DataFrame:
    """One row per event day file: its rows and its hours."""
    return (
        table(spark, sf, "events")
        .groupBy(_day())
        .agg(
            F.count(F.lit(1)).alias("length"),
            (F.max(F.hour("ts")) + 1).cast("bigint").alias("size_time"),
        )
        .select(_day_path(), "length", "size_time")
    )


DAY_MANIFEST = """day_manifest AS (
  SELECT 'ECMWF/' || strftime(ts, '%Y/%m/%d') || '.nc' AS file, count(*) AS length,
         CAST(max(hour(ts)) + 1 AS BIGINT) AS size_time
  FROM events GROUP BY 1)"""

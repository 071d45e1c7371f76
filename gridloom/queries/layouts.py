"""Queries on catalogs, attributes, layout plans and storage reports."""

from pyspark.sql import functions as F

from gridloom.contract import DATASETS, STORE_CODEC, contract_table
from gridloom.functions.values import nan
from gridloom.operators import reports
from gridloom.operators.layout import plan_rechunk, plan_store, uneven_shards
from gridloom.operators.selecting import data_vars_only, strip_global_attrs
from gridloom.queries import inputs as I


def _text(lengths):
    return F.array_join(F.transform(lengths, lambda n: n.cast("string")), ",")


def contract(spark, sf):
    """Contract rows with the number of arrays of the catalog each applies to."""
    used = (
        data_vars_only(I.catalog(spark, sf))
        .groupBy("dataset", "dim")
        .agg(F.count(F.lit(1)).alias("n_arrays"), F.max("dim_size").alias("longest"))
    )
    return contract_table(spark).join(used, ["dataset", "dim"], "left")


def rechunk_plan(spark, sf):
    plan = plan_rechunk(I.catalog(spark, sf), contract_table(spark), level=7)
    texts = {c: _text(F.col(c)) for c in ("shape", "chunksizes")}
    return plan.withColumns({**texts, "complevel": F.col("complevel").cast("bigint")})


def _store_plan(spark, sf, datasets=DATASETS):
    return plan_store(I.catalog(spark, sf), contract_table(spark, datasets), nan(), STORE_CODEC)


def store_plan(spark, sf):
    return _store_plan(spark, sf).select(
        "dataset",
        "file",
        "var",
        _text(F.col("chunks")).alias("chunks"),
        _text(F.col("shards")).alias("shards"),
        F.col("compressor.codec").alias("codec"),
        F.col("compressor.level").cast("bigint").alias("level"),
        F.col("compressor.shuffle").alias("shuffle"),
        F.isnan("fill_value").alias("fill_is_nan"),
    )


def layout_check(spark, sf):
    """Chunks of 5 along time do not fit shards of 24; latitude takes whole dims."""
    uneven = {
        "ecmwf": {"store": {"chunk_map": {"time": 5, "step": 7}, "shard_map": {"time": 24}}},
        "dpird": {"store": {"chunk_map": {"station": 2, "time": 25}, "shard_map": {"time": 500}}},
    }
    found = uneven_shards(_store_plan(spark, sf, uneven))
    return found.withColumn("dim_pos", F.col("dim_pos").cast("bigint"))


def data_vars(spark, sf):
    wide = data_vars_only(I.catalog(spark, sf))
    return wide.withColumn("dim_pos", F.col("dim_pos").cast("bigint"))


def stripped(spark, sf):
    return strip_global_attrs(I.attributes(spark, sf))


def _entries(stats):
    """Encoding entries (var, key, value) of storage statistics; nulls give no entry."""
    rows = stats.select(
        F.col("name").alias("var"),
        F.explode(
            F.array(
                F.struct(F.lit("dtype").alias("key"), F.col("dtype").alias("value")),
                F.struct(F.lit("chunks").alias("key"), _text(F.col("chunks")).alias("value")),
            )
        ).alias("e"),
    )
    return rows.select("var", "e.key", "e.value").filter(F.col("value").isNotNull())


def encoding_diff(spark, sf):
    return reports.encoding_diff(
        _entries(I.old_stats(spark, sf)), _entries(I.new_stats(spark, sf))
    )


def _compared(spark, sf):
    return reports.compare_storage(I.old_stats(spark, sf), I.new_stats(spark, sf))


def storage_compare(spark, sf):
    return _compared(spark, sf).withColumns(
        {c: _text(F.col(c)) for c in ("old_chunks", "new_chunks")}
    )


def flag_top_n(spark, sf):
    return reports.flagged_first(_compared(spark, sf)).select("name", "ratio")


def flag_count(spark, sf):
    return reports.flag_count(_compared(spark, sf))


def common_arrays(spark, sf):
    return reports.common_arrays(I.old_stats(spark, sf), I.new_stats(spark, sf))


def storage_totals(spark, sf):
    return reports.storage_totals(I.old_stats(spark, sf), I.new_stats(spark, sf))


def chunk_size_mb(spark, sf):
    """Stored chunk shape of some parts, in-memory chunks of others, else the shape."""
    arrays = I.old_stats(spark, sf)
    n = F.col("shape")[0]
    memory = F.when(
        F.col("dtype") == "float64", F.array(F.array(n - 1, F.lit(1)), F.array(F.col("shape")[1]))
    )
    encoded = F.when(F.col("storage") > 800, F.array(n, F.lit(3).cast("bigint")))
    stored_as = F.when(F.col("storage") > 700, "int16")
    sized = reports.chunk_size_mb(arrays, encoded, memory, F.col("shape"), stored_as, F.col("dtype"))
    return sized.select("name", _text(F.col("chunk_shape")).alias("chunk_shape"), "size_dtype", "mb")


def before_after(spark, sf):
    """Chunk size of every array before rechunking (whole array) and after (planned)."""
    plan = plan_rechunk(I.catalog(spark, sf), contract_table(spark), level=7)

    def sized(encoded):
        out = reports.chunk_size_mb(
            plan,
            encoded,
            F.lit(None).cast("array<array<bigint>>"),
            F.col("shape"),
            F.lit(None).cast("string"),
            F.col("dtype"),
        )
        return out.select("file", "var", _text(F.col("chunk_shape")).alias("chunk_shape"), "mb")

    return reports.before_after(
        sized(F.lit(None).cast("array<bigint>")), sized(F.col("chunksizes"))
    )


def _contract_values(datasets=DATASETS) -> str:
    rows = []
    for name, stages in datasets.items():
        for stage, spec in stages.items():
            chunks, shards = spec.get("chunk_map", {}), spec.get("shard_map", {})
            for dim in {**chunks, **shards}:
                chunk, shard = chunks.get(dim, "NULL"), shards.get(dim, "NULL")
                rows.append(
                    f"('{name}', '{stage}', '{dim}', CAST({chunk} AS BIGINT), CAST({shard} AS BIGINT))"
                )
    return f"contract(dataset, stage, dim, chunk, shard) AS (VALUES {', '.join(rows)})"


_PLANNED = """FROM catalog LEFT JOIN (SELECT * FROM contract WHERE stage = '{stage}') c USING (dataset, dim)
        WHERE NOT is_coord GROUP BY dataset, file, var"""

_ENTRIES = """{name}_entries AS (
  SELECT name AS var, 'dtype' AS key, dtype AS value FROM {name}
  UNION ALL
  SELECT name, 'chunks', array_to_string(chunks, ',') FROM {name} WHERE chunks IS NOT NULL)"""

_COMPARED = """compared AS (
  SELECT o.name, o.storage AS old_storage, o.chunks AS old_chunks, o.dtype AS old_dtype,
         n.storage AS new_storage, n.chunks AS new_chunks, n.dtype AS new_dtype,
         CAST(n.storage AS DOUBLE) / CAST(o.storage AS DOUBLE) AS ratio,
         CAST(n.storage AS DOUBLE) / CAST(o.storage AS DOUBLE) > CAST(1.05 AS DOUBLE)
           OR o.chunks IS DISTINCT FROM n.chunks OR o.dtype IS DISTINCT FROM n.dtype AS flagged
  FROM old_stats o JOIN new_stats n ON o.name = n.name WHERE o.storage <> 0)"""

QUERIES = {
    "contract_table": (
        contract,
        f"""WITH {I.CATALOG}, {_contract_values()},
        used AS (SELECT dataset, dim, count(*) AS n_arrays, max(dim_size) AS longest
            FROM catalog WHERE NOT is_coord GROUP BY 1, 2)
        SELECT dataset, dim, stage, chunk, shard, n_arrays, longest
        FROM contract LEFT JOIN used USING (dataset, dim)""",
    ),
    "layout_plan_netcdf": (
        rechunk_plan,
        f"""WITH {I.CATALOG}, {_contract_values()}
        SELECT dataset, file, var, max(dtype) AS dtype,
            string_agg(dim_size, ',' ORDER BY dim_pos) AS shape,
            string_agg(coalesce(chunk, dim_size), ',' ORDER BY dim_pos) AS chunksizes,
            true AS zlib, CAST(7 AS BIGINT) AS complevel, true AS shuffle
        {_PLANNED.format(stage="rechunk")}""",
    ),
    "layout_plan_sharded": (
        store_plan,
        f"""WITH {I.CATALOG}, {_contract_values()}
        SELECT dataset, file, var,
            string_agg(coalesce(chunk, dim_size), ',' ORDER BY dim_pos) AS chunks,
            string_agg(coalesce(shard, dim_size), ',' ORDER BY dim_pos) AS shards,
            'zstd' AS codec, CAST(5 AS BIGINT) AS level, true AS shuffle, true AS fill_is_nan
        {_PLANNED.format(stage="store")}""",
    ),
    "layout_check": (
        layout_check,
        f"""WITH {I.CATALOG},
        contract(dataset, dim, chunk, shard) AS (VALUES
            ('ecmwf', 'time', CAST(5 AS BIGINT), CAST(24 AS BIGINT)), ('ecmwf', 'step', 7, NULL),
            ('dpird', 'station', 2, NULL), ('dpird', 'time', 25, 500)),
        lens AS (SELECT dataset, file, var, CAST(dim_pos AS BIGINT) AS dim_pos,
            coalesce(chunk, dim_size) AS chunk, coalesce(shard, dim_size) AS shard
            FROM catalog LEFT JOIN contract USING (dataset, dim) WHERE NOT is_coord)
        SELECT * FROM lens WHERE shard % chunk <> 0""",
    ),
    "data_vars_only": (
        data_vars,
        f"""WITH {I.CATALOG} SELECT dataset, file, var, dtype, is_coord, dim,
            CAST(dim_pos AS BIGINT) AS dim_pos, dim_size FROM catalog WHERE NOT is_coord""",
    ),
    "strip_global_attrs": (
        stripped,
        f"""WITH {I.ATTRIBUTES} SELECT * FROM attrs
        WHERE NOT (dataset = 'dpird' AND scope = 'global')""",
    ),
    "encoding_diff": (
        encoding_diff,
        f"""WITH {I.STATS}, {_ENTRIES.format(name="old_stats")}, {_ENTRIES.format(name="new_stats")}
        SELECT var, key, o.value AS source_value, n.value AS converted_value,
            o.value IS NOT DISTINCT FROM n.value AS same
        FROM old_stats_entries o FULL OUTER JOIN new_stats_entries n USING (var, key)""",
    ),
    "storage_compare": (
        storage_compare,
        f"""WITH {I.STATS}, {_COMPARED}
        SELECT * REPLACE (array_to_string(old_chunks, ',') AS old_chunks,
            array_to_string(new_chunks, ',') AS new_chunks) FROM compared""",
    ),
    "flag_top_n": (
        flag_top_n,
        f"""WITH {I.STATS}, {_COMPARED}
        SELECT name, ratio FROM compared WHERE flagged ORDER BY name LIMIT 3""",
    ),
    "flag_count": (
        flag_count,
        f"WITH {I.STATS}, {_COMPARED} SELECT count(*) FILTER (flagged) AS flagged FROM compared",
    ),
    "common_arrays": (
        common_arrays,
        f"WITH {I.STATS} SELECT name FROM old_stats INTERSECT SELECT name FROM new_stats",
    ),
    "storage_totals": (
        storage_totals,
        f"""WITH {I.STATS},
        t AS (SELECT (SELECT CAST(sum(storage) AS BIGINT) FROM old_stats) AS old_total,
            (SELECT CAST(sum(storage) AS BIGINT) FROM new_stats) AS new_total)
        SELECT *, CAST(new_total AS DOUBLE) / CAST(old_total AS DOUBLE) AS ratio FROM t""",
    ),
    "chunk_size_mb": (
        chunk_size_mb,
        f"""WITH {I.STATS},
        used AS (SELECT name, CASE
              WHEN storage > 800 THEN [shape[1], 3]
              WHEN dtype = 'float64' THEN [shape[1] - 1, shape[2]]
              ELSE shape END AS lens,
            CASE WHEN storage > 700 THEN 'int16' ELSE dtype END AS size_dtype FROM old_stats)
        SELECT name, array_to_string(lens, ',') AS chunk_shape, size_dtype,
            CAST(lens[1] * lens[2] * CASE size_dtype WHEN 'int16' THEN 2 WHEN 'float32' THEN 4
              ELSE 8 END AS DOUBLE) / CAST(1048576 AS DOUBLE) AS mb
        FROM used""",
    ),
    "before_after": (
        before_after,
        f"""WITH {I.CATALOG}, {_contract_values()},
        shapes AS (SELECT file, var, CASE dtype WHEN 'float32' THEN 4 ELSE 8 END AS item,
            list(dim_size ORDER BY dim_pos) AS whole,
            list(coalesce(chunk, dim_size) ORDER BY dim_pos) AS planned
          FROM catalog LEFT JOIN (SELECT * FROM contract WHERE stage = 'rechunk') c
            USING (dataset, dim)
          WHERE NOT is_coord GROUP BY file, var, dtype)
        SELECT label, file, var, array_to_string(lens, ',') AS chunk_shape,
            CAST(list_product(lens) * item AS DOUBLE) / CAST(1048576 AS DOUBLE) AS mb
        FROM (SELECT 'BEFORE' AS label, file, var, item, whole AS lens FROM shapes
              UNION ALL SELECT 'AFTER', file, var, item, planned FROM shapes)""",
    ),
}

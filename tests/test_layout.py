"""Layout plans, fills and contracts on small literal arrays."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.contract import DATASETS, STORE_CODEC, contract_table, load_contracts, stage_spec
from gridloom.functions.values import nan, resolve_fill, resolve_fill_column
from gridloom.model import Grid
from gridloom.operators.layout import plan_rechunk, plan_store, uneven_shards

CATALOG = (
    "dataset string, file string, var string, dtype string, is_coord boolean, "
    "dim string, dim_pos int, dim_size bigint"
)


def catalog(spark, dims: dict, var="t2m", coords=()):
    rows = [("d", "f", var, "float32", False, d, k, n) for k, (d, n) in enumerate(dims.items())]
    rows += [("d", "f", c, "int64", True, c, 0, dims[c]) for c in coords]
    return spark.createDataFrame(rows, CATALOG)


def contract(spark, chunk, shard=None):
    stages = {"rechunk": {"chunk_map": chunk}, "store": {"chunk_map": chunk, "shard_map": shard or {}}}
    return contract_table(spark, {"d": stages})


def test_plan_takes_data_variables_only_and_never_clips(spark):
    arrays = catalog(spark, {"station": 2, "time": 3}, "airTemperature", ("station", "time"))
    rows = plan_rechunk(arrays, contract(spark, {"time": 2}), level=5).collect()
    assert [(r["var"], r["chunksizes"]) for r in rows] == [("airTemperature", [2, 2])]
    assert (rows[0]["zlib"], rows[0]["shuffle"], rows[0]["complevel"]) == (True, True, 5)
    longer = plan_rechunk(arrays, contract(spark, {"time": 50}), level=5).first()
    assert longer["chunksizes"] == [2, 50]


def test_plan_uses_whole_dim_when_not_mapped(spark):
    arrays = catalog(spark, {"time": 4, "latitude": 2, "longitude": 3})
    plan = plan_rechunk(arrays, contract(spark, {"time": 2}), level=5).first()
    assert plan["chunksizes"] == [2, 2, 3]


def test_plan_ignores_mapped_dims_the_array_lacks(spark):
    plan = plan_rechunk(catalog(spark, {"time": 4}), contract(spark, {"time": 2, "depth": 9}), 5)
    assert plan.first()["chunksizes"] == [2]


def test_store_plan(spark):
    arrays = catalog(spark, {"time": 6, "latitude": 2}, coords=("time", "latitude"))
    plan = plan_store(arrays, contract(spark, {"time": 2}, {"time": 6}), nan(), STORE_CODEC)
    rows = plan.collect()
    assert len(rows) == 1
    assert (rows[0]["chunks"], rows[0]["shards"]) == ([2, 2], [6, 2])
    assert rows[0]["compressor"].asDict() == STORE_CODEC
    assert math.isnan(rows[0]["fill_value"])
    assert uneven_shards(plan).isEmpty()


def test_uneven_shards_are_found(spark):
    arrays = catalog(spark, {"time": 6, "latitude": 2})
    plan = plan_store(arrays, contract(spark, {"time": 4}, {"time": 6}), nan(), STORE_CODEC)
    assert [(r["dim_pos"], r["chunk"], r["shard"]) for r in uneven_shards(plan).collect()] == [(0, 4, 6)]
    with pytest.raises(ValueError):
        Grid(("time",), {"time": 6}, {"time": 4}, {"time": 6}).check()


def test_empty_catalog_gives_empty_plans(spark):
    none = spark.createDataFrame([], CATALOG)
    assert plan_rechunk(none, contract(spark, {"time": 4}), 5).isEmpty()
    assert plan_store(none, contract(spark, {"time": 1}, {"time": 2}), nan(), STORE_CODEC).isEmpty()


def test_fill_values():
    assert isinstance(resolve_fill("nan", "float32"), np.float32)
    assert np.isnan(resolve_fill("nan", "float32"))
    assert isinstance(resolve_fill(float("nan"), "float64"), np.float64)
    assert resolve_fill("0", "str") == "0"
    assert resolve_fill(0, "int") == 0
    assert resolve_fill(9.969209968386869e36, "float64") == 9.969209968386869e36
    assert resolve_fill("word", "str") == "word"
    with pytest.raises(TypeError):
        resolve_fill(0, "str")
    with pytest.raises(OverflowError):
        resolve_fill(300, "int8")


def test_fill_column_errors(spark):
    frame = spark.createDataFrame([("0", False), ("word", True)], "text string, is_text boolean")
    text, is_text = F.col("text"), F.col("is_text")
    kept = frame.filter("is_text").select(resolve_fill_column(text, "str", is_text).alias("f"))
    assert kept.first()["f"] == "word"
    for column in (resolve_fill_column(text, "str", is_text), resolve_fill_column(text, "int8")):
        with pytest.raises(Exception):
            frame.select(column).collect()


def test_contract_lookup(tmp_path):
    path = tmp_path / "datasets.json"
    path.write_text('{"dpird": {"rechunk": {"input_root": "raw"}}}')
    datasets = load_contracts(str(path))
    assert stage_spec(datasets, "dpird", "rechunk") == {"input_root": "raw"}
    with pytest.raises(KeyError):
        stage_spec(datasets, "dpird", "store")
    assert stage_spec(DATASETS, "ecmwf", "store")["shard_map"]["time"] == 120


def test_live_shards_hold_whole_chunks():
    for stages in DATASETS.values():
        spec = stages["store"]
        Grid(tuple(spec["chunk_map"]), {}, spec["chunk_map"], spec["shard_map"]).check()

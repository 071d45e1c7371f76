"""Contracts: per dataset and stage, how its arrays are chunked and stored."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns, chunk and shard maps, levels and fills of the two
# weather datasets. Roots are folder names below a deployment's data folder.
DATASETS = {
    "dpird": {
        "rechunk": {
            "input_root": "raw",
            "input_pattern": "DPIRD/DPIRD_final_stations.nc",
            "output_root": "rechunked",
            "chunk_map": {"station": 96, "time": 52624},
            "complevel": 7,
        },
        "store": {
            "input_root": "raw",
            "input_pattern": "DPIRD/DPIRD_final_stations.nc",
            "output_root": "stores",
            "chunk_map": {"station": 192, "time": 26312},
            "shard_map": {"station": 192, "time": 52624},
            "fill_value": "nan",
            "fill_value_dtype": "float64",
        },
    },
    "ecmwf": {
        "rechunk": {
            "input_root": "raw",
            "input_pattern": "ECMWF/**/*.nc",
            "output_root": "rechunked",
            "chunk_map": {"time": 7, "step": 113, "latitude": 37, "longitude": 151},
            "complevel": 7,
        },
        "store": {
            "input_root": "raw",
            "input_pattern": "ECMWF/**/*.nc",
            "output_root": "stores",
            "chunk_map": {"time": 4, "step": 113, "latitude": 111, "longitude": 151},
            "shard_map": {"time": 120, "step": 113, "latitude": 111, "longitude": 151},
            "fill_value": "nan",
            "fill_value_dtype": "float32",
        },
    },
}

# Where finished stores are published, and which ones.
PUBLISH = {
    "catalog": "workspace",
    "schema": "weather",
    "volume": "weather-data",
    "folder": "zarr_objects",
    "stores": ["dpird.zarr", "ecmwf.zarr"],
}

# Codec settings of the two stages.
STORE_CODEC = {"codec": "zstd", "level": 5, "shuffle": True}
RECHUNK_CODEC = {"codec": "zlib", "shuffle": True}

# What staging in and staging out select.
STAGE_IN_DAYS = "[0-9][0-9][0-9][0-9]/[0-9][0-9]/[0-9][0-9].nc"


def load_contracts(path: str) -> dict:
    """Contracts from a JSON file shaped like ``DATASETS``."""
    with open(path) as f:
        return json.load(f)


def stage_spec(datasets: dict, dataset: str, stage: str) -> dict:
    """Parameters of one stage; an unknown name is a ``KeyError``."""
    return datasets[dataset][stage]


def publish_root(publish: dict = PUBLISH) -> str:
    place = (publish["catalog"], publish["schema"], publish["volume"], publish["folder"])
    return "/Volumes/" + "/".join(place)


def contract_table(spark: SparkSession, datasets: dict = DATASETS) -> DataFrame:
    """One row per dataset, stage and dim: ``chunk`` and ``shard``, null if not mapped."""
    specs = [
        (name, stage, spec.get("chunk_map", {}), spec.get("shard_map", {}))
        for name, stages in datasets.items()
        for stage, spec in stages.items()
    ]
    maps = spark.createDataFrame(
        specs, "dataset string, stage string, chunks map<string,bigint>, shards map<string,bigint>"
    )
    dims = F.array_union(F.map_keys("chunks"), F.map_keys("shards"))
    return maps.select("*", F.explode(dims).alias("dim")).select(
        "dataset",
        "stage",
        "dim",
        F.try_element_at("chunks", F.col("dim")).alias("chunk"),
        F.try_element_at("shards", F.col("dim")).alias("shard"),
    )

"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What a cluster job should start from; a deployment overrides sizes as needed.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

CELL_BATCH = 65_536  # cells of one Arrow batch while a job packs them
TEXT_BATCH = 4 << 20  # bytes of an Arrow batch, about, while a job sends texts to Python
LISTED_COST = 64 * 1024  # bytes a file counts for when only its name and length are read


def build_session(app: str = "gridloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rows_only_batches(spark: SparkSession):
    """Bound Arrow batches by rows alone while a job packs cells, by more of them.

    The byte bound is tested after each row, which costs more than sending a
    cell of a few bytes. Rows that carry payloads need it, so it is put back.
    """
    wanted = {"maxBytesPerBatch": str(2**31 - 1) + "b", "maxRecordsPerBatch": str(CELL_BATCH)}
    wanted = {f"spark.sql.execution.arrow.{key}": value for key, value in wanted.items()}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def small_batches(spark: SparkSession):
    """Bound Arrow batches by fewer bytes while a job sends texts to Python: a batch is
    held by Spark, by its worker and again by what the worker returns, in every task at
    once. A job's settings are read when it runs, so its result is written inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, f"{TEXT_BATCH}b")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def cheap_opens(spark: SparkSession):
    """Deal many files to a task while a table of them is written whose rows need no
    content: by Spark's default a task opens as many as would make 128 MB at 4 MB each."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(LISTED_COST))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def few_listers(spark: SparkSession):
    """List many folders in each task: by Spark's default a task lists one, up to 10000
    of them, and starting it takes longer."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host that Spark would read it from."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(root).toString()


def default_root(spark: SparkSession) -> str:
    """What stands before an absolute path without a scheme: ``file:``, or the
    scheme and host of the cluster's file system."""
    return qualified(spark, "/").rstrip("/")


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="gridloom-")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the cluster's shared checkpoint folder."""
    return f"{_shared_root(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table,
    whose size the optimizer then knows."""
    folder = scratch_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

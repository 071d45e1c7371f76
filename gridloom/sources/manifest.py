"""File manifests: one row per file, never the file content."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import paths
from gridloom.functions.ordering import with_running_total
from gridloom.session import qualified

# scheme and host: what is left starts with /
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)"


def scan_files(
    spark: SparkSession, root: str, pattern: str = "**/*", content: bool = False
) -> DataFrame:
    """Files under ``root`` whose relative path matches ``pattern``; their content
    is read only with ``content``.

    A missing root gives no rows. Names starting with ``.`` or ``_`` and files
    without a byte are not listed, as with every Spark file source.
    """
    name = pattern.rsplit("/", 1)[-1]
    root = qualified(spark, root)
    base = re.sub(_SCHEME, "", root.rstrip("/"))
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name)
            .load(root)
        )
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = "path string, rel_path string, length bigint, modified timestamp"
        return spark.createDataFrame([], schema + ", content binary" * content)
    plain = F.regexp_replace("path", _SCHEME, "")
    return files.select(
        "path",
        paths.relative_to(plain, base).alias("rel_path"),
        "length",
        F.col("modificationTime").alias("modified"),
        *["content"] * content,
    ).filter(paths.matches(F.col("rel_path"), pattern))


def in_order(manifest: DataFrame, path: str = "path") -> DataFrame:
    """Add ``ord``, 1 for the first path; paths compare component by component."""
    numbered = with_running_total(manifest, [paths.parts(F.col(path))], "ord")
    return numbered.withColumn("ord", F.col("ord") + 1)


def sample_file(ordered: DataFrame, nth: int = 10) -> DataFrame:
    """Only the ``nth`` file of an ordered manifest; an error when there are fewer."""
    one = ordered.filter(F.col("ord") == nth)
    if one.isEmpty():
        raise IndexError(f"there is no file number {nth}")
    return one


def include(manifest: DataFrame, patterns: list[str], path: str = "rel_path") -> DataFrame:
    """Files matching any of the root-anchored patterns."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | paths.matches(F.col(path), pattern.lstrip("/"))
    return manifest.filter(hit)


def include_trees(
    manifest: DataFrame, trees: list[str], path: str = "rel_path", depth: int | None = None
) -> DataFrame:
    """Files below any of the given folders, at most ``depth`` levels down."""
    hit = F.lit(False)
    for tree in trees:
        prefix = tree.strip("/") + "/"
        below = F.col(path).startswith(prefix)
        if depth is not None:
            level = F.size(F.split(path, "/")) - prefix.count("/")
            below = below & (level <= depth)
        hit = hit | below
    return manifest.filter(hit)


def work_list(datasets: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """One task row per file over all datasets, given (manifest, in root, out root)."""
    listed = None
    for name, (manifest, in_root, out_root) in datasets.items():
        rows = manifest.select(
            F.lit(name).alias("dataset"),
            F.lit(in_root).alias("in_root"),
            F.col("path").alias("in_path"),
            paths.rebase(F.col("path"), in_root, out_root).alias("out_path"),
        )
        listed = rows if listed is None else listed.unionByName(rows)
    return listed


def require_files(manifest: DataFrame, at_least: int, message: str) -> DataFrame:
    """The manifest itself, once it is known to have ``at_least`` files."""
    if manifest.limit(at_least).count() < at_least:
        raise FileNotFoundError(message)
    return manifest

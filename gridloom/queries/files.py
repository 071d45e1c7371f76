"""Queries on manifests: listing, ordering, filters, copies, guards."""

from pyspark.sql import functions as F

from gridloom.contract import DATASETS, PUBLISH, STAGE_IN_DAYS, publish_root
from gridloom.functions import paths
from gridloom.queries import inputs as I
from gridloom.session import scratch_folder
from gridloom.sinks.objects import copy_files, write_objects
from gridloom.sinks.publish import (
    listing,
    plan_copy,
    present_sources,
    skipped_sources,
    upload_targets,
    verify_copy,
)
from gridloom.sources.digest import file_digests
from gridloom.sources.manifest import (
    in_order,
    include,
    include_trees,
    require_files,
    sample_file,
    scan_files,
    work_list,
)


def _documents(spark, sf):
    """Every document as a file of its text, a folder per source."""
    return I.table(spark, sf, "documents").select(
        F.concat(F.lit("ECMWF/"), "source", F.lit("/"), "lang", F.lit("/"), "doc_id", F.lit(".nc")).alias(
            "rel_path"
        ),
        F.encode("text", "UTF-8").alias("payload"),
    )


def _document_files(spark, sf) -> str:
    root = scratch_folder(spark, "files")
    write_objects(_documents(spark, sf), root).agg(F.sum("length")).first()
    return root


def manifest_scan(spark, sf):
    root = _document_files(spark, sf)
    found = scan_files(spark, root, DATASETS["ecmwf"]["store"]["input_pattern"])
    return found.select("rel_path", "length")


def copy_status(spark, sf):
    """Copy every document file; conversations name sources that do not exist."""
    root, target = _document_files(spark, sf), scratch_folder(spark, "copies")
    real = scan_files(spark, root).select("rel_path")
    missing = (
        I.table(spark, sf, "conversations")
        .select(F.concat(F.lit("missing/"), "conv_id", F.lit(".nc")).alias("rel_path"))
        .distinct()
    )
    pairs = real.unionByName(missing).select(
        F.concat(F.lit(root + "/"), "rel_path").alias("source"),
        F.concat(F.lit(target + "/"), "rel_path").alias("target"),
    )
    status = copy_files(pairs)
    return status.select(paths.relative_to(F.col("target"), target).alias("rel_path"), "ok")


def manifest_sorted(spark, sf):
    return in_order(I.order_files(spark, sf).select("path", "length"))


def dry_run_sample(spark, sf):
    days = include_trees(I.order_files(spark, sf), ["ECMWF"]).select("path", "length")
    return sample_file(in_order(days))


def path_include_filter(spark, sf):
    """Stage-in rule on paths of which only some are day files."""
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    name = (
        F.when(F.col("o_orderstatus") == "O", F.concat(day, F.lit(".nc")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("extra/"), day, F.lit(".nc")))
        .otherwise(F.concat(day, F.lit(".nc.part")))
    )
    listed = I.table(spark, sf, "orders").select("o_orderkey", name.alias("rel_path"))
    return include(listed, [STAGE_IN_DAYS])


def prefix_include_filter(spark, sf):
    return include_trees(I.order_files(spark, sf), ["DPIRD/", "ECMWF/1996/"]).select(
        "rel_path", "length"
    )


def prefix_one_level(spark, sf):
    """The one-level variant: files directly in a folder, not deeper ones."""
    trees = ["DPIRD/", "ECMWF/1996/"]
    return include_trees(I.order_files(spark, sf), trees, depth=1).select("rel_path", "length")


def date_from_path(spark, sf):
    day = F.concat(F.lit("/data/ECMWF/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit(".nc"))
    orders = I.table(spark, sf, "orders").select("o_orderkey", day.alias("path"))
    return orders.withColumn("day", paths.date_of(F.col("path")))


def output_path(spark, sf):
    files = I.order_files(spark, sf)
    return files.select("path", paths.rebase(F.col("path"), "/data/raw", "/data/rechunked").alias("out_path"))


def work(spark, sf):
    files = I.order_files(spark, sf)
    both = {
        name: (
            include(files, [DATASETS[name]["rechunk"]["input_pattern"].replace("DPIRD_final_stations", "*")]),
            "/data/raw",
            "/data/rechunked",
        )
        for name in DATASETS
    }
    return work_list(both)


def _copied(spark, sf):
    """What a target already holds: orders with status P are not there yet,
    urgent ones have another length."""
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("length") + 1)
    return (
        I.order_files(spark, sf)
        .filter(F.col("o_orderstatus") != "P")
        .select("rel_path", F.coalesce(changed, "length").alias("length"))
    )


def copy_plan(spark, sf):
    files = I.order_files(spark, sf)
    return plan_copy(files, _copied(spark, sf)).select("rel_path", "length")


def copy_plan_digest(spark, sf):
    """Copies of which some are absent and some hold as many, but other, bytes."""
    documents = _documents(spark, sf).select(
        "rel_path", "payload", F.regexp_extract("rel_path", "([0-9]+)[.]nc$", 1).cast("long").alias("n")
    )
    root, target = _document_files(spark, sf), scratch_folder(spark, "copied")
    text = F.decode("payload", "UTF-8")
    turned = F.encode(F.concat(F.expr("substr(decode(payload, 'UTF-8'), 2)"), F.substring(text, 1, 1)), "UTF-8")
    held = documents.where("n % 10 <> 1").select(
        "rel_path", F.when(F.col("n") % 10 == 0, turned).otherwise(F.col("payload")).alias("payload")
    )
    write_objects(held, target).agg(F.sum("length")).first()
    sides = [file_digests(scan_files(spark, at), block=1 << 16) for at in (root, target)]
    return plan_copy(*sides, by="digest").select("rel_path", "length")


def copy_listing(spark, sf):
    return listing(_copied(spark, sf))


def copy_counts(spark, sf):
    return verify_copy(I.order_files(spark, sf), _copied(spark, sf))


def _stores(spark, sf):
    """Order files as the content of stores: two requested, one not."""
    store = (
        F.when(F.col("o_orderstatus") == "O", "ecmwf.zarr")
        .when(F.col("o_orderstatus") == "F", "dpird.zarr")
        .otherwise("other.zarr")
    )
    name = F.concat(store, F.lit("/"), "rel_path")
    return I.order_files(spark, sf).select(name.alias("rel_path"), "length")


def _requested(spark):
    return spark.createDataFrame([(s,) for s in [*PUBLISH["stores"], "absent.zarr"]], "store string")


def present(spark, sf):
    files, requested = _stores(spark, sf), _requested(spark)
    kept = present_sources(requested, files).withColumn("present", F.lit(True))
    return kept.unionByName(
        skipped_sources(requested, files).withColumn("present", F.lit(False))
    )


def targets(spark, sf):
    sent = upload_targets(_requested(spark), _stores(spark, sf), publish_root())
    return sent.select("rel_path", "target", "length")


def min_files_guard(spark, sf):
    return require_files(I.day_manifest(spark, sf), 2, "not enough files").select("file", "length")


def missing_source_guard(spark, sf):
    """The station files are there; a folder nobody wrote is refused."""
    files = I.order_files(spark, sf)
    kept = require_files(include_trees(files, ["DPIRD"]), 1, "no station file")
    try:
        require_files(include_trees(files, ["SILO"]), 1, "no such folder")
        refused = False
    except FileNotFoundError:
        refused = True
    return kept.select("rel_path", F.lit(refused).alias("other_refused"))


def empty_input(spark, sf):
    """A pattern that matches none of the files: an empty work list, no error."""
    none = include(I.order_files(spark, sf), ["SILO/**/*.nc"])
    listed = work_list({"silo": (none, "/data/raw", "/data/rechunked")})
    return listed.agg(F.count(F.lit(1)).alias("submitted"))


def _tree_sql(depth: str = "") -> str:
    return f"""WITH {I.ORDER_FILES} SELECT rel_path, length FROM order_files
        WHERE (starts_with(rel_path, 'DPIRD/') {depth.format(n=2)})
           OR (starts_with(rel_path, 'ECMWF/1996/') {depth.format(n=3)})"""


_COPIED = """copied AS (SELECT rel_path,
    CASE WHEN o_orderpriority = '1-URGENT' THEN length + 1 ELSE length END AS length
  FROM order_files WHERE o_orderstatus <> 'P')"""

_STORES = """stores AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'ecmwf.zarr'
    WHEN 'F' THEN 'dpird.zarr' ELSE 'other.zarr' END AS store, store || '/' || rel_path AS rel_path,
    length FROM order_files)"""

_REQUESTED = "requested(store) AS (VALUES ('dpird.zarr'), ('ecmwf.zarr'), ('absent.zarr'))"

QUERIES = {
    "manifest_scan": (
        manifest_scan,
        """SELECT 'ECMWF/' || source || '/' || lang || '/' || doc_id || '.nc' AS rel_path,
            CAST(octet_length(encode(text)) AS BIGINT) AS length FROM documents""",
    ),
    "copy_status": (
        copy_status,
        """SELECT 'ECMWF/' || source || '/' || lang || '/' || doc_id || '.nc' AS rel_path, true AS ok
        FROM documents
        UNION ALL
        SELECT DISTINCT 'missing/' || conv_id || '.nc', false FROM conversations""",
    ),
    "manifest_sorted": (
        manifest_sorted,
        f"""WITH {I.ORDER_FILES} SELECT path, length,
            row_number() OVER (ORDER BY string_split(path, '/')) AS ord FROM order_files""",
    ),
    "dry_run_sample": (
        dry_run_sample,
        f"""WITH {I.ORDER_FILES}, numbered AS (SELECT path, length,
            row_number() OVER (ORDER BY string_split(path, '/')) AS ord FROM order_files
            WHERE starts_with(rel_path, 'ECMWF/'))
        SELECT * FROM numbered WHERE ord = 10""",
    ),
    "path_include_filter": (
        path_include_filter,
        """WITH listed AS (SELECT o_orderkey, CASE o_orderstatus
              WHEN 'O' THEN strftime(o_orderdate, '%Y/%m/%d') || '.nc'
              WHEN 'F' THEN 'extra/' || strftime(o_orderdate, '%Y/%m/%d') || '.nc'
              ELSE strftime(o_orderdate, '%Y/%m/%d') || '.nc.part' END AS rel_path FROM orders)
        SELECT * FROM listed
        WHERE regexp_full_match(rel_path, '[0-9]{4}/[0-9]{2}/[0-9]{2}\\.nc')""",
    ),
    "prefix_include_filter": (prefix_include_filter, _tree_sql()),
    "prefix_one_level": (
        prefix_one_level,
        _tree_sql("AND len(string_split(rel_path, '/')) <= {n}"),
    ),
    "date_from_path": (
        date_from_path,
        """SELECT o_orderkey, '/data/ECMWF/' || strftime(o_orderdate, '%Y/%m/%d') || '.nc' AS path,
            strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
    ),
    "output_path": (
        output_path,
        f"""WITH {I.ORDER_FILES} SELECT path, '/data/rechunked/' || rel_path AS out_path
        FROM order_files""",
    ),
    "work_list": (
        work,
        f"""WITH {I.ORDER_FILES} SELECT lower(string_split(rel_path, '/')[1]) AS dataset,
            '/data/raw' AS in_root, path AS in_path, '/data/rechunked/' || rel_path AS out_path
        FROM order_files WHERE rel_path LIKE '%.nc'""",
    ),
    "copy_plan": (
        copy_plan,
        f"""WITH {I.ORDER_FILES}, {_COPIED} SELECT rel_path, length FROM order_files
        ANTI JOIN copied USING (rel_path, length)""",
    ),
    "copy_plan_digest": (
        copy_plan_digest,
        """SELECT 'ECMWF/' || source || '/' || lang || '/' || doc_id || '.nc' AS rel_path,
            CAST(octet_length(encode(text)) AS BIGINT) AS length FROM documents
        WHERE doc_id % 10 = 1 OR doc_id % 10 = 0 AND text[2:] || text[:1] <> text""",
    ),
    "copy_verify": (
        copy_listing,
        f"""WITH {I.ORDER_FILES}, {_COPIED}
        SELECT rel_path, length FROM copied ORDER BY rel_path LIMIT 20""",
    ),
    "copy_verify_counts": (
        copy_counts,
        f"""WITH {I.ORDER_FILES}, {_COPIED}
        SELECT count(*) FILTER (s.length = t.length) AS matched,
            count(*) FILTER (t.length IS NULL) AS missing,
            count(*) FILTER (s.length <> t.length) AS size_differs,
            count(*) FILTER (s.length IS NULL) AS extra
        FROM order_files s FULL OUTER JOIN copied t USING (rel_path)""",
    ),
    "present_sources": (
        present,
        f"""WITH {I.ORDER_FILES}, {_STORES}, {_REQUESTED}
        SELECT store, store IN (SELECT store FROM stores) AS present FROM requested""",
    ),
    "upload_targets": (
        targets,
        f"""WITH {I.ORDER_FILES}, {_STORES}, {_REQUESTED}
        SELECT rel_path, '/Volumes/workspace/weather/weather-data/zarr_objects/' || rel_path
            AS target, length
        FROM stores SEMI JOIN requested USING (store)""",
    ),
    "min_files_guard": (
        min_files_guard,
        f"WITH {I.DAY_MANIFEST} SELECT file, length FROM day_manifest",
    ),
    "missing_source_guard": (
        missing_source_guard,
        f"""WITH {I.ORDER_FILES} SELECT rel_path, true AS other_refused FROM order_files
        WHERE starts_with(rel_path, 'DPIRD/')""",
    ),
    "empty_input": (
        empty_input,
        f"""WITH {I.ORDER_FILES} SELECT count(*) AS submitted FROM order_files
        WHERE starts_with(rel_path, 'SILO/') AND rel_path LIKE '%.nc'""",
    ),
}

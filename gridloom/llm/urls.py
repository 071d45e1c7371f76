"""URL filtering by host-suffix and path-prefix rules.

Every URL is expanded into the expressions ``<host suffix><path prefix>`` that a
rule could be written as. Expressions meet rules in an equi-join on a short
prefix of their SHA-256 digest; the full digest confirms a meeting, and the
longest confirmed rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import fold, small_side

HASH_DIGITS = 8  # hexadecimal digits of the join key
BROADCAST_RULES = 50_000


def host_of(url: Column) -> Column:
    """Host of a URL, A-Z lower-cased; empty for null or without ``://``."""
    return fold(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Path of a URL up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as a table: ``rule`` (``host/path/``) and ``action`` (allow or block)."""
    for rule, action in rules:
        if not (rule.endswith("/") and action in ("allow", "block")):
            raise ValueError(f"a rule is host/ or host/path/ with allow or block: {rule} {action}")
    return spark.createDataFrame(rules, "rule string, action string")


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Verdict of every distinct URL: url, host, path, rule, verdict.

    Rules are folded to lower-case hosts; of equal rules with both actions,
    block stands. A null URL, or one without ``://``, has an empty host and path
    and takes ``default``, as does a URL that no rule fits. Expansions go as deep
    as the deepest rule, which loses none. An empty rule table gives ``default``.
    """
    rules = rules.select(
        F.concat(
            fold(F.substring_index("rule", "/", 1)),
            F.expr("substring(rule, instr(rule, '/'))"),
        ).alias("rule"),
        "action",
    ).groupBy("rule").agg(F.max("action").alias("action"))
    deep = rules.agg(
        F.max(F.size(F.split(F.substring_index("rule", "/", 1), "\\."))),
        F.max(F.size(F.split("rule", "/")) - 1),
    ).first()
    labels, slashes = deep[0] or 0, deep[1] or 0

    urls = pages.select(F.col(url).alias("url")).distinct()
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    expanded = (
        urls.where("host <> ''")
        .withColumns({"_h": F.split("host", "\\."), "_p": F.split("path", "/")})
        .withColumn("_k", F.expr(f"explode(sequence(0, least({labels}, size(_h))))"))
        .withColumn("_s", F.expr("concat_ws('.', slice(_h, size(_h) - _k + 1, _k))"))
        .withColumn("_j", F.expr(f"explode(sequence(0, least({slashes}, size(_p) - 1)))"))
        .where("_k > 0 and _j > 0")
        .select(
            "url",
            F.concat("_s", F.expr("concat_ws('/', slice(_p, 1, _j))"), F.lit("/")).alias("_e"),
        )
        .withColumn("_digest", F.sha2("_e", 256))
        .withColumn("_key", F.substring("_digest", 1, HASH_DIGITS))
    )
    keyed = rules.withColumn("_full", F.sha2("rule", 256)).withColumn(
        "_key", F.substring("_full", 1, HASH_DIGITS)
    )
    hits = (
        expanded.join(small_side(keyed, BROADCAST_RULES), "_key")
        .where("_digest = _full")
        .groupBy("url")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("_best"))
        .select(F.col("url").alias("_url"), "_best.rule", "_best.action")
    )
    return urls.join(hits, F.col("url") == F.col("_url"), "left").select(
        "url", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict")
    )


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``; repeated
    rows and null ids are kept."""
    judged = judge_urls(pages, rules)
    rows = pages.select("page_id", F.col("url").alias("_own"))
    return rows.join(judged, F.col("_own").eqNullSafe(F.col("url"))).select(
        "page_id", "host", "path", "rule", "verdict"
    )

"""Path expressions over manifest columns."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"([^/]+)/([^/]+)/([^/]+)\.nc$"


def glob_regex(pattern: str) -> str:
    """Anchored regex for a root-relative glob; ``**/`` spans any depth, zero included."""
    out, i = [], 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out.append("(?:[^/]+/)*")
            i += 3
        elif pattern.startswith("**", i):
            out.append(".*")
            i += 2
        elif pattern[i] == "*":
            out.append("[^/]*")
            i += 1
        elif pattern[i] == "?":
            out.append("[^/]")
            i += 1
        elif pattern[i] == "[" and "]" in pattern[i:]:
            end = pattern.index("]", i)
            out.append(pattern[i : end + 1].replace("[!", "[^"))
            i = end + 1
        else:
            out.append(re.escape(pattern[i]))
            i += 1
    return "^" + "".join(out) + "$"


def matches(rel_path: Column, pattern: str) -> Column:
    return rel_path.rlike(glob_regex(pattern))


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``; a path outside it fails the query."""
    prefix = root.rstrip("/") + "/"
    return F.when(
        path.startswith(prefix), F.substring(path, len(prefix) + 1, 2**31 - 1)
    ).otherwise(F.raise_error(F.concat(path, F.lit(f" is not below {root}"))))


def rebase(path: Column, in_root: str, out_root: str) -> Column:
    return F.concat(F.lit(out_root.rstrip("/") + "/"), relative_to(path, in_root))


def date_of(path: Column) -> Column:
    """``.../2024/02/06.nc`` to ``2024-02-06``; digits are not validated."""
    return F.concat_ws("-", *[F.regexp_extract(path, _DATE, k) for k in (1, 2, 3)])


def parts(path: Column) -> Column:
    """Sort key that orders paths component by component: the separator is made
    to sort before every character of a name. A plain string sorts much faster
    than an array of components."""
    return F.translate(path, "/", "\x01")

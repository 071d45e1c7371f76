"""Exact Jaccard join of documents on their word 5-grams.

Texts of one shingle set are one node. All shingles share one order, rarest
first, by counts over all documents; nodes that reach the threshold must meet in
the first fifth of their ordered shingles, their prefixes. Prefix shingles are
joined by a sorted window: each node is compared with the first nodes of the
lists it is in and the nodes before it, those it shares most lists with. Length,
positional and suffix filters and bitmaps of the sets drop candidates, and each
pair left is verified once on its full sets. Links found so far
are closed to components; only where a list still holds several components are
the pairs between them enumerated, so a group of near copies costs a few
comparisons a node, and no link between components is missed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import (
    components,
    free_shuffles,
    giving_back,
    id_bitmaps,
    id_spot,
    in_bitmap,
    likely_among,
)
from gridloom.llm.texts import LONG_WORD, blocks, mixed
from gridloom.session import materialized

SHINGLE = 5
PERCENT = 80
COUNTERS = 1 << 20  # shingles are counted in so many places; ties only change the order
SLICES = 64  # the counters travel in so many parts
FAN_IN = 64  # tasks whose counters are added at once
LIST_ROWS = 50_000  # lists expected to be longer are split into parts of about this size
LEADERS = 4  # nodes of its lists that a node is compared with at once
PROFILE = 16  # regions of the suffix filter
EARLIER = 16  # earlier shingles a row knows, so that a pair meets in few of its lists
_NODE_SEED = np.uint64(0xA0761D6478BD642F)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# A value for each byte, and an odd base whose powers keep the places of bytes apart.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95


class Words:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of texts, A-Z lower-cased.
    A word's hash is a polynomial of its bytes, taken from running sums over the
    whole text, so no word becomes an object of its own; but a long word does: with
    length, polynomials modulo 2^64 of different words come to be equal."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(max(n, 1 << 16), base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up[:n], self.down

    def _block(self, raw: bytes) -> np.ndarray:
        text = np.frombuffer(raw, np.uint8)
        edge = np.diff(_SPACE[text].view(np.int8), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = self._powers(len(text))
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_BYTE[text] * up, out=sums[1:])
        words = (sums[ends] - sums[starts]) * down[starts]
        words = mixed(words + (ends - starts).astype(np.uint64))
        for k in np.flatnonzero(ends - starts > LONG_WORD):
            words[k] = xxhash.xxh3_64_intdigest(text[starts[k] : ends[k]])
        return words

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        parts = [self._block(p.encode("utf-8", "surrogatepass").lower()) for p in blocks(text) if p]
        return np.concatenate(parts) if len(parts) > 1 else parts[0]


# Odd factors that keep the places of a shingle's words apart. No sum of some of them
# is a sum of others, so words that repeat in a shingle do not hide their places.
_PLACES = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(h: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of hashed words; fewer words are one shingle."""
    if not len(h):
        return h
    n = min(SHINGLE, len(h))
    total = h[: len(h) - n + 1] * _PLACES[0]
    for k in range(1, n):
        total += h[k : len(h) - n + 1 + k] * _PLACES[k]
    total = mixed(total + np.uint64(n))
    total.sort()
    new = np.ones(len(total), bool)
    new[1:] = total[1:] != total[:-1]
    return total[new]


def node_of(s: np.ndarray) -> int:
    """A signed 64-bit name of a shingle set."""
    total = mixed(s ^ _NODE_SEED).sum(dtype=np.uint64, keepdims=True)
    return int(mixed(total + np.uint64(len(s)))[0].astype(np.int64))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the threshold."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # two runs are merged
    both = np.count_nonzero(both[1:] == both[:-1])
    return 100 * both >= percent * (len(a) + len(b) - both)


def _profile(s: np.ndarray) -> np.ndarray:
    return np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=PROFILE)


def sketch(s: np.ndarray) -> np.ndarray:
    """A bitmap of 4 to 8 bits a shingle, packed: which places the shingles hash to."""
    bits = max(256, 1 << (4 * len(s)).bit_length())
    held = np.zeros(bits, bool)
    held[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little")


def _sketches_agree(x: np.ndarray, y: np.ndarray, nx: int, ny: int, percent: int) -> bool:
    """Whether sets of these sketches may reach the threshold: a place that only one
    side has stands for a shingle, at least, that only this side has."""
    least = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(v.reshape(-1, least)) for v in (x, y))
    shared = min(nx - int(np.bitwise_count(x & ~y).sum()), ny - int(np.bitwise_count(y & ~x).sum()))
    return (100 + percent) * shared >= percent * (nx + ny)


def _first_pass(docs: DataFrame) -> DataFrame:
    """doc_id, copy (a hash of the text), n, node, profile of every row; and parts of
    the counters of all shingles (task, slice, counts)."""
    schema = (
        "doc_id long, copy long, n long, node long, profile array<int>, task int, slice int, "
        "counts binary"
    )

    def describe(batches):
        from pyspark import TaskContext

        hashes, counts = Words(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            ns, nodes, profiles = [], [], []
            for text in batch.column(1):
                s = shingle_set(hashes(text.as_py()))
                np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
                ns.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                profiles.append(_profile(s).astype(np.int32) if len(s) else None)
            size = batch.num_rows
            own = [batch.column(0), batch.column(2), ns, nodes, profiles]
            yield _batch(schema, own + [[None] * size] * 3)
        parts = np.split(np.minimum(counts, 2**31 - 1).astype("<i4"), SLICES)
        none = [[None] * SLICES] * 5
        task = [TaskContext.get().partitionId()] * SLICES
        yield _batch(schema, [*none, task, range(SLICES), [p.tobytes() for p in parts]])

    return docs.select("doc_id", "text", _copy_of(docs).alias("copy")).mapInArrow(giving_back(describe), schema)



def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
             "array<int>": pa.list_(pa.int32()), "string": pa.string()}
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def _counters(parts: DataFrame) -> np.ndarray:
    """Sum of all tasks' counters, a few tasks at a time; the result has a fixed size."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, "<i4").astype(np.int64) for c in pdf["counts"])
        counts = np.minimum(total, 2**31 - 1).astype("<i4").tobytes()
        return pd.DataFrame(
            {"task": pdf["task"].iloc[:1], "slice": pdf["slice"].iloc[:1], "counts": [counts]}
        )

    parts = parts.where("slice is not null").select("task", "slice", "counts")
    tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        parts = parts.withColumn("task", F.expr(f"cast(task div {FAN_IN} as int)"))
        parts = parts.groupBy("task", "slice").applyInPandas(
            add, "task int, slice int, counts binary"
        )
        tasks = -(-tasks // FAN_IN)
        if tasks == 1:
            break
    total = np.zeros((SLICES, COUNTERS // SLICES), np.int32)
    for row in parts.collect():  # 4 MB; row by row, each partition would be a job
        total[row["slice"]] = np.frombuffer(row["counts"], "<i4")
    return total.ravel()


def _prefixes(docs: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """Prefix shingles of all nodes: shingle, part, node, size, pos."""
    schema = "shingle long, part int, node long, size int, pos int"
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def prefix(batches):
        hashes, counts, done = Words(), shared.value, set()
        for batch in batches:
            rows = []
            for text in batch.column(0):
                s = shingle_set(hashes(text.as_py()))
                if not len(s):
                    continue
                node = node_of(s)
                if node in done:  # a copy; the window would drop it as well
                    continue
                if len(done) >= 1 << 20:
                    done.clear()
                done.add(node)
                count = counts[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                length = len(s) + (-percent * len(s)) // 100 + 1
                first = np.lexsort((s, count))[:length]
                parts = 1 + count[first].astype(np.int64) // LIST_ROWS
                rows.append((
                    s[first].astype(np.int64),
                    # 0 is a whole list; the parts of a split one count from 1
                    np.where(parts > 1, 1 + abs(node) % parts, 0).astype(np.int32),
                    np.full(length, node, np.int64),
                    np.full(length, len(s), np.int32),
                    np.arange(length, dtype=np.int32),
                ))
            if rows:
                yield _batch(schema, [pa.array(np.concatenate(c)) for c in zip(*rows)])

    return docs.where("doc_id is not null").select("text").mapInArrow(giving_back(prefix), schema)


def _may_link(x: str, y: str, percent: int) -> str:
    """Length and positional filter of two prefix rows with one shingle: what both
    sides still have from here on must do. Nodes that link pass it in the list of the
    first shingle they share, before which they share none."""
    return (
        f"100 * least({x}size, {y}size) >= {percent} * greatest({x}size, {y}size) and "
        f"{100 + percent} * least({x}size - {x}pos, {y}size - {y}pos) "
        f">= {percent} * ({x}size + {y}size)"
    )


def _lists(prefixes: DataFrame) -> DataFrame:
    """Prefix rows that share their shingle with another node, with the first row
    of the list, its leader (f_), and the row before (b_). Nodes that have this
    shingle early, so few that are rarer, come first: they may share the most."""
    near = Window.partitionBy("shingle", "part").orderBy("pos", "size", "node")
    whole = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns = {f"f_{c}": F.first(c).over(whole) for c in ("node", "size", "pos")}
    columns |= {f"b_{c}": F.lag(c).over(near) for c in ("node", "size", "pos")}
    columns |= {"l_node": F.last("node").over(whole)}
    # a list in several parts is kept whole: its other parts are elsewhere
    return prefixes.withColumns(columns).where("f_node <> l_node or part > 0").drop("l_node")


def _first_pairs(rows: DataFrame, percent: int, sides: tuple[str, ...]) -> DataFrame:
    """a and b: each node b is compared with those of its leaders (f_) or of the
    nodes before it (b_) that it shares most lists with, ``LEADERS`` of them."""
    met = None
    for x in sides:
        own = rows.where(f"{x}node <> node and {_may_link('', x, percent)}").select(
            F.col(f"{x}node").alias("a"), F.col("node").alias("b")
        )
        met = own if met is None else met.union(own)
    shared = met.groupBy("a", "b").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("times"), "a"))
    return shared.withColumn("rank", rank).where(f"rank <= {LEADERS}").select("a", "b")


def _verified(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int
) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. ``nodes``: node, doc_id
    (a document with its text), size, profile. Profiles are compared first, then
    sketches of the sets, then the sets; the first two drop no pair that links."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("an"),
                       F.col("profile").alias("ap"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("bn"),
                       F.col("profile").alias("bp"))
    # suffix filter: in no region can more shingles be shared than either side has
    shared = " + ".join(f"least(ap[{k}], bp[{k}])" for k in range(PROFILE))
    pairs = materialized(
        pairs.join(one, "a").join(two, "b")
        .where(f"{100 + percent} * ({shared}) >= {percent} * (an + bn)")
        .select("a", "b")
    )
    # most pairs end at their sketches, so that few whole sets are shuffled
    for form, test in ((sketch, _sketches_agree), (np.asarray, linked)):
        if not pairs.limit(1).count():
            return pairs
        sets = _sets_of(docs, pairs, nodes, form)
        one = sets.where("leads").select(F.col("node").alias("a"), F.col("form").alias("av"),
                                         F.col("size").alias("an"))
        two = sets.where("follows").select(F.col("node").alias("b"), F.col("form").alias("bv"),
                                           F.col("size").alias("bn"))
        whole = pairs.join(two, "b").join(one, "a").select("a", "b", "av", "bv", "an", "bn")
        pairs = materialized(whole.mapInArrow(giving_back(_agreeing(test, percent)), "a long, b long"))
        del sets, one, two, whole
        free_shuffles(pairs.sparkSession)
    return pairs


def _agreeing(test, percent: int):
    def agreeing(batches):
        for batch in batches:
            good = []
            for av, bv, an, bn in zip(*(batch.column(k) for k in range(2, 6))):
                one, two = (
                    np.frombuffer(v.as_buffer(), "<u8" if test is linked else np.uint8)
                    for v in (av, bv)
                )
                sizes = () if test is linked else (an.as_py(), bn.as_py())
                good.append(test(one, two, *sizes, percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return agreeing


def _sets_of(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, form) -> DataFrame:
    """The shingles of each node in ``pairs`` in a form (whole, or a sketch), worked
    out again from one document of the node, their number, and on which sides the
    node stands there (leads: a, follows: b). Tasks drop
    other documents by bitmaps, so that only sets to be compared are shuffled; a
    stray one meets no pair."""
    sides = F.posexplode(F.array("a", "b")).alias("side", "node")
    places = pairs.select(sides).distinct().join(nodes.select("node", "doc_id"), "node")
    held = id_bitmaps(places, "doc_id", sides=2)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def wanted(batches):
        hashes = Words()
        for batch in batches:
            spots = batch.column(1).to_numpy()
            sides = [in_bitmap(h, spots) for h in shared.value]
            at = np.flatnonzero(sides[0] | sides[1])
            sets = [shingle_set(hashes(t.as_py())) for t in batch.column(0).take(pa.array(at))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([form(s).tobytes() for s in sets], pa.binary()),
                 *(pa.array(side[at]) for side in sides)],
                names=["node", "size", "form", "leads", "follows"],
            )

    rows = docs.where("doc_id is not null").select("text", id_spot("doc_id"))
    schema = "node long, size int, form binary, leads boolean, follows boolean"
    return materialized(rows.mapInArrow(giving_back(wanted), schema))


def _open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the lists that still hold several components, with their roots."""
    named = lists.select("shingle", "part", "node", "size", "pos").join(roots, "node", "left")
    named = materialized(named.withColumn("root", F.coalesce("root", "node")))
    several = (
        named.groupBy("shingle")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        .where("lo <> hi")
        .select("shingle")
    )
    return named.join(several, "shingle")


def _with_earlier(rows: DataFrame) -> DataFrame:
    """Rows of open lists with ``earlier``: the shingles that come last before this
    one in the node's order. Two nodes of different components share a shingle only
    in an open list, so one that stands in both is a list where they meet as well."""
    before = Window.partitionBy("node").orderBy("pos").rowsBetween(-EARLIER, -1)
    return rows.withColumn("earlier", F.collect_list("shingle").over(before))


def _membership(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row (doc_id, copy, n, node), and for each node in a component with
    several rows: node, root, component_id (its smallest doc_id)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    first = materialized(_first_pass(docs))
    rows = first.where("slice is null").select("doc_id", "copy", "n", "node", "profile")
    nodes = materialized(
        rows.where("node is not null and doc_id is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
             F.first("n").alias("n"), F.first("profile").alias("profile"))
    )
    lists = materialized(_lists(_prefixes(docs, _counters(first), percent)))

    free_shuffles(docs.sparkSession)
    pairs = materialized(_first_pairs(lists, percent, ("f_", "b_")))
    links = _verified(pairs, nodes, docs, percent)
    roots = components(links)
    tried = pairs.union(pairs.select("b", "a"))

    # what those comparisons did not settle: lists with more than one component
    open_rows = materialized(_with_earlier(_open_lists(lists, roots)))
    columns = ("node", "size", "pos", "root", "earlier")
    x, y = (
        open_rows.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in columns])
        for side in ("x", "y")
    )
    rest = (
        x.join(y, "shingle")
        # nodes that share an earlier shingle have met there, or failed a filter there
        .where(
            f"x_root < y_root and {_may_link('x_', 'y_', percent)} "
            "and not arrays_overlap(x_earlier, y_earlier)"
        )
        .selectExpr("least(x_node, y_node) as a", "greatest(x_node, y_node) as b")
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    rest = materialized(rest)
    del x, y
    free_shuffles(docs.sparkSession)
    more = _verified(rest, nodes, docs, percent)
    if more.limit(1).count():
        roots = components(links.union(more))

    member = nodes.join(roots, "node", "left").select(
        "node", "doc_id", "copies", F.coalesce("root", "node").alias("root")
    )
    least = member.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.sum("copies").alias("rows")
    )
    # only rows that share a component need to look theirs up
    shared = materialized(
        member.join(least.where("rows > 1"), "root").select("node", "root", "component_id")
    )
    return rows.drop("profile"), shared


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Null and empty texts, and texts of white space alone, have no shingles and
    link with nothing; a row with a null doc_id links with nothing and has a null
    component. Equal rows are in one component. A very long text is held whole in
    one task. An empty table gives no rows; other columns are not read.
    """
    rows, shared = _membership(docs, percent)
    shared = shared.select(F.col("node").alias("_node"), "component_id")
    return rows.join(
        shared, (F.col("node") == F.col("_node")) & F.col("doc_id").isNotNull(), "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row, with all its columns, of each component of ``docs``: that of the
    smallest doc_id, of several texts of this id the one with the smallest hash.

    Rows are dropped by doc_id and text, so a text that links with nothing stays
    whatever else its doc_id stands for. Of equal rows one stays, of rows with one
    id and text that differ in other columns any one. Rows without words, which are
    in no component, and rows with a null doc_id all stay.
    """
    rows, shared = _membership(docs, percent)
    inside = materialized(
        rows.where("doc_id is not null").join(shared, "node").select("root", "doc_id", "copy")
    )
    # the smallest id of each component, then the smallest hash of its texts
    first = inside.groupBy("root").agg(F.min("doc_id").alias("first_id"))
    best = inside.join(first, "root").where("doc_id = first_id")
    best = best.groupBy("root", "first_id").agg(F.min("copy").alias("first_copy"))
    judged = inside.join(best, "root")
    gone = materialized(
        judged.where("doc_id <> first_id or copy <> first_copy")
        .select(F.col("doc_id").alias("_gone"), F.col("copy").alias("_copy"))
        .distinct()
    )
    twice = materialized(
        judged.where("doc_id = first_id and copy = first_copy")
        .groupBy(F.col("doc_id").alias("_twice"), F.col("copy").alias("_copy"))
        .count()
        .where("count > 1")
    )
    # the texts of most rows, which neither table names, are not shuffled
    named = gone.union(twice.select("_twice", "_copy"))
    likely = likely_among(named, docs["doc_id"], _copy_of(docs))
    near = docs.where(likely)
    same = (near["doc_id"] == gone["_gone"]) & (_copy_of(near) == gone["_copy"])
    near = near.join(gone, same, "left_anti")
    if twice.limit(1).count():
        same = (near["doc_id"] == twice["_twice"]) & (_copy_of(near) == twice["_copy"])
        number = F.row_number().over(Window.partitionBy("doc_id", _copy_of(near)).orderBy("doc_id"))
        place = next(n for n in ("_place", "_place_") if n not in docs.columns)
        one = near.join(twice, same, "left_semi").withColumn(place, number)
        one = one.where(F.col(place) == 1).drop(place)
        near = near.join(twice, same, "left_anti").unionByName(one)
    return docs.where(~likely).unionByName(near)


def _copy_of(docs: DataFrame):
    """Rows of one doc_id are told apart by this hash of their text."""
    return F.xxhash64(docs["text"].cast("string"))

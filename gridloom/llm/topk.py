"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates lie in blocks of bounded size. Each block holds, for every dimension,
the order of its members by falling value: the sorted lists. A query reads the
lists from the end its own coordinate asks for, a step of depth at a time in all
dimensions, scores what it meets for the first time in full, and adds up the
values at the depth reached: no member not yet met can score more. It stops when
that bound lies below the kth best score known.

What is known at the start is shared: a first pass reads only the heads of all
lists of all blocks, and the kth score it finds for a query over all blocks is
the floor of its second pass, so most blocks are left after a look at their
first entries. Queries go in rounds of bounded bytes, each broadcast; candidates
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.ordering import with_running_total
from gridloom.llm.vectors import EXACT, dims_of, floored, in_blocks, usable
from gridloom.session import materialized, scratch_folder

SCALE = 256
EVERY = 50  # rows whose key this divides are queries
K = 5
HEADS = 4  # entries of each list read by the first pass
QUERY_BYTES = 32 << 20  # of queries in one round, broadcast
WIDE = 1 << 62  # sums from here on are not left to 64 bits
_NONE = np.iinfo(np.int64).min  # floor of a query nothing is known of
_LISTS = "uids binary, ids array<long>, x binary, ranks binary"
_FOUND = "query long, query_id long, vec_id long, score long"


def sorted_lists(others: list, x: np.ndarray) -> dict:
    """A block: members, their vectors, and for each dimension their order by
    falling value (ties in any order)."""
    uid, ids = others
    ranks = np.argsort(-x, axis=0, kind="stable").T.astype("<i4")
    return {
        "uids": uid.to_numpy().astype("<i8").tobytes(),
        "ids": ids.to_pylist(),
        "x": x.astype("<i8").tobytes(),
        "ranks": np.ascontiguousarray(ranks).tobytes(),
    }


def _depths(members: int, limit: int | None) -> list[int]:
    steps, depth = [], 1
    while depth < members:
        steps.append(depth)
        depth *= 4
    steps.append(members)
    return [s for s in steps if s <= limit] or [min(limit, members)] if limit else steps


class Block:
    """Sorted lists of one block, for queries of the same dimensions."""

    def __init__(self, row: dict, dims: int, limit: int | None):
        self.uids = np.frombuffer(row["uids"], "<i8")
        n = len(self.uids)
        # a missing key comes after all others
        self.missing = np.array([i is None for i in row["ids"]])
        self.ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
        self.x = np.frombuffer(row["x"], "<i8").reshape(n, dims)
        self.ranks = np.frombuffer(row["ranks"], "<i4").reshape(dims, n)
        self.depths = _depths(n, limit)
        self.most = int(np.abs(self.x).max(initial=0))
        each = np.arange(dims)
        cut = np.array([1, *self.depths])
        # values at each depth of the lists, read from the top and from the end
        self.top = self.x[self.ranks[:, cut - 1], each[:, None]]
        self.end = self.x[self.ranks[:, n - cut], each[:, None]]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """What a member not met above each depth can score at most: a row for
        each query; the first column is for members not looked for at all."""
        top, end = self.top, self.end
        if self.most * int(np.abs(queries).max(initial=0)) * len(top) >= WIDE:
            top, end = top.astype(object), end.astype(object)
        return np.maximum(queries, 0) @ top + np.minimum(queries, 0) @ end

    def search(self, q, own: int, bounds, floor: int, k: int, scores_of) -> tuple:
        """The best ``k`` members that score ``floor`` or more, as (scores,
        positions), and how many members were scored."""
        scores, at = np.empty(0, np.int64), np.empty(0, np.int64)
        met = np.zeros(len(self.uids), bool)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        kth, before = floor, 0
        if bounds[0] < kth:
            return scores, at, 0
        if not len(up) and not len(down):  # all score 0, no list says more
            up = np.arange(1)
        n = len(self.uids)
        for depth, bound in zip(self.depths, bounds[1:]):
            new = np.zeros(n, bool)
            new[self.ranks[up, before:depth].ravel()] = True
            new[self.ranks[down, n - depth : n - before].ravel()] = True
            new &= ~met
            met |= new
            before = depth
            fresh = np.flatnonzero(new)
            fresh = fresh[self.uids[fresh] != own]
            found = scores_of(self.x[fresh], q)
            good = found >= kth
            scores = np.concatenate([scores, found[good]])
            at = np.concatenate([at, fresh[good]])
            best = np.lexsort((self.ids[at], self.missing[at], -scores))[:k]
            scores, at = scores[best], at[best]
            if len(scores) == k:
                kth = max(kth, int(scores[-1]))
            if bound < kth:
                break
        return scores, at, int(met.sum())


def _scorer(most: int, queries: np.ndarray, dims: int):
    """Exact inner products: by doubles where they hold all sums, else by longs, else
    by whole numbers of any size."""
    sums = most * int(np.abs(queries).max(initial=0)) * max(dims, 1)
    if sums < EXACT:
        return lambda x, q: (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if sums < WIDE:
        return lambda x, q: x @ q
    # NumPy refuses a score beyond 64 bits
    return lambda x, q: (x.astype(object) @ q.astype(object)).astype(np.int64)


def _searched(lists: DataFrame, shared, dims: int, k: int, limit: int | None) -> DataFrame:
    """The best ``k`` members for each query of a round, over each task's blocks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids, keys, queries, floors = shared.value
        best = [(np.empty(0, np.int64),) * 3 for _ in uids]  # scores, missing, ids
        floors = floors.copy()
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, dims, limit)
                scores_of = _scorer(max(block.most, 1), queries, dims)
                bounds = block.bounds(queries)
                for n, q in enumerate(queries):
                    scores, at, _ = block.search(q, uids[n], bounds[n], floors[n], k, scores_of)
                    if not len(at):
                        continue
                    held = best[n]
                    both = [
                        np.concatenate([held[0], scores]),
                        np.concatenate([held[1], block.missing[at]]),
                        np.concatenate([held[2], block.ids[at]]),
                    ]
                    order = np.lexsort((both[2], both[1], -both[0]))[:k]
                    best[n] = tuple(c[order] for c in both)
                    if len(order) == k:
                        floors[n] = max(floors[n], best[n][0][-1])
        sizes = [len(b[0]) for b in best]
        if sum(sizes):
            scores, missing, ids = (np.concatenate(c) for c in zip(*best))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(uids, sizes)),
                    pa.array(np.repeat(keys, sizes)),
                    pa.array(ids, mask=missing.astype(bool)),
                    pa.array(scores),
                ],
                names=["query", "query_id", "vec_id", "score"],
            )

    found = lists.mapInArrow(search, _FOUND)
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(f"rank <= {k}")


def top_inner_products(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best other rows of each
    row whose key is divisible by ``every``.

    Entries count as floor(scale * x); the score is their inner product, exact.
    Ties go to the smaller key, a null key last. Vectors that are null or hold
    null or non-finite entries take no part; missing last entries of a shorter
    vector, and an empty one, count as 0. Rows of one key are rows of their own:
    each is a query and a candidate of the others, and equal rows are all
    candidates. With fewer than ``k`` other rows all are returned; an empty table
    gives no rows. Other columns are not read, whatever their names. An entry or a
    score too large for whole numbers is an error.
    """
    spark = vectors.sparkSession
    rows = materialized(
        usable(vectors, vector).select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(key).cast("long").alias("vec_id"),
            F.expr(floored(vector, scale)).alias("x"),
        )
    )
    dims = dims_of(rows, "x")
    lists = materialized(in_blocks(rows, dims, _LISTS, sorted_lists))
    asked = with_running_total(rows.where(f"vec_id % {every} = 0"), [F.col("uid")], "place")
    asked = materialized(asked)
    in_round = max(1, query_bytes // (8 * max(dims, 1)))
    out = scratch_folder(spark, "found")
    last = asked.agg(F.max("place")).first()[0]
    schema = f"{_FOUND}, rank int"
    if last is None:
        return spark.createDataFrame([], schema).select("query_id", "rank", "vec_id", "score")
    for start in range(0, last + 1, in_round):
        # at most in_round rows: query_bytes of whole numbers
        part = asked.where(F.col("place").between(start, start + in_round - 1))
        held = part.select("uid", "vec_id", "x").toArrow().combine_chunks()
        uids, keys = held.column(0).to_numpy(), held.column(1).to_numpy()
        queries = np.zeros((len(uids), dims), np.int64)
        for n, x in enumerate(held.column(2).to_pylist()):
            queries[n, : len(x)] = x
        floors = np.full(len(uids), _NONE, np.int64)
        shared = spark.sparkContext.broadcast((uids, keys, queries, floors))
        heads = _searched(lists, shared, dims, k, HEADS).where(f"rank = {k}")
        known = {r["query"]: r["score"] for r in heads.select("query", "score").collect()}
        floors = np.array([known.get(u, _NONE) for u in uids.tolist()], np.int64)
        shared = spark.sparkContext.broadcast((uids, keys, queries, floors))
        _searched(lists, shared, dims, k, None).write.mode("append").parquet(out)
    found = spark.read.schema(schema).parquet(out)
    return found.select("query_id", "rank", "vec_id", "score")

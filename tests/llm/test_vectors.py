"""Top-k search and whitening, on odd rows and against plain NumPy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import topk, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def clashing(frame):
    names = ["uid", "x", "place", "i", "c0", "ids", "rank", "score", "component", "n"]
    return frame.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


@pytest.fixture(scope="module")
def odd(spark):
    """Null keys and vectors, null and non-finite entries, repeats, ties."""
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(6)], k % 3) for k in range(240)]
    rows += [rows[50], rows[50], rows[7], (100, rows[3][1], 0), (100, rows[4][1], 0)]
    rows += [(None, rows[50][1], 1), (500, None, 1), (501, [0.1, None, 0.0, 0.0, 0.0, 0.5], 1)]
    rows += [(550, [float("nan")] * 6, 1), (551, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(600, [0.0] * 6, None), (601, rows[50][1], 2)]
    return clashing(spark.createDataFrame(rows, SCHEMA).repartition(5)), rows


def plain_rows(rows, scale, shift=0):
    good = [(i, v) for i, v, _ in rows if v is not None]
    good = [(i, v) for i, v in good if all(c is not None and np.isfinite(c) for c in v)]
    return [(i, np.floor(scale * np.float32(v).astype(float)).astype(np.int64) + shift) for i, v in good]


def brute_top(rows, k=topk.K):
    data, out = plain_rows(rows, topk.SCALE), []
    for n, (i, q) in enumerate(data):
        if i is None or i % topk.EVERY:
            continue
        found = [(-int(x @ q), j is None, j) for m, (j, x) in enumerate(data) if m != n]
        for rank, (score, _, j) in enumerate(sorted(found)[:k], 1):
            out.append((i, rank, j, -score))
    return out


def as_rows(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


TOP = ["query_id", "rank", "vec_id", "score"]


def test_top_inner_products_equal_all_products(spark, odd, monkeypatch):
    frame, rows = odd
    assert as_rows(topk.top_inner_products(frame), TOP) == sorted(brute_top(rows), key=repr)
    # many small blocks and rounds of two queries
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 1)
    found = topk.top_inner_products(frame, query_bytes=96)
    assert as_rows(found, TOP) == sorted(brute_top(rows), key=repr)


def test_top_of_few_or_no_rows(spark):
    few = [(0, [0.5, -1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1)]
    frame = spark.createDataFrame(few, SCHEMA)
    assert as_rows(topk.top_inner_products(frame), TOP) == sorted(brute_top(few), key=repr)
    for rows in ([], [(0, None, 1)], [(0, [0.5], 1)], [(3, [0.5], 1)]):
        assert topk.top_inner_products(spark.createDataFrame(rows, SCHEMA)).count() == 0
    zero = [(0, [0.0, 0.0], 1), (1, [1.0, 1.0], 1), (None, [1.0, 2.0], 1)]
    frame = spark.createDataFrame(zero, SCHEMA)
    assert as_rows(topk.top_inner_products(frame), TOP) == [(0, 1, 1, 0), (0, 2, None, 0)]


def test_search_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(2)
    x = rng.integers(-30, 30, (2000, 4))
    x[77] = (200, -200, 150, 10)
    row = topk.sorted_lists([_Column(np.arange(2000)), _Column(np.arange(2000))], x)
    block = topk.Block(row, 4, None)
    q = x[77]
    bounds = block.bounds(q[None])[0]
    scores, at, met = block.search(q, 77, bounds, topk._NONE, 5, lambda m, v: m @ v)
    best = np.lexsort((np.arange(2000), -(x @ q)))
    assert at.tolist() == [k for k in best if k != 77][:5]
    assert met < 1500
    # a floor above every bound leaves the block alone
    assert block.search(q, 77, bounds, int(bounds[0]) + 1, 5, None)[2] == 0


class _Column:
    def __init__(self, values):
        self.values = values

    def to_numpy(self):
        return self.values

    def to_pylist(self):
        return self.values.tolist()


def test_wide_entries_are_scored_exactly_or_refused(spark):
    big = [(0, [float(1 << 44), 1.0], 1), (1, [0.0078125, 3.0], 1), (2, [0.0078125, -3.0], 1)]
    frame = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    found = as_rows(topk.top_inner_products(frame), TOP)
    assert found == [(0, 1, 1, (1 << 53) + 3 * 65536), (0, 2, 2, (1 << 53) - 3 * 65536)]
    huge = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        topk.top_inner_products(huge).collect()


WHITE = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain_whitening(rows, components=8):
    data = plain_rows(rows, whitening.SCALE, whitening.SHIFT)
    x = np.array([v for _, v in data])
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    centred = off / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return [i for i, _ in data], n, (off.astype(object) ** 2).sum(axis=1), centred @ axes / np.sqrt(
        values
    ), values / np.trace(cov)


def test_whitening_equals_a_full_decomposition(spark, odd):
    frame, rows = odd
    ids, n, deviation, white, explained = plain_whitening(rows)
    found = whitening.whitened_components(frame, components=4).collect()
    assert len(found) == 4 * n and {r["n"] for r in found} == {n}
    assert max(r["identity_error"] for r in found) < 1e-9
    by_component = {c: [r for r in found if r["component"] == c] for c in range(1, 5)}
    want = sorted(zip(map(repr, ids), deviation.tolist()))
    assert sorted((repr(r["vec_id"]), r["deviation"]) for r in by_component[1]) == want
    for c, part in by_component.items():
        assert part[0]["explained"] == pytest.approx(explained[c - 1], rel=1e-10)
        got = sorted(r["whitened"] for r in part)
        plain = white[:, c - 1]
        error = min(np.abs(got - np.sort(s * plain)).max() for s in (1, -1))
        assert error < 1e-8


def test_filtered_iteration_finds_close_eigenvalues():
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    for values in (
        np.linspace(2, 1, 60),
        np.r_[5, 5, 5, np.linspace(1.01, 1, 57)],
        np.ones(60),
        np.r_[3, 2, 1, np.zeros(57)],
        np.r_[9, np.full(30, 2.0), np.linspace(1, 0.1, 29)],
    ):
        operator = axes * values @ axes.T
        found, q = whitening.top_eigenpairs(lambda m: operator @ m, 60, 8)
        assert np.allclose(found, np.sort(values)[::-1][:8], atol=1e-10)
        assert np.abs(operator @ q - q * found).max() < 1e-8
        assert np.allclose(q.T @ q, np.eye(8), atol=1e-12)


def test_whitening_of_degenerate_tables(spark):
    for rows in (
        [],
        [(1, None, 1), (2, [], 1)],
        [(1, [0.5, 0.25], 1)],
        [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)],
    ):
        frame = spark.createDataFrame(rows, SCHEMA)
        found = whitening.whitened_components(frame)
        assert found.columns == WHITE and found.count() == 0
    # one direction only, a null key, and a vector of another length
    line = [(k, [k / 16, -k / 8], 1) for k in range(5)] + [(None, [0.5, -1.0], 1), (9, [1.0], 1)]
    found = whitening.whitened_components(clashing(spark.createDataFrame(line, SCHEMA))).collect()
    assert len(found) == 6 and {r["component"] for r in found} == {1}
    assert found[0]["explained"] == pytest.approx(1.0)
    assert {r["vec_id"] for r in found} == {0, 1, 2, 3, 4, None}


def test_deviation_beyond_64_bits_is_an_error(spark):
    rows = [(k, [float(1 << 30) * (k % 2)], 1) for k in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="too large|OverflowError"):
        whitening.whitened_components(frame).collect()

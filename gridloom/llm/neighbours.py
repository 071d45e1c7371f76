"""Near-duplicate vectors by NN-descent.

A first neighbour graph comes from the leaves of a few random hyperplane trees.
In rounds, the neighbours and some reverse neighbours of every vector are
compared with each other, and each keeps the nearest it has met. Edges at the
threshold join components. A list that is full of such edges is saturated: it is
enlarged to its whole component, which is read block by block, so links are
counted without being written out. An audit compares a fixed share of the
vectors with all others by brute force and measures recall, vector by vector;
while it is too low, further trees and rounds follow. If it stays too low, all
vectors of a label are compared with each other in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import components, giving_back
from gridloom.session import materialized

THRESHOLD = 0.98
NEIGHBOURS = 10
TREES, LEAF, LEAF_ROWS = 4, 64, 256  # leaves hold about LEAF rows and are split at LEAF_ROWS
ROUNDS = 2
BLOCK = 256  # rows of a block of a component (up to eight times as many) or of the audit
AUDIT_EVERY, RECALL, ATTEMPTS = 50, 0.95, 4
GROUP_ROWS = 16_384  # rows of small groups that a task looks at together
GROUP_SIMS = 1 << 18  # similarities that it holds at once
_EDGE = "src long, dst long, sim double, joined boolean"


def _vectors(rows: DataFrame) -> DataFrame:
    """Distinct usable vectors: node, label, dim, vec (unit length), copies."""
    usable = (
        "label is not null and size(embedding) > 0 and "
        "forall(embedding, x -> x is not null and abs(x) < double('infinity')) and "
        "exists(embedding, x -> x <> 0)"
    )
    distinct = (
        rows.where(usable)
        .groupBy("label", "embedding")
        .agg(F.count("*").alias("copies"), F.max(F.expr(f"vec_id % {AUDIT_EVERY} = 0")).alias("asked"))
        .select(_node(), "label", "embedding", "copies", F.coalesce("asked", F.lit(False)).alias("asked"))
    )

    def unit(batches):
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            flat = np.empty(lengths.sum())
            for _, rows, x in _by_length(batch.column(2)):
                x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares finite
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                flat[np.repeat(np.isin(np.arange(len(lengths)), rows), lengths)] = x.ravel()
            offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths.astype(np.int32)),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)), batch.column(3), batch.column(4)],
                names=["node", "label", "dim", "vec", "copies", "asked"],
            )

    label = dict(rows.dtypes)["label"]
    return distinct.mapInArrow(
        unit,
        f"node long, label {label}, dim int, vec array<double>, copies long, asked boolean",
    )


def _node():
    return F.xxhash64("label", "embedding").alias("node")


def _by_length(vecs: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Every length of the vectors of a list column: its rows, and them as a matrix."""
    lengths = np.diff(vecs.offsets.to_numpy())
    flat = vecs.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    for dim in np.unique(lengths).tolist():
        own = lengths == dim
        x = flat if own.all() else flat[np.repeat(own, lengths)]
        yield dim, np.flatnonzero(own), x.reshape(-1, dim)


def _roots(near: np.ndarray) -> np.ndarray:
    """The first row of every row's component, in each of many small groups."""
    rows = near.shape[1]
    root = np.broadcast_to(np.arange(rows), near.shape[:2])
    while True:
        low = np.minimum(root, np.where(near, root[:, None, :], rows).min(axis=2))
        low = np.take_along_axis(low, low, axis=1)
        if (low == root).all():
            return root
        root = low


def _joins(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """What holds the components of a group together."""
    x, ids = np.stack(pdf["vec"].to_numpy()), pdf["node"].to_numpy()
    root = _roots((x @ x.T >= threshold)[None])[0]
    tied = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"src": ids[root[tied]], "dst": ids[tied], "sim": threshold, "joined": True})


def _meet(
    ids: np.ndarray, x: np.ndarray, there: np.ndarray, worst: np.ndarray, keep: int, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Many small groups of one size at once (group, row, entry), padded with rows that
    are not ``there``: the nearest rows of every row of a group, and the nearest outside
    its own component there, as far as they are nearer than its ``worst``; then (joined)
    what holds the group's components together, at most one row for each of its rows."""
    groups, rows = there.shape
    sims = x @ x.transpose(0, 2, 1)
    sims[np.broadcast_to(~there[:, None, :], sims.shape)] = -2
    sims[:, np.arange(rows), np.arange(rows)] = -2
    near = sims >= threshold
    near &= there[:, :, None]
    root = np.tile(np.arange(rows), (groups, 1))
    some = np.flatnonzero(near.any(axis=(1, 2)))
    if len(some):
        root[some] = _roots(near[some])
    group, row = np.nonzero(there)
    yield from _nearest(ids, group, row, sims[group, row], worst, keep)
    sizes = np.zeros((groups, rows), np.int64)
    np.add.at(sizes, (group, root[group, row]), 1)
    own = there & (np.take_along_axis(sizes, root, axis=1) > 1)
    group, row = np.nonzero(own)
    if len(group):
        outside = np.where(root[group] == root[group, row][:, None], -2, sims[group, row])
        yield from _nearest(ids, group, row, outside, worst, keep)
    group, row = np.nonzero(there & (root != np.arange(rows)))
    if len(group):
        src, dst = ids[group, root[group, row]], ids[group, row]
        yield src, dst, np.full(len(src), float(threshold)), True


def _nearest(ids, group, row, sims, worst, keep: int):
    """The ``keep`` nearest of each row, as far as they are nearer than its worst."""
    k = min(keep, sims.shape[1] - 1)
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    sim = np.take_along_axis(sims, at, axis=1)
    each, place = np.nonzero((sim > -2) & (sim > worst[group, row][:, None]))
    if len(each):
        group, row = group[each], row[each]
        yield ids[group, row], ids[group, at[each, place]], sim[each, place], False


def _met(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """What meets inside the groups of ``keys``, which are small: node, vec, and worst,
    where a row wants nearer ones only. Rows of a group lie together, and a task looks
    at many groups at once."""
    if "worst" not in rows.columns:
        rows = rows.withColumn("worst", F.lit(-2.0))

    def meet(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        nodes, worst = (table.column(c).to_numpy() for c in ("node", "worst"))
        sizes = np.diff(np.append(starts, table.num_rows))
        found = []
        for _, mine, x in _by_length(table.column("vec").combine_chunks()):
            place = np.zeros(table.num_rows, np.int64)
            place[mine] = np.arange(len(mine))
            own = np.isin(starts, mine) & (sizes > 1)  # the vectors of a group are of one length
            padded = np.where(own, -(-sizes // 8) * 8, 0)
            for wide in np.unique(padded[own]).tolist():
                groups = np.flatnonzero(padded == wide)
                step = max(1, GROUP_SIMS // (wide * wide))
                for lo in range(0, len(groups), step):
                    some = groups[lo : lo + step]
                    there = np.arange(wide) < sizes[some][:, None]
                    at = starts[some][:, None] + np.where(there, np.arange(wide), 0)
                    some_x = x[place[at]]
                    found += _meet(nodes[at], some_x, there, worst[at], NEIGHBOURS, threshold)
        for src, dst, sim, joined in found:
            tied = pa.array(np.full(len(src), joined))
            yield pa.RecordBatch.from_arrays(
                [pa.array(src), pa.array(dst), pa.array(sim), tied], names=["src", "dst", "sim", "joined"]
            )

    dealt = rows.select(*keys, "node", "vec", "worst").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(giving_back(_in_groups(keys, meet)), _EDGE)


def _in_groups(
    keys: list[str], body: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow body over rows sorted by ``keys``: ``body`` gets about GROUP_ROWS rows
    of whole groups, and where each group starts."""

    def starts_of(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for key in keys:
            codes = table.column(key).combine_chunks().dictionary_encode().indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        return np.flatnonzero(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < GROUP_ROWS:
                continue
            table = pa.Table.from_batches(held)
            starts = starts_of(table)
            if len(starts) > 1:  # the last group may go on
                yield from body(table.slice(0, starts[-1]), starts[:-1])
                table = table.slice(starts[-1])
            held, rows = table.to_batches(), table.num_rows
        if held:
            table = pa.Table.from_batches(held)
            yield from body(table, starts_of(table))

    return run


def _from_trees(vectors: DataFrame, seed: int, threshold: float) -> DataFrame:
    """What meets inside the leaves of TREES trees."""
    sizes = vectors.groupBy("label", "dim").agg(F.count("*").alias("rows"))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("rows") / LEAF))).cast("int")
    sized = vectors.join(sizes, ["label", "dim"]).withColumn("depth", depth)

    def place(batches):
        planes: dict = {}
        for batch in batches:
            depth = batch.column(2).to_numpy()
            leaf = np.zeros((batch.num_rows, TREES), np.int64)
            for dim, rows, x in _by_length(batch.column(1)):
                cut = np.arange(62) < depth[rows][:, None]
                for t in range(TREES):
                    if (dim, t) not in planes:
                        rng = np.random.default_rng([seed, t, dim])
                        planes[dim, t] = rng.standard_normal((62, dim))
                    leaf[rows, t] = ((x @ planes[dim, t].T > 0) & cut) @ (1 << np.arange(62))
            take = pa.array(np.repeat(np.arange(batch.num_rows), TREES))
            tree = np.tile(np.arange(TREES, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(take) for k in (0, 1, 3, 4)),
                 pa.array(tree), pa.array(leaf.ravel())],
                names=["node", "vec", "label", "dim", "tree", "leaf"],
            )

    label = dict(vectors.dtypes)["label"]
    placed = sized.select("node", "vec", "depth", "label", "dim").mapInArrow(
        place, f"node long, vec array<double>, label {label}, dim int, tree int, leaf long"
    )
    leaves = ["label", "dim", "tree", "leaf"]
    counted = placed.groupBy(*leaves).agg(F.count("*").alias("rows"))
    part = F.expr(f"pmod(xxhash64(node, tree, {seed}), cast(ceil(rows / {LEAF_ROWS}) as bigint))")
    parted = placed.join(counted, leaves).withColumn("part", part)
    return _met(parted, [*leaves, "part"], threshold)


def _top(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The nearest of every vector, and the nearest outside its component (out): a
    list full of its own component still leads elsewhere."""
    best = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    for end in ("src", "dst"):
        best = best.join(roots.selectExpr(f"node as {end}", f"root as {end}_root"), end, "left")
    best = best.selectExpr(
        "src", "dst", "sim", "coalesce(src_root, src) <> coalesce(dst_root, dst) as out"
    )
    return _best_of(best, "src", "dst")


def _best_of(edges: DataFrame, own: str, other: str) -> DataFrame:
    order = [F.desc("sim"), other]
    rank = F.row_number().over(Window.partitionBy(own).orderBy(*order))
    far = F.row_number().over(Window.partitionBy(own, "out").orderBy(*order))
    ranked = edges.withColumns({"rank": rank, "far": far})
    kept = f"rank <= {NEIGHBOURS} or out and far <= {NEIGHBOURS}"
    return ranked.where(kept).drop("rank", "far")


def _refined(graph: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """One round: what the members of every vector's neighbourhood are to each
    other, as far as it can enter a list, and what joins them."""
    reverse = _best_of(graph, "dst", "src")
    members = (
        graph.selectExpr("src as pivot", "dst as node")
        .union(reverse.selectExpr("dst as pivot", "src as node"))
        .union(graph.selectExpr("src as pivot", "src as node"))
        .distinct()
    )
    worst = graph.groupBy(F.col("src").alias("node")).agg(
        F.expr(f"if(count_if(out) < {NEIGHBOURS}, -2D, min(sim))").alias("worst")
    )
    met = members.join(vectors.select("node", "vec").join(worst, "node"), "node")
    return _met(met, ["pivot"], threshold)


def _grown(roots: DataFrame | None, met: DataFrame) -> tuple[DataFrame, bool]:
    """The components after the joins of ``met``, and whether any of them is new."""
    joins = met.where("joined").selectExpr("src as a", "dst as b").distinct()
    if roots is not None:
        for end in "ab":
            held = roots.selectExpr(f"node as {end}", "root")
            joins = joins.join(held, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        joins = materialized(joins.where("a <> b").select("a", "b").distinct())
        if not joins.limit(1).count():
            return roots, False
        joins = joins.union(roots.select("node", "root"))
    return components(joins), True


def _links_in_components(
    vectors: DataFrame, roots: DataFrame, threshold: float
) -> DataFrame:
    """node and linked: rows other than its copies within the threshold, counted
    by comparing blocks of each component. Only counts leave a comparison."""
    rows = vectors.join(roots, "node").select("node", "root", "vec", "copies")
    # a vector is copied once for each block: larger blocks where a component is large
    size = f"greatest({BLOCK}, least({8 * BLOCK}, count(*) / 16))"
    sizes = roots.groupBy("root").agg(F.expr(f"cast(ceil(count(*) / {size}) as int)").alias("blocks"))
    blocked = rows.join(sizes, "root").withColumn("own", F.expr("pmod(xxhash64(node), blocks)"))
    pairs = blocked.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr(
        "root", "least(own, other) as i", "greatest(own, other) as j", "own", "node", "vec", "copies"
    )

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        x, y = pdf[pdf["own"] == i], pdf[pdf["own"] == j]
        if not len(x) or not len(y):
            return pd.DataFrame({"node": [], "linked": []})
        near = np.stack(x["vec"].to_numpy()) @ np.stack(y["vec"].to_numpy()).T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
            return pd.DataFrame({"node": x["node"], "linked": near @ y["copies"].to_numpy()})
        return pd.DataFrame({
            "node": np.concatenate([x["node"], y["node"]]),
            "linked": np.concatenate([near @ y["copies"].to_numpy(), near.T @ x["copies"].to_numpy()]),
        })

    counted = pairs.groupBy("root", "i", "j").applyInPandas(count, "node long, linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def _blocked(vectors: DataFrame, rows: int) -> DataFrame:
    """The vectors with block and blocks: blocks of about ``rows`` rows of a label."""
    sizes = vectors.groupBy("label", "dim").agg(
        F.expr(f"cast(ceil(count(*) / {rows}) as int)").alias("blocks")
    )
    block = F.expr("cast(pmod(xxhash64(node), blocks) as int)")
    return vectors.join(sizes, ["label", "dim"]).withColumn("block", block)


def _true_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """node and true_links of the asked vectors against all rows of their label;
    blocks of asked vectors meet blocks of rows."""
    keys = ["label", "dim", "block", "part"]
    asked = _blocked(vectors.where("asked"), 8 * BLOCK).withColumnsRenamed(
        {"block": "part", "blocks": "parts"}
    )
    parts = asked.groupBy("label", "dim").agg(F.max("parts").alias("parts"))
    sized = _blocked(vectors, 8 * BLOCK)
    rows = sized.join(parts, ["label", "dim"]).withColumn(
        "part", F.explode(F.expr("sequence(0, parts - 1)"))
    ).select(*keys, "node", "vec", "copies")
    blocks = sized.groupBy("label", "dim").agg(F.max("blocks").alias("blocks"))
    asked = asked.join(blocks, ["label", "dim"]).withColumn(
        "block", F.explode(F.expr("sequence(0, blocks - 1)"))
    ).selectExpr(*[f"{c} as q_{c}" for c in keys], "node as q_node", "vec as q_vec")

    def count(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"node": [], "true_links": []})
        all_, copies = np.stack(r["vec"].to_numpy()), r["copies"].to_numpy()
        totals = []
        for at in range(0, len(q), BLOCK):  # blocks of questions
            part = q.iloc[at : at + BLOCK]
            near = np.stack(part["q_vec"].to_numpy()) @ all_.T >= threshold
            near &= part["q_node"].to_numpy()[:, None] != r["node"].to_numpy()[None, :]
            totals.append(near @ copies)
        return pd.DataFrame({"node": q["q_node"].to_numpy(), "true_links": np.concatenate(totals)})

    counted = asked.groupBy(*[f"q_{c}" for c in keys]).cogroup(rows.groupBy(*keys)).applyInPandas(
        count, "node long, true_links long"
    )
    return counted.groupBy("node").agg(F.sum("true_links").alias("true_links"))


def _recall(truth: DataFrame, links: DataFrame) -> float:
    """The share of asked vectors with links whose links are all found: of all of
    them, or of those with at most NEIGHBOURS links, whichever is less. One vector
    counts as much as another, whatever its group; 1 without any."""
    whole = F.expr("coalesce(linked, 0) = true_links").cast("double")
    few = F.when(F.col("true_links") <= NEIGHBOURS, whole)
    shares = truth.where("true_links > 0").join(links, "node", "left").agg(F.avg(whole), F.avg(few))
    return min((x for x in shares.first() if x is not None), default=1.0)


def _all_joins(vectors: DataFrame, threshold: float) -> DataFrame:
    """What holds the components together, from comparing all vectors of a label
    with each other in blocks. Exact; its work grows with the square of a label."""
    pairs = (
        _blocked(vectors, 4 * BLOCK)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .selectExpr("label", "dim", "least(block, other) as i", "greatest(block, other) as j",
                    "node", "vec")
    )
    return pairs.groupBy("label", "dim", "i", "j").applyInPandas(
        lambda pdf: _joins(pdf, threshold), _EDGE
    )


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept, audit_recall of every row.

    Vectors link only within one label and length. Null, empty and zero vectors,
    vectors with null or non-finite components and rows without a label link with
    nothing: n_links 0 and a component of their own. Equal vectors are links of
    each other, repeated rows too. A null vec_id is never a component's name;
    its row is kept only if nothing else is in the component. audit_recall is,
    over every fiftieth vec_id, the share of vectors whose links were all found (1
    without any), or that share among those with few links, if it is less.
    """
    rows = rows.select(F.col("vec_id").cast("long"), "label", "embedding")
    vectors = materialized(_vectors(rows))
    truth = materialized(_true_links(vectors, threshold))
    graph = roots = None
    for attempt in range(ATTEMPTS):
        met = materialized(_from_trees(vectors, attempt, threshold))
        roots, _ = _grown(roots, met)
        rounds, grown = 0, True
        while rounds < ROUNDS or grown:  # on until a round joins nothing more
            rounds += 1
            edges = met.where("not joined").select("src", "dst", "sim")
            edges = edges.union(graph.select(edges.columns)) if graph is not None else edges
            graph = materialized(_top(edges, roots))
            met = materialized(_refined(graph, vectors, threshold))
            roots, grown = _grown(roots, met)
        links = materialized(_links_in_components(vectors, roots, threshold))
        recall = _recall(truth, links)
        if recall >= RECALL:
            break
    else:  # nothing else will do
        roots, _ = _grown(roots, materialized(_all_joins(vectors, threshold)))
        links = materialized(_links_in_components(vectors, roots, threshold))
        recall = _recall(truth, links)

    keyed = rows.withColumn("node", _node())
    member = (
        vectors.select("node", "copies")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"),
                (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        .where("n_links > 0")
        .withColumnRenamed("node", "_node")
    )
    least = (
        keyed.select("node", "vec_id").join(member, F.col("node") == F.col("_node"))
        .groupBy(F.col("root").alias("_root")).agg(F.min("vec_id").alias("least"))
    )
    named = member.join(least, F.col("root") == F.col("_root")).select("_node", "n_links", "least")
    component = F.coalesce("least", "vec_id")
    return keyed.join(named, F.col("node") == F.col("_node"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
        F.lit(recall).alias("audit_recall"),
    )

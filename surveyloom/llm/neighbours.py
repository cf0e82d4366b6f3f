"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors are one node, so copies cannot crowd a neighbour list. A node's list
holds the vectors of largest inner product with its direction, the order a query
asks for, so vectors of very different lengths need no common scale. The graph
starts from lists made within random half-space cells; each round, every node
gathers the vectors of its neighbours and of the reverse neighbours nearest in
direction in one join, compares those that have not met there before, and sends
each the best that can enter its list. Rounds end when the lists have all but
stopped to improve.

A query starts from its own node's list and some fixed nodes, and expands the
best unexpanded nodes of its list, hop by hop, until none is left to expand.
Graph work uses vectors rounded to 16 bits, each on a scale of its own; what a
query finds is scored on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.functions import cut_lineage, quote

#: Neighbours of a node; members compared around a node; best partners sent to each member.
DEGREE, GATHERED, SENT = 40, 80, 12
#: Points of a starting cell that are compared, and starting partitions.
CELL, TRIALS = 96, 4
#: Nodes or queries whose work goes to Python in one group.
SLOT = 64


def top(df: DataFrame, by: str, k: int, *order) -> DataFrame:
    """The first ``k`` rows of each ``by``; Spark cuts groups before the shuffle, so none grows."""
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(f"rank_ <= {k}").drop("rank_")


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): finite, non-zero vectors of the table's most common length."""
    rows = vectors.select(quote(vec_id).cast("long").alias("vec_id"), quote(embedding).alias("v"))
    finite = "v is not null and vec_id is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf')) and exists(v, x -> x <> 0)"
    rows = rows.where(finite)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (length[0].n if length else 0))


def rounded(v: np.ndarray) -> list[bytes]:
    """Vectors as 16-bit integers, after the float that they are multiples of."""
    scale = (np.maximum(np.abs(v).max(axis=1, initial=0), 1e-30) / 32_767).astype(np.float32)
    codes = np.round(v / scale[:, None].astype(np.float64)).clip(-32_767, 32_767).astype(np.int16)
    return [a.tobytes() + c.tobytes() for a, c in zip(scale, codes)]


def matrix(column) -> np.ndarray:
    raw = np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)
    scale, codes = raw[:, :4].copy().view(np.float32), raw[:, 4:].copy().view(np.int16)
    return codes * scale


def directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=-1, keepdims=True).clip(1e-30)  # squares of very short vectors would be zero
    return x / np.linalg.norm(x, axis=-1, keepdims=True).clip(1e-30)


def short_form(nodes: DataFrame, longest: float, dims: int) -> DataFrame:
    """(node, q): rounded vectors, the longest of length one."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims) / longest
            yield pa.record_batch([batch.column(0), pa.array(rounded(v), pa.binary())], ["node", "q"])

    return nodes.select("node", "v").mapInArrow(code, "node long, q binary")


def starting_lists(points: DataFrame, n: int, dims: int, seed: int) -> DataFrame:
    """(node, nbr, s): the best of each random cell. Cells that hold more than CELL points are dealt by hash."""
    bits = max(0, int(np.ceil(np.log2(max(1, n / (CELL // 2))))))
    planes = np.random.default_rng(seed).standard_normal((TRIALS, bits, dims)).astype(np.float32)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims)
        for batch in batches:
            if batch.num_rows:
                total += directions(matrix(batch.column(1).to_pylist())).sum(axis=0, dtype=np.float64)
        yield pa.record_batch([pa.array(np.arange(dims)), pa.array(total)], ["i", "total"])

    # Cells part around the mean direction, or vectors that all lean one way would share a cell.
    sums = points.mapInArrow(add, "i long, total double").groupBy("i").agg(F.sum("total")).collect()
    middle = np.array([t / n for _, t in sorted(tuple(r) for r in sums)], np.float32)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = directions(matrix(batch.column(1).to_pylist())) - middle if batch.num_rows else np.zeros((0, dims), np.float32)
            for t in range(TRIALS):
                code = ((x @ planes[t].T > 0) @ (1 << np.arange(bits))).astype(np.int64) if bits else np.zeros(len(x), np.int64)
                yield pa.record_batch([pa.array(code * TRIALS + t), *batch.columns], ["cell", "node", "q"])

    placed = points.mapInArrow(cells, "cell long, node long, q binary")
    sizes = placed.groupBy("cell").count().select("cell", F.ceil(F.col("count") / CELL).alias("parts"))
    dealt = placed.join(sizes, "cell").withColumn("part", F.expr("pmod(xxhash64(node), parts)"))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        found = best_pairs(pdf["node"].to_numpy(), matrix(pdf["q"]), DEGREE // 2)
        return pd.DataFrame(dict(zip(("node", "nbr", "s"), found)))

    return dealt.groupBy("cell", "part").applyInPandas(best, "node long, nbr long, s float")


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys together, and the edges of their runs."""
    order = np.argsort(keys, kind="stable")
    return order, np.append(np.flatnonzero(np.diff(keys[order], prepend=keys[order[0]] - 1)), len(keys))


def best_pairs(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, nbr, s): for each row its ``k`` best other rows. Callers bound the number of rows."""
    k = min(k, len(ids) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    s = directions(x) @ x.T
    np.fill_diagonal(s, -np.inf)
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(s, near, 1).ravel()


def fresh_pairs(
    edges: np.ndarray, ids: np.ndarray, x: np.ndarray, fresh: np.ndarray, worst: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, nbr, s): for each member of a run its ``k`` best others that are new to it.

    Runs lie between ``edges`` and have at most GATHERED rows. Two members that
    both stood around the centre in an earlier round were compared then; a
    partner below the receiver's ``worst`` could not enter its list.
    """
    sizes = np.diff(edges)
    run, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(ids)) - np.repeat(edges[:-1], sizes)
    shape = (len(sizes), int(sizes.max()))
    rows = np.zeros(shape, np.int64)
    rows[run, place] = np.arange(len(ids))
    real = np.arange(shape[1]) < sizes[:, None]
    around = x[rows]
    s = directions(around) @ around.transpose(0, 2, 1)
    new = fresh[rows]
    s[~((new[:, :, None] | new[:, None, :]) & real[:, :, None] & real[:, None, :])] = -np.inf
    s[:, np.arange(shape[1]), np.arange(shape[1])] = -np.inf
    k = min(k, shape[1])
    near = np.argpartition(-s, k - 1, axis=2)[:, :, :k]
    best = np.take_along_axis(s, near, 2)
    at = np.nonzero((best >= worst[rows][:, :, None]) & (best > -np.inf))
    return ids[rows[at[0], at[1]]], ids[rows[at[0], near[at]]], best[at]


def nn_descent(points: DataFrame, n: int, dims: int, *, rounds: int = 10, settled: float = 0.001, seed: int = 42) -> DataFrame:
    """(node, nbr, s): the neighbour graph, DEGREE edges a node."""
    order = (F.desc("s"), "nbr")
    first = top(starting_lists(points, n, dims, seed).distinct(), "node", DEGREE, *order)
    graph = cut_lineage(first.withColumn("fresh", F.lit(True)))
    before = graph.agg(F.count("*"), F.sum("s")).first()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        order, edges = runs(pdf["centre"].to_numpy())
        pdf = pdf.iloc[order]
        found = fresh_pairs(
            edges, pdf["member"].to_numpy(), matrix(pdf["q"]), pdf["fresh"].to_numpy(), pdf["worst"].to_numpy(), SENT
        )
        return pd.DataFrame(dict(zip(("node", "nbr", "s"), found)))

    slots = max(1, n // SLOT)

    for _ in range(rounds):
        listed = graph.select(F.col("node").alias("centre"), F.col("nbr").alias("member"), "fresh")
        # Among those that list a centre, s orders by the angle to it; a long vector stands in very many lists.
        asking = graph.select(F.col("nbr").alias("centre"), F.col("node").alias("member"), "s", "fresh")
        asking = top(asking, "centre", GATHERED - DEGREE, F.desc("s"), "member").drop("s")
        gathered = listed.unionByName(asking).groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
        # Around a centre without a new member all pairs have been compared.
        news = F.max("fresh").over(Window.partitionBy("centre"))
        gathered = gathered.withColumn("news", news).where("news").select("centre", "member", "fresh")
        # What a node's list ends with: nothing below it is worth sending. A list that is not full takes anything.
        worst = graph.groupBy("node").agg(F.when(F.count("*") >= DEGREE, F.min("s")).alias("worst"))
        members = points.join(worst, "node", "left").select(
            F.col("node").alias("member"), "q", F.coalesce("worst", F.lit(float("-inf")).cast("float")).alias("worst")
        )
        found = (
            gathered.join(members, "member")
            .groupBy(F.expr(f"pmod(xxhash64(centre), {slots})"))
            .applyInPandas(compare, "node long, nbr long, s float")
        )
        aged = graph.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True)))
        merged = aged.groupBy("node", "nbr").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
        graph = cut_lineage(top(merged, "node", DEGREE, *order))
        after = graph.agg(F.count("*"), F.sum("s")).first()
        # The sums of all lists have all but stopped to rise.
        if before[1] is None or after[1] - before[1] <= settled * abs(after[1]) and after[0] == before[0]:
            break
        before = after
    return graph.drop("fresh")


def graph_search(graph: DataFrame, points: DataFrame, queries: DataFrame, seeds: list[int], *, slots: int, keep: int, hops: int, wide: int) -> DataFrame:
    """(query, node): the ``keep`` best nodes of each query that greedy search meets.

    ``queries`` has (query, node, qq): the query's own node and its rounded vector.
    """

    def score(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "node": [], "s": []})
        left = left.sort_values("by")
        asked = matrix(left["qq"])[np.searchsorted(left["by"].to_numpy(), right["asker"].to_numpy())]
        s = np.einsum("ij,ij->i", matrix(right["q"]), asked)
        return pd.DataFrame({"query": right["asker"], "node": right["node"], "s": s})

    def scored(candidates: DataFrame) -> DataFrame:
        with_points = candidates.selectExpr("query as asker", "node").join(points, "node")
        own = queries.select(F.col("query").alias("by"), "qq")
        slot = lambda c: F.expr(f"pmod(xxhash64({c}), {slots})")  # noqa: E731  queries of a slot go to Python together
        return own.groupBy(slot("by")).cogroup(with_points.groupBy(slot("asker"))).applyInPandas(
            score, "query long, node long, s float"
        )

    own = queries.select("query", "node")
    start = own.join(graph.select("node", "nbr"), "node").selectExpr("query", "nbr as node").unionAll(own)
    if seeds:
        fixed = F.explode(F.array(*map(F.lit, seeds))).alias("node")
        start = start.unionAll(queries.select("query", fixed))
    beam = cut_lineage(top(scored(start.distinct()), "query", keep, F.desc("s"), "node").withColumn("open", F.lit(True)))
    for _ in range(hops):
        now = top(beam.where("open"), "query", wide, F.desc("s"), "node").select("query", "node")
        if now.isEmpty():
            break
        met = now.join(graph.select("node", "nbr"), "node").selectExpr("query", "nbr as node").distinct()
        fresh = met.join(beam.select("query", "node"), ["query", "node"], "left_anti")
        closed = beam.join(now.withColumn("now", F.lit(True)), ["query", "node"], "left").selectExpr("query", "node", "s", "open and now is null as open")
        merged = closed.unionByName(scored(fresh).withColumn("open", F.lit(True)))
        beam = cut_lineage(top(merged, "query", keep, F.desc("s"), "node"))
    return beam.select("query", "node")


def nearest(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, k: int = 20,
    keep: int = 128, hops: int = 8, wide: int = 24, seed: int = 42,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose id is divisible by ``every``.

    Nearest first by inner product of the original vectors in double precision,
    ties to the smaller id; a query is no candidate of its own, its copies are.
    Rows with a null id, null, zero or non-finite vectors take no part, nor do
    vectors of another length than most. A repeated id counts as often as it
    stands there, but an id is no candidate of itself.
    """
    rows = usable(vectors, vec_id, embedding).distinct()
    ids = cut_lineage(rows.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    measured = ids.selectExpr("size(v) as dims", "sqrt(aggregate(v, 0D, (a, x) -> a + x * x)) as norm")
    n, dims, longest = measured.agg(F.count("*"), F.max("dims"), F.max("norm")).first()
    found = "query_id long, rank int, vec_id long, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], found)
    points = cut_lineage(short_form(ids, longest, dims))
    graph = nn_descent(points, n, dims, seed=seed)
    member = cut_lineage(rows.join(ids.select("v", "node"), "v").select("node", "vec_id"))
    asked = member.where(f"vec_id % {every} = 0")
    # Long vectors answer many queries: the longest are where every search also begins.
    norms = ids.selectExpr("node", "sqrt(aggregate(v, 0D, (a, x) -> a + x * x)) as norm")
    seeds = [r.node for r in norms.orderBy(F.round("norm", 6).desc(), F.xxhash64("node")).limit(32).collect()]

    def as_query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
            yield pa.record_batch([batch.column(0), pa.array(rounded(directions(v)), pa.binary())], ["node", "qq"])

    # Copies ask once.
    wanted = ids.join(asked.select("node").distinct(), "node").select("node", "v").mapInArrow(as_query, "node long, qq binary")
    queries = cut_lineage(wanted.withColumn("query", F.col("node")))
    reached = graph_search(graph, points, queries, seeds, slots=max(1, n // (every * SLOT)), keep=keep, hops=hops, wide=wide)
    few = top(member, "node", k + 1, "vec_id")  # of a node's copies the k + 1 smallest ids can be an answer
    exact = (
        reached.join(ids.select("node", "v"), "node")
        .join(ids.select(F.col("node").alias("query"), F.col("v").alias("u")), "query")
        .withColumn("score", F.expr("aggregate(zip_with(u, v, (a, b) -> cast(a as double) * cast(b as double)), 0D, (t, x) -> t + x)"))
        .select("query", "node", "score")
    )
    lists = top(exact.join(few, "node").select("query", "vec_id", "score"), "query", k + 1, F.desc("score"), "vec_id")
    # A list per distinct query vector, then one per query without itself.
    answers = asked.select(F.col("node").alias("query"), F.col("vec_id").alias("query_id")).join(lists, "query").where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", place).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")

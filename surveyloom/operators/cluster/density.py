"""DBSCAN over all rows: k-d blocks with an ε margin, then cluster merging.

Copies of a point are collapsed first, with their weight.  The distinct points
are cut into k-d leaves; a point within ε of a leaf also goes there as margin,
so every ε-pair meets in the home leaf of either point, and margin points are
never compared with each other.  Cuts go where they save most work, first of all
into gaps between values, which need no margin.  A leaf larger than a block is
split into chunks, and each pair of chunks is one group, so groups are bounded
however dense a region is.  Groups never emit pairs: first a neighbour weight per
point, then one star per local component and the few core neighbours of border
points.  Distances come from one matrix product; those it cannot tell from ε are
computed term by term.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import complete, cut_lineage, doubles, ident, local_table
from surveyloom.operators.cluster.assign import matrix
from surveyloom.operators.sampling import sample_n

BLOCK_ROWS = 4_096
TREE_SAMPLE = 20_000
#: What sending a row to a leaf costs, in distances; a cut that saves less than this share is not made.
ROW_COST, LEAST_GAIN = 1_000, 0.02


def dbscan_eps(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    neighbours: int = 4,
    percentile: float = 0.01,
    floor: float = 0.5,
    sample: int = 20_000,
    seed: int = 42,
) -> float:
    """Low percentile of the distance to the 4th neighbour, a row counting itself.

    Only the bounded sample is compared with itself: it is broadcast, and each
    task finds the neighbour distances of its own slice.
    """
    names = list(columns)
    rows = sample_n(doubles(df, names, keep=[key]), key, sample, seed=seed)
    points = matrix(rows.toPandas(), names)
    points = points[~np.isnan(points).any(axis=1)]
    if len(points) < neighbours:
        return floor
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(points)

    def kth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = shared.value
        for batch in batches:
            ids = batch["id"].to_numpy()
            out = np.empty(len(ids))
            for s in range(0, len(ids), 256):
                d = _sq_distances(x[ids[s : s + 256]], x)
                out[s : s + 256] = np.partition(d, neighbours - 1, axis=1)[:, neighbours - 1]
            yield pd.DataFrame({"d": np.sqrt(out)})

    slices = max(1, min(4 * spark.sparkContext.defaultParallelism, len(points) // 250))
    d = spark.range(0, len(points), 1, slices).mapInPandas(kth, "d double").agg(F.percentile("d", F.lit(percentile))).first()[0]
    shared.destroy()
    return max(d, floor)


def _sq_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j : j + 1] - b[:, j]
        total += d * d
    return total


def _build_tree(sample: np.ndarray, share: float, eps: float, block: int):
    """Nested (dim, low, high, left, right) over a sample; a leaf is its number.

    Values up to ``low`` lie on the left, from ``high`` on the right. Cuts only
    spread the work; the result does not depend on them. The cost of a leaf is its
    home points times all its points, and the rows sent to it.
    """
    leaves = 0

    def cost(homes, rows):
        n = rows * share
        return homes * share * n + ROW_COST * n * np.ceil(n / block)

    def grow(rows: np.ndarray, home: np.ndarray):
        nonlocal leaves
        best, cut = (1 - LEAST_GAIN) * cost(home.sum(), len(rows)), None
        for dim in range(rows.shape[1]) if len(rows) * share > block else ():
            v, own = np.sort(rows[:, dim]), np.sort(rows[home, dim])
            values = np.unique(own)
            low, high = values[:-1], values[1:]
            if not len(low):
                continue
            h = np.searchsorted(own, low, side="right")
            costs = cost(h, np.searchsorted(v, low + eps, side="right")) + cost(len(own) - h, len(v) - np.searchsorted(v, high - eps))
            if costs.min() < best:
                at = int(costs.argmin())
                best, cut = costs[at], (dim, float(low[at]), float(high[at]))
        if cut is None:
            leaves += 1
            return leaves - 1
        dim, low, high = cut
        v = rows[:, dim]
        to_left, to_right = v <= low + eps, v >= high - eps
        return (*cut, grow(rows[to_left], (home & (v <= low))[to_left]), grow(rows[to_right], (home & (v > low))[to_right]))

    return grow(sample, np.ones(len(sample), dtype=bool)), leaves


def _true_gaps(points: DataFrame, names: list[str], tree):
    """The tree with every ``high`` the least value above ``low`` in all points, not the sample alone."""
    cuts: dict[int, set] = {}

    def note(node):
        if not isinstance(node, int):
            cuts.setdefault(node[0], set()).add(node[1])
            note(node[3])
            note(node[4])

    note(tree)
    if not cuts:
        return tree
    lows = {dim: np.array(sorted(v)) for dim, v in cuts.items()}

    def above(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = {dim: np.full(len(low), np.inf) for dim, low in lows.items()}
        for batch in batches:
            for dim, low in lows.items():
                v = np.append(np.sort(batch[names[dim]].to_numpy(dtype="float64")), np.inf)
                least[dim] = np.minimum(least[dim], v[np.searchsorted(v[:-1], low, side="right")])
        yield pd.concat([pd.DataFrame({"dim": dim, "low": low, "high": least[dim]}) for dim, low in lows.items()])

    found = points.select(*names).mapInPandas(above, "dim int, low double, high double").groupBy("dim", "low").agg(F.min("high"))
    highs = {(r[0], r[1]): r[2] for r in found.collect()}  # one row per cut of the tree

    def mended(node):
        if isinstance(node, int):
            return node
        dim, low, _, left, right = node
        return dim, low, highs[dim, low], mended(left), mended(right)

    return mended(tree)


def _place(x: np.ndarray, tree, eps: float):
    """(row, leaf, home) for each leaf a point lies in or within ε of."""
    found = []

    def walk(node, rows: np.ndarray, home: np.ndarray):
        if not len(rows):
            return
        if isinstance(node, int):
            found.append((rows, np.full(len(rows), node), home))
            return
        dim, low, high, left, right = node
        v = x[rows, dim]
        below = v <= low
        margin = eps * (1 + 1e-9) + 4 * (np.spacing(abs(low)) + np.spacing(eps))  # never short by rounding
        go = v <= low + margin
        walk(left, rows[go], (home & below)[go])
        go = v >= high - margin
        walk(right, rows[go], (home & ~below)[go])

    walk(tree, np.arange(len(x)), np.ones(len(x), dtype=bool))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _blocks(points: DataFrame, names: list[str], eps: float, block: int, seed: int, total: int) -> DataFrame:
    """Points in the chunk pairs of their leaves: (leaf, a, b, chunk, home, pid, w, x…)."""
    sample = matrix(sample_n(points.select("pid", *names), "pid", TREE_SAMPLE, seed=seed).toPandas(), names)
    tree, _ = _build_tree(sample, total / max(len(sample), 1), eps, block)
    tree = _true_gaps(points, names, tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                row, leaf, home = _place(matrix(batch, names), tree, eps)
                yield batch.iloc[row].assign(leaf=leaf.astype("int32"), home=home)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    placed = points.mapInPandas(place, f"{fields}, leaf int, home boolean")
    sizes = placed.groupBy("leaf").count().collect()
    chunks = local_table(
        points.sparkSession, [(r["leaf"], -(-r["count"] // block)) for r in sizes], "leaf int, chunks long"
    )
    return (
        placed.join(F.broadcast(chunks), "leaf")
        .withColumn("chunk", F.expr("pmod(xxhash64(pid), chunks)"))
        .withColumn("other", F.expr("explode(sequence(0L, chunks - 1))"))
        .selectExpr(
            "leaf", "least(chunk, other) as a", "greatest(chunk, other) as b", "chunk", "home", "pid", "w",
            *[ident(c) for c in names],
        )
    )


def _near(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Boolean ε-adjacency, in slabs: √Σ(x−y)² ≤ ε, summed term by term wherever rounding could matter."""
    out = np.empty((len(x), len(y)), dtype=bool)
    if not out.size:
        return out
    centre = y.mean(axis=0)
    p, q = x - centre, np.ascontiguousarray((y - centre).T)
    pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=0)
    reach = (np.sqrt(pp.max()) + np.sqrt(qq.max())) ** 2
    doubt = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (reach + eps * eps)
    rows = max(1, (1 << 20) // len(y))
    for s in range(0, len(x), rows):
        if not doubt < 1e300:
            out[s : s + rows] = np.sqrt(_sq_distances(x[s : s + rows], y)) <= eps
            continue
        apart = p[s : s + rows] @ q
        apart *= -2
        apart += pp[s : s + rows, None] - eps * eps
        apart += qq
        np.less_equal(apart, doubt, out=out[s : s + rows])
        i, j = np.nonzero(out[s : s + rows])
        unsure = apart[i, j] >= -doubt
        i, j = i[unsure] + s, j[unsure]
        exact = np.zeros(len(i))
        for c in range(x.shape[1]):
            d = x[i, c] - y[j, c]
            exact += d * d
        out[i, j] = np.sqrt(exact) <= eps
    return out


def _sides(pdf: pd.DataFrame) -> list[tuple[pd.DataFrame, pd.DataFrame]]:
    """The (rows, columns) whose distances a chunk pair owes: every pair with a home point, once."""
    a, b = pdf["a"].iloc[0], pdf["b"].iloc[0]
    left, home = pdf[pdf["chunk"] == a], pdf["home"].to_numpy()
    own = pdf[(pdf["chunk"] == a) & home]
    if a == b:
        return [(own, left)]
    right = pdf[pdf["chunk"] == b]
    return [(own, right), (pdf[(pdf["chunk"] == a) & ~home], pdf[(pdf["chunk"] == b) & home])]


def _neighbour_weights(blocks: DataFrame, names: list[str], eps: float) -> DataFrame:
    """(pid, weight): total weight within ε, a point's own weight included."""

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        same, parts = pdf["a"].iloc[0] == pdf["b"].iloc[0], [pd.DataFrame({"pid": pdf["pid"][:0], "weight": np.zeros(0)})]
        for rows, columns in _sides(pdf):
            if not len(rows) or not len(columns):
                continue
            near = _near(matrix(rows, names), matrix(columns, names), eps)
            sums = [(rows, near @ columns["w"].to_numpy(dtype="float64"))]
            if not same:
                sums.append((columns, rows["w"].to_numpy(dtype="float64") @ near))
            parts += [pd.DataFrame({"pid": s["pid"], "weight": n})[s["home"].to_numpy()] for s, n in sums]
        return pd.concat(parts)

    pid = blocks.schema["pid"].dataType.simpleString()
    partial = blocks.groupBy("leaf", "a", "b").applyInPandas(count, f"pid {pid}, weight double")
    return partial.groupBy("pid").agg(F.sum("weight").alias("weight"))


def _components(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component number per row and per column of a boolean adjacency; −1 without neighbours."""
    back = np.ascontiguousarray(near.T)
    of_row, of_column = np.full(near.shape[0], -1), np.full(near.shape[1], -1)
    for start in np.flatnonzero(near.any(axis=1)):
        if of_row[start] >= 0:
            continue
        frontier = np.array([start])
        of_row[start] = start
        while len(frontier):
            columns = np.flatnonzero(near[frontier].any(axis=0) & (of_column < 0))
            of_column[columns] = start
            frontier = np.flatnonzero(back[columns].any(axis=0) & (of_row < 0))
            of_row[frontier] = start
    return of_row, of_column


def _links(blocks: DataFrame, names: list[str], eps: float) -> DataFrame:
    """(pid, other, border): stars of local core components, and border → core links.

    A border point has fewer than ``min_points`` neighbours, so its links are few;
    a star has one row per core point.
    """

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"pid": pdf["pid"][:0], "other": pdf["pid"][:0], "border": np.zeros(0, dtype=bool)})]
        for rows, columns in _sides(pdf):
            sides = [(rows, columns)] if pdf["a"].iloc[0] == pdf["b"].iloc[0] else [(rows, columns), (columns, rows)]
            for own, others in sides:
                border, core = own[~own["core"].to_numpy() & own["home"].to_numpy()], others[others["core"].to_numpy()]
                if len(border) and len(core):
                    i, j = np.nonzero(_near(matrix(border, names), matrix(core, names), eps))
                    out.append(pd.DataFrame({"pid": border["pid"].to_numpy()[i], "other": core["pid"].to_numpy()[j], "border": True}))
            rows, columns = rows[rows["core"].to_numpy()], columns[columns["core"].to_numpy()]
            if len(rows) and len(columns):
                component = np.concatenate(_components(_near(matrix(rows, names), matrix(columns, names), eps)))
                pid = np.concatenate([rows["pid"].to_numpy(), columns["pid"].to_numpy()])[component >= 0]
                component = component[component >= 0]
                order = np.argsort(pid, kind="stable")
                root = pd.Series(pid[order]).groupby(component[order]).first()
                out.append(pd.DataFrame({"pid": pid, "other": root.loc[component].to_numpy(), "border": False}))
        return pd.concat(out)

    pid = blocks.schema["pid"].dataType.simpleString()
    found = blocks.where("core or home").groupBy("leaf", "a", "b").applyInPandas(link, f"pid {pid}, other {pid}, border boolean")
    return found.distinct()


def connected_components(stars: DataFrame) -> DataFrame:
    """(pid, label): the smallest pid of each component of (pid, other) edges.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so long chains shrink fast; rounds are cut in the shared
    checkpoint folder.
    """
    edges = stars.select("pid", "other").union(stars.select(F.col("other").alias("pid"), F.col("pid").alias("other")))
    edges = cut_lineage(edges.where("pid <> other").distinct())
    labels = cut_lineage(stars.select("pid").union(stars.select("other")).distinct().withColumn("label", F.col("pid")))
    while True:
        of_other = labels.select(F.col("pid").alias("other"), F.col("label").alias("seen"))
        smallest = edges.join(of_other, "other").groupBy("pid").agg(F.min("seen").alias("seen"))
        hooked = labels.join(smallest, "pid", "left").select(
            "pid", F.col("label").alias("was"), F.expr("least(label, seen)").alias("label")
        )
        jump = hooked.select(F.col("pid").alias("label"), F.col("label").alias("next"))
        moved = cut_lineage(
            hooked.join(jump, "label", "left").select("pid", "was", F.expr("least(label, next)").alias("label"))
        )
        labels = moved.select("pid", "label")
        if moved.where("was <> label").isEmpty():
            return labels


def dbscan(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    eps: float,
    *,
    min_points: int = 5,
    block: int = BLOCK_ROWS,
    seed: int = 42,
) -> DataFrame:
    """(key, cluster) for every row; −1 is noise.

    Clusters are numbered by their smallest core key; a border point within
    reach of several clusters joins the first of them. A row with a null or NaN
    feature is near nothing, so it is noise.
    """
    names = [f"x{i}_" for i in range(len(columns))]
    rows = df.selectExpr(
        f"{ident(key)} as key_", *[f"cast({ident(c)} as double) as {n}" for c, n in zip(columns, names)]
    )
    points = cut_lineage(complete(rows, names).groupBy(*names).agg(F.min("key_").alias("pid"), F.count("*").alias("w")))
    blocks = cut_lineage(_blocks(points, names, eps, block, seed, points.count()))
    core = cut_lineage(_neighbour_weights(blocks, names, eps).select("pid", (F.col("weight") >= min_points).alias("core")))
    links = cut_lineage(_links(blocks.join(core, "pid"), names, eps))
    labels = connected_components(links.where("not border"))
    border = (
        links.where("border")
        .join(labels.select(F.col("pid").alias("other"), "label"), "other")
        .groupBy("pid")
        .agg(F.min("label").alias("label"))
    )
    found = labels.join(core.where("core"), "pid", "left_semi").unionByName(border)
    numbered = _numbered(found.select("label").distinct())
    kinds = found.join(numbered, "label").select("pid", "cluster")
    labelled = points.join(kinds, "pid", "left").select(*names, "cluster")
    return rows.join(labelled, names, "left").select(
        F.col("key_").alias(key), F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster")
    )


def _numbered(labels: DataFrame) -> DataFrame:
    """Consecutive numbers in label order: a distributed sort and per-partition offsets."""
    ordered = cut_lineage(labels.orderBy("label").withColumn("part", F.spark_partition_id()))
    sizes = sorted(ordered.groupBy("part").count().collect())  # one row per partition
    before, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    starts = F.broadcast(local_table(labels.sparkSession, offsets, "part int, before long"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("label"))
    return ordered.withColumn("place", place).join(starts, "part").selectExpr("label", "before + place - 1 as cluster")

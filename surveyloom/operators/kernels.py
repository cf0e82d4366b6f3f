"""Weak polynomial kernels: feature maps, quality metrics, dominance weights.

A weak kernel is (x·z)^d over a few drawn columns, so it has an exact explicit
feature map φ of at most a few dozen columns and K = ΦΦᵀ is never formed.  Every
metric follows from per-class sums of φ and of φφᵀ: one pass over the rows, one
small matrix per partition, added up by a shuffle of those alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.functions import complete, doubles, ident, literal, local_table, quote, text_literal
from surveyloom.operators.dominance import dominators
from surveyloom.operators.models import monomials


# ── weak kernels ────────────────────────────────────────────────────────────

@dataclass(frozen=True)
class WeakKernel:
    """(x·z)^degree over the drawn columns; a column may be drawn twice."""

    columns: tuple[str, ...]
    degree: int

    def terms(self) -> list[tuple[tuple[int, ...], float]]:
        return monomials(len(self.columns), self.degree)

    @property
    def width(self) -> int:
        return len(self.terms())

    def map_sql(self) -> str:
        """SQL text of φ as an array."""
        products = [
            " * ".join([literal(c), *[ident(self.columns[p]) for p in positions]]) for positions, c in self.terms()
        ]
        return f"array({', '.join(products)})"


def weak_kernel_specs(
    columns: Sequence[str],
    num_kernels: int = 10,
    *,
    max_features: int = 5,
    max_degree: int = 3,
    seed: int | None = None,
) -> list[WeakKernel]:
    """Random kernels; the draws (size, columns, degree, per kernel) fix the stream."""
    rng = np.random.default_rng(seed)
    kernels = []
    for _ in range(num_kernels):
        size = rng.integers(1, max_features + 1)
        drawn = rng.integers(0, len(columns), size=size)
        kernels.append(WeakKernel(tuple(columns[i] for i in drawn), int(rng.integers(1, max_degree + 1))))
    return kernels


def specs_table(spark: SparkSession, kernels: Sequence[WeakKernel]) -> DataFrame:
    rows = [(i, list(k.columns), k.degree) for i, k in enumerate(kernels)]
    return local_table(spark, rows, "kernel int, cols array<string>, degree int")


def poly_feature_map(df: DataFrame, kernel: WeakKernel, *, keep: Sequence[str], out: str = "phi") -> DataFrame:
    """Kept columns and φ: φ(x)·φ(z) equals the kernel, on any table with the columns."""
    return df.selectExpr(*[ident(k) for k in keep], f"{kernel.map_sql()} as {ident(out)}")


# ── class sums ──────────────────────────────────────────────────────────────

@dataclass(frozen=True)
class ClassSums:
    """Rows, Σφ and Σφφᵀ of one side of a labelling."""

    n: float
    total: np.ndarray
    gram: np.ndarray

    def __add__(self, other: ClassSums) -> ClassSums:
        return ClassSums(self.n + other.n, self.total + other.total, self.gram + other.gram)

    def scaled(self, root: np.ndarray) -> ClassSums:
        """The sums of φ multiplied column by column with ``root``."""
        return ClassSums(self.n, self.total * root, self.gram * np.outer(root, root))

    def first(self, width: int) -> ClassSums:
        return ClassSums(self.n, self.total[:width], self.gram[:width, :width])


FeatureMap = Callable[[np.ndarray], np.ndarray]
#: Rows whose cubic monomials lie in memory together.
MOMENT_ROWS = 1_024


def weak_map(kernels: Sequence[WeakKernel], columns: Sequence[str]) -> FeatureMap:
    """The maps of several kernels side by side, for batches of ``columns``."""
    parts = []
    for k in kernels:
        at = [list(columns).index(c) for c in k.columns]
        terms = k.terms()
        parts.append((np.array([[at[p] for p in pos] for pos, _ in terms]), np.array([c for _, c in terms])))

    def apply(x: np.ndarray) -> np.ndarray:
        return np.hstack([x[:, positions].prod(axis=2) * weight for positions, weight in parts])

    return apply


@dataclass(frozen=True)
class Cubic:
    """The map of (x·z/d + 1)³ on d inputs, with sums that hold every moment once.

    Σφφᵀ has w(w+1)/2 entries for w = C(d+3, 3) monomials, but only C(d+6, 6) different
    ones: the moments of degree six in the d inputs and a one. A moment's sorted
    positions split into a lower and an upper half, so those whose lower half ends at m
    are one product of the monomials that end at m with those that start from m on.
    """

    d: int

    def __reduce__(self):
        return Cubic, (self.d,)  # tasks make the tables again

    @cached_property
    def _terms(self) -> tuple[np.ndarray, np.ndarray]:
        found = monomials(self.d + 1, 3)
        return np.array([p for p, _ in found]), np.array([c for _, c in found])

    @cached_property
    def _halves(self) -> list[tuple[np.ndarray, int]]:
        """Per m: the monomials whose last position is m, and where those begin that start from m on."""
        positions = self._terms[0]
        return [(np.flatnonzero(positions[:, 2] == m), int(np.searchsorted(positions[:, 0], m))) for m in range(self.d + 1)]

    def plain(self, x: np.ndarray) -> np.ndarray:
        """The monomials without their coefficients (monomials × rows), in order of their positions."""
        z, at = np.vstack([x.T / np.sqrt(self.d), np.ones((1, len(x)))]), 0
        out = np.empty((len(self._terms[0]), len(x)))
        for i in range(self.d + 1):
            for j in range(i, self.d + 1):
                np.multiply(z[j:], z[i] * z[j], out=out[at : at + self.d + 1 - j])
                at += self.d + 1 - j
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (self.plain(x) * self._terms[1][:, None]).T

    @property
    def size(self) -> int:
        """Numbers in ``sums``."""
        return 1 + len(self._terms[0]) + sum(len(low) * (len(self._terms[0]) - high) for low, high in self._halves)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Rows, Σ of the monomials, and the moments of degree six."""
        out = np.zeros(self.size)
        out[0] = len(x)
        for s in range(0, len(x), MOMENT_ROWS):
            z, at = self.plain(x[s : s + MOMENT_ROWS]), 1 + len(self._terms[0])
            out[1:at] += z.sum(axis=1)
            for low, high in self._halves:
                part = z[low] @ z[high:].T
                out[at : at + part.size] += part.ravel()
                at += part.size
        return out

    @cached_property
    def _moment(self) -> np.ndarray:
        """Where among the moments each entry of Σφφᵀ lies: by its sorted positions."""
        positions = self._terms[0]
        base = (self.d + 1) ** np.arange(5, -1, -1)
        keys = np.concatenate([
            ((positions[low] @ base[:3])[:, None] + positions[high:] @ base[3:]).ravel() for low, high in self._halves
        ])
        order = np.argsort(keys)
        out = np.empty((len(positions), len(positions)), np.int32)
        for i, p in enumerate(positions):
            both = np.sort(np.hstack([np.broadcast_to(p, positions.shape), positions]), axis=1)
            out[i] = order[np.searchsorted(keys, both @ base, sorter=order)]
        return out

    def class_sums(self, sums: np.ndarray) -> ClassSums:
        """The sums of the weighted map."""
        weight = self._terms[1]
        return ClassSums(sums[0], sums[1 : 1 + len(weight)] * weight, sums[1 + len(weight) :][self._moment] * np.outer(weight, weight))


def class_sums(df: DataFrame, columns: Sequence[str], label: str, maps: dict[str, FeatureMap]) -> dict[str, dict]:
    """{map: {class: ClassSums}} in one pass over the rows, for all maps at once."""
    names = list(columns)
    kind = df.schema[label].dataType.simpleString()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for batch in batches:
            x, y = batch[names].to_numpy(dtype="float64"), batch["label_"].to_numpy()
            for c in pd.unique(y):
                own = x[y == c]
                for name, phi in maps.items():
                    if isinstance(phi, Cubic):
                        sums = phi.sums(own)
                    else:
                        z = phi(own)
                        sums = np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
                    if (name, c) in seen:
                        seen[name, c] += sums
                    else:
                        seen[name, c] = sums
        if seen:
            yield pd.DataFrame([(m, c, sums) for (m, c), sums in seen.items()], columns=["map", "label_", "sums"])

    source = doubles(df.withColumnRenamed(label, "label_").where("label_ is not null"), names, keep=["label_"])
    added = (
        source.mapInPandas(partial, f"map string, label_ {kind}, sums array<double>")
        .groupBy("map", "label_")
        .agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
        .collect()
    )
    result: dict[str, dict] = {name: {} for name in maps}
    for row in added:
        v = row["sums"].toArray()
        if isinstance(maps[row["map"]], Cubic):
            result[row["map"]][row["label_"]] = maps[row["map"]].class_sums(v)
            continue
        m = round((-1 + (1 + 4 * (len(v) - 1)) ** 0.5) / 2)
        result[row["map"]][row["label_"]] = ClassSums(v[0], v[1 : m + 1], v[m + 1 :].reshape(m, m))
    return result


def _window(sums: ClassSums, start: int, stop: int) -> ClassSums:
    return ClassSums(sums.n, sums.total[start:stop], sums.gram[start:stop, start:stop])


def per_kernel(sums: dict, kernels: Sequence[WeakKernel]) -> list[dict]:
    """Split the sums of a joint map into one {class: ClassSums} per kernel."""
    bounds = np.concatenate([[0], np.cumsum([k.width for k in kernels])])
    return [
        {c: _window(s, int(a), int(b)) for c, s in sums.items()} for a, b in zip(bounds[:-1], bounds[1:])
    ]


def against(sums: dict, positive) -> tuple[ClassSums, ClassSums]:
    """(positive class, all the rest)."""
    rest = [s for c, s in sums.items() if c != positive]
    if not rest:
        s = sums[positive]
        return s, ClassSums(0.0, np.zeros_like(s.total), np.zeros_like(s.gram))
    total = rest[0]
    for s in rest[1:]:
        total = total + s
    return sums[positive], total


# ── metrics ─────────────────────────────────────────────────────────────────

def kernel_alignment(pos: ClassSums, neg: ClassSums) -> float:
    """⟨K, yyᵀ⟩ / (‖K‖·n), where ⟨K, yyᵀ⟩ = ‖Σyφ‖² and ‖K‖ = ‖Σφφᵀ‖."""
    signed = pos.total - neg.total
    return float(signed @ signed / (np.linalg.norm(pos.gram + neg.gram) * (pos.n + neg.n)))


def kernel_polarization(pos: ClassSums, neg: ClassSums) -> float:
    """Σ −yᵢyⱼ‖φᵢ−φⱼ‖² = 2‖Σyφ‖² − 2·Σy‖φ‖²·Σy."""
    signed = pos.total - neg.total
    return float(2 * signed @ signed - 2 * (np.trace(pos.gram) - np.trace(neg.gram)) * (pos.n - neg.n))


def kernel_fsm(pos: ClassSums, neg: ClassSums) -> float | None:
    """Spread of both classes along the line of their means, over its length squared."""
    if pos.n < 2 or neg.n < 2:
        return None
    w = pos.total / pos.n - neg.total / neg.n
    length = float(w @ w)
    if length == 0:
        return None

    def spread(s: ClassSums) -> float:
        return np.sqrt(max(0.0, (w @ s.gram @ w - (s.total @ w) ** 2 / s.n) / (s.n - 1)))

    return float((spread(pos) + spread(neg)) / length)


def kernel_trace(pos: ClassSums, neg: ClassSums) -> float:
    return float(np.trace(pos.gram) + np.trace(neg.gram))


Metric = Callable[[ClassSums, ClassSums], float | None]

# Name → (metric, +1 if larger is better else −1).
METRICS: dict[str, tuple[Metric, int]] = {
    "alignment": (kernel_alignment, 1),
    "polarization": (kernel_polarization, 1),
    "FSM": (kernel_fsm, 1),
    "complex_ratio": (kernel_trace, -1),
}
DEFAULT_METRICS = ("alignment", "FSM")


def metric_values(pos: ClassSums, neg: ClassSums, metrics: dict[str, tuple[Metric, int]] = METRICS) -> dict:
    return {name: fn(pos, neg) for name, (fn, _) in metrics.items()}


def kernel_metrics(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    kernels: Sequence[WeakKernel],
    *,
    positive,
    metrics: dict[str, tuple[Metric, int]] = METRICS,
) -> DataFrame:
    """One row per kernel and one column per metric, for class ``positive`` against the rest.

    ``metrics`` may hold the caller's own: name → (function of the two class
    sums, direction).
    """
    sums = class_sums(df, columns, label, {"weak": weak_map(kernels, columns)})["weak"]
    rows = [
        (i, *metric_values(*against(s, positive), metrics).values()) for i, s in enumerate(per_kernel(sums, kernels))
    ]
    return local_table(df.sparkSession, rows, "kernel int, " + ", ".join(f"{ident(m)} double" for m in metrics))


def ovr_means(per: list[dict], metrics: dict[str, tuple[Metric, int]] = METRICS) -> list[tuple]:
    """Per kernel, each metric averaged over the one-vs-rest labellings."""
    rows = []
    for sums in per:
        values = [list(metric_values(*against(sums, c), metrics).values()) for c in sorted(sums)]
        rows.append(tuple(None if None in column else float(np.mean(column)) for column in zip(*values)))
    return rows


def kernel_metrics_ovr(df: DataFrame, columns: Sequence[str], label: str, kernels: Sequence[WeakKernel]) -> DataFrame:
    sums = class_sums(df, columns, label, {"weak": weak_map(kernels, columns)})["weak"]
    rows = [(i, *r) for i, r in enumerate(ovr_means(per_kernel(sums, kernels)))]
    return local_table(df.sparkSession, rows, "kernel int, " + ", ".join(f"{ident(m)} double" for m in METRICS))


MAX_ANCHORS = 1_000


def anchor_products(mapped: DataFrame, anchors: DataFrame, key: str) -> DataFrame:
    """(key, anchor, k): inner products of every row's ``phi`` with a few anchor rows'.

    The anchors become part of the expression, so no pair of table rows is formed.
    """
    chosen = anchors.select(key, "phi").limit(MAX_ANCHORS + 1).collect()
    if len(chosen) > MAX_ANCHORS:
        raise ValueError(f"at most {MAX_ANCHORS} anchor rows")
    values = ", ".join(
        f"struct({text_literal(r[0])} as anchor, array({', '.join(literal(v) for v in r[1])}) as psi)" for r in chosen
    )
    return mapped.selectExpr(ident(key), "phi", f"inline(array({values}))").selectExpr(
        ident(key), "anchor", "aggregate(zip_with(phi, psi, (p, q) -> p * q), 0.0D, (s, v) -> s + v) as k"
    )


def pairwise_kernel(df: DataFrame, kernel: WeakKernel, key: str, anchors: DataFrame) -> DataFrame:
    """(key, anchor, k): kernel values of every row with a few anchor rows, for inspection."""
    return anchor_products(
        poly_feature_map(df, kernel, keep=[key]), poly_feature_map(anchors, kernel, keep=[key]), key
    )


def ideal_kernel(df: DataFrame, key: str, label: str, anchors: DataFrame) -> DataFrame:
    """(key, anchor, ideal): +1 for the same class as the anchor row, −1 otherwise."""
    chosen = anchors.select(key, label).limit(MAX_ANCHORS + 1).collect()
    if len(chosen) > MAX_ANCHORS:
        raise ValueError(f"at most {MAX_ANCHORS} anchor rows")
    values = ", ".join(f"struct({text_literal(r[0])} as anchor, {text_literal(r[1])} as of)" for r in chosen)
    return df.selectExpr(ident(key), ident(label), f"inline(array({values}))").selectExpr(
        ident(key), "anchor", f"if({ident(label)} = of, 1, -1) as ideal"
    )


# ── dominance weights ───────────────────────────────────────────────────────

#: Points compared directly in one group (see ``dominance``).
RANK_BLOCK = 1_024


def dominance_rank(df: DataFrame, key: str, directions: dict[str, int], *, out: str = "rank") -> DataFrame:
    """(key, rank): how many rows are at least as good in every metric, self included.

    Equal rows are collapsed with their count. Rows with a null or NaN metric have
    no rank and are not counted.
    """
    names = list(directions)
    # Positions name the metrics inside, so no name can clash with the key.
    to = [f"m{i}_" for i in range(len(names))]
    signed = complete(
        df.select(quote(key).alias("key_"), *[(quote(m).cast("double") * d).alias(t) for (m, d), t in zip(directions.items(), to)]), to
    )
    distinct = signed.groupBy(*to).agg(F.count("*").alias("n_"))
    ranks = dominators(distinct, to, weight="n_", block=RANK_BLOCK, out="rank_")
    return signed.join(ranks, to).select(F.col("key_").alias(key), F.col("rank_").alias(out))


def rank_weights(df: DataFrame, rank: str, *, power: float = 1, out: str = "weight") -> DataFrame:
    """Weights proportional to rank^power, summing to one."""
    raised = F.expr(f"pow({ident(rank)}, {power})")
    return df.withColumn(out, raised / df.agg(F.sum(raised)).scalar())


def extremality_weights(
    metrics: DataFrame,
    *,
    key: str = "kernel",
    directions: dict[str, int] | None = None,
    power: float = 1,
    strict_anti: bool = False,
) -> DataFrame:
    """(key, w_natural, w_antinatural) from the dominance ranks of the metrics.

    Natural weights use n − rank + 1.  The anti weights use the raw ranks under
    the opposite directions, as published; ``strict_anti`` uses n − rank + 1 there
    too, which favours the worse kernels.
    """
    directions = directions or {m: METRICS[m][1] for m in DEFAULT_METRICS}
    n = metrics.count()
    forward = dominance_rank(metrics, key, directions, out="forward")
    backward = dominance_rank(metrics, key, {m: -d for m, d in directions.items()}, out="backward")
    ranks = forward.join(backward, key).selectExpr(
        ident(key), f"{n} - forward + 1 as natural", f"{n} - backward + 1 as anti" if strict_anti else "backward as anti"
    )
    weighted = rank_weights(rank_weights(ranks, "natural", power=power, out="w_natural"), "anti", power=power, out="w_antinatural")
    return weighted.select(key, "w_natural", "w_antinatural")


def local_weights(rows: list[tuple], directions: Sequence[int], power: float) -> tuple[np.ndarray, np.ndarray]:
    """(natural, anti) weights of a few kernels whose metrics are on the driver already."""
    v = np.array(rows, dtype="float64") * np.array(directions)
    at_least = (v[None, :, :] >= v[:, None, :]).all(axis=2).sum(axis=1)
    at_most = (v[None, :, :] <= v[:, None, :]).all(axis=2).sum(axis=1)
    natural = (len(v) - at_least + 1.0) ** power
    anti = at_most.astype("float64") ** power
    return natural / natural.sum(), anti / anti.sum()


def combined_map_sql(kernels: Sequence[WeakKernel], weights: Sequence[float]) -> str:
    """SQL text of the map of Σ w·K: the maps side by side, times √w."""
    parts = []
    for kernel, w in zip(kernels, weights):
        if w > 0:
            parts.append(f"transform({kernel.map_sql()}, v -> v * {literal(w ** 0.5)})")
    return f"concat({', '.join(parts)})"


def combined_kernel(df: DataFrame, kernels: Sequence[WeakKernel], weights: Sequence[float], *, keep: Sequence[str], out: str = "features") -> DataFrame:
    """Kept columns and the combined kernel's feature vector."""
    mapped = df.selectExpr(*[ident(k) for k in keep], f"{combined_map_sql(kernels, weights)} as phi_")
    return mapped.select(*[F.col(ident(k)) for k in keep], array_to_vector("phi_").alias(out))


def kernel_weight_top3(weights: DataFrame, *, key: str = "kernel") -> DataFrame:
    """(ordering, key, weight, top3): the three heaviest kernels of each ordering."""
    long = weights.selectExpr(
        ident(key), "stack(2, 'natural', w_natural, 'antinatural', w_antinatural) as (ordering, weight)"
    )
    place = F.row_number().over(Window.partitionBy("ordering").orderBy(F.desc("weight"), F.desc(key)))
    return long.select("ordering", key, "weight", (place <= 3).alias("top3"))


def metric_minmax_by_kernel(metrics: DataFrame, names: Sequence[str], *, key: str = "kernel") -> DataFrame:
    """Each metric scaled to [0, 1] over the kernels; a constant metric stays raw."""
    ends = metrics.selectExpr(*[f"{f}({ident(m)})" for m in names for f in ("min", "max")]).first()
    scaled = []
    for m, low, high in zip(names, ends[::2], ends[1::2]):
        flat = low is None or high <= low
        scaled.append(ident(m) if flat else f"({ident(m)} - {literal(low)}) / {literal(high - low)} as {ident(m)}")
    return metrics.selectExpr(ident(key), *scaled)

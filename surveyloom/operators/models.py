"""Regressors and classifiers with the published parameters, on Spark ML and ``forest``.

Every ``fit_*`` takes a training table with a ``features`` vector, the target
column and, for classifiers, an indexed ``y_index`` and a ``weight``; it returns a
transformer.  ``predict`` turns any of them into a prediction table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.config import SurveyConfig
from surveyloom.functions import complete, doubles, hash52, ident, local_table, quote
from surveyloom.functions.columns import HASH52_RANGE
from surveyloom.operators.boosting import Boosting, fit_softmax_boosting, fit_squared_boosting
from surveyloom.operators.cluster.assign import as_vectors
from surveyloom.operators.features import class_counts
from surveyloom.operators.forest import Forest, Plan, grow

MAX_BINS = 256


def balanced_weights(df: DataFrame, label: str, *, out: str = "weight") -> DataFrame:
    """Row weights n/(K·n_class), through a broadcast of one row per class."""
    counts = class_counts(df, label)
    total = sum(n for _, n in counts)
    kind = df.schema[label].dataType.simpleString()
    table = local_table(
        df.sparkSession, [(c, total / (len(counts) * n)) for c, n in counts], f"{ident(label)} {kind}, {ident(out)} double"
    )
    return df.join(F.broadcast(table), label)


def index_labels(df: DataFrame, label: str, classes: Sequence[str], *, out: str = "y_index") -> DataFrame:
    """The position of the label in the ordered classes, as a double."""
    names = ", ".join("'" + c.replace("'", "\\'") + "'" for c in classes)
    return df.withColumn(out, F.expr(f"cast(array_position(array({names}), {ident(label)}) - 1 as double)"))


# ── feature maps ────────────────────────────────────────────────────────────

def monomials(width: int, degree: int) -> list[tuple[tuple[int, ...], float]]:
    """(positions, √multinomial) of every degree-``degree`` monomial of ``width`` inputs."""
    found = []
    for positions in combinations_with_replacement(range(width), degree):
        ways = factorial(degree)
        for p in set(positions):
            ways //= factorial(positions.count(p))
        found.append((positions, ways**0.5))
    return found


def gamma_scale(df: DataFrame, columns: Sequence[str]) -> float:
    """1/(d·Var X) over all entries of the training matrix."""
    sums = df.selectExpr(
        *[f"avg({ident(c)})" for c in columns], *[f"avg({ident(c)} * {ident(c)})" for c in columns]
    ).first()
    d = len(columns)
    means, squares = np.array(sums[:d], dtype="float64"), np.array(sums[d:], dtype="float64")
    variance = squares.mean() - means.mean() ** 2
    return 1.0 / (d * variance) if variance > 0 else 1.0


@dataclass(frozen=True)
class Cubes:
    """The map whose inner product is (γ x·z)³: all weighted degree-3 monomials."""

    positions: np.ndarray
    coefficient: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        i, j, k = self.positions.T
        t = np.ascontiguousarray(x.T)  # whole columns are gathered, which is several times faster
        return (t[i] * t[j] * t[k] * self.coefficient[:, None]).T

    # A cubic form is a quadratic one for each last factor, so margins and gradients need the
    # squares alone: products of matrices of last factors k × pairs (i, j), in place of all terms.
    # Pairs are in the order of j, so a few last factors together need the first pairs only.

    def _pairs(self) -> tuple[int, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Columns, the pair of each term, both factors of each pair, and (first k, end, pairs needed) of some last factors."""
        width = int(self.positions.max()) + 1
        j, i = np.tril_indices(width)
        some = sorted({width * g // 3 for g in range(4)})
        return width, self.positions[:, 0] + self.positions[:, 1] * (self.positions[:, 1] + 1) // 2, np.stack([i, j]), [
            (lo, hi, hi * (hi + 1) // 2) for lo, hi in zip(some, some[1:])
        ]

    def base(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, _, (i, j), _ = self._pairs()
        t = np.ascontiguousarray(x.T)
        return t, t[i] * t[j]

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """(last factor, class) × pairs."""
        width, pair, pairs, _ = self._pairs()
        out = np.zeros((width, len(weights), pairs.shape[1]))
        out[self.positions[:, 2], :, pair] = (weights * self.coefficient).T
        return out.reshape(-1, pairs.shape[1])

    def times(self, base: tuple[np.ndarray, np.ndarray], folded: np.ndarray) -> np.ndarray:
        t, squares = base
        classes = len(folded) // len(t)
        total = np.zeros((classes, t.shape[1]))
        for lo, hi, pairs in self._pairs()[3]:
            part = (folded[lo * classes : hi * classes, :pairs] @ squares[:pairs]).reshape(hi - lo, classes, -1)
            part *= t[lo:hi, None, :]
            total += part.sum(axis=0)
        return total.T

    def back(self, base: tuple[np.ndarray, np.ndarray], pull: np.ndarray) -> np.ndarray:
        """pairs × (last factor, class)."""
        t, squares = base
        classes, pulled = pull.shape[1], np.ascontiguousarray(pull.T)
        total = np.zeros((len(squares), len(t) * classes))
        for lo, hi, pairs in self._pairs()[3]:
            total[:pairs, lo * classes : hi * classes] = squares[:pairs] @ (t[lo:hi, None, :] * pulled).reshape(-1, t.shape[1]).T
        return total

    def unfolded(self, total: np.ndarray) -> np.ndarray:
        width, pair, _, _ = self._pairs()
        return total.reshape(len(total), width, -1)[pair, self.positions[:, 2]].T * self.coefficient


def cubic_terms(width: int, gamma: float) -> Cubes:
    terms = monomials(width, 3)
    return Cubes(np.array([p for p, _ in terms]), np.array([c for _, c in terms]) * gamma**1.5)


def cubic_map(df: DataFrame, columns: Sequence[str], gamma: float, *, keep: Sequence[str]) -> DataFrame:
    """``features`` whose inner product is (γ x·z)³: all weighted degree-3 monomials."""
    terms = cubic_terms(len(columns), gamma)

    @F.pandas_udf("array<double>")
    def cubes(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series(list(terms(np.column_stack([s.to_numpy(dtype="float64") for s in series]))))

    return _mapped(df, columns, cubes, keep)


def rbf_map(df: DataFrame, columns: Sequence[str], gamma: float, *, size: int, seed: int, keep: Sequence[str]) -> DataFrame:
    """Random Fourier features of exp(−γ‖x−z‖²): approximate by design, fixed by the seed."""
    omega = fourier_frequencies(len(columns), gamma, size, seed)

    @F.pandas_udf("array<double>")
    def waves(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in batches:
            x = np.column_stack([s.to_numpy(dtype="float64") for s in series])
            yield pd.Series(list(fourier_features(x, omega)))

    return _mapped(df, columns, waves, keep)


def fourier_frequencies(width: int, gamma: float, size: int, seed: int) -> np.ndarray:
    """size/2 frequencies for exp(−γ‖x−z‖²), drawn with a fixed seed."""
    return np.random.default_rng(seed).normal(0.0, np.sqrt(2.0 * gamma), size=(width, size // 2))


def fourier_features(x: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """Cosine and sine pairs, so that every row has norm exactly one."""
    angle = x @ omega
    return np.hstack([np.cos(angle), np.sin(angle)]) / np.sqrt(omega.shape[1])


@dataclass(frozen=True)
class Nystroem:
    """A Nyström map of exp(−γ‖x−z‖²): kernel values with the landmarks, times K_mm^(−1/2)."""

    landmarks: np.ndarray
    root: np.ndarray
    gamma: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.base(x) @ self.root

    # Margins and gradients need the kernel values alone: the root is applied to weights and sums.

    def base(self, x: np.ndarray) -> np.ndarray:
        return rbf_kernel(x, self.landmarks, self.gamma)

    def folded(self, weights: np.ndarray) -> np.ndarray:
        return self.root @ weights.T

    def times(self, base: np.ndarray, folded: np.ndarray) -> np.ndarray:
        return base @ folded

    def back(self, base: np.ndarray, pull: np.ndarray) -> np.ndarray:
        return pull.T @ base

    def unfolded(self, total: np.ndarray) -> np.ndarray:
        return total @ self.root


def rbf_kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    k = (2 * gamma) * (x @ y.T)
    k -= gamma * (x * x).sum(axis=1)[:, None]
    k -= gamma * (y * y).sum(axis=1)
    return np.exp(np.minimum(k, 0, out=k), out=k)


def _in_task(spark: SparkSession, x: np.ndarray, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """A small matrix made from a small matrix by one task: threaded solvers may not end beside the driver's JVM."""
    held = local_table(spark, [(x.astype("float64").tobytes(),)], "m binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for m in batch["m"]:
                y = work(np.frombuffer(m, "float64").reshape(x.shape))
                yield pd.DataFrame({"m": [np.ascontiguousarray(y).tobytes()], "w": [y.shape[1]]})

    row = held.mapInPandas(run, "m binary, w int").first()
    return np.frombuffer(row["m"], "float64").reshape(-1, row["w"])


def _inverse_root(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    values, vectors = np.linalg.eigh(rbf_kernel(landmarks, landmarks, gamma))
    held = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
    return vectors[:, held] / np.sqrt(values[held])


def fit_nystroem(df: DataFrame, columns: Sequence[str], gamma: float, *, key: str, size: int = 256, ridge: float = 1e-6, seed: int = 42) -> Nystroem:
    """Landmarks from all rows, in two draws fixed by the keys and the seed.

    Half are drawn alike from all rows, so that dense regions are covered. They give
    every row a ridge leverage score in one pass: what is left of k(x, x) after
    ridge regression on them. The other half is drawn by that score, from the
    regions the first half misses. Only ``size`` and 2 × ``size`` drawn rows reach
    the driver. Copies count as one landmark; rows with a null or NaN feature are
    no landmarks.
    """
    names = list(columns)
    inside = [f"x{j}_" for j in range(len(names))]
    rows = complete(doubles(df, names, keep=[key]), names).selectExpr(
        f"{hash52(key, seed)} as draw_", f"(1 + {hash52(key, f'{seed}-landmark')}) / {HASH52_RANGE + 1}D as u_",
        *[f"{ident(c)} as {x}" for c, x in zip(names, inside)],
    )
    first = rows.orderBy("draw_", *inside).limit(size).select(*inside).toPandas().drop_duplicates()
    if first.empty:
        raise ValueError("no complete row to draw landmarks from")
    even = first.to_numpy(dtype="float64")[: max(1, size // 2)]
    solve = _in_task(df.sparkSession, even, lambda x: np.linalg.inv(rbf_kernel(x, x, gamma) + ridge * np.eye(len(x))))

    @F.pandas_udf("double")
    def left_over(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in batches:
            k = rbf_kernel(np.column_stack([s.to_numpy(dtype="float64") for s in series]), even, gamma)
            yield pd.Series(np.maximum(1 - ((k @ solve) * k).sum(axis=1), 1e-12))

    # The smallest −ln(u) / score are a draw without replacement by score.
    scored = rows.withColumn("score_", left_over(*[F.col(x) for x in inside])).withColumn("turn_", F.expr("-ln(u_) / score_"))
    drawn = scored.orderBy("turn_", *inside).limit(2 * size).select(*inside).toPandas().to_numpy(dtype="float64")
    both = pd.DataFrame(np.vstack([even, drawn])).drop_duplicates().to_numpy()
    landmarks = both[:size]
    return Nystroem(landmarks, _in_task(df.sparkSession, landmarks, lambda x: _inverse_root(x, gamma)), gamma)


def nystroem_map(df: DataFrame, columns: Sequence[str], fitted: Nystroem, *, keep: Sequence[str]) -> DataFrame:
    """``features`` whose inner product approximates exp(−γ‖x−z‖²), exactly so between landmarks."""

    @F.pandas_udf("array<double>")
    def near(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series(list(fitted(np.column_stack([s.to_numpy(dtype="float64") for s in series]))))

    return _mapped(df, columns, near, keep)


def _mapped(df: DataFrame, columns: Sequence[str], udf, keep: Sequence[str]) -> DataFrame:
    inputs = [F.expr(f"cast({ident(c)} as double)") for c in columns]
    return df.select(*[quote(k) for k in keep], array_to_vector(udf(*inputs)).alias("features"))


def _key(train: DataFrame, config: SurveyConfig) -> Column:
    """What names a row for its bootstrap draws: the study's key, or the features where it is left out."""
    return quote(config.key) if config.key in train.columns else vector_to_array("features")


# ── regressors ──────────────────────────────────────────────────────────────

def fit_linear_regression(train: DataFrame, target: str, config: SurveyConfig = SurveyConfig()) -> Transformer:
    """Ordinary least squares by the normal equations: one pass."""
    return LinearRegression(labelCol=target, regParam=0.0, solver="normal").fit(train)


def fit_decision_tree_reg(train: DataFrame, target: str, config: SurveyConfig = SurveyConfig()) -> Forest:
    return grow(train, target, Plan(seed=config.seed, whole=config.whole_rows), key=_key(train, config))


def fit_random_forest_reg(train: DataFrame, target: str, config: SurveyConfig = SurveyConfig()) -> Forest:
    plan = Plan(n_trees=config.n_trees, draw=True, seed=config.seed, whole=config.whole_rows)
    return grow(train, target, plan, key=_key(train, config))


def fit_gradient_boosting_reg(train: DataFrame, target: str, config: SurveyConfig = SurveyConfig()) -> Boosting:
    return fit_squared_boosting(train, target, rounds=config.boosting_rounds, bins=MAX_BINS, whole=config.whole_rows)


REGRESSORS = {
    "Linear_Regression": fit_linear_regression,
    "Decision_Tree_Reg": fit_decision_tree_reg,
    "Random_Forest_Reg": fit_random_forest_reg,
    "Gradient_Boosting_Reg": fit_gradient_boosting_reg,
}


# ── classifiers ─────────────────────────────────────────────────────────────

def fit_logistic_regression(train: DataFrame, config: SurveyConfig = SurveyConfig()) -> Transformer:
    """Multinomial, balanced, L2 with C = 1 (so λ = 1/rows, as weights sum to rows)."""
    return LogisticRegression(
        labelCol="y_index", weightCol="weight", family="multinomial", maxIter=2_000,
        regParam=1.0 / max(train.count(), 1), elasticNetParam=0.0, standardization=False,
    ).fit(train)


def _classes(train: DataFrame) -> int:
    return int(train.agg(F.max("y_index")).first()[0] or 0) + 1


def fit_decision_tree_clf(train: DataFrame, config: SurveyConfig = SurveyConfig()) -> Forest:
    plan = Plan(classes=_classes(train), seed=config.seed, whole=config.whole_rows)
    return grow(train, "y_index", plan, key=_key(train, config), weight="weight")


def fit_random_forest_clf(train: DataFrame, config: SurveyConfig = SurveyConfig()) -> Forest:
    width = train.select(F.size(vector_to_array("features"))).first()[0]
    plan = Plan(
        n_trees=config.n_trees, draw=True, max_features=max(1, int(width**0.5)), classes=_classes(train), seed=config.seed,
        whole=config.whole_rows,
    )
    return grow(train, "y_index", plan, key=_key(train, config), weight="weight")


def fit_gradient_boosting_clf(train: DataFrame, config: SurveyConfig = SurveyConfig()) -> Boosting:
    """Softmax boosting: all classes' trees of a round follow joint gradients."""
    return fit_softmax_boosting(train, "y_index", _classes(train), rounds=config.boosting_rounds, whole=config.whole_rows)


def fit_svm(train: DataFrame, config: SurveyConfig = SurveyConfig(), *, balanced: bool = True) -> Transformer:
    """One-vs-rest linear SVM with C = 1 on whatever feature map ``train`` holds."""
    svc = LinearSVC(regParam=1.0 / max(train.count(), 1), standardization=False, maxIter=100)
    ovr = OneVsRest(classifier=svc, labelCol="y_index", parallelism=8)
    return (ovr.setWeightCol("weight") if balanced else ovr).fit(train)


CLASSIFIERS = {
    "Logistic_Regression": fit_logistic_regression,
    "Decision_Tree_Clf": fit_decision_tree_clf,
    "Random_Forest_Clf": fit_random_forest_clf,
    "Gradient_Boosting_Clf": fit_gradient_boosting_clf,
    "SVM_Linear": fit_svm,
}


def training_vectors(train: DataFrame, columns: Sequence[str], label: str, classes: Sequence[str], *, keep=()) -> DataFrame:
    """Balanced weights, indexed labels and the plain feature vector."""
    weighted = index_labels(balanced_weights(train, label), label, classes)
    return as_vectors(weighted, columns, keep=[*keep, "y_index", "weight"])


def predict(model: Transformer, df: DataFrame, name: str, *, key: str, split: str, y: str, classes: Sequence[str] | None = None) -> DataFrame:
    """(model, split, key, y, prediction); class positions become labels again."""
    scored = model.transform(df)
    prediction = "prediction"
    if classes is not None:
        names = ", ".join("'" + c.replace("'", "\\'") + "'" for c in classes)
        prediction = f"array({names})[cast(prediction as int)]"
    return scored.selectExpr(
        f"'{name}' as model", f"{ident(split)} as split", ident(key), f"{ident(y)} as y", f"{prediction} as prediction"
    )


# ── inspection ──────────────────────────────────────────────────────────────

def feature_importance_topn(model: Forest, columns: Sequence[str], spark, *, top: int = 20) -> DataFrame:
    """Impurity importances, highest first, at most ``top``."""
    ranked = sorted(zip(columns, map(float, model.importances())), key=lambda cv: -cv[1])[: min(top, len(columns))]
    return local_table(spark, [(i + 1, c, v) for i, (c, v) in enumerate(ranked)], "position int, feature string, importance double")


def simple_linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """(slope, intercept, r2) of a one-feature least-squares line: one aggregate."""
    return df.selectExpr(
        f"regr_slope({ident(y)}, {ident(x)}) as slope", f"regr_intercept({ident(y)}, {ident(x)}) as intercept",
        f"regr_r2({ident(y)}, {ident(x)}) as r2",
    )


def linear_coefficients(model, columns: Sequence[str], spark) -> DataFrame:
    rows = [("intercept", float(model.intercept)), *zip(columns, map(float, model.coefficients))]
    return local_table(spark, rows, "term string, coefficient double")


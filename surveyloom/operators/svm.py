"""One-vs-rest linear SVMs on a feature map that is worked out inside the tasks.

The rows are kept as plain features, packed in blocks; every pass maps them a few
hundred at a time and adds up the hinge losses and gradients of all classes, so
mapped features are never stored or sent. A map that is linear in something smaller
(``folded``) is not even worked out: margins and gradients follow from the smaller
numbers. The classes' solvers (limited-memory BFGS) move side by side: one pass
serves a trial point of each.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import ident

#: Rows of a block, and mapped numbers a task holds at a time.
BLOCK_ROWS, HELD = 4_096, 250_000


def descend(start: np.ndarray, *, steps: int = 100, tol: float = 1e-6, memory: int = 10) -> Generator:
    """Limited-memory BFGS with halved steps: yields trial points, is sent (value, gradient), returns the last point.

    Ends when five steps together lower the value by the share ``tol`` or less.
    """
    x = start
    f, g = yield x
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    values = [f]
    for _ in range(steps):
        d, shares = -g, []
        for s, y in reversed(kept):
            a = (s * d).sum() / (s * y).sum()
            shares.append(a)
            d = d - a * y
        if kept:
            s, y = kept[-1]
            d = d * ((s * y).sum() / (y * y).sum())
        for (s, y), a in zip(kept, reversed(shares)):
            d = d + s * (a - (y * d).sum() / (s * y).sum())
        slope = (d * g).sum()
        if slope >= 0:
            d, kept, slope = -g, [], -(g * g).sum()
        if slope == 0:
            break
        t = 1.0 if kept else 1.0 / np.sqrt((g * g).sum())
        for _ in range(20):
            f1, g1 = yield x + t * d
            if f1 <= f + 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = t * d, g1 - g
        if (s * y).sum() > 1e-12 * (y * y).sum():
            kept = [*kept[1 - memory :], (s, y)]
        x, f, g = x + s, f1, g1
        values.append(f)
        if len(values) > 5 and values[-6] - f <= tol * max(abs(values[-6]), 1e-12):
            break
    return x


class Whole:
    """How any map ``phi`` serves the passes: its features as they are.

    ``base`` is what a map keeps of some rows. Margins are ``times(base, folded(weights))``,
    and ``unfolded`` makes pull.T @ phi(x) of the sum of ``back(base, pull)`` over the rows.
    """

    def __init__(self, phi: Callable[[np.ndarray], np.ndarray]):
        self.base = phi

    def folded(self, weights: np.ndarray) -> np.ndarray:
        return weights.T

    def times(self, base: np.ndarray, folded: np.ndarray) -> np.ndarray:
        return base @ folded

    def back(self, base: np.ndarray, pull: np.ndarray) -> np.ndarray:
        return pull.T @ base

    def unfolded(self, total: np.ndarray) -> np.ndarray:
        return total


def folding(phi):
    """The map itself where it can fold weights, else all its features."""
    return phi if hasattr(phi, "folded") else Whole(phi)


@dataclass(frozen=True)
class MappedSvm:
    """A row of weights and a bias per class; ``transform`` adds ``prediction``, the class of the largest margin."""

    columns: tuple[str, ...]
    phi: Callable[[np.ndarray], np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        phi = folding(self.phi)
        folded = phi.folded(self.weights)
        rows = max(1, HELD // sum(folded.shape))
        parts = [phi.times(phi.base(x[at : at + rows]), folded) + self.bias for at in range(0, len(x), rows)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.bias)))

    def transform(self, df: DataFrame) -> DataFrame:
        @F.pandas_udf("double")
        def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for series in batches:
                x = np.column_stack([s.to_numpy(dtype="float64") for s in series])
                yield pd.Series(self.margins(x).argmax(axis=1).astype("float64"))

        return df.withColumn("prediction", predict(*[F.expr(f"cast({ident(c)} as double)") for c in self.columns]))


def _blocks(train: DataFrame, columns: Sequence[str], label: str, weight: str) -> DataFrame:
    """(block): features, label and weight of at most BLOCK_ROWS rows each."""
    names = [*columns, label, weight]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a = batch.to_numpy(dtype="float64")
            packed = [np.ascontiguousarray(a[at : at + BLOCK_ROWS]).tobytes() for at in range(0, len(a), BLOCK_ROWS)]
            # A few blocks at a time: Arrow batches of many would be large.
            yield from (pd.DataFrame({"block": [p]}) for p in packed)

    return train.selectExpr(*[f"cast({ident(c)} as double) as c{i}" for i, c in enumerate(names)]).mapInPandas(pack, "block binary")


def _total(blocks: DataFrame, width: int, summed: Callable[..., np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum over tasks of ``summed(chunks)``, where ``chunks(held)`` are rows (x, y, w), HELD // held at a time; each task sends one small matrix."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def chunks(held: int) -> Iterator[tuple]:
            rows = max(1, HELD // held)
            for batch in batches:
                for raw in batch["block"]:
                    a = np.frombuffer(raw, "float64").reshape(-1, width + 2)
                    for at in range(0, len(a), rows):
                        some = a[at : at + rows]
                        yield some[:, :width], some[:, width], some[:, width + 1]

        yield pd.DataFrame({"total": [np.ascontiguousarray(summed(chunks)).tobytes()]})

    total = np.zeros(shape)
    for row in blocks.mapInPandas(partial, "total binary").collect():
        total += np.frombuffer(row[0], "float64").reshape(shape)
    return total


def fit_mapped_svm(
    train: DataFrame, columns: Sequence[str], phi: Callable[[np.ndarray], np.ndarray], *,
    label: str = "y_index", weight: str = "weight", steps: int = 100,
) -> MappedSvm:
    """Hinge loss with C = 1 for each class against the rest, on ``phi`` of the columns of all rows.

    As in Spark's ``LinearSVC`` the solver works on features scaled to unit deviation,
    while the penalty is that of the features as they are; the bias has none.
    """
    width = len(columns)
    size, small = phi(np.zeros((1, width))).shape[1], folding(phi)
    blocks = _blocks(train, columns, label, weight).persist(StorageLevel.MEMORY_AND_DISK)

    def moments(chunks):
        total = np.zeros((4, size))
        for x, y, w in chunks(size):
            z = phi(x)
            total += np.vstack([w @ z, w @ (z * z), np.full(size, w.sum()), np.full(size, len(y))])
        return total

    sums = _total(blocks, width, moments, (4, size))
    whole, n = sums[2, 0], sums[3, 0]
    if not n:
        raise ValueError("no rows to fit an SVM on")
    spread = np.sqrt(np.maximum(sums[1] / whole - (sums[0] / whole) ** 2, 0.0))
    scale = np.where(spread > 1e-12, 1.0 / np.maximum(spread, 1e-12), 0.0)
    classes = int(train.agg(F.max(label)).first()[0]) + 1
    penalty = 1.0 / n

    runs = {c: descend(np.zeros(size + 1), steps=steps) for c in range(classes)}
    asked = {c: next(run) for c, run in runs.items()}
    ended: dict[int, np.ndarray] = {}
    while asked:
        own = np.array(list(asked))
        plain = np.stack([v[:-1] * scale for v in asked.values()])
        bias = np.array([v[-1] for v in asked.values()])

        def losses(chunks):
            folded, back, sides = small.folded(plain), 0.0, np.zeros((len(own), 2))
            for x, y, w in chunks(sum(folded.shape)):
                base = small.base(x)
                sign = np.where(y[:, None] == own, 1.0, -1.0)
                short = 1.0 - sign * (small.times(base, folded) + bias)
                pull = np.where(short > 0, -sign * w[:, None], 0.0)
                back = back + small.back(base, pull)
                sides += np.column_stack([pull.sum(axis=0), (np.maximum(short, 0) * w[:, None]).sum(axis=0)])
            pulled = np.zeros((len(own), size)) if np.isscalar(back) else small.unfolded(back)
            return np.column_stack([pulled, sides])

        found = _total(blocks, width, losses, (len(own), size + 2)) / whole
        for i, c in enumerate(own.tolist()):
            gradient = np.append((found[i, :-2] + penalty * plain[i]) * scale, found[i, -2])
            value = found[i, -1] + penalty / 2 * (plain[i] ** 2).sum()
            if not np.isfinite(value):
                raise ValueError("the rows hold a null or non-finite feature")
            try:
                asked[c] = runs[c].send((value, gradient))
            except StopIteration as last:
                ended[c] = last.value
                del asked[c]
    blocks.unpersist()
    weights = np.stack([ended[c][:-1] * scale for c in range(classes)])
    return MappedSvm(tuple(columns), phi, weights, np.array([ended[c][-1] for c in range(classes)]))

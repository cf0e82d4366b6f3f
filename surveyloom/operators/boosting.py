"""Gradient boosting: for several classes one small tree per class and round, fitted to
joint softmax gradients; for numbers one tree a round, fitted to what is left.

All trees of a round grow together, level by level: one pass sums (class, node,
feature, bin) histograms of gradients, the best splits are chosen from them, and the
last level's sums also give the leaf values. Over a table of at most ``whole`` rows
the passes run inside one task; over a larger one the rows are packed into blocks of
bin numbers once, and each pass is a Spark job whose tasks send one row per used
histogram cell. The scores are written out every few rounds, so that no pass repeats
more than those rounds' trees.

Leaf values are one Newton step, (K-1)/K · Σr / Σ|r|(1-|r|), times the learning
rate; the first scores are the log shares of the classes. For numbers the first tree
is fitted to them whole, and a later one adds twice the rate of its leaves' means, as
the gradient of the squared error has it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, quote
from surveyloom.operators.forest import TIE, _edges

#: Rounds after which the scores are written out, and rows of a block.
WRITTEN_EVERY, BLOCK_ROWS = 10, 16_384


@dataclass
class Round:
    """The trees of one round in heap order: feature (-1 at a leaf), bin and value of each (class, node)."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray


def softmax(scores: np.ndarray) -> np.ndarray:
    """Probabilities (classes × rows)."""
    e = np.exp(scores - scores.max(axis=0))
    return e / e.sum(axis=0)


def coded(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins (features × rows): up to the b-th edge is bin b."""
    kind = np.min_scalar_type(max(len(e) for e in edges))
    return np.stack([np.searchsorted(e, x[:, f]).astype(kind) for f, e in enumerate(edges)])


def places(trees: Round, bins: np.ndarray, k: int, levels: int) -> np.ndarray:
    """Place of every row among the nodes ``levels`` splits down class ``k``'s tree; below a leaf all go left.

    Each split is compared over all rows: numbers of one byte go through the processor by dozens.
    """
    at = np.zeros(bins.shape[1], np.min_scalar_type(2**levels))
    for level in range(levels):
        first, right = 2**level - 1, np.zeros(bins.shape[1], bool)
        for j in np.flatnonzero(trees.feature[k, first : first + 2**level] >= 0):
            right |= (bins[trees.feature[k, first + j]] > trees.bin[k, first + j]) & (at == j)
        at = 2 * at + right
    return at


def add_scores(scores: np.ndarray, rounds: list[Round], bins: np.ndarray, depth: int) -> np.ndarray:
    """``scores`` (classes × rows) with the rounds' trees added, in place."""
    for trees in rounds:
        for k in range(len(scores)):
            value = np.empty(2**depth)
            for place in range(2**depth):
                at = 0
                for level in reversed(range(depth)):
                    if trees.feature[k, at] < 0:
                        break
                    at = 2 * at + 1 + (place >> level & 1)
                value[place] = trees.value[k, at]
            scores[k] += value[places(trees, bins, k, depth)]
    return scores


def gradient_sums(
    trees: Round, bins: np.ndarray, y: np.ndarray, scores: np.ndarray, level: int, starts: np.ndarray, *, last: bool, squared: bool
) -> np.ndarray:
    """(class, node of the level, bin of a feature, [rows, Σr, weight]) of some rows.

    ``starts`` is where each feature's bins begin. Weight is Σ|r|(1-|r|), or the rows for
    numbers; where the level is not the last, a node's total is all that is wanted of it, so
    only the first feature's bins have it.
    """
    classes, nodes, cells = len(scores), 2**level, starts[-1]
    r = y - scores if squared else (y == np.arange(classes)[:, None]) - softmax(scores)
    h = None if squared else np.abs(r) * (1 - np.abs(r))
    out = np.zeros((classes, nodes, cells, 3))
    codes = bins.astype(np.intp)
    counted = [np.bincount(c, None, b - a) for c, a, b in zip(codes, starts, starts[1:])] if not level else None
    for k in range(classes):
        node = places(trees, bins, k, level).astype(np.intp) if level else None
        for f, (a, b) in enumerate(zip(starts, starts[1:])):
            cell = node * (b - a) + codes[f] if level else codes[f]
            size, shape = nodes * (b - a), (nodes, b - a)
            out[k, :, a:b, 0] = np.bincount(cell, None, size).reshape(shape) if level else counted[f]
            out[k, :, a:b, 1] = np.bincount(cell, r[k], size).reshape(shape)
            if not squared and (last or not f):
                out[k, :, a:b, 2] = np.bincount(cell, h[k], size).reshape(shape)
    if squared:
        out[..., 2] = out[..., 0]
    return out


def grow_round(sums: Callable[[Round, int], np.ndarray], starts: np.ndarray, classes: int, depth: int, step: float) -> Round:
    """One tree per class; ``sums`` gives the histograms of a level, given the splits so far."""
    size = 2 ** (depth + 1) - 1
    trees = Round(np.full((classes, size), -1, np.int64), np.zeros((classes, size), np.int64), np.zeros((classes, size)))
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))

    def leaf(stats: np.ndarray) -> float:
        return step * stats[1] / stats[2] if stats[2] > 1e-150 else 0.0

    for level in range(depth):
        grid = sums(trees, level)
        for k in range(classes):
            for j in range(2**level):
                at, cells = 2**level - 1 + j, grid[k, j]
                total = cells[: starts[1]].sum(axis=0)
                if not total[0] or (level and trees.feature[k, (at - 1) // 2] < 0):
                    continue
                ahead = np.concatenate([cells[a:b].cumsum(axis=0) for a, b in zip(starts, starts[1:])])
                n, s = ahead[:, 0], ahead[:, 1]
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = s**2 / n + (total[1] - s) ** 2 / (total[0] - n)
                score[(cells[:, 0] == 0) | (n >= total[0])] = -np.inf
                if not np.isfinite(score.max()):
                    trees.value[k, at] = leaf(total)
                    continue
                best = int((score >= TIE * score.max()).argmax())
                trees.feature[k, at], trees.bin[k, at] = of[best], best - starts[of[best]]
                if level == depth - 1:
                    trees.value[k, 2 * at + 1], trees.value[k, 2 * at + 2] = leaf(ahead[best]), leaf(total_of(cells, starts, of[best]) - ahead[best])
    return trees


def total_of(cells: np.ndarray, starts: np.ndarray, f: int) -> np.ndarray:
    return cells[starts[f] : starts[f + 1]].sum(axis=0)


def exact_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Middles between neighbouring values, or quantiles where there are too many values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="inverted_cdf"))
            out.append(values[:-1])
        else:
            out.append(values[:-1] / 2 + values[1:] / 2)
    return out


@dataclass
class Boosting:
    """The fitted rounds; ``transform`` adds ``prediction``: the number, or the likeliest class beside ``probability`` (array)."""

    edges: list[np.ndarray]
    start: np.ndarray
    rounds: list[Round]
    depth: int
    squared: bool = False

    def plain(self) -> tuple:
        return self.edges, self.start, [(t.feature, t.bin, t.value) for t in self.rounds], self.depth, self.squared

    @staticmethod
    def of(plain: tuple) -> Boosting:
        edges, start, rounds, depth, squared = plain
        return Boosting(edges, start, [Round(*t) for t in rounds], depth, squared)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(classes × rows)."""
        out = np.empty((len(self.start), len(x)))
        for at in range(0, len(x), BLOCK_ROWS):
            codes = coded(x[at : at + BLOCK_ROWS], self.edges)
            out[:, at : at + BLOCK_ROWS] = add_scores(np.tile(self.start[:, None], codes.shape[1]), self.rounds, codes, self.depth)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(self.plain())  # arrays only: executors need no copy of the package

        @F.pandas_udf("double" if self.squared else "array<double>")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = Boosting.of(sent.value)
            for x in batches:
                if not len(x):
                    yield pd.Series([], dtype="object")
                    continue
                scores = model.scores(np.stack(x.to_numpy()))
                yield pd.Series(scores[0] if model.squared else list(softmax(scores).T))

        found = predicted(vector_to_array("features"))
        if self.squared:
            return df.withColumn("prediction", found)
        return df.withColumn("probability", found).withColumn(
            "prediction", F.expr("cast(array_position(probability, array_max(probability)) - 1 as double)")
        )


def fit_softmax_boosting(
    train: DataFrame, y: str, classes: int, *, rounds: int = 100, rate: float = 0.1, depth: int = 3, bins: int = 256,
    whole: int = 20_000,
) -> Boosting:
    """Boosts on the rows of (features, y as a class position). An empty table raises a ValueError."""
    table = _table(train, y)
    tally = {int(r.y): r.n for r in table.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = sum(tally.values())
    if not n:
        raise ValueError("no rows to boost on")
    share = np.array([tally.get(k, 0) / n for k in range(classes)])
    start = np.log(np.clip(share, np.finfo(np.float32).eps, 1 - np.finfo(np.float32).eps))
    steps = [rate * (classes - 1) / classes] * rounds
    return _fit(table, n, whole, start, steps, depth, bins, False)


def fit_squared_boosting(
    train: DataFrame, y: str, *, rounds: int = 100, rate: float = 0.1, depth: int = 3, bins: int = 256, whole: int = 20_000
) -> Boosting:
    """Boosts on the rows of (features, y as a number). An empty table raises a ValueError."""
    table = _table(train, y)
    n = table.count()
    if not n:
        raise ValueError("no rows to boost on")
    return _fit(table, n, whole, np.zeros(1), [1.0] + [2 * rate] * (rounds - 1), depth, bins, True)


def _table(train: DataFrame, y: str) -> DataFrame:
    return cut_lineage(train.select(vector_to_array("features").alias("x"), quote(y).cast("double").alias("y")))


def _fit(table: DataFrame, n: int, whole: int, start: np.ndarray, steps: list[float], depth: int, bins: int, squared: bool) -> Boosting:
    width = table.select(F.size("x")).first()[0]
    fit = _in_one_task if n <= whole else _over_spark
    return fit(table, width, start, steps, depth, bins, squared)


def _starts(edges: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _in_one_task(table: DataFrame, width: int, start: np.ndarray, steps: list[float], depth: int, bins: int, squared: bool) -> Boosting:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(_matrix(b.column(0), width), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not held:
            return
        x, y = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        order = np.lexsort([y, *x.T])  # sums in one order, however the rows arrive
        x, y = x[order], y[order]
        edges = exact_edges(x, bins)
        starts, codes, scores, made = _starts(edges), coded(x, edges), np.tile(start[:, None], len(x)), []

        def sums(trees: Round, level: int) -> np.ndarray:
            return gradient_sums(trees, codes, y, scores, level, starts, last=level == depth - 1, squared=squared)

        for step in steps:
            made.append(grow_round(sums, starts, len(start), depth, step))
            add_scores(scores, made[-1:], codes, depth)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(Boosting(edges, start, made, depth, squared).plain())]})

    return Boosting.of(pickle.loads(table.coalesce(1).mapInArrow(fit, "model binary").first()[0]))


def _packed(table: DataFrame, width: int, edges: list[np.ndarray], start: np.ndarray) -> DataFrame:
    """(codes, y, scores) of up to ``BLOCK_ROWS`` rows each, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            codes, y = np.concatenate([h[0] for h in held], axis=1), np.concatenate([h[1] for h in held])
            scores = np.tile(start[:, None], len(y))
            return pa.record_batch([pa.array([a.tobytes()], pa.binary()) for a in (codes, y, scores)], ["codes", "y", "scores"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                if n and n + part.num_rows > BLOCK_ROWS:
                    yield block()
                    held, n = [], 0
                held.append((coded(_matrix(part.column(0), width), edges), part.column(1).to_numpy()))
                n += part.num_rows
        if n:
            yield block()

    return table.mapInArrow(pack, "codes binary, y binary, scores binary")


def _over_spark(table: DataFrame, width: int, start: np.ndarray, steps: list[float], depth: int, bins: int, squared: bool) -> Boosting:
    edges, classes = _edges(table, width, bins), len(start)
    starts, kind = _starts(edges), np.min_scalar_type(max(len(e) for e in edges))
    state = cut_lineage(_packed(table, width, edges, start))
    made: list[Round] = []
    written = 0

    def now(batches: Iterator[pa.RecordBatch], fresh: list[Round]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for codes, y, scores in zip(*(batch.column(c) for c in range(3))):
                codes = np.frombuffer(codes.as_buffer(), kind).reshape(width, -1)
                scores = np.frombuffer(scores.as_buffer()).reshape(classes, -1).copy()
                yield codes, np.frombuffer(y.as_buffer()), add_scores(scores, fresh, codes, depth)

    def sums(trees: Round, level: int) -> np.ndarray:
        fresh, shape = made[written:], (classes, 2**level, starts[-1], 3)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for codes, y, scores in now(batches, fresh):
                total += gradient_sums(trees, codes, y, scores, level, starts, last=level == depth - 1, squared=squared)
            cells = total.reshape(-1, 3)
            used = np.flatnonzero(cells[:, 0])
            yield pa.record_batch([pa.array(c) for c in (used, *cells[used].T)], ["cell", "n", "r", "h"])

        found = state.mapInArrow(run, "cell long, n double, r double, h double").groupBy("cell").agg(F.sum("n"), F.sum("r"), F.sum("h"))
        columns = [c.to_numpy() for c in found.toArrow().columns]
        out = np.zeros((int(np.prod(shape[:-1])), 3))
        out[columns[0]] = np.stack(columns[1:], axis=1)
        return out.reshape(shape)

    for i, step in enumerate(steps):
        made.append(grow_round(sums, starts, classes, depth, step))
        if (i + 1) % WRITTEN_EVERY == 0 and i + 1 < len(steps):
            fresh = made[written:]

            def advance(batches: Iterator[pa.RecordBatch], fresh=fresh) -> Iterator[pa.RecordBatch]:
                for codes, y, scores in now(batches, fresh):
                    yield pa.record_batch([pa.array([a.tobytes()], pa.binary()) for a in (codes, y, scores)], ["codes", "y", "scores"])

            state = cut_lineage(state.mapInArrow(advance, "codes binary, y binary, scores binary"))
            written = i + 1
    return Boosting(edges, start, made, depth, squared)

"""Decision trees and forests grown without depth limit, by level and then by node.

Large nodes are split level by level: every task sums (tree, node, feature, bin)
histograms of its rows, Spark adds them up, and the best split of each node comes
back to the driver. A node of at most ``whole`` rows is sent to one task, which
finishes it to pure leaves with exact splits between neighbouring values. So a
table of at most ``whole`` rows gets exact trees; of a larger one only the upper
levels split at quantiles. Rows find their node by routing from the root, and a
row's bootstrap weight in a tree is a hash of its key, so draws do not depend on
the layout and lost tasks repeat alike (quantiles come from sketches, which may).

The driver holds the upper levels: about rows / ``whole`` nodes per tree.
Finished subtrees stay in a written table; to predict, they are broadcast while
their counted size, unpacked, allows; beyond, rows are sent to groups of that size.

Splits: variance for numbers, Gini for classes; both maximise Σ sums² / weight over
the two sides. Ties go to the first feature, then to the lowest threshold. A node
becomes a leaf only if it is pure or no feature varies.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, local_table, quote

#: Bytes of finished subtrees, as they lie unpacked, that a task may hold to predict.
BROADCAST_BYTES = 64 << 20
#: Rows that a task takes together when it sends them on to their nodes.
BLOCK = 65_536
#: Numbers of all histograms that a task may hold at a time.
HELD = 16_000_000
#: Scores (never negative) this close to the best count as equal to it, as sums differ in their last bits.
TIE = 1 - 1e-12
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers (a bijection with good avalanche)."""
    x = np.asarray(x).astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def child_path(path: int, side: int) -> int:
    """The number that stands for a node by its way from the root."""
    return int(mix(np.array([(path * 2 + side + 1) & _MASK], np.uint64))[0])


_ODDS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))
#: Draws of all hashes that begin with the same 12 bits; where they differ, how many are right is looked up.
_DRAWS = np.searchsorted(_ODDS, np.arange(4097) / 4096, side="right").astype(np.int8)
_SURE = _DRAWS[:-1] == _DRAWS[1:]


def bootstrap(uid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn: Poisson(1), by a hash of row, tree and seed."""
    salt = mix(np.array([(seed << 32) + tree + 1], np.uint64))[0]
    h = mix(uid.astype(np.uint64) ^ salt) >> np.uint64(11)
    top = (h >> np.uint64(41)).astype(np.int64)
    drawn = _DRAWS[top].astype(np.float64)
    doubt = np.flatnonzero(~_SURE[top])
    drawn[doubt] = np.searchsorted(_ODDS, h[doubt].astype(np.float64) / 2.0**53, side="right")
    return drawn


def turns(paths: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The random numbers (nodes × features) in whose order a node takes its features."""
    return mix(mix(paths.astype(np.uint64)[:, None] ^ np.uint64(seed)) + np.arange(width, dtype=np.uint64)).astype(np.float64)


def allowed(paths: np.ndarray, varies: np.ndarray, max_features: int | None, seed: int) -> np.ndarray:
    """The features (nodes × features) each node may split on: ``max_features`` random ones of those that vary."""
    if max_features is None or max_features >= varies.shape[1]:
        return varies
    draw = turns(paths, varies.shape[1], seed)
    draw[~varies] = np.inf
    last = np.partition(draw, max_features - 1, axis=1)[:, max_features - 1 : max_features]
    return varies & (draw <= last)


def packed_rows(values: list[np.ndarray], codes: np.ndarray, rows: np.ndarray) -> bytes:
    """Some rows as their distinct values and positions among them, or plain where a feature has too many values."""
    most = max(map(len, values))
    if most > 1 << 16:
        return b"\0" + np.stack([v[c[rows]] for v, c in zip(values, codes)]).tobytes()
    small = np.uint8 if most <= 256 else np.uint16
    return b"".join([bytes([small().itemsize]), np.array([len(v) for v in values], np.int32).tobytes(), *(v.tobytes() for v in values), codes[:, rows].astype(small).tobytes()])


def _parts(raw: bytes, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The values and positions of ``packed_rows`` that are not plain."""
    lengths = np.frombuffer(raw, np.int32, width, 1)
    at = 1 + 4 * width
    values = np.split(np.frombuffer(raw, np.float64, lengths.sum(), at), np.cumsum(lengths)[:-1])
    return values, np.frombuffer(raw, np.uint8 if raw[0] == 1 else np.uint16, offset=at + 8 * int(lengths.sum())).reshape(width, -1)


def unpacked_rows(raw: bytes, width: int) -> np.ndarray:
    """The rows of ``packed_rows`` (rows × features)."""
    if not raw[0]:
        return np.frombuffer(raw, np.float64, offset=1).reshape(width, -1).T
    return np.stack([v[c] for v, c in zip(*_parts(raw, width))], axis=1)


def joined_rows(raws: Sequence[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All rows of some ``packed_rows`` as values (some may be unused) and positions among them, as ``ranked`` has them."""
    if not all(raw[0] for raw in raws):
        return ranked(np.concatenate([unpacked_rows(raw, width) for raw in raws]))
    parts = [_parts(raw, width) for raw in raws]
    values = [np.unique(np.concatenate(v)) for v in zip(*(v for v, _ in parts))]
    small = np.min_scalar_type(max(map(len, values)))
    return values, np.concatenate(
        [np.stack([np.searchsorted(v, w).astype(small)[c] for v, w, c in zip(values, own, codes)]) for own, codes in parts], axis=1
    )


def runs(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value with the places that hold it, in order."""
    order = np.argsort(of, kind="stable")
    found, first = np.unique(of[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, first[1:]))


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches, so many rows or a little more at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


@dataclass
class Tree:
    """Nodes in arrays; the right child follows the left one. ``left`` is -1 at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray  # nodes × outputs
    gain: np.ndarray
    rows: np.ndarray
    impurity: np.ndarray

    def route(self, x: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The leaf of every row, from the root or the given nodes on: values up to the threshold go left."""
        at = np.zeros(len(x), np.int64) if start is None else start.astype(np.int64)
        live = np.flatnonzero(self.left[at] >= 0)
        flat, node, begin = x.ravel(), at[live], live * x.shape[1]
        while len(live):
            node = self.left[node] + (flat[begin + self.feature[node]] > self.threshold[node])
            ended = self.left[node] < 0
            if ended.any():
                at[live[ended]] = node[ended]
                more = ~ended
                live, node, begin = live[more], node[more], begin[more]
        return at

    def packed(self) -> bytes:
        return zlib.compress(pickle.dumps(self.__dict__, protocol=5), 1)

    @staticmethod
    def unpacked(raw: bytes) -> Tree:
        return Tree(**pickle.loads(zlib.decompress(raw)))


def together(raw: dict[tuple[int, int], bytes], sizes: Sequence[int]) -> tuple[Tree, list[np.ndarray]]:
    """Subtrees of (tree, upper node) as one set of nodes, and for each tree the root by upper node (-1: none); ``sizes`` are the upper trees'."""
    roots, parts, made = [np.full(n, -1) for n in sizes], [], 0
    for (t, node), packed in raw.items():
        tree = Tree.unpacked(packed)
        roots[t][node] = made
        parts.append((tree.feature, tree.threshold, np.where(tree.left >= 0, tree.left + made, -1), tree.value))
        made += len(tree.left)
    feature, threshold, left, value = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64), np.zeros((0, 1)))
    return Tree(feature, threshold, left, value, np.zeros(0), np.zeros(0), np.zeros(0)), roots


def ranked(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct values of each feature, and every value's position among them (features × rows)."""
    values, codes = [], np.empty((x.shape[1], len(x)), np.int32)
    for f, column in enumerate(x.T):
        distinct, codes[f] = np.unique(column, return_inverse=True)
        values.append(distinct)
    return values, codes


def grow_whole(
    x: np.ndarray | tuple[list[np.ndarray], np.ndarray], y: np.ndarray, weight: np.ndarray, *, classes: int = 0,
    max_features: int | None = None, seed: int = 0, path: int = 1, max_depth: int | None = None,
) -> Tree:
    """One tree to pure leaves, all nodes of a level at once; ``y`` holds numbers, or positions of ``classes``,
    and ``x`` rows × features, or what ``ranked`` makes of them.

    Rows lie in the order of their nodes. A level adds them up by (node, feature, value)
    and takes running sums over those cells; features that a node may not use are left out.
    """
    values, codes = x if isinstance(x, tuple) else ranked(x)
    width = len(values)
    codes = codes.astype(np.min_scalar_type(max(map(len, values))))
    y, weight = np.asarray(y, np.float64), np.asarray(weight, np.float64)
    label = y.astype(np.int64) if classes else None
    starts, slot = np.zeros(1, np.int64), np.zeros(len(y), np.int64)
    feature, threshold, left, value, gain, rows, impurity = [], [], [], [], [], [], []
    paths, made, depth = np.array([path], np.uint64), 1, 0
    while len(paths):
        m = len(paths)
        count = np.diff([*starts, len(slot)])
        w = np.bincount(slot, weight, m)
        if classes:
            total = np.bincount(slot * classes + label, weight, m * classes).reshape(m, classes)
        else:
            total = np.bincount(slot, weight * y, m)[:, None]
        base = (total**2).sum(axis=1) / w
        if classes:
            bad = 1.0 - base / w
            pure = (total > 0).sum(axis=1) <= 1
        else:
            bad = np.maximum(np.bincount(slot, weight * y**2, m) / w - (total[:, 0] / w) ** 2, 0.0)
            pure = np.minimum.reduceat(y, starts) == np.maximum.reduceat(y, starts)
        best = np.full((m, width), -np.inf)
        cut = np.zeros((m, width))
        last = np.zeros((m, width), np.int32)  # the largest code on the left
        may = np.zeros((m, width), bool)
        if not pure.all() and (max_depth is None or depth < max_depth):
            low, high = (f.reduceat(codes, starts, axis=1).T.astype(np.int64) for f in (np.minimum, np.maximum))
            may = allowed(paths, (high > low) & ~pure[:, None], max_features, seed)
        if may.any():
            # The cells of a pair of node and feature: one for each code of its range.
            size = np.where(may, high - low + 1, 0)
            cells = int(size.sum())
            open_ = np.flatnonzero(may.any(axis=1)[slot])
            here, drawn = slot[open_], weight[open_]
            part = label[open_] if classes else drawn * y[open_]
            most = int(may.sum(axis=1).max())
            by_feature = most > width // 2 and len(open_) > 256 and cells <= 8 * most * len(open_)
            size = (size.T if by_feature else size).ravel()
            begin = np.cumsum(size) - size
            if by_feature:  # one after the other, so that the numbers at hand are few
                shift = begin.reshape(width, m) - low.T
                used, pair = None, np.repeat(np.arange(m * width), size)
                wide, held = np.zeros(cells), np.zeros((cells, max(classes, 1)))
                bounds = [*begin[::m].tolist(), cells]
                for f in np.flatnonzero(may.any(axis=0)).tolist():
                    own = slice(bounds[f], bounds[f + 1])
                    n = own.stop - own.start
                    first = np.where(may[:, f], shift[f] - own.start, n)  # past the cells: what a node may not use
                    cell = first[here] + (codes[f] if len(open_) == len(slot) else codes[f, open_])
                    if not may[:, f].all():
                        np.minimum(cell, n, out=cell)
                    if classes:
                        held[own] = np.bincount(cell * classes + part, drawn, (n + 1) * classes)[: n * classes].reshape(-1, classes)
                        wide[own] = held[own].sum(axis=1)
                    else:
                        wide[own] = np.bincount(cell, drawn, n + 1)[:n]
                        held[own, 0] = np.bincount(cell, part, n + 1)[:n]
            else:
                shift = begin.reshape(m, width) - low
                picks = np.argsort(~may, axis=1, kind="stable")[:, :most]
                turn = np.where(np.take_along_axis(may, picks, axis=1), np.take_along_axis(shift, picks, axis=1), cells)
                at = (picks * codes.shape[1]).T[:, here] + open_
                cell = codes.ravel()[at] + turn.T[:, here]
                np.minimum(cell, cells, out=cell)
                times, cell = len(cell), cell.ravel()
                used = None
                if cells > 8 * len(cell):  # mostly empty: number the used ones
                    used, cell = np.unique(np.append(cell, cells), return_inverse=True)
                    used, cell = used[:-1], cell[:-1]
                n = cells if used is None else len(used)
                if classes:
                    held = np.bincount(cell * classes + np.tile(part, times), np.tile(drawn, times), (n + 1) * classes).reshape(-1, classes)[:n]
                    wide = held.sum(axis=1)
                else:
                    wide = np.bincount(cell, np.tile(drawn, times), n + 1)[:n]
                    held = np.bincount(cell, np.tile(part, times), n + 1)[:n, None]
                # An empty range begins where the next one does.
                pair = np.repeat(np.arange(m * width), size) if used is None else np.searchsorted(begin, used, side="right") - 1
            full = np.flatnonzero(wide)  # weights are above zero
            if len(full) < len(wide):
                pair, held, wide = pair[full], held[full], wide[full]
                used = full if used is None else used[full]
            elif used is None:
                used = full
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            cuts = np.diff(np.append(first, len(pair))) - 1  # of each pair: one fewer than its used cells
            at = np.flatnonzero(pair[1:] == pair[:-1])
            lead = np.repeat(first, cuts)
            ahead_w, ahead = np.cumsum(wide), np.cumsum(held, axis=0)
            lw = ahead_w[at] - (ahead_w[lead] - wide[lead])
            ls = ahead[at] - (ahead[lead] - held[lead])
            k = pair[at] % m if by_feature else pair[at] // width
            score = (ls**2).sum(axis=1) / lw + ((total[k] - ls) ** 2).sum(axis=1) / np.maximum(w[k] - lw, 1e-300)
            first, cuts = first[cuts > 0], cuts[cuts > 0]
            top = np.maximum.reduceat(score, np.cumsum(cuts) - cuts)
            hit = np.flatnonzero(score >= TIE * np.repeat(top, cuts))
            of = np.repeat(first, cuts)[hit]
            lead, some = np.flatnonzero(np.append(True, of[1:] != of[:-1])), pair[first]
            i = at[hit[lead]]
            k, f = np.divmod(some, m)[::-1] if by_feature else np.divmod(some, width)
            below, above = (low[k, f] + used[j] - begin[some] for j in (i, i + 1))
            best[k, f], last[k, f] = score[hit[lead]], below
            offset = np.cumsum([0, *map(len, values)])[f]
            flat = np.concatenate(values)
            v, u = flat[offset + below], flat[offset + above]
            middle = v / 2 + u / 2
            cut[k, f] = np.where((middle >= v) & (middle < u), middle, v)
        chosen = (best >= TIE * best.max(axis=1, keepdims=True)).argmax(axis=1)
        node = np.arange(m)
        split = best[node, chosen] > -np.inf
        feature.append(np.where(split, chosen, -1))
        threshold.append(cut[node, chosen])
        left.append(np.where(split, made + 2 * (np.cumsum(split) - 1), -1))
        value.append(total / w[:, None])
        gain.append(np.where(split, best[node, chosen] - base, 0.0))
        rows.append(count)
        impurity.append(bad)
        made += 2 * int(split.sum())
        paths = mix((paths[split][:, None] * np.uint64(2) + np.array([1, 2], np.uint64)).ravel())
        moving = np.flatnonzero(split[slot])
        s = slot[moving]
        kid = 2 * (np.cumsum(split) - 1)[s] + (codes[chosen[s], moving] > last[s, chosen[s]])
        by = np.argsort(kid.astype(np.uint16) if len(paths) < 1 << 16 else kid, kind="stable")
        moving, slot = moving[by], kid[by]
        codes, y, weight = codes.take(moving, axis=1), y[moving], weight[moving]
        label = label[moving] if classes else None
        starts = np.searchsorted(slot, np.arange(len(paths)))
        depth += 1
    join = np.concatenate
    return Tree(join(feature).astype(np.int32), join(threshold), join(left).astype(np.int64), join(value), join(gain), join(rows), join(impurity))


@dataclass
class Upper:
    """The levels of one tree that were split by histograms."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    path: list[int] = field(default_factory=lambda: [1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    mean: dict[int, tuple[int, list[float]]] = field(default_factory=dict)  # rows and value of split nodes
    value: dict[int, list[float]] = field(default_factory=dict)  # leaves that need no subtree

    def tree(self, *, binned: bool = False) -> Tree:
        """The levels as a tree, of numbers or of the numbers of their bins."""
        n = len(self.feature)
        none = np.zeros(n)
        return Tree(np.array(self.feature), np.array(self.bin if binned else self.threshold), np.array(self.left), none[:, None], np.array(self.gain), none, none)


@dataclass
class Plan:
    n_trees: int = 1
    draw: bool = False
    max_features: int | None = None
    classes: int = 0  # 0: numbers
    seed: int = 0
    whole: int = 20_000
    bins: int = 256

    def weight(self, uid: np.ndarray, w: np.ndarray, tree: int) -> np.ndarray:
        return w * bootstrap(uid, tree, self.seed) if self.draw else w


def _columns(batch: pa.RecordBatch, width: int):
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return batch.column(0).to_numpy(), x, batch.column(2).to_numpy(), batch.column(3).to_numpy()


def _add(out: np.ndarray, x: np.ndarray, leaf: np.ndarray, start: np.ndarray, grove: Tree, values: dict[int, list[float]]) -> None:
    """Adds what one tree says of each row: the value of its upper leaf, or of the leaf that its subtree (from ``start``) leads to."""
    for node in values:
        out[leaf == node] += values[node]
    own = np.argsort(start, kind="stable")[np.count_nonzero(start < 0) :]  # rows of a subtree together: its nodes stay in the cache
    out[own] += grove.value[grove.route(x[own], start[own])]


@dataclass
class Forest:
    """A fitted tree or forest; ``transform`` adds ``prediction``."""

    plan: Plan
    columns: int
    centre: float
    uppers: list[Upper]
    subtrees: DataFrame  # (tree, node, nodes, rows, tree_bytes)

    def transform(self, df: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``df`` with the mean of the trees (or the class of the largest mean share; ties: the first)."""
        uppers = [(u.tree(), u.value) for u in self.uppers]
        n, k, classes, centre = self.plan.n_trees, max(self.plan.classes, 1), self.plan.classes, self.centre

        def final(total: np.ndarray) -> np.ndarray:
            return total.argmax(axis=1).astype(np.float64) if classes else total[:, 0] / n + centre

        size = (self.subtrees.agg(F.sum("nodes")).first()[0] or 0) * 8 * (6 + k)
        if size > broadcast_bytes:
            return self._joined(df, uppers, final, broadcast_bytes)
        sent = df.sparkSession.sparkContext.broadcast(
            {(r.tree, r.node): bytes(r.tree_bytes) for r in self.subtrees.select("tree", "node", "tree_bytes").collect()}
        )

        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            grove, roots = together(sent.value, [len(u.left) for u, _ in uppers])
            for some in batches:
                if not len(some):
                    yield pd.Series([], dtype="float64")
                    continue
                x = np.stack(some.to_numpy())
                out = np.zeros((len(x), k))
                for root, (upper, values) in zip(roots, uppers):
                    leaf = upper.route(x)
                    _add(out, x, leaf, root[leaf], grove, values)
                yield pd.Series(final(out))

        return df.withColumn("prediction", predict(vector_to_array("features")))

    def _joined(self, df: DataFrame, uppers, final, limit: int) -> DataFrame:
        """Subtrees are put into groups of ``limit`` bytes, unpacked; rows meet the groups that hold their subtrees.

        A group of many rows is dealt over several tasks. Rows travel in blocks, and a
        task sends back the sums of its group's trees for a block.
        """
        k, width = max(self.plan.classes, 1), self.columns
        held = cut_lineage(df.withColumn("uid_", F.monotonically_increasing_id()))
        total = held.count()
        sizes = self.subtrees.select("tree", "node", "nodes", "rows").orderBy("tree", "node").collect()
        group_of = [np.full(len(u.feature), -1) for u, _ in uppers]  # per tree: group of each upper node
        share: list[dict[int, int]] = []  # per group: rows of each tree that were learnt from
        room = 0
        for s in sizes:
            need = s.nodes * 8 * (6 + k)
            if not share or room + need > limit:
                share.append({})
                room = 0
            room += need
            group_of[s.tree][s.node] = len(share) - 1
            share[-1][s.tree] = share[-1].get(s.tree, 0) + s.rows
        for groups, (_, values) in zip(group_of, uppers):
            for node in values:  # leaves without a subtree: any group will do
                groups[node] = max(int(groups.max()), 0)
        learnt = [sum(part.get(t, 0) for part in share) for t in range(len(uppers))]
        salts = [1 + int(total * max(r / max(learnt[t], 1) for t, r in part.items())) // 100_000 for part in share] or [1]

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in gathered(batches, BLOCK // 4):
                uid = block.column(0).to_numpy()
                x = block.column(1).chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                wanted: dict[int, np.ndarray] = {}
                for groups, (upper, _) in zip(group_of, uppers):
                    for g, rows in runs(groups[upper.route(x)]):
                        wanted.setdefault(g, np.zeros(len(x), bool))[rows] = True
                values, codes = ranked(x)
                for g, rows in wanted.items():
                    rows = np.flatnonzero(rows)
                    yield pa.RecordBatch.from_pydict({
                        "g": pa.array([g], pa.int32()), "salt": pa.array([int(uid[0]) // 7 % salts[g]], pa.int32()), "block": pa.array([int(uid[0])], pa.int64()),
                        "uids": pa.array([uid[rows].tobytes()], pa.binary()), "x": pa.array([packed_rows(values, codes, rows)], pa.binary()),
                    })

        rows = held.select("uid_", vector_to_array("features").alias("x")).mapInArrow(deal, "g int, salt int, block long, uids binary, x binary")
        group_table = local_table(
            df.sparkSession, [(s.tree, s.node, int(group_of[s.tree][s.node]), salts[group_of[s.tree][s.node]]) for s in sizes],
            "tree int, node long, g int, salts int",
        )
        copies = (
            self.subtrees.select("tree", "node", "tree_bytes").join(F.broadcast(group_table), ["tree", "node"])
            .select("tree", "node", "tree_bytes", "g", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"))
        )

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left):
                return pd.DataFrame({"block": [], "g": [], "uids": [], "sums": []})
            g = int(left["g"].iloc[0])
            raw = {(t, node): b for t, node, b in zip(right["tree"], right["node"], right["tree_bytes"])}
            grove, roots = together(raw, [len(u.left) for u, _ in uppers])
            sums = []
            for x in left["x"]:
                x = unpacked_rows(x, width)
                out = np.zeros((len(x), k))
                for t, (upper, values) in enumerate(uppers):
                    if not (group_of[t] == g).any():
                        continue
                    leaf = upper.route(x)
                    _add(out, x, leaf, roots[t][leaf], grove, {node: v for node, v in values.items() if group_of[t][node] == g})
                sums.append(out.tobytes())
            return pd.DataFrame({"block": left["block"], "g": left["g"], "uids": left["uids"], "sums": sums})

        def ended(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("g")
            uid = np.concatenate([np.frombuffer(u, np.int64) for u in pdf["uids"]])
            found, place = np.unique(uid, return_inverse=True)
            out = np.zeros((len(found), k))
            start = 0
            for part in pdf["sums"]:
                part = np.frombuffer(part, np.float64).reshape(-1, k)
                out[place[start : start + len(part)]] += part
                start += len(part)
            return pd.DataFrame({"uid_": found, "prediction": final(out)})

        each = rows.groupBy("g", "salt").cogroup(copies.groupBy("g", "salt")).applyInPandas(meet, "block long, g int, uids binary, sums binary")
        scored = each.groupBy("block").applyInPandas(ended, "uid_ long, prediction double")
        return held.join(scored, "uid_").drop("uid_")

    def importances(self) -> np.ndarray:
        """Impurity decrease by feature, each tree's adding up to one, averaged."""
        width = self.columns

        def by_feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    tree = Tree.unpacked(raw)
                    inner = tree.left >= 0
                    gains = np.bincount(tree.feature[inner], tree.gain[inner], width)
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "gains": pa.array([gains.astype(float).tolist()], pa.list_(pa.float64()))})

        totals = np.zeros((self.plan.n_trees, width))
        found = self.subtrees.select("tree", "node", "tree_bytes").mapInArrow(by_feature, "tree int, gains array<double>")
        sums = found.groupBy("tree").agg(*[F.sum(F.col("gains")[i]).alias(f"g{i}") for i in range(width)])
        for row in sums.collect():
            totals[row[0]] += row[1:]
        for t, u in enumerate(self.uppers):
            for f, g in zip(u.feature, u.gain):
                if f >= 0:
                    totals[t, f] += g
        whole = totals.sum(axis=1, keepdims=True)
        return np.divide(totals, whole, out=np.zeros_like(totals), where=whole > 0).mean(axis=0)


def grow(
    train: DataFrame, y: str, plan: Plan, *, key: Column, weight: str | None = None, trees_at_once: int = 25
) -> Forest:
    """Grows all trees on the rows of (features, y[, weight]); ``key`` names a row for its bootstrap draws.

    Rows need finite features and a y. An empty table raises a ValueError.
    """
    rows = train.select(
        F.xxhash64(key).alias("uid"), vector_to_array("features").alias("x"), quote(y).cast("double").alias("y"),
        (quote(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    )
    table = cut_lineage(rows)
    first, n, mean = table.agg(F.max(F.size("x")), F.count("*"), F.avg("y")).first()
    if not n:
        raise ValueError("no rows to grow a tree on")
    # A short number as centre: sums of whole numbers stay exact, so equal splits compare as equal in any order.
    width, centre = first, 0.0 if plan.classes else float(np.float32(mean))
    table = table.withColumn("y", F.col("y") - F.lit(centre))
    uppers = [Upper() for _ in range(plan.n_trees)]
    finish: set[tuple[int, int]] = set()
    active = [(t, 0) for t in range(plan.n_trees)]
    if n <= plan.whole:
        finish, active = set(active), []
    edges = _edges(table, width, plan.bins) if active else []
    lengths = np.array([len(e) + 1 for e in edges])
    spans = dict.fromkeys(active, (np.zeros(width, np.int64), lengths - 1 if active else lengths))  # bins a node's rows may have
    some_only = 0 < (plan.max_features or 0) < width
    whole: set[tuple[int, int]] = set()  # nodes whose drawn features do not all vary: these are split with all in view
    while active:
        fresh, views, partial = [], {}, set()
        for t, node in active:
            low, high = spans[t, node]
            may = np.flatnonzero(high > low)
            if some_only and (t, node) not in whole:
                turn = turns(np.array([uppers[t].path[node]], np.uint64), width, plan.seed)[0]
                if len(may) > plan.max_features:
                    partial.add((t, node))
                may = may[np.argsort(turn[may], kind="stable")[: plan.max_features]]
            views[t, node] = np.sort(may) if len(may) else np.zeros(1, np.int64)
        room = max(1, HELD // (int(max(lengths[v].sum() for v in views.values())) * (2 + max(plan.classes, 1))))
        for at in range(0, len(active), room):
            some = {k: views[k] for k in active[at : at + room]}
            for s in _best_splits(table, uppers, some, partial, edges, plan, width).collect():
                u = uppers[s.tree]
                if s.feature == -2:
                    whole.add((s.tree, s.node))
                    fresh.append((s.tree, s.node))
                    continue
                low, high = spans.pop((s.tree, s.node))
                u.mean[s.node] = (s.rows, list(s.value))
                if s.feature < 0:
                    u.value[s.node] = list(s.value)
                    continue
                u.feature[s.node], u.threshold[s.node] = s.feature, float(edges[s.feature][s.bin])
                u.bin[s.node] = s.bin
                u.left[s.node], u.gain[s.node] = len(u.feature), s.gain
                for side, count in enumerate((s.n_left, s.n_right)):
                    kid = len(u.feature)
                    for values, new in ((u.feature, -1), (u.threshold, 0.0), (u.bin, -1), (u.left, -1), (u.gain, 0.0)):
                        values.append(new)
                    u.path.append(child_path(u.path[s.node], side))
                    if count <= plan.whole:
                        finish.add((s.tree, kid))
                    else:
                        fresh.append((s.tree, kid))
                        here = np.arange(width) == s.feature
                        spans[s.tree, kid] = (np.where(here, s.bin + 1, low), high) if side else (low, np.where(here, s.bin, high))
        active = fresh
    parts = [
        _finished(table, uppers, {k for k in finish if at <= k[0] < at + trees_at_once}, plan, width, range(at, min(at + trees_at_once, plan.n_trees)))
        for at in range(0, plan.n_trees, trees_at_once)
    ]
    subtrees = parts[0]
    for more in parts[1:]:
        subtrees = subtrees.unionByName(more)
    return Forest(plan, width, centre, uppers, subtrees)


def _edges(table: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Thresholds of each feature: its distinct quantiles but the last."""
    wide = table.select(*[F.col("x")[i].alias(f"x{i}") for i in range(width)])
    found = wide.approxQuantile(wide.columns, [(i + 1) / bins for i in range(bins)], 0.25 / bins)
    return [np.unique(q)[:-1] for q in found]


def _best_splits(table: DataFrame, uppers: Sequence[Upper], views: dict[tuple[int, int], np.ndarray], partial: set, edges, plan: Plan, width: int) -> DataFrame:
    """(tree, node, feature, bin, rows, n_left, n_right, gain, value) of each node of ``views``, which says what features it looks at.

    A node of ``partial`` has others that may vary. Feature -1 at a leaf, -2 where a node needs the features it has not looked at.
    """
    outputs = max(plan.classes, 1)
    lengths = np.array([len(e) + 1 for e in edges])
    bins = int(lengths.max())
    slots: dict[int, dict[int, int]] = {}
    for t, node in views:
        own = slots.setdefault(t, {})
        own[node] = len(own)
    trees = {t: uppers[t].tree(binned=True) for t in slots}
    paths = {(t, node): uppers[t].path[node] for t, node in views}
    looks: dict[int, list[tuple[int, list[int], np.ndarray, np.ndarray]]] = {}  # per tree and turn: cells before, slots that look, their features, first cells
    for t, own in slots.items():
        looks[t], made = [], 0
        for turn in range(max(len(views[t, node]) for node in own)):
            which = [node for node in own if len(views[t, node]) > turn]
            seen = np.array([views[t, node][turn] for node in which])
            looks[t].append((made, which, seen, np.cumsum(lengths[seen]) - lengths[seen]))
            made += int(lengths[seen].sum())

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: np.zeros((sum(int(lengths[seen].sum()) for _, _, seen, _ in look), 2 + outputs)) for t, look in looks.items()}
        for block in gathered(batches, BLOCK):
            uid, x, y, w = _columns(block.to_batches()[0], width)
            columns = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)]).astype(np.uint16 if bins <= 1 << 16 else np.int64)
            coded, n = np.ascontiguousarray(columns.T), len(x)
            for t, own in slots.items():
                slot = np.full(len(uppers[t].feature), -1)
                slot[list(own)] = list(own.values())
                weight = plan.weight(uid, w, t)
                rows = np.flatnonzero(weight > 0)
                at = slot[trees[t].route(coded[rows])]
                if at.min(initial=0) < 0:
                    rows, at = rows[at >= 0], at[at >= 0]
                drawn = weight[rows]
                # Rows and whole weights fit in one number: a block holds under 2 ** 26 of either.
                whole = not plan.classes and (drawn == np.floor(drawn)).all() and drawn.max(initial=0) < 1 << 9
                both, part, label = drawn * 2.0**26 + 1, drawn * y[rows], y[rows].astype(np.int64)
                for made, which, seen, begin in looks[t]:
                    size = int(lengths[seen].sum())
                    total = held[t][made : made + size]
                    if len(which) < len(own):
                        first, feature = np.full(len(own), -1), np.zeros(len(own), np.int64)
                        i = [own[node] for node in which]
                        first[i], feature[i] = begin, seen
                        some = np.flatnonzero(first[at] >= 0)
                        here, of, weights, sums, kind, packed = at[some], rows[some], drawn[some], part[some], label[some], both[some]
                    else:
                        first, feature, here, of, weights, sums, kind, packed = begin, seen, at, rows, drawn, part, label, both
                    code = columns[seen[0]][of] if (seen == seen[0]).all() else columns.ravel()[feature[here] * n + of]
                    cell = first[here] + code
                    if plan.classes:
                        total[:, 0] += np.bincount(cell, minlength=size)
                        by_class = np.bincount(cell * plan.classes + kind, weights, size * plan.classes).reshape(size, -1)
                        total[:, 1] += by_class.sum(axis=1)
                        total[:, 2:] += by_class
                        continue
                    if whole:
                        packed = np.bincount(cell, packed, size)
                        wide = np.floor(packed / 2.0**26)
                        total[:, 0] += packed - wide * 2.0**26
                        total[:, 1] += wide
                    else:
                        total[:, 0] += np.bincount(cell, minlength=size)
                        total[:, 1] += np.bincount(cell, weights, size)
                    total[:, 2] += np.bincount(cell, sums, size)
        for t, own in slots.items():
            of = np.concatenate([np.repeat(which, lengths[seen]) for _, which, seen, _ in looks[t]])
            features = np.concatenate([np.repeat(seen, lengths[seen]) for _, _, seen, _ in looks[t]])
            places = np.concatenate([np.arange(n) for _, _, seen, _ in looks[t] for n in lengths[seen]])
            used = np.flatnonzero(held[t][:, 0])
            for some in np.array_split(used, len(used) // 100_000 + 1):
                if len(some):
                    columns = [np.full(len(some), t, np.int32), of[some], features[some].astype(np.int32), places[some].astype(np.int32)]
                    yield pa.record_batch([pa.array(c) for c in [*columns, *held[t][some].T]], names)

    names = ["tree", "node", "feature", "bin", "n", "w", *[f"s{i}" for i in range(outputs)]]
    kinds = "tree int, node long, feature int, bin int, " + ", ".join(f"{c} double" for c in names[4:])
    # Nodes are dealt out by a stated number, so that few bytes are not taken for little work and put into one task.
    hands = min(len(views), 4 * table.sparkSession.sparkContext.defaultParallelism)
    dealt = table.mapInArrow(histograms, kinds).withColumn("hand", F.expr(f"pmod(hash(tree, node), {hands})")).repartition(hands, "hand")
    summed = dealt.groupBy("hand", *names[:4]).agg(*[F.sum(c).alias(c) for c in names[4:]])

    def best(t: int, node: int, feature: np.ndarray, place: np.ndarray, sums: np.ndarray) -> tuple:
        grid = np.zeros((width, bins, 2 + outputs))
        grid[feature, place] = sums
        ahead = grid.cumsum(axis=1)
        whole = ahead[views[t, node][0], -1]
        lw, ls = ahead[:, :, 1], ahead[:, :, 2:]
        rest = np.maximum(whole[1] - lw, 1e-300)
        used = grid[:, :, 0] > 0
        with np.errstate(invalid="ignore", divide="ignore"):
            score = (ls**2).sum(axis=2) / lw + ((whole[2:] - ls) ** 2).sum(axis=2) / rest
        score[~used | (ahead[:, :, 0] >= whole[0])] = -np.inf
        varies = used.sum(axis=1) > 1
        may = allowed(np.array([paths[t, node]], np.uint64), varies[None], plan.max_features, plan.seed)[0]
        score[~may] = -np.inf
        f, b = divmod(int((score >= TIE * score.max()).argmax()), bins)
        base = (whole[2:] ** 2).sum() / whole[1]
        pure = plan.classes and (whole[2:] > 0).sum() <= 1
        if not pure and (t, node) in partial and not varies[views[t, node]].all():
            f = -2
        elif pure or not np.isfinite(score[f, b]):
            f = -1
        gain = float(score[f, b] - base) if f >= 0 else 0.0
        return t, node, f, b, int(whole[0]), int(ahead[f, b, 0]), int(whole[0] - ahead[f, b, 0]), gain, list(whole[2:] / whole[1])

    def bests(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, kept = pdf[names[:4]].to_numpy(), pdf[names[4:]].to_numpy()
        order = np.lexsort(rows.T[1::-1])
        starts = np.flatnonzero(np.append(True, (np.diff(rows[order, :2], axis=0) != 0).any(axis=1)))
        found = [best(*rows[some[0], :2].tolist(), rows[some, 2], rows[some, 3], kept[some]) for some in np.split(order, starts[1:])]
        return pd.DataFrame(found, columns=["tree", "node", "feature", "bin", "rows", "n_left", "n_right", "gain", "value"])

    out = "tree int, node long, feature int, bin int, rows long, n_left long, n_right long, gain double, value array<double>"
    return summed.groupBy("hand").applyInPandas(bests, out)


def _finished(table: DataFrame, uppers: Sequence[Upper], finish: set[tuple[int, int]], plan: Plan, width: int, of: range) -> DataFrame:
    """(tree, node, tree_bytes) of every small node, each grown in one task of at most ``whole`` rows."""
    trees = {t: uppers[t].tree() for t in of}
    paths = {k: uppers[k[0]].path[k[1]] for k in finish}
    wanted = {t: np.array(sorted(node for u, node in finish if u == t), np.int64) for t in of}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(batches, BLOCK):
            uid, x, y, w = _columns(block.to_batches()[0], width)
            values, codes = ranked(x)
            for t in of:
                weight = plan.weight(uid, w, t)
                leaf = trees[t].route(x)
                rows = np.flatnonzero((weight > 0) & np.isin(leaf, wanted[t]))
                found = [(node, rows[i]) for node, i in runs(leaf[rows])]
                for some in (found[i : i + 64] for i in range(0, len(found), 64)):
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([t] * len(some), pa.int32()), "node": pa.array([node for node, _ in some], pa.int64()),
                        "numbers": pa.array([np.concatenate([uid[r].view(np.float64), y[r], weight[r]]).tobytes() for _, r in some], pa.binary()),
                        "x": pa.array([packed_rows(values, codes, r) for _, r in some], pa.binary()),
                    })

    def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        k = (int(key[0]), int(key[1]))
        numbers = np.concatenate([np.frombuffer(b, np.float64).reshape(3, -1) for b in pdf["numbers"]], axis=1)
        uid, y, w = numbers[0].copy().view(np.int64), numbers[1], numbers[2]
        values, codes = joined_rows(list(pdf["x"]), width)
        order = np.lexsort([y, uid])  # sums in one order, wherever the rows come from
        tree = grow_whole((values, codes.take(order, axis=1)), y[order], w[order], classes=plan.classes, max_features=plan.max_features, seed=plan.seed, path=paths[k])
        return pd.DataFrame({"tree": [k[0]], "node": [k[1]], "nodes": [len(tree.left)], "rows": [len(y)], "tree_bytes": [tree.packed()]})

    cores = table.sparkSession.sparkContext.defaultParallelism
    dealt = table.mapInArrow(deal, "tree int, node long, numbers binary, x binary")
    # A task per node or so, however small; of many nodes a few share one.
    tasks = max(cores, min(len(finish), max(16 * cores, len(finish) // 4)))
    dealt = dealt.repartition(tasks, "tree", "node")
    grown = cut_lineage(dealt.groupBy("tree", "node").applyInPandas(whole, "tree int, node long, nodes long, rows long, tree_bytes binary"))
    return grown.coalesce(max(cores, len(finish) // 16))  # to be read in fewer tasks than it was made in


def node_table(forest: Forest, columns: Sequence[str], *, tree: int = 0, max_depth: int = 4) -> DataFrame:
    """The first levels of one tree, breadth first: split, impurity, rows and value of each node.

    For classes the value is the position of the class with the largest share. Levels
    split by histograms have no impurity for numbers. Only the subtrees that begin
    within these levels are read.
    """
    upper, classes = forest.uppers[tree], forest.plan.classes
    read: dict[int, Tree] = {}

    def seen(node: tuple[int | None, int]) -> tuple:
        """(feature, threshold, impurity, rows, value, children) of (root of its subtree or None, number)."""
        root, i = node
        if root is None and i not in upper.mean:  # the subtree that was grown whole from here
            raw = forest.subtrees.where(f"tree = {tree} and node = {i}").select("tree_bytes").first()
            read[i] = Tree.unpacked(bytes(raw[0]))
            root, i = i, 0
        if root is None:
            rows, value = upper.mean[i]
            impurity = 1.0 - sum(v * v for v in value) if classes else None
            kid, at, cut = upper.left[i], upper.feature[i], upper.threshold[i]
        else:
            t = read[root]
            rows, value, impurity = int(t.rows[i]), t.value[i].tolist(), float(t.impurity[i])
            kid, at, cut = int(t.left[i]), int(t.feature[i]), float(t.threshold[i])
        shown = float(np.argmax(value)) if classes else value[0] + forest.centre
        kids = [(root, kid), (root, kid + 1)] if kid >= 0 else []
        return (columns[at], cut) if kids else (None, None), impurity, rows, shown, kids

    out, level, fresh = [], [(0, (None, 0))], 1
    for depth in range(max_depth + 1):
        below = []
        for number, node in level:
            split, impurity, rows, shown, kids = seen(node)
            numbers = [fresh, fresh + 1] if kids else [None, None]
            fresh += len(kids)
            out.append((number, depth, *split, impurity, rows, shown, *numbers))
            below += zip(numbers, kids)
        level = below
    ddl = "id int, depth int, feature string, threshold double, impurity double, samples long, value double, left_child int, right_child int"
    return local_table(forest.subtrees.sparkSession, out, ddl)

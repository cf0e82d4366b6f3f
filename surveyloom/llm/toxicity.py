"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Tokens are lower-cased words between ASCII punctuation. A token enters as its
word vector (words of the training sample) joined with a character vector: a
small bidirectional gated network over its bytes, pooled by attention. Windows
of tokens run through a second bidirectional gated network, and attention pools
its states into one logit. All windows of the whole text are scored, each
overlapping the next; a document's score is that of its worst window.

Training is numpy on a bounded sample of labelled documents. A label belongs to
the document, so after a warm-up on random windows each step learns from the
window that scores highest.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import local_table, quote
from surveyloom.llm.common import fold, texts_of

#: Lower case; ASCII other than letters and digits as blanks.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Longer runs are cut into tokens of this many bytes, so every byte is read.
TOKEN_BYTES = 24
#: Tokens whose projections a task holds at once, and tokens scored at once.
KNOWN_TOKENS, CHUNK_TOKENS = 200_000, 400_000
#: Share of the distinct words whose vector a training step leaves out.
WORD_DROPOUT = 0.5
#: Windows or tokens that run side by side.
LANES = 1024


@dataclass(frozen=True)
class Shape:
    word: int = 12
    char: int = 8
    char_hidden: int = 8
    hidden: int = 8
    window: int = 32
    stride: int = 24


def split_tokens(text: bytes) -> list[bytes]:
    words = text.translate(TABLE).split()
    if words and max(map(len, words)) > TOKEN_BYTES:
        words = [w[i : i + TOKEN_BYTES] for w in words for i in range(0, len(w), TOKEN_BYTES)]
    return words


def window_starts(n: int, shape: Shape) -> list[int]:
    """Starts that cover all ``n`` tokens; the last window ends with the text."""
    if n <= shape.window:
        return [0] if n else []
    return [*range(0, n - shape.window, shape.stride), n - shape.window]


def squash(x: np.ndarray, scale: float) -> np.ndarray:
    """1 / (1 + exp(scale · x)) in place; the exponential is vectorised where tanh may not be."""
    x *= scale
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def gated(x: np.ndarray, h: np.ndarray, ut: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of a gated unit on projected inputs x (3H, B): next state, update, reset, candidate, U·h part."""
    hidden = len(h)
    a = ut @ h
    gates = squash(x[: 2 * hidden] + a[: 2 * hidden], -1)
    new = gates[hidden:] * a[2 * hidden :]
    new += x[2 * hidden :]
    squash(new, -2)
    new *= 2
    new -= 1
    nxt = h - new
    nxt *= gates[:hidden]
    nxt += new
    return nxt, gates[:hidden], gates[hidden:], new, a[2 * hidden :]


def recur(x: np.ndarray, mask: np.ndarray | None, u: np.ndarray, cache: list | None = None) -> np.ndarray:
    """States (T, H, B) of a gated unit over projected inputs x (T, 3H, B)."""
    steps, wide, lanes = x.shape
    h = np.zeros((wide // 3, lanes), np.float32)
    states = np.empty((steps, wide // 3, lanes), np.float32)
    ut = np.ascontiguousarray(u.T)
    with np.errstate(over="ignore"):
        for t in range(steps):
            nxt, *rest = gated(x[t], h, ut)
            if mask is not None:
                nxt = np.where(mask[t], nxt, h)
            if cache is not None:
                cache.append((h, *rest))
            h = states[t] = nxt
    return states


def run_over(table: np.ndarray, index: np.ndarray, u: np.ndarray) -> np.ndarray:
    """States (T, H, B) over rows of a projected table; index (T, B)."""
    hidden = table.shape[1] // 3
    h = np.zeros((hidden, index.shape[1]), np.float32)
    states = np.empty((len(index), *h.shape), np.float32)
    ut = np.ascontiguousarray(u.T)
    with np.errstate(over="ignore"):
        for t, row in enumerate(index):
            h = states[t] = gated(np.ascontiguousarray(table.take(row, axis=0).T), h, ut)[0]
    return states


def recur_back(dstates: np.ndarray, mask: np.ndarray, u: np.ndarray, cache: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u`` from those of the states."""
    steps, hidden, lanes = dstates.shape
    dx = np.zeros((steps, 3 * hidden, lanes), np.float32)
    du = np.zeros_like(u)
    carry = np.zeros((hidden, lanes), np.float32)
    for t in range(steps - 1, -1, -1):
        h, update, reset, new, an = cache[t]
        total = dstates[t] + carry
        g = np.where(mask[t], total, 0)
        dnew = g * (1 - update) * (1 - new * new)
        dupdate = g * (h - new) * update * (1 - update)
        dreset = dnew * an * reset * (1 - reset)
        dx[t] = np.concatenate([dupdate, dreset, dnew])
        da = np.concatenate([dupdate, dreset, dnew * reset])
        du += h @ da.T
        carry = u @ da + g * update + np.where(mask[t], 0, total)
    return dx, du


class Network:
    """Weights by name; ``fit`` learns them, ``project`` and ``window_logits`` apply them."""

    def __init__(self, vocabulary: list[bytes], shape: Shape, seed: int):
        rng = np.random.default_rng(seed)
        s, c = shape, shape.char_hidden
        make = lambda *size: (rng.standard_normal(size) / np.sqrt(size[0])).astype(np.float32)
        self.shape, self.slope, self.shift = shape, 1.0, 0.0
        self.words = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.w = {
            "word": 0.1 * rng.standard_normal((len(vocabulary) + 1, s.word)).astype(np.float32),
            "char": 0.5 * rng.standard_normal((256, s.char)).astype(np.float32),
            "catt": make(2 * c, 1), "attn": make(2 * s.hidden, 1), "out": make(2 * s.hidden, 1),
            "bias": np.zeros(1, np.float32),
        }
        self.w["word"][0] = 0
        for d in "fb":
            self.w |= {f"cx{d}": make(s.char, 3 * c), f"cu{d}": make(c, 3 * c), f"cb{d}": np.zeros(3 * c, np.float32)}
            self.w |= {
                f"x{d}": make(s.word + 2 * c, 3 * s.hidden), f"u{d}": make(s.hidden, 3 * s.hidden),
                f"b{d}": np.zeros(3 * s.hidden, np.float32),
            }

    # characters
    def characters(self, tokens: list[bytes], keep: bool = False):
        """Character vectors (n, 2C); with ``keep`` also what the backward pass needs."""
        w, longest = self.w, max(map(len, tokens))
        ids = np.zeros((len(tokens), longest), np.uint8)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        mask = np.arange(longest) < lengths[:, None]
        ids[mask] = np.frombuffer(b"".join(tokens), np.uint8)
        mask_t = mask.T
        states, caches = [], []
        for d in "fb":
            table = w["char"] @ w[f"cx{d}"] + w[f"cb{d}"]
            x = np.ascontiguousarray(table[ids].transpose(1, 2, 0))
            cache: list | None = [] if keep else None
            if d == "f":
                states.append(recur(x, mask_t[:, None, :], w["cuf"], cache))
            else:
                states.append(recur(x[::-1], mask_t[::-1, None, :], w["cub"], cache)[::-1])
            caches.append(cache)
        h = np.concatenate(states, axis=1)
        e = np.where(mask_t, (w["catt"].T @ h)[:, 0], -1e9)
        e = np.exp(e - e.max(axis=0))
        weight = e / e.sum(axis=0)
        pooled = (weight[:, None, :] * h).sum(axis=0).T
        return (pooled, (ids, mask_t, h, weight, caches)) if keep else pooled

    def pooled_characters(self, tokens: list[bytes]) -> np.ndarray:
        """Character vectors without padding: tokens of a length run together."""
        out = np.empty((len(tokens), 2 * self.shape.char_hidden), np.float32)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        order = np.argsort(lengths, kind="stable")
        stream = np.frombuffer(b"".join(tokens), np.uint8)
        first = np.cumsum(lengths) - lengths
        tables = [self.w["char"] @ self.w[f"cx{d}"] + self.w[f"cb{d}"] for d in "fb"]
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for low, high in zip(edges, edges[1:]):
            n = lengths[order[low]]
            for k in range(low, high, LANES):
                part = order[k : min(k + LANES, high)]
                ids = stream[first[part] + np.arange(n)[:, None]]
                states = [run_over(table, x, self.w[f"cu{d}"]) for d, table, x in zip("fb", tables, (ids, ids[::-1]))]
                h = np.concatenate([states[0], states[1][::-1]], axis=1)
                e = (self.w["catt"].T @ h)[:, 0]
                e = np.exp(e - e.max(axis=0))
                e /= e.sum(axis=0)
                h *= e[:, None, :]
                out[part] = h.sum(axis=0).T
        return out

    def project(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Projected inputs (n, 3H) of both directions, one row per token."""
        ids = np.fromiter((self.words.get(t, 0) for t in tokens), np.int64, len(tokens))
        x = np.concatenate([self.w["word"][ids], self.pooled_characters(tokens)], axis=1)
        return x @ self.w["xf"] + self.w["bf"], x @ self.w["xb"] + self.w["bb"]

    # windows
    def window_logits(self, tables: tuple[np.ndarray, np.ndarray], index: np.ndarray) -> np.ndarray:
        """Logits of full windows: index (B, T) points into the projected tables."""
        out = np.empty(len(index), np.float32)
        half = self.shape.hidden
        heads = np.concatenate([self.w["attn"], self.w["out"]], axis=1).T
        for k in range(0, len(index), LANES):
            part = np.ascontiguousarray(index[k : k + LANES].T)
            ahead = heads[:, :half] @ run_over(tables[0], part, self.w["uf"])
            back = heads[:, half:] @ run_over(tables[1], part[::-1], self.w["ub"])
            both = ahead + back[::-1]  # (T, energy and value, B)
            e = np.exp(both[:, 0] - both[:, 0].max(axis=0))
            out[k : k + LANES] = (e * both[:, 1]).sum(axis=0) / e.sum(axis=0) + self.w["bias"][0]
        return out

    def document_logits(self, docs: list[list[bytes]], known: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The highest window logit of each document and that window's start; (-inf, 0) without tokens."""
        best, where = np.full(len(docs), -np.inf), np.zeros(len(docs), np.int64)
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        base = np.cumsum(sizes) - sizes
        begin = [window_starts(n, self.shape) for n in sizes.tolist()]
        owners = np.repeat(np.arange(len(docs)), [len(x) for x in begin])
        if not len(owners):
            return best, where
        stream = known.index(chain.from_iterable(docs), int(sizes.sum()))
        starts = np.fromiter(chain.from_iterable(begin), np.int64, len(owners))
        first, lengths = base[owners] + starts, np.minimum(sizes[owners], self.shape.window)
        logits = np.empty(len(owners), np.float32)
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            for k in range(0, len(at), 8 * LANES):
                some = at[k : k + 8 * LANES]
                logits[some] = self.window_logits(known.tables(), stream[first[some][:, None] + np.arange(n)])
        np.maximum.at(best, owners, logits)
        top = logits == best[owners]
        where[owners[top][::-1]] = starts[top][::-1]
        return best, where

    def probability(self, logits: np.ndarray) -> np.ndarray:
        """Calibrated scores; 0 where there was no token."""
        raised = np.clip(self.slope * logits.astype(np.float64) + self.shift, -700, 700)
        return np.where(np.isfinite(logits), 1 / (1 + np.exp(-raised)), 0.0)

    # training
    def step(self, windows: list[list[bytes]], target: np.ndarray, hidden_words: np.random.Generator) -> dict[str, np.ndarray]:
        """Gradients of the logistic loss over padded windows; some word vectors are left out, so spelling counts too."""
        w, s, lanes = self.w, self.shape, len(windows)
        distinct = list(dict.fromkeys(t for x in windows for t in x))
        row = {t: i for i, t in enumerate(distinct)}
        steps = max(map(len, windows))
        index = np.zeros((lanes, steps), np.int64)
        lengths = np.array([len(x) for x in windows])
        mask = (np.arange(steps) < lengths[:, None]).T
        for i, x in enumerate(windows):
            index[i, : len(x)] = [row[t] for t in x]
        ids = np.array([self.words.get(t, 0) for t in distinct])
        ids[hidden_words.random(len(ids)) < WORD_DROPOUT] = 0
        chars, (cids, cmask, ch, cweight, ccache) = self.characters(distinct, keep=True)
        inputs = np.concatenate([w["word"][ids], chars], axis=1)
        states, caches = [], []
        for d in "fb":
            x = np.ascontiguousarray((inputs @ w[f"x{d}"] + w[f"b{d}"])[index].transpose(1, 2, 0))
            cache: list = []
            if d == "f":
                states.append(recur(x, mask[:, None, :], w["uf"], cache))
            else:
                states.append(recur(x[::-1], mask[::-1, None, :], w["ub"], cache)[::-1])
            caches.append(cache)
        h = np.concatenate(states, axis=1)
        value = np.einsum("thb,h->tb", h, w["out"][:, 0])
        e = np.where(mask, np.einsum("thb,h->tb", h, w["attn"][:, 0]), -1e9)
        e = np.exp(e - e.max(axis=0))
        weight = e / e.sum(axis=0)
        pooled = (weight * value).sum(axis=0)
        dlogit = (1 / (1 + np.exp(-(pooled + w["bias"][0]))) - target).astype(np.float32) / lanes
        dvalue = weight * dlogit
        denergy = weight * (value - pooled) * dlogit
        grads = {
            "out": np.einsum("tb,thb->h", dvalue, h)[:, None], "attn": np.einsum("tb,thb->h", denergy, h)[:, None],
            "bias": np.array([dlogit.sum()], np.float32),
        }
        dh = dvalue[:, None, :] * w["out"][None] + denergy[:, None, :] * w["attn"][None]
        dinputs = np.zeros_like(inputs)
        for k, d in enumerate("fb"):
            own = dh[:, k * s.hidden : (k + 1) * s.hidden]
            if d == "f":
                dx, grads["uf"] = recur_back(own, mask[:, None, :], w["uf"], caches[0])
            else:
                dx, grads["ub"] = recur_back(own[::-1], mask[::-1, None, :], w["ub"], caches[1])
                dx = dx[::-1]
            drow = np.zeros((len(distinct), 3 * s.hidden), np.float32)
            np.add.at(drow, index.T[mask], dx.transpose(0, 2, 1)[mask])
            grads[f"x{d}"], grads[f"b{d}"] = inputs.T @ drow, drow.sum(axis=0)
            dinputs += drow @ w[f"x{d}"].T
        grads["word"] = np.zeros_like(w["word"])
        np.add.at(grads["word"], ids, dinputs[:, : s.word])
        grads["word"][0] = 0
        dpool = dinputs[:, s.word :]
        dot = np.einsum("thb,bh->tb", ch, dpool)
        dce = cweight * (dot - (cweight * dot).sum(axis=0))
        grads["catt"] = np.einsum("tb,thb->h", dce, ch)[:, None]
        dch = cweight[:, None, :] * dpool.T[None] + dce[:, None, :] * w["catt"][None]
        grads["char"] = np.zeros_like(w["char"])
        for k, d in enumerate("fb"):
            own = dch[:, k * s.char_hidden : (k + 1) * s.char_hidden]
            if d == "f":
                dx, grads["cuf"] = recur_back(own, cmask[:, None, :], w["cuf"], ccache[0])
            else:
                dx, grads["cub"] = recur_back(own[::-1], cmask[::-1, None, :], w["cub"], ccache[1])
                dx = dx[::-1]
            table = np.zeros((256, 3 * s.char_hidden), np.float32)
            np.add.at(table, cids.T[cmask], dx.transpose(0, 2, 1)[cmask])
            grads[f"cx{d}"], grads[f"cb{d}"] = w["char"].T @ table, table.sum(axis=0)
            grads["char"] += table @ w[f"cx{d}"].T
        return grads

    def fit(
        self, docs: list[list[bytes]], labels: np.ndarray, *, epochs: int, warm_up: int, rate: float, seed: int
    ) -> None:
        """Adam on one window per document: random at first, then the worst one.

        Once windows are chosen, an epoch sees every toxic document and as many
        clean ones, those that score highest. A fifth of the documents is kept
        out; their scores set the slope and the place of the decision.
        """
        rng = np.random.default_rng(seed)
        kept_out = rng.random(len(docs)) < 0.2
        own = np.flatnonzero(~kept_out)
        toxic, clean = own[labels[own] == 1], own[labels[own] == 0]
        batch = min(64, max(8, len(toxic) // 12))
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        clock, total = 0, epochs * -(-2 * len(toxic) // batch)
        for epoch in range(epochs):
            if epoch < warm_up:
                start = [int(rng.choice(window_starts(len(x), self.shape))) for x in docs]
                some_clean = rng.permutation(clean)[: len(toxic)]
            else:
                logits, start = self.document_logits(docs, Tokens(self))
                some_clean = clean[np.argsort(-logits[clean], kind="stable")[: len(toxic)]]
            order = rng.permutation(np.concatenate([toxic, some_clean]))
            for k in range(0, len(order), batch):
                some = order[k : k + batch]
                grads = self.step([docs[i][start[i] : start[i] + self.shape.window] for i in some], labels[some], rng)
                clock += 1
                for name, g in grads.items():
                    mean[name] += 0.1 * (g - mean[name])
                    square[name] += 0.001 * (g * g - square[name])
                    size = np.sqrt(square[name] / (1 - 0.999**clock)) + 1e-8
                    self.w[name] -= rate * max(0.1, 1 - clock / total) * (mean[name] / (1 - 0.9**clock)) / size
        chosen = np.flatnonzero(kept_out)
        if len({*labels[chosen].tolist()}) == 2:
            self.slope, self.shift = decision(self.document_logits([docs[i] for i in chosen], Tokens(self))[0], labels[chosen])


def decision(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of a logistic curve over the logits."""
    slope, shift = 1.0, 0.0
    soft = np.where(labels == 1, 0.99, 0.01)
    for _ in range(2000):
        error = (1 / (1 + np.exp(-np.clip(slope * logits + shift, -50, 50))) - soft) / len(labels)
        slope, shift = max(slope - 0.2 * float((error * logits).sum()), 0.05), shift - 0.2 * float(error.sum())
    return slope, shift


class Tokens:
    """Tokens met so far and their projections; starts afresh when too many."""

    def __init__(self, net: Network):
        self.net, self.rows = net, defaultdict()
        self.rows.default_factory = self.rows.__len__  # a new token gets the next row
        wide = 3 * net.shape.hidden
        self.room = [np.empty((1024, wide), np.float32) for _ in range(2)]

    def index(self, tokens: Iterable[bytes], n: int) -> np.ndarray:
        """The row of each of ``n`` tokens; new ones are projected."""
        if len(self.rows) > KNOWN_TOKENS:
            self.rows.clear()
        rows, first = self.rows, len(self.rows)
        found = np.fromiter(map(rows.__getitem__, tokens), np.int64, n)
        if len(rows) > first:
            for k, part in enumerate(self.net.project(list(islice(rows, first, None)))):
                if len(self.room[k]) < len(rows):
                    grown = np.empty((int(len(rows) * 1.3) + 1024, part.shape[1]), np.float32)
                    grown[:first] = self.room[k][:first]
                    self.room[k] = grown
                self.room[k][first : len(rows)] = part
        return found

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return self.room[0], self.room[1]


def training_sample(docs: DataFrame, labels: DataFrame, *, n_toxic: int, n_clean: int, max_bytes: int) -> list[tuple[bytes, int]]:
    """At most ``n_toxic`` and ``n_clean`` labelled documents, in the order of a hash of the id."""
    known = (
        labels.select(quote("doc_id").alias("doc_id"), quote("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), 5) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    rows = texts_of(docs).where(f"text is not null and length(text) <= {max_bytes}").select("doc_id")
    labelled = known.join(rows.distinct(), "doc_id").withColumn("at", F.xxhash64("doc_id"))
    chosen = [
        (r.doc_id, c) for c, n in ((0, n_clean), (1, n_toxic)) for r in labelled.where(f"toxic = {c}").orderBy("at", "doc_id").limit(n).collect()
    ]
    if not chosen:
        return []
    wanted = F.broadcast(local_table(docs.sparkSession, chosen, "doc_id long, toxic int"))  # n_toxic + n_clean rows at most
    found = texts_of(docs).where(f"text is not null and length(text) <= {max_bytes}").join(wanted, "doc_id")
    rows = found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return [(bytes(r.text), r.toxic) for r in rows]


def train_toxicity(
    docs: DataFrame, labels: DataFrame, *, n_toxic: int = 800, n_clean: int = 1600, max_bytes: int = 60_000, epochs: int = 16,
    warm_up: int = 6, rate: float = 0.01, seed: int = 42, shape: Shape | None = None,
) -> Network | None:
    """Fit on a bounded sample of the labelled rows whose crc32 fold (of 5) is not 0.

    The sample's bounds are ``n_toxic`` and ``n_clean`` documents, none longer
    than ``max_bytes``. Null labels and ids are no labels; a doc_id labelled
    twice counts as toxic if either row says so. None if a class has no document.
    """
    sample = [(split_tokens(t), y) for t, y in training_sample(docs, labels, n_toxic=n_toxic, n_clean=n_clean, max_bytes=max_bytes)]
    sample = [(t, y) for t, y in sample if t]
    if len({y for _, y in sample}) < 2:
        return None
    held: dict[bytes, int] = {}
    for tokens, _ in sample:
        for t in set(tokens):
            held[t] = held.get(t, 0) + 1
    net = Network(sorted(t for t, n in held.items() if n >= 3), shape or Shape(), seed)
    net.fit([t for t, _ in sample], np.array([y for _, y in sample], np.float32), epochs=epochs, warm_up=warm_up, rate=rate, seed=seed)
    return net


def batch_scores(model: Network | None, texts: Iterable[bytes | None], known: Tokens | None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and deciding windows of a batch, worked out in groups of bounded size."""
    scores, starts, group, size = [], [], [], 0

    def flush():
        best, where = model.document_logits(group, known) if model else (None, np.zeros(len(group), np.int64))
        scores.append(model.probability(best) if model else np.zeros(len(group)))
        starts.append(where)

    for x in texts:
        group.append(split_tokens(x) if x else [])
        size += len(group[-1])
        if size >= CHUNK_TOKENS:
            flush()
            group, size = [], 0
    flush()
    return np.concatenate(scores), np.concatenate(starts)


def score_toxicity(docs: DataFrame, net: Network | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted, worst_token) of every row.

    worst_token is the first token of the window that decides. A text without
    tokens (null, empty, punctuation) scores 0; without a model every text does.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # the weights: bounded by the sample's vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known = Tokens(model) if model else None
        for batch in batches:
            score, start = batch_scores(model, batch.column(1).to_pylist(), known)
            yield pa.record_batch(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(start)],
                ["doc_id", "score", "predicted", "worst_token"],
            )

    narrow = texts_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int, worst_token long")


def keep_clean(docs: DataFrame, net: Network | None, *, text: str = "text") -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns and no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known = Tokens(model) if model else None
        for batch in batches:
            texts = (None if x is None else x.encode() for x in batch.column(at).to_pylist())
            yield batch.filter(pa.array(batch_scores(model, texts, known)[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)

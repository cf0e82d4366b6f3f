"""Personal data: fixed patterns, and a linear-chain conditional random field on top.

The field labels the words of a line as plain or as one of four kinds. Its
features are word shapes alone: the shape of a word (letters, digit runs by
length, other signs as they are), of the word before and of the word after. It
is trained in numpy from a small labelled table and decoded by Viterbi over many
lines at once. Runs of one label become spans; a span that touches one of the
patterns' is dropped, so the field only adds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import texts_of

#: The kinds in their order, their patterns, and how many digits two of them have.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)
#: Signs without which a pattern cannot match.
NEEDS = ("@", ".", "", "+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the valid matches of each pattern, by start, then kind."""
    out = []
    for kind, (pattern, sign) in enumerate(zip(PATTERNS, NEEDS)):
        if sign not in text:
            continue
        for m in pattern.finditer(text):
            found = m[0]
            if kind == 1:
                ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in found.split("."))
            elif kind == 2:
                digits = found.replace(" ", "").replace("-", "")
                ok = CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
            elif kind == 3:
                ok = PHONE_DIGITS[0] <= sum(map(str.isdigit, found)) <= PHONE_DIGITS[1]
            else:
                ok = True
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    """Letters as a, runs of up to three digits as n, of four as 4, longer ones as D; other signs stay; edge punctuation goes."""
    word = word.strip(".,;:!?\"'")
    out = re.sub(r"[^\W\d_]+", "a", word)
    out = re.sub(r"[0-9]+", lambda m: "nnn4D"[min(len(m[0]), 5) - 1], out)
    return out if len(out) <= 24 else out[:24] + "+"


def labelled_table() -> list[tuple[list[str], list[int]]]:
    """A small labelled table made by rule: words and labels (0 plain, 1 + kind).

    Beside what the patterns find it holds variants that they miss: spelled-out
    addresses, phone numbers without a plus, dotted or grouped numbers.
    """
    rng = np.random.default_rng(11)
    number = lambda *sizes: ["".join(map(str, rng.integers(0, 10, n))) for n in sizes]
    word = lambda: "".join(rng.choice(list("abcdefghiklmnoprstuv"), rng.integers(1, 9)))
    rows = []
    for i in range(360):
        make = i % 12
        n = number(3, 3, 4, 4, 4, 4, 2, 5)
        span = {
            0: (1, [f"{word()}.{n[6]}@{word()}.com"]),
            1: (1, [f"{word()}[at]{word()}[dot]com"]),
            2: (1, [f"{word()}(at){word()}.org"]),
            3: (2, [".".join(number(*rng.integers(1, 4, 4)))]),
            4: (3, n[2:6]),
            5: (3, ["-".join(n[2:6])]),
            6: (4, ["+1", f"({n[0]})", f"{n[1]}-{n[2]}"]),
            7: (4, [f"({n[0]})", f"{n[1]}-{n[2]}"]),
            8: (4, [f"{n[0]}-{n[1]}-{n[2]}"]),
            9: (0, [f"{n[2]}", f"v{n[6]}.{n[0]}", f"{n[6]}:{n[6]}"]),
            10: (0, [f"{word()}={n[7]}{word()}", f"{n[6]}.{n[6]}", f"${n[0]}.{n[6]}", f"{n[6]}%"]),
            11: (0, [f"{word()}-{word()}", f"({word()})", f"{n[7]}{n[2]}", f"{word()}/{word()}"]),
        }[make]
        before = [word() for _ in range(rng.integers(0, 6))]
        after = [word() for _ in range(rng.integers(0, 6))]
        rows.append((before + span[1] + after, [0] * len(before) + [span[0]] * len(span[1]) + [0] * len(after)))
    return rows


class ShapeField:
    """Weights of the field: emissions by shape of the word, its left and right neighbour; transitions."""

    def __init__(self, table: Sequence[tuple[Sequence[str], Sequence[int]]], *, steps: int = 40, rate: float = 0.5, decay: float = 1e-3):
        shapes = sorted({shape(w) for words, _ in table for w in words})
        self.number = {s: i + 2 for i, s in enumerate(shapes)}  # 0: no word there, 1: a shape not seen
        self.labels, self.known = 1 + len(KINDS), {}
        n, m = len(shapes) + 2, self.labels
        self.own, self.left, self.right = (np.zeros((n, m)) for _ in range(3))
        self.step, self.first = np.zeros((m, m)), np.zeros(m)
        self.own[1, 1:] = -2.0  # an unseen shape is plain unless its neighbours speak for more
        rows = [(np.array([self.number[shape(w)] for w in words]), np.array(y)) for words, y in table if len(words)]
        square = [np.full_like(p, 1e-8) for p in self.parameters()]
        for _ in range(steps):
            grads = [-decay * len(rows) * p for p in self.parameters()]
            for ids, y in rows:
                self.gradient(ids, y, grads)
            for p, g, s in zip(self.parameters(), grads, square):
                g /= max(len(rows), 1)
                s += g * g
                p += rate * g / np.sqrt(s)
            self.own[1, 1:] = -2.0

    def parameters(self) -> list[np.ndarray]:
        return [self.own, self.left, self.right, self.step, self.first]

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Scores (…, labels) of words along the last axis of ``ids``; beyond the ends there is no word."""
        before, after = np.zeros_like(ids), np.zeros_like(ids)
        before[..., 1:], after[..., :-1] = ids[..., :-1], ids[..., 1:]
        return self.own[ids] + self.left[before] + self.right[after]

    def gradient(self, ids: np.ndarray, y: np.ndarray, grads: list[np.ndarray]) -> None:
        """Adds observed minus expected features of one sentence."""
        e, n = self.emissions(ids), len(ids)
        fwd, bwd = np.zeros((n, self.labels)), np.zeros((n, self.labels))
        fwd[0] = self.first + e[0]
        for t in range(1, n):
            fwd[t] = np.logaddexp.reduce(fwd[t - 1][:, None] + self.step, axis=0) + e[t]
        for t in range(n - 2, -1, -1):
            bwd[t] = np.logaddexp.reduce(self.step + (e[t + 1] + bwd[t + 1])[None], axis=1)
        z = np.logaddexp.reduce(fwd[-1])
        seen = np.zeros((n, self.labels))
        seen[np.arange(n), y] = 1
        gap = seen - np.exp(fwd + bwd - z)
        before, after = np.append(0, ids[:-1]), np.append(ids[1:], 0)
        for g, at in zip(grads, (ids, before, after)):
            np.add.at(g, at, gap)
        for t in range(1, n):
            pair = np.exp(fwd[t - 1][:, None] + self.step + (e[t] + bwd[t])[None] - z)
            grads[3] -= pair
            grads[3][y[t - 1], y[t]] += 1
        grads[4] += gap[0]

    def decode(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each line by Viterbi; lines of a length run side by side."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(lines)
        lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for low, high in zip(edges, edges[1:]):
            n = int(lengths[order[low]])
            for k in range(low, high if n else low, max(1, 65_536 // max(n, 1))):
                part = order[k : min(k + max(1, 65_536 // n), high)]
                labels = self.viterbi(np.stack([lines[i] for i in part]))
                for i, row in zip(part, labels):
                    out[i] = row
        return out

    def decode_lines(self, ids: np.ndarray, lengths: list[int]) -> list[np.ndarray | None]:
        """The labels of consecutive lines; None where all words are plain.

        Lines of letters alone have equal labels if they are equally long, so
        one of each length is decoded.
        """
        plain = self.number.get("a", 1)
        ends = np.cumsum(lengths)
        odd = np.append(0, np.cumsum(ids != plain))
        first = ends - lengths
        letters = odd[ends] == odd[first]
        sizes = sorted({n for n, x in zip(lengths, letters.tolist()) if x} - self.known.keys())
        self.known.update((n, x if x.any() else None) for n, x in zip(sizes, self.decode([np.full(n, plain) for n in sizes])))
        out: list[np.ndarray | None] = [self.known[n] if x else None for n, x in zip(lengths, letters.tolist())]
        rest = np.flatnonzero(~letters).tolist()
        for i, labels in zip(rest, self.decode([ids[first[i] : ends[i]] for i in rest])):
            out[i] = labels if labels.any() else None
        return out

    def viterbi(self, ids: np.ndarray) -> np.ndarray:
        e = np.ascontiguousarray(self.emissions(ids).transpose(1, 2, 0))  # (words, labels, lines)
        steps, m, lanes = e.shape
        back = np.zeros((steps, m, lanes), np.int8)
        score = self.first[:, None] + e[0]
        for t in range(1, steps):
            best = score[0] + self.step[0][:, None]
            for a in range(1, m):
                other = score[a] + self.step[a][:, None]
                better = other > best
                np.copyto(best, other, where=better)
                back[t][better] = a
            score = best + e[t]
        labels = np.zeros((lanes, steps), np.int8)
        labels[:, -1] = score.argmax(axis=0)
        for t in range(steps - 1, 0, -1):
            labels[:, t - 1] = back[t][labels[:, t], np.arange(lanes)]
        return labels


#: Words as the text contracts cut them.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'"


def added_spans(text: str, at: int, labels: np.ndarray, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of one label in a line that starts at ``at``, without edge punctuation and what touches ``taken``."""
    out, words = [], [m.span() for m in WORD.finditer(text)]
    t = 0
    while t < len(labels):
        end = t
        while end + 1 < len(labels) and labels[end + 1] == labels[t]:
            end += 1
        if labels[t]:
            a, b = words[t][0], words[end][1]
            while a < b and text[a] in EDGES:
                a += 1
            while a < b and text[b - 1] in EDGES:
                b -= 1
            if a < b and not any(s < at + b and at + a < e for s, _, e in taken):
                out.append((at + a, int(labels[t]) - 1, at + b))
        t = end + 1
    return out


def find_personal_data(
    docs: DataFrame, field: ShapeField | None = None, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    The four counts and base_sha256 are those of the patterns' spans; ``spans``
    lists all, the field's too, as kind:start:end by start, then kind (code
    points, end exclusive). A null text is empty. The field defaults to one
    trained on ``labelled_table()``.
    """
    model = field or ShapeField(labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Shapes(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = out = model.number.get(shape(word.decode("utf-8", "replace")), 1)
                return out

        shapes = Shapes()
        show = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        for batch in batches:
            ids, bodies = batch.column(0), [x or b"" for x in batch.column(1).to_pylist()]
            counts, digests, shown, added = [[] for _ in KINDS], [], [], []
            for k in range(0, len(bodies), 1000):
                some = bodies[k : k + 1000]
                split = [[line.split() for line in x.split(b"\n")] for x in some]
                lengths = [len(line) for lines in split for line in lines]
                words = chain.from_iterable(line for lines in split for line in lines)
                labels = iter(model.decode_lines(np.fromiter(map(shapes.__getitem__, words), np.int64, sum(lengths)), lengths))
                if len(shapes) > 500_000:
                    shapes.clear()
                for body, lines in zip(some, split):
                    own = [next(labels) for _ in lines]
                    text = body.decode()
                    base = base_spans(text)
                    more = []
                    if any(x is not None for x in own):
                        at = 0
                        for line, x in zip(text.split("\n"), own):
                            if x is not None:
                                more += added_spans(line, at, x, base)
                            at += len(line) + 1
                    for kind, c in enumerate(counts):
                        c.append(sum(s[1] == kind for s in base))
                    digests.append(sha256(show(base).encode()).hexdigest())
                    shown.append(show(sorted(base + more)))
                    added.append(len(more))
            yield pa.record_batch(
                [ids, *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(shown, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    narrow = texts_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return narrow.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")

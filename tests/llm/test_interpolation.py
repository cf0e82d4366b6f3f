import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from surveyloom.llm import interpolation as L


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return [*out, "<end>"]


def brute(rows):
    """Counts and exact expectation-maximisation, one event at a time."""
    role = lambda i: 2 if i is None or crc32(str(i).encode()) % 7 == 2 else int(crc32(str(i).encode()) % 7 == 3)
    uni, bi, starts = {k: Counter() for k in (0, 1)}, {k: Counter() for k in (0, 1)}, Counter()
    for i, t in rows:
        if role(i) < 2:
            w = words(t)
            uni[role(i)].update(w)
            bi[role(i)].update(zip(["<start>", *w], w))
            starts[role(i)] += 1

    def model(c1, c2, docs):
        n, v = sum(c1.values()), len(c1)

        def parts(w):
            for a, b in zip(["<start>", *w], w):
                ctx = docs if a == "<start>" else c1[a]
                yield min(int(math.log2(ctx + 1)), 20), c2[a, b] / max(ctx, 1), c1[b] / max(n, 1), 1 / (v + 1), c1[b]

        return parts, n, v

    parts, *_ = model(uni[0], bi[0], starts[0])
    weights = np.full((21, 3), 1 / 3)
    events = [e for i, t in rows if role(i) == 1 for e in parts(words(t))]
    for b in {e[0] for e in events}:
        own = np.array([e[1:4] for e in events if e[0] == b])
        for _ in range(60):
            x = own * weights[b]
            weights[b] = (x / x.sum(axis=1, keepdims=True)).mean(axis=0)
    parts, n, v = model(uni[0] + uni[1], bi[0] + bi[1], starts[0] + starts[1])
    out = []
    for i, t in rows:
        e = np.array(list(parts(words(t))))
        w = weights[e[:, 0].astype(int)]
        out.append((i, len(e), int((e[:, 4] > 0).sum()), n, np.log10((e[:, 4] + 1) / (n + v + 1)).sum(), np.log10((w * e[:, 1:4]).sum(axis=1)).sum()))
    return out


def test_equals_brute_force(make, corpus, monkeypatch):
    rows = [*corpus, (None, corpus[1][1])]
    got = L.score_documents(make(rows)).collect()
    key = lambda r: (repr(r[0]), r[1], r[4])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    for a, b in zip(got, sorted(brute(rows), key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
        assert a[5] == pytest.approx(b[5], rel=0.02)


def test_weights_prefer_what_fits():
    w = L.learn_weights([(3, 40, 4, 90), (3, -(10**6), 8, 10)])
    assert w[3, 0] > 0.8 and np.allclose(w.sum(axis=1), 1) and np.allclose(w[5], 1 / 3, atol=1e-3)


def test_empty(make):
    assert L.score_documents(make([])).isEmpty()
    row = L.score_documents(make([(None, None)])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (1, 0, 0, None)

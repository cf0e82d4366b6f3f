import random
from hashlib import sha256
from math import floor

import numpy as np
import pytest

from surveyloom.llm.vector_codes import integers, nearest_entries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, code string, entry int, other int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "v", "c", 1, 2) for i, v, k in rows], SCHEMA)


def brute(rows, entries=256):
    """Plain search over all entries, in Python's integers."""
    finite = lambda v: v and all(x is not None and x == x and abs(x) != float("inf") for x in v)
    kept = [(i, [floor(1024 * float(np.float32(x))) for x in v], k) for i, v, k in rows if finite(v)]
    if not kept:
        return {}, None
    order = sorted(kept, key=lambda r: (r[0], r[1]))
    d = len(kept[0][1]) // 4
    cut = lambda v: [v[p * d : p * d + d] for p in range(4)]
    books = [[cut(v)[p] for _, v, _ in order[:entries]] for p in range(4)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(4):
        for p, book in enumerate(books):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v)[p], book)[1], []).append(cut(v)[p])
            for j, members in groups.items():
                book[j] = [sum(c) // len(members) for c in zip(*members)]
    out, by_label = [], {}
    for i, v, k in kept:
        found = [near(x, book) for x, book in zip(cut(v), books)]
        error = sum(f[0] for f in found)
        by_label[k] = by_label.get(k, 0) + error
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, k))
    digest = sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    most = 2**63 - 1
    return sorted((i, c, min(e, most), min(by_label[k], most)) for i, c, e, k in out), digest


def check(spark, rows, entries=256):
    got = vector_codes(table(spark, rows).repartition(4), entries=entries).collect()
    expected, digest = brute(rows, entries)
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == expected
    assert {r.codebooks_sha256 for r in got} == {digest}


@pytest.mark.parametrize("seed,entries", [(1, 256), (2, 16), (3, 5)])
def test_equals_brute_force(spark, seed, entries):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 1, 8).astype("f4").tolist(), rng.choice([0, 1, 2, None])) for i in rng.permutation(400) * 3]
    rows += [(5000 + i, rows[7][1], 1) for i in range(150)] + [(5000, rows[9][1], 1)] * 2
    check(spark, [(i, v, None if k is None else int(k)) for i, v, k in rows], entries)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, None, 2.0, 3.0], 2), (4, [nan] * 4, 2), (5, [inf, 0.0, 0.0, 0.0], 2), (6, [0.0] * 4, None),
            (7, [0.5, -0.0001, 1e-9, -2.0], None), (7, [0.5, -0.0001, 1e-9, -2.0], None), (8, [-1.0, 1.0, -1.0, 1.0], 3)]
    check(spark, rows)
    assert vector_codes(table(spark, [])).isEmpty()
    assert vector_codes(table(spark, rows[:5])).isEmpty()


def test_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1e-3, 5.0, 1e9, -3e20, 3e38]) * rng.random() for _ in range(8)], i % 2) for i in range(30)]
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows]
    check(spark, rows, 6)


def test_other_lengths(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0, 5.0], 0), (2, [1.0], 0), (3, [7.0] * 5, 0)]
    got = vector_codes(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "00000000", 0), (3, "01010101", 0)]


def test_search_equals_scan():
    rng = np.random.default_rng(6)
    for _ in range(60):
        d = int(rng.integers(1, 6))
        book, points = rng.integers(-4, 5, (int(rng.integers(1, 40)), d)), rng.integers(-5, 6, (30, d))
        index, best = nearest_entries(points, book)
        away = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_integers_floor():
    assert integers(np.array([[0.5, -0.5, -1e-9, 3.0]]), 1024).tolist() == [[512, -512, -1, 3072]]
    assert integers(np.array([[3e38, -2.5e30]]), 1024).tolist() == [[int(3e38) * 1024, int(-2.5e30) * 1024]]

import numpy as np
import pytest

from surveyloom.llm.neighbours import nearest


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "q") for i, v in rows], "vec_id long, embedding array<float>, rank int, q string")


def brute(rows, every=20, k=20):
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 16}
    ids, x = np.array(list(ok)), np.array(list(ok.values()))
    out = {}
    for i in ids[ids % every == 0]:
        s = x @ ok[i]
        order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-round(s[j], 9), ids[j]))[:k]
        out[int(i)] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q, rows in want.items():
        mine = sorted(found.get(q, []))
        assert [r[0] for r in mine] == list(range(1, len(rows) + 1))
        assert all(a[2] >= b[2] - 1e-12 for a, b in zip(mine, mine[1:]))
        hits += len({r[1] for r in mine} & {i for i, _ in rows})
        total += len(rows)
    assert set(found) == {q for q, rows in want.items() if rows}
    return hits / total


@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, unit):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    x = centres[rng.integers(0, 6, 1500)] + 0.7 * rng.standard_normal((1500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None] if unit else 1
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    rows += [(2000 + i, rows[7][1]) for i in range(60)]  # copies
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [1.0]), (None, rows[0][1]), (3080, [None] * 16)]
    assert recall(nearest(table(spark, rows)).collect(), brute(rows)) >= (0.95 if unit else 0.9)


def test_fewer_than_k(spark):
    rows = [(20, [1.0] + [0.0] * 15), (21, [1.0] + [0.0] * 15), (22, [0.5, 0.5] + [0.0] * 14)]
    got = sorted(nearest(table(spark, rows)).collect())
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(20, 1, 21, 1.0), (20, 2, 22, 0.5)]


def test_empty(spark):
    assert nearest(table(spark, [])).isEmpty() and nearest(table(spark, [(20, [1.0])])).isEmpty()


@pytest.mark.parametrize("lengths", ["one long", "spread"])
def test_recall_for_uneven_lengths(spark, lengths):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16))
    if lengths == "spread":
        x *= np.exp(rng.standard_normal(1500))[:, None]
    else:
        x[3] *= 1e4
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    assert recall(nearest(table(spark, rows)).collect(), brute(rows)) >= 0.95

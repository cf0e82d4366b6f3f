"""Dominance counts against brute force, over many blocks, and the running sum they rest on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import dominance, kernels as K

NAMES = ["a", "b", "c"]


def brute(v):
    return {i: int((v >= v[i]).all(axis=1).sum()) for i in range(len(v))}


def ranked(spark, v):
    names = NAMES[: v.shape[1]]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], "k long, " + ", ".join(f"{n} double" for n in names))
    return {r["k"]: r["rank"] for r in K.dominance_rank(df, "k", dict.fromkeys(names, 1)).collect()}


def tables():
    rng = np.random.default_rng(3)
    line = np.sort(rng.normal(size=300))
    hot = rng.normal(size=(300, 2))
    hot[:120, 0] = 0.5
    return {
        "one metric": rng.integers(0, 90, size=(300, 1)),
        "two": rng.normal(size=(300, 2)),
        "rising together": np.column_stack([line, line]),
        "against each other": np.column_stack([line, -line]),
        "a hot value": hot,
        "ties": rng.integers(0, 12, size=(300, 2)),
        "three": rng.integers(0, 9, size=(300, 3)),
        "signed zeros": rng.choice([0.0, -0.0, 1.0], size=(40, 2)),
    }


@pytest.mark.parametrize("name", list(tables()))
def test_equals_brute_force(spark, monkeypatch, name):
    monkeypatch.setattr(K, "RANK_BLOCK", 16)
    v = tables()[name].astype("float64")
    assert ranked(spark, v) == brute(v)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "RANK_BLOCK", 2)
    schema = "m0_ long, a double, b double"
    rows = [(1, 1.0, 1.0), (2, None, 5.0), (3, float("nan"), 5.0), (4, 2.0, float("inf")), (5, 1.0, 1.0), (6, 0.0, 9.0)]
    got = {r[0]: r[1] for r in K.dominance_rank(spark.createDataFrame(rows, schema), "m0_", {"a": 1, "b": 1}).collect()}
    assert got == {1: 3, 4: 1, 5: 3, 6: 2}
    assert K.dominance_rank(spark.createDataFrame([], schema), "m0_", {"a": 1, "b": 1}).count() == 0


def test_running_sum_over_pieces(spark):
    df = spark.range(0, 5_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    got = dominance.running_sum(df.where("g < 2 or o < 5"), ["g"], ["o"], F.col("o"), out="s", total="t").toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("o")
        assert (part["s"] == part["o"].cumsum()).all() and (part["t"] == part["o"].sum()).all()


def test_shuffled_rows_grow_as_n_log_n(spark, monkeypatch):
    """Rows of the halves: at most one per point and level."""
    sent = {}
    settled = dominance._settled
    for n in (1_024, 4_096):
        seen = []
        monkeypatch.setattr(dominance, "_settled", lambda rows, *a: (seen.append(rows.count()), settled(rows, *a))[1])
        points = spark.range(n).selectExpr("cast(id as double) a", "cast(hash(id) as double) b", "1L as n_")
        dominance.dominators(points, ["a", "b"], weight="n_", block=64, out="r").count()
        sent[n] = seen[0]
    assert sent[1_024] <= 1_024 * 4 and sent[4_096] <= 4_096 * 6

"""Row functions, cleaning, quantiles, statistics: hand cases and edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import features, profile, sampling
from surveyloom.operators.ranks import exact_percentiles, group_sizes, rank_select
from surveyloom.plans.study import engineer
from surveyloom.sources import read_table, split_xy, survey_from_orders
from surveyloom.sources.tables import nan_to_null


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_derive_age_clips_and_keeps_null(spark):
    df = spark.createDataFrame([(1, 1973), (2, 1900), (3, 2022), (4, None)], "k int, year_of_birth int")
    assert rows(features.derive_age(df), "k") == [(1, 49), (2, 80), (3, 14), (4, None)]


def test_composite_score_counts_null_as_zero(spark):
    df = spark.createDataFrame([(1, 2, None), (2, None, None)], "k int, a int, b int")
    assert rows(features.composite_score(df, {"t": ["a", "b"]}), "k") == [(1, 2), (2, 0)]


def test_bins_are_right_closed_and_outside_is_nan(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (5,), (27,), (28,), (None,)], "x int")
    bands = [r["band"] for r in features.bin_labels(df, "x", out="band").collect()]
    assert bands == ["nan", "Minimal", "Minimal", "Mild", "Severe", "nan", "nan"]


def test_column_name_collision_is_an_error(spark):
    with pytest.raises(ValueError):
        features.clean_column_names(spark.createDataFrame([(1, 2)], "`A ` int, a int"))


def test_impute_median_skips_absent_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    out = features.impute_median(df, ["a", "b", "c"])
    assert sorted(r["a"] for r in out.collect()) == [1.0, 2.5, 4.0]
    assert all(r["b"] is None for r in out.collect())


def test_scaling_of_constant_column_is_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, x double")
    assert rows(features.standard_scale(df, ["c", "x"]), "x") == [(0.0, -1.0), (0.0, 1.0)]
    assert rows(features.minmax_scale(df, ["c", "x"]), "x") == [(0.0, 0.0), (0.0, 1.0)]


def test_dominant_class_tie_takes_the_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "y string")
    assert features.dominant_class(df, "y") == "a"


def test_nan_is_null_and_label_zero_is_minus_one(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"), 0), (1.0, 1)], "x double, y int")
    assert nan_to_null(df).where("x is null").count() == 1
    assert [r["y"] for r in split_xy(df).collect()] == [-1, 1]
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,\n")
    assert rows(read_table(spark, path), "a") == [(1, "x"), (2, None)]


def test_missing_path_is_reported_with_its_name(spark):
    with pytest.raises(Exception, match="no_such_table"):
        read_table(spark, "/tmp/no_such_table.csv")


@pytest.mark.parametrize("limit", [200_000, 50, 5])
def test_percentiles_are_exact_at_any_bound(spark, limit):
    rng = np.random.default_rng(1)
    a = np.concatenate([rng.normal(size=4000), np.full(3000, 0.25)])  # a hot value
    g = rng.integers(0, 3, size=7000)
    df = spark.createDataFrame([(int(i), float(v)) for i, v in zip(g, a)], "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = exact_percentiles(df, ["v"], probs, limit=limit)[("v",)]
    assert np.allclose(got, np.quantile(a, probs), atol=1e-12)
    by = exact_percentiles(df, ["v"], probs, by="g", limit=limit)
    for k in range(3):
        assert np.allclose(by[(k, "v")], np.quantile(a[g == k], probs), atol=1e-12)


def test_rank_select_returns_table_values(spark):
    values = spark.range(1000).selectExpr("0 as g", "cast((id * 37) % 1000 as double) as value")
    got = rank_select(values, {(0,): [0, 499, 999]}, by=["g"], sizes=group_sizes(values, ["g"]), limit=10, accuracy=100)
    assert got == {(0,): {0: 0.0, 499: 499.0, 999: 999.0}}


def test_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert profile.dataset_overview(df).count() == 2
    assert rows(profile.central_tendency(df, ["a"])) == [("a", None, None)]
    assert profile.mode_all_ties(df, ["a", "b"]).count() == 0
    assert profile.histogram(df, ["a"]).count() == 0
    assert rows(profile.outlier_counts(df, ["a"])) == [("a", 0)]
    assert features.drop_null_rows(df).count() == 0


def test_modes_keep_all_ties(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (2, "x"), (3, None)], "a int, b string")
    assert {(r[0], r[1]) for r in profile.mode_all_ties(df, ["a", "b"]).collect()} == {
        ("a", "1"), ("a", "2"), ("b", "x"), ("b", "y"),
    }


def test_histogram_last_bin_holds_the_maximum_and_empty_bins_stay(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "x double")
    assert [r["n"] for r in profile.histogram(df, ["x"]).orderBy("bin").collect()] == [2, 0, 0, 0, 1]


def test_sample_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = {r[0] for r in sampling.sample_n(df, "k", 300).collect()}
    two = {r[0] for r in sampling.sample_n(df.repartition(17), "k", 300).collect()}
    assert len(one) == 300 and one == two
    assert sampling.sample_n(df, "k", 9000).count() == 5000


def test_split_is_disjoint_and_proportional_per_class(spark):
    df = spark.range(1000).selectExpr("id as k", "case when id % 10 < 7 then 'hot' when id < 990 then 'b' else 'rare' end as y")
    out = sampling.stratified_split(df, "y", "k")
    assert out.count() == 1000 and out.select("k").distinct().count() == 1000
    n = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    sizes = {s: sum(v for (_, t), v in n.items() if t == s) for s in ("train", "validation", "test")}
    assert sizes == {"train": 600, "validation": 200, "test": 200}
    for c, total in df.groupBy("y").count().collect():
        assert abs(n.get((c, "test"), 0) - 0.2 * total) <= 1
        assert abs(n.get((c, "train"), 0) - 0.6 * total) <= 1
    again = sampling.stratified_split(df.repartition(11), "y", "k")
    assert out.exceptAll(again.select(out.columns)).count() == 0


def test_random_split_sizes(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    n = dict(sampling.random_split(df, "k", seed=3).groupBy("split").count().collect())
    assert n == {"train": 70, "test": 31}
    assert sampling.random_split(df, "k", exact=False).where(F.col("split") == "test").count() > 10


def test_correlations_are_pairwise_and_keep_digits_at_large_means(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    x = pd.DataFrame(rng.normal(size=(300, 3)) + [0, 1e7, -3], columns=["a", "b", "c"])
    x["c"] += x["a"]
    x["flat"] = 2.0
    x.iloc[::7, 0], x.iloc[::5, 2] = np.nan, np.nan
    got = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(spark.createDataFrame(x).replace(float("nan"), None), list(x)).collect()}
    want = x.corr()
    assert len(got) == 6 and got["flat", "a"] is None
    assert all(got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9) for a, b in got if a != "flat")


def test_wide_survey_code_is_small_enough_to_be_compiled(spark):
    """HotSpot compiles methods of up to 8,000 bytes; no whole-stage method of the survey may be longer."""
    orders = spark.createDataFrame([(1, 2, 3.0)], "o_orderkey long, o_custkey long, o_totalprice double")
    engineer(survey_from_orders(orders))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8_000

"""Queries: weak kernels, their metrics and weights.

The SQL computes every metric from the dense n×n kernel of the whole
``embeddings`` table, as defined; the queries use class sums of feature maps.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.catalog.registry import query, table
from surveyloom.catalog.tables import rounded
from surveyloom.catalog.views import FEATURES, VEC, clean_survey, vectors
from surveyloom.operators import kernels as K
from surveyloom.plans.full import kernel_strategy_comparison

KERNELS = K.weak_kernel_specs(VEC, 6, seed=42)
POSITIVE = 3
_METRICS = list(K.METRICS)


def _dot_sql(kernel: K.WeakKernel) -> str:
    at = [VEC.index(c) + 1 for c in kernel.columns]
    return "(" + " + ".join(f"a.x[{i}] * b.x[{i}]" for i in at) + f") ** {kernel.degree}"


# k(a, b) for every kernel and every pair of rows, the rows being all of ``embeddings``.
DENSE_CTE = (
    "points as (select vec_id, cast(label as int) as label, cast(embedding as double[]) as x from embeddings),\n"
    "cells as ("
    + "\nunion all ".join(
        f"select {i} as kernel, a.vec_id as a, b.vec_id as b, a.label as la, b.label as lb, {_dot_sql(k)} as k from points a, points b"
        for i, k in enumerate(KERNELS)
    )
    + ")"
)

# The four metrics for each kernel and class, one class against the rest.
METRICS_CTE = DENSE_CTE + """,
classes as (select distinct label as c from points CLASS_FILTER),
diag as (select kernel, a as i, k as kii from cells where a = b),
signed as (select kernel, c, a, b, k, case when la = c then 1 else -1 end as ya, case when lb = c then 1 else -1 end as yb
  from cells, classes),
basic as (select s.kernel, c, sum(k * ya * yb) / (sqrt(sum(k * k)) * sqrt(count(*))) as alignment,
  sum(-ya * yb * (da.kii + db.kii - 2 * k)) as polarization, sum(case when a = b then k end) as complex_ratio
  from signed s join diag da on da.kernel = s.kernel and da.i = a join diag db on db.kernel = s.kernel and db.i = b group by 1, 2),
sides as (select kernel, c, a, ya, avg(case when yb = ya then k end) as same, avg(case when yb <> ya then k end) as cross_
  from signed group by 1, 2, 3, 4),
means as (select kernel, c, ya, avg(same) as same, avg(cross_) as cross_, count(*) as n from sides group by 1, 2, 3),
phi as (select kernel, c, sum(same - cross_) as phi from means group by 1, 2),
terms as (select s.kernel, s.c, s.ya, sum((s.cross_ - s.same + m.same - m.cross_) ** 2) / (any_value(phi) * (any_value(n) - 1)) as t,
  any_value(phi) as phi from sides s join means m on m.kernel = s.kernel and m.c = s.c and m.ya = s.ya
  join phi p on p.kernel = s.kernel and p.c = s.c group by 1, 2, 3),
fsm as (select kernel, c, sum(sqrt(t)) / sqrt(any_value(phi)) as fsm from terms group by 1, 2),
metrics as (select basic.kernel, basic.c, alignment, polarization, fsm as "FSM", complex_ratio
  from basic join fsm on basic.kernel = fsm.kernel and basic.c = fsm.c)"""

ONE_CTE = METRICS_CTE.replace("CLASS_FILTER", f"where label = {POSITIVE}")
ALL_CTE = METRICS_CTE.replace("CLASS_FILTER", "")
DIGITS = 5


def _metric_select(name: str) -> str:
    return f'with {ONE_CTE} select kernel, round("{name}", {DIGITS}) as "{name}" from metrics'


def one_class_metrics(spark, sf_dir):
    return K.kernel_metrics(vectors(spark, sf_dir), VEC, "label", KERNELS, positive=POSITIVE)


@query("weak_kernel_specs")
def _weak_kernel_specs(spark, sf_dir):
    columns = [c for c in clean_survey(spark, sf_dir).columns if c in FEATURES]
    return K.specs_table(spark, K.weak_kernel_specs(columns, 15, seed=42))


_MAP_KERNEL = K.WeakKernel(("x2", "x5", "x2"), 3)


def _map_sql(kernel: K.WeakKernel) -> str:
    terms = ", ".join(
        f"round({c!r} * " + " * ".join(f"cast(embedding[{VEC.index(kernel.columns[p]) + 1}] as double)" for p in pos) + ", 8)"
        for pos, c in kernel.terms()
    )
    return f"[{terms}]"


@query(
    "poly_feature_map",
    sql=f"select vec_id, unnest({_map_sql(_MAP_KERNEL)}) as value, unnest(range({_MAP_KERNEL.width}))::int as pos from embeddings",
)
def _poly_feature_map(spark, sf_dir):
    mapped = K.poly_feature_map(vectors(spark, sf_dir), _MAP_KERNEL, keep=["vec_id"])
    return mapped.select("vec_id", F.posexplode("phi").alias("pos", "value")).withColumn("value", F.round("value", 8))


_PAIR_SQL = (
    "with points as (select vec_id, cast(label as int) as label, cast(embedding as double[]) as x from embeddings), "
    "anchors as (select min(vec_id) as anchor from points group by label) "
)


def _anchors(v):
    return v.join(F.broadcast(v.groupBy("label").agg(F.min("vec_id").alias("vec_id"))), ["label", "vec_id"], "left_semi")


@query(
    "pairwise_kernel",
    sql=_PAIR_SQL + f"select a.vec_id, b.vec_id as anchor, round({_dot_sql(_MAP_KERNEL)}, 8) as k "
    "from points a, points b where b.vec_id in (from anchors)",
)
def _pairwise_kernel(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return K.pairwise_kernel(v, _MAP_KERNEL, "vec_id", _anchors(v)).withColumn("k", F.round("k", 8))


@query(
    "ideal_kernel",
    sql=_PAIR_SQL + "select a.vec_id, b.vec_id as anchor, case when a.label = b.label then 1 else -1 end as ideal "
    "from points a, points b where b.vec_id in (from anchors)",
)
def _ideal_kernel(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return K.ideal_kernel(v, "vec_id", "label", _anchors(v))


def _register_metric(key: str, name: str):
    @query(key, sql=_metric_select(name))
    def run(spark, sf_dir):
        return rounded(one_class_metrics(spark, sf_dir).select("kernel", name), [name], DIGITS)


for _key, _name in (
    ("kernel_alignment", "alignment"), ("kernel_polarization", "polarization"),
    ("kernel_fsm", "FSM"), ("kernel_trace", "complex_ratio"),
):
    _register_metric(_key, _name)


@query(
    "kernel_metrics_ovr",
    sql=f"with {ALL_CTE} select kernel, "
    + ", ".join(f'round(avg("{m}"), {DIGITS}) as "{m}"' for m in _METRICS)
    + " from metrics group by 1",
)
def _kernel_metrics_ovr(spark, sf_dir):
    return rounded(K.kernel_metrics_ovr(vectors(spark, sf_dir), VEC, "label", KERNELS), _METRICS, DIGITS)


def mean_gap(pos: K.ClassSums, neg: K.ClassSums) -> float:
    """A caller's own metric: distance of the class means in feature space."""
    w = pos.total / pos.n - neg.total / neg.n
    return float((w @ w) ** 0.5)


@query(
    "custom_kernel_metrics",
    sql=f"with {ONE_CTE} select kernel, round(sqrt(phi), {DIGITS}) as mean_gap from phi",
)
def _custom_kernel_metrics(spark, sf_dir):
    m = K.kernel_metrics(
        vectors(spark, sf_dir), VEC, "label", KERNELS, positive=POSITIVE, metrics={"mean_gap": (mean_gap, 1)}
    )
    return rounded(m, ["mean_gap"], DIGITS)


_RANK_CTE = ONE_CTE + """,
ranks as (select i.kernel, count(*) filter (where j.alignment >= i.alignment and j."FSM" >= i."FSM") as forward,
  count(*) filter (where j.alignment <= i.alignment and j."FSM" <= i."FSM") as backward from metrics i, metrics j group by 1)"""
_DIRECTIONS = {"alignment": 1, "FSM": 1}


@query("dominance_rank", sql=f"with {_RANK_CTE} select kernel, forward as rank from ranks")
def _dominance_rank(spark, sf_dir):
    return K.dominance_rank(one_class_metrics(spark, sf_dir), "kernel", _DIRECTIONS)


@query(
    "dominance_rank_rows",
    sql="with m as (select c_custkey, c_acctbal, count(o_orderkey) as orders from customer join orders on c_custkey = o_custkey group by 1, 2) "
    "select i.c_custkey, count(*) as rank from m i join m j on j.c_acctbal >= i.c_acctbal and j.orders >= i.orders group by 1",
)
def _dominance_rank_rows(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    m = c.join(o, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey", "c_acctbal").agg(F.count("*").alias("orders"))
    return K.dominance_rank(m, "c_custkey", {"c_acctbal": 1, "orders": 1})


@query(
    "rank_weights",
    sql=f"with {_RANK_CTE} select kernel, forward as rank, round(forward ** 2 / sum(forward ** 2) over (), 6) as weight from ranks",
)
def _rank_weights(spark, sf_dir):
    ranks = K.dominance_rank(one_class_metrics(spark, sf_dir), "kernel", _DIRECTIONS)
    return rounded(K.rank_weights(ranks, "rank", power=2), ["weight"])


_WEIGHTS_CTE = _RANK_CTE + """,
raised as (select kernel, (count(*) over () - forward + 1) ** 2 as nat, backward ** 2 as opp from ranks),
weights as (select kernel, nat / sum(nat) over () as w_natural, opp / sum(opp) over () as w_antinatural from raised)"""


@query(
    "extremality_weights",
    sql=f"with {_WEIGHTS_CTE} select kernel, round(w_natural, 6) as w_natural, round(w_antinatural, 6) as w_antinatural from weights",
)
def _extremality_weights(spark, sf_dir):
    w = K.extremality_weights(one_class_metrics(spark, sf_dir), power=2)
    return rounded(w, ["w_natural", "w_antinatural"])


@query(
    "combined_kernel",
    sql=f"with {_WEIGHTS_CTE}, anchors as (select min(vec_id) as anchor from points group by label) "
    "select a as vec_id, b as anchor, round(sum(w_natural * k), 8) as k from cells join weights using (kernel) "
    "where b in (from anchors) group by 1, 2",
)
def _combined_kernel(spark, sf_dir):
    v = vectors(spark, sf_dir)
    weights = K.extremality_weights(one_class_metrics(spark, sf_dir), power=2).orderBy("kernel").collect()
    combined = K.combined_map_sql(KERNELS, [r["w_natural"] for r in weights])
    mapped = v.selectExpr("vec_id", f"{combined} as phi")
    rows = K.anchor_products(mapped, _anchors(v).selectExpr("vec_id", f"{combined} as phi"), "vec_id")
    return rows.withColumn("k", F.round("k", 8))


@query(
    "kernel_weight_top3",
    sql=f"with {_WEIGHTS_CTE}, long as (select 'natural' as ordering, kernel, w_natural as w from weights "
    "union all select 'antinatural', kernel, w_antinatural from weights) select ordering, kernel, round(w, 6) as weight, "
    "row_number() over (partition by ordering order by round(w, 9) desc, kernel desc) <= 3 as top3 from long",
)
def _kernel_weight_top3(spark, sf_dir):
    w = K.extremality_weights(one_class_metrics(spark, sf_dir), power=2)
    w = rounded(w, ["w_natural", "w_antinatural"], 9)
    return rounded(K.kernel_weight_top3(w), ["weight"])


@query(
    "metric_minmax_by_kernel",
    sql=f"with {ONE_CTE} select kernel, "
    + ", ".join(
        f'round(("{m}" - min("{m}") over ()) / (max("{m}") over () - min("{m}") over ()), {DIGITS}) as "{m}"' for m in _METRICS
    )
    + " from metrics",
)
def _metric_minmax_by_kernel(spark, sf_dir):
    return rounded(K.metric_minmax_by_kernel(one_class_metrics(spark, sf_dir), _METRICS), _METRICS, DIGITS)


@query("kernel_strategy_comparison")
def _kernel_strategy_comparison(spark, sf_dir):
    df = clean_survey(spark, sf_dir).selectExpr(
        "resp_id", *FEATURES, "if(phq9_category = 'Severe', 1, -1) as severe"
    )
    return kernel_strategy_comparison(df, "resp_id", FEATURES, "severe", kernels_list=(5, 10, 15), n_iterations=10)

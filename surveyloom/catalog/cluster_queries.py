"""Queries: projections and clustering.

Distance work runs on ``embeddings`` (64 columns); fitted clusterings on the
standardised survey.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.catalog.registry import query, table
from surveyloom.catalog.tables import rounded
from surveyloom.catalog.views import CLEAN_CTE, FEATURES, NUMERIC, VEC, clean_survey, vectors
from surveyloom.config import SEVERITY_LABELS
from surveyloom.functions import local_table
from surveyloom.operators import cluster, features, reduce
from surveyloom.operators.cluster.assign import cluster_centres

EPS = 1.15

POINTS_CTE = """
points as (select vec_id, cast(label as int) as label, cast(embedding as double[]) as x from embeddings),
dims as (select vec_id, label, unnest(x) as v, unnest(range(1, 65)) as d from points),
means as (select label, d, avg(v) as v from dims group by 1, 2),
centres as (select label, list(v order by d) as c from means group by 1),
pairs as (select a.vec_id as a, b.vec_id as b, a.label as la, b.label as lb, list_distance(a.x, b.x) as dist
  from points a, points b)"""

SILHOUETTE_CTE = """
sizes as (select label, count(*) as n from points group by 1),
sums as (select a, la, lb, sum(dist) as s from pairs group by 1, 2, 3),
near as (select a, la, max(case when lb = la then s / (n - 1) end) as own, min(case when lb <> la then s / n end) as other
  from sums join sizes on lb = label group by 1, 2),
widths as (select case when own is null then 0 else (other - own) / greatest(own, other) end as s from near)"""

BOULDIN_CTE = """
spreads as (select p.label, avg(list_distance(x, c)) as s from points p join centres using (label) group by 1),
ratios as (select i.label, max((si.s + sj.s) / list_distance(i.c, j.c)) as r
  from centres i join centres j on i.label <> j.label
  join spreads si on si.label = i.label join spreads sj on sj.label = j.label group by 1)"""


def standardised_survey(spark, sf_dir):
    df = clean_survey(spark, sf_dir).select("resp_id", *NUMERIC)
    return features.standard_scale(df, FEATURES)


def label_centres(v):
    return [list(row[2:]) for row in cluster_centres(v, VEC, "label")]


@query("pca_project")
def _pca_project(spark, sf_dir):
    scores, _ = reduce.pca_project(clean_survey(spark, sf_dir), "resp_id", NUMERIC, 3)
    return rounded(scores, ["pc1", "pc2", "pc3"])


@query("pca_explained")
def _pca_explained(spark, sf_dir):
    _, explained = reduce.pca_project(clean_survey(spark, sf_dir), "resp_id", NUMERIC, 3)
    return rounded(explained, ["percent"])


@query("pca_plot_sample")
def _pca_plot_sample(spark, sf_dir):
    return reduce.pca_plot_sample(clean_survey(spark, sf_dir), "resp_id", NUMERIC, "phq9_total")


@query("kmeans_sweep")
def _kmeans_sweep(spark, sf_dir):
    return cluster.kmeans_sweep(standardised_survey(spark, sf_dir), "resp_id", FEATURES)[0]


_WIDTH_SQL = (
    "least(floor((o_totalprice - {low}) / {span} * {k}), {k} - 1)"
)


@query(
    "elbow_k",
    sql="with r as (select min(o_totalprice) as low, max(o_totalprice) - min(o_totalprice) as span from orders), "
    "ks as (select unnest(range(2, 11)) as k), "
    f"parts as (select k, {_WIDTH_SQL.format(low='low', span='span', k='k')} as c, o_totalprice as x from orders, r, ks), "
    "inertia as (select k, sum(w) as w from (select k, c, var_pop(x) * count(*) as w from parts group by 1, 2) group by 1), "
    "bends as (select k, lead(w) over (order by k) - 2 * w + lag(w) over (order by k) as bend from inertia) "
    "select cast(k as int) as k, round(bend / 1e9, 3) as bend_billions from bends where bend is not null order by bend desc, k limit 1",
)
def _elbow_k(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_totalprice")
    low, span = o.selectExpr("min(o_totalprice)", "max(o_totalprice) - min(o_totalprice)").first()
    widths = {k: _WIDTH_SQL.format(low=f"{low!r}D", span=f"{span!r}D", k=k) for k in range(2, 11)}
    best = cluster.elbow_k(cluster.within_sums(o, ["o_totalprice"], widths))
    return best.select("k", F.round(F.col("bend") / 1e9, 3).alias("bend_billions"))


@query("kmeans_fit")
def _kmeans_fit(spark, sf_dir):
    s = standardised_survey(spark, sf_dir)
    fit = cluster.partition.best_kmeans(s, FEATURES, [5])[5]
    return cluster.kmeans_fit(s, "resp_id", FEATURES, fit)


@query(
    "nearest_centroid",
    sql=f"with {POINTS_CTE}, d as (select vec_id, centres.label as c, list_distance(x, c) as dist from points, centres) "
    "select vec_id, cast(c as int) as cluster from d qualify row_number() over (partition by vec_id order by dist, c) = 1",
)
def _nearest_centroid(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return cluster.nearest_centroid(v, VEC, label_centres(v)).select("vec_id", "cluster")


@query(
    "fcm_membership_step",
    sql=f"with {POINTS_CTE}, w as (select vec_id, centres.label as c, 1 / list_distance(x, c) ** 2 as w from points, centres), "
    "u as (select vec_id, c, (w / sum(w) over (partition by vec_id)) ** 2 as u2 from w) "
    "select cast(c as int) as cluster, cast(d - 1 as int) as dim, round(sum(u2 * v) / sum(u2), 6) as value "
    "from u join dims using (vec_id) group by 1, 2",
)
def _fcm_membership_step(spark, sf_dir):
    v = vectors(spark, sf_dir)
    step = cluster.fcm_membership_step(v, VEC, label_centres(v))
    values = F.array(*VEC)
    return step.select("cluster", F.posexplode(values).alias("dim", "value")).withColumn("value", F.round("value", 6))


@query("fuzzy_cmeans")
def _fuzzy_cmeans(spark, sf_dir):
    return cluster.fuzzy_cmeans(standardised_survey(spark, sf_dir), "resp_id", FEATURES, 5)[0]


@query("fcm_memberships")
def _fcm_memberships(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return cluster.fuzzy.membership_columns(v, "vec_id", VEC, label_centres(v))


@query(
    "dbscan_eps",
    sql=f"with {POINTS_CTE}, fourth as (select a, dist from pairs qualify row_number() over (partition by a order by dist) = 4) "
    "select round(greatest(quantile_cont(dist, 0.01), 0.5), 6) as eps from fourth",
)
def _dbscan_eps(spark, sf_dir):
    eps = cluster.dbscan_eps(vectors(spark, sf_dir), "vec_id", VEC)
    return rounded(local_table(spark, [(eps,)], "eps double"), ["eps"])


@query(
    "dbscan",
    sql=f"with recursive {POINTS_CTE}, near as (select a, b from pairs where dist <= {EPS}), "
    "core as (select a from near group by a having count(*) >= 5), "
    "edges as (select a, b from near where a in (from core) and b in (from core)), "
    "reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a), "
    "labels as (select a, min(b) as label from reach group by a), "
    "border as (select n.a, min(l.label) as label from near n join labels l on n.b = l.a where n.a not in (from core) group by 1), "
    "found as (from labels union all from border), "
    "numbered as (select a, cast(dense_rank() over (order by label) - 1 as int) as cluster from found) "
    "select vec_id, coalesce(cluster, -1) as cluster from points left join numbered on vec_id = a",
)
def _dbscan(spark, sf_dir):
    return cluster.dbscan(vectors(spark, sf_dir), "vec_id", VEC, EPS)


@query(
    "subtractive_potential",
    sql=f"with {POINTS_CTE} select a as vec_id, round(sum(exp(-1.0 * dist * dist)), 6) as potential from pairs group by 1",
)
def _subtractive_potential(spark, sf_dir):
    p = cluster.subtractive_potential(vectors(spark, sf_dir), "vec_id", VEC, radius=2.0)
    return p.select("vec_id", F.round("potential", 6).alias("potential"))


@query(
    "subtractive_first_centre",
    sql=f"with {POINTS_CTE}, p as (select a, sum(exp(-1.0 * dist * dist)) as s from pairs group by 1), "
    "top as (select a from p order by s desc, a limit 1) "
    "select cast(d - 1 as int) as dim, round(v, 6) as value from dims join top on vec_id = a",
)
def _subtractive_first_centre(spark, sf_dir):
    p = cluster.subtractive_potential(vectors(spark, sf_dir), "vec_id", VEC, radius=2.0)
    centre = cluster.subtractive_centres(p, "vec_id", VEC, r_a=2.0, r_b=3.0, max_centres=1)[0]
    return rounded(local_table(spark, list(enumerate(centre)), "dim int, value double"), ["value"])


@query("subtractive_cluster")
def _subtractive_cluster(spark, sf_dir):
    return cluster.subtractive_cluster(standardised_survey(spark, sf_dir), "resp_id", FEATURES)[0]


@query("agglomerative")
def _agglomerative(spark, sf_dir):
    return cluster.agglomerative(standardised_survey(spark, sf_dir), "resp_id", FEATURES, 5)


@query("silhouette", sql=f"with {POINTS_CTE}, {SILHOUETTE_CTE} select round(avg(s), 6) as silhouette from widths")
def _silhouette(spark, sf_dir):
    score = cluster.silhouette(vectors(spark, sf_dir), "vec_id", VEC, "label")
    return rounded(local_table(spark, [(score,)], "silhouette double"), ["silhouette"])


@query("silhouette_sq")
def _silhouette_sq(spark, sf_dir):
    score = cluster.silhouette_squared(vectors(spark, sf_dir), VEC, "label")
    return rounded(local_table(spark, [(score,)], "silhouette double"), ["silhouette"])


@query("davies_bouldin", sql=f"with {POINTS_CTE}, {BOULDIN_CTE} select round(avg(r), 6) as davies_bouldin from ratios")
def _davies_bouldin(spark, sf_dir):
    score = cluster.davies_bouldin(vectors(spark, sf_dir), VEC, "label")
    return rounded(local_table(spark, [(score,)], "davies_bouldin double"), ["davies_bouldin"])


@query(
    "cluster_summary",
    sql=f"with {POINTS_CTE}, {SILHOUETTE_CTE}, {BOULDIN_CTE} select (select count(distinct label) from points) as n_clusters, "
    "(select round(avg(s), 4) from widths) as silhouette, (select round(avg(r), 4) from ratios) as davies_bouldin",
)
def _cluster_summary(spark, sf_dir):
    s = cluster.cluster_summary(vectors(spark, sf_dir), "vec_id", VEC, "label")
    return local_table(
        spark, [(s["N_Clusters"], s["Silhouette"], s["Davies_Bouldin"])],
        "n_clusters long, silhouette double, davies_bouldin double",
    )


@query(
    "relabel_by_rank",
    sql=f"with {CLEAN_CTE}, grouped as (select resp_id, phq9_total, cast(4 - least(floor(pss_total / 9), 4) as int) as cluster from clean), "
    "medians as (select cluster, median(phq9_total) as m from grouped group by 1), "
    f"ranked as (select cluster, ({SEVERITY_LABELS})[row_number() over (order by m, cluster)] as cluster_label from medians) "
    "select resp_id, cluster, cluster_label from grouped join ranked using (cluster)",
)
def _relabel_by_rank(spark, sf_dir):
    g = clean_survey(spark, sf_dir).selectExpr(
        "resp_id", "phq9_total", "cast(4 - least(floor(pss_total / 9), 4) as int) as cluster"
    )
    return cluster.relabel_by_rank(g, "cluster", "phq9_total").select("resp_id", "cluster", "cluster_label")

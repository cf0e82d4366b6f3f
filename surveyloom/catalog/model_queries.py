"""Queries: trained models, and the evaluation of predictions.

Evaluation is checked on two predictors that both engines can compute: the
other two questionnaire totals, rescaled to the target's range, and their
severity bands.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.catalog.registry import query, table
from surveyloom.catalog.tables import STRATIFIED_CTE, rounded, split_survey
from surveyloom.catalog.views import CLEAN_CTE, clean_survey
from surveyloom.config import SEVERITY_EDGES, SEVERITY_LABELS, SurveyConfig
from surveyloom.operators import evaluate, models, report
from surveyloom.operators.cluster.assign import as_vectors
from surveyloom.operators.forest import node_table
from surveyloom.plans import supervised

CONFIG = SurveyConfig()
PREDICTORS = {"GAD_Scaled": "cast(gad_total as double) * 9 / 7", "PSS_Scaled": "27 * sqrt(cast(pss_total as double) / 40)"}
_BAND = (
    "case " + " ".join(f"when {{p}} <= {e} then '{s}'" for e, s in zip(SEVERITY_EDGES[1:-1], SEVERITY_LABELS))
    + f" else '{SEVERITY_LABELS[-1]}' end"
)
_SPLIT = "case split when 'validation' then 'Validation' else 'Test' end as split"

PREDICTIONS_CTE = (
    f"{CLEAN_CTE}, {STRATIFIED_CTE},\nreg as ("
    + " union all ".join(
        f"select '{m}' as model, {_SPLIT}, resp_id, cast(phq9_total as double) as y, {sql} as prediction from parts where split <> 'train'"
        for m, sql in PREDICTORS.items()
    )
    + "),\nclf as ("
    + " union all ".join(
        f"select '{m}' as model, {_SPLIT}, resp_id, phq9_category as y, {_BAND.format(p='(' + sql + ')')} as prediction from parts where split <> 'train'"
        for m, sql in PREDICTORS.items()
    )
    + ")"
)
REG_METRICS_CTE = (
    PREDICTIONS_CTE + ",\nreg_metrics as (select model, split, round(avg((y - prediction) ** 2), 4) as \"MSE\", "
    "round(sqrt(avg((y - prediction) ** 2)), 4) as \"RMSE\", round(avg(abs(y - prediction)), 4) as \"MAE\", "
    "round(1 - avg((y - prediction) ** 2) / var_pop(y), 4) as \"R2\" from reg group by 1, 2)"
)
CONFUSION_CTE = (
    PREDICTIONS_CTE + f",\nlabels as (select unnest({SEVERITY_LABELS}) as c), runs as (select distinct model, split from clf), "
    "tallies as (select model, split, y, prediction, count(*) as n from clf group by all), "
    "confusion as (select r.model, r.split, a.c as actual, p.c as predicted, coalesce(n, 0) as n from runs r, labels a, labels p "
    "left join tallies k on k.model = r.model and k.split = r.split and k.y = a.c and k.prediction = p.c)"
)
SCORES_CTE = (
    CONFUSION_CTE + ",\nsides as (select r.model, r.split, c as class, "
    "(select sum(n) from confusion x where x.model = r.model and x.split = r.split and actual = c and predicted = c) as tp, "
    "(select sum(n) from confusion x where x.model = r.model and x.split = r.split and actual = c) as support, "
    "(select sum(n) from confusion x where x.model = r.model and x.split = r.split and predicted = c) as predicted, "
    "(select sum(n) from confusion x where x.model = r.model and x.split = r.split) as total from runs r, labels), "
    "pr as (select *, case when predicted = 0 then 0 else tp / predicted end as precision, "
    "case when support = 0 then 0 else tp / support end as recall from sides), "
    "scores as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1 from pr), "
    "report as (select model, split, class, precision, recall, f1, cast(support as bigint) as support from scores "
    "union all select model, split, 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from scores group by 1, 2 "
    "union all select model, split, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
    "sum(f1 * support) / sum(support), cast(sum(support) as bigint) from scores group by 1, 2), "
    "sens as (select model, split, class, round(recall, 4) as \"Sensitivity\", "
    "round(case when total = support then 0 else (total - support - predicted + tp) / (total - support) end, 4) as \"Specificity\" from scores), "
    "acc as (select model, split, round(avg(case when y = prediction then 1.0::double else 0 end), 4) as \"Accuracy\" from clf group by 1, 2), "
    "f1s as (select model, split, round(f1, 4) as \"Macro_F1\" from report where class = 'macro avg')"
)


def _held_out(spark, sf_dir):
    return split_survey(spark, sf_dir).where("split <> 'train'").withColumn(
        "split", F.expr("if(split = 'validation', 'Validation', 'Test')")
    )


def regression_table(spark, sf_dir):
    variants = ", ".join(f"struct('{m}' as model, {sql} as prediction)" for m, sql in PREDICTORS.items())
    return _held_out(spark, sf_dir).selectExpr("split", "resp_id", "cast(phq9_total as double) as y", f"inline(array({variants}))")


def classification_table(spark, sf_dir):
    variants = ", ".join(
        f"struct('{m}' as model, {_BAND.format(p='(' + sql + ')')} as prediction)" for m, sql in PREDICTORS.items()
    )
    return _held_out(spark, sf_dir).selectExpr("split", "resp_id", "phq9_category as y", f"inline(array({variants}))")


def confusion_table(spark, sf_dir):
    return evaluate.confusion_matrix(classification_table(spark, sf_dir), SEVERITY_LABELS)


def metrics_table(spark, sf_dir):
    return evaluate.regression_rows(regression_table(spark, sf_dir)).unionByName(
        evaluate.classification_metrics(classification_table(spark, sf_dir), SEVERITY_LABELS)
    )


@query("regression_metrics", sql=f"with {REG_METRICS_CTE} from reg_metrics")
def _regression_metrics(spark, sf_dir):
    return evaluate.regression_metrics(regression_table(spark, sf_dir))


@query("confusion_matrix", sql=f"with {CONFUSION_CTE} from confusion")
def _confusion_matrix(spark, sf_dir):
    return confusion_table(spark, sf_dir)


@query(
    "classification_report",
    sql=f"with {SCORES_CTE} select model, split, class, round(precision, 6) as precision, round(recall, 6) as recall, "
    "round(f1, 6) as f1, support from report",
)
def _classification_report(spark, sf_dir):
    return rounded(evaluate.classification_report(confusion_table(spark, sf_dir)), ["precision", "recall", "f1"])


@query("accuracy", sql=f"with {SCORES_CTE} from acc")
def _accuracy(spark, sf_dir):
    return evaluate.accuracy(classification_table(spark, sf_dir))


@query("sensitivity_specificity", sql=f"with {SCORES_CTE} from sens")
def _sensitivity_specificity(spark, sf_dir):
    return evaluate.sensitivity_specificity(confusion_table(spark, sf_dir))


def _board_sql(source: str, names: list[str], extra: str = "") -> str:
    picks = ", ".join(
        f"max(case when split = '{s}' then \"{m}\" end) as \"{short}_{m.replace('_', '')}\""
        for s, short in (("Validation", "Val"), ("Test", "Test")) for m in names
    )
    return f"select model, {picks} from {source} {extra} group by 1"


@query("model_leaderboard", sql=f"with {SCORES_CTE} " + _board_sql("acc join f1s using (model, split)", ["Accuracy", "Macro_F1"]))
def _model_leaderboard(spark, sf_dir):
    return report.model_leaderboard(metrics_table(spark, sf_dir), "Classification")


@query("regression_leaderboard", sql=f"with {REG_METRICS_CTE} " + _board_sql("reg_metrics", ["R2", "RMSE", "MAE", "MSE"]))
def _regression_leaderboard(spark, sf_dir):
    return report.model_leaderboard(metrics_table(spark, sf_dir), "Regression")


@query(
    "sens_spec_table",
    sql=f"with {SCORES_CTE} select model, split, class, \"Sensitivity\" as sensitivity, \"Specificity\" as specificity from sens",
)
def _sens_spec_table(spark, sf_dir):
    return report.sens_spec_table(metrics_table(spark, sf_dir))


@query(
    "best_model",
    sql=f"with {SCORES_CTE} select model, \"Accuracy\" as value from acc where split = 'Validation' order by value desc, model limit 1",
)
def _best_model(spark, sf_dir):
    return report.best_model(metrics_table(spark, sf_dir))


@query(
    "model_comparison",
    sql=f"with {REG_METRICS_CTE} select cast(row_number() over (order by \"R2\", model) as int) as position, model, \"R2\" as value "
    "from reg_metrics where split = 'Validation'",
)
def _model_comparison(spark, sf_dir):
    return report.model_comparison(metrics_table(spark, sf_dir), "R2")


@query(
    "pred_vs_actual",
    sql=f"with {PREDICTIONS_CTE} select model, split, resp_id, y, round(prediction, 6) as prediction, "
    "round(min(least(y, prediction)) over (partition by model, split), 6) as low, "
    "round(max(greatest(y, prediction)) over (partition by model, split), 6) as high from reg",
)
def _pred_vs_actual(spark, sf_dir):
    return rounded(evaluate.pred_vs_actual(regression_table(spark, sf_dir)), ["prediction", "low", "high"])


@query(
    "balanced_weights",
    sql="with n as (select event_type, count(*) as c from events group by 1) "
    "select event_id, event_type, round((select sum(c) from n) / ((select count(*) from n) * c), 6) as weight from events join n using (event_type)",
)
def _balanced_weights(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rounded(models.balanced_weights(e, "event_type"), ["weight"])


@query(
    "linear_regression",
    sql="select 'intercept' as term, round(regr_intercept(l_extendedprice, l_quantity), 3) as coefficient from lineitem "
    "union all select 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 3) from lineitem",
)
def _linear_regression(spark, sf_dir):
    lines = as_vectors(table(spark, sf_dir, "lineitem"), ["l_quantity"], keep=["l_extendedprice"])
    model = models.fit_linear_regression(lines, "l_extendedprice")
    return rounded(models.linear_coefficients(model, ["l_quantity"], spark), ["coefficient"], 3)


@query(
    "simple_linear_fit",
    sql="select round(regr_slope(l_extendedprice, l_quantity), 3) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept, "
    "round(regr_r2(l_extendedprice, l_quantity), 6) as r2 from lineitem",
)
def _simple_linear_fit(spark, sf_dir):
    fit = models.simple_linear_fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(rounded(fit, ["slope", "intercept"], 3), ["r2"])


def prepared(spark, sf_dir):
    return supervised.prepare(clean_survey(spark, sf_dir), CONFIG, label="phq9_category")


def _register_regressor(key: str, name: str):
    @query(key)
    def run(spark, sf_dir):
        return supervised.regression_predictions(prepared(spark, sf_dir), CONFIG, [name])


def _register_classifier(key: str, name: str):
    @query(key)
    def run(spark, sf_dir):
        return supervised.classification_predictions(prepared(spark, sf_dir), CONFIG, [name])


for _key, _name in (
    ("decision_tree_reg", "Decision_Tree_Reg"), ("random_forest_reg", "Random_Forest_Reg"),
    ("gradient_boosting_reg", "Gradient_Boosting_Reg"),
):
    _register_regressor(_key, _name)
for _key, _name in (
    ("logistic_regression", "Logistic_Regression"), ("decision_tree_clf", "Decision_Tree_Clf"),
    ("random_forest_clf", "Random_Forest_Clf"), ("gradient_boosting_clf", "Gradient_Boosting_Clf"),
    ("svm_linear", "SVM_Linear"), ("svm_poly3", "SVM_Polynomial"), ("svm_rbf", "SVM_RBF"),
):
    _register_classifier(_key, _name)


@query("svm_mkl")
def _svm_mkl(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return supervised.mkl_predictions(p, supervised.weigh_kernels(p, CONFIG), CONFIG)


@query("mkl_report")
def _mkl_report(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return supervised.mkl_report(spark, supervised.weigh_kernels(p, CONFIG), CONFIG)


@query("feature_importance_topn")
def _feature_importance_topn(spark, sf_dir):
    p = prepared(spark, sf_dir)
    train = as_vectors(p.train, p.columns, keep=[p.target])
    return models.feature_importance_topn(models.fit_decision_tree_reg(train, p.target, CONFIG), p.columns, spark)


@query("tree_nodes")
def _tree_nodes(spark, sf_dir):
    p = prepared(spark, sf_dir)
    train = models.training_vectors(p.train, p.columns, p.label, p.classes)
    tree = models.fit_decision_tree_clf(train, CONFIG)
    return node_table(tree, p.columns)

"""The supervised step: split, scale, fit every model, score validation and test."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.config import MODEL_METRICS, SurveyConfig
from surveyloom.functions import cut_lineage, ident, in_parallel, local_table, numeric_columns
from surveyloom.operators import evaluate, kernels as K, models
from surveyloom.operators.cluster.assign import as_vectors, spread
from surveyloom.operators.features import class_counts, dominant_class, fit_standard
from surveyloom.operators.sampling import stratified_split
from surveyloom.operators.svm import fit_mapped_svm

SPLIT_NAMES = "case split when 'validation' then 'Validation' when 'test' then 'Test' else 'Train' end"


@dataclass
class Prepared:
    """The scaled table with its split; ``train`` and ``held_out`` are views of it."""

    table: DataFrame
    columns: tuple[str, ...]
    classes: tuple[str, ...]
    key: str
    target: str
    label: str

    @property
    def train(self) -> DataFrame:
        return self.table.where("split = 'Train'")

    @property
    def held_out(self) -> DataFrame:
        return self.table.where("split <> 'Train'")


def prepare(df: DataFrame, config: SurveyConfig = SurveyConfig(), *, label: str | None = None) -> Prepared:
    """Stratified 60/20/20 split; features scaled by the training rows alone.

    The result is checkpointed once: every model reads it.
    """
    label = label or config.label
    skip = {config.target, config.label, config.category, config.key}
    columns = numeric_columns(df, skip)
    chosen = cut_lineage(
        df.selectExpr(ident(config.key), ident(config.target), ident(label), *[ident(c) for c in columns])
    )
    parts = stratified_split(chosen, label, config.key, seed=config.seed).withColumn("split", F.expr(SPLIT_NAMES))
    scaling = fit_standard(parts.where("split = 'Train'"), columns)
    table = spread(cut_lineage(scaling.apply(parts)))
    present = {c for c, _ in class_counts(table.where("split = 'Train'"), label)}
    classes = tuple(c for c in config.ordered_labels if c in present)
    return Prepared(table, tuple(columns), classes, config.key, config.target, label)


def regression_predictions(p: Prepared, config: SurveyConfig = SurveyConfig(), names: Sequence[str] | None = None) -> DataFrame:
    """(model, split, key, y, prediction) of the held-out rows for each regressor."""
    train = as_vectors(p.train, p.columns, keep=[p.key, p.target]).persist()
    held_out = as_vectors(p.held_out, p.columns, keep=[p.key, p.target, "split"])

    def run(name: str) -> DataFrame:
        model = models.REGRESSORS[name](train, p.target, config)
        return models.predict(model, held_out, name, key=p.key, split="split", y=p.target)

    tables = _side_by_side(p, run, list(names or models.REGRESSORS))
    train.unpersist()
    return _union(tables)


def classification_predictions(p: Prepared, config: SurveyConfig = SurveyConfig(), names: Sequence[str] | None = None) -> DataFrame:
    """Held-out predictions of each classifier, the three SVM maps included; no row cap."""
    wanted = list(names or [*models.CLASSIFIERS, "SVM_Polynomial", "SVM_RBF"])
    labelled = models.index_labels(models.balanced_weights(p.train, p.label), p.label, p.classes)

    def run(name: str) -> DataFrame:
        if name in ("SVM_Polynomial", "SVM_RBF"):
            gamma = models.gamma_scale(p.train, p.columns)
            if name == "SVM_Polynomial":
                phi = models.cubic_terms(len(p.columns), gamma)
            else:
                phi = models.fit_nystroem(p.train, p.columns, gamma, key=p.key, size=config.rbf_features, seed=config.seed)
            return _held_out_predictions(fit_mapped_svm(labelled, p.columns, phi), lambda t, keep: t, p, name)
        mapped = lambda t, keep: as_vectors(t, p.columns, keep=keep)
        train = mapped(labelled, [p.key, "y_index", "weight"]).persist()
        fit = models.CLASSIFIERS.get(name, models.fit_svm)
        table = _held_out_predictions(fit(train, config), mapped, p, name)
        train.unpersist()
        return table

    return _union(_side_by_side(p, run, wanted))


def _held_out_predictions(model, mapped, p: Prepared, name: str) -> DataFrame:
    held_out = mapped(p.held_out, [p.key, "split", p.label])
    return models.predict(model, held_out, name, key=p.key, split="split", y=p.label, classes=p.classes)


def _side_by_side(p: Prepared, run, names: list[str]) -> list[DataFrame]:
    """Fit independent models at the same time: their many small jobs overlap."""
    return in_parallel(p.table.sparkSession, [lambda n=n: run(n) for n in names], width=4)


def _union(tables: list[DataFrame]) -> DataFrame:
    result = tables[0]
    for t in tables[1:]:
        result = result.unionByName(t)
    return result


@dataclass
class KernelStudy:
    kernels: list[K.WeakKernel]
    metrics: list[tuple]
    natural: list[float]
    anti: list[float]
    train_rows: int


def weigh_kernels(p: Prepared, config: SurveyConfig = SurveyConfig()) -> KernelStudy:
    """Draw weak kernels, score them one-vs-rest, weigh them on the dominant class.

    All training rows take part, in one pass.
    """
    kernels = K.weak_kernel_specs(p.columns, config.num_kernels, max_features=config.max_features, seed=config.seed)
    sums = K.class_sums(p.train, p.columns, p.label, {"weak": K.weak_map(kernels, p.columns)})["weak"]
    per = K.per_kernel(sums, kernels)
    top = dominant_class(p.train, p.label)
    chosen = [
        tuple(K.METRICS[m][0](*K.against(s, top)) for m in K.DEFAULT_METRICS) for s in per
    ]
    natural, anti = K.local_weights(chosen, [K.METRICS[m][1] for m in K.DEFAULT_METRICS], config.kernel_power)
    rows = int(sum(s.n for s in sums.values()))
    return KernelStudy(kernels, K.ovr_means(per), natural.tolist(), anti.tolist(), rows)


def mkl_predictions(p: Prepared, study: KernelStudy, config: SurveyConfig = SurveyConfig()) -> DataFrame:
    """Held-out predictions of the SVM on the natural and the anti combination."""
    labelled = models.index_labels(p.train, p.label, p.classes)
    variants = {"SVM_MKL_Natural": study.natural, "SVM_MKL_AntiNatural": study.anti}

    def run(name: str) -> DataFrame:
        weights = variants[name]
        mapped = lambda t, keep, w=weights: K.combined_kernel(t, study.kernels, w, keep=keep)
        train = mapped(labelled, ["y_index"]).persist()
        table = _held_out_predictions(models.fit_svm(train, config, balanced=False), mapped, p, name)
        train.unpersist()
        return table

    return _union(_side_by_side(p, run, list(variants)))


def mkl_report(spark, study: KernelStudy, config: SurveyConfig = SurveyConfig()) -> DataFrame:
    """(kernel, name, value): sizes, both weights and the per-kernel metrics."""
    rows: list[tuple] = [
        (None, "Num_Weak_Kernels", float(len(study.kernels))),
        (None, "Max_Features", float(config.max_features)),
        (None, "Train_Rows", float(study.train_rows)),
    ]
    for i, values in enumerate(study.metrics):
        rows += [(i, "Weight_Natural", study.natural[i]), (i, "Weight_AntiNatural", study.anti[i])]
        rows += [(i, name, None if v is None else round(v, 6)) for name, v in zip(MODEL_METRICS, values)]
    return local_table(spark, rows, "kernel int, name string, value double")


def run_supervised(df: DataFrame, config: SurveyConfig = SurveyConfig(), *, label: str | None = None) -> DataFrame:
    """The long metrics table of every regressor, classifier and kernel SVM."""
    p = prepare(df, config, label=label)
    study = weigh_kernels(p, config)
    regression = cut_lineage(regression_predictions(p, config))
    classes = cut_lineage(classification_predictions(p, config).unionByName(mkl_predictions(p, study, config)))
    kernel_rows = mkl_report(df.sparkSession, study, config).selectExpr(
        "'Classification' as task", "'SVM_MKL_Natural' as model", "cast(null as string) as split",
        "coalesce(concat('kernel_', lpad(cast(kernel as string), 2, '0')), 'MKL') as class", "name as metric", "value",
    )
    return (
        evaluate.regression_rows(regression)
        .unionByName(evaluate.classification_metrics(classes, p.classes))
        .unionByName(kernel_rows)
    )



import json

from surveyloom.sources.sinks import METRIC_COLUMNS, write_metrics_document


def test_document_by_a_path_only_spark_opens(spark, tmp_path):
    rows = [("Regression", "M", "Test", None, "R2", 0.5), ("Classification", "C", "Test", "Mild", "f1", 1.0), ("Clustering", "K", None, None, "k", None)]
    metrics = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in METRIC_COLUMNS[:-1]) + ", value double")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.sinks.link./out", f"file://{tmp_path}")
    path = "viewfs://sinks/out/metrics"
    for note in ("first", "é"):  # the second run takes the place of the first
        document = write_metrics_document(metrics, path, extra={"note": note})
    (read,) = spark.read.text(path, wholetext=True).collect()
    assert json.loads(read[0]) == document == {
        "Regression": {"M": {"Test": {"R2": 0.5}}}, "Classification": {"C": {"Test": {"Mild": {"f1": 1.0}}}},
        "Clustering": {"K": {"k": None}}, "note": "é",
    }

"""Every registered operator query with SQL against DuckDB, and the pipeline against its stages."""

import os

import pytest

import corpus_pipeline
import oracle
from surveyloom.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_pipeline(spark):
    """run() equals the stages' brute-force versions, one after the other."""
    from test_lines import brute
    from test_simhash import components, fingerprint

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert 0.7 * docs.count() < len(rows) <= docs.count()
    deduped = [(i, t) for i, t, *_ in brute(rows)]
    got = stages["line_dedup"](spark, clean, SF_DIR)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(deduped)
    assert all(r.n_chars == len(r.text) for r in got.collect())
    first = components([i for i, _ in deduped], [fingerprint(t) for _, t in deduped])
    unique = [(i, t) for (i, t), c in zip(deduped, first) if i == c]
    leaks = [r.text.lower() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    final = corpus_pipeline.run(spark, SF_DIR)
    ids = {r.doc_id for r in final.collect()}
    assert ids <= {i for i, _ in unique}
    assert {i for i, t in unique if any(x in t.lower() for x in leaks)} == {i for i, _ in unique} - ids


def odd_documents(spark, tmp_path):
    """documents with nulls, repeated rows, a long text, and columns named like the stages' own."""
    rows = [(1, None), (2, ""), (3, "a short text"), (3, "a short text"), (None, "no id"), (None, None), (4, "word " * 40_000), (5, "日本語 🙂")]
    rows += [(10 + i, f"some line that is long enough to count\nand number {i} of its own") for i in range(5)]
    names = "doc_id long, text string, n_lines long, lost string, n_dropped int, h string, fp long, words string, label string, score double"
    wide = [(i, t, 7, "x", 1, "h", 2, "w", None, 0.5) for i, t in rows]
    spark.createDataFrame(wide, names).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    return spark.read.parquet(str(tmp_path / "documents.parquet"))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[1:]])
def test_stage_on_odd_rows_and_empty_tables(spark, tmp_path, name):
    docs, stage = odd_documents(spark, tmp_path), dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, str(tmp_path))
    rows = got.collect()
    assert stage(spark, docs.limit(0), str(tmp_path)).isEmpty()
    if name == "sentencepiece":
        assert len(rows) == docs.count() and all(r.n_tokens == len(r.ids) for r in rows)
        return
    assert got.columns == docs.columns
    if name == "line_dedup":
        assert len(rows) == docs.count() and all((r.n_lines, r.lost, r.n_dropped) == (7, "x", 1) for r in rows)
        assert {r.doc_id for r in rows if r.text and "long enough" in r.text} == {14}
    elif name == "simhash_near_dedup":
        assert sorted(r.doc_id for r in rows if r.doc_id is not None)[:4] == [1, 3, 3, 4]
    else:
        assert len(rows) == docs.count()

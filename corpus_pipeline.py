"""The corpus pipeline: five stages over ``documents``, each an operator of ``surveyloom.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and hands it to the next stage. All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import scratch_path
from surveyloom.llm import decontaminate, lines, pieces, simhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted label is toxic go."""
    net = toxicity.train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, net)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters that three or more documents hold stay in the largest doc_id."""
    # The other columns travel under names of their own, whatever they are called.
    held = {c: f"held_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    kept = lines.dedup_lines(docs.withColumnsRenamed(held), carry=list(held.values()))
    back = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(held.get(c, c)).alias(c) for c in docs.columns]
    return kept.select(*back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with an end id, and what they decode to."""
    rows = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: A learned classifier, XXH64 and the merge agenda are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Line dedup: lines that many documents share stay in one of them.

Lines are normalised (blanks stripped at both ends, A-Z lower-cased), hashed to
128 bits and counted by distinct document. A line of at least ``min_chars`` code
points that at least ``min_docs`` documents hold is kept only in the largest
doc_id. The counts travel as (hash, doc_id) pairs, distinct before the second
shuffle, so a line that a third of the documents hold is summed from partial
counts. The pairs meet the frequent lines in a join that adaptive execution may
split; what a document loses is a set of its own lines, and the text is
reassembled by position.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, quote
from surveyloom.llm.common import BLANKS


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the normalised line; None if it is shorter than ``min_chars`` code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_pairs(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h, doc_id): the long lines of each document, each once per row."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {line_hash(line, min_chars) for line in (text or b"").split(b"\n")} - {None}
                hashes += own
                ids += [doc] * len(own)
            yield pa.record_batch([pa.array(hashes, pa.binary()), pa.array(ids, pa.int64())], ["h", "doc_id"])

    return docs.where("doc_id is not null").mapInArrow(explode, "h binary, doc_id long")


def dedup_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, carried columns…), one row per input row.

    A null or empty text is one empty line. Rows of one doc_id count as one
    document; a row without doc_id is no holder of any line and keeps its own.
    Carried columns must not be named like the result's.
    """
    clash = {"doc_id", "text", "n_lines", "n_dropped"} & set(carry)
    if clash:
        raise ValueError(f"carried columns clash with the result: {sorted(clash)}")
    narrow = docs.select(quote(doc_id).cast("long").alias("doc_id"), quote(text).cast("binary").alias("text"))
    pairs = line_pairs(narrow, min_chars)
    frequent = (
        pairs.groupBy("h")
        .agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h", "keeper")
    )
    # Written out, so that the join shuffles both sides itself and can split the pairs of a very common line.
    frequent = cut_lineage(frequent)
    lost = (
        pairs.join(frequent, "h").where("doc_id < keeper").groupBy("doc_id").agg(F.collect_set("h").alias("lost"))
    )
    held = [f"carried_{i}" for i in range(len(carry))]  # names of their own: none can clash
    wide = docs.select(
        quote(doc_id).cast("long").alias("doc_id"), quote(text).cast("binary").alias("text"),
        *[quote(c).alias(h) for c, h in zip(carry, held)],
    )
    joined = wide.join(lost, "doc_id", "left").select("doc_id", "text", "lost", *held)

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for body, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = (body or b"").split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [x for x in lines if line_hash(x, min_chars) not in gone]
                kept.append(b"\n".join(lines))
                n_dropped.append(n_lines[-1] - len(lines))
            yield pa.record_batch(
                [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64()), *batch.columns[3:]],
                ["doc_id", "text", "n_lines", "n_dropped", *held],
            )

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in wide.schema[2:]]
    out = joined.mapInArrow(reassemble, ", ".join(["doc_id long", "text string", "n_lines long", "n_dropped long", *kinds]))
    return out.toDF("doc_id", "text", "n_lines", "n_dropped", *carry)

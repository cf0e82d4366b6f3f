"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within ``radius`` bits have
a segment within radius // segments bits, so each distinct fingerprint looks up
the small Hamming ball around each of its segments in the table of all segments,
and complete distances verify what is found. Copies share a fingerprint and
enter once; links between distinct fingerprints are joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, quote
from surveyloom.llm.common import texts_of
from surveyloom.operators.cluster.density import connected_components

#: Shingles whose bits are unpacked at once; bounds the memory of a long text.
CHUNK = 1 << 18


def simhash(text: bytes, words: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of the word shingles, as a signed 64-bit number.

    Fewer words than a shingle has give the whole sequence; none gives zero.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row; a null text counts as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(x or b"", words) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    narrow = texts_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return narrow.mapInArrow(hashed, "doc_id long, fp long")


def signed(x: int) -> int:
    """The signed 64-bit number of the same bits."""
    return x - (1 << 64) if x >> 63 else x


def segment_masks(segments: int, radius: int) -> list[tuple[int, int, list[int]]]:
    """(first bit, mask, flips) per segment; flips enumerate its ball of radius // segments bits; all signed."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    out = []
    for low, high in zip(edges, edges[1:]):
        flips = [
            signed(sum(1 << b for b in bits)) for k in range(radius // segments + 1) for bits in combinations(range(high - low), k)
        ]
        out.append((low, signed((1 << (high - low)) - 1), flips))
    return out


def fingerprint_links(distinct: DataFrame, *, radius: int = 2, segments: int = 2) -> DataFrame:
    """(pid, other): distinct fingerprints ``fp`` at most ``radius`` bits apart, pid < other.

    A pair that several probes find is returned as often.
    """
    masks = segment_masks(segments, radius)
    cut = "cast(shiftrightunsigned(fp, {low}) & cast('{mask}' as bigint) as bigint)"
    table = ", ".join(f"struct({i} as seg, {cut.format(low=low, mask=mask)} as val)" for i, (low, mask, _) in enumerate(masks))
    table = distinct.selectExpr("fp as other", f"inline(array({table}))")
    probes = [
        distinct.selectExpr("fp as pid", f"{i} as seg", f"{cut.format(low=low, mask=mask)} as own")
        .selectExpr("pid", "seg", "own", "explode(array(" + ", ".join(f"cast('{x}' as bigint)" for x in flips) + ")) as flip")
        .selectExpr("pid", "seg", "own ^ flip as val")
        for i, (low, mask, flips) in enumerate(masks)
    ]
    probe = probes[0]
    for more in probes[1:]:
        probe = probe.unionAll(more)
    near = F.expr(f"pid < other and bit_count(pid ^ other) <= {radius}")
    return probe.join(table, ["seg", "val"]).where(near).select("pid", "other")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2, segments: int = 2
) -> DataFrame:
    """(doc_id, fp, component_id, n_links) of every row.

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits, the document itself included; n_links counts the
    other distinct fingerprints it links to. Rows without words have fingerprint
    zero and link like any other; a row without doc_id takes part but names no
    component (null if it stands alone).
    """
    rows = cut_lineage(fingerprints(docs, doc_id=doc_id, text=text, words=words))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = cut_lineage(fingerprint_links(distinct.select("fp"), radius=radius, segments=segments).distinct())
    labels = connected_components(links)
    degree = (
        links.select("pid").unionAll(links.select(F.col("other").alias("pid"))).groupBy("pid").agg(F.count("*").alias("n_links"))
    )
    linked = labels.join(degree, "pid").join(distinct.withColumnRenamed("fp", "pid"), "pid")
    roots = linked.groupBy("label").agg(F.min("first").alias("component_id"))
    found = linked.join(roots, "label").select(F.col("pid").alias("fp"), "component_id", "n_links")
    # Written out, so that the join shuffles both sides itself and can split the rows of a very common fingerprint.
    classes = cut_lineage(
        distinct.join(found, "fp", "left").select(
            "fp", F.coalesce("component_id", "first").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
        )
    )
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id", "n_links")


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the smallest doc_id of each component, with the columns of ``docs``.

    Rows without a doc_id cannot be named and stay; of several rows with the
    kept doc_id all stay.
    """
    found = near_duplicates(docs, **settings)
    gone = found.where("doc_id is not null and doc_id <> component_id").select("doc_id").distinct()
    name = settings.get("doc_id", "doc_id")
    return docs.join(gone.withColumnRenamed("doc_id", name), name, "left_anti").select(*map(quote, docs.columns))

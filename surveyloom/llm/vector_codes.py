"""Vector codes: each part of a vector is replaced by the index of its nearest codebook entry.

All arithmetic is on integers, so results do not depend on order. The nearest
entry is found by equal-average search: entries are sorted by the sum of their
components, and the search goes outward from the part's own sum. As the squared
gap of the sums is at most the dimension times the squared distance, a side ends
where the squared gap over the dimension strictly exceeds the best distance; equal
distances are still met, and the lower index wins.

Each round is one scan: tasks assign their parts and send one row of sums per
codebook entry. Only codebooks reach the driver and the tasks; their size depends
on the number of entries and components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, quote

#: Sums travel as limbs of this many bits, so they never overflow 64 bits.
LIMB = 28
MOST = (1 << 63) - 1


@dataclass
class Codebooks:
    """Entries of each part position, as rows of integers; ``size`` components in all."""

    entries: list[np.ndarray]
    size: int
    scale: int

    def sha256(self) -> str:
        text = ",".join(str(int(x)) for book in self.entries for entry in book for x in entry)
        return sha256(text.encode()).hexdigest()


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale·x) as 64-bit integers, or as Python's where distances would not fit."""
    floors = np.floor(values * float(scale)) if values.size and np.abs(values).max() < 1e300 else values
    if floors is not values and (2.0 * np.abs(floors).max(initial=0.0) * max(values.shape[1], 1)) ** 2 < 2.0**61:
        return floors.astype(np.int64)
    rows = [[int(x) * scale if x == int(x) else int((x * scale) // 1) for x in row] for row in values.tolist()]
    return np.array(rows, object).reshape(values.shape)


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of every point's nearest entry; ties to the lower index."""
    if points.dtype != book.dtype:
        points, book = points.astype(object), book.astype(object)
    dimension = max(book.shape[1], 1)
    sums = book.sum(axis=1) if book.shape[1] else np.zeros(len(book), np.int64)
    order = np.argsort(sums, kind="stable")
    sums, sorted_book = sums[order], book[order]
    own = points.sum(axis=1) if points.shape[1] else np.zeros(len(points), np.int64)
    best = np.full(len(points), -1, points.dtype)  # -1: none yet
    index = np.zeros(len(points), np.int64)
    above = np.searchsorted(sums, own)
    for step, start in ((1, above), (-1, above - 1)):
        rows, at = np.arange(len(points)), start.copy()
        while len(rows):
            inside = (at >= 0) & (at < len(sums))
            rows, at = rows[inside], at[inside]
            gap = sums[at] - own[rows]
            near = (best[rows] < 0) | (gap * gap <= best[rows] * dimension)
            rows, at = rows[near], at[near]
            if not len(rows):
                break
            away = sorted_book[at] - points[rows]
            distance = (away * away).sum(axis=1) if away.shape[1] else np.zeros(len(rows), best.dtype)
            found = order[at]
            better = (best[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (found < index[rows]))
            best[rows[better]], index[rows[better]] = distance[better], found[better]
            at = at + step
    return index, best


def part_edges(size: int, parts: int) -> list[int]:
    return [i * size // parts for i in range(parts + 1)]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), size)


def usable_vectors(table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label") -> DataFrame:
    """(vec_id, label, vector) of the rows whose vector is neither null nor empty and holds only finite numbers."""
    rows = table.select(
        quote(vec_id).cast("long").alias("vec_id"),
        (quote(label) if label else F.lit(None).cast("int")).alias("label"), quote(vector).alias("vector"),
    )
    return rows.where(
        "size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )


def learn_codebooks(rows: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks]:
    """The rows that take part, and the codebooks after ``rounds`` rounds of assigning and averaging.

    The first entries are the parts of the smallest vec_ids (ties by the vector, null
    ids last). Vectors of another length than the very first one take no part, as they
    have no such parts. A length that ``parts`` does not divide is cut at the floors.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).select(F.size("vector")).first()
    size = first[0] if first else 0
    rows = rows.where(f"size(vector) = {size}")
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    edges = part_edges(size, parts)
    start = integers(np.array([r[0] for r in seeds], np.float64).reshape(len(seeds), size), scale)
    books = Codebooks([start[:, a:b] for a, b in zip(edges, edges[1:])], size, scale)
    if not seeds:
        return rows, books
    widest = rows.agg(F.max(F.expr("greatest(abs(array_max(vector)), abs(array_min(vector)))")).cast("double")).first()[0]
    limbs = max(1, -(-(int(widest * scale).bit_length() + 1) // LIMB)) if widest * scale < float("inf") else 38
    width = max(b - a for a, b in zip(edges, edges[1:])) * limbs
    names = [f"s{i}" for i in range(width)]
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(
            _summing(books.entries, edges, size, scale, limbs, names),
            "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names),
        )
        totals = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
        books = Codebooks([book.copy() for book in books.entries], size, scale)
        for p, e, n, *values in totals.collect():
            d = edges[p + 1] - edges[p]
            whole = [sum(values[i * limbs + k] << (LIMB * k) for k in range(limbs)) for i in range(d)]
            books.entries[p][e] = [x // n for x in whole]
    return rows, books


def _summing(books, edges, size, scale, limbs, names):
    """Task: sums and counts of the parts nearest to each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(book), book.shape[1], limbs), np.int64) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            whole = integers(matrix(batch.column(0), size), scale)
            for p, book in enumerate(books):
                points = whole[:, edges[p] : edges[p + 1]]
                index, _ = nearest_entries(points, book)
                counts[p] += np.bincount(index, minlength=len(book))
                rest = points
                for k in range(limbs):
                    limb = rest if k == limbs - 1 else rest & ((1 << LIMB) - 1)
                    np.add.at(sums[p][:, :, k], index, limb.astype(np.int64))
                    rest = rest >> LIMB
        for p, book in enumerate(books):
            used = np.flatnonzero(counts[p])
            if len(used):
                flat = np.zeros((len(used), len(names)), np.int64)
                flat[:, : book.shape[1] * limbs] = sums[p][used].reshape(len(used), -1)
                columns = [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used])]
                yield pa.record_batch([*columns, *[pa.array(flat[:, i]) for i in range(len(names))]], ["part", "entry", "n", *names])

    return run


def encode_vectors(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hex digits per part, and the squared distances summed over the parts.

    An error beyond the largest long is given as that number.
    """
    edges, size, scale, entries = part_edges(books.size, len(books.entries)), books.size, books.scale, books.entries
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(matrix(batch.column(2), size), scale)
            found = [nearest_entries(whole[:, edges[p] : edges[p + 1]], book) for p, book in enumerate(entries)]
            codes = ["".join(f"{i:02x}" for i in row) for row in zip(*[index.tolist() for index, _ in found])]
            errors = [min(sum(row), MOST) for row in zip(*[best.tolist() for _, best in found])]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return rows.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def vector_codes(
    table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4,
    entries: int = 256, rounds: int = 4, scale: int = 1024,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row.

    Null, empty and non-finite vectors take no part; repeated rows count each;
    fewer rows than entries make smaller codebooks; an empty table has no rows.
    ``label_error`` is the error summed over equal labels, nulls together.
    """
    if entries > 256:
        raise ValueError("two hex digits hold 256 entries")
    rows, books = learn_codebooks(usable_vectors(table, vec_id=vec_id, vector=vector, label=label), parts=parts, entries=entries, rounds=rounds, scale=scale)
    coded = cut_lineage(encode_vectors(rows, books))
    totals = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST)).cast("long").alias("label_error"))
    totals = totals.withColumnRenamed("label", "other")
    joined = coded.join(totals, coded["label"].eqNullSafe(totals["other"]))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

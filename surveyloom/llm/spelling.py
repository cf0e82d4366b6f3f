"""Spelling variants: words one inserted, deleted or replaced character apart, grouped by their usual form.

Forward and reversed words are sorted, and every distinct prefix or suffix, a node
of the forward or reversed trie, gets a number. Around each position a word then
has two integer pairs: the nodes before and after the position with its character
skipped, and the nodes before and after the gap with nothing skipped. Two words are
neighbours by replacement if they share a skipped pair, and by insertion if the
gap pair of one is a skipped pair of the other. A pair of nodes fixes everything
but one character, so no group holds more words than the alphabet has letters,
plus one.

Deleting any character of a run of equal ones gives the same word, so only a
run's first counts for insertions, and every pair of neighbours meets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2, log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, quote

# The letters of a word and the case folding of the contract.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Node and word numbers: the part of the sorted table, then the place within it.
PART_SHIFT = 40


def count_words(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2, slip_every: int = 31
) -> DataFrame:
    """(word, n) of the maximal runs of letters, A-Z lower-cased, with one letter lost in every ``slip_every``-th run by hash.

    A run's hash is the crc32 of "<doc_id>:<run>"; a null id counts as empty text.
    Null texts hold no words, repeated rows count each.
    """
    # A run that loses a letter must have one more than a word; shorter runs can't become words.
    runs = docs.select(
        F.coalesce(quote(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(quote(text), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"),
    )
    low = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = low.select("run", F.expr("crc32(cast(concat(id, ':', run) as binary))").alias("h"))
    slipped = hashed.selectExpr(
        f"if(h % {slip_every} = 0, concat(left(run, cast(h % length(run) as int)),"
        " substring(run, cast(h % length(run) as int) + 2)), run) as word"
    )
    counted = slipped.where(f"length(word) >= {min_length}").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(f"n >= {min_count}")


def common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def trie_nodes(rows: DataFrame, column: str, *, place: str | None = None) -> DataFrame:
    """Adds ``nodes`` array<long>: the numbers of the column's prefixes, the empty one first; equal prefixes, equal numbers.

    The rows, distinct in the column, are sorted over all partitions. A prefix is new
    where the word before lacks it, and is numbered there. Prefixes that go on from one
    part into the next are numbered by the first such border and their length. For that
    the driver sees the first and last word of each part: as many words as partitions.
    ``place`` also adds the row's number in the sorted order.
    """
    names = [c for c in rows.columns]
    ordered = cut_lineage(
        rows.repartitionByRange(F.col(column)).sortWithinPartitions(column).withColumn("part", F.spark_partition_id())
    )
    key, part = names.index(column), len(names)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = number = None
        for batch in batches:
            if batch.num_rows:
                first = batch.column(0)[0].as_py() if first is None else first
                last, number = batch.column(0)[batch.num_rows - 1].as_py(), batch.column(1)[0].as_py()
        if first is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([number], pa.int32()), "first": [first], "last": [last]})

    parts = sorted(ordered.select(column, "part").mapInArrow(ends, "part int, first string, last string").collect())
    borders: dict[int, tuple[str, list[int]]] = {}  # part → the prefix shared with the part before, its nodes' numbers
    shared, numbers = "", []
    for (_, _, before), (p, first, _) in zip(parts, parts[1:]):
        now = before[: common(before, first)]
        kept = common(shared, now) + 1 if numbers else 0
        numbers = numbers[:kept] + [-(p << PART_SHIFT) - d - 1 for d in range(kept, len(now) + 1)]
        shared = now
        borders[p] = (now, numbers)
    after = {p: borders[q] for (p, _, _), (q, _, _) in zip(parts, parts[1:])}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, path, fresh, row = "", [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            p = batch.column(part)[0].as_py()
            upper, upper_path = after.get(p, ("", []))
            nodes, places = [], []
            for word in batch.column(key).to_pylist():
                if path:
                    kept = common(before, word) + 1
                    path = path[:kept]
                else:
                    path = list(borders[p][1]) if p in borders else []
                ahead = common(upper, word) + 1 if upper_path else 0
                path += upper_path[len(path) : ahead]
                more = len(word) + 1 - len(path)
                start = (p << PART_SHIFT) + fresh
                path += range(start, start + more)
                fresh += more
                before = word
                nodes.append(path)
                places.append((p << PART_SHIFT) + row)
                row += 1
            columns = [batch.column(i) for i in range(len(names))] + [pa.array(nodes, pa.list_(pa.int64()))]
            yield pa.record_batch([*columns, pa.array(places, pa.int64())][: len(out)], out)

    out = [*names, "nodes", *([place] if place else [])]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["nodes array<long>"]
    return ordered.mapInArrow(number, ", ".join([*kinds, *([f"`{place}` long"] if place else [])]))


def near_words(words: DataFrame) -> DataFrame:
    """(id, word, n, n_near, best_id, best_n) of (word, n): the count of near words and the one of largest n.

    Ids rise in code-point order, so they break ties. Nulls for the best of a word without near words.
    """
    forward = trie_nodes(words.select("word", "n"), "word", place="id").withColumnRenamed("nodes", "pre")
    both = trie_nodes(forward.withColumn("backward", F.reverse("word")), "backward").withColumnRenamed("nodes", "suf")
    both = cut_lineage(both.select("id", "word", "n", "pre", "suf"))
    # 0: skipped, the first of its run; 1: skipped, a later one; 2: gap.
    entries = both.selectExpr("id", "n", "pre", "suf", "split(word, '') as letters", "length(word) as size").selectExpr(
        "id", "n",
        "inline(concat("
        "transform(slice(sequence(0, size), 1, size), i -> struct(pre[i] as p, suf[size - 1 - i] as s,"
        " if(i = 0 or letters[i] <> letters[i - 1], 0, 1) as kind)),"
        "transform(sequence(0, size), i -> struct(pre[i] as p, suf[size - i] as s, 2 as kind))))",
    )
    # All of a group are near each other but for the later letter of a run and the gap, which meet at the run's first.
    group = "partition by p, s order by n desc, id rows between unbounded preceding and unbounded following"
    ranked = entries.selectExpr(
        "id", "kind", f"count(1) over ({group}) as size",
        f"max(kind = 1) over ({group}) and max(kind = 2) over ({group}) as both",
        *[f"nth_value(struct(n, -id as id, kind), {k}) over ({group}) as top{k}" for k in (1, 2, 3)],
    )
    found = ranked.where("size > 1").selectExpr(
        "id", "size - if(both and kind > 0, 2, 1) as near",
        "element_at(filter(array(top1, top2, top3), t -> t is not null and -t.id <> id and not (kind > 0 and t.kind > 0)), 1) as best",
    )
    each = found.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    return both.select("id", "word", "n").join(each, "id", "left").selectExpr(
        "id", "word", "n", "coalesce(n_near, 0L) as n_near", "-best.id as best_id", "best.n as best_n"
    )


def group_spellings(words: DataFrame, *, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a table (word, n) of distinct words.

    A word's form is its near word of largest n (ties: the smallest) if that is at
    least ``ratio`` times the word's own; its root is the last of the forms that follow
    one another. Rows with a null word or n take no part. Counts rise from form to
    form, so as many rounds suffice as the largest count's logarithm allows.
    """
    usable = words.where("word is not null and n is not null")
    near = near_words(usable).selectExpr(
        "id", "word", "n", "n_near", f"if(best_n >= {ratio} * n, best_id, null) as form_id", f"if(best_n >= {ratio} * n, best_n, null) as form_n"
    )
    near = cut_lineage(near)
    roots = near.where("form_id is not null").selectExpr("id", "form_id as root_id")
    high, low = near.agg(F.max("n"), F.min("n")).first()
    hops = log10(max(high / max(low, 1), 1)) / log10(ratio) + 1 if high else 1
    for _ in range(int(log2(hops)) + 1):
        ahead = roots.selectExpr("id as root_id", "root_id as next_id")
        roots = cut_lineage(roots.join(ahead, "root_id", "left").selectExpr("id", "coalesce(next_id, root_id) as root_id"))
    names = near.select("id", "word")
    return (
        near.join(roots, "id", "left")
        .join(names.selectExpr("id as form_id", "word as form"), "form_id", "left")
        .join(names.selectExpr("id as root_id", "word as root"), "root_id", "left")
        .selectExpr("word", "n", "n_near", "form", "form_n", "coalesce(root, word) as root")
    )

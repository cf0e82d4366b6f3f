"""LM scoring by deleted interpolation of bigram, unigram and uniform estimates.

P(w|v) = l2(b)·c(vw)/c(v) + l1(b)·c(w)/N + l0(b)/(V+1), where b is the bucket of
the context's frequency. The weights come from expectation-maximisation on
held-out counts: one fold of the training documents is deleted from the counts,
and its events are gathered, over all documents, as a histogram of (bucket,
ratios of the estimates) of fixed resolution.

Documents become blocks: rows of word hashes and local word numbers, written
once. A block names each of its words and word pairs once, with its own count,
in packets by hash range; the sums of a range are made in one group and the
totals go back to each block in the order asked. No word, pair or document is a
key of its own, so frequent ones make no group large.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import scratch_path
from surveyloom.llm.common import fold, texts_of

#: Tokens of a block; distinct entries that a hash range should hold.
BLOCK_TOKENS, RANGE_ENTRIES = 600_000, 1_500_000
BLOCKS_PER_FILE = 32
#: Contexts are bucketed by the octave of their frequency; those of 2^20 and more share the last.
BUCKETS = 21
#: Steps per octave of the ratios that the weights are learned from.
STEPS = 4
#: Names of the end and the start; white space, so no word is either.
END, START = b"\n", b"\t"
BLOCK_SCHEMA = "p long, dev boolean, doc_ids array<long>, roles array<int>, sizes array<long>, vocabulary binary, ids binary"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_keys(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes) & ~np.uint64(1)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29)))) | np.uint64(1)


START_KEY = int(word_keys(np.array([xxhash.xxh64_intdigest(START)], np.uint64))[0])


def make_blocks(docs: DataFrame, *, folds: int, test_fold: int, dev_fold: int) -> DataFrame:
    """Blocks of whole documents; role 0 trains, 1 is the deleted fold, 2 is only scored (also rows without an id)."""
    arrow = pa.schema(
        [("p", pa.int64()), ("dev", pa.bool_()), ("doc_ids", pa.list_(pa.int64())), ("roles", pa.list_(pa.int32())),
         ("sizes", pa.list_(pa.int64())), ("vocabulary", pa.binary()), ("ids", pa.binary())]
    )
    of = fold(F.col("doc_id"), folds)
    role = F.when(of.isNull() | (of == test_fold), 2).when(of == dev_fold, 1).otherwise(0)
    rows = docs.withColumn("role", role.cast("int"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def start() -> dict:
            number = defaultdict()
            number.default_factory = number.__len__
            number[END]  # the end is word 0
            return {"number": number, "ids": [], "doc_ids": [], "roles": [], "sizes": [], "n": 0}

        def close(b: dict, dev: bool) -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in b["number"]), np.uint64, len(b["number"]))
            row = {
                "p": (part << 24) + made, "dev": dev, "doc_ids": b["doc_ids"], "roles": b["roles"], "sizes": b["sizes"],
                "vocabulary": hashes.tobytes(), "ids": zlib.compress(np.concatenate(b["ids"]).tobytes(), 1),
            }
            return pa.RecordBatch.from_pylist([row], arrow)

        open_blocks = {False: start(), True: start()}
        for batch in batches:
            for doc, text, role in zip(*(batch.column(i).to_pylist() for i in range(3))):
                b = open_blocks[role == 1]
                words = (text or b"").lower().split()
                words.append(END)
                b["ids"].append(np.fromiter(map(b["number"].__getitem__, words), np.uint32, len(words)))
                b["doc_ids"].append(doc)
                b["roles"].append(role)
                b["sizes"].append(len(words))
                b["n"] += len(words)
                if b["n"] >= BLOCK_TOKENS:
                    yield close(b, role == 1)
                    made += 1
                    open_blocks[role == 1] = start()
        for dev, b in open_blocks.items():
            if b["n"]:
                yield close(b, dev)
                made += 1

    return rows.select("doc_id", "text", "role").mapInArrow(cut, BLOCK_SCHEMA)


class Block:
    """A block's tokens, and its words and pairs in the order their packets have."""

    def __init__(self, row: dict, ranges: int):
        hashes = np.frombuffer(row["vocabulary"], np.uint64)
        self.ids = np.frombuffer(zlib.decompress(row["ids"]), np.uint32).astype(np.int64)
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        n = len(hashes)  # the start gets number n
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.before[self.starts] = n
        roles = np.asarray(row["roles"])
        counted = np.repeat(roles < 2, self.sizes)
        pairs, self.pair = np.unique(self.before * np.int64(n + 1) + self.ids, return_inverse=True)
        hashes = np.append(hashes, np.uint64(xxhash.xxh64_intdigest(START)))
        with np.errstate(over="ignore"):
            keys = np.concatenate([word_keys(hashes), pair_keys(hashes[pairs // (n + 1)], hashes[pairs % (n + 1)])])
        counts = np.concatenate(
            [np.bincount(self.ids[counted], minlength=n), [int((roles < 2).sum())], np.bincount(self.pair[counted], minlength=len(pairs))]
        )
        self.n_words = n + 1
        self.range = ((keys >> np.uint64(20)) % np.uint64(ranges)).astype(np.int64)
        self.order = np.argsort(self.range, kind="stable")
        self.keys, self.counts = keys[self.order], counts[self.order].astype(np.uint32)
        self.edges = np.searchsorted(self.range[self.order], np.arange(ranges + 1))

    def totals(self, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Totals of the words and of the pairs from the replies of each range."""
        flat = np.concatenate([np.frombuffer(replies[r], np.uint32) for r in sorted(replies)])
        out = np.empty(len(self.order), np.int64)
        out[self.order] = flat
        return out[: self.n_words], out[self.n_words :]


def packets(blocks: DataFrame, ranges: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row, ranges)
                held = [r for r in range(ranges) if b.edges[r] < b.edges[r + 1]]
                cut = [slice(b.edges[r], b.edges[r + 1]) for r in held]
                yield pa.record_batch(
                    [pa.array(held, pa.int32()), pa.array([row["p"]] * len(held), pa.int64()), pa.array([row["dev"]] * len(held)),
                     pa.array([b.keys[c].tobytes() for c in cut], pa.binary()), pa.array([b.counts[c].tobytes() for c in cut], pa.binary())],
                    ["r", "p", "dev", "keys", "counts"],
                )

    return blocks.mapInArrow(emit, "r int, p long, dev boolean, keys binary, counts binary")


REPLY_SCHEMA = "p long, r int, totals binary, main binary, tokens long, types long, main_tokens long, main_types long"


def sum_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Totals of a hash range, for each block in its own order, and the range's share of N and V (as block −1).

    Blocks of the deleted fold also get the totals without that fold.
    """
    keys = [np.frombuffer(k, np.uint64) for k in pdf["keys"]]
    counts = np.concatenate([np.frombuffer(c, np.uint32) for c in pdf["counts"]]).astype(np.float64)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    dev = np.repeat(pdf["dev"].to_numpy(bool), [len(k) for k in keys])
    whole = np.bincount(at, counts, len(distinct)).astype(np.uint32)
    main = whole - np.bincount(at[dev], counts[dev], len(distinct)).astype(np.uint32)
    words = (distinct & np.uint64(1) == 0) & (distinct != np.uint64(START_KEY))
    edges = np.cumsum([0, *map(len, keys)])
    rows = [
        (p, r, whole[at[a:b]].tobytes(), main[at[a:b]].tobytes() if d else b"", 0, 0, 0, 0)
        for p, r, d, a, b in zip(pdf["p"], pdf["r"], pdf["dev"], edges, edges[1:])
    ]
    w, m = whole[words].astype(np.int64), main[words].astype(np.int64)
    rows.append((-1, int(pdf["r"].iloc[0]), b"", b"", int(w.sum()), int((w > 0).sum()), int(m.sum()), int((m > 0).sum())))
    return pd.DataFrame(rows, columns=["p", "r", "totals", "main", "tokens", "types", "main_tokens", "main_types"])


def estimates(b: Block, replies: dict[int, bytes], tokens: int, types: int):
    """Bucket, bigram, unigram and uniform estimates, and the count of the word, for each token."""
    words, pairs = b.totals(replies)
    context, count = words[b.before], words[b.ids]
    bucket = np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)
    two = pairs[b.pair] / np.maximum(context, 1)
    return bucket, two, count / max(tokens, 1), 1 / (types + 1), count


def learn_weights(cells: list[tuple[int, int, int, int]], rounds: int = 60) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram, uniform by expectation-maximisation; a bucket without events has thirds."""
    out = np.full((BUCKETS, 3), 1 / 3)
    table = np.array(cells, np.float64).reshape(-1, 4)
    for bucket in np.unique(table[:, 0]).astype(int):
        own = table[table[:, 0] == bucket]
        ratio = np.stack([*(np.where(own[:, k] == -(10**6), 0, np.exp2(own[:, k] / STEPS)) for k in (1, 2)), np.ones(len(own))], axis=1)
        weight = own[:, 3] / own[:, 3].sum()
        for _ in range(rounds):
            part = ratio * out[bucket]
            out[bucket] = weight @ (part / part.sum(axis=1, keepdims=True))
    out[:, 2] = np.maximum(out[:, 2], 1e-6)
    return out / out.sum(axis=1, keepdims=True)


def score_documents(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = 7, test_fold: int = 2, dev_fold: int = 3
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A null text is empty and has the end token alone. Rows of the test fold are
    scored only; so are rows without a doc_id (held_out null). With no document
    in the deleted fold the three weights are equal; with no training document
    every count is 0.
    """
    spark: SparkSession = docs.sparkSession
    narrow = texts_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    path = scratch_path(spark, "lm-blocks")
    make_blocks(narrow, folds=folds, test_fold=test_fold, dev_fold=dev_fold).write.option(
        "maxRecordsPerFile", BLOCKS_PER_FILE
    ).parquet(path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    total = blocks.selectExpr("aggregate(sizes, 0L, (a, b) -> a + b) as n").agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_ENTRIES))
    path = scratch_path(spark, "lm-totals")
    sent = packets(blocks, ranges).repartition(ranges, "r")
    sent.groupBy("r").applyInPandas(sum_range, REPLY_SCHEMA).write.parquet(path)
    replies = spark.read.schema(REPLY_SCHEMA).parquet(path)
    stats = replies.where("p = -1").agg(*(F.sum(c) for c in ("tokens", "types", "main_tokens", "main_types"))).first()
    tokens, types, main_tokens, main_types = (int(x or 0) for x in stats)
    answers = replies.where("p >= 0").select("p", "r", "totals")
    without = replies.where("p >= 0 and length(main) > 0").select("p", "r", "main")

    def histogram(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"bucket": [], "two": [], "one": [], "n": []})
        bucket, two, one, flat, _ = estimates(Block(left.iloc[0].to_dict(), ranges), dict(zip(right["r"], right["main"])), main_tokens, main_types)
        with np.errstate(divide="ignore"):
            q = [np.where(x > 0, np.round(STEPS * np.log2(np.maximum(x, 1e-300) / flat)), -(10**6)) for x in (two, one)]
        cells = pd.DataFrame({"bucket": bucket, "two": q[0].astype(int), "one": q[1].astype(int), "n": 1})
        return cells.groupby(["bucket", "two", "one"], as_index=False).sum()

    by_dev = blocks.where("dev").groupBy("p").cogroup(without.groupBy("p"))
    cells = by_dev.applyInPandas(histogram, "bucket int, two int, one int, n long").groupBy("bucket", "two", "one").agg(F.sum("n").alias("n"))
    weights = learn_weights([tuple(r) for r in cells.collect()])  # at most buckets × steps² cells

    def score(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0].to_dict()
        b = Block(row, ranges)
        bucket, two, one, flat, count = estimates(b, dict(zip(right["r"], right["totals"])), tokens, types)
        w = weights[bucket]
        model = np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] * flat)
        base = np.log10((count + 1) / (tokens + types + 1))
        summed = [np.add.reduceat(x, b.starts) for x in (base, model, (count > 0).astype(np.int64))]
        return pd.DataFrame(
            {"doc_id": pd.array(list(row["doc_ids"]), "Int64"), "n_tokens": b.sizes, "n_known": summed[2], "base_score": summed[0], "score": summed[1]}
        )

    rows = blocks.groupBy("p").cogroup(answers.groupBy("p"))
    kinds = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return rows.applyInPandas(score, kinds).select(
        "doc_id", (fold(F.col("doc_id"), folds) == test_fold).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )

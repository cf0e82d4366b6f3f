"""Token ids as range-coded files: static asymmetric numeral systems in interleaved lanes.

A shard is one row of a Parquet table, so Spark writes, commits and rereads it
on any file system. It holds its documents' ids in one stream, cut into blocks
of ``block`` ids. All blocks of a shard share one frequency table, counted over
the whole shard. A block is coded by ``lanes`` interleaved 64-bit states that
emit 32-bit words; every ``spacing`` steps the states and the word position are
kept as a checkpoint, so parts of a block decode side by side too. Blocks carry a
crc32 of their words and of their ids.

Blocks and checkpoints advance together as vectors, so the coder's loop runs
once per step, not once per id.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from surveyloom.functions import quote
from surveyloom.llm.bpe import ODD, byte_characters
from surveyloom.llm.common import code_points, joined_ids, parts_of

#: The coder's format: states stay in [2^31, 2^63), frequencies add up to 2^18.
LOW, SCALE_BITS = np.uint64(1 << 31), 18
LANES, BLOCK, SPACING = 32, 1 << 16, 512
#: Ids after which a shard is closed; about 3 MB coded.
SHARD_IDS = 2_000_000
SHARDS_PER_FILE = 8
#: Distinct chunks a task remembers before it starts afresh, and code points of texts cut up at a time.
REMEMBERED, SLICE = 500_000, 2_000_000
#: New chunks that go to the library in one text.
TOGETHER = 1000


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to the format's total; every id that occurs keeps at least 1."""
    total = 1 << SCALE_BITS
    used = np.flatnonzero(counts)
    if len(used) > total:
        raise ValueError("more distinct ids than the table has room for")
    freq = np.zeros(len(counts), np.int64)
    if len(used):
        freq[used] = np.maximum(1, counts[used] * (total - len(used)) // counts.sum())
        short = total - int(freq.sum())
        freq[used[np.argmax(counts[used])]] += short
    return freq


def encode_shard(ids: np.ndarray, *, lanes: int = LANES, block: int = BLOCK, spacing: int = SPACING) -> dict:
    """Table, blocks and checkpoints of one stream of ids."""
    counts = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    freq = frequencies(counts)
    used = np.flatnonzero(freq)
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    freq = freq.astype(np.uint64)
    n_blocks = max(1, -(-len(ids) // block))
    steps = block // lanes if n_blocks > 1 else -(-len(ids) // lanes)
    sizes = [min(block, len(ids) - b * block) for b in range(n_blocks)]
    own = -(-np.array(sizes) // lanes)  # steps of each block; only the last block has fewer
    filler = int(np.argmax(counts))
    grid = np.full(n_blocks * steps * lanes, filler, np.int64)
    grid[: len(ids)] = ids
    grid = grid.reshape(n_blocks, steps, lanes)
    state = np.full((n_blocks, lanes), LOW, np.uint64)
    emitted = np.zeros((steps, n_blocks, lanes), bool)
    words = np.zeros((steps, n_blocks, lanes), np.uint32)
    marks = np.zeros((-(-steps // spacing), n_blocks, lanes), np.uint64)
    room = np.uint64(63 - SCALE_BITS)
    for t in range(steps - 1, -1, -1):
        ids_t = grid[:, t]
        f = freq[ids_t]
        live = (own > t)[:, None]
        full = (state >= f << room) & live
        emitted[t], words[t] = full, state & np.uint64(0xFFFFFFFF)
        moved = np.where(full, state >> np.uint64(32), state)
        times = moved // f
        state = np.where(live, (times << np.uint64(SCALE_BITS)) + (moved - times * f) + start[ids_t], state)
        if t % spacing == 0:
            marks[t // spacing] = state
    sent = emitted.sum(axis=2)  # (steps, blocks)
    before = np.cumsum(sent, axis=0) - sent
    payload = [words[:, b][emitted[:, b]].astype("<u4").tobytes() for b in range(n_blocks)]
    parts = [max(1, -(-int(n) // spacing)) for n in own]
    flat = ids.astype("<u4")
    return {
        "table": zlib.compress(
            np.concatenate([np.diff(used, prepend=0), freq[used].astype(np.int64)]).astype("<u4").tobytes(), 6
        ),
        "sizes": sizes,
        "blocks": payload,
        "states": [marks[: parts[b], b].astype("<u8").tobytes() for b in range(n_blocks)],
        "places": [before[::spacing, b][: parts[b]].astype("<u4").tobytes() for b in range(n_blocks)],
        "words_crc": [zlib.crc32(p) for p in payload],
        "ids_crc": [zlib.crc32(flat[b * block : b * block + n].tobytes()) for b, n in enumerate(sizes)],
    }


def decode_shard(shard: dict, *, lanes: int = LANES, block: int = BLOCK, spacing: int = SPACING) -> np.ndarray:
    """The stream of ids; every checkpoint of every block advances at once. Raises if a checksum fails."""
    for payload, crc in zip(shard["blocks"], shard["words_crc"]):
        if zlib.crc32(payload) != crc:
            raise ValueError("a block's words are damaged")
    table = np.frombuffer(zlib.decompress(shard["table"]), "<u4").astype(np.int64).reshape(2, -1)
    used, freq = np.cumsum(table[0]), table[1]
    total = sum(shard["sizes"])
    if not total:
        return np.zeros(0, np.int64)
    slot = np.repeat(np.arange(len(used)), freq)
    start, freq = (np.cumsum(freq) - freq).astype(np.uint64), freq.astype(np.uint64)
    lengths = np.array([len(p) // 4 for p in shard["blocks"]])
    words = np.concatenate([np.frombuffer(p, "<u4") for p in shard["blocks"]] + [np.zeros(lanes, "<u4")]).astype(np.uint64)
    base = np.cumsum(lengths) - lengths
    state = np.concatenate([np.frombuffer(s, "<u8").reshape(-1, lanes) for s in shard["states"]]).astype(np.uint64)
    place = np.concatenate([b + np.frombuffer(p, "<u4").astype(np.int64) for b, p in zip(base, shard["places"])])
    # Ids and steps of each part; only the last part of a block may have fewer.
    n_ids = np.array([min(spacing * lanes, n - at) for n in shard["sizes"] for at in range(0, max(n, 1), spacing * lanes)])
    own = -(-n_ids // lanes)
    out = np.zeros((len(own), int(own.max()), lanes), np.int64)
    low_bits = np.uint64((1 << SCALE_BITS) - 1)
    for t in range(out.shape[1]):
        live = (own > t)[:, None]
        at = slot[(state & low_bits).astype(np.int64)]
        out[:, t] = at
        moved = freq[at] * (state >> np.uint64(SCALE_BITS)) + (state & low_bits) - start[at]
        need = (moved < LOW) & live
        rank = np.cumsum(need, axis=1)
        word = words[np.minimum(place[:, None] + rank - 1, len(words) - 1)]
        state = np.where(live, np.where(need, (moved << np.uint64(32)) | word, moved), state)
        place = place + rank[:, -1]
    keep = np.arange(out.shape[1] * lanes) < n_ids[:, None]
    ids = used[out.reshape(len(own), -1)[keep]]
    for b, crc in enumerate(shard["ids_crc"]):
        if zlib.crc32(ids[b * block : b * block + shard["sizes"][b]].astype("<u4").tobytes()) != crc:
            raise ValueError("a block decodes to other ids")
    return ids


#: Chunks that can stand on a line of their own: white space would join the line end.
LINE = re.compile(r" ?\S+")
#: Classes of code points: letters and digits, other signs, the apostrophe (contractions start with it), blanks,
#: other white space, the end of a text.
WORD, SIGN, APOSTROPHE, BLANK, SPACE, END = range(6)


def classes() -> np.ndarray:
    """The class of every code point, as Python's patterns (and ``CHUNK``) see it."""
    everything = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    table = np.full(0x110000, SIGN, np.uint8)
    for pattern, kind in ((r"[^\W_]+", WORD), ("'", APOSTROPHE), (r"\s+", SPACE), (" ", BLANK)):
        for run in re.finditer(pattern, everything):
            table[run.start() : run.end()] = kind
    return table


def cuts(kinds: np.ndarray) -> np.ndarray:
    """Places before which the splitter cuts for sure: around signs, before white space and around its last character.

    A last blank stays with the word behind it; what follows an apostrophe may belong to it.
    """
    solid, white = kinds < BLANK, (kinds == BLANK) | (kinds == SPACE)
    end, word, sign = kinds == END, kinds == WORD, kinds == SIGN
    cut = np.ones(len(kinds) + 1, bool)
    inner = cut[1:-1]
    inner[:] = white[1:] & solid[:-1] | (kinds[:-1] == SPACE) & solid[1:] | end[1:] | end[:-1]
    inner |= word[:-1] & solid[1:] & ~word[1:] | sign[:-1] & word[1:]
    inner[:-1] |= white[1:-1] & solid[2:]
    return np.flatnonzero(cut)


class Chunks(dict):
    """Chunk of text → its ids as bytes; each distinct chunk is encoded once per task by the library.

    The tokenizer cuts between chunks (see ``cuts``), so a text gets its chunks'
    ids. Texts with added tokens, or with characters whose class is not sure, are
    encoded whole. New chunks go to the library as lines of one text, and its line
    ends part their ids again; runs of letters, which the splitter leaves whole,
    pass it by and go to the library's merges in byte characters.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        line_end = self.whole("\n")
        if len(line_end) != 1 or self.whole("a\n b\nc").tolist().count(line_end[0]) != 2:
            raise ValueError("the tokenizer does not keep line ends apart")
        self.line_end = int(line_end[0])
        self.kinds = classes()
        self.shown = code_points("".join(byte_characters()))
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(byte_characters()[ord("\n")])
        tokens = self.merges.get_vocab()
        self.sizes = np.zeros(max(tokens.values()) + 1, np.int64)
        self.sizes[list(tokens.values())] = list(map(len, tokens))
        some = ["Chunk", " of", " é漢"]
        if not set(byte_characters()) <= set(tokens) or self.run(some) != [self.whole(x).tobytes() for x in some]:
            raise ValueError("the tokenizer is not of the byte-level kind")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def lines(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that can stand on lines of their own."""
        ids = self.whole("\n".join(chunks))
        edges = [-1, *np.flatnonzero(ids == self.line_end).tolist(), len(ids)]
        if len(edges) != len(chunks) + 1:
            raise AssertionError("line ends and chunks do not match")
        raw = ids.tobytes()
        return [raw[4 * low + 4 : 4 * high] for low, high in zip(edges, edges[1:])]

    def run(self, chunks: list[str]) -> list[bytes]:
        """Ids of runs of letters with or without a blank before them."""
        text = np.frombuffer("\n".join(chunks).encode(), np.uint8)
        shown = self.shown[text].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([shown], add_special_tokens=False)[0].ids, np.uint32)
        # The line ends are gone; tokens are as long as the bytes they stand for.
        ends = np.append(np.flatnonzero(text == ord("\n")), len(text)) - np.arange(len(chunks))
        reached = np.append(0, np.cumsum(self.sizes[ids]))
        edges = np.searchsorted(reached, ends)
        if reached[-1] != ends[-1] or (reached[edges] != ends).any():
            raise AssertionError("tokens and chunks do not match")
        raw, edges = ids.tobytes(), [0, *(4 * edges).tolist()]
        return [raw[low:high] for low, high in zip(edges, edges[1:])]

    def learn(self, chunks: Iterable[str]) -> None:
        runs, lines = [], []
        for c in chunks:
            if (c[1:] if c[0] == " " else c).isalpha():
                runs.append(c)
            elif LINE.fullmatch(c):
                lines.append(c)
            else:
                self[c] = self.whole(c).tobytes()
        for some, encode in ((runs, self.run), (lines, self.lines)):
            for k in range(0, len(some), TOGETHER):
                self.update(zip(some[k : k + TOGETHER], encode(some[k : k + TOGETHER])))

    def known(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks; new ones are learnt."""
        found = list(map(self.get, chunks))
        fresh = [k for k, raw in enumerate(found) if raw is None]
        self.learn([chunks[k] for k in fresh])
        for k in fresh:
            found[k] = self[chunks[k]]
        return found

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every text; ``SLICE`` code points are cut up at a time."""
        start = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= SLICE or k == len(texts) - 1:
                yield from self.encode_slice(texts[start : k + 1])
                start, size = k + 1, 0

    def encode_slice(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self) > REMEMBERED:
            self.clear()
        plain = [not (self.added.search(x) or ODD.search(x)) for x in texts]
        own = [x for x, ok in zip(texts, plain) if ok]
        # A line end closes each text; as a chunk of its own it is dropped again.
        text = "".join([x + "\n" for x in own])
        points = code_points(text)
        ends = np.cumsum([len(x) + 1 for x in own], dtype=np.int64)
        kinds = self.kinds[points]
        kinds[ends - 1] = END
        edges = cuts(kinds) if own else np.zeros(1, np.int64)
        flat, at = joined_ids(parts_of(text, points, edges), self.known)
        last = at[np.searchsorted(edges, ends - 1)]
        lows = iter(np.append(0, last + 1).tolist())
        highs = iter(last.tolist())
        for x, ok in zip(texts, plain):
            yield flat[next(lows) : next(highs)] if ok else self.whole(x)


SHARD_SCHEMA = (
    "part int, shard int, doc_ids array<long>, doc_sizes array<long>, table binary, sizes array<long>, blocks array<binary>,"
    " states array<binary>, places array<binary>, words_crc array<long>, ids_crc array<long>"
)


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 0,
    partitions: int | None = None,
) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id order (nulls first).

    Rows of one doc_id follow each other in the order of their text's hash. A
    null text counts as empty and has the end id alone. A text of any length
    goes into one shard.
    """
    arrow = pa.schema(
        [("part", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
         ("table", pa.binary()), ("sizes", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary())),
         ("states", pa.list_(pa.binary())), ("places", pa.list_(pa.binary())), ("words_crc", pa.list_(pa.int64())),
         ("ids_crc", pa.list_(pa.int64()))]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, part, shard = Chunks(tokenizer), TaskContext.get().partitionId(), 0
        held, doc_ids, size = [], [], 0

        def close() -> pa.RecordBatch:
            row = encode_shard(np.concatenate(held).astype(np.int64))
            row |= {"part": part, "shard": shard, "doc_ids": doc_ids, "doc_sizes": [len(x) for x in held]}
            return pa.RecordBatch.from_pylist([row], arrow)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), chunks.encode(texts)):
                held.append(np.concatenate([ids, end]))
                doc_ids.append(doc)
                size += len(held[-1])
                if size >= SHARD_IDS:
                    yield close()
                    held, doc_ids, size, shard = [], [], 0, shard + 1
        if held:
            yield close()

    rows = docs.select(quote(doc_id).cast("long").alias("doc_id"), quote(text).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    n = partitions or max(1, rows.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    coded = ordered.mapInArrow(encode, SHARD_SCHEMA)
    coded.write.option("maxRecordsPerFile", SHARDS_PER_FILE).option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids array<int>]) of every document of the files.

    ``start`` counts the ids of all documents before it: shard totals are summed
    in order of part and shard, then added to the places within each shard.
    """
    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = files.selectExpr("part", "shard", "aggregate(doc_sizes, 0L, (a, b) -> a + b) as n")
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per writing task, then one per shard of a task: the sums never meet in one place.
    ahead = parts.withColumn("ahead", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.withColumn("inside", F.sum("n").over(within)).join(ahead.select("part", "ahead"), "part")
    base = base.selectExpr("part", "shard", "coalesce(ahead, 0L) + coalesce(inside, 0L) as base")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_shard(row).astype("<u4")
                sizes = np.array(row["doc_sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                own = [ids[s : s + n] for s, n in zip(starts, sizes)]
                for k in range(0, len(own), 2000):
                    some = own[k : k + 2000]
                    columns = [
                        pa.array([row["part"]] * len(some), pa.int32()), pa.array([row["shard"]] * len(some), pa.int32()),
                        pa.array(row["doc_ids"][k : k + 2000], pa.int64()), pa.array(starts[k : k + 2000]),
                        pa.array(sizes[k : k + 2000]), pa.array([zlib.crc32(x.tobytes()) for x in some], pa.int64()),
                    ]
                    names = ["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int32) for x in some], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.record_batch(columns, names)

    kinds = "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    rows = files.mapInArrow(decode, kinds).join(base, ["part", "shard"])
    return rows.selectExpr("doc_id", "base + place as start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))

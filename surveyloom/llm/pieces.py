"""SentencePiece encoding and decoding of merge-type vocabularies.

Adjacent symbols whose join is a piece wait in an agenda ordered by score (ties:
the leftmost); the best pair is merged until none is left. A merge never crosses
a boundary that no piece of the vocabulary spans, so a text falls into segments
and each distinct segment is worked out once per task. A slice of texts is cut in
numpy and its distinct segments are found by Arrow. Its new words share their
agendas: a row of pair ranks per word, whose least entries are merged for all words
at once; long or unusual ones keep a heap of their own. Symbols that are no piece
become their UTF-8 byte pieces. Normalisation and decoding are the library's.

Every slice of an Arrow batch is also encoded by the library; a difference raises.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import code_points, joined_ids, parts_of, texts_of

SPACE = "▁"
#: Distinct segments a task remembers before it starts afresh.
REMEMBERED = 600_000
#: Code points of the texts that are encoded and checked at a time.
SLICE = 2_000_000
#: Words up to this length share agendas, this many words at a time.
SHORT, TOGETHER = 30, 4096
#: Rank of a pair that makes no piece.
NEVER = np.int32(2**31 - 1)


class Agenda(dict):
    """Word after a space mark → its ids as 32-bit numbers."""

    def __init__(self, model: str):
        super().__init__()
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib, n = self.library, self.library.get_piece_size()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        if any(lib.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids = {lib.id_to_piece(i): i for i in range(n) if not special[i]}
        self.cost = {piece: -lib.get_score(i) for piece, i in self.ids.items() if len(piece) > 1}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown, self.fallback = lib.unk_id(), lib.is_byte(self.bytes[0])
        self.end = lib.eos_id()
        self.shown = pa.array([b"%d " % i for i in range(n)], pa.large_binary())
        # A text can be cut before a space mark that follows another character if no piece spans that place,
        # and around a line end if no longer piece holds one.
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        self.crosses = any(map(crossing.search, self.cost))
        self.lines = any("\n" in p for p in self.cost)
        self.cut = re.compile(
            r"(?s).+" if self.crosses else f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.lines else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        )
        self.prepare_ranks()

    def prepare_ranks(self) -> None:
        """Pairs of ids as sorted numbers with the rank of the piece they make; the best piece has rank 0."""
        ids = self.ids
        ranked = sorted(self.cost, key=self.cost.get)
        self.piece_of = np.array([ids[p] for p in ranked], np.int32)
        pairs = {
            ids[p[:k]] << 32 | ids[p[k:]]: rank
            for rank, p in enumerate(ranked) for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[x] for x in self.pairs.tolist()], np.int32)
        self.characters = np.full(0x110000, -1, np.int32)
        # Words with characters that are no pieces, and vocabularies with equal scores, keep to the heap.
        scores = [c for p, c in self.cost.items() if SPACE not in p[1:]]
        if not self.crosses and SPACE in ids and len(self.pairs) and len(set(scores)) == len(scores):
            for p, i in ids.items():
                if len(p) == 1 and p not in "\n" + SPACE:
                    self.characters[ord(p)] = i

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pieces that pairs of ids make; padding (-1) makes none."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NEVER)

    def learn(self, words: set[str]) -> None:
        """Encodes new words, those of like length together."""
        fresh = sorted((w for w in words if 0 < len(w) <= SHORT and w not in self), key=len)
        for k in range(0, len(fresh), TOGETHER):
            some = fresh[k : k + TOGETHER]
            symbols = self.characters[np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)]
            sizes = np.array([len(w) for w in some])
            width = int(sizes[-1])
            grid = np.full((len(some), width + 1), -1, np.int32)
            grid[:, 0] = self.ids.get(SPACE, -1)
            grid[:, 1:][np.arange(width) < sizes[:, None]] = symbols
            known = (grid >= 0).sum(axis=1) == sizes + 1
            self.share_agendas([w for w, ok in zip(some, known.tolist()) if ok], grid[known], sizes[known] + 1)

    def share_agendas(self, words: list[str], grid: np.ndarray, sizes: np.ndarray) -> None:
        """Merges the best pair of every word at once until no word has one."""
        left = np.arange(len(words))
        agenda = self.rank(grid[:, :-1], grid[:, 1:])
        while len(left):
            at = agenda.argmin(axis=1)
            least = agenda[np.arange(len(left)), at]
            done = least == NEVER
            if done.any():
                raw, step = grid[done].tobytes(), 4 * grid.shape[1]
                for k, (i, n) in enumerate(zip(left[done].tolist(), sizes[done].tolist())):
                    self[words[i]] = raw[k * step : k * step + 4 * n]
                live = ~done
                left, grid, sizes, agenda, at, least = (x[live] for x in (left, grid, sizes, agenda, at, least))
            if not len(left):
                break
            rows, width = np.arange(len(left)), grid.shape[1]
            grid[rows, at] = self.piece_of[least]
            # The right one of the pair goes, and so does the pair; the others move up.
            grid = np.take_along_axis(grid, np.arange(width - 1) + (np.arange(width - 1) > at[:, None]), axis=1)
            agenda = np.take_along_axis(agenda, np.arange(width - 2) + (np.arange(width - 2) >= at[:, None]), axis=1)
            sizes = sizes - 1
            if width < 3:
                agenda = np.full((len(left), 1), NEVER)
                continue
            for place in (at - 1, at):
                some = (place >= 0) & (place < width - 2)
                r, c = rows[some], place[some]
                agenda[r, c] = self.rank(grid[r, c], grid[r, c + 1])

    def merged(self, segment: str) -> list[str]:
        """The symbols of a segment of any length."""
        symbols: list[str | None] = list(segment)
        last = len(symbols) - 1
        after, before, cost = list(range(1, last + 2)), list(range(-1, last)), self.cost
        agenda = []
        for i in range(last):
            pair = symbols[i] + symbols[i + 1]
            if pair in cost:
                agenda.append((cost[pair], i, i + 1, pair))
        heapify(agenda)
        while agenda:
            _, left, right, pair = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if a is None or b is None or len(a) + len(b) != len(pair) or after[left] != right:
                continue  # one of the two has been merged meanwhile
            symbols[left], symbols[right] = pair, None
            after[left] = follow = after[right]
            if follow <= last:
                before[follow] = left
                joined = pair + symbols[follow]
                if joined in cost:
                    heappush(agenda, (cost[joined], left, follow, joined))
            lead = before[left]
            if lead >= 0:
                joined = symbols[lead] + pair
                if joined in cost:
                    heappush(agenda, (cost[joined], lead, left, joined))
        return [s for s in symbols if s is not None]

    def __missing__(self, word: str) -> bytes:
        """A word that does not share agendas; the space mark before it is not written out."""
        out = b"".join([self.segment(part) for part in self.cut.findall(SPACE + word)])
        if len(word) <= SHORT:
            self[word] = out
        return out

    def segment(self, segment: str) -> bytes:
        symbols = self.merged(segment)
        ids = list(map(self.ids.get, symbols))
        return array("I", self.spelled(symbols) if None in ids else ids).tobytes()

    def spelled(self, symbols: list[str]) -> list[int]:
        """Ids where some symbols are no pieces: their bytes, or one unknown id for a run of them."""
        ids: list[int] = []
        unknown_before = False
        for symbol in symbols:
            known = self.ids.get(symbol)
            if known is not None:
                ids.append(known)
            elif self.fallback:
                ids += [self.bytes[b] for b in symbol.encode()]
            elif not unknown_before:
                ids.append(self.unknown)
            unknown_before = known is None
        return ids

    def known(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct segments; a word after one space mark is remembered without it."""
        words = [p[1:] if p[0] == SPACE and p[1:2] != SPACE else None for p in parts]
        found = list(map(self.get, words))
        fresh = [k for k, raw in enumerate(found) if raw is None]
        self.learn({words[k] for k in fresh} - {None})
        for k in fresh:
            found[k] = self.segment(parts[k]) if words[k] is None else self[words[k]]
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of every text with the end id, as 32-bit numbers."""
        if len(self) > REMEMBERED:
            self.clear()
        split = [self.library.normalize(x) for x in texts]
        text = "".join(split)
        bounds = np.append(0, np.cumsum([len(x) for x in split], dtype=np.int64))
        points = code_points(text)
        cut = np.zeros(len(points) + 1, bool)
        cut[bounds] = True
        # The places at which ``cut`` parts a text.
        if not self.crosses:
            mark = points == ord(SPACE)
            cut[1:-1] |= mark[1:] & ~mark[:-1]
            if not self.lines:
                line_end = points == ord("\n")
                cut[1:-1] |= line_end[1:] | line_end[:-1]
        edges = np.flatnonzero(cut)
        flat, at = joined_ids(parts_of(text, points, edges), self.known)
        places = at[np.searchsorted(edges, bounds)].tolist()
        end = array("I", [self.end]).tobytes()
        for low, high in zip(places, places[1:]):
            yield flat[low:high].tobytes() + end

    def decimals(self, raws: list[bytes]) -> Iterator[bytes]:
        """The decimal form of the ids of every text, joined by blanks."""
        written = self.shown.take(pa.array(np.frombuffer(b"".join(raws), np.uint32)))
        offsets, text = np.frombuffer(written.buffers()[1], np.int64), memoryview(written.buffers()[2])
        places = offsets[np.append(0, np.cumsum([len(x) // 4 for x in raws], dtype=np.int64))].tolist()
        for low, high in zip(places, places[1:]):
            yield bytes(text[low : high - 1])

    def checked(self, texts: list[str]) -> Iterator[tuple[list[int], bytes]]:
        """(ids, their decimal form joined by blanks) of every text; raises where the library encodes another way."""
        start = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= SLICE or k == len(texts) - 1:
                some = texts[start : k + 1]
                own = list(self.encode(some))
                for raw, shown, ids in zip(own, self.decimals(own), self.library.encode(some, add_eos=True, num_threads=1)):
                    if array("I", ids).tobytes() != raw:
                        raise AssertionError("the agenda's ids differ from the library's")
                    yield ids, shown
                start, size = k + 1, 0


def encoded(docs: DataFrame, model: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string, ids_sha256) of every row, checked against the library.

    A null text counts as empty and has the end id alone; bytes that are no UTF-8
    count as replacement characters; repeated rows are encoded each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = Agenda(model)
        for batch in batches:
            ids, decoded, hashes = [], [], []
            for own, shown in agenda.checked(_texts(batch)):
                ids.append(pa.array(own, pa.int32()))
                decoded.append(agenda.library.decode(own))
                hashes.append(sha256(shown).hexdigest())
            sizes = pa.array([0, *map(len, ids)], pa.int32())
            flat = pa.concat_arrays(ids) if ids else pa.array([], pa.int32())
            lists = pa.ListArray.from_arrays(pa.compute.cumulative_sum(sizes), flat)
            yield pa.record_batch(
                [batch.column(0), lists, pa.array(decoded, pa.string()), pa.array(hashes, pa.string())],
                ["doc_id", "ids", "decoded", "ids_sha256"],
            )

    return _narrow(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>, decoded string, ids_sha256 string")


def piece_digests(docs: DataFrame, model: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the same encoding and decoding, without sending ids and texts on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = Agenda(model)
        for batch in batches:
            sizes, of_ids, of_texts = [], [], []
            for own, shown in agenda.checked(_texts(batch)):
                sizes.append(len(own))
                of_ids.append(sha256(shown).hexdigest())
                of_texts.append(sha256(agenda.library.decode(own).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _narrow(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in batch.column(1).to_pylist()]


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return texts_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))

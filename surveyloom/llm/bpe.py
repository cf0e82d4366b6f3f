"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a text has exactly one encoding, so also exactly one last token.
An automaton over the vocabulary reports the tokens that end at a place; such a
token is the prefix's last one if it is compatible with the last token of what
lies before it, that is, if merging the two side by side would leave both as
they are. Following the last tokens back from the end gives the ids. The work
is linear in the text, whatever the order of the merges.

Whether two neighbours are compatible follows from the life spans of the symbols
along their common edge: a symbol is there from the merge that makes it until
the merge that uses it up, and merges run in order of rank, the leftmost first.

Texts are cut at added tokens and then, by the library's own splitter, into
pieces no token crosses; each distinct piece is worked out once per task.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from surveyloom.functions import quote
from surveyloom.llm.common import texts_of

#: Distinct pieces and pairs a task remembers before it starts afresh.
REMEMBERED = 400_000
#: Code points of a text that are cut into pieces at a time.
SLICE = 1_000_000
#: Later than every merge.
NEVER = 1 << 60

# The bytes that byte-level vocabularies write as the character of the same number;
# the others follow in order from character 256 on.
SHOWN = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    shown = {b for low, high in SHOWN for b in range(low, high + 1)}
    hidden = (chr(256 + i) for i in range(256))
    return [chr(b) if b in shown else next(hidden) for b in range(256)]


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        plain = {"dropout": (None, 0), "continuing_subword_prefix": (None, ""), "end_of_word_suffix": (None, ""), "ignore_merges": (None, False)}
        odd = [k for k, allowed in plain.items() if model.get(k) not in allowed]
        if model["type"] != "BPE" or spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or odd:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.ids: dict[str, int] = model["vocab"]
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError("added tokens with conditions are not supported")
        ids = self.ids
        self.merges: dict[tuple[int, int], int] = {}  # pair → rank
        self.made: dict[int, tuple[int, int, int]] = {}  # token → rank and the pair it is made of
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, token = ids[left], ids[right], ids[left + right]
            if token in self.made or any(x in self.made and self.made[x][0] >= rank or len(s) > 1 and x not in self.made for x, s in ((a, left), (b, right))):
                raise ValueError("merges must make each token once, after its parts")
            self.merges[a, b] = rank
            self.made[token] = (rank, a, b)

    def bytes_of(self) -> dict[int, bytes]:
        """Every id's bytes; an added token's are those of its text."""
        number = {c: b for b, c in enumerate(byte_characters())}
        table = {i: bytes(number[c] for c in token) for token, i in self.ids.items() if all(c in number for c in token)}
        return table | {i: text.encode() for text, i in self.added.items()}


class Prefixes(dict):
    """Piece in byte characters → its ids."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.merges, self.made = vocabulary.merges, vocabulary.made
        self.automaton = ahocorasick.Automaton()
        for token, i in vocabulary.ids.items():
            if i in self.made or len(token) == 1:
                self.automaton.add_word(token, (i, len(token)))
        self.automaton.make_automaton()
        self.edges: tuple[dict, dict] = ({}, {})
        self.compatible: dict[tuple[int, int], bool] = {}
        self.reached: dict[int, bool] = {}
        self.size = {i: len(token) for token, i in vocabulary.ids.items()}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(symbol, rank of the merge that uses it up) along the token's left (0) or right (1) edge, itself first."""
        found = self.edges[side].get(token)
        if found is None:
            found, until, symbol = [], NEVER, token
            while True:
                found.append((symbol, until))
                if symbol not in self.made:
                    break
                until, *parts = self.made[symbol]
                symbol = parts[side]
            self.edges[side][token] = found
        return found

    def parted(self, left: int, right: int, before: int) -> bool:
        """No merge of a rank under ``before`` joins the two while both build up side by side."""
        merges = self.merges
        for a, a_until in self.edge(left, 1):
            for b, b_until in self.edge(right, 0):
                rank = merges.get((a, b))
                # Of equal ranks the merge further left comes first: a's own before this one, this one before b's.
                if rank is not None and rank < before and rank < a_until and rank <= b_until:
                    return False
        return True

    def reachable(self, token: int) -> bool:
        """The token's own text is encoded as the token."""
        known = self.reached.get(token)
        if known is None:
            made = self.made.get(token)
            known = made is None or (self.reachable(made[1]) and self.reachable(made[2]) and self.parted(made[1], made[2], made[0]))
            self.reached[token] = known
        return known

    def fits(self, left: int, token: int) -> bool:
        """Compatible neighbours; remembered."""
        if len(self.compatible) > REMEMBERED:
            self.compatible.clear()
        found = self.compatible[left, token] = self.reachable(token) and self.parted(left, token, NEVER)
        return found

    def __missing__(self, piece: str) -> list[int]:
        last: list[int | None] = [None] * len(piece)  # of the prefix that ends here
        known = self.compatible.get
        for end, (token, n) in self.automaton.iter(piece):
            if last[end] is None:
                if end >= n:
                    left = last[end - n]
                    fits = known((left, token))
                    if fits or fits is None and self.fits(left, token):
                        last[end] = token
                elif self.reachable(token):
                    last[end] = token
        ids, at, size = [], len(piece) - 1, self.size
        while at >= 0:
            token = last[at]
            ids.append(token)
            at -= size[token]
        ids.reverse()
        return ids


#: Chunks that start and end where the splitter cuts: runs of letters and digits with the blank before them,
#: full stops and commas after a word, other runs, single line ends, longer white space with what follows it.
CHUNK = re.compile(r" ?[^\W_]+|[.,]+(?!\S)| ?\S+|\n(?!\s)|\s+\S*")
#: Characters whose class the splitter and Python's tables may see differently; texts with them are cut by the splitter alone.
ODD = re.compile("[\x1c-\x1fᲉᲊꟋ-Ƛ\U00010500-\U0010ffff]")
#: A place before a blank where any text can be cut.
SAFE = re.compile(r"(?<=[^\W_])(?= )")


class Encoder(dict):
    """Chunk of text → its ids as 32-bit numbers in bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.vocabulary = Vocabulary(path)
        self.prefixes = Prefixes(self.vocabulary)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.shown = {b: c for b, c in enumerate(byte_characters()) if chr(b) != c}
        names = sorted(self.vocabulary.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.added = {name: array("I", [i]).tobytes() for name, i in self.vocabulary.added.items()}

    def __missing__(self, chunk: str) -> bytes:
        if (chunk[1:] if chunk[0] == " " else chunk).isalpha():  # one piece
            raw = array("I", self.prefixes[chunk.encode().decode("latin-1").translate(self.shown)]).tobytes()
        else:
            raw = b"".join(array("I", self.prefixes[piece]).tobytes() for piece, _ in self.split(chunk))
        if len(chunk) < 64:
            self[chunk] = raw
        return raw

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if ODD.search(text):
            return b"".join(array("I", self.prefixes[piece]).tobytes() for piece, _ in self.split(text))
        if len(text) <= SLICE:
            return b"".join(map(self.__getitem__, CHUNK.findall(text)))
        out, at = [], 0
        while at < len(text):
            cut = SAFE.search(text, at + SLICE)
            end = cut.start() if cut else len(text)
            out += map(self.__getitem__, CHUNK.findall(text[at:end]))
            at = end
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if len(self) > REMEMBERED:
            self.clear()
        if self.cuts is None or not self.cuts.search(text):
            return self.plain(text)
        return b"".join(self.added.get(part) or self.plain(part) for part in self.cuts.split(text) if part)


class Decoder:
    """Ids → text; what is no valid UTF-8 becomes replacement characters, as in the library."""

    def __init__(self, path: str):
        self.table = Vocabulary(path).bytes_of()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.table.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def encode_bpe(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row, in its place; ids equal the library's without special tokens around.

    A null text counts as empty and has no ids; a null id stays null; repeated
    rows are encoded each; bytes that are no UTF-8 count as replacement
    characters. Other columns are left behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            ids = [memoryview(encoder.encode((x or b"").decode("utf-8", "replace"))).cast("I").tolist() for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _narrow(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode_bpe(rows: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of ids; null ids count as none. An id outside the vocabulary raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(tokenizer)
        for batch in batches:
            texts = [decoder.decode(array("I", x or []).tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = rows.select(quote(doc_id).cast("long").alias("doc_id"), quote(ids).cast("array<int>").alias("ids"))
    return narrow.mapInArrow(run, "doc_id long, text string")


def bpe_digests(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding, then decoding of the ids, without sending them on.

    Nulls, empty texts and repeated rows count as in ``encode_bpe``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(tokenizer), Decoder(tokenizer)
        for batch in batches:
            sizes, of_ids, of_texts = [], [], []
            for x in batch.column(1):
                ids = encoder.encode((x.as_py() or b"").decode("utf-8", "replace"))
                sizes.append(len(ids) // 4)
                of_ids.append(sha256(ids).hexdigest())
                of_texts.append(sha256(decoder.decode(ids).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _narrow(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = texts_of(docs, doc_id=doc_id, text=text)
    return rows.withColumn("doc_id", rows["doc_id"].cast("long"))

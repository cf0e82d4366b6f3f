import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from surveyloom.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


ODD = ["ab", "the", " ", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\r", "9", "é", "漢", "'s", "!", ".", " ", "\x1c", "🙂", "<|endoftext|>", "<|END", "Ɤ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 1000, 65_536, 65_537, 140_000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) - 1, 50_256)
    shard = T.encode_shard(ids)
    assert np.array_equal(T.decode_shard(shard), ids)
    if n > 60_000:
        p = np.bincount(ids)[np.unique(ids)] / n
        bits = -(p * np.log2(p)).sum()
        assert sum(map(len, shard["blocks"])) * 8 / n < bits * 1.02 + 0.1


@pytest.mark.parametrize("block, lanes, spacing", [(64, 4, 3), (64, 8, 8), (256, 4, 100)])
def test_small_blocks(block, lanes, spacing):
    ids = np.random.default_rng(1).integers(0, 50_257, 1000)
    shard = T.encode_shard(ids, block=block, lanes=lanes, spacing=spacing)
    assert np.array_equal(T.decode_shard(shard, block=block, lanes=lanes, spacing=spacing), ids)


def test_damage_is_found():
    shard = T.encode_shard(np.arange(500) % 7)
    shard["blocks"] = [b"\x00" + shard["blocks"][0][1:]]
    with pytest.raises(ValueError):
        T.decode_shard(shard)


def test_one_id_only():
    ids = np.zeros(100_000, np.int64)
    assert np.array_equal(T.decode_shard(T.encode_shard(ids)), ids)


def test_chunks_equal_library(library):
    import random

    rng, chunks = random.Random(2), T.Chunks(PATH)
    texts = ["".join(rng.choice(["ab", "the", " ", " ", "  ", "\n", "\t", "9", "é", "漢", "'s", "!", " ", "<|endoftext|>"]) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for text, ids in zip(texts, chunks.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_cuts_are_the_splitters(library):
    import random

    rng, kinds = random.Random(3), T.classes()
    signs = ["ab", "the", " ", " ", "  ", "\n", "\t", "\xa0", "9", "é", "漢", "'s", "'", ".", ",", "_", "(", "²", "🙂", "\u0301"]
    for _ in range(2000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 25)))
        got = T.cuts(np.append(kinds[T.code_points(text)], T.END))[:-2].tolist()
        assert set(got) <= {low for _, (low, _) in library.pre_tokenizer.pre_tokenize_str(text)}, repr(text)
        if text[0].isalpha():
            assert len(got) >= len(text.split()), repr(text)


def test_runs_of_letters_pass_the_splitter_by(library):
    chunks = T.Chunks(PATH)
    texts = ["Words of lettérs " * 50 + "漢字 ßtraße", "", "one"]
    assert [len(ids) for ids in chunks.encode([""])] == [0]
    chunks.whole = chunks.lines = None  # the ways through the splitter
    assert [ids.tolist() for ids in chunks.encode(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_files(spark, make, corpus, library, tmp_path, monkeypatch):
    rows = [*corpus, (None, "no id")]
    T.write_token_files(make(rows), PATH, str(tmp_path / "t"), partitions=5)
    got = T.read_token_files(spark, str(tmp_path / "t"), with_ids=True).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, library.encode(t or "", add_special_tokens=False).ids + [0])
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    at = 0
    for r in got:
        assert list(r.ids) == want[r.doc_id] and r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_empty(spark, make, tmp_path):
    T.write_token_files(make([]), PATH, str(tmp_path / "t"))
    assert T.read_token_files(spark, str(tmp_path / "t")).isEmpty()

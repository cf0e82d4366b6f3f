import hashlib
import json
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from surveyloom.llm.bpe import Decoder, Encoder, Prefixes, Vocabulary, bpe_digests, decode_bpe, encode_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "e", "t", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'", "ing", "the", "12", "é", "日本", "🙂", "\x1c", "　",
       "\xa0", "_", "----", "aaaa", "́", "<|endoftext|>", "<|end", "AB", "\r\n", "Ɤ", "\U000105c0", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_digests_equal_library(make, corpus, library):
    rows = corpus + [(500, "a <|endoftext|>b<|endoftext|>"), (501, "<|endoftext|>"), (502, "aé" * 30_000), (503, "\n" * 20_000 + " x"), (None, "null id")]
    got = {r.doc_id: r for r in bpe_digests(make(rows), PATH).collect()}
    for i, t in rows:
        ids = ids_of(library, t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_round_trip(make, corpus, spark, library):
    ids = encode_bpe(make(corpus), PATH)
    assert {(r.doc_id, tuple(r.ids)) for r in ids.collect()} == {(i, tuple(ids_of(library, t or ""))) for i, t in corpus}
    back = decode_bpe(ids, PATH).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t or "") for i, t in corpus)
    lone = decode_bpe(spark.createDataFrame([(1, [26525]), (2, None)], "doc_id long, ids array<int>"), PATH).collect()
    assert [r.text for r in lone] == [library.decode([26525]), ""]
    assert encode_bpe(make([]), PATH).isEmpty() and bpe_digests(make([]), PATH).isEmpty()


def test_random_strings(library):
    rng, encoder, decoder = random.Random(5), Encoder(PATH), Decoder(PATH)
    for _ in range(20_000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 14)))
        ids, expected = encoder.encode(text), ids_of(library, text)
        assert ids == array("I", expected).tobytes(), repr(text)
        assert decoder.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_slices_and_bytes(spark, library, monkeypatch):
    """Long texts are cut at safe places only; bytes that are no UTF-8 become replacement characters."""
    rng = random.Random(6)
    text = "".join(rng.choice([*ODD, " word", " longer"]) for _ in range(20_000)).replace("Ɤ", "").replace("\x1c", "")
    text = "".join(c for c in text if ord(c) < 0x10000).replace("<|endoftext|>", "")
    monkeypatch.setattr("surveyloom.llm.bpe.SLICE", 500)
    assert Encoder(PATH).encode(text) == array("I", ids_of(library, text)).tobytes()
    df = spark.createDataFrame([(1, bytearray(b"ab\xff\xfec"))], "doc_id long, text binary").selectExpr("doc_id", "cast(text as string) text")
    row = encode_bpe(df, PATH).first()
    assert list(row.ids) == ids_of(library, "ab��c")


def test_last_token_of_every_prefix(tmp_path):
    """Random merge lists: equal to applying the merges one rank after the other."""
    rng = random.Random(7)
    for n in range(25):
        vocab = {c: i for i, c in enumerate("abc")}
        merges = []
        while len(merges) < 14:
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if a + b not in vocab and len(a + b) < 9:
                vocab[a + b] = len(vocab)
                merges.append([a, b])
        library = Tokenizer(models.BPE(vocab, [tuple(m) for m in merges]))
        library.pre_tokenizer, library.decoder = pre_tokenizers.ByteLevel(add_prefix_space=False), decoders.ByteLevel()
        path = str(tmp_path / f"{n}.json")
        library.save(path)
        prefixes = Prefixes(Vocabulary(path))
        for _ in range(150):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
            symbols = list(text)
            for a, b in merges:
                i = 0
                while i < len(symbols) - 1:
                    if symbols[i] == a and symbols[i + 1] == b:
                        symbols[i : i + 2] = [a + b]
                    i += 1
            assert prefixes[text] == [vocab[s] for s in symbols] == library.encode(text).ids


def test_other_vocabularies_raise(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    for change in ({"normalizer": {"type": "NFC"}}, {"model": spec["model"] | {"ignore_merges": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            Vocabulary(str(path))

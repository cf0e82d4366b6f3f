import hashlib
import random
from array import array

import public_tokenizers
import pytest
import sentencepiece

from surveyloom.llm.pieces import Agenda, encoded, piece_digests

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_equals_library(make, corpus, library):
    got = {r.doc_id: r for r in piece_digests(make(corpus), MODEL).collect()}
    for i, t in corpus:
        ids = library.encode(t or "", add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_strings(library):
    rng, agenda = random.Random(5), Agenda(MODEL)
    alphabet = "abcdeth in▁ \n\t.,0129ÄéλЖ漢🙂 ​<s></s>"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        ids = library.encode(text, add_eos=True)
        assert list(agenda.checked([text])) == [(ids, " ".join(map(str, ids)).encode())], repr(text)


def test_long_segments(library):
    rng, agenda = random.Random(6), Agenda(MODEL)
    text = "".join(rng.choice("aehnrst") for _ in range(60_000))
    assert [ids for ids, _ in agenda.checked([text])] == [library.encode(text, add_eos=True)]
    words = {"".join(rng.choice("aehnrsté") for _ in range(rng.randint(1, 40))) for _ in range(6000)}
    agenda.learn(words)
    assert {w for w in words if len(w) <= 30} == set(agenda)
    assert all(agenda[w] == agenda.segment("▁" + w) for w in words)


def test_segments_of_odd_texts_are_worked_out_once(library):
    agenda, calls = Agenda(MODEL), []
    segment = agenda.segment
    agenda.segment = lambda part: calls.append(part) or segment(part)
    texts = ["two  blanks and\nlines " * 300, "", "  two  ", "▁lines\n\n", "two  blanks"]
    assert [ids for ids, _ in agenda.checked(texts)] == library.encode(texts, add_eos=True)
    assert len(calls) == len(set(calls)) < 20


def test_ids_and_texts(make, corpus, library):
    got = {(r.doc_id, tuple(r.ids), r.decoded) for r in encoded(make(corpus), MODEL).collect()}
    expected = [(i, library.encode(t or "", add_eos=True)) for i, t in corpus]
    assert got == {(i, tuple(ids), library.decode(ids)) for i, ids in expected}


def test_difference_raises(library):
    agenda = Agenda(MODEL)
    agenda["word"] = agenda["other"]
    assert [ids for ids, _ in agenda.checked(["other words", ""])] == library.encode(["other words", ""], add_eos=True)
    with pytest.raises(AssertionError):
        list(agenda.checked(["fine", "a word"]))


def test_bytes_that_are_no_text(spark, library):
    df = spark.createDataFrame([(1, bytearray(b"ab\xff\xfec"))], "doc_id long, text binary").selectExpr("doc_id", "cast(text as string) text")
    assert list(encoded(df, MODEL).first().ids) == library.encode("ab\ufffd\ufffdc", add_eos=True)


def test_empty_and_null(make):
    assert encoded(make([]), MODEL).isEmpty()
    rows = encoded(make([(1, None), (None, "a b")]), MODEL).collect()
    assert [(r.doc_id, list(r.ids)[-1], r.decoded) for r in rows] == [(1, 2, ""), (None, 2, "a b")]

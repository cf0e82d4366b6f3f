import itertools
import random
import re
from hashlib import sha256

import numpy as np
import pytest

from surveyloom.llm import personal_data as P


@pytest.fixture(scope="module")
def field():
    return P.ShapeField(P.labelled_table())


def test_viterbi_equals_every_path(field):
    rng = np.random.default_rng(0)
    for n in (1, 2, 4):
        ids = rng.integers(1, len(field.number) + 2, (5, n))
        got = field.viterbi(ids)
        for row, labels in zip(ids, got):
            e = field.emissions(row)
            score = lambda y: field.first[y[0]] + sum(e[t][y[t]] for t in range(n)) + sum(field.step[y[t - 1], y[t]] for t in range(1, n))  # noqa: E731, B023
            assert np.isclose(score(labels), max(map(score, itertools.product(range(5), repeat=n))))


def test_held_out_accuracy():
    table = P.labelled_table()
    field = P.ShapeField(table[:240])
    right = total = 0
    for words, y in table[240:]:
        ids = np.array([field.number.get(P.shape(w), 1) for w in words])
        right += (field.decode([ids])[0] == y).sum()
        total += len(y)
    assert right / total > 0.97


def test_base_patterns():
    text = "a.b@c-d.example.com 1.2.3.256 001.2.3.4 x 4111 1111 1111 1111 x 4111111111111112 x 4111 1111 1111 1111 4111111111111111 x +1 (555) 010-9999 +12 x@y 1.2.3.4.5"
    got = [(P.KINDS[k], text[s:e]) for s, k, e in P.base_spans(text)]
    assert got == [("email", "a.b@c-d.example.com"), ("ip", "001.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 010-9999"), ("ip", "1.2.3.4")]


def test_long_digit_runs_take_linear_time():
    assert P.base_spans("1" * 100_000 + ".1.1.1 " + "9" * 100_000) == []


def test_rows(make, corpus, field):
    rng = random.Random(8)
    rows = list(corpus)
    rows += [(500 + i, f"{corpus[i][1]}\né call +1 (555) 555-{rng.randint(1000, 9999)} or mail x{i}@mail.example.com 10.0.0.{i}") for i in range(10)]
    rows += [(600, "write to joe[at]mail[dot]com or (555) 555-1234."), (None, "a@b.c")]
    got = sorted(P.find_personal_data(make(rows), field).collect(), key=repr)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        t = texts[r.doc_id] or ""
        base = P.base_spans(t)
        shown = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == sha256(shown.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))
        assert len(list(filter(None, r.spans.split(",")))) == len(base) + r.n_added
    by = {r.doc_id: r for r in got}
    assert by[505].n_email == by[505].n_phone == by[505].n_ip == 1
    extra = [texts[600][int(s) : int(e)] for _, s, e in re.findall(r"(\w+):(\d+):(\d+)", by[600].spans)]
    assert extra == ["joe[at]mail[dot]com", "(555) 555-1234"]
    assert sum(r.n_added for r in got if r.doc_id is not None and r.doc_id < 500) == 0


def test_empty(make, field):
    assert P.find_personal_data(make([]), field).isEmpty()


def test_lines_equal_one_by_one(field):
    rng = np.random.default_rng(5)
    lines = [rng.choice([field.number["a"], *range(1, 9)], rng.integers(0, 9), p=[0.84, *[0.02] * 8]) for _ in range(300)]
    got = field.decode_lines(np.concatenate(lines).astype(np.int64), [len(x) for x in lines])
    for x, y in zip(lines, got):
        want = field.decode([x.astype(np.int64)])[0]
        assert np.array_equal(want, y) if y is not None else not want.any()

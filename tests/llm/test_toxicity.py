import random

import numpy as np
import pytest

from surveyloom.llm import toxicity as T

SMALL = T.Shape(word=6, char=5, char_hidden=3, hidden=4, window=12, stride=8)


def test_windows_cover_and_overlap():
    for n in range(0, 100):
        starts = T.window_starts(n, SMALL)
        covered = {t for s in starts for t in range(s, min(s + 12, n))}
        assert covered == set(range(n))
        assert all(b - a < 12 for a, b in zip(starts, starts[1:]))


def test_tokens():
    assert T.split_tokens(b"The IDIOT's, x" + "é".encode()) == [b"the", b"idiot", b"s", b"x\xc3\xa9"]
    assert b"".join(T.split_tokens(b"y" * 100)) == b"y" * 100 and max(map(len, T.split_tokens(b"y" * 100))) == 24


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = T.Network([b"a", b"bb", b"ccc"], SMALL, 1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    windows = [[b"a", b"bb", b"zz"], [b"ccc", b"a", b"q", b"bb", b"bb"], [b"x"]]
    target = np.array([1.0, 0.0, 1.0])

    class Never:
        def random(self, n):
            return np.ones(n)

    def loss():
        logits = [net.document_logits([w], T.Tokens(net))[0][0] for w in windows]
        return float(np.mean([np.logaddexp(0, -z) if y else np.logaddexp(0, z) for z, y in zip(logits, target)]))

    grads = net.step(windows, target, Never())
    for name in net.w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in net.w[name].shape)
            if name == "word" and at[0] == 0:
                continue
            if name == "char":
                at = (ord("b"), at[1])
            keep = net.w[name][at]
            net.w[name][at] = keep + 0.01
            up = loss()
            net.w[name][at] = keep - 0.01
            down = loss()
            net.w[name][at] = keep
            assert abs((up - down) / 0.02 - grads[name][at]) < 2e-3, (name, at)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    rows = []
    for i in range(700):
        words = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 120))]
        bad = i % 3 == 0
        for _ in range(3 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["scoundrel", "zonk" + rng.choice("aei") + "t"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark, make, labelled):
    docs = make([(i, t) for i, t, _ in labelled] + [(9001, None), (9002, ""), (9003, "..."), (None, "a scoundrel here")])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in labelled] + [(None, 1, 1), (9001, None, 0)], "doc_id long, toxic int, text int")
    net = T.train_toxicity(docs, labels)
    rows = {r.doc_id: r for r in T.score_toxicity(docs, net).collect()}
    from zlib import crc32

    held = [(y, rows[i].predicted) for i, _, y in labelled if crc32(str(i).encode()) % 5 == 0]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert rows[9001].score == rows[9002].score == rows[9003].score == 0.0
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    kept = T.keep_clean(docs, net)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if not r.predicted}


def test_no_labels(spark, make):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.train_toxicity(make([(1, "x")]), labels) is None
    assert T.score_toxicity(make([(1, "x")]), None).first().score == 0.0
    assert T.score_toxicity(make([]), None).isEmpty()

import random
import re
from itertools import combinations

import pytest

from surveyloom.llm.decontaminate import MASKS, contaminated, seed_masks

RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 7))) for _ in range(3000)]


def prose(n):
    return [RNG.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="module")
def items():
    texts = [" ".join(prose(n)) for n in (30, 14, 60, 9, 6, 4)]
    return [(i, t) for i, t in enumerate(texts)] + [(50, texts[0].upper()), (51, None), (52, ""), (None, texts[1])]


def run(spark, make, rows, items, **settings):
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, words string, members int")
    return sorted(contaminated(make(rows), table, **settings).collect())


@pytest.mark.parametrize("limit", [200_000, 0])
def test_planted_and_clean(spark, make, items, limit):
    text = dict(items[:6])
    edited = text[2].split()
    for at in (3, 17, 30, 44, 58):  # one substitution in ten or so
        edited[at] = "zzz"
    part = text[2].split()[20:38]
    rows = [
        (1, " ".join(prose(200)) + "\n" + text[0] + ". " + " ".join(prose(50))),
        (2, " ".join(prose(100)) + " " + ", ".join(w.capitalize() for w in edited)),
        (3, " ".join(prose(40) + part + prose(40))),
        (4, text[3]), (5, "a " + text[4] + " b"), (6, text[5]),
        (7, " ".join(prose(5000))), (8, None), (9, ""), (10, " ".join(text[1].split()[:7] + prose(20))), (None, text[0]),
    ]
    got = run(spark, make, rows + rows[:1], items, broadcast_rows=limit)
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 0), (2, 2), (3, 2), (4, 3), (5, 4), (6, 5)]
    first, second, third = got[:3]
    assert (first.members, first.start, first.n_item, first.n_matched, first.coverage) == (2, 200, 30, 30, 1.0)
    assert (second.start, second.n_matched) == (100, 55)
    assert (third.start, third.n_aligned, third.n_matched >= 18) == (20, 60, True)


def test_begins_before_the_text(spark, make, items):
    half = dict(items[:6])[2].split()[30:]
    (row,) = run(spark, make, [(1, " ".join(half))], items)
    assert (row.start, row.n_aligned, row.n_matched) == (-30, 30, 30)


def test_equals_brute_force(spark, make, items):
    """Every alignment of every pair is tried; both must report the same pairs."""
    rows = []
    for i in range(60):
        words = prose(60)
        source = dict(items[:4])[i % 4].split()
        for k in range(RNG.randint(0, len(source))):
            words[10 + k : 11 + k] = [source[k] if RNG.random() < 0.9 else "other"]
        rows.append((i, " ".join(words)))
    got = {(r.doc_id, r.item_id) for r in run(spark, make, rows, items)}
    strong, any_run = set(), set()
    for d, text in rows:
        a = re.findall(r"\w+", text)
        for item, b in ((i, t.split()) for i, t in items[:5]):
            need = min(len(b), 13)
            for s in range(-len(b), len(a)):
                same = [0 <= s + j < len(a) and a[s + j] == b[j] for j in range(len(b))]
                for j in range(len(b) - need + 1):
                    if sum(same[j : j + need]) >= 0.8 * need:
                        any_run.add((d, item))
                    if all(same[j : j + min(len(b), 14)]) and len(same[j : j + 14]) == min(len(b), 14):
                        strong.add((d, item))
    assert strong <= got <= any_run and strong


def test_empty_tables(spark, make, items):
    assert run(spark, make, [], items) == [] and run(spark, make, [(1, "some words here and there")], []) == []


def substituted(words, places):
    return " ".join("other" if i in places else w for i, w in enumerate(words))


def test_every_two_substitutions(spark, make):
    """A run of 13 with any two tokens replaced is found, alone, inside a text and in a longer item."""
    words = [f"w{i}" for i in range(13)]
    places = [p for n in (0, 1, 2) for p in combinations(range(13), n)]
    texts = [substituted(words, p) for p in places] + [f"a {substituted(words, p)} b" for p in places]
    texts += [" ".join(words[2:]), " ".join(words[:11]), " ".join(words[1:12])]
    for item in (" ".join(words), " ".join(f"w{i}" for i in range(-4, 20))):
        got = run(spark, make, list(enumerate(texts)), [(1, item)])
        assert [r.doc_id for r in got] == list(range(len(texts)))
    weak = [substituted(words, p) for p in combinations(range(13), 3)]
    assert run(spark, make, list(enumerate(weak)), [(1, " ".join(words))]) == []


@pytest.mark.parametrize("n, differ", sorted(MASKS))
def test_masks_fit_every_place(n, differ):
    fits = [{at + i for i, bit in enumerate(m) if bit == "1"} for m in seed_masks(n, 0.8) for at in range(n - len(m) + 1)]
    assert all(any(fit.isdisjoint(p) for fit in fits) for p in combinations(range(n), differ))


def test_short_items_with_substitutions(spark, make):
    items = [(n, " ".join(f"i{n}w{i}" for i in range(n))) for n in range(5, 13)]
    texts = [(n, f"a {substituted(t.split(), p)} b") for n, t in items for p in combinations(range(n), n // 5)]
    got = run(spark, make, [(d, t) for d, (_, t) in enumerate(texts)], items)
    assert [(r.doc_id, r.item_id) for r in got] == [(d, n) for d, (n, _) in enumerate(texts)]
    weak = [f"a {substituted(t.split(), p)} b" for n, t in items for p in combinations(range(n), n // 5 + 1)]
    assert run(spark, make, list(enumerate(weak)), items) == []


@pytest.mark.parametrize("limit", [200_000, 0])
def test_long_copies(spark, make, limit):
    """A copy of thousands of tokens, with substitutions, is compared once, not once per seed."""
    long, middle = prose(4000), prose(500)
    edited = [w if i % 9 else "other" for i, w in enumerate(middle)]
    rows = [(1, " ".join(long)), (2, " ".join(prose(300) + long + prose(300))), (3, " ".join(edited + edited)), (4, " ".join(prose(3000)))]
    rows += [(10 + i, " ".join(middle)) for i in range(30)]
    got = {(r.doc_id, r.item_id): r for r in run(spark, make, rows, [(7, " ".join(long)), (8, " ".join(middle))], broadcast_rows=limit)}
    assert set(got) == {(1, 7), (2, 7), (3, 8), *((10 + i, 8) for i in range(30))}
    assert (got[2, 7].start, got[2, 7].n_matched) == (300, 4000)
    assert (got[3, 8].start, got[3, 8].n_matched) == (0, sum(a == b for a, b in zip(middle, edited)))


def brute(a, b, overlap=13, agree=0.8):
    """Best (n_matched, best run, -start) over all alignments of the item b, or None."""
    need, found = min(len(b), overlap), []
    for s in range(-len(b), len(a)):
        same = [0 <= s + j < len(a) and a[s + j] == b[j] for j in range(len(b))]
        best = max(sum(same[j : j + need]) for j in range(len(b) - need + 1))
        if best >= agree * need:
            found.append((sum(same), best, -s - 1))
    return max(found, default=None)


def test_exact_for_items_of_500_tokens(spark, make):
    """Runs anywhere in long items, with as many substitutions as are allowed: equal to trying every alignment."""
    rng = random.Random(9)
    items = [(i, prose(n)) for i, n in enumerate((500, 120, 13, 7))]
    rows = []
    for d in range(24):
        words, source = prose(60), items[d % 4][1]
        start, n = rng.randrange(max(1, len(source) - 40)), rng.choice([6, 10, 13, 30])
        part = [w if rng.random() < 0.85 else "zz" for w in source[start : start + n]]
        rows.append((d, words[:20] + part + words[20:]))
    got = {(r.doc_id, r.item_id): (r.n_matched, r.start) for r in run(spark, make, [(d, " ".join(w)) for d, w in rows], [(i, " ".join(w)) for i, w in items])}
    expected = {(d, i): brute(a, b) for d, a in rows for i, b in items}
    assert got == {k: (v[0], -v[2] - 1) for k, v in expected.items() if v} and len(got) > 5


def test_unspaced_and_short_items(spark, make):
    items = [(1, "日本語の質問です"), (2, "yes no"), (3, "คำถามภาษาไทย"), (4, "?!")]
    rows = [(1, "これは日本語の質問ですか"), (2, "say yes: no more"), (3, "yes and no"), (4, "ดูคำถามภาษาไทยนี้"), (5, "日本の言語"), (6, "?!")]
    assert [(r.doc_id, r.item_id) for r in run(spark, make, rows, items)] == [(1, 1), (2, 2), (4, 3)]

import random
import re
import zlib
from collections import Counter

import pytest

from surveyloom.llm.spelling import common, count_words, group_spellings, trie_nodes

LETTERS = "[A-Za-zÀ-ÿ]+"


def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall(LETTERS, text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words):
    rows, form = {}, {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_apart(w, v))
        best = near[0] if near and -near[0][0] >= 10 * n else None
        form[w] = best and best[1]
        rows[w] = [n, len(near), best and best[1], best and -best[0]]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows[w].append(root)
    return {w: tuple(r) for w, r in rows.items()}


def groups(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def variants(rng, n_roots, letters="abeé"):
    """Words with runs of equal letters, and many one or two slips away from others."""
    words = Counter()
    for _ in range(n_roots):
        root = "".join(rng.choice(letters) * rng.choice([1, 1, 2]) for _ in range(rng.randint(5, 8)))
        words[root] += rng.choice([500, 1000, 40])
        for _ in range(6):
            w = root
            for _ in range(rng.choice([1, 1, 2])):
                k, c = rng.randrange(len(w) + 1), rng.choice(letters)
                w = rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]])
            words[w] += rng.choice([2, 2, 3, 50])
    return dict(words)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_brute_force(spark, seed):
    words = variants(random.Random(seed), 60)
    got = groups(group_spellings(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)))
    assert got == brute_groups(words)


def test_ties_and_chains(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 20, "aaaabbb": 20, "aaaaabc": 200, "baaaaaa": 20, "xyz": 3, "": 5, "q": 60, "aaaaacb": 300}
    got = groups(group_spellings(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute_groups(words)
    assert got["aaaaaaa"][2:] == ("aaaaaab", 20, "aaaaacb")


def test_nodes_number_prefixes(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 12))) for _ in range(900)} | {"a" * 3000, "a" * 2999 + "b"})
    for partitions in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            df = spark.createDataFrame([(w, 1) for w in words], "word string, nodes_ int")
            rows = trie_nodes(df, "word", place="id").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        number = {}
        for r in rows:
            for d, node in enumerate(r.nodes):
                assert number.setdefault(r.word[:d], node) == node
        assert len(set(number.values())) == len(number)
        assert [r.word for r in sorted(rows, key=lambda r: r.id)] == words


def test_common():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(2))
        k = common(a, b)
        assert a[:k] == b[:k] and (k == min(len(a), len(b)) or a[k] != b[k])


def test_documents(spark, make, corpus):
    rows = corpus + [(500 + i, f"Wôrdword ÉCOLE×ié wordwôrd {'Z' * 20_000} longword\tlongwörd") for i in range(40)]
    words = brute_words(rows)
    got = groups(group_spellings(count_words(make(rows))))
    assert got == brute_groups(words)
    assert len(got) > 20


def test_empty_and_null(make, spark):
    assert group_spellings(count_words(make([]))).isEmpty()
    assert group_spellings(count_words(make([(1, None), (2, ""), (3, "short words")]))).isEmpty()
    rows = [(None, "sometimes"), (None, "sometimes"), (1, "nowadays nowadays")]
    assert groups(group_spellings(count_words(make(rows)))) == brute_groups(brute_words(rows))
    nulls = spark.createDataFrame([(None, 3), ("abcdefg", None), ("abcdefh", 4)], "word string, n long")
    assert groups(group_spellings(nulls)) == {"abcdefh": (4, 0, None, None, "abcdefh")}

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, h string, fp long, words string, item string"


def frame(spark, rows):
    """documents with columns whose names the operators use themselves."""
    wide = [(i, t, "en", "src0", None if t is None else len(t), 0.5, "h", 7, "w", "x") for i, t in rows]
    return spark.createDataFrame(wide, COLUMNS)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def corpus():
    """Random prose with copies, near copies, shared lines, and odd texts."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize()
    shared = prose(8)
    rows = [(i, "\n".join(prose(rng.randint(1, 30)) for _ in range(rng.randint(1, 8)))) for i in range(60)]
    rows += [(100 + i, f"{prose(5)}\n  {shared.upper() if i % 2 else shared}\t\n{prose(6)}") for i in range(6)]
    rows += [(200 + i, rows[3][1]) for i in range(5)]
    rows += [(300 + i, rows[5][1] + f" tail{i}") for i in range(5)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "\n\n"), (404, "one"), (405, "one two"), (406, "  double  blanks \n\n x ")]
    rows += [(407, prose(30_000)), (408, "x" * 50_000), (409, "日本語 ① ﬁ ▁ \x00 🙂"), (410, rows[0][1]), (410, rows[0][1])]
    return rows

import random

import numpy as np

from surveyloom.llm import licences as L

RNG = random.Random(4)


def prose(n):
    return " ".join("".join(RNG.choice("aeinrst") for _ in range(RNG.randint(2, 7))) for _ in range(n))


def test_winnow_keeps_one_of_every_window():
    for n in (0, 1, 2, 5, 40):
        h = np.random.default_rng(n).integers(0, 6, n).astype(np.uint64)
        kept = set(L.winnow(h, 4).tolist())
        for i in range(max(0, n - 3)):
            window = h[i : i + 4]
            assert i + 3 - int(np.argmin(window[::-1])) in kept


def test_align_against_full_table():
    """A band that covers everything equals the plain local alignment's score in matched words."""
    for _ in range(40):
        a = [RNG.choice([b"x", b"y", b"z"]) for _ in range(RNG.randint(1, 12))]
        b = [RNG.choice([b"x", b"y", b"z"]) for _ in range(RNG.randint(1, 12))]
        s = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                s[i + 1, j + 1] = max(0, s[i, j] + (2 if a[i] == b[j] else -1), s[i, j + 1] - 1, s[i + 1, j] - 1)
        matched, i0, i1, j0, j1 = L.align(a, b, -len(b), len(a))
        assert (s.max() == 0) == (matched == 0)
        if matched:
            gaps = (i1 - i0) + (j1 - j0) - 2 * matched
            assert s.max() <= 2 * matched and s.max() >= 2 * matched - gaps


def test_planted_and_clean(make):
    exact = prose(30) + "\n" + "Licensed under the Apache License, Version 2.0." + "\n" + prose(20)
    mit = dict(L.TEMPLATES)["MIT"].split()
    edited = mit[:10] + ["really"] + mit[10:20] + mit[21:30] + ["other"] + mit[31:]
    rows = [
        (1, exact), (2, "É " + " ".join(edited).upper()), (3, prose(5000)), (4, None), (5, ""),
        (6, "this work is permitted under the license"), (7, "Released under the MIT License. " * 2), (1, exact),
    ]
    got = sorted(L.scan_licences(make(rows)).collect())
    assert [(r.doc_id, r.template) for r in got] == [(1, "Apache-2.0"), (1, "Apache-2.0"), (2, "MIT"), (7, "MIT-notice"), (7, "MIT-notice")]
    assert exact[got[0].start : got[0].end] == "Licensed under the Apache License, Version 2.0" and got[0].coverage == 1.0
    assert got[2].start == 2 and got[2].matched == len(" ".join(mit).encode().translate(L.TABLE).split()) - 2 and got[2].end == len(rows[1][1])
    assert L.scan_licences(make([])).isEmpty()

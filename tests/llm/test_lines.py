import hashlib

from surveyloom.llm.lines import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_equals_brute_force(make, corpus):
    rows = [*corpus, (None, corpus[-10][1]), (None, corpus[60][1])]
    got = [tuple(r) for r in dedup_lines(make(rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert sum(r[3] for r in got) > 5


def test_boundaries(make):
    rows = [(i, f"{'a' * 19}é\n{'b' * 19}\nown {i}") for i in range(3)]
    got = {r.doc_id: r for r in dedup_lines(make(rows)).collect()}
    assert [got[i].n_dropped for i in range(3)] == [1, 1, 0]
    assert got[0].text == f"{'b' * 19}\nown 0"


def test_two_holders_of_repeated_rows_are_not_three(make):
    line = "a line that is long enough"
    got = dedup_lines(make([(1, line), (1, line), (2, line)])).collect()
    assert [r.n_dropped for r in got] == [0, 0, 0]


def test_carry_and_empty(make):
    got = dedup_lines(make([]), carry=["lang", "h"])
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped", "lang", "h"] and got.isEmpty()
    row = dedup_lines(make([(1, None)]), carry=["lang", "h", "n_chars"]).first()
    assert (row.text, row.n_lines, row.h, row.n_chars) == ("", 1, "h", None)
    assert hashlib.sha256(row.text.encode()).hexdigest().startswith("e3b0c442")

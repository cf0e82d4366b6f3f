import random

import pytest
import xxhash

from surveyloom.llm.simhash import fingerprint_links, keep_first, near_duplicates, segment_masks


def fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, fps, radius=2):
    label = {i: i for i in range(len(ids))}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_equals_brute_force(make, corpus):
    rows = [*corpus, (None, corpus[3][1])]
    got = near_duplicates(make(rows)).collect()
    fps = [fingerprint(t) for _, t in rows]
    want = [(i, f, c) for (i, _), f, c in zip(rows, fps, components([i for i, _ in rows], fps))]
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert len({r.component_id for r in got}) < len(rows) - 10


@pytest.mark.parametrize("radius, segments", [(2, 2), (3, 2), (3, 4), (1, 1)])
def test_links_within_radius(spark, radius, segments):
    rng = random.Random(radius)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for f in fps for _ in range(6)]
    signed = sorted({f - 2**64 if f >= 2**63 else f for f in fps})
    got = {tuple(r) for r in fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius=radius, segments=segments).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= radius}
    assert got == want and want


def test_balls():
    assert [len(flips) for *_, flips in segment_masks(2, 2)] == [33, 33]
    assert [len(flips) for *_, flips in segment_masks(3, 2)] == [1, 1, 1]


def test_keep_first(make, corpus):
    docs = make([*corpus, (None, None)])
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    want = {r.component_id for r in near_duplicates(docs).collect()}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == want


def test_empty(make):
    assert near_duplicates(make([])).isEmpty()

from __future__ import annotations

import random
import re

import pytest

from folioscope.llm import near_dedup as N

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, percent=80):
    sets = {d: shingle_set(t) for d, t in rows}
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_brute_force(spark, percent):
    """Chains of copies, each a little different from the last, so that far members meet only through others."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    rows, doc = [], 0
    for size in (1, 1, 2, 3, 5, 8, 40):
        text = [rng.choice(words) for _ in range(rng.randint(40, 300))]
        for _ in range(size):
            rows.append((doc, " ".join(text)))
            doc += 1
            for _ in range(rng.choice((0, 1, 1, 2, 4, 8))):
                text[rng.randrange(len(text))] = rng.choice(words)
    shared = [rng.choice(words) for _ in range(60)]
    for _ in range(25):  # a passage that many texts share
        rows.append((doc, " ".join(shared + [rng.choice(words) for _ in range(rng.randint(5, 60))])))
        doc += 1
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_groups(spark.createDataFrame(rows, SCHEMA), percent).collect()}
    assert got == brute(rows, percent)


def test_odd_texts_and_clashing_columns(docs, rows):
    found = N.near_groups(docs).collect()
    want = brute([(d, t) for d, t, *_ in rows])
    assert len(found) == len(rows)
    assert all((r.n_shingles, r.component_id, r.kept) == want[r.doc_id] for r in found)
    assert want[303][1] == want[304][1] == 303 and want[301][1] == 301 and want[302][1] == 302


def test_empty_and_null_ids(spark, no_docs):
    assert N.near_groups(no_docs).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "x y")]
    got = {r.doc_id: (r.component_id, r.kept) for r in N.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {None: (None, True), 1: (1, True), 2: (2, True)}


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 200), (200, 150), (300, 300)]
    got = dict(map(tuple, N.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {100: 100, 150: 100, 200: 100}


def test_components_extended_by_more_links(spark):
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    first, second = [(1, 2), (3, 4), (10, 11)], [(4, 2), (7, 8), (20, 1)]
    got = dict(map(tuple, N.extended(N.components(frame(first)), frame(second)).collect()))
    assert got == dict(map(tuple, N.components(frame(first + second)).collect())) == {1: 1, 2: 1, 3: 1, 4: 1, 20: 1, 10: 10, 11: 10, 7: 7, 8: 7}


def test_a_text_among_namesakes_is_linked(spark):
    """Two texts share a doc_id; a near copy of the second is linked to it."""
    first, second = (" ".join(f"{mark}{k}" for k in range(60)) for mark in "ab")
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in N.near_groups(spark.createDataFrame([(5, first), (5, second), (9, second + " more")], SCHEMA)).collect()}
    assert got[9, 57] == (5, False) and got[5, 56] == (5, True)


def test_banding_meets_similar_pairs():
    """Two sets at the limit of similarity share a table key (probability 0.9999)."""
    import numpy as np

    rng = np.random.default_rng(0)
    met = 0
    for _ in range(300):
        common = rng.integers(0, 1 << 63, 170, np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, 15, np.uint64)]) for _ in range(2))
        x, y = (N.mixed(N.mixed(h[0::2]) + h[1::2]) for h in (N.minhashes(a), N.minhashes(b)))
        met += (x[:8] == y[:8]).any() and (x[8:] == y[8:]).any()
    assert met >= 299


def test_dropping(docs):
    kept = N.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert 304 not in {r.doc_id for r in kept.select("doc_id").collect()}


def test_dropping_takes_copies_and_not_their_namesakes(spark):
    other, text = (" ".join(f"{mark}{k}" for k in range(60)) for mark in "ab")
    rows = [(5, other), (5, text), (3, text + " more"), (None, text)]
    kept = N.drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(5, other), (3, text + " more"), (None, text)], key=str)

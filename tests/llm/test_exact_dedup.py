from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import exact_dedup as X


def digest(text: str | None) -> str:
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def test_groups_equal_brute_force(docs, rows):
    groups: dict[str, list[int]] = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(digest(text), []).append(doc_id)
    want = sorted((d, min(groups[digest(t)]), len(groups[digest(t)]), d == min(groups[digest(t)]), digest(t)) for d, t, *_ in rows)
    assert sorted(map(tuple, X.exact_groups(docs).collect())) == want


def test_empty_table(no_docs):
    assert X.exact_groups(no_docs).count() == 0


def test_dropping_keeps_columns_and_one_of_each(docs, rows):
    kept = X.drop_copies(docs)
    assert kept.columns == docs.columns
    left = [digest(r.text) for r in kept.collect()]
    assert set(left) == {digest(t) for _, t, *_ in rows} and len(left) == len(set(left))


def test_dropping_takes_copies_and_not_their_namesakes(spark):
    rows = [(None, "same"), (1, "same"), (None, "alone"), (5, "A"), (5, "B"), (3, "B")]
    kept = X.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "same"), (None, "alone"), (5, "A"), (3, "B")], key=str)


def test_change_index(spark, docs):
    rows = X.digests(docs).cache()
    index = X.build_index(rows)
    gone = rows.where("doc_id = 307")
    after = {r.digest: r.group_size for r in X.change_index(index, rows.limit(0), gone).collect()}
    before = {r.digest: r.group_size for r in index.collect()}
    key = bytes(gone.first().digest)
    assert after[key] == before[key] - 2
    assert sum(after.values()) == sum(before.values()) - 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 300)), max_size=600))
def test_index_is_a_counted_map(steps):
    index, want = X.CuckooIndex(1), {}
    for insert, k in steps:
        key = hashlib.sha256(str(k).encode()).digest()
        if insert:
            index.add(key, k, 1)
            want[key] = want.get(key, 0) + 1
        elif key in want:
            index.take(key, 1)
            want[key] -= 1
            if not want[key]:
                del want[key]
    assert {k: v[1] for k, v in index.items()} == want and index.live == len(want)


def test_equal_fingerprints_are_told_apart_and_overflow_grows():
    index = X.CuckooIndex(1)
    keys = [b"\x01\x02" + bytes(8) + k.to_bytes(22, "big") for k in range(8)]
    for k, key in enumerate(keys):
        index.insert(key, k)
    assert all(index.values[index.find(key)] == k for k, key in enumerate(keys))
    assert index.find(b"\x01\x02" + bytes(29) + b"\x99") < 0
    more = [hashlib.sha256(bytes([k])).digest() for k in range(200)]
    for key in more:
        index.insert(key, None)
    assert index.buckets > 1 and all(index.find(k) >= 0 for k in keys + more)

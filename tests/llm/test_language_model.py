from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folioscope.llm import language_model as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
END = " "


def fold(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Brute:
    """The model by its formulas, over all training texts at once."""

    def __init__(self, rows):
        self.words = [(d, [*WORD.findall((t or "").translate(LOWER)), END]) for d, t in rows]
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        for d, ws in self.words:
            if not fold(d):
                h = [END, *ws]
                self.one.update(ws)
                self.two.update(zip(h, h[1:], strict=False))
                self.three.update(zip(h, h[1:], h[2:], strict=False))
        self.total, self.kinds = sum(self.one.values()), len(self.one)

    def p(self, word, history):
        if not history:
            return (self.one[word] + 1) / (self.total + self.kinds + 1)
        lower = self.p(word, history[1:])
        seen, whole = (self.two[*history, word], self.one[history[0]]) if len(history) == 1 else (self.three[*history, word], self.two[tuple(history)])
        k = L.PRIOR[len(history) - 1]
        return (seen + k * lower) / (whole + k)

    def row(self, doc_id, ws):
        h = [END, *ws]
        base = sum(math.log10(self.p(w, ())) for w in ws)
        score = sum(math.log10(self.p(w, h[max(0, k - 1) : k + 1])) for k, w in enumerate(ws))
        return doc_id, fold(doc_id), len(ws), sum(self.one[w] > 0 for w in ws), self.total, round(base, 6), round(score, 6)

    def rows(self):
        return sorted((self.row(*r) for r in self.words), key=str)


def got(frame):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("block,shard,segment", [(20_000, 700, 7), (1 << 30, 1 << 30, 1024)])
def test_equals_brute_force(docs, rows, block, shard, segment):
    """Base columns and the model's score, over several blocks, shards and segments, and over one."""
    found = L.score_documents(docs.coalesce(1), block_bytes=block, shard_entries=shard, segment=segment)
    assert got(found) == Brute([(d, t) for d, t, *_ in rows]).rows()


def test_every_history_is_a_distribution():
    rng = random.Random(0)
    texts = [" ".join(rng.choice("aaabcde") for _ in range(rng.randint(0, 12))) for _ in range(60)]
    model = Brute([(k, t) for k, t in enumerate(texts)])
    words = [*"abcde", END]
    for history in [(), *((a,) for a in words), *((a, b) for a in words for b in "abcde")]:
        assert sum(model.p(w, history) for w in words) + model.p("unseen", history) == pytest.approx(1)


def test_a_passage_seen_twice_scores_apart(spark):
    """What occurs twice is an arc at any size of the corpus: nothing is pruned by its share."""
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    free = [k for k in range(3000) if not fold(k)]
    rows = [(k, text(100)) for k in free[:1500]]
    held = [k for k in range(3000) if fold(k)][:2]
    rows += [(free[1500], rows[0][1]), (held[0], rows[0][1]), (held[1], text(100))]
    found = {r.doc_id: r for r in L.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gain = lambda d: (found[d].score - found[d].base_score) / found[d].n_tokens
    assert gain(held[0]) > 2 and gain(held[1]) < 0.1 and gain(free[0]) > gain(free[1])


def test_packing_round_trip():
    for values in (np.array([], np.uint64), np.array([1, 2**63, 5], np.uint64)):
        assert L.unpacked(L.packed(values), np.uint64).tolist() == values.tolist()


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c"), (None, "a b"), (1, "a b c"), (1, "x"), (1, "x"), (2, None)]
    assert got(L.score_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == Brute(rows).rows()


def test_empty_table(no_docs):
    assert L.score_documents(no_docs).count() == 0


def test_nothing_to_learn_from(spark):
    only = next(k for k in range(100) if fold(k))
    (row,) = L.score_documents(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and row.n_tokens == 3 and row.score == row.base_score == 0

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import packing as P
from folioscope.llm.queries import tokenizer_path
from folioscope.llm.tokens import encoder

PATH = tokenizer_path("word_bpe_49k.json")


def check(rows, size: int) -> dict[int, int]:
    """Gapless sequences of at most size; gives the fill of each."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return {k: sum(n for _, n in v) for k, v in held.items()}


def test_pieces_and_sequences(docs, rows):
    got = [r.asDict() for r in P.pack_documents(docs, PATH, 0, 2048).collect()]
    fill = check(got, 2048)
    tool = encoder(PATH).tokenizer
    want = defaultdict(int)
    for doc_id, text, *_ in rows:
        ids = np.array([*tool.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[doc_id, k, at, len(part), zlib.crc32(part.tobytes()), part.tobytes()] += 1
    have = defaultdict(int)
    for r in got:
        have[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])] += 1
    assert have == want
    assert len(fill) == -(-sum(fill.values()) // 2048)


def test_several_regions_and_levels(spark):
    rows = [(k, 0, 0, 200 + k * 37 % 900, k) for k in range(600)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = [r.asDict() for r in P.pack_pieces(pieces, 2048, 60).collect()]
    assert sorted(r["doc_id"] for r in got) == list(range(600))
    fill = check(got, 2048)
    assert len(fill) <= 1.02 * sum(r[3] for r in rows) / 2048 + 1


def decreasing(lengths, size):
    return P.best_fit([], sorted(range(len(lengths)), key=lambda p: -lengths[p]), lengths, size)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=120), st.integers(0, 5))
def test_evolution_keeps_every_piece_and_never_loses_to_best_fit(lengths, seed):
    first = decreasing(lengths, 100)
    for bins in P.evolve(lengths, 100, seed):
        assert sorted(p for _, held in bins for p in held) == list(range(len(lengths)))
        assert all(free == 100 - sum(lengths[p] for p in held) >= 0 for free, held in bins)
    best = P.evolve(lengths, 100, seed)[0]
    assert len(best) <= len(first)
    assert P.cost(P._bins(P._numbers(best, len(lengths)), lengths, 100), 100) == P.cost(best, 100)


def test_crossover_injects_whole_bins_and_changes_no_parent():
    import random

    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    base, donor = decreasing(lengths, 100), P.best_fit([], range(300), lengths, 100)
    before = [(f, list(h)) for f, h in base], [(f, list(h)) for f, h in donor]
    child = P.crossover(base, donor, random.Random(3), lengths, 100)
    assert sorted(p for _, held in child for p in held) == list(range(300))
    assert ([(f, list(h)) for f, h in base], [(f, list(h)) for f, h in donor]) == before
    whole = {tuple(sorted(h)) for f, h in donor if not f}
    assert whole & {tuple(sorted(h)) for _, h in child}


def test_evolution_beats_best_fit():
    """Fewer bins than best fit, longest first, on lengths of the corpus and on a hard case."""
    lengths = [44, 6, 24, 6, 8, 37, 21, 33, 21, 33, 13, 54] * 2
    assert sum(lengths) == 600
    assert len(P.evolve(lengths, 60, 1, generations=300)[0]) <= len(decreasing(lengths, 60))


def test_evolution_beats_best_fit_on_real_lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = [r.length for r in P.cut_pieces(docs, PATH, 0, 2048, False).where("length < 2048").orderBy("doc_id", "piece").select("length").collect()]
    fewer = more = 0
    for k in range(0, len(found) - 3000, 500):
        lengths = found[k : k + 3000]
        best = P.evolve(lengths, 2048, k, generations=P.EPOCHS * P.GENERATIONS)[0]
        fewer += len(best) < len(decreasing(lengths, 2048))
        more += len(best) > len(decreasing(lengths, 2048))
    assert fewer >= 1 and not more


def test_elites_migrate_between_islands(spark):
    """Every island ends with an individual at least as good as any that its neighbour had an epoch before."""
    rows = [(k % 2, 300 + k * 389 % 1200, k, k, 0) for k in range(600)]
    dealt = spark.createDataFrame(rows, "region long, length long, ids_crc32 long, doc_id long, piece int")
    best = {r.region: bytes(r.best) for r in P.evolved(dealt, 2, 2048, 0).collect()}
    for region in (0, 1):
        lengths = sorted((r[1] for r in rows if r[0] == region), reverse=True)
        bins = P._bins(best[region], lengths, 2048)
        assert sorted(p for _, h in bins for p in h) == list(range(300))
        alone = [P.evolve(lengths, 2048, region * 101 + island)[0] for island in range(P.ISLANDS)]
        assert P.cost(bins, 2048) <= min(P.cost(x, 2048) for x in alone)


def test_null_and_repeated_ids(spark):
    """All rows under one id, alike or null: dealt to several regions, and all packed."""
    rows = [(None, 0, 0, 500 + k % 3, 7) for k in range(400)] + [(5, 0, 0, 2048, 1)] * 3
    got = [r.asDict() for r in P.pack_pieces(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), 2048, 50).collect()]
    assert len(got) == 403 and len({r["sequence_id"] >> 24 for r in got}) > 4
    assert len(check(got, 2048)) <= 3 + 100 + 3


def test_a_full_last_level_ends(spark):
    """Pieces of which no two fit together never fill a bin, at any level."""
    rows = [(k, 0, 0, 1100, k) for k in range(300)]
    got = [r.asDict() for r in P.pack_pieces(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), 2048, 40).collect()]
    assert len(check(got, 2048)) == 300


def test_empty_table(no_docs):
    assert P.pack_documents(no_docs, PATH, 0, 2048).count() == 0

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import token_files as W
from folioscope.llm.queries import tokenizer_path
from folioscope.llm.tokens import Encoder, encoder

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.fixture(scope="module", params=FILES)
def tool(request) -> Encoder:
    return encoder(tokenizer_path(request.param))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(" \n\t 　ab'sdé́ÀΣςﬁ🙂12.,|<>_#") | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=6))
def test_words_give_the_ids_of_the_whole_text(tool, texts):
    want = [tool.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, tool.kind).tolist() for b in tool.encode(texts)] == want


def test_special_strings_are_ordinary(tool):
    (ids,) = tool.encode(["a <|endoftext|> b <|startoftext|>x"])
    assert max(np.frombuffer(ids, tool.kind)) < (50256 if tool.spaces else 49406)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=1500))
def test_wavelet_matrix(values):
    ids = np.array(values, np.uint16)
    matrix = W.WaveletMatrix.build(ids, 7)
    assert matrix.decode().tolist() == values
    for at in range(0, len(values), 97):
        assert matrix.access(at) == values[at]
    for token in (0, 3, 70):
        places = [k for k, v in enumerate(values) if v == token]
        assert matrix.count(token) == len(places)
        assert matrix.count(token, len(values) // 3, len(values) // 2) == sum(len(values) // 3 <= p < len(values) // 2 for p in places)
        for k in range(0, len(places), 5):
            assert matrix.select(token, k) == places[k]
        with pytest.raises(IndexError):
            matrix.select(token, len(places))


def test_shard_round_trip():
    ids = np.arange(1000, dtype=np.uint16) % 333
    shard = W.ShardFile(W.shard_bytes([None, -5, 7], [10, 0, 990], ids, 9, 4, 77) + b"\n")
    doc_ids, lengths = shard.documents()
    assert doc_ids == [None, -5, 7] and lengths.tolist() == [10, 0, 990] and shard.decode().tolist() == ids.tolist()
    assert (shard.part_number, shard.before, shard.size) == (4, 77, 1000)
    empty = W.ShardFile(W.shard_bytes([], [], ids[:0], 9))
    assert empty.documents()[0] == [] and empty.decode().tolist() == [] and empty.count(3) == 0


def test_a_shard_file_answers_from_the_blocks_it_needs():
    """Access, count and select over several blocks equal plain search, and open one block a plane, or two."""
    rng = np.random.default_rng(0)
    ids = (rng.zipf(1.3, 3 * W.BLOCK + 17) % 60_000).astype(np.uint16)
    data = W.shard_bytes([1], [len(ids)], ids, 16)
    for at in (0, 1, W.BLOCK - 1, W.BLOCK, len(ids) - 1, *rng.integers(0, len(ids), 20).tolist()):
        shard = W.ShardFile(data)
        assert shard.access(at) == ids[at]
        assert len(shard.opened) <= 1 + 16
    for token in (1, 2, 999, 59_999):
        places = np.flatnonzero(ids == token)
        shard = W.ShardFile(data)
        assert shard.count(token) == len(places)
        assert shard.count(token, 1000, 2 * W.BLOCK) == ((places >= 1000) & (places < 2 * W.BLOCK)).sum()
        for k in range(0, len(places), max(1, len(places) // 7)):
            assert shard.select(token, k) == places[k]
    assert W.ShardFile(data).decode().tolist() == ids.tolist()


def test_shards_give_back_every_document(spark, docs, rows):
    tool = encoder(tokenizer_path(FILES[0]))
    path = W.write_token_shards(docs, tokenizer_path(FILES[0]), 2)
    got = sorted(map(tuple, W.read_token_shards(spark, path).collect()))
    want, start = [], 0
    for doc_id, text in sorted((d, t or "") for d, t, *_ in rows):
        ids = [*tool.tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)
    assert sum(r.n for r in W.find_token(spark, path, 2).collect()) >= len(rows)


def test_null_and_repeated_ids_lie_gapless_in_order(spark):
    rows = [(None, "b b"), (None, "a"), (None, None), (3, "c c c"), (3, "d"), (1, "e")]
    path = W.write_token_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tokenizer_path(FILES[0]), 2)
    found = sorted(W.read_token_shards(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, None, 1, 3, 3]
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:k]) for k in range(len(found))]


def test_empty_table(spark, no_docs):
    assert W.read_token_shards(spark, W.write_token_shards(no_docs, tokenizer_path(FILES[0]), 2)).count() == 0

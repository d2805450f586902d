"""Language-model scoring with a weighted backoff automaton.

Counting. Every task numbers the words of its texts block by block (about BLOCK_BYTES of text each). A block then asks
for the training counts of its distinct words, bigrams and trigrams: sorted lists, cut by hash into shards, go to the
shards' tasks, which add the lists of all blocks up and send the totals back. So every n-gram of the whole corpus counts,
those seen once too; no n-gram is pruned, no task or driver ever holds the corpus's table, and a frequent word is one
entry a block. Words travel as strings; n-grams as hashes of so many bits that two of them meet with probability 1e-7.

Model. A hierarchy of Dirichlet priors: P(w) = (c(w) + 1) / (N + V + 1) and P(w | h) = (c(hw) + k P(w | h')) / (c(h) + k),
where h' lacks the first word of h and k is PRIOR of h's length. As an automaton: a state for each history, an arc
for each n-gram of training, and a failure arc from h to h' of weight k / (c(h) + k). Every state's distribution sums to
one. A block builds the part of the automaton that its texts can reach.

Scoring. One left-to-right traversal carries the state and adds up log10 weights; all documents of a block step together.
Long documents are cut where they are walked: two words fix the state, so a segment begins with the two before it.

Defined results: null or blank text is the end token alone. With no training text every probability is one. Rows with
the same doc_id, null too, are scored one by one. Ties cannot arise: no result depends on an order.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, crc_mod, id_and_text, mixed, stored, text_rows

END = b" "  # no word has a space
BLOCK_BYTES = 8_000_000
#: Blocks that one task of the scoring shuffle reads, one after another.
BLOCKS_PER_TASK = 4
#: Entries (words and n-grams of blocks) that one shard's task adds up, on average.
SHARD_ENTRIES = 2_000_000
#: Prior weight of the shorter history, for histories of one and of two words (tried on held-out texts).
PRIOR = (100.0, 4.0)
#: Hash bits beyond those that number all tokens.
SPARE_BITS = 24
SEGMENT = 1024


def packed(values: np.ndarray) -> bytes:
    """An array of integers, byte plane by byte plane, compressed: planes of zeros cost nothing."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def _join(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def _split(blob: bytes, count: int) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(b"\n") if count else []


class _Numbers(dict):
    """Numbers words as they come; the end token is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


_BLOCK = "block long, n_tokens long, doc_ids array<long>, held array<boolean>, sizes array<long>, n_words long, words binary, ids binary"


def _encode(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of _BLOCK: the documents of a block, its distinct words and all their numbers."""
    part, made = TaskContext.get().partitionId(), 0
    numbers, flat = _Numbers({END: 0}), array("I")
    doc_ids, held, sizes = [], [], []
    taken = 0

    def block() -> pa.RecordBatch:
        row = [part << 32 | made, len(flat), doc_ids, held, sizes, len(numbers), _join(list(numbers)), packed(np.frombuffer(flat, np.uint32))]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
        names = ["block", "n_tokens", "doc_ids", "held", "sizes", "n_words", "words", "ids"]
        return pa.record_batch([pa.array([value], kind) for value, kind in zip(row, kinds, strict=True)], names=names)

    for batch in batches:
        marks, at = batch.column("held_out").to_pylist(), 0
        for ids, texts in text_rows([batch], raw=True):
            for doc_id, text in zip(ids, texts, strict=True):
                before = len(flat)
                flat.extend(map(numbers.__getitem__, byte_words(text)))
                flat.append(0)
                doc_ids.append(doc_id)
                held.append(marks[at])
                sizes.append(len(flat) - before)
                at += 1
                taken += len(text) + 1
                if taken >= block_bytes:
                    yield block()
                    numbers, flat, doc_ids, held, sizes = _Numbers({END: 0}), array("I"), [], [], []
                    made, taken = made + 1, 0
    if doc_ids:
        yield block()


class Grams:
    """The distinct bigrams and trigrams of a block. ids: word numbers, each document ending in the end token 0, which is
    also what stands before a document's first word."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, held: np.ndarray):
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        ids = ids.astype(np.uint64)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[self.starts] = 0
        training = np.repeat(~held, sizes)
        self.pairs, place = np.unique(before << np.uint64(32) | ids, return_inverse=True)
        self.pair_count = np.bincount(place, training, len(self.pairs)).astype(np.int64)
        later = np.ones(len(ids), bool)
        later[self.starts] = False
        later = np.flatnonzero(later)
        self.triples, first, where = np.unique(place[later - 1].astype(np.uint64) << np.uint64(32) | ids[later], return_index=True, return_inverse=True)
        self.triple_count = np.bincount(where, training[later], len(self.triples)).astype(np.int64)
        self.head = (self.triples >> np.uint64(32)).astype(np.int64)  # a trigram's first two words, as a pair's number
        self.tail = place[later[first]]  # and its last two

    def keys(self, word_hash: np.ndarray, bits: int) -> np.ndarray:
        """Hashes of the pairs and then of the triples."""
        low = np.uint64(0xFFFFFFFF)
        pairs = mixed(mixed(word_hash[self.pairs >> np.uint64(32)]) + word_hash[self.pairs & low])
        triples = mixed(mixed(pairs[self.head] + np.uint64(1)) + word_hash[self.triples & low])
        return np.concatenate([pairs, triples]) >> np.uint64(64 - bits)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _opened(row: dict) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's words, their hashes, word numbers, tokens per document and marks of held-out documents."""
    words = _split(row["words"], row["n_words"])
    return words, _hashes(words), unpacked(row["ids"], np.uint32), np.array(row["sizes"], np.int64), np.array(row["held"], bool)


def _cuts(keys: np.ndarray, bits: int, shard_bits: int) -> np.ndarray:
    """Where each shard's part of sorted keys begins, and the end."""
    marks = np.arange((1 << shard_bits) - 1, dtype=np.uint64) + np.uint64(1)
    inner = np.searchsorted(keys, marks << np.uint64(bits - shard_bits))
    return np.concatenate([[0], inner, [len(keys)]])


_ASKED = "shard long, block long, n_words long, words binary, word_counts binary, grams binary, gram_counts binary"


def _requests(bits: int, shard_bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                words, word_hash, ids, sizes, held = _opened(row)
                grams = Grams(ids, sizes, held)
                word_count = np.bincount(ids, np.repeat(~held, sizes), len(words)).astype(np.uint32)
                by_word = np.argsort(word_hash, kind="stable")
                keys = grams.keys(word_hash, bits)
                by_gram = np.argsort(keys, kind="stable")
                keys, counts = keys[by_gram], np.concatenate([grams.pair_count, grams.triple_count])[by_gram].astype(np.uint32)
                word_cuts, gram_cuts = _cuts(word_hash[by_word], 64, shard_bits), _cuts(keys, bits, shard_bits)
                rows = []
                for shard in range(1 << shard_bits):
                    at, to = gram_cuts[shard : shard + 2]
                    own = by_word[word_cuts[shard] : word_cuts[shard + 1]]
                    if to > at or len(own):
                        rows.append((shard, row["block"], len(own), _join([words[w] for w in own.tolist()]), packed(word_count[own]), packed(np.diff(keys[at:to], prepend=np.uint64(0))), packed(counts[at:to])))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                names = [c.split(" ")[0] for c in _ASKED.split(", ")]
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return ask


_TOLD = "shard long, block long, word_totals binary, gram_totals binary, kinds long, tokens long"


def _add_up(table: pa.Table) -> pa.Table:
    """The totals of one shard for every block that asked. kinds and tokens of the shard stand in its first row."""
    column = {c: table.column(c).to_pylist() for c in ("shard", "block", "n_words", "words", "word_counts", "grams", "gram_counts")}
    listed = [_split(blob, n) for blob, n in zip(column["words"], column["n_words"], strict=True)]
    words = pa.array([w for part in listed for w in part], pa.binary()).dictionary_encode()
    at = words.indices.to_numpy().astype(np.int64)
    word_totals = np.bincount(at, np.concatenate([unpacked(b, np.uint32) for b in column["word_counts"]]), len(words.dictionary)).astype(np.uint64)
    keys = [np.cumsum(unpacked(b, np.uint64), dtype=np.uint64) for b in column["grams"]]
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    gram_totals = np.bincount(where, np.concatenate([unpacked(b, np.uint32) for b in column["gram_counts"]])).astype(np.uint64)
    word_ends, gram_ends = np.cumsum(column["n_words"]), np.cumsum([len(k) for k in keys])
    answers = [packed(word_totals[at[e - n : e]]) for e, n in zip(word_ends.tolist(), column["n_words"], strict=True)]
    told = [packed(gram_totals[where[e - len(k) : e]]) for e, k in zip(gram_ends.tolist(), keys, strict=True)]
    rest = [0] * (len(keys) - 1)
    return pa.table(
        {
            "shard": pa.array(column["shard"], pa.int64()),
            "block": pa.array(column["block"], pa.int64()),
            "word_totals": pa.array(answers, pa.binary()),
            "gram_totals": pa.array(told, pa.binary()),
            "kinds": pa.array([int((word_totals > 0).sum()), *rest], pa.int64()),
            "tokens": pa.array([int(word_totals.sum()), *rest], pa.int64()),
        }
    )


class Automaton:
    """Arcs as sorted keys (state, word) with weight and target. State 0 is the root, which has an arc for every word;
    1 + w is the history of word w, and the states after those are histories of two words, by number of pair."""

    def __init__(self, word_totals: np.ndarray, grams: Grams, gram_totals: np.ndarray, tokens: int, kinds: int, prior: tuple[float, float] = PRIOR):
        low, wide = np.uint64(0xFFFFFFFF), np.uint64(32)
        words, pairs = len(word_totals), len(grams.pairs)
        first, second = (grams.pairs >> wide).astype(np.int64), (grams.pairs & low).astype(np.int64)
        pair_totals, triple_totals = gram_totals[:pairs].astype(np.float64), gram_totals[pairs:].astype(np.float64)
        word_totals = word_totals.astype(np.float64)
        single = (word_totals + 1) / (tokens + kinds + 1)
        two = (pair_totals + prior[0] * single[second]) / (word_totals[first] + prior[0])
        three = (triple_totals + prior[1] * two[grams.tail]) / (pair_totals[grams.head] + prior[1])
        self.single = np.log10(single)
        self.fail = np.concatenate([np.zeros(1 + words, np.int64), 1 + second])
        self.backoff = np.log10(np.concatenate([[1.0], prior[0] / (word_totals + prior[0]), prior[1] / (pair_totals + prior[1])]))
        seen2, seen3 = np.flatnonzero(pair_totals), np.flatnonzero(triple_totals)
        self.keys = np.concatenate([grams.pairs[seen2] + (np.uint64(1) << wide), grams.triples[seen3] + (np.uint64(1 + words) << wide)])
        self.weight = np.log10(np.concatenate([two[seen2], three[seen3]]))
        self.target = 1 + words + np.concatenate([seen2, grams.tail[seen3]])

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights and next states: an arc if there is one, else failure arcs until there is."""
        weight, target = np.zeros(len(state)), np.zeros(len(state), np.int64)
        open_ = np.arange(len(state))
        while len(open_):
            now = state[open_]
            root = now == 0
            done = open_[root]
            weight[done] += self.single[word[done]]
            target[done] = 1 + word[done]
            open_, now = open_[~root], now[~root]
            key = now.astype(np.uint64) << np.uint64(32) | word[open_].astype(np.uint64)
            at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            weight[open_[hit]] += self.weight[at[hit]]
            target[open_[hit]] = self.target[at[hit]]
            open_, now = open_[~hit], now[~hit]
            weight[open_] += self.backoff[now]
            state = state.copy()
            state[open_] = self.fail[now]
        return weight, target

    def walk(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """The weight of every token; documents are ids[start:end], each begun in the state after an end token."""
        pieces = -(-(ends - starts) // segment)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(starts, pieces) + number * segment
        size = np.minimum(np.repeat(ends, pieces) - first, segment)
        order = np.argsort(-size, kind="stable")
        first, size, number = first[order], size[order], number[order]
        state = np.where(number == 0, 1, 0)
        later = np.flatnonzero(number)
        for back in (2, 1):
            state[later] = self.step(state[later], ids[first[later] - back])[1]
        out = np.empty(len(ids))
        alive = np.searchsorted(-size, -np.arange(1, segment + 1), side="right")
        for t in range(int(size.max(initial=0))):
            at = first[: alive[t]] + t
            out[at], state = self.step(state[: alive[t]], ids[at])
        return out


_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_documents(
    docs: DataFrame, folds: int = 7, held: int = 2, prior: tuple[float, float] = PRIOR, block_bytes: int = BLOCK_BYTES, shard_entries: int = SHARD_ENTRIES, segment: int = SEGMENT
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Training leaves out fold `held`."""
    rows = id_and_text(docs).withColumn("held_out", crc_mod(F.col("doc_id"), folds) == held)
    blocks = stored(rows.mapInArrow(lambda batches: _encode(batches, block_bytes), _BLOCK), "blocks")
    count, size = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    entries, tasks = 2 * int(size), max(1, -(-count // BLOCKS_PER_TASK))
    bits = min(64, entries.bit_length() + SPARE_BITS)
    shard_bits = max(0, -(-entries // shard_entries) - 1).bit_length()
    asked = blocks.mapInArrow(_requests(bits, shard_bits), _ASKED)
    told = stored(asked.repartition(1 << shard_bits, "shard").groupBy("shard").applyInArrow(_add_up, _TOLD), "totals")
    kinds, tokens = (int(x or 0) for x in told.agg(F.sum("kinds"), F.sum("tokens")).first())

    def score(block: pa.Table, totals: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        words, word_hash, ids, sizes, held_out = _opened(row)
        grams = Grams(ids, sizes, held_out)
        totals = totals.sort_by("shard")
        word_totals, gram_totals = np.zeros(len(words), np.uint64), np.zeros(len(grams.pairs) + len(grams.triples), np.uint64)
        word_totals[np.argsort(word_hash, kind="stable")] = np.concatenate([unpacked(b, np.uint64) for b in totals.column("word_totals").to_pylist()])
        gram_totals[np.argsort(grams.keys(word_hash, bits), kind="stable")] = np.concatenate([unpacked(b, np.uint64) for b in totals.column("gram_totals").to_pylist()])
        automaton = Automaton(word_totals, grams, gram_totals, tokens, kinds, prior)
        base = np.add.reduceat(automaton.single[ids], grams.starts)
        known = np.add.reduceat((word_totals[ids] > 0).astype(np.int64), grams.starts)
        total = np.add.reduceat(automaton.walk(ids, grams.starts, grams.ends, segment), grams.starts)
        columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(held_out), pa.array(sizes), pa.array(known), pa.array(base), pa.array(total)]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    answers = told.select("block", "shard", "word_totals", "gram_totals").repartition(tasks, "block")
    scored = blocks.repartition(tasks, "block").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, _SCORE)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")

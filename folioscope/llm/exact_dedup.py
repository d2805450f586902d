"""Exact dedup with a cuckoo-filter index.

Every partition feeds the digests of its rows to a local index, so that a group of copies, however large, leaves it as
one row. A second pass merges those rows shard by shard through one index each. A fingerprint hit counts only after
the full digest in the same bucket slot is equal. When an insertion finds no free slot the table doubles and is filled
again from the stored keys.

Defined results: null text counts as empty. Rows with equal doc_id and text all stay (they are the same document).
Null doc_ids never become keep_id unless a group has nothing else; such rows stay only if the whole group has no id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored

SLOTS = 4
KICKS = 200
#: Live digests that one shard's index should hold.
SHARD_KEYS = 250_000


class CuckooIndex:
    """Cuckoo filter whose slots keep the full digest beside the fingerprint, with a value for each live digest."""

    def __init__(self, buckets: int = 64):
        self._fresh(buckets)
        self.live = 0

    def _fresh(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (buckets * SLOTS)
        self.values: list = [None] * (buckets * SLOTS)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:10], "little") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def find(self, key: bytes) -> int:
        """The key's slot, or -1. The fingerprint finds candidates; the stored digest decides."""
        mark, a, b = self._places(key)
        for bucket in (a, b):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.keys[slot] == key:
                    return slot
        return -1

    def insert(self, key: bytes, value) -> None:
        """Adds a key that is not in the index."""
        while (left := self._place(key, value)) is not None:
            self._grow()
            key, value = left
        self.live += 1

    def _place(self, key: bytes, value):
        mark, a, b = self._places(key)
        bucket = a
        for kick in range(KICKS):
            for at in (a, b) if kick == 0 else (bucket,):
                for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.keys[slot], self.values[slot] = mark, key, value
                        return None
            slot = bucket * SLOTS + kick % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            key, self.keys[slot] = self.keys[slot], key
            value, self.values[slot] = self.values[slot], value
            bucket = self._other(bucket, mark)
        return key, value

    def _grow(self) -> None:
        """Doubles the table until every stored key has a slot."""
        old = [(k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None]
        size = self.buckets
        while True:
            size *= 2
            self._fresh(size)
            if all(self._place(k, v) is None for k, v in old):
                return

    def delete(self, key: bytes) -> bool:
        """Removes a live digest; False if it is not there."""
        if (slot := self.find(key)) < 0:
            return False
        self.prints[slot], self.keys[slot], self.values[slot] = 0, None, None
        self.live -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None)

    def add(self, key: bytes, doc_id: int | None, count: int) -> None:
        """Counts count rows of key; keeps the smallest doc_id seen."""
        if (slot := self.find(key)) < 0:
            self.insert(key, [doc_id, count])
            return
        value = self.values[slot]
        value[1] += count
        if doc_id is not None and (value[0] is None or doc_id < value[0]):
            value[0] = doc_id

    def take(self, key: bytes, count: int) -> None:
        """Takes count rows of key away; the digest goes with its last row."""
        if (slot := self.find(key)) >= 0:
            self.values[slot][1] -= count
            if self.values[slot][1] <= 0:
                self.delete(key)


def _digest() -> Column:
    spaced = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(spaced, 256))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the text with each run of white space made one space)."""
    return id_and_text(docs).select("doc_id", _digest().alias("digest"))


_GROUP = "digest binary, keep_id long, group_size long"


def _batch(index: CuckooIndex) -> pa.RecordBatch:
    rows = list(index.items())
    return pa.record_batch(
        [
            pa.array([k for k, _ in rows], pa.binary()),
            pa.array([v[0] for _, v in rows], pa.int64()),
            pa.array([v[1] for _, v in rows], pa.int64()),
        ],
        names=["digest", "keep_id", "group_size"],
    )


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for key, doc_id in zip(batch.column("digest").to_pylist(), batch.column("doc_id").to_pylist(), strict=True):
            index.add(key, doc_id, 1)
        if index.live >= SHARD_KEYS:
            yield _batch(index)
            index = CuckooIndex()
    yield _batch(index)


def _merge(table: pa.Table) -> pa.Table:
    index = CuckooIndex()
    for key, doc_id, count in zip(*(table.column(c).to_pylist() for c in ("digest", "keep_id", "group_size")), strict=True):
        if count >= 0:
            index.add(key, doc_id, count)
    for key, count in zip(table.column("digest").to_pylist(), table.column("group_size").to_pylist(), strict=True):
        if count < 0:
            index.take(key, -count)
    return pa.Table.from_batches([_batch(index)])


def _sharded(groups: DataFrame, keys: int) -> DataFrame:
    shards = max(64, -(-keys // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards))
    return groups.withColumn("shard", shard).groupBy("shard").applyInArrow(_merge, _GROUP)


def build_index(rows: DataFrame) -> DataFrame:
    """One row per live digest (digest, keep_id, group_size) of rows (doc_id, digest)."""
    return _sharded(rows.mapInArrow(_local, _GROUP), rows.count())


def change_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The index after rows (doc_id, digest) come and go. A group keeps its keep_id until its last row goes;
    a caller that deletes a kept row renews keep_id from the rows that live."""
    change = inserted.mapInArrow(_local, _GROUP)
    gone = deleted.mapInArrow(_local, _GROUP).withColumn("group_size", -F.col("group_size"))
    return _sharded(index.unionByName(change).unionByName(gone), index.count() + inserted.count())


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    rows = stored(digests(docs), "digests")
    groups = build_index(rows)
    joined = rows.join(groups, "digest")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns. Only the rows that are copies go, not others of their doc_id."""
    rows = docs.withColumn("_digest", _digest())
    kept = exact_groups(docs)
    gone = kept.where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.unhex("text_sha256").alias("_gone_digest")).distinct()
    same = rows["doc_id"].cast("long").eqNullSafe(gone["_gone_id"]) & (rows["_digest"] == gone["_gone_digest"])
    return rows.join(gone, same, "left_anti").drop("_digest")

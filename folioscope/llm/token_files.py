"""Token ids in wavelet-matrix shards.

Documents go by doc_id range to partitions; each partition writes shards of about SHARD_TOKENS ids. A shard is one
compressed file in its own format (magic WVM2):

    head            bits of an id, number of ids and of documents, partition, ids of the partition before the shard
    zeros           zeros of each bit-plane
    section ends    of the three kinds of section that follow
    documents       doc_ids and lengths, compressed
    rank directory  ones before every RANK bits of each plane, compressed
    planes          one bit-plane for each bit of an id, in blocks of BLOCK bits, each compressed by itself

From one file a reader gets any id (access), counts of an id in a span (count), the places of an id (select) and all ids
(decode); it opens the directory and those blocks alone that the question touches. Executors can write to shared storage
only through Spark, so files go out as one-row files of Spark's text writer, which appends a line end that readers ignore.

Defined results: null text is an empty document, which has the end id alone. Rows with equal doc_id go by a hash of their
text; null doc_ids come first. An empty table gives no shard and no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, partitions_for, scratch, text_rows
from .tokens import encoder

SHARD_TOKENS = 2_000_000
#: Bytes of text for a partition: at least FEW where there are shuffle partitions enough, at most MANY.
FEW_BYTES, MANY_BYTES = 8_000_000, 256_000_000
RANK = 4096
BLOCK = 1 << 17
_HEAD = struct.Struct("<4sIQQQQ")


class WaveletMatrix:
    """Bit-planes from the highest bit down; below each plane the zeros stand before the ones, in order.

    directory: for each plane the ones before every RANK bits, and all of them."""

    def __init__(self, size: int, zeros: list[int], planes: list[np.ndarray] | None = None, directory: list[np.ndarray] | None = None):
        self.size, self.zeros, self.planes = size, zeros, planes
        self._directory = directory

    @property
    def directory(self) -> list[np.ndarray]:
        if self._directory is None:
            self._directory = [self.ranks(p) for p in self.planes]
        return self._directory

    @staticmethod
    def ranks(plane: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(plane) // (RANK // 8)) * (RANK // 8), np.uint8)
        padded[: len(plane)] = plane
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, RANK // 64).sum(1, dtype=np.int64) if len(padded) else np.zeros(0, np.int64)
        return np.concatenate([[0], np.cumsum(ones)])

    def part(self, level: int, first: int, last: int) -> np.ndarray:
        """The bytes first to last of a plane; they lie in one block."""
        return self.planes[level][first:last]

    def plane(self, level: int) -> np.ndarray:
        return self.planes[level]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, now = [], [], ids
        for bit in range(bits - 1, -1, -1):
            up = (now & now.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(up))
            low = np.compress(~up, now)
            zeros.append(len(low))
            now = np.concatenate([low, np.compress(up, now)])
        return cls(len(ids), zeros, planes)

    def decode(self, kind=np.uint16) -> np.ndarray:
        """All ids: the last plane's order is rebuilt plane by plane towards the first."""
        now = np.zeros(self.size, kind)
        for bit, level in enumerate(reversed(range(len(self.zeros)))):
            zeros = self.zeros[level]
            up = np.unpackbits(self.plane(level), count=self.size).view(bool)
            before = np.empty_like(now)
            before[np.flatnonzero(~up)] = now[:zeros]
            before[np.flatnonzero(up)] = now[zeros:] | kind(1 << bit)
            now = before
        return now

    def _bit(self, level: int, at: int) -> int:
        return int(self.part(level, at >> 3, (at >> 3) + 1)[0]) >> (7 - (at & 7)) & 1

    def _ones(self, level: int, at: int) -> int:
        """Ones among the first `at` bits of a plane."""
        first = at // RANK
        ones = int(self.directory[level][first])
        if at > first * RANK:
            ones += int(np.unpackbits(self.part(level, first * RANK >> 3, (at + 7) >> 3))[: at - first * RANK].sum())
        return ones

    def access(self, at: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level, at)
            bit = self._bit(level, at)
            value = value << 1 | bit
            at = zeros + ones if bit else at - ones
        return value

    def _range(self, token: int, first: int, last: int) -> tuple[int, int]:
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, first), self._ones(level, last)
            if token >> (len(self.zeros) - 1 - level) & 1:
                first, last = zeros + a, zeros + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """How often token is among ids[first:last]."""
        a, b = self._range(token, first, self.size if last is None else last)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0) of token; IndexError beyond the last."""
        a, b = self._range(token, 0, self.size)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(len(self.zeros) - 1, -1, -1):
            if token >> (len(self.zeros) - 1 - level) & 1:
                at = self._nth(level, at - self.zeros[level], True)
            else:
                at = self._nth(level, at, False)
        return at

    def _nth(self, level: int, k: int, one: bool) -> int:
        ones = self.directory[level]
        before = ones if one else np.arange(len(ones)) * RANK - ones
        first = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.part(level, first * RANK >> 3, (first + 1) * RANK >> 3))
        return first * RANK + int(np.flatnonzero(part == one)[k - int(before[first])])


class ShardFile(WaveletMatrix):
    """A shard over the bytes of its file. Sections are decompressed when they are first asked for."""

    def __init__(self, data: bytes | memoryview):
        magic, self.bits, size, self.n_docs, self.part_number, self.before = _HEAD.unpack_from(data)
        if magic != b"WVM2":
            raise ValueError("not a token shard")
        zeros = np.frombuffer(data, "<u8", self.bits, _HEAD.size)
        self.blocks = -(-size // BLOCK)
        table = _HEAD.size + zeros.nbytes
        self.ends = np.frombuffer(data, "<u8", 2 + self.bits * self.blocks, table).astype(np.int64)
        self.data, self.body = memoryview(data), table + self.ends.nbytes
        self.opened: dict[int, bytes] = {}
        super().__init__(size, [int(z) for z in zeros])

    def _section(self, k: int) -> bytes:
        if k not in self.opened:
            first = int(self.ends[k - 1]) if k else 0
            self.opened[k] = zstandard.ZstdDecompressor().decompress(self.data[self.body + first : self.body + int(self.ends[k])])
        return self.opened[k]

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """doc_ids, and ids per document."""
        data, n = self._section(0), self.n_docs
        known, doc_ids = np.frombuffer(data, "u1", n), np.frombuffer(data, "<i8", n, n)
        return [d if k else None for d, k in zip(doc_ids.tolist(), known.tolist(), strict=True)], np.frombuffer(data, "<u4", n, 9 * n)

    @property
    def directory(self) -> list[np.ndarray]:
        if self._directory is None:
            self._directory = list(np.frombuffer(self._section(1), "<u4").astype(np.int64).reshape(self.bits, -1))
        return self._directory

    def part(self, level: int, first: int, last: int) -> np.ndarray:
        block = first // (BLOCK // 8)
        return np.frombuffer(self._section(2 + level * self.blocks + block), np.uint8)[first - block * BLOCK // 8 : last - block * BLOCK // 8]

    def plane(self, level: int) -> np.ndarray:
        return np.frombuffer(b"".join(self._section(2 + level * self.blocks + k) for k in range(self.blocks)), np.uint8)


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int, part: int = 0, before: int = 0) -> bytes:
    """The file of a shard. doc_ids ascend; lengths are ids per document."""
    matrix = WaveletMatrix.build(ids, bits)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    told = known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<u4").tobytes()
    pack = zstandard.ZstdCompressor(level=1).compress
    sections = [pack(told), pack(np.concatenate(matrix.directory).astype("<u4").tobytes())]
    for plane in matrix.planes:
        sections += [pack(plane[at : at + BLOCK // 8].tobytes()) for at in range(0, len(plane), BLOCK // 8)]
    head = _HEAD.pack(b"WVM2", bits, len(ids), len(doc_ids), part, before)
    return b"".join([head, np.array(matrix.zeros, "<u8").tobytes(), np.cumsum([len(x) for x in sections]).astype("<u8").tobytes(), *sections])


def _partitions(rows: DataFrame) -> int:
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, min(partitions_for(rows.sparkSession), -(-size // FEW_BYTES)), -(-size // MANY_BYTES))


def write_token_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> str:
    """Writes the shards of docs as files of a folder, by default a new one in the shared workspace, and names it."""
    spark = docs.sparkSession
    path = path or f"{scratch(spark)}/token-shards-{uuid.uuid4().hex}"
    rows = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    # The hash shares out the rows of a doc_id (null, say) that very many rows have.
    ordered = rows.repartitionByRange(_partitions(rows), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(tokenizer, 500_000), TaskContext.get().partitionId()
        end = np.array([end_id], tool.kind).tobytes()
        bits = max(int(tool.tokenizer.get_vocab_size()), end_id + 1).bit_length()
        done, held, ids, sizes = 0, 0, [], []
        blobs: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal done, held
            payload = shard_bytes(ids, sizes, np.frombuffer(b"".join(blobs), tool.kind), bits, part, done)
            done, held = done + held, 0
            for kept in (ids, sizes, blobs):
                kept.clear()
            return pa.record_batch([pa.array([payload], pa.binary())], names=["payload"])

        for doc_ids, texts in text_rows(batches, 4_000_000):
            for doc_id, found in zip(doc_ids, tool.encode(texts), strict=True):
                blobs.append(found + end)
                ids.append(doc_id)
                sizes.append(len(blobs[-1]) // tool.kind.itemsize)
                held += sizes[-1]
                if held >= SHARD_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    files = ordered.select("doc_id", "text").mapInArrow(encode, "payload binary")
    files.select(F.col("payload").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content: one row a shard file."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.where(F.col("length") > 0).select("path", "content")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, ShardFile]]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            yield path.as_py(), ShardFile(memoryview(content.as_buffer()))


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files. The driver adds up two numbers for each
    partition of the writer, of which there are as many as there are MANY_BYTES of text, or a few."""
    files = shard_files(spark, path)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in _each(batches):
            yield pa.record_batch([pa.array([shard.part_number], pa.int64()), pa.array([shard.size], pa.int64())], names=["part", "n_tokens"])

    starts, total = {}, 0
    for part, size in files.mapInArrow(heads, "part long, n_tokens long").groupBy("part").agg(F.sum("n_tokens")).orderBy("part").collect():
        starts[part] = total
        total += size

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in _each(batches):
            doc_ids, lengths = shard.documents()
            wide = shard.decode(np.uint16 if shard.bits <= 16 else np.uint32).astype("<u4").view(np.uint8)
            ends = np.cumsum(lengths, dtype=np.int64)
            view = memoryview(wide)
            crcs = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            first = starts[shard.part_number] + shard.before
            columns = [pa.array(doc_ids, pa.int64()), pa.array(first + ends - lengths), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64())]
            yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(decode, _READ)


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """path, n: how often token stands in each shard file, by rank on its planes, without decoding the ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, shard in _each(batches):
            yield pa.record_batch([pa.array([name]), pa.array([shard.count(token)], pa.int64())], names=["path", "n"])

    return shard_files(spark, path).mapInArrow(count, "path string, n long")

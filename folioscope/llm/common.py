"""Shared pieces of the corpus operators: shared storage, text scanning and hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words separated by ASCII white space.
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


def workspace(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    spark.checkpoint.dir names it. Where that is unset, a temporary folder serves,
    but only in local mode, where the executors are the driver.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(spark, "_folioscope_folder"):
        spark._folioscope_folder = tempfile.mkdtemp(prefix="folioscope-")
    return spark._folioscope_folder


_SCOPE: ContextVar[str] = ContextVar("scope", default="tables")


def scratch(spark: SparkSession, scope: str | None = None) -> str:
    """The folder for this application's tables of a scope, by default the one that is open."""
    return f"{workspace(spark)}/folioscope-{spark.sparkContext.applicationId}/{scope or _SCOPE.get()}"


@contextmanager
def scoped(scope: str) -> Iterator[None]:
    """Tables that are stored inside belong to the scope and can be discarded together."""
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)


def discard(spark: SparkSession, scope: str) -> None:
    """Deletes the tables of a scope. Nothing that still has to read them may be left."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark, scope))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read again: a cut in the lineage that survives lost executors."""
    path = f"{scratch(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only doc_id and text (null: empty), so that other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def row_key(doc_id, text):
    """128 bits that tell rows apart by doc_id (null is one of its own) and text (null: empty). Rows with one key are
    the same in both, so whatever is found for the key holds for each of them."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))))


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_UPPER)


def lower_column(column):
    """A-Z to a-z and nothing else, in the JVM."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class WordHash(dict):
    """Word to 64-bit hash; forgets its words when there are over `most`, which bounds its memory."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode())
        return value

    def all(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_words(text: bytes) -> list[bytes]:
    """Words of UTF-8 text between ASCII white space, A-Z as a-z: what lower() and split() of bytes do."""
    return text.lower().split()


def text_rows(batches: Iterator[pa.RecordBatch], chars: int = 8_000_000, raw: bool = False) -> Iterator[tuple[list, list]]:
    """(doc_ids, texts) in runs of about so many bytes; one longer text is a run of its own. raw: texts as UTF-8."""
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        if raw:
            texts = pc.cast(texts, pa.binary())
        at, size = 0, 0
        lengths = pc.binary_length(texts).to_pylist()
        for k, n in enumerate(lengths):
            if size and size + n > chars:
                yield ids[at:k], texts.slice(at, k - at).to_pylist()
                at, size = k, 0
            size += n
        if at < len(ids):
            yield ids[at:], texts.slice(at).to_pylist()


def crc_mod(doc_id, mod: int):
    """crc32 of doc_id written as text, modulo mod (the contracts' folds)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(mod))


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

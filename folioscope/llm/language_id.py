"""Language ID by multinomial naive Bayes over hashed character n-grams.

N-grams of one to three characters of the lower-cased text (anything but letters is a blank) fall into BUCKETS buckets.
Training counts buckets per language over a bounded sample: of each language about PER_LANGUAGE documents of the
training folds, chosen by a hash of doc_id. The matrix of log probabilities (languages x BUCKETS) goes to the executors;
a batch is scored as a sparse matrix (bucket numbers and document offsets) times it.

Defined results: null text and text without a letter are `und` with score 0. Without any training label every
document is `und`. Ties go to the language that is first in the alphabet. Rows with the same doc_id, null too, are scored
one by one, and a row's result does not depend on the rows scored with it. Labels are meant to be languages: the model
holds a row of BUCKETS numbers for each distinct lang, and more than MOST_LANGUAGES of them are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, id_and_text, text_rows

BUCKETS = 1 << 15
PER_LANGUAGE = 4000
#: Distinct labels up to which a model is built (64 MB of matrix).
MOST_LANGUAGES = 512
#: Evidence of about so many characters counts in full for the score; more does not make it surer.
SURE_CHARS = 60


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers (three rows, for n = 1, 2, 3), where each text starts, and its count of letters."""
    padded = [f"  {t.lower()} " for t in texts]  # two blanks before the next text: no n-gram holds letters of two texts
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in padded])[:-1]])
    is_letter = _letters()[codes]
    codes = np.where(is_letter, codes, np.uint32(32))
    after = np.append(codes[1:], np.uint32(32))
    third = np.append(after[1:], np.uint32(32))
    one = codes * np.uint32(0x9E3779B1)
    two = (one ^ after) * np.uint32(0x85EBCA6B) + np.uint32(1)
    three = (two ^ third) * np.uint32(0xC2B2AE35) + np.uint32(2)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    return np.stack([one, two, three]) >> shift, starts, np.add.reduceat(is_letter.astype(np.int64), starts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        at = 0
        for ids, texts in text_rows([batch], 2_000_000):
            buckets, starts, _ = grams(texts)
            ends = np.append(starts[1:], buckets.shape[1])
            for k in range(len(ids)):
                counts = totals.setdefault(langs[at + k], np.zeros(BUCKETS, np.int64))
                counts += np.bincount(buckets[:, starts[k] : ends[k]].ravel(), minlength=BUCKETS)
            at += len(ids)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["lang", "bucket", "n"])


def train(docs: DataFrame, folds: int = 4, held: int = 2) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, their log priors, and log probabilities (languages x BUCKETS)."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod(F.col("doc_id"), folds) != held))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct labels: lang does not name languages")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros(0), np.zeros((0, BUCKETS), np.float32)
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, PER_LANGUAGE / sizes[lang]))))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000
    found = labelled.where(chosen).mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(langs), BUCKETS), 0.5)
    row = {lang: k for k, lang in enumerate(langs)}
    np.add.at(counts, ([row[x] for x in found.column("lang").to_pylist()], found.column("bucket").to_numpy()), found.column("n").to_numpy())
    prior = np.log([sizes[lang] for lang in langs]) - np.log(sum(sizes.values()))
    return langs, prior, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def predict(texts: list[str], model: tuple[list[str], np.ndarray, np.ndarray]) -> tuple[list[str], list[float]]:
    langs, prior, weights = model
    if not langs:
        return ["und"] * len(texts), [0.0] * len(texts)
    buckets, starts, letters = grams(texts)
    totals = np.stack([np.add.reduceat(np.take(row, buckets).sum(0, dtype=np.float64), starts) for row in weights], 1)
    best = (totals + prior).argmax(1)
    size = np.maximum(1, np.diff(np.append(starts, buckets.shape[1])))
    tempered = prior + totals * np.minimum(1, SURE_CHARS / size)[:, None]
    tempered = np.exp(tempered - tempered.max(1, keepdims=True))
    scores = tempered[np.arange(len(texts)), best] / tempered.sum(1)
    return [langs[b] if n else "und" for b, n in zip(best, letters, strict=True)], np.where(letters > 0, scores, 0.0).tolist()


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    model = train(docs, folds, held)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches, 2_000_000):
            langs, scores = predict(texts, model)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    found = id_and_text(docs).mapInArrow(score, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score")

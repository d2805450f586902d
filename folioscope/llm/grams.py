"""Words and word k-gram hashes as array columns, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import lower_column

#: A run of digits, letters a-z and characters beyond ASCII (fixed value).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(lower_column(text), F.lit(WORD), F.lit(0))


def gram_hashes(words: Column, k: int) -> Column:
    """Hashes of the k-grams starting at each word; empty if there are fewer than k words."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(F.lit(k), *(F.get(words, i + j) for j in range(k))))
    return F.when(F.size(words) >= k, each).otherwise(F.array().cast("array<bigint>"))


def window_minima(hashes: Column, width: int) -> Column:
    """Winnowing: the distinct minima of all `width` consecutive hashes; empty if there are fewer."""
    each = F.transform(F.sequence(F.lit(0), F.size(hashes) - width), lambda i: F.least(*(F.get(hashes, i + j) for j in range(width))))
    return F.when(F.size(hashes) >= width, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))

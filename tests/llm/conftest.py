from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made_texts(count: int = 60, seed: int = 5) -> list[tuple]:
    """Prose of invented words with copies, near copies, symbols, and odd cases: null, empty, blank, one very long."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeilnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows: list[tuple] = []
    for k in range(count):
        rows.append((k, " ".join(rng.choice(words) for _ in range(rng.randint(3, 120))).capitalize() + ".", ("en", "fr")[k % 2], "s0", 1))
    for k in range(10):
        rows.append((100 + k, rows[k][1].replace(" ", "  \n"), "en", "s0", 1))  # equal but for white space
        base = rows[20 + k][1].split(" ")
        base[len(base) // 2] = "other"
        rows.append((200 + k, " ".join(base), "en", "s0", 1))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0), (302, " \n\t", "en", "s", 3), (303, "a b c", "en", "s", 5), (304, "a b c", "fr", "s", 5), (305, "é🙂 ﬁ Ünï ŵ", "fr", "s", 9)]
    rows.append((306, "long " * 20_000 + "end", "en", "s", 100_003))
    rows += [(307, rows[0][1], "en", "s", 1), (307, rows[0][1], "en", "s", 1)]  # a repeated row
    return rows


@pytest.fixture(scope="session")
def rows():
    return made_texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The made texts with further columns whose names the operators use inside."""
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("words", "hash", "rep", "block", "word", "n", "key", "component", "digest", "held_out", "score", "spans", "ids"):
        frame = frame.withColumn(name, F.lit(1))
    return frame


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

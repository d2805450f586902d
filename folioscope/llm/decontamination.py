"""Benchmark decontamination by winnowing, with DataFrame functions only.

Of every GRAM-word hash the smallest in each run of WINDOW - GRAM + 1 is a fingerprint, in documents and items alike.
Ten shared words hold the same hashes on both sides and so the same fingerprint: no shared window is missed. Texts are
split once and their fingerprints stored; only texts that share a fingerprint are read again. Every place of it is
extended to the item's window around it and compared word by word. An item of fewer than ten words is one window of its
own length, for which documents give all k-grams of that length.

Defined results: one row for each row of the documents. Rows are told apart by doc_id and text (row_key), so null and
repeated doc_ids are judged text by text. Null text has no words. Items with null item_id or no word are left out.
Repeated items count once. Tied fingerprints are one fingerprint, and every place of it is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, row_key, stored
from .grams import gram_hashes, window_minima, word_array

WINDOW = 10
GRAM = 5
#: Measured bytes up to which a side is broadcast; beyond, the joins shuffle.
BROADCAST_BYTES = 32_000_000


def _minimum_at(hashes: Column, start: Column) -> Column:
    return F.array_min(F.slice(hashes, start + 1, WINDOW - GRAM + 1))


def item_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """window_id, size, hash, lead (words of the window before the fingerprint), window (words); and window_id, item_id."""
    words = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), word_array(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0)
    long = words.where(F.size("words") >= WINDOW).withColumn("hashes", gram_hashes(F.col("words"), GRAM))
    placed = long.select("item_id", "words", "hashes", F.explode(F.sequence(F.lit(0), F.size("words") - WINDOW)).alias("start"))
    placed = placed.withColumn("hash", _minimum_at(F.col("hashes"), F.col("start")))
    lead = F.array_position(F.slice("hashes", F.col("start") + 1, WINDOW - GRAM + 1), F.col("hash")) - 1
    full = placed.select("item_id", F.lit(WINDOW).alias("size"), "hash", lead.cast("int").alias("lead"), F.slice("words", F.col("start") + 1, WINDOW).alias("window"))
    for size in range(1, WINDOW):
        short = words.where(F.size("words") == size)
        full = full.unionByName(short.select("item_id", F.lit(size).alias("size"), F.get(gram_hashes(F.col("words"), size), F.lit(0)).alias("hash"), F.lit(0).alias("lead"), F.col("words").alias("window")))
    full = stored(full.withColumn("window_id", F.unhex(F.md5(F.array_join("window", " ")))), "item-windows")
    return full.select("window_id", "size", "hash", "lead", "window").distinct(), full.select("window_id", "item_id").distinct()


def _small(side: DataFrame, size: int) -> DataFrame:
    """side for a broadcast if its measured bytes allow that; beyond, Spark joins by shuffle."""
    return F.broadcast(side) if size <= BROADCAST_BYTES else side


def _bytes(df: DataFrame, each) -> int:
    return df.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated for every row."""
    rows = id_and_text(docs).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    windows, members = item_windows(items)
    windows = stored(windows, "windows")
    size = _bytes(windows, F.length(F.array_join("window", " ")) + 64)
    short = sorted(r[0] for r in windows.select("size").where(F.col("size") < WINDOW).distinct().collect())  # nine at most

    words = rows.select("doc_id", "row_key", word_array(F.col("text")).alias("words"))
    hashed = words.select("doc_id", "row_key", F.size("words").cast("long").alias("n_words"), gram_hashes(F.col("words"), GRAM).alias("hashes"), *(gram_hashes(F.col("words"), k).alias(f"short{k}") for k in short))
    marks = F.concat(window_minima(F.col("hashes"), WINDOW - GRAM + 1), *(F.array_distinct(f"short{k}") for k in short))
    marked = stored(hashed.select("doc_id", "row_key", "n_words", marks.alias("marks")), "fingerprints")
    shared = marked.select("row_key", F.explode("marks").alias("hash")).join(_small(windows.select("hash").distinct(), size), "hash", "left_semi")
    shared = stored(shared.groupBy("row_key").agg(F.collect_set("hash").alias("shared")), "shared")

    again = rows.join(_small(shared, _bytes(shared, F.size("shared") * 8 + 64)), "row_key").select("row_key", "shared", word_array(F.col("text")).alias("words"))
    placed = again.select("row_key", "words", F.explode(_places(F.col("words"), F.col("shared"), short)).alias("p"))
    met = placed.select("row_key", "p.*").join(_small(windows, size), ["size", "hash"])
    start = F.col("at") - F.col("lead")
    real = (start >= F.col("from")) & (F.slice("around", F.greatest(start - F.col("from"), F.lit(0)) + 1, F.col("size")) == F.col("window"))
    met = stored(met.where(real).select("row_key", "window_id", start.alias("first"), (start + F.col("size") - 1).alias("last")).distinct(), "hits")
    hit = F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))).cast("long")
    spans = met.groupBy("row_key").agg(hit.alias("n_hit"))
    named = met.select("row_key", "window_id").distinct().join(members, "window_id").groupBy("row_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = marked.select("doc_id", "row_key", "n_words").join(spans.join(named, "row_key"), "row_key", "left")
    none = F.array().cast("array<string>")
    found = found.select("doc_id", "row_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))
    return found.select("doc_id", "row_key", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids", (F.col("n_hit") > 0).alias("contaminated"))


def _places(words: Column, shared: Column, short: list[int]) -> Column:
    """Where the shared fingerprints stand: structs of at, size, hash, and the words around (from which place on)."""
    def placed(size: int, k: int) -> Column:
        each = F.transform(gram_hashes(words, k), lambda h, i: F.struct(i.alias("at"), h.alias("hash")))
        kept = F.filter(each, lambda p: F.array_contains(shared, p["hash"]))
        first = lambda p: F.greatest(p["at"] - GRAM, F.lit(0))
        return F.transform(kept, lambda p: F.struct(p["at"], F.lit(size).alias("size"), p["hash"], first(p).alias("from"), F.slice(words, first(p) + 1, WINDOW + GRAM).alias("around")))

    return F.concat(placed(WINDOW, GRAM), *(placed(k, k) for k in short))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs without a hit, with all their columns. Each row goes by its own text, whatever its doc_id."""
    bad = contamination(docs, items).where("contaminated").select(F.col("row_key").alias("_hit_key")).distinct()
    return docs.join(bad, row_key(docs["doc_id"].cast("long"), docs["text"]) == bad["_hit_key"], "left_anti")

"""MinHash near-dedup with tensored banding.

Two collections of COLLECTION small hashes (each of two minhashes) are computed per text. Table (i, j) is keyed by hash i
of the first collection and hash j of the second, so 32 minhashes make 64 tables of four. Only hashes that at least two
texts share can make a shared table key, so the rest is dropped before the pairs are formed.

Candidates are confirmed on full shingle sets without forming all pairs of a bucket:
1. a bucket's pivot is its first class by doc_id; each text is compared with the pivot that most of its buckets have,
   which is likely the most similar, and then in buckets that still hold several components likewise with the last;
2. texts of buckets that still hold several components are joined by an exact prefix filter (shingles by document
   frequency, rarest first, with length and position bounds), across components only. It loses no link among them. The
   join's key is a shingle and a band of set sizes, so that a frequent shingle falls into many keys.

Equal sets are one class, named by a hash of the set (rep), from the start, so copies never form pairs. A pair meets in a
table with probability 0.9999 at similarity 0.85 and 0.9994 at 0.80.

Defined results: null or blank text has n_shingles 0 and is linked with nothing. Rows with null doc_id keep
component_id null and stay. Rows with equal doc_id and text share one result; different texts under one doc_id are linked
each by its own set. Of tied representatives the smallest doc_id stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, WordHash, ascii_lower, id_and_text, mixed, stored, text_rows

SHINGLE = 5
COLLECTION = 8
#: Similarity from which two sets are linked, in percent; callers may ask for another.
PERCENT = 80
_HASHES = 4 * COLLECTION
_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 64, _HASHES, np.uint64)[:, None]
_ODD = _rng.integers(0, 1 << 64, _HASHES, np.uint64)[:, None] | np.uint64(1)


def shingles(words: list[str], known: WordHash) -> np.ndarray:
    """Distinct 64-bit hashes of the 5-word shingles, sorted; the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = known.all(words)
    width = min(SHINGLE, n)
    rolled = hashes[: n - width + 1] + np.uint64(width)
    for j in range(1, width):
        rolled = mixed(rolled) + hashes[j : n - width + 1 + j]
    return np.unique(mixed(rolled))


def minhashes(distinct: np.ndarray) -> np.ndarray:
    best = None
    for at in range(0, len(distinct), 16_384):
        values = (distinct[None, at : at + 16_384] ^ _XOR) * _ODD
        values ^= values >> np.uint64(32)
        least = values.min(1)
        best = least if best is None else np.minimum(best, least)
    return best


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, pa.Array]]:
    """What text_rows gives, with the marks of the same rows."""
    for batch in batches:
        at = 0
        for ids, texts in text_rows([batch]):
            yield ids, texts, batch.column("mark").slice(at, len(ids))
            at += len(ids)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHash()
    none = np.zeros(0, np.uint64)
    for ids, texts, marks in _marked(batches):
        sizes, keys, first, second = [], [], [], []
        for text in texts:
            distinct = shingles(SPACED.findall(ascii_lower(text)), known)
            sizes.append(len(distinct))
            keys.append(xxhash.xxh3_128_digest(distinct.tobytes()))
            if len(distinct):
                least = minhashes(distinct)
                pairs = mixed(mixed(least[0::2]) + least[1::2])
                first.append(pairs[:COLLECTION])
                second.append(pairs[COLLECTION:])
            else:
                first.append(none)
                second.append(none)
        yield pa.record_batch([pa.array(ids, pa.int64()), marks, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(first), _lists(second)], names=["doc_id", "mark", "n_shingles", "set_key", "first", "second"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHash()
    for ids, texts in text_rows(batches, 2_000_000):
        rows = [shingles(SPACED.findall(ascii_lower(text)), known) for text in texts]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([xxhash.xxh3_128_digest(r.tobytes()) for r in rows], pa.binary()), _lists(rows)], names=["doc_id", "set_key", "shingles"])


def _mark(text: str) -> Column:
    """Digest of a text, which tells rows with the same doc_id apart."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def sketches(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("mark", _mark("text")).mapInArrow(_sketch, "doc_id long, mark binary, n_shingles long, set_key binary, first array<long>, second array<long>")


def _shared_cells(classes: DataFrame, column: str) -> DataFrame:
    """rep, first_id, table, cell of the hashes that at least two classes have."""
    cells = classes.select("rep", "first_id", F.posexplode(column).alias("table", "cell"))
    shared = cells.groupBy("table", "cell").count().where("count > 1").select("table", "cell")
    return cells.join(shared, ["table", "cell"], "left_semi")


def bucket_members(classes: DataFrame) -> DataFrame:
    """key, rep, low, high: every bucket with at least two classes, with the reps of its first and its last class by
    doc_id: an original that copies were made from most often comes before them or after them."""
    first = _shared_cells(classes, "first").select("rep", "first_id", F.col("table").alias("i"), F.col("cell").alias("a"))
    second = _shared_cells(classes, "second").select("rep", F.col("table").alias("j"), F.col("cell").alias("b"))
    keyed = first.join(second, "rep").select("rep", "first_id", F.xxhash64("i", "a", "j", "b").alias("key"))
    keyed = stored(keyed, "buckets")
    place = F.struct("first_id", "rep")
    ends = keyed.groupBy("key").agg(F.min(place)["rep"].alias("low"), F.max(place)["rep"].alias("high")).where("low <> high")
    return stored(keyed.drop("first_id").join(ends, "key"), "bucket-members")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose sets are alike enough. A hot side is split by the adaptive skew join."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right_set"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left_set", "right_set"))
    sizes = F.size("left_set") + F.size("right_set")
    return both.where(_possible(F.size("left_set"), F.size("right_set"), percent)).where(common * 100 >= percent * (sizes - common)).select("a", "b")


def _possible(n: Column, m: Column, percent: int) -> Column:
    """Sizes whose sets can be alike enough."""
    return F.least(n, m) * 100 >= percent * F.greatest(n, m)


def components(edges: DataFrame) -> DataFrame:
    """rep, component (smallest rep reachable) for every rep with an edge (a, b).

    Each round points every rep to its smallest neighbour, follows pointers twice and contracts the edges.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    total = None
    while edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("least")).select("rep", F.least("rep", "least").alias("parent")), "parents")
        for _ in range(2):
            up = parent.select(F.col("rep").alias("parent"), F.col("parent").alias("up"))
            parent = parent.join(up, "parent", "left").select("rep", F.coalesce("up", "parent").alias("parent"))
        parent = stored(parent, "parents")
        if total is None:
            total = parent.withColumnRenamed("parent", "component")
        else:
            step = parent.select(F.col("rep").alias("component"), "parent")
            total = stored(total.join(step, "component", "left").select("rep", F.coalesce("parent", "component").alias("component")), "components")
        at_a = parent.select(F.col("rep").alias("a"), F.col("parent").alias("pa"))
        at_b = parent.select(F.col("rep").alias("b"), F.col("parent").alias("pb"))
        edges = stored(edges.join(at_a, "a").join(at_b, "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
    return edges.select(F.col("a").alias("rep"), F.col("b").alias("component")) if total is None else total


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """found (rep, component) after more links (a, b): only the components that the links join are walked again."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(found.select(F.col("rep").alias(end), F.col("component").alias(f"{end}_in")), end, "left").withColumn(end, F.coalesce(f"{end}_in", end)).drop(f"{end}_in")
    step = components(ends)
    onward = step.select(F.col("rep").alias("component"), F.col("component").alias("onward"))
    moved = found.join(onward, "component", "left").select("rep", F.coalesce("onward", "component").alias("component"))
    return stored(moved.unionByName(step.join(found.select("rep"), "rep", "left_anti")), "components")


def _unresolved(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, with their component."""
    now = members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed_keys = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    return now.join(mixed_keys, "key", "left_semi")


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components that can be alike enough, from sets (rep, component, shingles).

    Position p in a set sorted by document frequency: two sets whose first common shingle stands at p and q share at
    most min(n - p, m - q) shingles. Shingles that one set alone has come first and make no rows.
    """
    token = sets.select("rep", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    frequent = token.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = token.join(frequent, "shingle").groupBy("rep", "component", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("order"))
    alone = F.col("n") - F.size("order")
    prefix = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1
    head = known.withColumn("alone", alone).where(alone < prefix).select("rep", "component", "n", "alone", F.posexplode(F.slice("order", F.lit(1), prefix - alone)).alias("k", "entry"))
    head = head.select("rep", "component", F.col("n"), (F.col("n") - F.col("alone") - F.col("k")).alias("rest"), F.col("entry.shingle").alias("shingle"))
    band = F.floor(F.log(F.col("n") + 0.0) / math.log(100 / percent)).cast("int")  # alike sets are in one or in neighbouring bands
    head = head.withColumn("band", band)
    x = head.select("shingle", "band", F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("rest").alias("ra"))
    y = head.select("shingle", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), F.col("rep").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("rest").alias("rb"))
    bound = F.least("ra", "rb") * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    near = x.join(y, ["shingle", "band"]).where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & bound & _possible(F.col("na"), F.col("nb"), percent))
    return near.select("a", "b").distinct()


def near_components(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The stored sketches, and set_key to component of every class of equal sets."""
    sketch = stored(sketches(docs), "sketches")
    named = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(named.groupBy("set_key").agg(F.xxhash64("set_key").alias("rep"), F.min("doc_id").alias("first_id"), F.first("first").alias("first"), F.first("second").alias("second")), "classes")
    members = bucket_members(classes)

    wanted = members.select("rep").distinct().join(classes.select("rep", "set_key", F.col("first_id").alias("doc_id")), "rep")
    texts = id_and_text(docs).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    full = texts.mapInArrow(_sets, "doc_id long, set_key binary, shingles array<long>")
    sets = stored(full.join(wanted, ["doc_id", "set_key"]).dropDuplicates(["rep"]).select("rep", "shingles"), "sets")

    star = members.where("rep <> low").groupBy(F.col("rep").alias("a")).agg(F.mode("low", True).alias("b"))
    found = components(confirmed(star, sets, percent))
    open_ = _unresolved(members, found)
    star = open_.where("rep <> high").groupBy(F.col("rep").alias("a")).agg(F.mode("high", True).alias("b"))
    found = extended(found, confirmed(star, sets, percent))
    open_ = stored(_unresolved(members, found).select("rep", "component").distinct(), "open")
    pairs = stored(prefix_pairs(sets.join(open_, "rep"), percent), "prefix-pairs")
    found = extended(found, confirmed(pairs, sets, percent))
    mapped = classes.select("set_key", "rep", "first_id").join(found, "rep", "left").withColumn("node", F.coalesce("component", "rep"))
    least = mapped.groupBy("node").agg(F.min("first_id").alias("least"))
    mapped = mapped.join(least, "node").select("set_key", F.col("least").alias("component"))
    return sketch, mapped


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, mark, n_shingles, component_id, kept for every row."""
    sketch, mapped = near_components(docs, percent)
    joined = sketch.select("doc_id", "mark", "n_shingles", "set_key").join(mapped, "set_key", "left")
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    out = joined.select("doc_id", "mark", "n_shingles", linked.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return _grouped(docs, percent).drop("mark")


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay, with all their columns. Only the rows that are copies go, not others of their doc_id."""
    rows = docs.withColumn("_mark", _mark("text"))
    gone = _grouped(docs, percent).where("NOT kept").select(F.col("doc_id").alias("_gone_id"), F.col("mark").alias("_gone_mark")).distinct()
    return rows.join(gone, (rows["doc_id"].cast("long") == gone["_gone_id"]) & (rows["_mark"] == gone["_gone_mark"]), "left_anti").drop("_mark")

"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut into full pieces and a rest; nothing else is cut. The pieces are dealt to regions
of about REGION_PIECES, and several islands, each a Spark row of its own, evolve packings of one region. An individual is
a list of bins. Crossover injects whole well-filled bins of one parent into the other; bins of the other that would repeat
a piece are dissolved, as are its worse-filled ones, and the displaced pieces go, the longer about first, each to the bin
with the least room that takes it. Fewer bins win, then the more uneven fill. After every epoch of generations an island's
elites are stored and its best one migrates to the next island of the region. A region that has no more bins than the sum
of its lengths asks for evolves no further.

A region's well-filled bins are final. Pieces of the others go on to the next level, where they form fewer regions. What
counts as well filled is relaxed from level to level, until nothing is left over.

Defined results: null text is an empty document (the end id alone). A null doc_id is packed like any other, and rows that
repeat a doc_id are dealt by their place in the table, so no region fills up with them. Repeated rows are packed as often
as they come; pieces tied in length are interchangeable.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, partitions_for, stored, text_rows
from .tokens import encoder

REGION_PIECES = 3000
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 25
POPULATION = 6
ELITES = 2
#: A bin with at most this share free is final, at each level; at the last level every bin is.
SLACK = (0.004, 0.016, 0.064, 0.25, 1.0)
#: Rows of islands in one task.
ISLANDS_PER_TASK = 32

Bin = tuple[int, list[int]]  # what is free, and the pieces


def best_fit(bins: Sequence[Bin], pieces: Sequence[int], length: Sequence[int], size: int) -> list[Bin]:
    """Puts pieces in their order each into the bin with the least room that takes it. The given bins stay as they are."""
    out = list(bins)
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has exactly r free
    for k, (free, _) in enumerate(out):
        if free:
            by_room.setdefault(free, []).append(k)
            rooms |= 1 << free
    own: set[int] = set()  # bins whose list is not shared with another individual
    for piece in pieces:
        need = length[piece]
        above = rooms >> need
        if above:
            room = need + (above & -above).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            held = out[k][1] if k in own else list(out[k][1])
            held.append(piece)
        else:
            room, k, held = size, len(out), [piece]
            out.append((size, held))
        own.add(k)
        left = room - need
        out[k] = (left, held)
        if left:
            by_room.setdefault(left, []).append(k)
            rooms |= 1 << left
    return out


def cost(bins: Sequence[Bin], size: int) -> tuple[int, int]:
    """The lower the better: bins, then evenness of fill (room gathered in few bins can be used)."""
    return len(bins), -sum((size - free) ** 2 for free, _ in bins)


def falling(pieces: Sequence[int], length: Sequence[int], rng: random.Random, shake: float) -> list[int]:
    """The longest first, with lengths taken up to a share `shake` too large."""
    if not shake:
        return sorted(pieces, key=length.__getitem__, reverse=True)
    return sorted(pieces, key=lambda p: length[p] * (1 + shake * rng.random()), reverse=True)


def crossover(base: Sequence[Bin], donor: Sequence[Bin], rng: random.Random, length: Sequence[int], size: int) -> list[Bin]:
    bound = rng.choice((0, 0, 1, 2)) * size // 2048
    well = [b for b in donor if b[0] <= bound] or sorted(donor, key=lambda b: b[0])[: max(1, len(donor) // 3)]
    share = rng.random()
    kept = [b for b in well if rng.random() < share]
    inside = {p for _, held in kept for p in held}
    dissolved = rng.choice((0, 1, 2, 4, 2048)) * size // 2048
    displaced: list[int] = []
    for free, held in base:
        if not inside.isdisjoint(held):
            displaced += [p for p in held if p not in inside]
        elif free > dissolved or rng.random() < 0.02:
            displaced += held
        else:
            kept.append((free, held))
    return best_fit(kept, falling(displaced, length, rng, rng.choice((0.0, 0.05, 0.2, 0.5))), length, size)


def evolve(length: Sequence[int], size: int, seed: int, elites: Sequence[list[Bin]] = (), generations: int = GENERATIONS) -> list[list[Bin]]:
    """One epoch of an island: individuals, the best first, that pack pieces 0..n-1 of these lengths. It begins with
    elites; without them with best fit, longest first, and shaken forms of it."""
    rng = random.Random(seed)
    least = -(-sum(length) // size)
    group = list(elites) or [best_fit([], falling(range(len(length)), length, rng, 0.0), length, size)]
    key = lambda bins: cost(bins, size)
    while len(group) < POPULATION and min(map(len, group)) > least:
        group.append(best_fit([], falling(range(len(length)), length, rng, 0.3), length, size))
    group.sort(key=key)
    for _ in range(generations):
        if len(group[0]) <= least:
            break
        base, donor = rng.sample(range(len(group)), 2)
        group.append(crossover(group[base], group[donor], rng, length, size))
        group.sort(key=key)
        del group[POPULATION:]
    return group


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, with_ids: bool = True, words: int = 750_000) -> DataFrame:
    """Pieces of every document: place, length, crc32 of the ids as little-endian 32-bit integers, and the ids so."""
    rows = id_and_text(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, words)
        end = np.array([end_id], tool.kind).tobytes()
        for doc_ids, texts in text_rows(batches, 4_000_000):
            columns: list[list] = [[] for _ in range(6)]
            for doc_id, found in zip(doc_ids, tool.encode(texts), strict=True):
                wide = np.frombuffer(found + end, tool.kind).astype("<u4").tobytes()
                for k, at in enumerate(range(0, len(wide), 4 * size)):
                    part = wide[at : at + 4 * size]
                    for column, value in zip(columns, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    pieces = rows.mapInArrow(cut, _PIECE)
    return pieces if with_ids else pieces.drop("ids")


def _numbers(bins: Sequence[Bin], count: int) -> bytes:
    """An individual as the bin number of every piece."""
    out = np.empty(count, "<u4")
    for number, (_, held) in enumerate(bins):
        out[held] = number
    return out.tobytes()


def _bins(numbers: bytes, length: Sequence[int], size: int) -> list[Bin]:
    at = np.frombuffer(numbers, "<u4")
    order = np.argsort(at, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(at) else []
    return [(size - sum(length[p] for p in held), held) for held in (part.tolist() for part in parts)]


def _in_order(table: pa.Table) -> pa.Table:
    """A region's pieces, the longest first; pieces tied in all of these are alike."""
    return table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])


def _lengths(table: pa.Table) -> pa.Table:
    length = np.array(_in_order(table).column("length"), "<u4")
    return pa.table({"region": table.column("region").slice(0, 1), "lengths": pa.array([length.tobytes()], pa.binary())})


_STATE = "region long, island int, lengths binary, elites array<binary>, bins int, cost long, least int"


def _epoch(size: int, seed: int):
    """One epoch of every island. Elites come in and go out as bin numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                length = np.frombuffer(row["lengths"], "<u4").tolist()
                group = evolve(length, size, seed * 1_000_003 + row["region"] * 101 + row["island"], [_bins(e, length, size) for e in row["elites"]])
                bins, squares = cost(group[0], size)
                row |= {"elites": [_numbers(x, len(length)) for x in group[:ELITES]], "bins": bins, "cost": squares, "least": -(-sum(length) // size)}
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int32(), pa.int64(), pa.int32()]
                names = [c.split(" ")[0] for c in _STATE.split(", ")]
                yield pa.record_batch([pa.array([row[c]], k) for c, k in zip(names, kinds, strict=True)], names=names)

    return run


def evolved(dealt: DataFrame, regions: int, size: int, level: int) -> DataFrame:
    """region and the best individual of its islands (bin numbers of the pieces shorter than a sequence, in order)."""
    lengths = dealt.where(F.col("length") < size).select("region", "length", "ids_crc32", "doc_id", "piece").groupBy("region").applyInArrow(_lengths, "region long, lengths binary")
    rows = regions * ISLANDS
    tasks = max(min(rows, partitions_for(dealt.sparkSession)), -(-rows // ISLANDS_PER_TASK))
    state = lengths.select("region", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths", F.array().cast("array<binary>").alias("elites"))
    for epoch in range(EPOCHS):
        spread = state.select("region", "island", "lengths", "elites").repartition(tasks, "region", "island")
        state = stored(spread.mapInArrow(_epoch(size, level * EPOCHS + epoch), _STATE), "islands")
        if epoch == EPOCHS - 1 or state.where("bins > least").limit(1).count() == 0:
            break
        guests = state.select("region", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elites")[0].alias("guest"))
        state = state.join(guests, ["region", "island"]).withColumn("elites", F.concat("elites", F.array("guest")))
    return state.groupBy("region").agg(F.min_by(F.col("elites")[0], F.struct("bins", "cost", "island")).alias("best"))


def _placed(size: int, level: int, last: bool):
    """Sequences and offsets of a region's pieces. sequence_id is null where a piece goes on to the next level."""

    def place(key: tuple, table: pa.Table, best: pa.Table) -> pa.Table:
        table = _in_order(table)
        length = table.column("length").to_pylist()
        whole = sum(1 for n in length if n == size)  # sorted: full pieces come first, each is a bin
        bins = [(0, [k]) for k in range(whole)]
        if best.num_rows:
            bins += [(free, [whole + p for p in held]) for free, held in _bins(best.column("best")[0].as_py(), length[whole:], size)]
        sequence: list[int | None] = [None] * len(length)
        offset: list[int | None] = [None] * len(length)
        for number, (free, held) in enumerate(bins):
            if not last and free > SLACK[level] * size:
                continue
            at = 0
            for piece in held:
                sequence[piece], offset[piece] = level << 58 | key[0].as_py() << 24 | number, at
                at += length[piece]
        plain = table.drop_columns(["region"])
        return plain.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return place


def pack_pieces(pieces: DataFrame, size: int, region_pieces: int = REGION_PIECES) -> DataFrame:
    """pieces (stored; with doc_id, piece, length, ids_crc32 and any more) with sequence_id and offset."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    done, left = None, pieces
    for level in range(len(SLACK)):
        count = left.count()
        if level and not count:
            break
        regions = -(-max(1, count) // region_pieces)
        last = regions == 1 or level == len(SLACK) - 1
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(regions))
        dealt = stored(left.withColumn("region", place), "dealt")
        best = evolved(dealt, regions, size, level)
        packed = stored(dealt.groupBy("region").cogroup(best.groupBy("region")).applyInArrow(_placed(size, level, last), schema), "packed")
        final = packed.where(F.col("sequence_id").isNotNull())
        done = final if done is None else done.unionByName(final)
        if last:
            break
        left = packed.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
    return done


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int, with_ids: bool = True, words: int = 750_000) -> DataFrame:
    """Cuts and packs. words: how many words a worker's encoder remembers, which bounds its memory."""
    return pack_pieces(stored(cut_pieces(docs, tokenizer, end_id, size, with_ids, words), "pieces"), size)

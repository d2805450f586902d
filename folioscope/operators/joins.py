"""Join and argmax helpers that keep an equi-key, so that no plan degenerates to a Cartesian product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.geometry import Box, box


def prefixed(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Every column but the keys gets the prefix."""
    return df.select(*keys, *(F.col(c).alias(prefix + c) for c in df.columns if c not in keys))


def page_join(left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column, how: str = "inner") -> DataFrame:
    """Joins on the page keys and a range condition. Columns other than the keys must differ."""
    renamed = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = condition
    for k in keys:
        on = on & (left[k] == renamed[f"_{k}"])
    joined = left.join(renamed, on, how)
    return joined.drop(*(f"_{k}" for k in keys)) if how not in ("left_semi", "left_anti") else joined


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], a: Box, b: Box, condition: Column, cell: int = 250) -> DataFrame:
    """Like page_join for pages with very many boxes: right boxes are listed in every grid cell that they touch and
    left boxes in that of their centre, so only neighbours meet. The condition must imply that a's centre is in b."""
    spot = left.withColumn("_gx", F.floor(a.cx / cell)).withColumn("_gy", F.floor(a.cy / cell))
    wide = right.withColumn("_gx", F.explode(F.sequence(F.floor(b.x / cell), F.floor(b.right / cell))))
    wide = wide.withColumn("_gy", F.explode(F.sequence(F.floor(b.y / cell), F.floor(b.bottom / cell))))
    return page_join(spot, wide, [*keys, "_gx", "_gy"], condition).drop("_gx", "_gy")


def pieces(df: DataFrame, size: int = 16 << 20) -> int | None:
    """How many partitions give a task about size bytes of the files that df reads; None where that is unknown.

    Rows of positions shrink to a few bytes in a shuffle, so partitions that Spark merges by those bytes hold more rows
    with every file, and a task's sorts grow to gigabytes."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    each = (leaves.apply(k) for k in range(leaves.size()))
    found = {leaf.canonicalized().hashCode(): int(leaf.stats().sizeInBytes()) for leaf in each}
    if (total := sum(found.values())) >= 1 << 60:
        return None
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // size))


def dealt(df: DataFrame, keys: Sequence[str], n: int | None) -> DataFrame:
    """df in n partitions by keys, or as it is for None."""
    return df.repartition(n, *keys) if n else df


def best(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """For each key the values of the row that comes first in order. One partial aggregation, no sort; order must end
    in a unique sequence number, which makes ties definite."""
    ranks = F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)))
    pick = df.groupBy(*keys).agg(F.min(F.struct(ranks.alias("rank"), F.struct(*values).alias("value"))).alias("_best"))
    return pick.select(*keys, *(F.col(f"_best.value.{v}").alias(v) for v in values))


def only(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """For each key its values if exactly one row has it; keys with several rows are declined."""
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *(F.min(v).alias(v) for v in values))
    return one.where("_n = 1").drop("_n")


__all__ = ["Box", "best", "box", "dealt", "grid_join", "only", "page_join", "pieces", "prefixed"]

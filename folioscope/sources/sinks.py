"""Sinks: page collections, manifests and diagnostics. A run's folder is written once and never overwritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pages(blocks: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row a page with its blocks as one array in order; the only place where a page becomes one value."""
    body = F.struct(order, *(c for c in blocks.columns if c not in (*keys, order)))
    return blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(body)).alias("blocks"))


def write_run(df: DataFrame, folder: str, by: Sequence[str] = ("page",)) -> None:
    """Parquet partitioned by page columns; fails if the folder exists."""
    df.write.mode("errorifexists").partitionBy(*by).parquet(folder)


def write_json(df: DataFrame, folder: str) -> None:
    df.write.mode("errorifexists").json(folder)


def page_receipts(pages_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, sha256 of the page's JSON, and its number of blocks: what a manifest lists."""
    return pages_.select(*keys, F.sha2(F.to_json(F.struct("blocks")), 256).alias("sha256"), F.size("blocks").alias("blocks"))


def manifest(receipts: DataFrame, document: str, warnings: DataFrame | None = None) -> DataFrame:
    """One row a document: pages, blocks, the hash over its pages' hashes in order, and whether it is complete."""
    order = F.array_sort(F.collect_list(F.struct("page", "sha256")))
    found = receipts.groupBy(document).agg(F.count(F.lit(1)).alias("pages"), F.sum("blocks").alias("blocks"), F.sha2(F.array_join(F.transform(order, lambda p: p["sha256"]), ""), 256).alias("sha256"))
    if warnings is None:
        return found.withColumn("status", F.lit("complete"))
    bad = warnings.select(document).distinct().withColumn("_w", F.lit(True))
    return found.join(bad, document, "left").withColumn("status", F.when(F.col("_w"), "needs_review").otherwise("complete")).drop("_w")


def verified(receipts: DataFrame, pages_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys of pages whose content differs from the receipt, or that only one side has."""
    now = page_receipts(pages_, keys).select(*keys, F.col("sha256").alias("_now"))
    return receipts.join(now, list(keys), "full_outer").where(~F.col("sha256").eqNullSafe(F.col("_now"))).select(*keys)

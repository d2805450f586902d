"""Proposals as JSON: parsing, validation into rows and rejects, verified reuse, page specs and tile merging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.geometry import box, overlap_of_smaller

SCHEMA = """page_number int, blocks array<struct<
  type: string, bbox: array<double>, title: string, text: string, parent_index: int,
  items: array<struct<label: string, value: string, unit: string, owner: string>>,
  rows: array<struct<label: string, cells: array<struct<column: string, value: string>>>>>>"""
#: The most blocks of a proposal, items of a block, rows of a table and cells of a row, and repeats.
MOST_BLOCKS, MOST_ITEMS, MOST_ROWS, MOST_CELLS, MOST_REPEATS = 65, 130, 60, 20, 3


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once; in a plain expression the optimizer repeats it at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _error(page: Column, p: Column) -> Column:
    """The first rule that a parsed proposal breaks, null if it is valid."""
    blocks = F.coalesce(p["blocks"], F.array())
    corner = lambda b, k: F.get(b["bbox"], F.lit(k))
    good_box = lambda b: (F.size(b["bbox"]) == 4) & (corner(b, 0) >= 0) & (corner(b, 0) < corner(b, 2)) & (corner(b, 2) <= 1000) & (corner(b, 1) >= 0) & (corner(b, 1) < corner(b, 3)) & (corner(b, 3) <= 1000)
    # in sorted values, one that stands over MOST_REPEATS times meets itself that many places before
    met = lambda s: F.exists(F.transform(s, lambda v, i: (i >= MOST_REPEATS) & v.eqNullSafe(F.get(s, i - MOST_REPEATS))), lambda v: v)
    too_often = lambda values: F.coalesce(_bound(F.sort_array(values), met), F.lit(False))
    signature = F.transform(blocks, lambda b: F.to_json(F.struct(b["type"], b["title"], b["text"], b["bbox"])))
    repeated = F.exists(blocks, lambda b: too_often(F.transform(b["items"], lambda i: F.to_json(i))))
    parent = F.exists(F.transform(blocks, lambda b, i: F.coalesce((b["parent_index"] < 0) | (b["parent_index"] >= i), F.lit(False))), lambda v: v)
    too_many = F.exists(blocks, lambda b: (F.coalesce(F.size(b["items"]), F.lit(0)) > MOST_ITEMS) | (F.coalesce(F.size(b["rows"]), F.lit(0)) > MOST_ROWS) | F.coalesce(F.exists(b["rows"], lambda r: F.size(r["cells"]) > MOST_CELLS), F.lit(False)))
    return (
        F.when(p.isNull() | p["blocks"].isNull(), "not_json")
        .when(~p["page_number"].eqNullSafe(page.cast("int")), "other_page")
        .when((F.size(blocks) > MOST_BLOCKS) | too_many, "too_many")
        .when(F.exists(blocks, lambda b: ~F.coalesce(good_box(b), F.lit(False))), "invalid_box")
        .when(repeated, "repeated_item")
        .when(parent, "invalid_parent")
        .when(too_often(signature), "repeated_block")
    )


def parsed(proposals: DataFrame) -> DataFrame:
    """page, error and p (the parsed struct). error names the first rule that a proposal breaks, null if it is valid."""
    judged = _bound(F.from_json("raw", SCHEMA), lambda p: F.struct(_error(F.col("page"), p).alias("error"), p.alias("p")))
    return proposals.select("page", judged.alias("_judged")).select("page", "_judged.error", "_judged.p")


def _valid_blocks(valid: DataFrame) -> DataFrame:
    """page, block, b of valid proposals. An outer explode, as no filter is then derived from it that parses again."""
    blocks = F.when(F.col("error").isNull(), F.col("p.blocks"))
    return valid.select("page", F.posexplode_outer(blocks).alias("block", "b")).where("block IS NOT NULL")


def proposal_blocks(valid: DataFrame) -> DataFrame:
    """page, block, type, title, box and counts of the blocks of valid proposals."""
    at = [F.get("b.bbox", F.lit(k)) for k in range(4)]
    return _valid_blocks(valid).select("page", "block", "b.type", "b.title", at[0].alias("x"), at[1].alias("y"), (at[2] - at[0]).alias("w"), (at[3] - at[1]).alias("h"), F.coalesce(F.size("b.items"), F.lit(0)).alias("n_items"), F.coalesce(F.size("b.rows"), F.lit(0)).alias("n_rows"))


def proposal_items(valid: DataFrame) -> DataFrame:
    return _valid_blocks(valid).select("page", "block", F.posexplode("b.items").alias("item", "i")).select("page", "block", "item", "i.label", "i.value")


def reusable(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests that a complete cached answer serves: same model, image and prompt."""
    return requests.join(cache.where("status = 'complete'").select("model", "image_sha256", "prompt_sha256", "raw"), ["model", "image_sha256", "prompt_sha256"])


def selected_pages(specs: DataFrame) -> DataFrame:
    """doc_id, page for specs like 1-3,8 (columns doc_id, spec, n_pages); an empty spec is all pages. Descending ranges
    and pages outside 1..n_pages raise."""
    part = F.explode(F.filter(F.transform(F.split(F.coalesce("spec", F.lit("")), ","), lambda v: F.trim(v)), lambda v: v != "")).alias("part")
    ends = specs.where("trim(coalesce(spec, '')) <> ''").select("doc_id", "n_pages", part)
    low, high = F.get(F.split("part", "-"), F.lit(0)).cast("int"), F.element_at(F.split("part", "-"), -1).cast("int")
    wrong = (low > high) | (low < 1) | (high > F.col("n_pages"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("page range not within the document: "), "part")).cast("int")).otherwise(low)
    chosen = ends.select("doc_id", F.explode(F.sequence(checked, high)).alias("page"))
    everything = specs.where("trim(coalesce(spec, '')) = '' AND n_pages > 0").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("n_pages").cast("int"))).alias("page"))
    return chosen.unionByName(everything).distinct()


def merged_tiles(tiles: DataFrame) -> DataFrame:
    """Blocks of overlapping page tiles in page units, each thing once.

    tiles: page, tile, block, type, title, text, n_items, box within the tile, and the tile's place tx, ty, tw, th. Of
    blocks with equal type, title and text that overlap by 0.6 the one with most items stays, of equals the first."""
    placed = tiles.select("page", "tile", "block", "type", "title", "text", "n_items", (F.col("tx") + F.col("x") * F.col("tw") / 1000).alias("x"), (F.col("ty") + F.col("y") * F.col("th") / 1000).alias("y"), (F.col("w") * F.col("tw") / 1000).alias("w"), (F.col("h") * F.col("th") / 1000).alias("h"))
    same = ["page", "type", "_title", "_text"]
    keyed = placed.withColumn("_title", F.lower(F.trim("title"))).withColumn("_text", F.lower(F.trim("text")))
    other = keyed.select(*same, *(F.col(c).alias(f"o_{c}") for c in ("tile", "block", "n_items", "x", "y", "w", "h")))
    better = (F.col("o_n_items") > F.col("n_items")) | ((F.col("o_n_items") == F.col("n_items")) & (F.struct("o_tile", "o_block") < F.struct("tile", "block")))
    met = keyed.join(other, same).where(better & (overlap_of_smaller(box(), box("o_"), 0) >= 0.6)).select("page", "tile", "block").distinct()
    kept = placed.join(met, ["page", "tile", "block"], "left_anti")
    return kept.withColumn("position", F.row_number().over(Window.partitionBy("page").orderBy("y", "x", "tile", "block")).cast("long"))

"""Integrity rules as queries. Each gives rows of rule, page keys, block and what is wrong; no row means valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import dealt, pieces

# What a block may be.
BLOCK_TYPES = ("heading", "text", "footnote", "contact", "table", "comparison_panel", "chart", "map", "kpi_panel", "photograph", "brand_mark", "decoration", "unclassified_visual", "group")
STATUSES = ("passed", "needs_review", "failed")


def _rule(df: DataFrame, rule: str, keys: Sequence[str], bad: Column, block: str = "block") -> DataFrame:
    return df.where(bad).select(F.lit(rule).alias("rule"), *keys, F.col(block).cast("string").alias("block"))


def block_violations(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rules on single blocks: known type and status, box on the page, confidence, unique ids."""
    box_bad = (F.col("x") < 0) | (F.col("y") < 0) | (F.col("w") <= 0) | (F.col("h") <= 0) | (F.col("x") + F.col("w") > 1000) | (F.col("y") + F.col("h") > 1000)
    several = blocks.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("_n"))
    rules = [
        _rule(blocks, "unknown_type", keys, ~F.col("type").isin(*BLOCK_TYPES)),
        _rule(blocks, "unknown_status", keys, ~F.col("status").isin(*STATUSES)),
        _rule(blocks, "box_off_page", keys, box_bad),
        _rule(blocks, "confidence_out_of_range", keys, ~F.col("confidence").between(0, 100)),
        _rule(blocks, "decoration_not_passed", keys, (F.col("type") == "decoration") & (F.col("status") != "passed")),
        _rule(several, "duplicate_block_id", keys, F.col("_n") > 1),
    ]
    return _union(rules)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def hierarchy_violations(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Links must exist, be said by both sides, and put a child one level below its parent.

    blocks: keys, block, parent, children (array), depth, type, status."""
    ids = blocks.select(*keys, F.col("block").alias("parent"), F.col("depth").alias("_depth"), F.col("children").alias("_children"), F.col("status").alias("_status"))
    linked = blocks.where("parent IS NOT NULL").join(ids, [*keys, "parent"], "left")
    listed = blocks.select(*keys, F.col("block").alias("_by"), F.explode("children").alias("block"))
    back = listed.join(blocks.select(*keys, "block", F.col("parent").alias("_parent"), F.col("status").alias("_child_status")), [*keys, "block"], "left")
    review = listed.join(blocks.select(*keys, "block", "status"), [*keys, "block"]).where("status <> 'passed'").select(*keys, F.col("_by").alias("block")).distinct()
    groups = blocks.where("status = 'passed'").join(review, [*keys, "block"], "left_semi")
    return _union(
        [
            _rule(linked, "parent_missing", keys, F.col("_depth").isNull()),
            _rule(linked, "parent_does_not_list_child", keys, F.col("_depth").isNotNull() & ~F.array_contains("_children", F.col("block"))),
            _rule(linked, "depth_not_below_parent", keys, F.col("depth") != F.col("_depth") + 1),
            _rule(blocks, "root_depth_not_zero", keys, F.col("parent").isNull() & (F.col("depth") != 0)),
            _rule(back, "child_names_other_parent", keys, ~F.col("_parent").eqNullSafe(F.col("_by"))),
            _rule(groups, "passing_group_with_review_child", keys, F.lit(True)),
        ]
    )


def rolled_up_status(blocks: DataFrame, keys: Sequence[str], depth: int) -> DataFrame:
    """keys, block, status after every group with a child that is not passed went to review, the deepest first.
    depth: the greatest depth, small and known from the schema."""
    now = blocks.select(*keys, "block", "parent", "depth", "status")
    for level in range(depth, 0, -1):
        open_ = now.where((F.col("depth") == level) & (F.col("status") != "passed")).select(*keys, F.col("parent").alias("block")).distinct().withColumn("_open", F.lit(True))
        status = F.when(F.col("_open").isNotNull() & (F.col("status") == "passed"), "needs_review").otherwise(F.col("status"))
        now = now.join(open_, [*keys, "block"], "left").withColumn("status", status).drop("_open")
    return now.select(*keys, "block", "status")


def closure(blocks: DataFrame, keys: Sequence[str], depth: int) -> DataFrame:
    """keys, block, ancestor, steps for every ancestor, by one join for each level."""
    edge = blocks.where("parent IS NOT NULL").select(*keys, F.col("block").alias("ancestor"), F.col("parent").alias("_up"))
    now = blocks.where("parent IS NOT NULL").select(*keys, "block", F.col("parent").alias("ancestor"), F.lit(1).alias("steps"))
    out = now
    for step in range(2, depth + 1):
        now = now.join(edge, [*keys, "ancestor"]).select(*keys, "block", F.col("_up").alias("ancestor"), F.lit(step).alias("steps"))
        out = out.unionByName(now)
    return out


def evidence_violations(evidence: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rule, keys, block (an evidence id). evidence: keys, block, evidence_id that blocks own; ledger: keys,
    evidence_id, text, owner. Every nonblank line has one owner, and the ledger names that owner. Both are read once for
    all rules, and texts stay out of the shuffle."""
    key, n = [*keys, "evidence_id"], pieces(ledger)
    owners = dealt(evidence.select(*key, "block"), key, n).groupBy(*key).agg(F.min("block").alias("_block"), F.max("block").alias("_last"))
    listed = dealt(ledger.where(F.trim("text") != "").select(*key, "owner"), key, n).withColumn("_listed", F.lit(True))
    both = listed.join(owners.withColumn("_held", F.lit(True)), key, "full_outer")
    rules = {
        "several_owners": F.col("_block") != F.col("_last"),
        "line_without_owner": F.col("_held").isNull(),
        "evidence_not_in_ledger": F.col("_listed").isNull(),
        "ledger_names_other_owner": F.col("_listed") & (F.col("_block") == F.col("_last")) & ~F.col("owner").eqNullSafe(F.col("_block")),
    }
    broken = F.explode(F.array_compact(F.array(*(F.when(bad, rule) for rule, bad in rules.items()))))
    return both.select(broken.alias("rule"), *keys, F.col("evidence_id").cast("string").alias("block"))


def table_violations(cells: DataFrame) -> DataFrame:
    """table_id, rule: columns named twice, rows that lack a cell of some column, cells beyond the header."""
    heads = cells.where("row = 0")
    width = heads.groupBy("table_id").agg(F.countDistinct("col").alias("_width"))
    twice = heads.where(F.trim("text") != "").groupBy("table_id", F.lower(F.trim("text")).alias("_l")).count().where("count > 1").select("table_id", F.lit("column_named_twice").alias("rule"))
    rows = cells.where("row > 0").groupBy("table_id", "row").agg(F.countDistinct("col").alias("_n"), F.max("col").alias("_last")).join(width, "table_id")
    lacking = rows.where("_n < _width").select("table_id", F.lit("row_lacks_cells").alias("rule"))
    beyond = rows.where("_last >= _width").select("table_id", F.lit("cell_beyond_header").alias("rule"))
    return _union([twice, lacking, beyond]).distinct()


def chart_violations(charts: DataFrame, observations: DataFrame, owned: DataFrame) -> DataFrame:
    """block, rule: counts that differ, values without owned evidence, marks used twice, passed charts that lack values."""
    counts = observations.groupBy("block").agg(F.count(F.lit(1)).alias("_n"), F.countDistinct("mark").alias("_marks"), F.count("mark").alias("_marked"))
    all_ = charts.join(counts, "block", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    strange = observations.select("block", F.col("value_evidence_id").alias("evidence_id")).join(owned, ["block", "evidence_id"], "left_anti").select("block").distinct()
    pick = lambda df, rule: df.select("block", F.lit(rule).alias("rule"))
    return _union(
        [
            pick(all_.where(F.col("emitted") != F.col("_n")), "emitted_count_differs"),
            pick(all_.where("_marked > _marks"), "mark_used_twice"),
            pick(all_.where((F.col("status") == "passed") & (F.col("_n") < F.col("expected"))), "incomplete_chart_passed"),
            pick(strange, "value_evidence_not_owned"),
        ]
    )


def completeness(pages: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, blocks, needs_review, complete: a page is complete if it has no warning and no block in review."""
    counted = blocks.groupBy(*keys).agg(F.count(F.lit(1)).alias("blocks"), F.sum((F.col("status") != "passed").cast("long")).alias("needs_review"))
    found = pages.join(counted, list(keys), "left").withColumn("blocks", F.coalesce("blocks", F.lit(0).cast("long"))).withColumn("needs_review", F.coalesce("needs_review", F.lit(0).cast("long")))
    return found.select(*keys, "blocks", "needs_review", ((F.col("warnings") == 0) & (F.col("needs_review") == 0)).alias("complete"))

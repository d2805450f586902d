"""Reading order, line groups, sections and heading roles, by window functions over one page or region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READING = ("y", "x", "seq")


def reading_order(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dense positions from 1 by y, then x; seq settles ties."""
    return blocks.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*READING)).cast("long"))


def line_gap_groups(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A new group starts where the gap to the lowest earlier bottom is over 10 and over 0.72 of the median height."""
    median = lines.groupBy(*keys).agg(F.median(F.greatest("h", F.lit(1))).alias("_median"))
    order = Window.partitionBy(*keys).orderBy(*READING)
    before = F.max(F.col("y") + F.col("h")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    broken = F.coalesce(F.col("y") - before > F.greatest(F.lit(10.0), F.col("_median") * 0.72), F.lit(False))
    flagged = lines.join(median, list(keys)).withColumn("_new", broken.cast("long"))
    return flagged.withColumn("group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_median", "_new")


def sections(blocks: DataFrame, keys: Sequence[str], heading: Column, band: Column, least: int = 2) -> DataFrame:
    """section: number of root headings so far, for blocks outside bands; 0 before the first heading. Sections with
    fewer than `least` members beside their heading are dissolved (null)."""
    order = Window.partitionBy(*keys).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    numbered = blocks.where(~band).withColumn("section", F.sum(heading.cast("long")).over(order))
    members = numbered.groupBy(*keys, "section").agg(F.sum((~heading).cast("long")).alias("_members"))
    found = numbered.join(members, [*keys, "section"])
    return found.withColumn("section", F.when((F.col("section") > 0) & (F.col("_members") >= least), F.col("section"))).drop("_members")


def heading_body(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each region its first line, if the gap below it is at least 12 and 0.6 of the median height: a heading that
    leads a body."""
    median = lines.groupBy(*keys).agg(F.median("h").alias("_median"))
    order = Window.partitionBy(*keys).orderBy(*READING)
    placed = lines.withColumn("_rank", F.row_number().over(order)).withColumn("_next", F.lead("y").over(order))
    first = placed.where("_rank = 1").join(median, list(keys)).withColumn("gap", F.col("_next") - F.col("y") - F.col("h"))
    return first.where(F.col("gap") >= F.greatest(F.lit(12.0), F.col("_median") * 0.6)).drop("_rank", "_next", "_median")


def heading_roles(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the first page title of a page stays one. Later ones with a digit are summary headings, others section
    headings, both on level 2."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*READING))
    titles = blocks.where("semantic_role = 'page_title'").withColumn("_rank", rank)
    later = F.when(F.col("text").rlike(r"\d"), "summary_heading").otherwise("section_heading")
    return titles.withColumn("role", F.when(F.col("_rank") == 1, "page_title").otherwise(later)).withColumn("level", F.when(F.col("_rank") == 1, 1).otherwise(2).cast("long")).drop("_rank")


def column_arrangement(blocks: DataFrame, keys: Sequence[str], gap: int = 120) -> DataFrame:
    """Two-lane order. The widest gap between sorted centres, if at least `gap`, divides left from right; wide or top
    blocks come first, then the left lane, the right lane and foot blocks (column lane: 0, 1, 2, 3)."""
    center = F.col("x") + F.col("w") / 2
    body = blocks.withColumn("_c", center).withColumn("_body", (F.col("w") < 600) & (F.col("y") < 890))
    order = Window.partitionBy(*keys).orderBy("_c", "seq")
    steps = body.where("_body").withColumn("_before", F.lag("_c").over(order)).where(F.col("_c") - F.col("_before") >= gap)
    widest = steps.groupBy(*keys).agg(F.max(F.struct(F.col("_c") - F.col("_before"), ((F.col("_c") + F.col("_before")) / 2).alias("at"))).alias("_w"))
    laned = body.join(widest.select(*keys, F.col("_w.at").alias("_at")), list(keys), "left")
    lane = F.when(F.col("y") >= 890, 3).when(~F.col("_body"), 0).when(F.col("_at").isNull() | (F.col("_c") <= F.col("_at")), 1).otherwise(2)
    placed = laned.withColumn("lane", lane.cast("long"))
    final = Window.partitionBy(*keys).orderBy("lane", *READING)
    return placed.withColumn("position", F.row_number().over(final).cast("long")).drop("_c", "_body", "_at")


def claims_by_marker(words: DataFrame, keys: Sequence[str], marker: Column, lead: float = 2) -> DataFrame:
    """claim: number of the bullet whose band holds a word. A band reaches from `lead` above its bullet to `lead` above
    the next; words above the first bullet belong to none (null)."""
    order = Window.partitionBy(*keys).orderBy(F.col("_at"), F.col("_word"), *READING)
    moved = words.withColumn("_word", (~marker).cast("int")).withColumn("_at", F.when(marker, F.col("y") - lead).otherwise(F.col("y")))
    counted = F.sum(1 - F.col("_word")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return moved.withColumn("claim", F.when(counted > 0, counted)).drop("_word", "_at")


def repeated_portraits(visuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Visuals with at least two peers (themselves included) in a column of like size: portraits."""
    same = visuals.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("x").alias("_x"), F.col("w").alias("_w"), F.col("h").alias("_h"))
    on = (F.abs(F.col("x") - F.col("_x")) <= 35) & (F.abs(F.col("w") - F.col("_w")) <= 0.25 * F.col("w")) & (F.abs(F.col("h") - F.col("_h")) <= 0.25 * F.col("h"))
    for k in keys:
        on = on & (visuals[k] == F.col(f"_{k}"))
    return visuals.join(same, on).groupBy(*keys, "region").agg(F.count(F.lit(1)).alias("peers")).where("peers >= 2")


def legend_free(values: DataFrame, labels: DataFrame, keys: Sequence[str], within: float = 75) -> DataFrame:
    """Values farther than `within` from every legend label of their page."""
    other = labels.select(*(F.col(k).alias(f"_{k}") for k in keys), (F.col("x") + F.col("w") / 2).alias("_lx"), (F.col("y") + F.col("h") / 2).alias("_ly"))
    dx, dy = F.col("x") + F.col("w") / 2 - F.col("_lx"), F.col("y") + F.col("h") / 2 - F.col("_ly")
    on = dx * dx + dy * dy <= within * within
    for k in keys:
        on = on & (values[k] == F.col(f"_{k}"))
    return values.join(other, on, "left_anti")


def footnotes(lines: DataFrame, regions_of: Sequence[str], top: Column, height: Column) -> DataFrame:
    """Lines of 20 characters or more in the lower 34 % of their region that carry a note mark or stand right beside one."""
    low = lines.where((F.col("y") >= top + height * 0.66))
    marks = low.where(F.col("text").rlike(r"^\s*[*†‡]")).select(*(F.col(k).alias(f"_{k}") for k in regions_of), F.col("y").alias("_y"), (F.col("x") + F.col("w")).alias("_right"), F.col("seq").alias("_seq"))
    beside = (F.abs(F.col("y") - F.col("_y")) <= 25) & (F.col("x") - F.col("_right")).between(0, 45)
    on = beside | (F.col("seq") == F.col("_seq"))
    for k in regions_of:
        on = on & (low[k] == F.col(f"_{k}"))
    return low.where(F.length("text") >= 20).join(marks, on, "left_semi")

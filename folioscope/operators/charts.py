"""Chart evidence as aggregates: percentage totals, completeness, axis calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as T

from .joins import page_join


def percentage_totals(observations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, observations, total, reconciles: every observation is a percentage and they add up to 98..102."""
    number = T.numeric_value(F.col("value"))
    parts = observations.select(*keys, number["value"].alias("v"), (number["unit"] == "percent").alias("p"))
    found = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("observations"), F.count(F.when(F.col("p"), 1)).alias("_percents"), F.round(F.sum(F.when(F.col("p"), F.col("v"))), 5).alias("total"))
    return found.select(*keys, "observations", "total", ((F.col("_percents") == F.col("observations")) & F.col("total").between(98, 102)).alias("reconciles"))


def emitted_share(expected: DataFrame, emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, expected, emitted, completeness: values that a visual prints, and those that its observations hold."""
    want = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    have = emitted.groupBy(*keys).agg(F.count(F.lit(1)).alias("emitted"))
    both = want.join(have, list(keys), "left").withColumn("emitted", F.coalesce("emitted", F.lit(0).cast("long")))
    return both.withColumn("completeness", F.round(F.col("emitted") / F.col("expected"), 5))


def axis_calibration(lines: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, ticks, slope, intercept, residual, accepted: a line through the percentage ticks left of all marks (one tick
    for each value, the highest). Accepted with three ticks, a falling line, 100 units of height and residuals to 3."""
    left = marks.groupBy(*keys).agg(F.min("x").alias("_left"))
    tick = lines.where(F.col("evidence_id").contains("-ocr-") & F.trim("text").rlike(r"^[-+]?\d[\d,.]*\s*%$")).join(left, list(keys)).where(F.col("x") + F.col("w") / 2 < F.col("_left") - 8)
    placed = tick.select(*keys, T.numeric_value(F.col("text"))["value"].alias("v"), (F.col("y") + F.col("h") / 2).alias("c"))
    placed = placed.groupBy(*keys, "v").agg(F.min("c").alias("c"))
    fit = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("ticks"), F.regr_slope("v", "c").alias("slope"), F.regr_intercept("v", "c").alias("intercept"), (F.max("c") - F.min("c")).alias("_span"))
    worst = placed.join(fit, list(keys)).groupBy(*keys).agg(F.max(F.abs(F.col("slope") * F.col("c") + F.col("intercept") - F.col("v"))).alias("residual"))
    found = fit.join(worst, list(keys))
    good = (F.col("ticks") >= 3) & (F.col("slope") < 0) & (F.col("_span") >= 100) & (F.col("residual") <= 3)
    return found.select(*keys, "ticks", "slope", "intercept", "residual", F.coalesce(good, F.lit(False)).alias("accepted"))


def point_ranges(marks: DataFrame, axes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range of percentages that a mark may stand for on an accepted axis; null on others. Never an exact value."""
    at = marks.join(axes, list(keys))
    middle = F.col("slope") * (F.col("y") + F.col("h") / 2) + F.col("intercept")
    spread = F.greatest(F.lit(1.0), F.abs("slope") * (F.col("h") / 2 + 5) + F.col("residual"))
    return at.select(*marks.columns, *(F.when(F.col("accepted"), F.round(v, 1)).alias(n) for n, v in (("low", middle - spread), ("high", middle + spread))))


def neighbours(marks: DataFrame, ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each mark the x labels on its left and right (the nearest centre on either side)."""
    spot = ticks.select(*keys, (F.col("x") + F.col("w") / 2).alias("_at"), F.col("text").alias("_label"))
    centre = F.col("x") + F.col("w") / 2
    met = page_join(marks, spot, keys, F.lit(True)).withColumn("_off", F.col("_at") - centre)
    found = met.groupBy(*keys, "mark").agg(F.max(F.when(F.col("_off") <= 0, F.struct("_off", "_label"))).alias("_l"), F.min(F.when(F.col("_off") >= 0, F.struct("_off", "_label"))).alias("_r"))
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return found.select(*keys, "mark", F.when(both, F.col("_l._label")).alias("left_label"), F.when(both, F.col("_r._label")).alias("right_label"))


def nearest(values: DataFrame, candidates: DataFrame, keys: Sequence[str], k: int = 1) -> DataFrame:
    """keys, seq, rank, other: the k nearest candidates of each value by the distance of centres, ties by their seq."""
    there = candidates.select(*keys, F.col("seq").alias("other"), (F.col("x") + F.col("w") / 2).alias("_x"), (F.col("y") + F.col("h") / 2).alias("_y"))
    dx, dy = F.col("x") + F.col("w") / 2 - F.col("_x"), F.col("y") + F.col("h") / 2 - F.col("_y")
    met = page_join(values, there, keys, F.lit(True)).select(*keys, "seq", F.struct((dx * dx + dy * dy).alias("d"), "other").alias("o"))
    top = met.groupBy(*keys, "seq").agg(F.slice(F.array_sort(F.collect_list("o")), 1, k).alias("_top"))
    return top.select(*keys, "seq", F.posexplode("_top").alias("rank", "o")).select(*keys, "seq", (F.col("rank") + 1).cast("long").alias("rank"), F.col("o.other").alias("other"))


def mutual_nearest(values: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs that are each other's nearest: stricter than the greedy pairing of operators.paged."""
    a = nearest(values, labels, keys).select(*keys, "seq", "other")
    b = nearest(labels, values, keys).select(*keys, F.col("seq").alias("other"), F.col("other").alias("seq"))
    return a.join(b, [*keys, "seq", "other"])

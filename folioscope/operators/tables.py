"""Tables as rows of cells: column kinds, totals, structure errors, grounding of cells on printed lines.

A cell row is table_id, row (0: header), col (0: row label), text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as T


def column_kinds(cells: DataFrame) -> DataFrame:
    """Value kind of each column: the first is text; then percent, currency, multiple or number by its signs."""
    body, text = F.col("row") > 0, F.coalesce("text", F.lit(""))
    seen = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    found = cells.groupBy("table_id", "col").agg(
        seen(text.contains("%")).alias("percent"),
        seen(text.rlike("[$€£]")).alias("currency"),
        seen(body & text.rlike(r"(?i)\bx\b")).alias("multiple"),
    )
    kind = F.when(F.col("col") == 0, "text").when(F.col("percent"), "percent").when(F.col("currency"), "currency").when(F.col("multiple"), "multiple").otherwise("number")
    return found.select("table_id", "col", kind.alias("value_kind"))


_TOTAL = r"(?i)^\s*(?:grand\s+)?total\b"


def total_checks(cells: DataFrame) -> DataFrame:
    """Of tables with at least four rows and three total rows: each column whose total rows all hold numbers, the sum
    of its subtotals, the last total, and whether they agree within max(0.011, 1e-8 of the total)."""
    labels = cells.where((F.col("col") == 0) & (F.col("row") > 0) & F.coalesce(F.col("text"), F.lit("")).rlike(_TOTAL)).select("table_id", "row")
    shape = cells.groupBy("table_id").agg((F.max("row") + 1).alias("rows"))
    group = labels.groupBy("table_id").agg(F.count(F.lit(1)).alias("totals"), F.max("row").alias("last"))
    used = group.join(shape, "table_id").where("rows >= 4 AND totals >= 3").select("table_id", "last", "totals")
    parts = cells.where("col > 0").join(labels, ["table_id", "row"]).join(used, "table_id").withColumn("number", T.signed_number(F.coalesce("text", F.lit(""))))
    last = F.col("row") == F.col("last")
    sums = parts.groupBy("table_id", "col", "totals").agg(
        F.count("number").alias("numbers"),
        F.sum(F.when(~last, F.col("number"))).alias("calculated"),
        F.max(F.when(last, F.col("number"))).alias("observed"),
    )
    sums = sums.where((F.col("numbers") == F.col("totals")) & F.col("observed").isNotNull())
    passed = F.abs(F.col("calculated") - F.col("observed")) <= F.greatest(F.lit(0.011), F.abs("observed") * 1e-8)
    return sums.select("table_id", "col", F.round("calculated", 5).alias("calculated"), "observed", passed.alias("passed"))


def structure_errors(cells: DataFrame) -> DataFrame:
    """table_id, error: distinct faults of ownership that sums cannot show."""
    text = F.trim(F.coalesce("text", F.lit("")))
    head, body = F.col("row") == 0, (F.col("row") > 0) & (F.col("col") > 0)
    count = lambda sign: F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))
    rules = {
        "one or more table columns have no header owner": head & (text == ""),
        "one or more table rows have no label owner": (F.col("row") > 0) & (F.col("col") == 0) & (text == ""),
        "one or more table headers contain unmatched parentheses": head & (count("(") != count(")")),
        "standalone currency symbol has no owned numeric value": body & text.isin("$", "€", "£"),
        "currency symbol is attached to a percentage cell": body & text.rlike(r"%\s*[$€£]$"),
    }
    faults = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return cells.select("table_id", F.explode(faults).alias("error")).distinct()


def linked_scalars(cells: DataFrame) -> DataFrame:
    """table_id, linked: numeric cells in rows whose label has a letter."""
    labelled = cells.where((F.col("col") == 0) & (F.col("row") > 0) & F.col("text").rlike("[A-Za-z]")).select("table_id", "row")
    numeric = T.numeric_value(F.coalesce("text", F.lit("")))["value"].isNotNull()
    return cells.where((F.col("col") > 0) & numeric).join(labelled, ["table_id", "row"], "left_semi").groupBy("table_id").agg(F.count(F.lit(1)).alias("linked"))


def ground_cells(cells: DataFrame, lines: DataFrame, columns: int, width: Column, in_order: bool = False) -> DataFrame:
    """Cells whose exact text is printed once where row label and column header say.

    lines: table_id, evidence_id, text, box of the lines that the table owns. Labels and headers must be printed once.
    Two-column tables need the value right of its label, wider ones under its header. A printed value that would serve
    several cells serves none of them; with in_order it serves the first cell whose only choice it is, table by table."""
    status = "ocr_value_and_row" if columns == 2 else "ocr_row_and_column"
    keyed = lines.select("table_id", "evidence_id", "h", T.alnum_key(F.col("text")).alias("key"), (F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy")).where("key <> ''")
    once = keyed.groupBy("table_id", "key").agg(F.count(F.lit(1)).alias("n"), F.min("cx").alias("ox"), F.min("cy").alias("oy"), F.min("h").alias("oh")).where("n = 1").drop("n")
    key = T.alnum_key(F.coalesce("text", F.lit("")))
    labels = cells.where("col = 0 AND row > 0").select("table_id", "row", key.alias("key")).join(once, ["table_id", "key"]).select("table_id", "row", F.col("ox").alias("lx"), F.col("oy").alias("ly"), F.col("oh").alias("lh"))
    wanted = cells.where("col > 0 AND row > 0").select("table_id", "row", "col", key.alias("key")).where("key <> ''").join(labels, ["table_id", "row"])
    met = wanted.join(keyed, ["table_id", "key"])
    met = met.where(F.abs(F.col("cy") - F.col("ly")) <= F.greatest(F.lit(20.0), (F.col("lh") + F.col("h")) / 2 + 12))
    if columns == 2:
        met = met.where(F.col("cx") > F.col("lx") + 5)
    else:
        heads = cells.where("row = 0 AND col > 0").select("table_id", "col", key.alias("key")).join(once, ["table_id", "key"]).select("table_id", "col", F.col("ox").alias("hx"))
        met = met.join(heads, ["table_id", "col"]).where(F.abs(F.col("cx") - F.col("hx")) <= F.greatest(F.lit(35.0), width / (columns * 1.4)))
    if in_order:
        from .paged import GROUNDED, ground_in_order, per_page

        found = per_page(met.select("table_id", "row", "col", "evidence_id"), ["table_id"], ground_in_order, GROUNDED)
        return found.withColumn("grounding_status", F.lit(status))
    single = met.groupBy("table_id", "row", "col").agg(F.count(F.lit(1)).alias("n"), F.min("evidence_id").alias("evidence_id")).where("n = 1")
    free = single.groupBy("table_id", "evidence_id").agg(F.count(F.lit(1)).alias("uses")).where("uses = 1")
    return single.join(free, ["table_id", "evidence_id"], "left_semi").select("table_id", "row", "col", "evidence_id", F.lit(status).alias("grounding_status"))


def cells_of(grid: DataFrame, keys: Sequence[str], rows: str) -> DataFrame:
    """An array of rows of strings as cell rows."""
    each = grid.select(*keys, F.posexplode(rows).alias("row", "cells"))
    return each.select(*keys, F.col("row").cast("long").alias("row"), F.posexplode("cells").alias("col", "text")).withColumn("col", F.col("col").cast("long"))

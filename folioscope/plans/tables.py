"""Queries over tables: kinds, totals, structure, grounding, HTML grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import tables as TB
from folioscope.sources.evidence import CHART_SQL, chart_lines, table
from folioscope.sources.html_tables import html_grids

from .base import query

#: One table for each order status: a header, rows of priorities, subtotals of each half and a grand total.
CELLS_SQL = """
o AS (SELECT o_orderstatus AS s, o_orderpriority AS p, count(*) AS n, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS v FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p) AS k, count(*) OVER (PARTITION BY s) AS m FROM o),
g AS (
  SELECT s, k AS row, p AS label, n, v FROM r
  UNION ALL SELECT s, 101, 'Total urgent', CAST(sum(n) FILTER (k <= 2) AS BIGINT), CAST(sum(v) FILTER (k <= 2) AS BIGINT) FROM r GROUP BY s
  UNION ALL SELECT s, 102, 'total rest', CAST(sum(n) FILTER (k > 2) AS BIGINT), CAST(sum(v) FILTER (k > 2) AS BIGINT) FROM r GROUP BY s
  UNION ALL SELECT s, 103, 'Grand total', CAST(sum(n) AS BIGINT), CAST(sum(v) + CASE WHEN s = 'P' THEN 5 ELSE 0 END AS BIGINT) FROM r GROUP BY s),
cells AS (
  SELECT s AS table_id, row, 0 AS col, label AS text FROM g
  UNION ALL SELECT s, row, 1, CAST(n AS VARCHAR) FROM g
  UNION ALL SELECT s, row, 2, '$' || v FROM g
  UNION ALL SELECT s, row, 3, CASE WHEN row % 2 = 0 THEN '$' ELSE (n % 100) || '% $' END FROM g
  UNION ALL SELECT DISTINCT s, 0, c, (['Priority', 'Orders (n', '', 'Share %'])[c + 1] FROM o, range(4) t(c))
"""


def status_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).alias("v"))
    rank = F.array_position(F.array(*(F.lit(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))), F.col("p"))
    rows = grouped.select("s", rank.cast("long").alias("row"), F.col("p").alias("label"), "n", "v")
    part = lambda low, high, row, label, extra=0: rows.where(F.col("row").between(low, high)).groupBy("s").agg(F.sum("n").alias("n"), (F.sum("v") + extra).alias("v")).select("s", F.lit(row).cast("long").alias("row"), F.lit(label).alias("label"), "n", "v")
    total = part(1, 9, 103, "Grand total").withColumn("v", F.col("v") + F.when(F.col("s") == "P", 5).otherwise(0))
    grid = rows.unionByName(part(1, 2, 101, "Total urgent")).unionByName(part(3, 9, 102, "total rest")).unionByName(total)
    share = F.when(F.col("row") % 2 == 0, "$").otherwise(F.concat(F.col("n") % 100, F.lit("% $")))
    body = grid.select(F.col("s").alias("table_id"), "row", F.posexplode(F.array(F.col("label"), F.col("n").cast("string"), F.concat(F.lit("$"), F.col("v")), share)).alias("col", "text"))
    head = rows.select(F.col("s").alias("table_id")).distinct().select("table_id", F.lit(0).cast("long").alias("row"), F.posexplode(F.array(*(F.lit(v) for v in ("Priority", "Orders (n", "", "Share %")))).alias("col", "text"))
    return body.unionByName(head).withColumn("col", F.col("col").cast("long"))


@query("column_value_kind", f"""WITH {CELLS_SQL}
SELECT table_id, col, CASE WHEN col = 0 THEN 'text' WHEN bool_or(contains(text, '%')) THEN 'percent' WHEN bool_or(regexp_matches(text, '[$€£]')) THEN 'currency'
  WHEN bool_or(row > 0 AND regexp_matches(text, '(?i)\\bx\\b')) THEN 'multiple' ELSE 'number' END AS value_kind FROM cells GROUP BY table_id, col""")
def column_value_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.column_kinds(status_cells(spark, sf_dir))


@query("subtotal_reconciliation", f"""WITH {CELLS_SQL},
t AS (SELECT table_id, row FROM cells WHERE col = 0 AND row > 0 AND regexp_matches(text, '(?i)^\\s*(grand\\s+)?total\\b')),
l AS (SELECT table_id, max(row) AS last, count(*) AS totals FROM t GROUP BY ALL HAVING count(*) >= 3),
n AS (SELECT c.table_id, c.col, c.row, last, totals, TRY_CAST(replace(nullif(regexp_extract(text, '[-+]?\\d[\\d,]*(\\.\\d+)?'), ''), ',', '') AS DOUBLE) AS v
      FROM cells c JOIN t USING (table_id, row) JOIN l USING (table_id) WHERE c.col > 0),
s AS (SELECT table_id, col, sum(v) FILTER (row <> last) AS calculated, max(v) FILTER (row = last) AS observed, count(v) AS k, any_value(totals) AS totals FROM n GROUP BY ALL)
SELECT table_id, col, round(calculated, 5) AS calculated, observed, abs(calculated - observed) <= greatest(0.011, abs(observed) * 1e-8) AS passed FROM s WHERE k = totals""")
def subtotal_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.total_checks(status_cells(spark, sf_dir))


@query("table_structure_errors", f"""WITH {CELLS_SQL}
SELECT DISTINCT table_id, error FROM (
  SELECT table_id, 'one or more table columns have no header owner' AS error FROM cells WHERE row = 0 AND trim(text) = ''
  UNION ALL SELECT table_id, 'one or more table rows have no label owner' FROM cells WHERE row > 0 AND col = 0 AND trim(text) = ''
  UNION ALL SELECT table_id, 'one or more table headers contain unmatched parentheses' FROM cells WHERE row = 0 AND length(replace(text, '(', '')) <> length(replace(text, ')', ''))
  UNION ALL SELECT table_id, 'standalone currency symbol has no owned numeric value' FROM cells WHERE row > 0 AND col > 0 AND trim(text) IN ('$', '€', '£')
  UNION ALL SELECT table_id, 'currency symbol is attached to a percentage cell' FROM cells WHERE row > 0 AND col > 0 AND regexp_matches(trim(text), '%\\s*[$€£]$'))""")
def table_structure_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.structure_errors(status_cells(spark, sf_dir))


@query("linked_scalar_count", f"""WITH {CELLS_SQL},
l AS (SELECT table_id, row FROM cells WHERE col = 0 AND row > 0 AND regexp_matches(text, '[A-Za-z]'))
SELECT table_id, count(*) AS linked FROM cells JOIN l USING (table_id, row) WHERE col > 0 AND regexp_matches(text, '\\d') GROUP BY ALL""")
def linked_scalar_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.linked_scalars(status_cells(spark, sf_dir))


@query("table_cell_grounding", f"""WITH {CHART_SQL},
lines AS (SELECT page AS table_id, evidence_id, text, CASE role WHEN 'label' THEN 60 ELSE 300 + page * 3 % 40 END AS x, 100 + 60 * slot + CASE WHEN role = 'value' AND (page + slot) % 6 = 0 THEN 45 ELSE 0 END AS y, w, h FROM chart),
keyed AS (SELECT *, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS key, x + w / 2 AS cx, y + h / 2 AS cy FROM lines),
once AS (SELECT table_id, key, min(cx) AS lx, min(cy) AS ly, min(h) AS lh FROM keyed GROUP BY ALL HAVING count(*) = 1),
met AS (
  SELECT l.table_id, l.slot AS row, k.evidence_id
  FROM (SELECT page AS table_id, slot, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS label FROM chart WHERE role = 'label') l
  JOIN (SELECT page AS table_id, slot, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS value FROM chart WHERE role = 'value') v USING (table_id, slot)
  JOIN once o ON o.table_id = l.table_id AND o.key = l.label JOIN keyed k ON k.table_id = l.table_id AND k.key = v.value
  WHERE abs(k.cy - o.ly) <= greatest(20.0, (o.lh + k.h) / 2 + 12) AND k.cx > o.lx + 5),
single AS (SELECT table_id, row, min(evidence_id) AS evidence_id FROM met GROUP BY ALL HAVING count(*) = 1)
SELECT table_id, row, 1 AS col, evidence_id, 'ocr_value_and_row' AS grounding_status FROM single
WHERE (table_id, evidence_id) IN (SELECT (table_id, evidence_id) FROM single GROUP BY table_id, evidence_id HAVING count(*) = 1)""".replace("row, min(evidence_id)", "row + 1 AS row, min(evidence_id)").replace("GROUP BY ALL HAVING count(*) = 1)\nSELECT table_id, row, 1", "GROUP BY table_id, row HAVING count(*) = 1)\nSELECT table_id, row, 1"))
def table_cell_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = chart_lines(spark, sf_dir)
    label = F.col("role") == "label"
    x = F.when(label, 60).otherwise(300 + F.col("page") * 3 % 40)
    y = 100 + 60 * F.col("slot") + F.when(~label & ((F.col("page") + F.col("slot")) % 6 == 0), 45).otherwise(0)
    lines = chart.select(F.col("page").alias("table_id"), "evidence_id", "text", x.alias("x"), y.alias("y"), "w", "h")
    cells = chart.select(F.col("page").alias("table_id"), (F.col("slot") + 1).alias("row"), F.when(label, 0).otherwise(1).cast("long").alias("col"), "text")
    return TB.ground_cells(cells, lines, 2, F.lit(600))


@query("html_table_cells", """
WITH n AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS row FROM nation)
SELECT CAST(n_regionkey AS BIGINT) AS table_id, row, c AS col, CASE c WHEN 0 THEN n_name WHEN 1 THEN CAST(n_nationkey AS VARCHAR) ELSE '' END AS text FROM n, range(3) t(c)
UNION ALL SELECT DISTINCT CAST(n_regionkey AS BIGINT), 0, c, (['Name', 'Key & id', ''])[c + 1] FROM nation, range(3) t(c)""")
def html_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat(F.lit("<tr><td> "), F.col("n_name"), F.lit("<br></td><td colspan=2>"), F.col("n_nationkey"), F.lit("</td></tr>"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("long").alias("table_id"), F.struct("n_nationkey", row.alias("row")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]), "")
    html = nation.groupBy("table_id").agg(F.concat(F.lit("<table><tr><th>Name</th><th colspan=2>Key &amp; id</th></tr>"), body, F.lit("</table>")).alias("html"))
    return TB.cells_of(html.select("table_id", html_grids("html").alias("grid")), ["table_id"], "grid").select("table_id", "row", "col", "text")


@query("page_tables")
def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    grids = table(spark, sf_dir, "pages").select("page_id", html_grids("html").alias("grid"))
    return grids.select("page_id", F.size("grid").alias("rows"))

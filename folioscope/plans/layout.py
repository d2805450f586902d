"""Queries over reading order, groups, sections and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.operators import assembly as A
from folioscope.operators import layout as L
from folioscope.sources.evidence import CHART_SQL, EVIDENCE_SQL, chart_lines, evidence_lines, page_regions

from .base import query
from .scalars import ROLE_SQL

PAGE = ["doc_id", "page"]


@query("reading_order", f"WITH {EVIDENCE_SQL} SELECT doc_id, page, seq, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, x, seq) AS position FROM evidence")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reading_order(evidence_lines(spark, sf_dir), PAGE).select(*PAGE, "seq", "position")


@query("line_gap_groups", f"""WITH {EVIDENCE_SQL},
odd AS (SELECT * REPLACE (y + seq % 40 // 5 * 30 AS y) FROM evidence),
m AS (SELECT doc_id, page, median(greatest(h, 1)) AS m FROM odd GROUP BY ALL),
f AS (SELECT odd.*, y - max(y + h) OVER (PARTITION BY odd.doc_id, odd.page ORDER BY y, x, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > greatest(10.0, m * 0.72) AS broken FROM odd JOIN m USING (doc_id, page))
SELECT doc_id, page, seq, CAST(sum(CASE WHEN broken THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY y, x, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "group" FROM f""")
def line_gap_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line; each five are set apart from the next by 30."""
    lines = evidence_lines(spark, sf_dir).withColumn("y", F.col("y") + F.floor(F.col("seq") % 40 / 5) * 30)
    return L.line_gap_groups(lines, PAGE).select(*PAGE, "seq", "group")


def typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    typed = lines.withColumn("block_type", T.text_block_type(F.col("text"), F.col("y"), 6 + F.col("seq") % 12))
    return typed.withColumn("semantic_role", T.semantic_role(F.col("block_type"), F.col("text"), F.col("y"), F.col("page") + 1, F.lit(False)))


@query("section_membership", f"""WITH {EVIDENCE_SQL}, {ROLE_SQL},
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, x, seq) AS position FROM typed),
s AS (SELECT *, sum(CASE WHEN block_type = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY position ROWS UNBOUNDED PRECEDING) AS section FROM p WHERE block_type <> 'footnote'),
m AS (SELECT doc_id, page, section, count(*) FILTER (block_type <> 'heading') AS members FROM s GROUP BY ALL)
SELECT doc_id, page, seq, CASE WHEN section > 0 AND members >= 2 THEN CAST(section AS BIGINT) END AS section FROM s JOIN m USING (doc_id, page, section)""")
def section_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = L.reading_order(typed_lines(spark, sf_dir), PAGE)
    return L.sections(placed, PAGE, F.col("block_type") == "heading", F.col("block_type") == "footnote").select(*PAGE, "seq", "section")


@query("heading_led_bodies", f"""WITH {EVIDENCE_SQL},
g AS (SELECT * REPLACE (y + CASE WHEN seq % 6 = 0 THEN 0 ELSE seq // 6 % 3 * 10 END AS y), seq // 6 AS region FROM evidence),
m AS (SELECT doc_id, page, region, median(h) AS m FROM g GROUP BY ALL),
p AS (SELECT g.*, m, row_number() OVER w AS rn, lead(y) OVER w - y - h AS gap FROM g JOIN m USING (doc_id, page, region) WINDOW w AS (PARTITION BY g.doc_id, g.page, g.region ORDER BY y, x, seq))
SELECT doc_id, page, region, seq, gap FROM p WHERE rn = 1 AND gap >= greatest(12.0, m * 0.6)""")
def heading_led_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, in regions of six; by region the first line stands 0, 10 or 20 further apart from the others."""
    region = F.floor(F.col("seq") / 6)
    lines = evidence_lines(spark, sf_dir).withColumn("region", region).withColumn("y", F.col("y") + F.when(F.col("seq") % 6 == 0, 0).otherwise(region % 3 * 10))
    return L.heading_body(lines, [*PAGE, "region"]).select(*PAGE, "region", "seq", "gap")


@query("heading_roles", f"""WITH {EVIDENCE_SQL}, {ROLE_SQL},
t AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, x, seq) AS rn FROM typed WHERE block_type = 'heading' AND y <= 220)
SELECT doc_id, page, seq, CASE WHEN rn = 1 THEN 'page_title' WHEN regexp_matches(text, '\\d') THEN 'summary_heading' ELSE 'section_heading' END AS role, CAST(CASE WHEN rn = 1 THEN 1 ELSE 2 END AS BIGINT) AS level FROM t""")
def heading_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.heading_roles(typed_lines(spark, sf_dir), PAGE).select(*PAGE, "seq", "role", "level")


@query("column_arrangement", f"""WITH {EVIDENCE_SQL},
b AS (SELECT *, x + w / 2 AS c, w < 600 AND y < 890 AS body FROM evidence),
s AS (SELECT *, lag(c) OVER (PARTITION BY doc_id, page ORDER BY c, seq) AS before FROM b WHERE body),
a AS (SELECT doc_id, page, max(struct_pack(gap := c - before, mid := (c + before) / 2)).mid AS mid FROM s WHERE c - before >= 120 GROUP BY ALL),
l AS (SELECT b.*, CAST(CASE WHEN y >= 890 THEN 3 WHEN NOT body THEN 0 WHEN mid IS NULL OR c <= mid THEN 1 ELSE 2 END AS BIGINT) AS lane FROM b LEFT JOIN a USING (doc_id, page))
SELECT doc_id, page, seq, lane, row_number() OVER (PARTITION BY doc_id, page ORDER BY lane, y, x, seq) AS position FROM l""")
def column_arrangement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.column_arrangement(evidence_lines(spark, sf_dir), PAGE).select(*PAGE, "seq", "lane", "position")


@query("claims_by_marker", f"""WITH {EVIDENCE_SQL},
m AS (SELECT *, seq % 4 = 1 AS mark FROM evidence),
c AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY CASE WHEN mark THEN y - 2 ELSE y END, CASE WHEN mark THEN 0 ELSE 1 END, y, x, seq ROWS UNBOUNDED PRECEDING) AS n FROM m)
SELECT doc_id, page, seq, CASE WHEN n > 0 THEN CAST(n AS BIGINT) END AS claim FROM c""")
def claims_by_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.claims_by_marker(evidence_lines(spark, sf_dir), PAGE, F.col("seq") % 4 == 1).select(*PAGE, "seq", F.col("claim").cast("long").alias("claim"))


@query("repeated_portraits", f"""WITH {EVIDENCE_SQL},
v AS (SELECT * FROM regions WHERE kind <> 'table')
SELECT a.doc_id, a.page, a.region, count(*) AS peers FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.page = b.page
 AND abs(a.x - b.x) <= 35 AND abs(a.w - b.w) <= 0.25 * a.w AND abs(a.h - b.h) <= 0.25 * a.h GROUP BY ALL HAVING count(*) >= 2""")
def repeated_portraits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.repeated_portraits(page_regions(evidence_lines(spark, sf_dir)).where("kind <> 'table'"), PAGE)


@query("legend_free_values", f"""WITH {CHART_SQL}
SELECT v.page, v.slot, v.text FROM chart v WHERE v.role = 'value' AND NOT EXISTS (
  SELECT 1 FROM chart l WHERE l.role = 'label' AND l.page = v.page AND pow(v.x + v.w / 2 - l.x - l.w / 2, 2) + pow(v.y + v.h / 2 - l.y - l.h / 2, 2) <= 35 * 35)""")
def legend_free_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chart_lines(spark, sf_dir)
    return L.legend_free(lines.where("role = 'value'"), lines.where("role = 'label'"), ["page"], 35).select("page", "slot", "text")


@query("visual_footnotes", f"""WITH {EVIDENCE_SQL},
z AS (SELECT *, seq // 8 AS region, CASE WHEN seq % 8 = 6 THEN '* ' || text ELSE text END AS t FROM evidence),
b AS (SELECT doc_id, page, region, min(y) AS top, max(y + h) - min(y) AS height FROM z GROUP BY ALL),
low AS (SELECT z.doc_id, z.page, z.region, seq, t, x, y, w FROM z JOIN b USING (doc_id, page, region) WHERE y >= top + height * 0.66)
SELECT doc_id, page, region, seq FROM low a WHERE length(t) >= 20 AND EXISTS (
  SELECT 1 FROM low m WHERE m.doc_id = a.doc_id AND m.page = a.page AND m.region = a.region AND regexp_matches(m.t, '^\\s*[*†‡]')
   AND (m.seq = a.seq OR (abs(a.y - m.y) <= 25 AND a.x - m.x - m.w BETWEEN 0 AND 45)))""")
def visual_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir).withColumn("region", F.floor(F.col("seq") / 8))
    lines = lines.withColumn("text", F.when(F.col("seq") % 8 == 6, F.concat(F.lit("* "), "text")).otherwise(F.col("text")))
    keys = [*PAGE, "region"]
    frame = lines.groupBy(*keys).agg(F.min("y").alias("top"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("height"))
    return L.footnotes(lines.join(frame, keys), keys, F.col("top"), F.col("height")).select(*keys, "seq")


@query("inline_sections", f"""WITH {EVIDENCE_SQL},
z AS (SELECT doc_id, page, seq, x, y, seq // 10 AS region, CASE WHEN seq % 5 = 2 THEN 'PART ' || seq || ': ' || text ELSE text END AS text FROM evidence),
t AS (SELECT *, nullif(regexp_extract(text, '^\\s*(\\p{{Lu}}[\\p{{Lu}}\\d &/''-]{{2,}}):', 1), '') AS t FROM z),
e AS (SELECT doc_id, page, region FROM t GROUP BY ALL HAVING count(t) >= 2)
SELECT doc_id, page, region, seq, count(t) OVER w AS section, last_value(t IGNORE NULLS) OVER w AS title FROM t JOIN e USING (doc_id, page, region) WINDOW w AS (PARTITION BY t.doc_id, t.page, t.region ORDER BY y, x, seq ROWS UNBOUNDED PRECEDING)""")
def inline_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir).withColumn("region", F.floor(F.col("seq") / 10))
    lines = lines.withColumn("text", F.when(F.col("seq") % 5 == 2, F.concat(F.lit("PART "), "seq", F.lit(": "), "text")).otherwise(F.col("text")))
    return A.inline_sections(lines, [*PAGE, "region"]).select(*PAGE, "region", "seq", "section", "title")


@query("page_blocks")
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    regions = page_regions(lines)
    features = regions.select(*PAGE, "region", (F.col("doc_id") % 5).alias("bar_candidates"), (F.col("region") % 3).alias("point_candidates"))
    return A.page_blocks(lines, regions, features)

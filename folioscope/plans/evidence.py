"""Queries over surrogate evidence: ownership, coverage, repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import ownership as own
from folioscope.sources.evidence import EVIDENCE_SQL, evidence_lines, page_regions, table

from .base import query

OWNER_SQL = f"""
WITH {EVIDENCE_SQL},
pairs AS (
  SELECT e.*, r.region, r.kind, r.w * r.h AS area, r.conf AS r_conf,
         CASE r.kind WHEN 'table' THEN 6 WHEN 'visual' THEN 5 WHEN 'normal_text' THEN 4 WHEN 'decoration' THEN 1 ELSE 2 END AS weight
  FROM evidence e JOIN regions r ON e.doc_id = r.doc_id AND e.page = r.page
   AND e.x + e.w / 2 BETWEEN r.x AND r.x + r.w AND e.y + e.h / 2 BETWEEN r.y AND r.y + r.h),
owners AS (
  SELECT doc_id, page, seq, region, kind FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, page, seq ORDER BY weight DESC, area, r_conf DESC, region) AS rn FROM pairs)
  WHERE rn = 1)
"""


@query("region_line_owner", OWNER_SQL + "SELECT doc_id, page, seq, region, kind FROM owners")
def region_line_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return own.region_owner(lines, page_regions(lines))


@query("evidence_disposition", OWNER_SQL + """
SELECT doc_id, page, coalesce(kind, 'unassigned') AS disposition, count(*) AS lines
FROM evidence LEFT JOIN owners USING (doc_id, page, seq) GROUP BY ALL""")
def evidence_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return own.dispositions(own.with_owner(lines, page_regions(lines)))


@query("unowned_lines", OWNER_SQL + "SELECT doc_id, page, seq, text FROM evidence ANTI JOIN owners USING (doc_id, page, seq)")
def unowned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return own.with_owner(lines, page_regions(lines), "left_anti").select("doc_id", "page", "seq", "text")


@query("multi_owner_evidence", OWNER_SQL + "SELECT doc_id, page, seq, count(*) AS owners FROM pairs GROUP BY ALL HAVING count(*) > 1")
def multi_owner_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return own.contested(lines, page_regions(lines))


#: Block content of the surrogate: each region serialises the lines with even seq that it owns.
CONTENT_SQL = OWNER_SQL + """,
content AS (
  SELECT doc_id, page, region, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h,
         string_agg(text, ' ' ORDER BY seq) AS text
  FROM evidence JOIN owners USING (doc_id, page, seq) WHERE seq % 2 = 0 GROUP BY doc_id, page, region),
numeric_lines AS (
  SELECT *, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS key FROM evidence
  WHERE conf >= 80 AND regexp_matches(text, '[0-9]') AND length(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) >= 3),
covered AS (
  SELECT n.doc_id, n.page, n.seq, n.text, EXISTS (
    SELECT 1 FROM content c WHERE c.doc_id = n.doc_id AND c.page = n.page
     AND n.x + n.w / 2 BETWEEN c.x - 10 AND c.x + c.w + 10 AND n.y + n.h / 2 BETWEEN c.y - 10 AND c.y + c.h + 10
     AND contains(regexp_replace(lower(c.text), '[^a-z0-9]', '', 'g'), n.key)) AS represented
  FROM numeric_lines n)
"""


def region_content(lines: DataFrame) -> DataFrame:
    """What regions hold. Every second line is left out of the content on purpose, so that the coverage rule, which is
    asked about all lines, has something to find."""
    owned = own.with_owner(lines, page_regions(lines), "inner").where("seq % 2 = 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"]), " ")
    return owned.groupBy("doc_id", "page", "region").agg(F.min("x").alias("x"), F.min("y").alias("y"), (F.max(F.col("x") + F.col("w")) - F.min("x")).alias("w"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("h"), text.alias("text"))


@query("numeric_line_coverage", CONTENT_SQL + """
SELECT doc_id, page, count(*) AS numeric_lines, count(*) FILTER (represented) AS represented FROM covered GROUP BY ALL""")
def numeric_line_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    found = own.numeric_coverage(lines, region_content(lines))
    return found.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("numeric_lines"), F.sum(F.col("represented").cast("long")).alias("represented"))


@query("numeric_missing_lines", CONTENT_SQL + "SELECT doc_id, page, seq, text FROM covered WHERE NOT represented")
def numeric_missing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return own.numeric_coverage(lines, region_content(lines)).where("NOT represented").select("doc_id", "page", "seq", "text")


@query("token_page_frequency", """
WITH tokens AS (
  SELECT DISTINCT lang, doc_id, unnest(regexp_extract_all(lower(text), '\\pL{2,}')) AS token FROM documents WHERE text IS NOT NULL)
SELECT lang, token, count(*) AS pages FROM tokens GROUP BY ALL""")
def token_page_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own.token_pages(table(spark, sf_dir, "documents"), "lang", "doc_id")


@query("repeated_bands", f"""
WITH {EVIDENCE_SQL},
bands AS (
  SELECT r.*, d.source, CAST(round_even(x / 25, 0) AS BIGINT) AS sx, CAST(round_even(y / 25, 0) AS BIGINT) AS sy,
         CAST(round_even(w / 25, 0) AS BIGINT) AS sw, CAST(round_even(h / 25, 0) AS BIGINT) AS sh
  FROM regions r JOIN documents d USING (doc_id)
  WHERE kind = 'visual' AND w >= 700 AND h <= 180 AND (y >= 820 OR y + h <= 180)),
repeated AS (SELECT source, sx, sy, sw, sh, count(DISTINCT doc_id) AS pages FROM bands GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3)
SELECT source, doc_id, region, pages FROM bands JOIN repeated USING (source, sx, sy, sw, sh)""")
def repeated_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = page_regions(evidence_lines(spark, sf_dir)).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return own.repeated_bands(regions, "source", "doc_id")

"""Evidence tables with explicit schemas, and surrogates of them built from the driver tables.

Scanning PDFs, recognising text and asking vision models happen outside; what they produce are tables with these
schemas. The surrogates use integer arithmetic only, so that any SQL engine gives the same boxes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(long: str, string: str, order: str) -> T.StructType:
    kinds = {c: T.LongType() for c in long.split()} | {c: T.StringType() for c in string.split()}
    return T.StructType([T.StructField(c, kinds[c]) for c in order.split()])


EVIDENCE = _schema("doc_id page seq conf x y w h", "evidence_id text", "doc_id page seq evidence_id text conf x y w h")
REGION = _schema("doc_id page region x y w h conf", "kind", "doc_id page region kind x y w h conf")

#: Regions on each surrogate page: two lanes of five bands with gaps, and across them a top band and an inset.
REGIONS = 12
KINDS = ("table", "visual", "normal_text", "decoration", "unknown")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evidence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each nonblank line of each document, placed on pages of 40 lines in two lanes."""
    lines = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text")).where(F.trim("text") != "")
    i = F.col("i").cast("long")
    return lines.select(
        "doc_id",
        (F.floor(i / 40) + 1).alias("page"),
        i.alias("seq"),
        F.concat_ws("-ocr-", F.col("doc_id").cast("string"), i.cast("string")).alias("evidence_id"),
        "text",
        (70 + 3 * (i % 11)).alias("conf"),
        (50 + 450 * (i % 2)).alias("x"),
        (20 + 24 * (i % 40)).alias("y"),
        F.least(F.lit(400), 8 * F.length("text")).cast("long").alias("w"),
        F.lit(18).cast("long").alias("h"),
    )


def page_regions(lines: DataFrame) -> DataFrame:
    """REGIONS regions on every page that has lines; kinds cycle with the document."""
    pages = lines.select("doc_id", "page").distinct()
    each = pages.select("doc_id", "page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(REGIONS - 1).cast("long"))).alias("region"))
    r = F.col("region")
    grid = r < 10
    kind = F.element_at(F.array(*(F.lit(k) for k in KINDS)), ((r * 3 + F.col("doc_id")) % 5 + 1).cast("int"))
    return each.select(
        "doc_id",
        "page",
        "region",
        kind.alias("kind"),
        F.when(grid, 40 + 450 * (r % 2)).when(r == 10, 0).otherwise(200).cast("long").alias("x"),
        F.when(grid, 10 + 196 * F.floor(r / 2)).when(r == 10, 0).otherwise(300).cast("long").alias("y"),
        F.when(grid, 440).when(r == 10, 1000).otherwise(600).cast("long").alias("w"),
        F.when(grid, 180).when(r == 10, 120).otherwise(300).cast("long").alias("h"),
        (60 + (r * 7) % 40).alias("conf"),
    )


#: The same two tables as DuckDB common table expressions.
EVIDENCE_SQL = """
evidence AS (
  SELECT doc_id, i // 40 + 1 AS page, i AS seq, doc_id || '-ocr-' || i AS evidence_id, text,
         70 + 3 * (i % 11) AS conf, 50 + 450 * (i % 2) AS x, 20 + 24 * (i % 40) AS y,
         CAST(least(400, 8 * length(text)) AS BIGINT) AS w, CAST(18 AS BIGINT) AS h
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
               unnest(range(len(string_split(text, chr(10))))) AS i
        FROM documents WHERE text IS NOT NULL)
  WHERE trim(text) <> ''),
regions AS (
  SELECT doc_id, page, region,
         (['table', 'visual', 'normal_text', 'decoration', 'unknown'])[(region * 3 + doc_id) % 5 + 1] AS kind,
         CASE WHEN region < 10 THEN 40 + 450 * (region % 2) WHEN region = 10 THEN 0 ELSE 200 END AS x,
         CASE WHEN region < 10 THEN 10 + 196 * (region // 2) WHEN region = 10 THEN 0 ELSE 300 END AS y,
         CASE WHEN region < 10 THEN 440 WHEN region = 10 THEN 1000 ELSE 600 END AS w,
         CASE WHEN region < 10 THEN 180 WHEN region = 10 THEN 120 ELSE 300 END AS h,
         60 + (region * 7) % 40 AS conf
  FROM (SELECT DISTINCT doc_id, page FROM evidence), range(12) t(region))
"""


def printed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short printed strings in twelve shapes (amounts, percentages, dates, contacts), one for each part."""
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    shapes = [
        F.concat(F.lit("$"), s(k % 97), F.lit(".5M")),
        F.concat(s(k % 100), F.lit(".9%")),
        F.concat(F.lit("("), s(1 + k % 900), F.lit(",250)")),
        F.concat(F.lit("$"), s(k % 50), F.lit(" billion total")),
        F.concat(F.lit("1,"), s(100 + k % 900), F.lit(".25x")),
        F.concat(F.lit("As of "), s(1 + k % 14), F.lit("/"), s(1 + k % 33), F.lit("/"), s(10 + k % 60)),
        F.concat(F.lit("between "), s(k % 20), F.lit("%-"), s(20 + k % 30), F.lit("% or "), s(k % 7), F.lit(".5%")),
        F.concat(F.lit("Total: "), s(k % 13), F.lit("k of $"), s(k % 17), F.lit(" k")),
        F.concat(F.lit("€"), s(k % 1000), F.lit("m")),
        F.concat(F.lit("Call 555-"), s(100 + k % 900), F.lit("-"), s(1000 + k % 9000), F.lit(" or mail user"), s(k), F.lit("@example"), s(k % 5), F.lit(".com")),
        F.concat(F.lit("NORTH "), s(k % 10), F.lit(" CAPITAL LLC at www.example"), s(k % 9), F.lit(".org/about")),
        F.col("p_name"),
    ]
    text = shapes[-1]
    for n, shape in enumerate(shapes[:-1]):
        text = F.when(k % 12 == n, shape).otherwise(text)
    return table(spark, sf_dir, "part").select(k.alias("line_id"), text.alias("text"))


PRINTED_SQL = """
printed AS (
  SELECT p_partkey AS line_id, CASE p_partkey % 12
    WHEN 0 THEN '$' || (p_partkey % 97) || '.5M'
    WHEN 1 THEN (p_partkey % 100) || '.9%'
    WHEN 2 THEN '(' || (1 + p_partkey % 900) || ',250)'
    WHEN 3 THEN '$' || (p_partkey % 50) || ' billion total'
    WHEN 4 THEN '1,' || (100 + p_partkey % 900) || '.25x'
    WHEN 5 THEN 'As of ' || (1 + p_partkey % 14) || '/' || (1 + p_partkey % 33) || '/' || (10 + p_partkey % 60)
    WHEN 6 THEN 'between ' || (p_partkey % 20) || '%-' || (20 + p_partkey % 30) || '% or ' || (p_partkey % 7) || '.5%'
    WHEN 7 THEN 'Total: ' || (p_partkey % 13) || 'k of $' || (p_partkey % 17) || ' k'
    WHEN 8 THEN '€' || (p_partkey % 1000) || 'm'
    WHEN 9 THEN 'Call 555-' || (100 + p_partkey % 900) || '-' || (1000 + p_partkey % 9000) || ' or mail user' || p_partkey || '@example' || (p_partkey % 5) || '.com'
    WHEN 10 THEN 'NORTH ' || (p_partkey % 10) || ' CAPITAL LLC at www.example' || (p_partkey % 9) || '.org/about'
    ELSE p_name END AS text
  FROM part)
"""


def chart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A surrogate chart on the page of each nation: a label and a value line for each customer segment."""
    counted = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("page"), F.col("c_mktsegment").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    slot = F.array_position(F.array(*(F.lit(s) for s in SEGMENTS)), F.col("label")) - 1
    placed = counted.select("page", "label", "n", slot.cast("long").alias("slot"))
    label = placed.select("page", (2 * F.col("slot")).alias("seq"), F.concat(F.col("page"), F.lit("-ocr-l"), F.col("slot")).alias("evidence_id"), F.col("label").alias("text"), F.lit("label").alias("role"), "slot", (60 + 180 * F.col("slot")).alias("x"), F.lit(200).cast("long").alias("y"), F.lit(120).cast("long").alias("w"), F.lit(18).cast("long").alias("h"))
    value = placed.select("page", (2 * F.col("slot") + 1).alias("seq"), F.concat(F.col("page"), F.lit("-ocr-v"), F.col("slot")).alias("evidence_id"), F.concat(F.lit("$"), F.col("n"), F.lit("M")).alias("text"), F.lit("value").alias("role"), "slot", (80 + 180 * F.col("slot") + (F.col("page") * 7 + F.col("slot") * 11) % 60).alias("x"), F.lit(230).cast("long").alias("y"), F.lit(60).cast("long").alias("w"), F.lit(18).cast("long").alias("h"))
    return label.unionByName(value)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

CHART_SQL = """
counted AS (
  SELECT CAST(c_nationkey AS BIGINT) AS page, c_mktsegment AS label, count(*) AS n,
         list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) - 1 AS slot
  FROM customer GROUP BY 1, 2),
chart AS (
  SELECT page, 2 * slot AS seq, page || '-ocr-l' || slot AS evidence_id, label AS text, 'label' AS role, slot,
         60 + 180 * slot AS x, 200 AS y, 120 AS w, 18 AS h FROM counted
  UNION ALL
  SELECT page, 2 * slot + 1, page || '-ocr-v' || slot, '$' || n || 'M', 'value', slot,
         80 + 180 * slot + (page * 7 + slot * 11) % 60, 230, 60, 18 FROM counted)
"""


def chart_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposed (label, value) pairs for the surrogate charts. By (page + slot) % 5: 0 and 1 are right, 2 names the
    next segment, 3 gives a value that is not printed, 4 proposes on a page without a block."""
    lines = chart_lines(spark, sf_dir)
    label = lines.where("role = 'label'").select("page", "slot", F.col("text").alias("label"))
    value = lines.where("role = 'value'").select("page", "slot", F.col("text").alias("value"))
    both = label.join(value, ["page", "slot"])
    case = (F.col("page") + F.col("slot")) % 5
    shifted = F.element_at(F.array(*(F.lit(s) for s in SEGMENTS)), ((F.col("slot") + 1) % 5 + 1).cast("int"))
    return both.select(
        "page",
        "slot",
        F.when(case == 2, shifted).otherwise(F.col("label")).alias("label"),
        F.when(case == 3, F.concat(F.col("value"), F.lit("9"))).otherwise(F.col("value")).alias("value"),
    )


CLAIMS_SQL = """
claims AS (
  SELECT l.page, l.slot,
         CASE WHEN (l.page + l.slot) % 5 = 2
              THEN (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[(l.slot + 1) % 5 + 1] ELSE l.text END AS label,
         CASE WHEN (l.page + l.slot) % 5 = 3 THEN v.text || '9' ELSE v.text END AS value
  FROM chart l JOIN chart v ON l.page = v.page AND l.slot = v.slot AND l.role = 'label' AND v.role = 'value')
"""

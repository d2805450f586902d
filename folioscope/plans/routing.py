"""Queries over routing, text choice, titles, cards and table matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import blocks as B
from folioscope.operators import ownership as own
from folioscope.sources.evidence import EVIDENCE_SQL, evidence_lines, page_regions, table

from .base import query

PAGE = ["doc_id", "page"]

#: Counters and line counts of a visual, one for each supplier, from arithmetic on its key.
FEATURES_SQL = """
f AS (SELECT s_suppkey AS k, s_suppkey % 14 AS n_lines, (s_suppkey * 3) % 7 AS n_numeric, (s_suppkey * 5) % 6 AS n_ticks, (s_suppkey * 7) % 5 AS n_percent, s_suppkey % 3 AS n_units, (s_suppkey // 3) % 2 AS n_signs,
        (s_suppkey * 11) % 9 AS n_prose, (s_suppkey * 13) % 6 AS n_places, (s_suppkey // 5) % 4 AS n_geographies, s_suppkey % 6 AS n_images, (s_suppkey * 3) % 8 AS horizontal_lines, (s_suppkey * 5) % 7 AS vertical_lines,
        (s_suppkey * 7) % 5 AS bar_candidates, (s_suppkey * 9) % 13 AS point_candidates, s_suppkey % 4 AS legend_swatch_candidates, s_suppkey % 2 AS horizontal_axis_candidates, (s_suppkey // 2) % 2 AS vertical_axis_candidates,
        (s_suppkey // 4) % 2 AS plot_boundary_detected, (s_suppkey % 10) / 10.0 AS table_grid_confidence, 60 + s_suppkey % 35 AS conf, CASE WHEN s_suppkey % 17 = 0 THEN 'Chart' WHEN s_suppkey % 19 = 0 THEN 'photograph' END AS visual_hint,
        CASE WHEN s_suppkey % 13 = 0 THEN ' Pie ' END AS proposed_type, CASE WHEN s_suppkey % 11 = 0 THEN 'BAR' END AS hinted_type FROM supplier),
t AS (SELECT *, CASE WHEN proposed_type IS NOT NULL THEN lower(trim(proposed_type)) WHEN hinted_type IS NOT NULL THEN lower(hinted_type) WHEN n_images >= 4 AND n_percent >= 3 THEN 'pie'
  WHEN point_candidates >= 8 AND horizontal_axis_candidates >= 1 AND vertical_axis_candidates >= 1 AND n_ticks >= 3 THEN 'scatterplot' WHEN bar_candidates >= 3 THEN 'bar'
  WHEN n_images >= 1 AND n_numeric >= 2 AND n_units >= 1 AND n_signs >= 1 THEN 'kpi_panel' ELSE 'unknown' END AS chart_type, n_numeric / greatest(n_lines, 1) AS dense,
  horizontal_axis_candidates >= 1 AND vertical_axis_candidates >= 1 AS axes FROM f)
"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("k"),
        (k % 14).alias("n_lines"),
        *(((k * a) % m).alias(c) for c, a, m in (("n_numeric", 3, 7), ("n_ticks", 5, 6), ("n_percent", 7, 5), ("n_units", 1, 3), ("n_prose", 11, 9), ("n_places", 13, 6), ("n_images", 1, 6), ("horizontal_lines", 3, 8), ("vertical_lines", 5, 7), ("bar_candidates", 7, 5), ("point_candidates", 9, 13), ("legend_swatch_candidates", 1, 4), ("horizontal_axis_candidates", 1, 2))),
        *((F.floor(k / d) % m).alias(c) for c, d, m in (("n_signs", 3, 2), ("n_geographies", 5, 4), ("vertical_axis_candidates", 2, 2), ("plot_boundary_detected", 4, 2))),
        ((k % 10) / 10.0).alias("table_grid_confidence"),
        (60 + k % 35).alias("conf"),
        F.when(k % 17 == 0, "Chart").when(k % 19 == 0, "photograph").alias("visual_hint"),
        F.when(k % 13 == 0, " Pie ").alias("proposed_type"),
        F.when(k % 11 == 0, "BAR").alias("hinted_type"),
    )


@query("chart_types", f"WITH {FEATURES_SQL} SELECT k, chart_type FROM t")
def chart_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select("k", B.chart_type().alias("chart_type"))


@query("visual_kinds", f"""WITH {FEATURES_SQL},
c AS (SELECT *, CASE WHEN lower(visual_hint) = 'chart' THEN 1 WHEN lower(visual_hint) = 'photograph' THEN 2 WHEN table_grid_confidence >= 0.6 AND horizontal_lines >= 4 AND vertical_lines >= 3 AND dense >= 0.35 THEN 3
  WHEN n_geographies >= 2 AND n_numeric >= 2 THEN 4 WHEN n_places >= 4 AND point_candidates >= 8 AND dense < 0.35 THEN 5 WHEN chart_type = 'kpi_panel' THEN 6
  WHEN n_numeric >= 2 AND (bar_candidates >= 3 OR (point_candidates >= 8 AND axes AND n_ticks >= 3) OR (legend_swatch_candidates >= 2 AND (bar_candidates >= 2 OR point_candidates >= 3)) OR (plot_boundary_detected >= 1 AND axes AND n_ticks >= 3)) THEN 7
  WHEN n_lines >= 10 AND n_prose >= 5 AND dense < 0.2 AND n_places < 3 THEN 8 WHEN n_lines >= 3 AND n_numeric = 0 THEN 9 ELSE 10 END AS r FROM t)
SELECT k, (['chart', 'photograph', 'table', 'map', 'map', 'kpi_panel', 'chart', 'normal_text', 'normal_text', 'unclassified_visual'])[r] AS kind,
  CAST(CASE r WHEN 1 THEN greatest(80, conf) WHEN 2 THEN greatest(82, conf) WHEN 3 THEN 76 WHEN 4 THEN least(94, 72 + 4 * n_geographies) WHEN 5 THEN 78 WHEN 6 THEN 82 WHEN 7 THEN 78 WHEN 8 THEN 75 WHEN 9 THEN 62 ELSE 35 END AS BIGINT) AS confidence FROM c""")
def visual_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select("k", B.visual_kind().alias("v")).select("k", "v.kind", "v.confidence")


@query("text_choice", f"""WITH {EVIDENCE_SQL},
p AS (SELECT l.doc_id, l.seq, CASE WHEN l.seq % 9 = 0 THEN '' WHEN l.seq % 4 = 1 THEN r.text ELSE l.text END AS native_text, CASE WHEN l.seq % 7 = 0 THEN '' WHEN l.seq % 3 = 0 THEN l.text || ' two more' ELSE l.text END AS ocr_text, (60 + l.seq % 40) / 100.0 AS quality
      FROM evidence l JOIN evidence r ON l.doc_id = r.doc_id AND r.seq = l.seq + 1),
w AS (SELECT *, list_distinct(regexp_extract_all(lower(native_text), '[\\pL\\pN_]+')) AS a, list_distinct(regexp_extract_all(lower(ocr_text), '[\\pL\\pN_]+')) AS b,
        len(list_filter(regexp_split_to_array(trim(native_text), '\\s+'), lambda v: v <> '')) AS na, len(list_filter(regexp_split_to_array(trim(ocr_text), '\\s+'), lambda v: v <> '')) AS nb FROM p)
SELECT doc_id, seq, CASE WHEN trim(ocr_text) = '' THEN CASE WHEN trim(native_text) <> '' THEN 'native' ELSE 'none' END WHEN trim(native_text) = '' OR quality < 0.78 THEN 'ocr'
  WHEN len(a) > 0 AND len(b) > 0 AND round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 5) < 0.35 THEN 'ocr' WHEN nb >= na + 2 THEN 'hybrid' ELSE 'native' END AS choice FROM w""")
def text_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir).select("doc_id", "seq", "text")
    after = lines.select("doc_id", (F.col("seq") - 1).alias("seq"), F.col("text").alias("after"))
    s = F.col("seq")
    pairs = lines.join(after, ["doc_id", "seq"]).select(
        "doc_id",
        "seq",
        F.when(s % 9 == 0, "").when(s % 4 == 1, F.col("after")).otherwise(F.col("text")).alias("native_text"),
        F.when(s % 7 == 0, "").when(s % 3 == 0, F.concat("text", F.lit(" two more"))).otherwise(F.col("text")).alias("ocr_text"),
        ((60 + s % 40) / 100.0).alias("quality"),
    )
    return pairs.select("doc_id", "seq", B.text_choice().alias("choice"))


@query("visual_titles", f"""WITH {EVIDENCE_SQL},
m AS (SELECT e.doc_id, e.page, r.region, trim(e.text) AS title, CASE WHEN regexp_matches(lower(e.text), 'tion') THEN 0 ELSE 1 END AS late, e.y, e.x, e.seq
      FROM evidence e JOIN regions r ON e.doc_id = r.doc_id AND e.page = r.page AND e.x + e.w / 2 BETWEEN r.x AND r.x + r.w AND e.y + e.h / 2 BETWEEN r.y AND r.y + r.h AND e.y <= r.y + r.h * 0.38
      WHERE r.kind = 'visual' AND (regexp_matches(lower(e.text), 'tion') OR len(regexp_extract_all(e.text, '[A-Za-z]+')) >= 2))
SELECT doc_id, page, region, title FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, page, region ORDER BY late, y, x, seq) = 1""")
def visual_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return B.visual_titles(lines, page_regions(lines).where("kind = 'visual'"), PAGE, "tion")


@query("value_cards", f"""WITH {EVIDENCE_SQL},
l AS (SELECT doc_id, page, seq, x, y, w, h, CASE WHEN seq % 6 = 5 THEN (seq % 50) || CASE WHEN seq % 12 = 5 THEN '-90%' ELSE '.5%' END ELSE 'caption ' || chr(97 + CAST(seq % 26 AS INTEGER)) END AS text FROM evidence),
r AS (SELECT * FROM regions WHERE region < 10 AND kind = 'table'),
v AS (SELECT r.doc_id, r.page, r.region, r.x AS rx, r.w AS rw, min(l.text) AS value, min(l.y) AS vy FROM l JOIN r ON l.doc_id = r.doc_id AND l.page = r.page AND l.x + l.w / 2 BETWEEN r.x AND r.x + r.w AND l.y + l.h / 2 BETWEEN r.y AND r.y + r.h WHERE l.seq % 6 = 5 GROUP BY ALL HAVING count(*) = 1),
c AS (SELECT v.*, l.text AS caption, row_number() OVER (PARTITION BY v.doc_id, v.page, v.region ORDER BY vy - l.y, l.seq) AS rn FROM v JOIN l ON v.doc_id = l.doc_id AND v.page = l.page AND l.seq % 6 <> 5 AND vy - l.y BETWEEN 10 AND 180 AND l.x + l.w / 2 BETWEEN rx - 25 AND rx + rw + 25)
SELECT doc_id, page, region, value, caption, CASE WHEN NOT regexp_matches(value, '\\d\\s*[-–—]\\s*\\d') THEN TRY_CAST(regexp_extract(value, '\\d+(\\.\\d+)?') AS DOUBLE) END AS number FROM c WHERE rn = 1""")
def value_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    s = F.col("seq")
    value = F.concat(s % 50, F.when(s % 12 == 5, "-90%").otherwise(".5%"))
    made = lines.withColumn("text", F.when(s % 6 == 5, value).otherwise(F.concat(F.lit("caption "), F.char(97 + s % 26))))
    return B.value_cards(made, page_regions(lines).where("region < 10 AND kind = 'table'"), PAGE)


@query("background_groups", f"""WITH {EVIDENCE_SQL},
m AS (SELECT d.doc_id, d.page, d.region AS block, g.region AS owner, row_number() OVER (PARTITION BY d.doc_id, d.page, d.region ORDER BY g.w * g.h, g.region) AS rn
      FROM regions d JOIN regions g ON d.doc_id = g.doc_id AND d.page = g.page AND d.region <> g.region AND d.x + d.w / 2 BETWEEN g.x AND g.x + g.w AND d.y + d.h / 2 BETWEEN g.y AND g.y + g.h WHERE d.kind = 'decoration' AND g.region >= 10)
SELECT doc_id, page, block, owner FROM m WHERE rn = 1""")
def background_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = page_regions(evidence_lines(spark, sf_dir)).withColumnRenamed("region", "block")
    return B.background_groups(blocks.where("kind = 'decoration'"), blocks.where("block >= 10"), PAGE)


@query("table_analysis_pages", f"""WITH {EVIDENCE_SQL},
l AS (SELECT * FROM evidence WHERE regexp_matches(text, '\\d') OR seq % 3 <> 1),
k AS (SELECT * REPLACE (CASE WHEN region < 10 AND kind <> 'visual' OR kind = 'table' AND doc_id % 3 <> 0 THEN 'unknown' ELSE kind END AS kind) FROM regions),
n AS (SELECT r.doc_id, r.page, r.region, r.kind, count(*) AS n FROM l JOIN k r ON l.doc_id = r.doc_id AND l.page = r.page AND l.x + l.w / 2 BETWEEN r.x AND r.x + r.w AND l.y + l.h / 2 BETWEEN r.y AND r.y + r.h GROUP BY ALL)
SELECT doc_id, page FROM n WHERE (kind = 'visual' AND n >= 6) OR (kind = 'normal_text' AND n >= 8)
UNION SELECT doc_id, page FROM k WHERE kind = 'table' UNION SELECT doc_id, 1 FROM documents WHERE doc_id % 50 = 7""")
def table_analysis_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    numbered = lines.withColumn("text", F.when(F.col("text").rlike(r"\d") | (F.col("seq") % 3 != 1), "1").otherwise("none"))
    other = ((F.col("region") < 10) & (F.col("kind") != "visual")) | ((F.col("kind") == "table") & (F.col("doc_id") % 3 != 0))
    regions = page_regions(lines).withColumn("kind", F.when(other, "unknown").otherwise(F.col("kind")))
    plan = F.when(F.col("doc_id") % 50 == 7, "table").otherwise("chart")
    plans = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).cast("long").alias("page"), plan.alias("type"))
    return B.table_pages(regions, numbered, plans, PAGE)


@query("table_matches", f"""WITH {EVIDENCE_SQL},
r AS (SELECT doc_id, page, region, x, y, w, h, CASE WHEN region % 3 = 0 THEN 'k' || doc_id % 4 END AS native_key FROM regions WHERE kind = 'table'),
c AS (SELECT doc_id, page, region AS candidate, x + doc_id % 6 * 60 AS x, y, w, h - 40 AS h, CASE WHEN doc_id % 5 = 0 THEN 'layout' ELSE 'grid' END AS structure, 'k' || region % 4 AS grid_key FROM regions WHERE kind = 'table' AND doc_id % 7 <> 0),
m AS (SELECT r.doc_id, r.page, r.region, c.candidate, c.structure, c.grid_key, greatest(least(r.x + r.w, c.x + c.w) - greatest(r.x, c.x), 0) * greatest(least(r.y + r.h, c.y + c.h) - greatest(r.y, c.y), 0) / (c.w * c.h) AS share FROM r JOIN c ON r.doc_id = c.doc_id AND r.page = c.page),
p AS (SELECT * FROM m WHERE share >= 0.45 QUALIFY row_number() OVER (PARTITION BY doc_id, page, region ORDER BY share DESC, candidate) = 1)
SELECT r.doc_id, r.page, r.region, p.candidate, CASE WHEN p.candidate IS NULL THEN 'not_detected' WHEN structure <> 'grid' THEN 'layout_only' WHEN native_key IS NULL THEN 'candidate' WHEN native_key = grid_key THEN 'matched' ELSE 'disagrees' END AS status
FROM r LEFT JOIN p USING (doc_id, page, region)""")
def table_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = page_regions(evidence_lines(spark, sf_dir)).where("kind = 'table'")
    d = F.col("doc_id")
    native = F.when(F.col("region") % 3 == 0, F.concat(F.lit("k"), d % 4))
    candidates = tables.where("doc_id % 7 <> 0").select(*PAGE, F.col("region").alias("candidate"), (F.col("x") + d % 6 * 60).alias("x"), "y", "w", (F.col("h") - 40).alias("h"), F.when(d % 5 == 0, "layout").otherwise("grid").alias("structure"), F.concat(F.lit("k"), F.col("region") % 4).alias("grid_key"))
    return B.match_tables(tables.select(*PAGE, "region", "x", "y", "w", "h", native.alias("native_key")), candidates, PAGE)


@query("mask_moments", "SELECT l_suppkey AS mask, round(sum(a), 4) AS area, round(sum(a * x) / sum(a), 4) AS cx, round(sum(a * y) / sum(a), 4) AS cy FROM (SELECT l_suppkey, l_orderkey % 500 AS x, l_partkey % 700 AS y, (l_orderkey % 256) / 255.0 AS a FROM lineitem) GROUP BY 1 HAVING sum(a) > 0")
def mask_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("mask"), (F.col("l_orderkey") % 500).alias("x"), (F.col("l_partkey") % 700).alias("y"), (F.col("l_orderkey") % 256).alias("alpha"))
    return B.mask_moments(pixels, ["mask"]).select("mask", *(F.round(c, 4).alias(c) for c in ("area", "cx", "cy")))


@query("brand_marks", f"""WITH {EVIDENCE_SQL},
g AS (SELECT e.doc_id, d.lang AS document, seq AS grp, CASE WHEN seq % 5 = 1 THEN text ELSE upper(replace(text, 'ß', 's')) END AS text, x, y, 200 AS w, h FROM evidence e JOIN (SELECT doc_id, lang FROM documents) d USING (doc_id)),
tp AS (SELECT lang AS document, token, count(DISTINCT doc_id) AS pages FROM (SELECT lang, doc_id, unnest(regexp_extract_all(lower(text), '\\pL{{2,}}')) AS token FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
s AS (SELECT *, list_distinct(regexp_extract_all(lower(text), '\\pL{{2,}}')) AS tokens, length(regexp_replace(text, '\\PL', '', 'g')) AS letters, length(regexp_replace(text, '\\P{{Lu}}', '', 'g')) AS uppers FROM g WHERE NOT regexp_matches(text, '\\d')),
k AS (SELECT * FROM s WHERE len(tokens) BETWEEN 1 AND 8 AND letters > 0 AND uppers >= letters * 0.72),
e AS (SELECT k.doc_id, k.grp, avg(CASE WHEN coalesce(pages, 0) >= 2 THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT doc_id, document, grp, unnest(tokens) AS token FROM k) k LEFT JOIN tp USING (document, token) GROUP BY ALL)
SELECT doc_id, grp AS "group", text FROM k JOIN e USING (doc_id, grp) WHERE share >= 0.75 OR (w <= 360 AND h <= 140 AND (y >= 800 OR y + h <= 200) AND (x <= 400 OR x + w >= 600))""")
def brand_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a group with its whole text; four in five are in capitals."""
    documents = table(spark, sf_dir, "documents")
    lines = evidence_lines(spark, sf_dir).join(documents.select("doc_id", F.col("lang").alias("document")), "doc_id")
    upper = F.upper(F.replace("text", F.lit("ß"), F.lit("s")))  # engines differ on its capital
    text = F.when(F.col("seq") % 5 == 1, F.col("text")).otherwise(upper)
    groups = lines.select("doc_id", "document", F.col("seq").alias("group"), F.lit(1).alias("n_lines"), text.alias("text"), "x", "y", F.lit(200).alias("w"), "h")
    pages = own.token_pages(documents, "lang", "doc_id").withColumnRenamed("lang", "document")
    return B.brand_marks(groups, pages, ["doc_id"])

"""Queries over page-wise operators and chart evidence. Where SQL has no greedy choice, only rows are checked here and
the tests compare with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import cards as K
from folioscope.operators import charts as C
from folioscope.operators import paged as P
from folioscope.sources.evidence import CHART_SQL, chart_lines, evidence_lines, page_regions, table

from .base import query


@query("proximity_bindings")
def proximity_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.per_page(chart_lines(spark, sf_dir), ["page"], P.proximity_bindings, P.BINDING)


NEAREST_SQL = f"""
WITH {CHART_SQL},
met AS (
  SELECT v.page, v.seq, l.seq AS other, row_number() OVER (PARTITION BY v.page, v.seq ORDER BY pow(v.x + v.w / 2 - l.x - l.w / 2, 2) + pow(v.y + v.h / 2 - l.y - l.h / 2, 2), l.seq) AS rank,
         row_number() OVER (PARTITION BY l.page, l.seq ORDER BY pow(v.x + v.w / 2 - l.x - l.w / 2, 2) + pow(v.y + v.h / 2 - l.y - l.h / 2, 2), v.seq) AS back
  FROM chart v JOIN chart l ON v.page = l.page AND v.role = 'value' AND l.role = 'label')
"""


@query("nearest_label_topk", NEAREST_SQL + "SELECT page, seq, rank, other FROM met WHERE rank <= 2")
def nearest_label_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chart_lines(spark, sf_dir)
    return C.nearest(lines.where("role = 'value'"), lines.where("role = 'label'"), ["page"], 2)


@query("mutual_nearest_pairs", NEAREST_SQL + "SELECT page, seq, other FROM met WHERE rank = 1 AND back = 1")
def mutual_nearest_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chart_lines(spark, sf_dir)
    return C.mutual_nearest(lines.where("role = 'value'"), lines.where("role = 'label'"), ["page"])


PERCENT_SQL = f"""
WITH {CHART_SQL},
t AS (SELECT page, sum(n) AS t FROM counted GROUP BY ALL),
obs AS (SELECT page, slot, CASE WHEN page % 7 = 3 AND slot = 0 THEN '$5' ELSE (n * 100 // t + CASE WHEN page % 6 = 5 THEN 3 ELSE 0 END) || '%' END AS value FROM counted JOIN t USING (page))
"""


def percent_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("page"), F.col("c_mktsegment").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    total = counted.groupBy("page").agg(F.sum("n").alias("t"))
    share = F.floor(F.col("n") * 100 / F.col("t")) + F.when(F.col("page") % 6 == 5, 3).otherwise(0)
    odd = (F.col("page") % 7 == 3) & (F.col("s") == "AUTOMOBILE")
    return counted.join(total, "page").select("page", "s", F.when(odd, "$5").otherwise(F.concat(share, F.lit("%"))).alias("value"))


@query("percentage_totals", PERCENT_SQL + """,
v AS (SELECT page, TRY_CAST(regexp_extract(value, '\\d+') AS DOUBLE) AS v, contains(value, '%') AS p FROM obs)
SELECT page, count(*) AS observations, round(sum(v) FILTER (p), 5) AS total, count(*) FILTER (p) = count(*) AND sum(v) FILTER (p) BETWEEN 98 AND 102 AS reconciles FROM v GROUP BY page""")
def percentage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.percentage_totals(percent_observations(spark, sf_dir), ["page"])


@query("chart_completeness", PERCENT_SQL + """
SELECT page, count(*) AS expected, count(*) FILTER (value LIKE '%!%%' ESCAPE '!' AND (page + slot) % 4 <> 1) AS emitted, round(count(*) FILTER (value LIKE '%!%%' ESCAPE '!' AND (page + slot) % 4 <> 1) / count(*), 5) AS completeness FROM obs GROUP BY page""")
def chart_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = percent_observations(spark, sf_dir)
    slots = F.create_map(*(F.lit(v) for k, s in enumerate(("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) for v in (s, k)))
    emitted = found.where(F.col("value").contains("%") & ((F.col("page") + F.element_at(slots, F.col("s"))) % 4 != 1))
    return C.emitted_share(found, emitted, ["page"])


AXIS_SQL = """
WITH ticks AS (
  SELECT n_nationkey AS page, k, n_nationkey || '-ocr-t' || k AS evidence_id, (k * 10) || '%' AS text, 20 AS x, 800 - k * 60 + CASE WHEN n_nationkey % 4 = 1 AND k = 2 THEN 90 ELSE 0 END + n_nationkey % 3 * k AS y, 30 AS w, 18 AS h
  FROM nation, range(6) t(k) WHERE n_nationkey % 5 <> 4 OR k < 2),
marks AS (SELECT n_nationkey AS page, m AS mark, 120 + m * 50 AS x, 300 + (n_nationkey * 17 + m * 71) % 400 AS y, 10 AS w, 10 AS h FROM nation, range(8) t(m)),
c AS (SELECT page, k * 10.0 AS v, min(y + h / 2) AS c FROM ticks GROUP BY ALL),
f AS (SELECT page, count(*) AS ticks, regr_slope(v, c) AS slope, regr_intercept(v, c) AS intercept, max(c) - min(c) AS span FROM c GROUP BY page),
axes AS (SELECT f.page, any_value(ticks) AS ticks, any_value(slope) AS slope, any_value(intercept) AS intercept, max(abs(slope * c + intercept - v)) AS residual, any_value(span) AS span FROM f JOIN c USING (page) GROUP BY f.page),
axis AS (SELECT *, ticks >= 3 AND slope < 0 AND span >= 100 AND residual <= 3 AS accepted FROM axes)
"""


def _axis(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    page = F.col("n_nationkey").cast("long")
    nation = table(spark, sf_dir, "nation").select(page.alias("page"))
    page, k, m = F.col("page"), F.col("k"), F.col("mark")
    ticks = nation.select("page", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")).where((page % 5 != 4) | (k < 2))
    y = 800 - k * 60 + F.when((page % 4 == 1) & (k == 2), 90).otherwise(0) + page % 3 * k
    ticks = ticks.select("page", F.concat(page, F.lit("-ocr-t"), k).alias("evidence_id"), F.concat(k * 10, F.lit("%")).alias("text"), F.lit(20).alias("x"), y.alias("y"), F.lit(30).alias("w"), F.lit(18).alias("h"))
    marks = nation.select("page", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("mark"))
    marks = marks.select("page", m.cast("long").alias("mark"), (120 + m * 50).alias("x"), (300 + (page * 17 + m * 71) % 400).alias("y"), F.lit(10).alias("w"), F.lit(10).alias("h"))
    return ticks, marks


@query("axis_calibration", AXIS_SQL + "SELECT CAST(page AS BIGINT) AS page, ticks, round(slope, 6) AS slope, round(residual, 6) AS residual, accepted FROM axis")
def axis_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks, marks = _axis(spark, sf_dir)
    return C.axis_calibration(ticks, marks, ["page"]).select("page", "ticks", F.round("slope", 6).alias("slope"), F.round("residual", 6).alias("residual"), "accepted")


@query("scatter_point_ranges", AXIS_SQL + """
SELECT CAST(page AS BIGINT) AS page, mark, CASE WHEN accepted THEN round(slope * (y + h / 2) + intercept - greatest(1.0, abs(slope) * (h / 2 + 5) + residual), 1) END AS low,
       CASE WHEN accepted THEN round(slope * (y + h / 2) + intercept + greatest(1.0, abs(slope) * (h / 2 + 5) + residual), 1) END AS high FROM marks JOIN axis USING (page)""")
def scatter_point_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks, marks = _axis(spark, sf_dir)
    return C.point_ranges(marks, C.axis_calibration(ticks, marks, ["page"]), ["page"]).select("page", "mark", "low", "high")


@query("axis_neighbours", """
WITH m AS (SELECT n_nationkey AS page, k AS mark, 120 + k * 50 AS cx FROM nation, range(8) t(k)), t AS (SELECT n_nationkey AS page, k, 100 + k * 130 + n_nationkey AS cx, 'x' || k AS label FROM nation, range(4) t(k)),
b AS (SELECT m.page, m.mark, arg_max(label, t.cx) FILTER (t.cx <= m.cx) AS l, arg_min(label, t.cx) FILTER (t.cx >= m.cx) AS r FROM m JOIN t ON m.page = t.page GROUP BY m.page, m.mark)
SELECT CAST(page AS BIGINT) AS page, mark, CASE WHEN r IS NOT NULL THEN l END AS left_label, CASE WHEN l IS NOT NULL THEN r END AS right_label FROM b""")
def axis_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("page"))
    marks = nation.select("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("mark"))
    ticks = nation.select("page", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    marks = marks.select("page", "mark", (115 + F.col("mark") * 50).alias("x"), F.lit(10).alias("w"))
    ticks = ticks.select("page", F.concat(F.lit("x"), "k").alias("text"), (90 + F.col("k") * 130 + F.col("page")).alias("x"), F.lit(20).alias("w"))
    return C.neighbours(marks, ticks, ["page"])


#: Three cards a nation: no sign where (page + k) % 7 = 6, a second line of the name where page % 3 = 0, a count where
#: (page + k) % 2 = 0.
CARDS_SQL = r"""
WITH base AS (SELECT CAST(n_nationkey AS BIGINT) AS page, lower(n_name) AS name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
b AS (SELECT *, 100 + 250 * k AS top FROM base, range(3) t(k)),
l AS (
  SELECT page, k * 10 AS seq, '$' AS text, 100 AS x, top AS y, 15 AS w, 40 AS h FROM b WHERE (page + k) % 7 <> 6
  UNION ALL SELECT page, k * 10 + 1, CAST(n + k * 1000 AS VARCHAR), 130, top, 60, 40 FROM b
  UNION ALL SELECT page, k * 10 + 2, CASE WHEN (page + k) % 2 = 0 THEN 'Million' ELSE 'k' END, 200, top + 10, 70, 18 FROM b
  UNION ALL SELECT page, k * 10 + 3, name, 120, top + 70, 120, 18 FROM b
  UNION ALL SELECT page, k * 10 + 4, 'of all', 120, top + 95, 120, 18 FROM b WHERE page % 3 = 0
  UNION ALL SELECT page, k * 10 + 5, CAST(page * 3 + k + 1 AS VARCHAR), 400, top + 20, 40, 18 FROM b WHERE (page + k) % 2 = 0
  UNION ALL SELECT page, k * 10 + 6, 'Accounts', 390, top + 50, 80, 18 FROM b),
c AS (SELECT *, page || '-ocr-' || seq AS id, x + w / 2 AS cx, y + h / 2 AS cy, regexp_full_match(text, '\d[\d,]*') AS num, text IN ('Million', 'k') AS unit FROM l),
un AS (SELECT u.page, u.seq AS u, n.seq AS n FROM c u JOIN c n ON u.page = n.page AND u.unit AND n.num AND n.cx < u.cx + 25 AND n.cy BETWEEN u.y - 25 AND u.y + u.h + 25 QUALIFY row_number() OVER (PARTITION BY u.page, u.seq ORDER BY sqrt(pow(u.cx - n.cx, 2) + pow(u.cy - n.cy, 2)), n.seq) = 1),
us AS (SELECT un.*, s.seq AS s FROM un JOIN c f ON f.page = un.page AND f.seq = un.n JOIN c s ON s.page = un.page AND s.text = '$' AND s.cx < f.cx AND abs(s.cy - f.cy) <= 90 QUALIFY row_number() OVER (PARTITION BY un.page, un.u ORDER BY sqrt(pow(s.cx - f.cx, 2) + pow(s.cy - f.cy, 2)), s.seq) = 1),
cards AS (
  SELECT us.*, f.cy AS middle, f.cx, row_number() OVER w - 1 AS card, coalesce((lag(f.cy) OVER w + f.cy) / 2, f.cy - 140) AS low, coalesce((lead(f.cy) OVER w + f.cy) / 2, f.cy + 180) AS high
  FROM us JOIN c f ON f.page = us.page AND f.seq = us.n WINDOW w AS (PARTITION BY us.page ORDER BY f.cy, f.seq)),
counts AS (
  SELECT a.page, a.card, n.seq AS n, o.seq AS o, n.cx FROM cards a JOIN c n ON n.page = a.page AND n.num AND n.cy BETWEEN a.low AND a.high AND NOT EXISTS (SELECT 1 FROM cards z WHERE z.page = n.page AND z.n = n.seq)
  JOIN c o ON o.page = n.page AND NOT regexp_matches(o.text, '\d') AND NOT o.unit AND o.text <> '$' AND abs(o.cx - n.cx) <= 130 AND o.cy - n.cy BETWEEN 0 AND 100
  QUALIFY row_number() OVER (PARTITION BY a.page, a.card ORDER BY sqrt(pow(o.cx - n.cx, 2) + pow(o.cy - n.cy, 2)), n.seq, o.seq) = 1),
names AS (
  SELECT a.page, a.card, string_agg(r.text, ' ' ORDER BY r.y, r.x) AS series, arg_min(r.id, r.y) AS id FROM cards a LEFT JOIN counts k ON k.page = a.page AND k.card = a.card
  JOIN c r ON r.page = a.page AND NOT r.num AND NOT r.unit AND r.text <> '$' AND r.cy BETWEEN greatest(a.low, a.middle + 45) AND a.high AND abs(r.cx - a.cx) <= 190 AND r.cx < coalesce(k.cx, 1000) - 30 GROUP BY ALL)
SELECT a.page, CAST(a.card AS INTEGER) AS card, series, 'amount' AS label, '$' || f.text || ' ' || lower(u.text) AS value, CAST(f.text AS DOUBLE) * CASE WHEN u.text = 'k' THEN 1e3 ELSE 1e6 END AS normalized, f.id AS value_evidence_id, m.id AS label_evidence_id
FROM cards a JOIN names m USING (page, card) JOIN c f ON f.page = a.page AND f.seq = a.n JOIN c u ON u.page = a.page AND u.seq = a.u
UNION ALL SELECT a.page, CAST(a.card AS INTEGER), series, o.text, n.text, CAST(n.text AS DOUBLE), n.id, o.id FROM cards a JOIN names USING (page, card) JOIN counts k USING (page, card) JOIN c n ON n.page = a.page AND n.seq = k.n JOIN c o ON o.page = a.page AND o.seq = k.o
"""


@query("figure_cards", CARDS_SQL)
def figure_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_nationkey").cast("long").alias("page"), F.lower("n_name").alias("name")).agg(F.count("c_custkey").alias("n"))
    base = counted.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    page, k, at = F.col("page"), F.col("k"), 100 + 250 * F.col("k")
    even = (page + k) % 2 == 0
    made = [
        (0, F.lit("$"), 100, at, 15, 40, (page + k) % 7 != 6),
        (1, (F.col("n") + k * 1000).cast("string"), 130, at, 60, 40, None),
        (2, F.when(even, "Million").otherwise("k"), 200, at + 10, 70, 18, None),
        (3, F.col("name"), 120, at + 70, 120, 18, None),
        (4, F.lit("of all"), 120, at + 95, 120, 18, page % 3 == 0),
        (5, (page * 3 + k + 1).cast("string"), 400, at + 20, 40, 18, even),
        (6, F.lit("Accounts"), 390, at + 50, 80, 18, None),
    ]
    each = F.array(*(F.when(F.lit(True) if where is None else where, F.struct((k * 10 + n).alias("seq"), text.alias("text"), F.lit(x).alias("x"), y.alias("y"), F.lit(w).alias("w"), F.lit(h).alias("h"))) for n, text, x, y, w, h, where in made))
    lines = base.select("page", F.explode(each).alias("r")).where("r IS NOT NULL").select("page", "r.*").withColumn("evidence_id", F.concat("page", F.lit("-ocr-"), "seq"))
    return K.figure_cards(lines, ["page"]).select("page", "card", "series", "label", "value", "normalized", "value_evidence_id", "label_evidence_id")


@query("merged_visuals")
def merged_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = page_regions(evidence_lines(spark, sf_dir)).where("kind IN ('visual', 'unknown')").withColumnRenamed("region", "seq")
    return P.per_page(regions, ["doc_id", "page"], P.merge_visuals, P.VISUAL)


@query("line_paragraphs")
def line_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.per_page(evidence_lines(spark, sf_dir), ["doc_id", "page"], P.paragraphs, P.PARAGRAPH)


@query("bar_bindings")
def bar_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders a year as bars: a mark, a value in thousands and a year below for each."""
    years = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("page"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    k = F.col("year") - 1990
    height = 100 + F.col("n") % 300
    base = years.select("page", "year", "n", (60 + k * 100).alias("at"), height.alias("height"))
    row = lambda role, text, x, y, w, h, n: base.select("page", F.lit(role).alias("role"), (F.col("year") * 4 + n).alias("seq"), F.concat("year", F.lit(f"-ocr-{n}")).alias("evidence_id"), text.alias("text"), x.alias("x"), y.alias("y"), F.lit(w).alias("w"), h.alias("h"))
    at, tall = F.col("at"), F.col("height")
    mark = row("mark", F.lit(""), at, 700 - tall, 40, tall, 0)
    value = row("line", F.concat(F.lit("$"), "n", F.lit("k")), at - 5, 680 - tall, 50, F.lit(18), 1)
    year = row("line", F.col("year").cast("string"), at, F.lit(710), 40, F.lit(18), 2)
    return P.per_page(mark.unionByName(value).unionByName(year), ["page"], P.bar_bindings, P.BAR)

"""Queries over the scalar functions: text, numbers, dates and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import geometry as G
from folioscope.functions import text as T
from folioscope.operators.joins import page_join, prefixed
from folioscope.sources.evidence import EVIDENCE_SQL, PRINTED_SQL, evidence_lines, page_regions, printed_texts, table

from .base import query


@query("clean_text_paragraphs", r"""
WITH a AS (SELECT doc_id, replace(text, chr(173), '') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '([\pL\pN_])-\s*\n\s*([a-z])', '\1\2', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g') AS t FROM b),
d AS (SELECT doc_id, replace(replace(regexp_replace(t, '\n{2,}', chr(1), 'g'), chr(10), ' '), chr(1), chr(10) || chr(10)) AS t FROM c),
e AS (SELECT doc_id, regexp_replace(regexp_replace(t, '^\s+', ''), '\s+$', '') AS t FROM d)
SELECT doc_id, sha256(t) AS sha, CAST(length(t) AS BIGINT) AS chars, CAST(len(string_split(t, chr(10) || chr(10))) AS BIGINT) AS paragraphs FROM e""")
def clean_text_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("t"))
    return cleaned.select("doc_id", F.sha2("t", 256).alias("sha"), F.length("t").cast("long").alias("chars"), F.size(F.split("t", "\n\n")).cast("long").alias("paragraphs"))


NUMERIC = r"""
n AS (SELECT line_id, text, trim(replace(text, ',', '')) AS c,
             TRY_CAST(nullif(regexp_extract(replace(text, ',', ''), '[-+]?\d+(\.\d+)?'), '') AS DOUBLE) AS value FROM printed),
m AS (SELECT *, lower(regexp_extract(c, '(?i)[-+]?\d+(?:\.\d+)?\s*(billion|million|mm|bn|[bmk])\b', 1)) AS scale FROM n),
numeric_values AS (
  SELECT line_id, value,
         CASE WHEN value IS NULL THEN NULL WHEN contains(c, '%') THEN 'percent' WHEN contains(c, '$') THEN 'USD' WHEN lower(c) LIKE '%x' THEN 'multiple' END AS unit,
         CASE WHEN contains(c, '%') THEN value / 100
              WHEN contains(c, '$') THEN value * CASE WHEN scale IN ('b', 'bn', 'billion') THEN 1e9 WHEN scale IN ('m', 'mm', 'million') THEN 1e6 WHEN scale = 'k' THEN 1e3 ELSE 1 END
              ELSE value END AS normalized FROM m)
"""


@query("numeric_value_parse", f"WITH {PRINTED_SQL}, {NUMERIC} SELECT * FROM numeric_values")
def numeric_value_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printed_texts(spark, sf_dir).select("line_id", T.numeric_value(F.col("text")).alias("n")).select("line_id", "n.value", "n.unit", "n.normalized")


@query("signed_number_parse", f"""WITH {PRINTED_SQL},
p AS (SELECT line_id, trim(text) AS t, TRY_CAST(replace(nullif(regexp_extract(text, '[-+]?\\d[\\d,]*(\\.\\d+)?'), ''), ',', '') AS DOUBLE) AS v FROM printed)
SELECT line_id, CASE WHEN t IN ('', '-', '–', '—') THEN NULL WHEN t LIKE '(%' AND t LIKE '%)' THEN -abs(v) ELSE v END AS number FROM p""")
def signed_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printed_texts(spark, sf_dir).select("line_id", T.signed_number(F.col("text")).alias("number"))


@query("scalar_class_flags", rf"""WITH {PRINTED_SQL}
SELECT line_id, regexp_matches(text, '(?i){T.NUMBER}') AS has_number,
       regexp_full_match(text, '(?i){T.TABLE_SCALAR}') AS table_scalar, regexp_full_match(text, '(?i){T.CARD_VALUE}') AS card_value FROM printed""")
def scalar_class_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printed_texts(spark, sf_dir).select("line_id", T.has_number(F.col("text")).alias("has_number"), T.full(F.col("text"), T.TABLE_SCALAR).alias("table_scalar"), T.full(F.col("text"), T.CARD_VALUE).alias("card_value"))


@query("token_agreement", rf"""WITH {EVIDENCE_SQL},
w AS (SELECT doc_id, seq, list_distinct(regexp_extract_all(lower(text), '[\pL\pN_]+')) AS a FROM evidence),
p AS (SELECT l.doc_id, l.seq, l.a, r.a AS b FROM w l JOIN w r ON l.doc_id = r.doc_id AND r.seq = l.seq + 1)
SELECT doc_id, seq, CASE WHEN len(a) > 0 AND len(b) > 0 THEN round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 5) END AS agreement FROM p""")
def token_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir).select("doc_id", "seq", "text")
    after = lines.select("doc_id", (F.col("seq") - 1).alias("seq"), F.col("text").alias("after"))
    return lines.join(after, ["doc_id", "seq"]).select("doc_id", "seq", T.token_agreement(F.col("text"), F.col("after")).alias("agreement"))


@query("key_forms", rf"""WITH {PRINTED_SQL}
SELECT line_id, regexp_replace(lower(text), '[^a-z0-9%$€£.]+', '', 'g') AS evidence_key, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS alnum_key,
       regexp_replace(lower(text), '[^\pL\pN_]+', '', 'g') AS word_key, regexp_replace(lower(text), '\s+', '', 'g') AS cell_key,
       coalesce(nullif(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'document') AS slug FROM printed""")
def key_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printed_texts(spark, sf_dir).select("line_id", T.evidence_key(F.col("text")).alias("evidence_key"), T.alnum_key(F.col("text")).alias("alnum_key"), T.word_key(F.col("text")).alias("word_key"), T.cell_key(F.col("text")).alias("cell_key"), T.slug(F.col("text")).alias("slug"))


ROLE_SQL = rf"""
typed AS (
  SELECT *, CASE WHEN y >= 890 OR (font > 0 AND font <= 8 AND y >= 820) THEN 'footnote'
    WHEN contains(text, '@') OR regexp_matches(text, '\b\d{{3}}[-.) ]\d{{3}}[- ]\d{{4}}\b') THEN 'contact'
    WHEN len(list_filter(regexp_split_to_array(text, '\s+'), lambda v: v <> '')) <= 14 AND NOT regexp_matches(text, '[.,;:]$')
     AND (font >= 14 OR (upper(text) = text AND lower(text) <> text)
          OR (regexp_matches(text, '\p{{Lu}}') AND NOT regexp_matches(text, '\pL\p{{Lu}}') AND NOT regexp_matches(text, '(^|\PL)\p{{Ll}}'))) THEN 'heading'
    ELSE 'text' END AS block_type
  FROM (SELECT *, 6 + seq % 12 AS font FROM evidence))
"""


@query("text_block_type", f"""WITH {EVIDENCE_SQL}, {ROLE_SQL}
SELECT doc_id, seq, block_type, CASE WHEN block_type = 'heading' AND seq % 7 = 0 THEN 'panel_heading'
  WHEN block_type = 'heading' AND y <= 220 THEN CASE WHEN page = 1 THEN 'document_title' ELSE 'page_title' END
  WHEN block_type = 'heading' THEN 'section_heading' WHEN block_type = 'footnote' THEN 'footnote'
  WHEN block_type = 'contact' THEN 'contact_information' ELSE 'body_text' END AS semantic_role FROM typed""")
def text_block_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    typed = lines.withColumn("block_type", T.text_block_type(F.col("text"), F.col("y"), 6 + F.col("seq") % 12))
    return typed.select("doc_id", "seq", "block_type", T.semantic_role(F.col("block_type"), F.col("text"), F.col("y"), F.col("page"), F.col("seq") % 7 == 0).alias("semantic_role"))


@query("block_type_counts", f"WITH {EVIDENCE_SQL}, {ROLE_SQL} SELECT page, block_type, count(*) AS blocks FROM typed GROUP BY ALL")
def block_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return lines.groupBy("page", T.text_block_type(F.col("text"), F.col("y"), 6 + F.col("seq") % 12).alias("block_type")).agg(F.count(F.lit(1)).alias("blocks"))


@query("contact_fields", rf"""WITH {PRINTED_SQL}
SELECT line_id, nullif(regexp_extract(text, '[\pL\pN_.+-]+@[\pL\pN_.-]+\.[A-Za-z]{{2,}}'), '') AS email,
       nullif(regexp_extract(text, '\b(?:\+?1[-. )]*)?\(?\d{{3}}\)?[-. ]\d{{3}}[-. ]\d{{4}}\b'), '') AS phone,
       CASE WHEN NOT regexp_matches(text, '\d') AND regexp_matches(text, '(?i)\b(?:LLC|INC|CORP|LTD|LLP|LP|PLC)\b') THEN text END AS organization FROM printed""")
def contact_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = T.contact_details(F.col("text"))
    suffixed = F.when(F.col("text").rlike(r"(?i)\b(?:LLC|INC|CORP|LTD|LLP|LP|PLC)\b"), F.col("c.organization"))
    return printed_texts(spark, sf_dir).select("line_id", "text", card.alias("c")).select("line_id", "c.email", "c.phone", suffixed.alias("organization"))


#: The range pattern without look-behind, which DuckDB lacks.
RANGE_SQL = r"(?i)(?:^|[^\w.])(\d+(?:\.\d+)?)\s*%?\s*(?:-|–|—|to)\s*(\d+(?:\.\d+)?)\s*%"


@query("percent_mentions", rf"""WITH {PRINTED_SQL},
r AS (SELECT line_id, list_transform(list_zip(regexp_extract_all(text, '{RANGE_SQL}', 1), regexp_extract_all(text, '{RANGE_SQL}', 2)), lambda p: p[1] || '..' || p[2]) AS ranges,
             regexp_extract_all(regexp_replace(text, '{RANGE_SQL}', '|', 'g'), '(?:^|[^\w.])(\d+(?:\.\d+)?)\s*%', 1) AS single FROM printed)
SELECT line_id, array_to_string(ranges, ';') AS ranges, array_to_string(single, ';') AS single, CAST(len(ranges) + len(single) AS BIGINT) AS mentions FROM r""")
def percent_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = printed_texts(spark, sf_dir).select("line_id", T.percent_mentions(F.col("text")).alias("m"))
    plain = lambda v: F.regexp_replace(v.cast("string"), r"\.0$", "")
    ranges = F.transform(F.filter("m", lambda v: v["kind"] == "range"), lambda v: F.concat(plain(v["low"]), F.lit(".."), plain(v["high"])))
    single = F.transform(F.filter("m", lambda v: v["kind"] == "value"), lambda v: plain(v["low"]))
    return found.select("line_id", F.array_join(ranges, ";").alias("ranges"), F.array_join(single, ";").alias("single"), F.size("m").cast("long").alias("mentions"))


@query("as_of_date", rf"""WITH {PRINTED_SQL},
d AS (SELECT line_id, TRY_CAST(regexp_extract(text, '\b(\d{{1,2}})/(\d{{1,2}})/(\d{{2,4}})\b', 1) AS INT) AS m, TRY_CAST(regexp_extract(text, '\b(\d{{1,2}})/(\d{{1,2}})/(\d{{2,4}})\b', 2) AS INT) AS d,
             TRY_CAST(regexp_extract(text, '\b(\d{{1,2}})/(\d{{1,2}})/(\d{{2,4}})\b', 3) AS INT) AS y FROM printed)
SELECT line_id, m IS NOT NULL AS found, CAST(TRY_CAST(printf('%04d-%02d-%02d', CASE WHEN y < 100 THEN y + 2000 ELSE y END, m, d) AS DATE) AS VARCHAR) AS as_of FROM d""")
def as_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return printed_texts(spark, sf_dir).select("line_id", T.as_of_date(F.col("text")).alias("d")).select("line_id", "d.found", F.col("d.date").cast("string").alias("as_of"))


@query("layout_glyphs", rf"""WITH words AS (SELECT doc_id, i, w FROM (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS w, unnest(range(len(regexp_split_to_array(text, '\s+')))) AS i FROM documents WHERE text IS NOT NULL))
SELECT doc_id, count(*) FILTER (regexp_full_match(trim(w), '[�|~/•→&]{{1,2}}')) AS glyphs, count(*) FILTER (trim(w) IN ('•', '●', '▪', '◦', '‣', '►', '▸', '➢', '➤', '-', '–', '*')) AS bullets FROM words GROUP BY 1""")
def layout_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.explode(F.split("text", r"\s+")).alias("w"))
    count = lambda c: F.sum(c.cast("long"))
    return words.groupBy("doc_id").agg(count(T.is_layout_glyph(F.lit("native_pdf_word"), F.col("w"))).alias("glyphs"), count(T.is_bullet(F.col("w"))).alias("bullets"))


@query("box_overlaps", f"""WITH {EVIDENCE_SQL},
p AS (SELECT a.doc_id, a.page, a.region AS left_region, b.region AS right_region, a.x AS ax, a.y AS ay, a.w AS aw, a.h AS ah, b.x AS x2, b.y AS y2, b.w AS w2, b.h AS h2
      FROM regions a JOIN regions b ON a.doc_id = b.doc_id AND a.page = b.page AND a.region < b.region),
i AS (SELECT *, greatest(0, least(ax + aw, x2 + w2) - greatest(ax, x2)) * greatest(0, least(ay + ah, y2 + h2) - greatest(ay, y2)) AS shared FROM p)
SELECT doc_id, page, left_region, right_region, round(shared / greatest(1, least(aw * ah, w2 * h2)), 9) AS of_smaller, round(shared / (w2 * h2), 9) AS of_right,
       round(greatest(0, least(ax + aw, x2 + w2) - greatest(ax, x2)) / greatest(1, least(aw, w2)), 9) AS of_width,
       round(sqrt(pow(ax + aw / 2 - x2 - w2 / 2, 2) + pow(ay + ah / 2 - y2 - h2 / 2, 2)), 6) AS distance,
       abs(ax + aw / 2 - x2 - w2 / 2) < 15 AND abs(ay + ah / 2 - y2 - h2 / 2) < 15 AS same_place FROM i WHERE shared > 0""")
def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = page_regions(evidence_lines(spark, sf_dir))
    keys = ["doc_id", "page"]
    left, right = prefixed(regions, "a_", keys), prefixed(regions, "b_", keys)
    a, b = G.box("a_"), G.box("b_")
    pairs = page_join(left, right, keys, F.col("a_region") < F.col("b_region")).where(G.intersection(a, b) > 0)
    return pairs.select(
        *keys,
        F.col("a_region").alias("left_region"),
        F.col("b_region").alias("right_region"),
        F.round(G.overlap_of_smaller(a, b), 9).alias("of_smaller"),
        F.round(G.coverage(a, b), 9).alias("of_right"),
        F.round(G.projection_overlap(a.x, a.right, b.x, b.right), 9).alias("of_width"),
        F.round(G.distance(a, b), 6).alias("distance"),
        G.same_place(a, b).alias("same_place"),
    )


@query("normalized_boxes", """
WITH s AS (SELECT s_suppkey AS k, s_suppkey * 37 % 800 - 60 AS x0, s_suppkey * 53 % 900 - 40 AS y0, s_suppkey * 37 % 800 - 60 + 30 + s_suppkey % 200 AS x1, s_suppkey * 53 % 900 - 40 + 20 + s_suppkey % 90 AS y1 FROM supplier),
c AS (SELECT k, x0, y0, x1, y1, least(greatest(x0 * 1000 / 612, 0), 1000) AS x, least(greatest(y0 * 1000 / 792, 0), 1000) AS y FROM s)
SELECT k, round(x, 6) AS x, round(y, 6) AS y, round(least(greatest((x1 - x0) * 1000 / 612, 0), 1000 - x), 6) AS w, round(least(greatest((y1 - y0) * 1000 / 792, 0), 1000 - y), 6) AS h,
       round(least(greatest(x1 * 1000 / 612, 0), 1000) - x, 6) AS corner_w,
       x0 >= 0 AND x0 < x1 AND x1 <= 1000 AND y0 >= 0 AND y0 < y1 AND y1 <= 1000 AS proposal_valid FROM c""")
def normalized_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    x0, y0 = k * 37 % 800 - 60, k * 53 % 900 - 40
    x1, y1 = x0 + 30 + k % 200, y0 + 20 + k % 90
    width, height = F.lit(612), F.lit(792)
    exact, clamped = G.normalized(x0, y0, x1, y1, width, height), G.clamped_corners(x0, y0, x1, y1, width, height)
    return table(spark, sf_dir, "supplier").select(k.alias("k"), *(F.round(v, 6).alias(n) for n, v in zip("xywh", exact, strict=True)), F.round(clamped.w, 6).alias("corner_w"), G.proposal_box(x0, y0, x1, y1).isNotNull().alias("proposal_valid"))


@query("map_projections", """
WITH p AS (SELECT s_suppkey AS k, -125 + s_suppkey % 58 AS lon, 25 + s_suppkey % 24 AS lat, (sin(radians(29.5)) + sin(radians(45.5))) / 2 AS n FROM supplier),
c AS (SELECT *, pow(cos(radians(29.5)), 2) + 2 * n * sin(radians(29.5)) AS c FROM p)
SELECT k, round(ln(tan(pi() / 4 + radians(lat) / 2)), 6) AS mercator_y,
       round(sqrt(c - 2 * n * sin(radians(lat))) / n * sin(n * (radians(lon) - radians(-96))), 6) AS albers_x,
       round(sqrt(c - 2 * n * sin(radians(37.5))) / n - sqrt(c - 2 * n * sin(radians(lat))) / n * cos(n * (radians(lon) - radians(-96))), 6) AS albers_y FROM c""")
def map_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    lon, lat = (-125 + k % 58).cast("double"), (25 + k % 24).cast("double")
    x, y = G.albers(lon, lat)
    return table(spark, sf_dir, "supplier").select(k.alias("k"), F.round(G.mercator_y(lat), 6).alias("mercator_y"), F.round(x, 6).alias("albers_x"), F.round(y, 6).alias("albers_y"))


@query("text_structure")
def text_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", T.text_structures(F.col("text")).alias("s"))
    return found.select("doc_id", F.size("s.paragraphs").alias("paragraphs"), "s.intro", "s.ordered", F.size("s.items").alias("items"))

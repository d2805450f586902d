"""Queries over lossless capture and source observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import capture as C
from folioscope.operators import ownership as own
from folioscope.sources.evidence import CHART_SQL, EVIDENCE_SQL, chart_lines, evidence_lines, page_regions

from .base import query
from .evidence import CONTENT_SQL, OWNER_SQL, region_content

PAGE = ["doc_id", "page"]

#: The first word of every third line as a native word (every sixth with a letter more), and layout texts that join the
#: lines 5, 15, ... with the next.
OBS_SQL = """
obs AS (
  SELECT doc_id, page, 'w' || seq AS obs, 'native_pdf_word' AS source, string_split(text, ' ')[1] || CASE WHEN seq % 6 = 0 THEN 'q' ELSE '' END AS text, x, y, CAST(8 * length(string_split(text, ' ')[1]) AS BIGINT) AS w, h FROM evidence WHERE seq % 3 = 0
  UNION ALL
  SELECT a.doc_id, a.page, 'p' || a.seq, 'layout_text', a.text || CASE WHEN a.seq % 20 = 5 THEN ' ' || b.text ELSE repeat(' zz', 60) END, 40, a.y - 4, 900, 60
  FROM evidence a JOIN evidence b ON a.doc_id = b.doc_id AND a.page = b.page AND b.seq = a.seq + 1 WHERE a.seq % 10 = 5)
"""


def observations(lines: DataFrame) -> DataFrame:
    """Surrogate observations of a page: native words of every third line and wide texts over every tenth, which leave
    gaps on purpose. They are matched with all lines."""
    word = F.get(F.split("text", " "), F.lit(0))
    words = lines.where("seq % 3 = 0").select(*PAGE, F.concat(F.lit("w"), "seq").alias("obs"), F.lit("native_pdf_word").alias("source"), F.concat(word, F.when(F.col("seq") % 6 == 0, "q").otherwise("")).alias("text"), "x", "y", (8 * F.length(word)).cast("long").alias("w"), "h")
    after = lines.select(*PAGE, (F.col("seq") - 1).alias("seq"), F.col("text").alias("after"))
    pairs = lines.where("seq % 10 = 5").join(after, [*PAGE, "seq"])
    more = F.when(F.col("seq") % 20 == 5, F.concat(F.lit(" "), "after")).otherwise(F.repeat(F.lit(" zz"), F.lit(60)))
    wide = pairs.select(*PAGE, F.concat(F.lit("p"), "seq").alias("obs"), F.lit("layout_text").alias("source"), F.concat("text", more).alias("text"), F.lit(40).cast("long").alias("x"), (F.col("y") - 4).alias("y"), F.lit(900).cast("long").alias("w"), F.lit(60).cast("long").alias("h"))
    return words.unionByName(wide)


MATCH_SQL = f"""
{OBS_SQL},
near AS (
  SELECT o.doc_id, o.page, o.obs, o.source, regexp_replace(lower(o.text), '[^a-z0-9]', '', 'g') AS key, e.evidence_id, regexp_replace(lower(e.text), '[^a-z0-9]', '', 'g') AS line,
         list_transform(regexp_extract_all(e.text, '[\\pL\\pN_]+'), lambda t: regexp_replace(lower(t), '[^a-z0-9]', '', 'g')) AS tokens
  FROM obs o JOIN evidence e ON o.doc_id = e.doc_id AND o.page = e.page
   AND ((e.x + e.w / 2 BETWEEN o.x - 14 AND o.x + o.w + 14 AND e.y + e.h / 2 BETWEEN o.y - 14 AND o.y + o.h + 14)
     OR (o.x + o.w / 2 BETWEEN e.x - 14 AND e.x + e.w + 14 AND o.y + o.h / 2 BETWEEN e.y - 14 AND e.y + e.h + 14))
  WHERE regexp_replace(lower(o.text), '[^a-z0-9]', '', 'g') <> ''),
parts AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id, page, obs) >= 0.6 * length(key) AS enough FROM near WHERE source <> 'native_pdf_word' AND length(line) >= 3 AND contains(key, line)),
matched AS (
  SELECT doc_id, page, obs, evidence_id FROM near WHERE source = 'native_pdf_word' AND (list_contains(tokens, key) OR (length(key) >= 4 AND contains(line, key)))
  UNION ALL SELECT doc_id, page, obs, evidence_id FROM parts WHERE enough)
"""


@query("native_word_match", f"WITH {EVIDENCE_SQL}, {MATCH_SQL} SELECT * FROM matched")
def native_word_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return C.match_observations(observations(lines), lines, PAGE)


@query("observation_dispositions", f"""{CONTENT_SQL}, {MATCH_SQL},
around AS (
  SELECT o.doc_id, o.page, o.obs, c.region AS block, c.text AS content FROM obs o JOIN content c ON o.doc_id = c.doc_id AND o.page = c.page
   AND o.x + o.w / 2 BETWEEN c.x - 8 AND c.x + c.w + 8 AND o.y + o.h / 2 BETWEEN c.y - 8 AND c.y + c.h + 8
  QUALIFY row_number() OVER (PARTITION BY o.doc_id, o.page, o.obs ORDER BY c.w * c.h, c.region) = 1),
f AS (
  SELECT o.*, a.block, a.content, regexp_replace(lower(o.text), '[^a-z0-9]', '', 'g') AS key, EXISTS (SELECT 1 FROM matched m WHERE m.doc_id = o.doc_id AND m.page = o.page AND m.obs = o.obs) AS hit
  FROM obs o LEFT JOIN around a ON o.doc_id = a.doc_id AND o.page = a.page AND o.obs = a.obs)
SELECT doc_id, page, obs, CASE WHEN hit THEN 'matched_ocr' WHEN block IS NULL THEN 'fallback_text'
  WHEN length(key) >= 2 AND CASE WHEN source = 'native_pdf_word' THEN list_contains(list_transform(regexp_split_to_array(content, '\\s+'), lambda t: regexp_replace(lower(t), '[^a-z0-9]', '', 'g')), key)
       ELSE length(key) >= 5 AND contains(regexp_replace(lower(content), '[^a-z0-9]', '', 'g'), key) END THEN 'content_supported'
  WHEN source = 'native_pdf_word' AND regexp_full_match(trim(text), '[�|~/•→&]{{1,2}}') THEN 'verbatim_glyph' ELSE 'raw_attached' END AS disposition, CASE WHEN NOT hit THEN block END AS block FROM f""")
def observation_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    asked = observations(lines)
    blocks = region_content(lines).withColumnRenamed("region", "block").withColumnRenamed("text", "content")
    return C.observation_dispositions(asked, C.match_observations(asked, lines, PAGE), blocks, PAGE)


@query("line_capture", f"""{CONTENT_SQL},
held AS (SELECT *, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS key FROM content),
l AS (SELECT e.*, o.region AS block, regexp_replace(lower(e.text), '[^a-z0-9]', '', 'g') AS key FROM evidence e LEFT JOIN owners o USING (doc_id, page, seq)),
near AS (SELECT l.doc_id, l.page, l.seq, min(h.region) AS near FROM l JOIN held h ON l.doc_id = h.doc_id AND l.page = h.page AND l.x + l.w / 2 BETWEEN h.x - 10 AND h.x + h.w + 10 AND l.y + l.h / 2 BETWEEN h.y - 10 AND h.y + h.h + 10 AND contains(h.key, l.key)
         WHERE l.block IS NULL AND length(l.key) >= 3 GROUP BY ALL HAVING count(*) = 1)
SELECT l.doc_id, l.page, l.seq, coalesce(l.block, near) AS block, CASE WHEN l.block IS NOT NULL AND coalesce(contains(h.key, l.key), false) THEN 'structured' WHEN l.block IS NOT NULL THEN 'raw_evidence' WHEN near IS NOT NULL THEN 'structured_nearby' ELSE 'fallback' END AS capture
FROM l LEFT JOIN held h ON l.doc_id = h.doc_id AND l.page = h.page AND l.block = h.region LEFT JOIN near n ON l.doc_id = n.doc_id AND l.page = n.page AND l.seq = n.seq""")
def line_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    owners = own.region_owner(lines, page_regions(lines)).withColumnRenamed("region", "block")
    blocks = region_content(lines).withColumnRenamed("region", "block").withColumnRenamed("text", "content")
    return C.capture_lines(lines, owners, blocks, PAGE)


@query("suppressed_duplicates", f"""WITH {CHART_SQL},
c AS (SELECT l.page, l.slot, l.text AS label, v.text AS value, least(l.x, v.x) AS x, 200 AS y, 160 AS w, 48 AS h FROM chart l JOIN chart v ON l.page = v.page AND l.slot = v.slot AND l.role = 'label' AND v.role = 'value'),
t AS (SELECT page, slot, CASE WHEN slot % 2 = 0 THEN label ELSE label || ' ' || value END AS text, x + (page * 13 + slot * 7) % 300 AS x, 210 AS y, 100 AS w, 18 AS h FROM c)
SELECT page, slot, text FROM t WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.page = t.page AND regexp_replace(lower(t.text), '[^\\pL\\pN_]+', '', 'g') IN (regexp_replace(lower(label), '[^\\pL\\pN_]+', '', 'g'), regexp_replace(lower(value), '[^\\pL\\pN_]+', '', 'g'), regexp_replace(lower(label || ' ' || value), '[^\\pL\\pN_]+', '', 'g'))
  AND (greatest(least(t.x + t.w, c.x + c.w) - greatest(t.x, c.x), 0) * greatest(least(t.y + t.h, c.y + c.h) - greatest(t.y, c.y), 0) / greatest(least(t.w * t.h, c.w * c.h), 1) >= 0.5
    OR sqrt(pow(t.x + t.w / 2 - c.x - c.w / 2, 2) + pow(t.y + t.h / 2 - c.y - c.h / 2, 2)) <= greatest(60, c.w, c.h)))""")
def suppressed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chart_lines(spark, sf_dir)
    label = lines.where("role = 'label'").select("page", "slot", F.col("text").alias("label"), F.col("x").alias("lx"))
    value = lines.where("role = 'value'").select("page", "slot", F.col("text").alias("value"), F.col("x").alias("vx"))
    claims = label.join(value, ["page", "slot"]).select("page", "slot", "label", "value", F.least("lx", "vx").alias("x"), F.lit(200).alias("y"), F.lit(160).alias("w"), F.lit(48).alias("h"))
    text = F.when(F.col("slot") % 2 == 0, F.col("label")).otherwise(F.concat_ws(" ", "label", "value"))
    texts = claims.select("page", "slot", text.alias("text"), (F.col("x") + (F.col("page") * 13 + F.col("slot") * 7) % 300).alias("x"), F.lit(210).alias("y"), F.lit(100).alias("w"), F.lit(18).alias("h"))
    return C.suppress_duplicates(texts, claims, ["page"]).select("page", "slot", "text")


@query("duplicate_native_words", f"""WITH {EVIDENCE_SQL}, {OBS_SQL}
SELECT doc_id, page, obs FROM obs o WHERE source = 'native_pdf_word' AND len(regexp_extract_all(lower(text), '[\\pL\\pN_]+')) > 0 AND EXISTS (
  SELECT 1 FROM evidence p WHERE p.doc_id = o.doc_id AND p.page = o.page AND length(p.text) >= 20 AND o.x + o.w / 2 BETWEEN p.x - 15 AND p.x + p.w + 15 AND o.y + o.h / 2 BETWEEN p.y - 18 AND p.y + p.h + 18
   AND contains(' ' || array_to_string(regexp_extract_all(lower(p.text), '[\\pL\\pN_]+'), ' ') || ' ', ' ' || array_to_string(regexp_extract_all(lower(o.text), '[\\pL\\pN_]+'), ' ') || ' '))""")
def duplicate_native_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return C.duplicate_words(lines, observations(lines).where("source = 'native_pdf_word'"), PAGE).select(*PAGE, "obs")

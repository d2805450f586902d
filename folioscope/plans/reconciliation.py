"""Queries over proposals, claims and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import reconcile as R
from folioscope.sources.evidence import CHART_SQL, CLAIMS_SQL, EVIDENCE_SQL, SEGMENTS, chart_claims, chart_lines, evidence_lines, page_regions, table

from .base import query
from .tables import CELLS_SQL, status_cells

PAGE = ["doc_id", "page"]

PROPOSALS_SQL = """
proposals AS (
  SELECT doc_id, page, region AS proposal, CASE WHEN (doc_id + region) % 7 = 0 THEN 'table' ELSE kind END AS type,
         least(x + doc_id % 5 * 40, 1000) AS x, y + 20 AS y, w, h, region % 4 AS n_rows, (doc_id + region) % 5 AS n_items
  FROM regions WHERE region % 3 = 0)
"""


def proposals(regions: DataFrame) -> DataFrame:
    """Every third region proposed, moved to the right by up to 160 and 20 down; one in seven as a table."""
    kind = F.when((F.col("doc_id") + F.col("region")) % 7 == 0, "table").otherwise(F.col("kind"))
    return regions.where("region % 3 = 0").select(*PAGE, F.col("region").alias("proposal"), kind.alias("type"), F.least(F.col("x") + F.col("doc_id") % 5 * 40, F.lit(1000)).alias("x"), (F.col("y") + 20).alias("y"), "w", "h", (F.col("region") % 4).alias("n_rows"), ((F.col("doc_id") + F.col("region")) % 5).alias("n_items"))


PARENTS_SQL = f"""
WITH {EVIDENCE_SQL}, {PROPOSALS_SQL},
met AS (
  SELECT p.doc_id, p.page, p.proposal, b.region AS block,
         greatest(least(p.x + p.w, b.x + b.w) - greatest(p.x, b.x), 0) * greatest(least(p.y + p.h, b.y + b.h) - greatest(p.y, b.y), 0) / greatest(least(p.w * p.h, b.w * b.h), 1) AS share
  FROM proposals p JOIN regions b ON p.doc_id = b.doc_id AND p.page = b.page AND p.type = b.kind),
parents AS (SELECT doc_id, page, proposal, block FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, proposal ORDER BY share DESC, block) AS rn FROM met WHERE share >= 0.35) WHERE rn = 1)
"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    regions = page_regions(evidence_lines(spark, sf_dir))
    return proposals(regions), regions.withColumnRenamed("region", "block").withColumnRenamed("kind", "type")


@query("parent_block", PARENTS_SQL + "SELECT * FROM parents")
def parent_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.parents(*_sides(spark, sf_dir), PAGE, "proposal")


@query("missing_table_proposals", PARENTS_SQL + "SELECT doc_id, page, proposal FROM proposals ANTI JOIN parents USING (doc_id, page, proposal) WHERE type = 'table' AND n_rows >= 2")
def missing_table_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.missing_tables(*_sides(spark, sf_dir), PAGE, "proposal").select(*PAGE, "proposal")


@query("region_hints", f"""WITH {EVIDENCE_SQL}, {PROPOSALS_SQL},
met AS (
  SELECT p.doc_id, p.page, b.region, p.proposal, p.type, p.n_items,
         greatest(least(p.x + p.w, b.x + b.w) - greatest(p.x, b.x), 0) * greatest(least(p.y + p.h, b.y + b.h) - greatest(p.y, b.y), 0) / least(p.w * p.h, b.w * b.h) AS share
  FROM proposals p JOIN regions b ON p.doc_id = b.doc_id AND p.page = b.page AND b.kind = 'visual' WHERE p.n_items >= 2)
SELECT doc_id, page, region, type AS hint FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, region ORDER BY share DESC, n_items DESC, proposal) AS rn FROM met WHERE share >= 0.55) WHERE rn = 1""")
def region_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = page_regions(evidence_lines(spark, sf_dir))
    return R.hint_regions(proposals(regions), regions, PAGE)


#: Printed lines of the charts: labels of slot 4 in two lines (page % 3 = 1) and of slot 3 in three (page % 3 = 2);
#: percentages below the values (page % 3 = 0); values of slots 0 and 1 printed again (page % 4 = 2), out of the proposals'
#: box and in it. Blocks: one a page, but none on pages 4, 9, ...; panels of figures where page % 7 = 3, pies where
#: page % 3 = 0. Observations name the segment after next where (page * slot) % 4 = 1; where (page + 3 * slot) % 8 = 2 they
#: are missing, or on pies hold the percentage, which on even pages has the amount as companion. A block owns all lines but
#: the values of slot 3.
ITEMS_SQL = f"""
WITH {CHART_SQL}, {CLAIMS_SQL},
cl AS (
  SELECT page, seq, evidence_id, text, x, y, w, h FROM chart WHERE NOT (role = 'label' AND (slot = 4 AND page % 3 = 1 OR slot = 3 AND page % 3 = 2))
  UNION ALL SELECT page, 50 + k, page || '-ocr-l4' || k, part, x, 176 + 24 * k, 60, 18 FROM chart, (VALUES (0, 'MACHI'), (1, 'NERY')) t(k, part) WHERE role = 'label' AND slot = 4 AND page % 3 = 1
  UNION ALL SELECT page, 60 + k, page || '-ocr-l3' || k, part, x, 152 + 24 * k, 60, 18 FROM chart, (VALUES (0, 'HOUSE'), (1, 'HO'), (2, 'LD')) t(k, part) WHERE role = 'label' AND slot = 3 AND page % 3 = 2
  UNION ALL SELECT page, 100 + slot, page || '-ocr-p' || slot, (10 + slot) || '.5%', x + 10, 252, 40, 18 FROM chart WHERE role = 'value' AND page % 3 = 0
  UNION ALL SELECT page, 200 + slot, page || '-ocr-d' || slot, text, CASE WHEN slot = 0 THEN x ELSE 900 END, CASE WHEN slot = 0 THEN 800 ELSE 300 END, 60, 18 FROM chart WHERE role = 'value' AND page % 4 = 2 AND slot <= 1),
seen AS (
  SELECT v.page AS block, v.slot AS obs, v.evidence_id AS vid, v.text AS raw, CASE WHEN (v.page * v.slot) % 4 = 1 THEN (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[(v.slot + 2) % 5 + 1] ELSE l.text END AS name, NULL AS craw, NULL AS cid
  FROM chart v JOIN chart l ON v.page = l.page AND v.slot = l.slot AND v.role = 'value' AND l.role = 'label' WHERE v.page % 5 <> 4 AND (v.page + 3 * v.slot) % 8 <> 2
  UNION ALL
  SELECT v.page, v.slot, v.page || '-ocr-p' || v.slot, (10 + v.slot) || '.5%', l.text, CASE WHEN v.page % 2 = 0 THEN v.text END, CASE WHEN v.page % 2 = 0 THEN v.evidence_id END
  FROM chart v JOIN chart l ON v.page = l.page AND v.slot = l.slot AND v.role = 'value' AND l.role = 'label' WHERE v.page % 5 <> 4 AND v.page % 3 = 0 AND (v.page + 3 * v.slot) % 8 = 2),
obs AS (SELECT block, obs, vid, cid, regexp_replace(lower(raw), '[^a-z0-9%$€£.]+', '', 'g') AS rk, regexp_replace(lower(coalesce(craw, '')), '[^a-z0-9%$€£.]+', '', 'g') AS ck, CASE WHEN block % 7 = 3 THEN 'total' ELSE lower(name) END AS category, CASE WHEN block % 7 = 3 THEN lower(name) ELSE '' END AS series FROM seen),
keyed AS (SELECT *, regexp_replace(lower(text), '[^a-z0-9%$€£.]+', '', 'g') AS key FROM cl WHERE x + w / 2 BETWEEN -15 AND 1015 AND y + h / 2 BETWEEN 135 AND 365),
c AS (SELECT *, regexp_replace(lower(value), '[^a-z0-9%$€£.]+', '', 'g') AS vk, regexp_replace(lower(label), '[^a-z0-9%$€£.]+', '', 'g') AS lk, CASE WHEN page % 7 = 3 THEN 'kpi_panel' ELSE 'chart' END AS type, CASE WHEN page % 5 <> 4 THEN page END AS block FROM claims),
v1 AS (SELECT c.page, c.slot, k.evidence_id, k.text, k.x, k.y, k.w, k.h FROM c JOIN keyed k ON c.page = k.page AND c.vk = k.key QUALIFY count(*) OVER (PARTITION BY c.page, c.slot) = 1),
l1 AS (SELECT c.page, c.slot, [k.evidence_id] AS ids, k.x, k.y, k.w, k.h FROM c JOIN keyed k ON c.page = k.page AND c.lk = k.key QUALIFY count(*) OVER (PARTITION BY c.page, c.slot) = 1),
pool AS (SELECT c.page, c.slot, c.lk, k.key, k.evidence_id AS id, k.seq, k.x, k.y, k.w, k.h FROM c JOIN v1 USING (page, slot) ANTI JOIN l1 USING (page, slot) JOIN keyed k ON c.page = k.page AND regexp_matches(k.text, '[A-Za-z]') AND abs(k.x + k.w / 2 - v1.x - v1.w / 2) <= 170 AND k.y BETWEEN v1.y - 150 AND v1.y + 20),
two AS (SELECT a.page, a.slot, [a.id, b.id] AS ids, least(a.x, b.x) AS x, a.y, greatest(a.x + a.w, b.x + b.w) - least(a.x, b.x) AS w, b.y + b.h - a.y AS h FROM pool a JOIN pool b ON a.page = b.page AND a.slot = b.slot AND (a.y, a.x, a.seq) < (b.y, b.x, b.seq) AND b.y - a.y <= 100 AND a.key || b.key = a.lk),
three AS (SELECT a.page, a.slot, [a.id, b.id, c.id] AS ids, least(a.x, b.x, c.x) AS x, a.y, greatest(a.x + a.w, b.x + b.w, c.x + c.w) - least(a.x, b.x, c.x) AS w, c.y + c.h - a.y AS h FROM pool a JOIN pool b ON a.page = b.page AND a.slot = b.slot AND (a.y, a.x, a.seq) < (b.y, b.x, b.seq) JOIN pool c ON a.page = c.page AND a.slot = c.slot AND (b.y, b.x, b.seq) < (c.y, c.x, c.seq) AND c.y - a.y <= 100 AND a.key || b.key || c.key = a.lk WHERE NOT EXISTS (SELECT 1 FROM two t WHERE t.page = a.page AND t.slot = a.slot)),
l2 AS (SELECT * FROM l1 UNION ALL SELECT * FROM (SELECT * FROM two UNION ALL SELECT * FROM three) QUALIFY count(*) OVER (PARTITION BY page, slot) = 1),
f AS (
  SELECT c.*, v1.evidence_id AS v_id, v1.text AS v_text, v1.x AS vx, v1.y AS vy, v1.w AS vw, v1.h AS vh, l2.ids,
         coalesce(abs(l2.x + l2.w / 2 - v1.x - v1.w / 2) <= greatest(90.0, (l2.w + v1.w) * 0.65) AND v1.y - l2.y - l2.h BETWEEN -25 AND 150, false) AS pair_printed,
         coalesce(ids IS NOT NULL AND v1.evidence_id NOT LIKE '%-ocr-v3', false) AS both_owned
  FROM c LEFT JOIN v1 USING (page, slot) LEFT JOIN l2 USING (page, slot)),
m AS (
  SELECT f.page, f.slot, count(*) AS n, count(*) FILTER (o.vid = f.v_id OR o.cid = f.v_id) AS m, min(struct_pack(o := o.obs, category := o.category, series := o.series)) AS any_claim, min(struct_pack(o := o.obs, category := o.category, series := o.series)) FILTER (o.vid = f.v_id OR o.cid = f.v_id) AS own_claim
  FROM f JOIN obs o ON f.block = o.block AND (f.vk = o.rk OR f.vk = o.ck) GROUP BY ALL),
st AS (
  SELECT f.page, f.slot, min(p.evidence_id) AS pid FROM f JOIN cl p ON f.page = p.page AND p.evidence_id LIKE '%-ocr-p%' AND abs(p.x + p.w / 2 - f.vx - f.vw / 2) <= 75 AND p.y - f.vy - f.vh BETWEEN -12 AND 75
  WHERE f.pair_printed AND f.type = 'chart' AND f.page % 3 = 0 AND f.block IS NOT NULL GROUP BY ALL HAVING count(*) = 1),
sk AS (SELECT st.*, o.cid FROM st JOIN obs o ON o.block = st.page AND o.vid = st.pid),
g AS (
  SELECT f.*, pid, cid, coalesce(CASE WHEN n > 1 AND v_id IS NOT NULL THEN m ELSE n END, 0) AS matches, CASE WHEN n > 1 AND v_id IS NOT NULL THEN own_claim ELSE any_claim END AS claim
  FROM f LEFT JOIN m USING (page, slot) LEFT JOIN sk USING (page, slot)),
decided AS (
  SELECT page, slot, CASE WHEN block IS NULL THEN 'no_matching_source_block'
    WHEN matches <> 1 AND pair_printed AND both_owned AND pid IS NOT NULL AND cid IS NULL THEN 'printed_amount_attached_to_percentage'
    WHEN matches <> 1 AND v_id IS NOT NULL THEN 'printed_vision_value_missing_or_ambiguous_in_source_block'
    WHEN matches <> 1 THEN 'vision_value_not_uniquely_printed'
    WHEN claim.category = lk OR type = 'kpi_panel' AND claim.series = lk THEN 'agreement'
    WHEN type <> 'chart' OR NOT pair_printed THEN 'ownership_disagreement_needs_review'
    WHEN NOT both_owned THEN 'printed_pair_outside_block_ownership'
    ELSE 'label_corrected_from_printed_pair' END AS decision, v_id AS value_evidence_id, ids[1] AS label_evidence_id, array_to_string(ids, ',') AS label_evidence_ids, pair_printed, pid FROM g),
final AS (SELECT * EXCLUDE (pid), CASE WHEN decision IN ('agreement', 'label_corrected_from_printed_pair', 'printed_amount_attached_to_percentage') THEN pid END AS percentage_evidence_id FROM decided)
"""


def _printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = chart_lines(spark, sf_dir)
    page, slot, x = F.col("page"), F.col("slot"), F.col("x")
    two, three = (slot == 4) & (page % 3 == 1), (slot == 3) & (page % 3 == 2)
    labels, values = chart.where("role = 'label'"), chart.where("role = 'value'")
    row = lambda frame, seq, mark, text, x, y, w: frame.select("page", seq.cast("long").alias("seq"), F.concat(page, F.lit("-ocr-"), mark).alias("evidence_id"), text.alias("text"), x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(w).cast("long").alias("w"), F.lit(18).cast("long").alias("h"))

    def parts(where, words, seq, mark, top):
        cut = labels.where(where).select("page", "x", F.posexplode(F.array(*map(F.lit, words))).alias("k", "part"))
        return row(cut, seq + F.col("k"), F.concat(F.lit(mark), "k"), F.col("part"), x, top + 24 * F.col("k"), 60)

    plain = chart.where(~((F.col("role") == "label") & (two | three))).select("page", "seq", "evidence_id", "text", "x", "y", "w", "h")
    below = row(values.where("page % 3 = 0"), 100 + slot, F.concat(F.lit("p"), slot), F.concat(10 + slot, F.lit(".5%")), x + 10, F.lit(252), 40)
    again = row(values.where("page % 4 = 2 AND slot <= 1"), 200 + slot, F.concat(F.lit("d"), slot), F.col("text"), F.when(slot == 0, x).otherwise(900), F.when(slot == 0, 800).otherwise(300), 60)
    found = plain.unionByName(parts(two, ("MACHI", "NERY"), 50, "l4", 176)).unionByName(parts(three, ("HOUSE", "HO", "LD"), 60, "l3", 152))
    return found.unionByName(below).unionByName(again).withColumn("conf", F.lit(90))


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = chart_lines(spark, sf_dir).where("page % 5 <> 4")
    label = chart.where("role = 'label'").select("page", "slot", F.col("text").alias("label"))
    page, slot = F.col("page"), F.col("slot")
    values = chart.where("role = 'value'").join(label, ["page", "slot"]).withColumn("gone", (page + 3 * slot) % 8 == 2).where(~F.col("gone") | (page % 3 == 0))
    wrong = F.element_at(F.array(*(F.lit(s) for s in SEGMENTS)), ((slot + 2) % 5 + 1).cast("int"))
    name = F.when(~F.col("gone") & (page * slot % 4 == 1), wrong).otherwise(F.col("label"))
    panel, side = page % 7 == 3, F.col("gone") & (page % 2 == 0)
    return values.select(
        page.alias("block"),
        slot.alias("obs"),
        F.when(panel, "total").otherwise(name).alias("category"),
        F.when(panel, name).alias("series"),
        F.when(F.col("gone"), F.concat(10 + slot, F.lit(".5%"))).otherwise(F.col("text")).alias("raw_value"),
        F.when(F.col("gone"), F.concat(page, F.lit("-ocr-p"), slot)).otherwise(F.col("evidence_id")).alias("value_evidence_id"),
        F.when(side, F.col("text")).alias("companion_raw"),
        F.when(side, F.col("evidence_id")).alias("companion_evidence_id"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, page = _printed(spark, sf_dir), F.col("page")
    within = {"p_x": 0, "p_y": 150, "p_w": 1000, "p_h": 200}
    claims = chart_claims(spark, sf_dir).withColumn("block", F.when(page % 5 != 4, page)).withColumn("type", F.when(page % 7 == 3, "kpi_panel").otherwise("chart")).withColumn("pie", page % 3 == 0)
    claims = claims.withColumns({c: F.lit(v) for c, v in within.items()})
    owned = lines.where(~F.col("evidence_id").endswith("-ocr-v3")).select(page.alias("block"), "evidence_id")
    found = R.reconcile_items(claims, lines, _observations(spark, sf_dir), owned, ["page"], "slot")
    return found.withColumn("label_evidence_ids", F.array_join("label_evidence_ids", ","))


@query("reconcile_items", ITEMS_SQL + "SELECT * FROM final")
def reconcile_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir)


@query("decision_counts", ITEMS_SQL + "SELECT page, decision, count(*) AS decisions FROM final GROUP BY page, decision UNION ALL SELECT NULL, decision, count(*) FROM final GROUP BY decision")
def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.decision_counts(_items(spark, sf_dir), "page")


@query("companion_percentages", f"""WITH {CHART_SQL},
p AS (SELECT page, page || '-ocr-p' || slot AS evidence_id, (10 + slot) || '.5%' AS text, x + (page + slot) % 4 * 30 AS x, y + 30 + (page * slot) % 5 * 20 AS y, 40 AS w, 18 AS h FROM chart WHERE role = 'value'),
met AS (SELECT a.page, a.slot, p.evidence_id, p.text FROM chart a JOIN p ON a.page = p.page AND abs(p.x + p.w / 2 - a.x - a.w / 2) <= 75 AND p.y - a.y - a.h BETWEEN -12 AND 75 WHERE a.role = 'value')
SELECT page, slot, min(evidence_id) AS evidence_id, min(text) AS text FROM met GROUP BY page, slot HAVING count(*) = 1""")
def companion_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = chart_lines(spark, sf_dir).where("role = 'value'")
    page, slot = F.col("page"), F.col("slot")
    percents = amounts.select("page", F.concat(page, F.lit("-ocr-p"), slot).alias("evidence_id"), F.concat(10 + slot, F.lit(".5%")).alias("text"), (F.col("x") + (page + slot) % 4 * 30).alias("x"), (F.col("y") + 30 + page * slot % 5 * 20).alias("y"), F.lit(40).alias("w"), F.lit(18).alias("h"))
    return R.companion_percentages(amounts, percents, ["page"], "slot")


@query("reconcile_table_cells", f"""WITH {CELLS_SQL},
heads AS (SELECT table_id, col, text AS column_label FROM cells WHERE row = 0),
labels AS (SELECT table_id, row, text AS row_label FROM cells WHERE col = 0 AND row > 0),
asked AS (
  SELECT CASE WHEN (row + col) % 9 = 8 THEN table_id || '?' ELSE table_id END AS table_id, row * 10 + col AS item, row, col, row_label || CASE WHEN (row + col) % 9 = 7 THEN ' x' ELSE '' END AS row_label, column_label,
         text || CASE WHEN (row + col) % 4 = 3 THEN '1' ELSE '' END AS value
  FROM cells JOIN heads USING (table_id, col) JOIN labels USING (table_id, row) WHERE row > 0 AND col > 0),
k AS (SELECT table_id, item, row, col, regexp_replace(lower(value), '[^a-z0-9%$€£.]+', '', 'g') AS v, (row + col) % 9 = 7 AS odd FROM asked)
SELECT k.table_id, item, CASE WHEN k.table_id LIKE '%?' THEN 'no_matching_source_block' WHEN odd THEN 'row_or_column_owner_unresolved'
  WHEN regexp_replace(lower(c.text), '[^a-z0-9%$€£.]+', '', 'g') = v THEN 'agreement' WHEN k.table_id = 'F' THEN 'native_cell_retained_over_vision_disagreement' ELSE 'table_cell_disagreement_needs_review' END AS decision
FROM k LEFT JOIN cells c ON c.table_id = k.table_id AND c.row = k.row AND c.col = k.col""")
def reconcile_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = status_cells(spark, sf_dir)
    heads = cells.where("row = 0").select("table_id", "col", F.col("text").alias("column_label"))
    labels = cells.where("col = 0 AND row > 0").select("table_id", "row", F.col("text").alias("row_label"))
    both = cells.where("row > 0 AND col > 0").join(heads, ["table_id", "col"]).join(labels, ["table_id", "row"])
    case = (F.col("row") + F.col("col")) % 9
    proposed = both.select(
        F.when(case == 8, F.concat("table_id", F.lit("?"))).otherwise(F.col("table_id")).alias("table_id"),
        (F.col("row") * 10 + F.col("col")).alias("item"),
        F.concat("row_label", F.when(case == 7, " x").otherwise("")).alias("row_label"),
        "column_label",
        F.concat("text", F.when((F.col("row") + F.col("col")) % 4 == 3, "1").otherwise("")).alias("value"),
    )
    return R.reconcile_cells(proposed, cells, cells.where("table_id = 'F'"))


@query("visual_bindings", f"""WITH {CHART_SQL}, {CLAIMS_SQL},
d AS (SELECT v.page, v.evidence_id AS value_evidence_id, l.text AS label, 70 + v.slot AS confidence FROM chart v JOIN chart l ON v.page = l.page AND v.slot = l.slot AND v.role = 'value' AND l.role = 'label' WHERE (v.page + v.slot) % 6 <> 5),
m AS (SELECT page, page || '-ocr-v' || slot AS value_evidence_id, label, 60 + (page * slot) % 30 AS confidence FROM claims WHERE (page + slot) % 7 <> 6)
SELECT page, value_evidence_id, coalesce(d.label, m.label) AS label, CASE WHEN lower(d.label) = lower(m.label) THEN greatest(d.confidence, m.confidence) ELSE coalesce(d.confidence, m.confidence) END AS confidence,
  CASE WHEN d.label IS NULL THEN 'added' WHEN m.label IS NULL THEN 'retained' WHEN lower(d.label) = lower(m.label) THEN 'confirmed' ELSE 'conflicted' END AS status
FROM d FULL OUTER JOIN m USING (page, value_evidence_id)""")
def visual_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chart_lines(spark, sf_dir)
    label = lines.where("role = 'label'").select("page", "slot", F.col("text").alias("label"))
    found = lines.where("role = 'value' AND (page + slot) % 6 <> 5").join(label, ["page", "slot"]).select("page", F.col("evidence_id").alias("value_evidence_id"), "label", (70 + F.col("slot")).alias("confidence"))
    model = chart_claims(spark, sf_dir).where("(page + slot) % 7 <> 6").select("page", F.concat("page", F.lit("-ocr-v"), "slot").alias("value_evidence_id"), "label", (60 + F.col("page") * F.col("slot") % 30).alias("confidence"))
    return R.visual_bindings(found, model, ["page"])


@query("model_bindings", f"""WITH {CHART_SQL}, {CLAIMS_SQL},
b AS (SELECT page, slot AS item, label, value, CASE WHEN slot = 0 THEN page || '-ocr-v0' END AS evidence_id, 50 + slot AS confidence FROM claims),
g AS (
  SELECT b.page, b.item, b.label, b.confidence, c.evidence_id AS g_id,
         CASE WHEN b.evidence_id = c.evidence_id THEN 1 WHEN lower(trim(b.value)) = lower(trim(c.text)) THEN 2 WHEN regexp_replace(lower(b.value), '[^a-z0-9]', '', 'g') = regexp_replace(lower(c.text), '[^a-z0-9]', '', 'g') THEN 3 END AS grade
  FROM b JOIN chart c ON b.page = c.page),
n AS (SELECT page, item, label, confidence, grade, count(*) AS n, min(g_id) AS value_evidence_id FROM g WHERE grade IS NOT NULL GROUP BY ALL),
f AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY page, item ORDER BY grade) = 1),
u AS (SELECT * FROM f WHERE n = 1)
SELECT page, value_evidence_id, label, confidence, grade FROM u QUALIFY row_number() OVER (PARTITION BY page, value_evidence_id ORDER BY confidence DESC, item) = 1
 AND min(lower(label)) OVER (PARTITION BY page, value_evidence_id) = max(lower(label)) OVER (PARTITION BY page, value_evidence_id)""")
def model_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.when(F.col("slot") == 0, F.concat("page", F.lit("-ocr-v0")))
    claims = chart_claims(spark, sf_dir).select("page", F.col("slot").alias("item"), "label", "value", given.alias("evidence_id"), (50 + F.col("slot")).alias("confidence"))
    return R.model_bindings(claims, chart_lines(spark, sf_dir), ["page"])


ROUTES_SQL = """
p AS (SELECT n_nationkey AS page, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (
  SELECT page, page % 2 AS errors_a, (page // 2) % 2 AS errors_b, n % 9 AS represented_a, n % 7 AS represented_b, n % 5 AS structured_a, n % 4 AS structured_b, n % 11 AS linked_a, n % 6 AS linked_b,
         85 + n % 15 AS iou, n % 8 AS map_bindings, n % 2 = 0 AS pie_verified, n % 6 AS pie_items, n % 10 AS table_linked, n % 4 AS table_baseline, n % 3 <> 0 AS keeps_coverage,
         (['map', 'chart', 'table', NULL, NULL])[page % 5 + 1] AS proposal_type FROM p)
"""


@query("route_choice", f"""WITH {ROUTES_SQL}
SELECT CAST(page AS BIGINT) AS page, CASE WHEN errors_b = 0 AND proposal_type = 'map' AND iou >= 90 AND map_bindings >= 5 THEN 'registered_map_candidate_selected'
  WHEN errors_b = 0 AND proposal_type = 'chart' AND pie_verified AND pie_items >= 3 THEN 'verified_chart_candidate_selected'
  WHEN errors_b = 0 AND proposal_type = 'table' AND keeps_coverage AND table_linked >= 3 AND table_linked >= table_baseline + 3 THEN 'ocr_supported_table_candidate_selected'
  WHEN proposal_type IS NOT NULL THEN 'vision_candidate_rejected_without_independent_support'
  WHEN ((represented_a >= represented_b + 2 AND structured_a >= structured_b) OR (linked_a >= linked_b + 3 AND represented_a >= represented_b)) AND errors_a <= errors_b THEN 'pre_paddle_structured_route_preserved_more_ocr_content'
  ELSE 'deterministic_route_retained' END AS route FROM r""")
def route_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_nationkey").cast("long").alias("page")).agg(F.count("c_custkey").alias("n"))
    n, page = F.col("n"), F.col("page")
    kind = F.element_at(F.array(F.lit("map"), F.lit("chart"), F.lit("table"), F.lit(None), F.lit(None)), (page % 5 + 1).cast("int"))
    pages = counted.select(
        "page",
        (page % 2).alias("errors_a"),
        (F.floor(page / 2) % 2).alias("errors_b"),
        *((n % m).alias(c) for c, m in (("represented_a", 9), ("represented_b", 7), ("structured_a", 5), ("structured_b", 4), ("linked_a", 11), ("linked_b", 6), ("map_bindings", 8), ("pie_items", 6), ("table_linked", 10), ("table_baseline", 4))),
        ((85 + n % 15) / 100).alias("map_iou"),
        (n % 2 == 0).alias("pie_verified"),
        (n % 3 != 0).alias("keeps_coverage"),
        kind.alias("proposal_type"),
    )
    return R.route_choice(pages)

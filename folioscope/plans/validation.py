"""Queries over integrity rules, hierarchy, proposals and run totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import ownership as own
from folioscope.operators import validation as V
from folioscope.sources import proposals as P
from folioscope.sources.evidence import EVIDENCE_SQL, evidence_lines, page_regions, table

from .base import query
from .evidence import OWNER_SQL
from .tables import CELLS_SQL, status_cells

PAGE = ["doc_id", "page"]

#: A tree on every page: block 0 over 1 and 2, block 1 over 3..6, block 2 over 7..11, with planted faults.
BLOCKS_SQL = f"""
WITH {EVIDENCE_SQL},
raw AS (SELECT doc_id, page, region AS block, x, y, w, h, conf, CASE WHEN region = 0 THEN NULL WHEN region <= 2 THEN 0 WHEN region <= 6 THEN 1 ELSE 2 END AS up FROM regions),
blocks AS (
  SELECT doc_id, page, block, x, y, w, CASE WHEN (doc_id + block) % 19 = 0 THEN 0 ELSE h END AS h, CASE WHEN (doc_id + block) % 23 = 0 THEN 120 ELSE conf END AS confidence,
         CASE WHEN (doc_id + block) % 29 = 0 THEN 99 ELSE up END AS parent,
         CASE WHEN block = 0 THEN [1, 2] WHEN block = 1 THEN [3, 4, 5, 6] WHEN block = 2 THEN CASE WHEN doc_id % 11 = 0 THEN [7, 8, 9, 10] ELSE [7, 8, 9, 10, 11] END ELSE [] END AS children,
         CASE WHEN up IS NULL THEN 0 WHEN up = 0 THEN 1 ELSE 2 END + CASE WHEN (doc_id + block) % 31 = 0 THEN 1 ELSE 0 END AS depth,
         CASE WHEN (doc_id * 7 + block) % 37 = 0 THEN 'oddity' WHEN block <= 2 THEN 'group' WHEN block = 11 THEN 'decoration' ELSE 'text' END AS type,
         CASE WHEN block > 2 AND (doc_id + block * 5) % 13 = 0 THEN 'needs_review' ELSE 'passed' END AS status FROM raw)
"""


def planted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, b = F.col("doc_id"), F.col("region")
    up = F.when(b == 0, None).when(b <= 2, 0).when(b <= 6, 1).otherwise(2).cast("long")
    ids = lambda *v: F.array(*(F.lit(k).cast("long") for k in v)).cast("array<bigint>")
    children = F.when(b == 0, ids(1, 2)).when(b == 1, ids(3, 4, 5, 6)).when((b == 2) & (d % 11 == 0), ids(7, 8, 9, 10)).when(b == 2, ids(7, 8, 9, 10, 11)).otherwise(ids())
    regions = page_regions(evidence_lines(spark, sf_dir))
    return regions.select(
        *PAGE,
        b.alias("block"),
        "x",
        "y",
        "w",
        F.when((d + b) % 19 == 0, 0).otherwise(F.col("h")).alias("h"),
        F.when((d + b) % 23 == 0, 120).otherwise(F.col("conf")).alias("confidence"),
        F.when((d + b) % 29 == 0, 99).otherwise(up).alias("parent"),
        children.alias("children"),
        (F.when(b == 0, 0).when(b <= 2, 1).otherwise(2) + F.when((d + b) % 31 == 0, 1).otherwise(0)).alias("depth"),
        F.when((d * 7 + b) % 37 == 0, "oddity").when(b <= 2, "group").when(b == 11, "decoration").otherwise("text").alias("type"),
        F.when((b > 2) & ((d + b * 5) % 13 == 0), "needs_review").otherwise("passed").alias("status"),
    )


@query("block_violations", BLOCKS_SQL + """
SELECT 'unknown_type' AS rule, doc_id, page, CAST(block AS VARCHAR) AS block FROM blocks WHERE type = 'oddity'
UNION ALL SELECT 'box_off_page', doc_id, page, CAST(block AS VARCHAR) FROM blocks WHERE x < 0 OR y < 0 OR w <= 0 OR h <= 0 OR x + w > 1000 OR y + h > 1000
UNION ALL SELECT 'confidence_out_of_range', doc_id, page, CAST(block AS VARCHAR) FROM blocks WHERE confidence NOT BETWEEN 0 AND 100
UNION ALL SELECT 'decoration_not_passed', doc_id, page, CAST(block AS VARCHAR) FROM blocks WHERE type = 'decoration' AND status <> 'passed'""")
def block_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.block_violations(planted_blocks(spark, sf_dir), PAGE)


@query("hierarchy_violations", BLOCKS_SQL + """,
l AS (SELECT b.*, p.depth AS pd, p.children AS pc FROM blocks b LEFT JOIN blocks p ON b.doc_id = p.doc_id AND b.page = p.page AND b.parent = p.block WHERE b.parent IS NOT NULL),
c AS (SELECT b.doc_id, b.page, b.block AS up, b.status AS up_status, unnest(b.children) AS block FROM blocks b),
k AS (SELECT c.*, b.parent, b.status AS child_status FROM c LEFT JOIN blocks b ON c.doc_id = b.doc_id AND c.page = b.page AND c.block = b.block)
SELECT 'parent_missing' AS rule, doc_id, page, CAST(block AS VARCHAR) AS block FROM l WHERE pd IS NULL
UNION ALL SELECT 'parent_does_not_list_child', doc_id, page, CAST(block AS VARCHAR) FROM l WHERE pd IS NOT NULL AND NOT list_contains(pc, block)
UNION ALL SELECT 'depth_not_below_parent', doc_id, page, CAST(block AS VARCHAR) FROM l WHERE depth <> pd + 1
UNION ALL SELECT 'root_depth_not_zero', doc_id, page, CAST(block AS VARCHAR) FROM blocks WHERE parent IS NULL AND depth <> 0
UNION ALL SELECT 'child_names_other_parent', doc_id, page, CAST(block AS VARCHAR) FROM k WHERE parent IS DISTINCT FROM up
UNION ALL SELECT DISTINCT 'passing_group_with_review_child', doc_id, page, CAST(up AS VARCHAR) FROM k WHERE child_status <> 'passed' AND up_status = 'passed'""")
def hierarchy_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.hierarchy_violations(planted_blocks(spark, sf_dir), PAGE)


@query("group_status_rollup", BLOCKS_SQL + """,
tree AS (SELECT doc_id, page, block, CASE WHEN block = 0 THEN NULL WHEN block <= 2 THEN 0 WHEN block <= 6 THEN 1 ELSE 2 END AS up, status FROM blocks),
mid AS (SELECT t.doc_id, t.page, t.block, t.up, CASE WHEN t.block IN (1, 2) AND EXISTS (SELECT 1 FROM tree c WHERE c.doc_id = t.doc_id AND c.page = t.page AND c.up = t.block AND c.status <> 'passed') THEN 'needs_review' ELSE t.status END AS status FROM tree t)
SELECT m.doc_id, m.page, m.block, CASE WHEN m.block = 0 AND EXISTS (SELECT 1 FROM mid c WHERE c.doc_id = m.doc_id AND c.page = m.page AND c.up = 0 AND c.status <> 'passed') THEN 'needs_review' ELSE m.status END AS status FROM mid m""")
def group_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("block")
    tree = planted_blocks(spark, sf_dir).withColumn("parent", F.when(b == 0, None).when(b <= 2, 0).when(b <= 6, 1).otherwise(2).cast("long")).withColumn("depth", F.when(b == 0, 0).when(b <= 2, 1).otherwise(2))
    return V.rolled_up_status(tree, PAGE, 2)


@query("hierarchy_closure", """
WITH RECURSIVE n AS (SELECT c_custkey AS block, CASE WHEN c_custkey > 1 THEN c_custkey // 8 END AS parent FROM customer),
t AS (SELECT block, parent AS ancestor, 1 AS steps FROM n WHERE parent IS NOT NULL UNION ALL SELECT t.block, n.parent, steps + 1 FROM t JOIN n ON t.ancestor = n.block WHERE n.parent IS NOT NULL)
SELECT block, ancestor, steps FROM t""")
def hierarchy_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nodes = table(spark, sf_dir, "customer").select(F.lit(0).alias("tree"), key.alias("block"), F.when(key > 1, F.floor(key / 8)).alias("parent"))
    return V.closure(nodes, ["tree"], 8).drop("tree")


@query("evidence_violations", OWNER_SQL + """,
held AS (
  SELECT doc_id, page, region AS block, doc_id || '-ocr-' || seq AS evidence_id FROM owners WHERE (doc_id + seq) % 41 <> 0
  UNION ALL SELECT doc_id, page, region + 50, doc_id || '-ocr-' || seq FROM owners WHERE (doc_id + seq) % 43 = 0
  UNION ALL SELECT doc_id, page, region, doc_id || '-ghost-' || seq FROM owners WHERE (doc_id + seq) % 101 = 0),
ledger AS (SELECT doc_id, page, evidence_id, text, CASE WHEN (doc_id + seq) % 47 = 0 THEN 77 ELSE region END AS owner FROM evidence JOIN owners USING (doc_id, page, seq)),
o AS (SELECT doc_id, page, evidence_id, count(DISTINCT block) AS n, min(block) AS block FROM held GROUP BY ALL),
b AS (SELECT doc_id, page, evidence_id, n, block, text, owner FROM ledger FULL OUTER JOIN o USING (doc_id, page, evidence_id))
SELECT 'several_owners' AS rule, doc_id, page, evidence_id AS block FROM b WHERE n > 1
UNION ALL SELECT 'line_without_owner', doc_id, page, evidence_id FROM b WHERE n IS NULL
UNION ALL SELECT 'evidence_not_in_ledger', doc_id, page, evidence_id FROM b WHERE text IS NULL
UNION ALL SELECT 'ledger_names_other_owner', doc_id, page, evidence_id FROM b WHERE text IS NOT NULL AND n = 1 AND owner IS DISTINCT FROM block""")
def evidence_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    owned = own.with_owner(lines, page_regions(lines), "inner")
    k = F.col("doc_id") + F.col("seq")
    holds = lambda when, block, evidence_id: F.when(when, F.struct(block.alias("block"), evidence_id.alias("evidence_id")))
    ghost = F.concat("doc_id", F.lit("-ghost-"), "seq")
    planted = F.array(holds(k % 41 != 0, F.col("region"), F.col("evidence_id")), holds(k % 43 == 0, F.col("region") + 50, F.col("evidence_id")), holds(k % 101 == 0, F.col("region"), ghost))
    held = owned.select(*PAGE, F.explode(F.array_compact(planted)).alias("h")).select(*PAGE, "h.block", "h.evidence_id")
    ledger = owned.select(*PAGE, "evidence_id", "text", F.when(k % 47 == 0, 77).otherwise(F.col("region")).alias("owner"))
    return V.evidence_violations(held, ledger, PAGE)


@query("table_violations", f"""WITH {CELLS_SQL},
f AS (SELECT table_id, row, col, CASE WHEN table_id = 'O' AND row = 0 AND col = 3 THEN 'PRIORITY' ELSE text END AS text FROM cells WHERE NOT (table_id = 'F' AND row = 3 AND col = 2)
      UNION ALL SELECT table_id, row, 4, 'x' FROM cells WHERE table_id = 'P' AND row = 1 AND col = 0),
w AS (SELECT table_id, count(DISTINCT col) AS width FROM f WHERE row = 0 GROUP BY ALL),
z AS (SELECT table_id, row, count(DISTINCT col) AS n, max(col) AS last, any_value(width) AS width FROM f JOIN w USING (table_id) WHERE row > 0 GROUP BY table_id, row)
SELECT DISTINCT table_id, 'column_named_twice' AS rule FROM (SELECT table_id FROM f WHERE row = 0 AND trim(text) <> '' GROUP BY table_id, lower(trim(text)) HAVING count(*) > 1)
UNION SELECT table_id, 'row_lacks_cells' FROM z WHERE n < width UNION SELECT table_id, 'cell_beyond_header' FROM z WHERE last >= width""")
def table_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = status_cells(spark, sf_dir)
    renamed = F.when(F.expr("table_id = 'O' AND row = 0 AND col = 3"), "PRIORITY").otherwise(F.col("text"))
    faulty = cells.where("NOT (table_id = 'F' AND row = 3 AND col = 2)").withColumn("text", renamed)
    extra = cells.where("table_id = 'P' AND row = 1 AND col = 0").select("table_id", "row", F.lit(4).cast("long").alias("col"), F.lit("x").alias("text"))
    return V.table_violations(faulty.unionByName(extra))


@query("completeness_by_page", BLOCKS_SQL + """
SELECT doc_id, page, count(*) AS blocks, count(*) FILTER (status <> 'passed') AS needs_review, doc_id % 5 <> 0 AND count(*) FILTER (status <> 'passed') = 0 AS complete FROM blocks GROUP BY doc_id, page""")
def completeness_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = planted_blocks(spark, sf_dir)
    pages = evidence_lines(spark, sf_dir).select(*PAGE).distinct().withColumn("warnings", (F.col("doc_id") % 5 == 0).cast("int"))
    return V.completeness(pages, blocks, PAGE)


@query("collection_totals", BLOCKS_SQL + "SELECT type, status, count(*) AS blocks FROM blocks GROUP BY ROLLUP (type, status)")
def collection_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted_blocks(spark, sf_dir).rollup("type", "status").agg(F.count(F.lit(1)).alias("blocks"))


#: One proposal for each customer; by key % 8: 1 is another page, 2 a bad box, 3 repeats an item, 4 a bad parent,
#: 5 repeats a block, 6 no JSON.
@query("proposal_validation", """
SELECT c_custkey AS page, CASE c_custkey % 8 WHEN 1 THEN 'other_page' WHEN 2 THEN 'invalid_box' WHEN 3 THEN 'repeated_item' WHEN 4 THEN 'invalid_parent' WHEN 5 THEN 'repeated_block' WHEN 6 THEN 'not_json' END AS error,
       CAST(CASE WHEN c_custkey % 8 IN (0, 7) THEN 2 ELSE 0 END AS BIGINT) AS blocks, CAST(CASE WHEN c_custkey % 8 IN (0, 7) THEN 2 ELSE 0 END AS BIGINT) AS items FROM customer""")
def proposal_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    item = lambda name: f'{{"label": "{name}", "value": "1"}}'
    block = lambda b="[10, 20, 300, 400]", items="", parent="null": f'{{"type": "chart", "bbox": {b}, "title": "t", "text": "", "parent_index": {parent}, "items": [{items}]}}'
    pair = ", ".join([block(items=", ".join([item("a"), item("b")])), block("[310, 20, 600, 400]", parent="0")])
    raw = F.when(k % 8 == 2, block("[10, 20, 5, 400]")).when(k % 8 == 3, block(items=", ".join([item("a")] * 4))).when(k % 8 == 4, block(parent="0")).when(k % 8 == 5, ", ".join([block()] * 4)).otherwise(pair)
    page = F.when(k % 8 == 1, k + 1).otherwise(k)
    whole = F.when(k % 8 == 6, "{").otherwise(F.concat(F.lit('{"page_number": '), page, F.lit(', "blocks": ['), raw, F.lit("]}")))
    # many short rows fit one split of a file, and each is a proposal to parse: they are dealt out before
    pages = table(spark, sf_dir, "customer").select("c_custkey").repartition("c_custkey")
    found = P.parsed(pages.select(k.alias("page"), whole.alias("raw")))
    blocks = P.proposal_blocks(found).groupBy("page").agg(F.count(F.lit(1)).alias("blocks"))
    items = P.proposal_items(found).groupBy("page").agg(F.count(F.lit(1)).alias("items"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.select("page", "error").join(blocks, "page", "left").join(items, "page", "left").select("page", "error", zero("blocks"), zero("items"))


@query("proposal_cache_hits", """
WITH r AS (SELECT s_suppkey AS page, 'm' || s_nationkey % 3 AS model, sha256('i' || s_suppkey % 40) AS image_sha256, sha256('p' || s_suppkey % 2) AS prompt_sha256 FROM supplier),
c AS (SELECT DISTINCT 'm' || s_nationkey % 2 AS model, sha256('i' || s_suppkey % 30) AS image_sha256, sha256('p0') AS prompt_sha256, CASE WHEN s_suppkey % 30 % 4 = 3 THEN 'failed' ELSE 'complete' END AS status FROM supplier)
SELECT page, model FROM r JOIN c USING (model, image_sha256, prompt_sha256) WHERE status = 'complete'""")
def proposal_cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    sha = lambda letter, v: F.sha2(F.concat(F.lit(letter), v), 256)
    suppliers = table(spark, sf_dir, "supplier")
    requests = suppliers.select(k.alias("page"), F.concat(F.lit("m"), n % 3).alias("model"), sha("i", k % 40).alias("image_sha256"), sha("p", k % 2).alias("prompt_sha256"))
    cache = suppliers.select(F.concat(F.lit("m"), n % 2).alias("model"), sha("i", k % 30).alias("image_sha256"), sha("p", F.lit(0)).alias("prompt_sha256"), F.when(k % 30 % 4 == 3, "failed").otherwise("complete").alias("status"), F.lit("{}").alias("raw")).distinct()
    return P.reusable(requests, cache).select("page", "model")


@query("page_selection", """
WITH s AS (SELECT s_suppkey AS doc_id, 12 AS n_pages, s_suppkey % 4 AS k FROM supplier)
SELECT DISTINCT doc_id, p AS page FROM s, range(1, 13) t(p) WHERE k = 0 OR (k = 1 AND p IN (1, 2, 3, 5)) OR (k = 2 AND p = 8) OR (k = 3 AND p BETWEEN 2 AND 12 AND (p <= 4 OR p >= 10))""")
def page_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 4
    spec = F.when(k == 0, None).when(k == 1, "1-3,5, 3").when(k == 2, "8").otherwise("10-12,2-4,")
    return P.selected_pages(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"), spec.alias("spec"), F.lit(12).alias("n_pages"))).withColumn("page", F.col("page").cast("long"))


@query("merged_tiles", """
WITH b AS (SELECT n_nationkey % 5 AS page, n_nationkey AS k, n_name AS title FROM nation),
t AS (
  SELECT page, 0 AS tile, k AS block, 'text' AS type, title, '' AS text, k % 4 AS n_items, 100 AS x, 300 + k * 20 AS y, 200.0 AS w, 40 * 0.34 AS h, (300 + k * 20) * 0.34 AS py FROM b
  UNION ALL SELECT page, 1, k, 'text', CASE WHEN k % 3 = 0 THEN title ELSE title || ' x' END, '', k % 3, 100, 0, 200.0, 40 * 0.34, (300 + k * 20) * 0.34 FROM b),
d AS (SELECT a.page, a.tile, a.block FROM t a JOIN t o ON a.page = o.page AND a.type = o.type AND lower(a.title) = lower(o.title) AND (a.tile, a.block) <> (o.tile, o.block)
      WHERE (o.n_items > a.n_items OR (o.n_items = a.n_items AND (o.tile, o.block) < (a.tile, a.block))))
SELECT CAST(page AS BIGINT) AS page, CAST(tile AS BIGINT) AS tile, CAST(block AS BIGINT) AS block, row_number() OVER (PARTITION BY page ORDER BY round(py, 6), tile, block) AS position FROM t WHERE (page, tile, block) NOT IN (SELECT (page, tile, block) FROM d)""")
def merged_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    base = table(spark, sf_dir, "nation").select((k % 5).alias("page"), k.alias("block"), F.col("n_name").alias("title"))
    b = F.col("block")
    upper = base.select("page", F.lit(0).cast("long").alias("tile"), "block", F.lit("text").alias("type"), "title", F.lit("").alias("text"), (b % 4).alias("n_items"), F.lit(100.0).alias("x"), (300.0 + b * 20).alias("y"), F.lit(200.0).alias("w"), F.lit(40.0).alias("h"), F.lit(0.0).alias("tx"), F.lit(0.0).alias("ty"), F.lit(1000.0).alias("tw"), F.lit(340.0).alias("th"))
    title = F.when(b % 3 == 0, F.col("title")).otherwise(F.concat("title", F.lit(" x")))
    lower = base.select("page", F.lit(1).cast("long").alias("tile"), "block", F.lit("text").alias("type"), title.alias("title"), F.lit("").alias("text"), (b % 3).alias("n_items"), F.lit(100.0).alias("x"), ((300 + b * 20) * 340.0 / 720).alias("y"), F.lit(200.0).alias("w"), F.lit(40 * 340.0 / 720).alias("h"), F.lit(0.0).alias("tx"), F.lit(0.0).alias("ty"), F.lit(1000.0).alias("tw"), F.lit(720.0).alias("th"))
    found = P.merged_tiles(upper.unionByName(lower))
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("page").orderBy(F.round("y", 6), "tile", "block")).cast("long")
    return found.select("page", "tile", "block", order.alias("position"))

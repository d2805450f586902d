"""Queries over boxes in images, words in boxes, receipts and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import geometry as G
from folioscope.operators import blocks as B
from folioscope.sources import sinks as S
from folioscope.sources.evidence import EVIDENCE_SQL, evidence_lines, page_regions

from .base import query

PAGE = ["doc_id", "page"]
#: Pixels of the surrogate images.
WIDTH, HEIGHT = 1200, 900


@query("image_boxes", f"""WITH {EVIDENCE_SQL},
e AS (SELECT doc_id, page, region, x, y, w, h, CAST(greatest(x - 80, 0) AS DOUBLE) AS x0, CAST(greatest(y - 100, 0) AS DOUBLE) AS y0, CAST(least(x + w + 80, 1000) AS DOUBLE) AS x1, CAST(least(y + h + 140, 870) AS DOUBLE) AS y1 FROM regions),
p AS (SELECT *, x1 - x0 AS ew, y1 - y0 AS eh FROM e WHERE y1 > y0),
i AS (SELECT *, (x - x0) * {WIDTH} / ew AS px, (y - y0) * {HEIGHT} / eh AS py, w * {WIDTH} / ew AS pw, h * {HEIGHT} / eh AS ph FROM p)
SELECT doc_id, page, region, round(x0, 4) AS image_x, round(y0, 4) AS image_y, round(ew, 4) AS image_w, round(eh, 4) AS image_h, round(px, 4) AS pixel_x, round(py, 4) AS pixel_y, round(pw, 4) AS pixel_w, round(ph, 4) AS pixel_h,
       round(x0 + px * ew / {WIDTH}, 4) AS x, round(y0 + py * eh / {HEIGHT}, 4) AS y, round(pw * ew / {WIDTH}, 4) AS w, round(ph * eh / {HEIGHT}, 4) AS h FROM i""")
def image_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region widened to an image with room for labels, its box in pixels of that image, and that box on the page."""
    regions = page_regions(evidence_lines(spark, sf_dir))
    of = G.box()
    image = G.expanded_visual(of)
    width, height = F.lit(WIDTH), F.lit(HEIGHT)
    pixels = G.to_pixels(of, image, width, height)
    back = G.to_page(pixels, image, width, height)
    named = lambda made, prefix: [F.round(v, 4).alias(prefix + c) for c, v in zip("xywh", (made.x, made.y, made.w, made.h), strict=True)]
    return regions.where(image.h > 0).select(*PAGE, "region", *named(image, "image_"), *named(pixels, "pixel_"), *named(back, ""))


@query("words_in_boxes", f"""WITH {EVIDENCE_SQL}
SELECT e.doc_id, e.page, r.region AS block, string_agg(text, ' ' ORDER BY e.y, e.x, e.seq) AS text
FROM evidence e JOIN regions r ON e.doc_id = r.doc_id AND e.page = r.page AND e.x + e.w / 2 BETWEEN r.x AND r.x + r.w AND e.y + e.h / 2 BETWEEN r.y AND r.y + r.h GROUP BY ALL""")
def words_in_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evidence_lines(spark, sf_dir)
    return B.native_words(lines, page_regions(lines).withColumnRenamed("region", "block"), PAGE)


RECEIPTS_SQL = f"""WITH {EVIDENCE_SQL},
receipts AS (SELECT doc_id, page, sha256('{{"blocks":["' || string_agg(evidence_id, '","' ORDER BY seq) || '"]}}') AS sha256, count(*) AS blocks FROM evidence GROUP BY ALL),
changed AS (SELECT doc_id, page, sha256('{{"blocks":["' || string_agg(CASE WHEN (doc_id + seq) % 53 = 0 THEN 'other' ELSE evidence_id END, '","' ORDER BY seq) || '"]}}') AS sha256 FROM evidence GROUP BY ALL)
"""


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages as lists of evidence ids, and the same with some of them changed."""
    lines = evidence_lines(spark, sf_dir)
    gathered = lambda evidence: lines.groupBy(*PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", evidence.alias("id")))), lambda s: s["id"]).alias("blocks"))
    changed = F.when((F.col("doc_id") + F.col("seq")) % 53 == 0, "other").otherwise(F.col("evidence_id"))
    return gathered(F.col("evidence_id")), gathered(changed)


@query("page_receipts", RECEIPTS_SQL + "SELECT * FROM receipts")
def page_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.page_receipts(_pages(spark, sf_dir)[0], PAGE).withColumn("blocks", F.col("blocks").cast("long"))


@query("run_manifest", RECEIPTS_SQL + """
SELECT doc_id, count(*) AS pages, CAST(sum(blocks) AS BIGINT) AS blocks, sha256(string_agg(sha256, '' ORDER BY page)) AS sha256, CASE WHEN doc_id % 9 = 4 THEN 'needs_review' ELSE 'complete' END AS status FROM receipts GROUP BY doc_id""")
def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = S.page_receipts(_pages(spark, sf_dir)[0], PAGE)
    return S.manifest(receipts, "doc_id", receipts.where("doc_id % 9 = 4").select("doc_id"))


@query("changed_pages", RECEIPTS_SQL + "SELECT doc_id, page FROM receipts JOIN changed USING (doc_id, page) WHERE receipts.sha256 <> changed.sha256")
def changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _pages(spark, sf_dir)
    return S.verified(S.page_receipts(first, PAGE), second, PAGE)

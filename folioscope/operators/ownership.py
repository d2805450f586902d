"""Who owns a line: exclusive region owners, dispositions, and what stays without an owner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.functions.geometry import box, center_in

from .joins import best, dealt, page_join, pieces, prefixed

PAGE = ["doc_id", "page"]
# A kind with more weight takes a line first.
PRIORITY = {"table": 6, "visual": 5, "normal_text": 4, "unknown": 2, "other": 2, "decoration": 1}


def candidates(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Every pair of a line and a region of its page that holds the line's centre."""
    n = pieces(lines)
    return page_join(dealt(lines, PAGE, n), dealt(prefixed(regions, "r_", PAGE), PAGE, n), PAGE, center_in(box(), box("r_")))


def region_owner(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """doc_id, page, seq, region, kind: one owner for each line that some region holds. Kind decides, then the smaller
    area, the higher confidence, and the region that comes first."""
    weight = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for pair in PRIORITY.items() for v in pair)), F.col("r_kind")), F.lit(2))
    found = candidates(lines, regions).select(*PAGE, "seq", F.col("r_region").alias("region"), F.col("r_kind").alias("kind"), weight.alias("weight"), (F.col("r_w") * F.col("r_h")).alias("area"), "r_conf")
    return best(found, [*PAGE, "seq"], [-F.col("weight"), F.col("area"), -F.col("r_conf"), F.col("region")], ["region", "kind"])


def with_owner(lines: DataFrame, regions: DataFrame, how: str = "left") -> DataFrame:
    """Every line, with region and kind where it has an owner. how: inner for
    the lines that have one only, left_anti for those that have none."""
    key, n = [*PAGE, "seq"], pieces(lines)
    return dealt(lines, key, n).join(dealt(region_owner(lines, regions), key, n), key, how)


def dispositions(owned: DataFrame) -> DataFrame:
    """Lines of each page by what owns them."""
    return owned.groupBy(*PAGE, F.coalesce("kind", F.lit("unassigned")).alias("disposition")).agg(F.count(F.lit(1)).alias("lines"))


def contested(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Lines that several regions hold, with how many."""
    return candidates(lines, regions).groupBy(*PAGE, "seq").agg(F.count(F.lit(1)).alias("owners")).where("owners > 1")


def numeric_coverage(lines: DataFrame, content: DataFrame, least_conf: int = 80, margin: int = 10) -> DataFrame:
    """Numeric lines of good confidence, and whether nearby content holds them.

    content: page keys, box x, y, w, h and text of block content. represented: a block within margin of the line's
    centre has the line's key in its text."""
    keyed = lines.withColumn("key", T.alnum_key(F.col("text"))).where((F.col("conf") >= least_conf) & F.col("text").rlike(r"\d") & (F.length("key") >= 3))
    held = prefixed(content.withColumn("content_key", T.alnum_key(F.col("text"))).select(*PAGE, "x", "y", "w", "h", "content_key"), "b_", PAGE)
    near = center_in(box(), box("b_"), margin) & F.col("b_content_key").contains(F.col("key"))
    found = page_join(keyed, held, PAGE, near, "left_semi").select(*PAGE, "seq").withColumn("represented", F.lit(True))
    return keyed.join(found, [*PAGE, "seq"], "left").withColumn("represented", F.coalesce("represented", F.lit(False)))


def token_pages(lines: DataFrame, document: str, page: str, name_tokens: DataFrame | None = None) -> DataFrame:
    """document, token, pages: on how many pages a lower-cased word of two letters or more stands. Words of a file name
    (columns document and token) count as two pages more."""
    tokens = lines.select(document, page, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)([\p{L}]{2,})"), F.lit(1))).alias("token")).distinct()
    counted = tokens.groupBy(document, "token").agg(F.count(F.lit(1)).alias("pages"))
    if name_tokens is not None:
        counted = counted.unionByName(name_tokens.select(document, "token").distinct().withColumn("pages", F.lit(2).cast("long")))
        counted = counted.groupBy(document, "token").agg(F.sum("pages").alias("pages"))
    return counted


def repeated_bands(regions: DataFrame, document: str, page: str, least_pages: int = 3) -> DataFrame:
    """Visual bands over the page's width at its top or foot that return on several pages of a document: decoration."""
    band = (F.col("kind") == "visual") & (F.col("w") >= 700) & (F.col("h") <= 180) & ((F.col("y") >= 820) | (F.col("y") + F.col("h") <= 180))
    marks = [F.bround(F.col(c) / 25).cast("long").alias(f"s{c}") for c in "xywh"]
    group = [document, "sx", "sy", "sw", "sh"]
    bands = regions.where(band).select("*", *marks)
    repeated = bands.groupBy(*group).agg(F.countDistinct(page).alias("pages")).where(F.col("pages") >= least_pages)
    return bands.join(repeated, group).select(document, page, "region", "pages")

"""From routed regions to blocks: grids of tables, marks of charts, sections of text, and the page pipeline."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.functions.geometry import box, clamped_corners
from folioscope.sources.html_tables import html_grids

from . import blocks as B
from . import ownership as own
from .joins import only, page_join, prefixed
from .paged import Row, cx, first_fit, joined_fragments, reading, text_of, text_rows
from .paged import column_anchors as anchors_of

# Tables


def table_candidates(payloads: DataFrame) -> DataFrame:
    """page, candidate, rows, structure, score and box of analysed tables.

    payloads: page, width, height, boxes array<struct<label, score, coordinate array<double>>>, tables
    array<struct<html string, bbox array<double>>>. A table without a box takes that of the table box with its number.
    Two rows make a candidate, two columns a grid; else it is layout only."""
    each = payloads.select("page", "width", "height", F.posexplode("tables").alias("candidate", "t"))
    listed = payloads.select("page", F.posexplode(F.filter("boxes", lambda b: b["label"] == "table")).alias("candidate", "b"))
    both = each.join(listed, ["page", "candidate"], "left").withColumn("rows", html_grids("t.html")).where(F.size("rows") >= 2)
    at = [F.coalesce(F.get("t.bbox", F.lit(k)), F.get("b.coordinate", F.lit(k))) for k in range(4)]
    placed = clamped_corners(*at, F.col("width"), F.col("height"))
    status = F.when(F.size(F.get("rows", F.lit(0))) >= 2, "grid").otherwise("layout_only")
    return both.select("page", "candidate", "rows", status.alias("structure"), F.col("b.score").alias("score"), *(v.alias(c) for c, v in zip("xywh", placed, strict=True)))


_SIGN = re.compile(r"[$€£]")
_PLAIN = re.compile(r"\(?[-+]?\d[\d,.]*\)?")


def normal_grid(grid: list[list[str]]) -> dict:
    """title, rows of a printed grid: a first row of one cell is its title, loose currency signs join their number, and
    columns that are left empty go. A grid whose first column holds the values is turned round."""
    rows = [[re.sub(r"\s+", " ", v or "").strip() for v in row] for row in grid]
    rows = [r for r in rows if any(r)]
    title = None
    if len(rows) > 2 and sum(map(bool, rows[0])) == 1 and sum(map(bool, rows[1])) > 1:
        title = next(filter(None, rows[0]))
        rows = rows[1:]
    for row in rows[1:]:
        for k in range(len(row) - 1):
            if _SIGN.fullmatch(row[k]) and _PLAIN.fullmatch(row[k + 1]):
                row[k], row[k + 1] = "", row[k] + row[k + 1]
            elif (found := re.fullmatch(r"(.*%)\s*([$€£])", row[k])) and _PLAIN.fullmatch(row[k + 1]):
                row[k], row[k + 1] = found[1], found[2] + row[k + 1]
    width = max(map(len, rows), default=0)
    rows = [r + [""] * (width - len(r)) for r in rows]
    filled = [k for k in range(width) if any(r[k] for r in rows)]
    rows = [[r[k] for k in filled] for r in rows]
    numeric = lambda v: bool(re.search(r"\d", v)) and not re.search("[A-Za-z]{2}", v)
    if rows and len(filled) == 2 and all(numeric(r[0]) and not numeric(r[1]) for r in rows):
        rows = [[r[1], r[0]] for r in rows]
    return {"title": title, "rows": rows}


def typed_cells(cells: DataFrame, kinds: DataFrame, from_layout: DataFrame) -> DataFrame:
    """Cells with value, unit and normalized. In currency columns of tables that do not come from layout analysis the unit
    is USD and the scale is not applied (a rule of the source that is kept)."""
    typed = cells.where("row > 0 AND col > 0").join(kinds, ["table_id", "col"]).join(from_layout.select("table_id").distinct().withColumn("_layout", F.lit(True)), "table_id", "left")
    typed = typed.withColumn("n", T.numeric_value(F.coalesce("text", F.lit(""))))
    plain = (F.col("value_kind") == "currency") & F.col("_layout").isNull() & F.col("n.value").isNotNull()
    return typed.select("table_id", "row", "col", "text", F.col("n.value").alias("value"), F.when(plain, "USD").otherwise(F.col("n.unit")).alias("unit"), F.when(plain, F.col("n.value")).otherwise(F.col("n.normalized")).alias("normalized"))


GRID = "row int, col int, text string"


def ocr_grid(lines: list[Row]) -> list[Row]:
    """Lines of a table region as cells: a new row where y leaves its first line by more than 16; each line goes to the
    column of the header row that is nearest."""
    rows: list[list[Row]] = []
    for r in reading(lines):
        if rows and abs(r["y"] - rows[-1][0]["y"]) <= 16:
            rows[-1].append(r)
        else:
            rows.append([r])
    if len(rows) < 2 or len(rows[0]) < 2:
        return []
    heads = sorted(map(cx, rows[0]))
    cells: dict[tuple[int, int], list[str]] = {}
    for k, row in enumerate(rows):
        for r in sorted(row, key=lambda r: r["x"]):
            cells.setdefault((k, int(np.argmin([abs(h - cx(r)) for h in heads]))), []).append(text_of(r))
    return [{"row": k, "col": c, "text": " ".join(v)} for (k, c), v in sorted(cells.items())]


def aligned_table(words: list[Row], width: float = 1000) -> list[Row]:
    """A grid from positioned words without rules: at least two columns of numbers with one right edge, six rows with a
    label left of them, and the words above as header."""
    anchors = anchors_of(words, width)
    if len(anchors) < 2:
        return []
    rows = [joined_fragments(r, width) for r in text_rows(words)]
    body, head = [], []
    for row in rows:
        owned: dict[int, str] = {}
        label = []
        for w in row:
            right = w["x"] + w["w"]
            k = int(np.argmin([abs(a - right) for a in anchors]))
            if abs(anchors[k] - right) <= 0.02 * width and re.search(r"\d|^[-–—]$", text_of(w)):
                owned[k] = text_of(w)
            else:
                label.append(w)
        if owned and label and label[0]["x"] < anchors[0]:
            body.append([" ".join(map(text_of, label)), *(owned.get(k, "") for k in range(len(anchors)))])
        elif not body:
            head += row
    if len(body) < 6:
        return []
    titles = [""] * (len(anchors) + 1)
    for w in reading(head):
        k = int(np.argmin([abs(a - w["x"] - w["w"]) for a in anchors]))
        if abs(anchors[k] - w["x"] - w["w"]) <= 0.06 * width:
            titles[k + 1] = f"{titles[k + 1]} {text_of(w)}".strip()
    return [{"row": r, "col": c, "text": v} for r, row in enumerate([titles, *body]) for c, v in enumerate(row)]


# Charts in drawings


def vector_bars(rectangles: list[Row]) -> list[Row]:
    """The filled rectangles that share one foot (3 units), if there are four or more: bars."""
    filled = [r for r in rectangles if r.get("fill") and r["w"] > 0 and r["h"] > 0]
    groups = first_fit(sorted(filled, key=lambda r: r["y"] + r["h"]), lambda r: r["y"] + r["h"], 3)
    best = max(groups, key=len, default=[])
    return sorted(best, key=lambda r: r["x"]) if len(best) >= 4 else []


def raster_chart(images: list[Row], page: float = 1000) -> str | None:
    """scatterplot for eight or more small square images, pie for eight or more other small ones."""
    small = [r for r in images if 0 < r["w"] <= 0.25 * page and 0 < r["h"] <= 0.25 * page]
    square = sum(0.8 <= r["w"] / r["h"] <= 1.25 and r["w"] <= 0.03 * page for r in small)
    if len(small) < 8:
        return None
    return "scatterplot" if square >= 8 else "pie"


# Text


def inline_sections(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, seq, section, title of regions with two or more lines that open with capitals and a colon; lines above the
    first are section 0."""
    order = Window.partitionBy(*keys).orderBy("y", "x", "seq")
    title = F.nullif(F.regexp_extract("text", r"(?U)^\s*([\p{Lu}][\p{Lu}\d &/'-]{2,}):", 1), F.lit(""))
    marked = lines.withColumn("_t", title)
    enough = marked.groupBy(*keys).agg(F.count("_t").alias("_n")).where("_n >= 2").select(*keys)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return marked.join(enough, list(keys), "left_semi").select(*keys, "seq", F.count("_t").over(upto).alias("section"), F.last("_t", True).over(upto).alias("title"))


def segmented(text: str, vocabulary: dict[str, int]) -> list[str]:
    """A word run together, split into known words (three letters or more, on two pages or more) with most pieces; whole
    if it cannot be split completely."""
    low = text.lower()
    best: list[list[str] | None] = [[], *[None] * len(low)]
    for end in range(1, len(low) + 1):
        for start in range(max(0, end - 24), end - 2):
            head = best[start]
            if head is not None and vocabulary.get(low[start:end], 0) >= 2 and (best[end] is None or len(head) + 1 > len(best[end])):
                best[end] = [*head, text[start:end]]
    return best[-1] or [text]


PROFILE = "photo long, biography long"


def profile_rows(rows: list[Row]) -> list[Row]:
    """Photographs (role photo) and the biography beside each: side by side for 45 % of the shorter, from 20 over to 250
    apart; from the top, each used once."""
    photos = reading(r for r in rows if r["role"] == "photo")
    texts = reading(r for r in rows if r["role"] != "photo")
    out = []
    for p in photos:
        fit = []
        for t in texts:
            high = min(p["y"] + p["h"], t["y"] + t["h"]) - max(p["y"], t["y"])
            gap = t["x"] - p["x"] - p["w"]
            if high >= 0.45 * max(1, min(p["h"], t["h"])) and -20 <= gap <= 250:
                fit.append((gap, t))
        if fit:
            taken = min(fit, key=lambda f: (abs(f[0]), f[1]["seq"]))[1]
            texts.remove(taken)
            out.append({"photo": p["seq"], "biography": taken["seq"]})
    return out


def absorbed_islands(islands: DataFrame, visuals: DataFrame, items: DataFrame, lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, region, visual, item of text regions inside a visual (2 units over) whose two lines are the label and value
    of exactly one proposed item of it.

    items: keys, visual, item, label, value; lines: keys, region, text."""
    i, v = box(), box("v_")
    inside = (i.x >= v.x - 2) & (i.y >= v.y - 2) & (i.right <= v.right + 2) & (i.bottom <= v.bottom + 2)
    held = page_join(islands, prefixed(visuals.withColumnRenamed("region", "visual"), "v_", keys), keys, inside).select(*keys, "region", F.col("v_visual").alias("visual"))
    said = lines.groupBy(*keys, "region").agg(F.array_sort(F.collect_list(T.word_key(F.col("text")))).alias("said")).where(F.size("said") == 2)
    asked = items.select(*keys, "visual", "item", F.array_sort(F.array(T.word_key(F.col("label")), T.word_key(F.col("value")))).alias("said"))
    met = held.join(said, [*keys, "region"]).join(asked, [*keys, "visual", "said"])
    return only(met, [*keys, "region"], ["visual", "item"])


def payload_bindings(payloads: DataFrame) -> DataFrame:
    """page, item, type, label, value, confidence of a region answer in JSON: types in small letters, confidences in 0..1
    (what is no number is 0), entries that are no objects left out."""
    schema = "type string, bindings array<struct<label: string, value: string, confidence: string>>"
    given = payloads.select("page", F.from_json("raw", schema).alias("p"))
    each = given.select("page", F.lower(F.coalesce("p.type", F.lit("unknown"))).alias("type"), F.posexplode(F.filter("p.bindings", lambda b: b.isNotNull())).alias("item", "b"))
    sure = F.coalesce(F.col("b.confidence").try_cast("double"), F.lit(0.0))
    return each.select("page", "item", "type", "b.label", "b.value", F.least(F.greatest(F.when(F.isnan(sure), 0.0).otherwise(sure), F.lit(0.0)), F.lit(1.0)).alias("confidence"))


# The page pipeline


def page_blocks(lines: DataFrame, regions: DataFrame, features: DataFrame) -> DataFrame:
    """doc_id, page, region, type, semantic_role, text, lines, status of the blocks of every page: lines to their owner, visuals to their
    kind, text by its type, and a fallback block for lines that no region owns.

    features: page keys, region and the counters of B.COUNTERS; regions without counters have zeros."""
    page = own.PAGE
    owned = own.with_owner(lines, regions)
    body = owned.where("region IS NOT NULL").groupBy(*page, "region").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "seq", "text"))), lambda s: s["text"]), "\n").alias("text"),
        F.count(F.lit(1)).alias("lines"),
        F.min("y").alias("top"),
    )
    counts = B.line_counts(owned.where("region IS NOT NULL"), [*page, "region"])
    summary = B.vision_summary(features, [*page, "region"])
    routed = regions.select(*page, "region", "kind", "conf").join(body, [*page, "region"]).join(counts, [*page, "region"]).join(summary, [*page, "region"], "left")
    routed = routed.fillna(0.0, list(B.COUNTERS)).withColumns({"visual_hint": F.lit(None).cast("string"), "proposed_type": F.lit(None).cast("string"), "hinted_type": F.lit(None).cast("string"), "n_images": F.lit(0)})
    visual = routed.withColumn("_v", B.visual_kind())
    text_type = T.text_block_type(F.col("text"), F.col("top"), F.lit(10))
    kind = F.when(F.col("kind") == "decoration", "decoration").when(F.col("kind") == "table", "table").when((F.col("kind") == "visual") & (F.col("_v.kind") != "normal_text"), F.col("_v.kind")).otherwise(text_type)
    status = F.when(kind.isin("decoration", "text", "heading", "footnote", "contact"), "passed").otherwise("needs_review")
    made = visual.select(*page, "region", kind.alias("type"), "text", "lines", "top", status.alias("status"))
    words = T.semantic_role(F.col("type"), F.col("text"), F.col("top"), F.col("page"), F.lit(False))
    listed = F.element_at(F.create_map(*(F.lit(v) for pair in B.ROLES.items() for v in pair)), F.col("type"))
    role = F.when(F.col("type").isin("text", "heading", "footnote", "contact"), words).otherwise(listed)
    made = made.select(*page, "region", "type", role.alias("semantic_role"), "text", "lines", "status")
    loose = owned.where("region IS NULL").select(*page, (-1 - F.col("seq")).alias("region"), F.lit("text").alias("type"), F.lit("unresolved_source_text").alias("semantic_role"), "text", F.lit(1).cast("long").alias("lines"), F.lit("needs_review").alias("status"))
    return made.unionByName(loose)


def panel_violations(claims: DataFrame, bullets: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, rule of comparison panels: claims without text, fewer claims than bullets, evidence that is not in the ledger.
    claims: keys, claim, text, evidence_ids."""
    empty = claims.where(F.trim("text") == "").select(*keys, F.lit("claim_without_text").alias("rule"))
    counted = bullets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b")).join(claims.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")), list(keys), "left")
    fewer = counted.where(F.coalesce("_c", F.lit(0)) != F.col("_b")).select(*keys, F.lit("claims_differ_from_bullets").alias("rule"))
    strange = claims.select(*keys, F.explode("evidence_ids").alias("evidence_id")).join(ledger, [*keys, "evidence_id"], "left_anti").select(*keys, F.lit("evidence_not_in_ledger").alias("rule"))
    return empty.unionByName(fewer).unionByName(strange).distinct()


def run_violations(listed: DataFrame, written: DataFrame, document: str) -> DataFrame:
    """document, page, rule: pages that the manifest lists and the run lacks, the other way round, or with another hash.
    Both: document, page, sha256."""
    both = listed.join(written.withColumnRenamed("sha256", "_w"), [document, "page"], "full_outer")
    rule = F.when(F.col("_w").isNull(), "page_missing").when(F.col("sha256").isNull(), "page_not_listed").when(F.col("sha256") != F.col("_w"), "hash_differs")
    return both.withColumn("rule", rule).where("rule IS NOT NULL").select(document, "page", "rule")


def uncaptured(lines: DataFrame, content: DataFrame, raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nonblank lines whose owner neither says them nor keeps them as raw evidence. content: keys, block, text; raw: keys,
    evidence_id; lines carry their block."""
    said = content.select(*keys, "block", T.alnum_key(F.col("text")).alias("_c"))
    met = lines.where(F.trim("text") != "").join(said, [*keys, "block"], "left")
    absent = met.where(~F.coalesce(F.col("_c").contains(T.alnum_key(F.col("text"))), F.lit(False)))
    return absent.join(raw, [*keys, "evidence_id"], "left_anti").drop("_c")

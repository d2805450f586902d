"""Reconciliation of independent proposals with printed evidence and source blocks.

A proposal never supplies a value: it can only confirm a printed one, or correct the label of a printed and owned pair.
Everything ambiguous is declined, and every proposed item gets exactly one decision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.functions.geometry import Box, box, center_in, overlap_of_smaller, same_place

from .joins import best, page_join, prefixed

# The closed vocabularies of decisions.
ITEM_DECISIONS = (
    "no_matching_source_block",
    "agreement",
    "label_corrected_from_printed_pair",
    "printed_amount_attached_to_percentage",
    "printed_vision_value_missing_or_ambiguous_in_source_block",
    "vision_value_not_uniquely_printed",
    "ownership_disagreement_needs_review",
    "printed_pair_outside_block_ownership",
)
CELL_DECISIONS = (
    "no_matching_source_block",
    "row_or_column_owner_unresolved",
    "agreement",
    "native_cell_retained_over_vision_disagreement",
    "table_cell_disagreement_needs_review",
)


def parents(proposals: DataFrame, blocks: DataFrame, keys: Sequence[str], proposal: str, least: float = 0.35) -> DataFrame:
    """keys, proposal, block: for each proposal the block of its type that it overlaps most, and by `least` at least."""
    a, b = box(), box("b_")
    share = overlap_of_smaller(a, b)
    met = page_join(proposals, prefixed(blocks, "b_", keys), keys, (F.col("type") == F.col("b_type")) & (share >= least))
    met = met.withColumn("share", share)
    return best(met.select(*keys, proposal, "share", F.col("b_block").alias("block")), [*keys, proposal], [-F.col("share"), F.col("block")], ["block"])


def missing_tables(proposals: DataFrame, blocks: DataFrame, keys: Sequence[str], proposal: str) -> DataFrame:
    """Proposed tables of two rows or more that no source table answers."""
    tables = proposals.where("type = 'table' AND n_rows >= 2")
    return tables.join(parents(tables, blocks, keys, proposal), [*keys, proposal], "left_anti")


_LETTERS, _PERCENT = "[A-Za-z]", r"^\d+(?:\.\d+)?%$"


def _box_of(line: Column) -> Box:
    return Box(*(line[c] for c in "xywh"))


def _with_lines(wanted: DataFrame, lines: DataFrame, keys: Sequence[str], item: str, condition: Column) -> DataFrame:
    """keys, item and every other column of wanted, with found: the lines of the page that meet the condition on wanted
    and on columns l_..., in order. Only what the condition lets through is gathered, one small list for each item."""
    kept = lines.select(
        *keys,
        *(F.col(c).alias(f"l_{c}") for c in ("seq", "evidence_id", "text", "conf", "x", "y", "w", "h")),
        T.evidence_key(F.col("text")).alias("l_key"),
        F.col("evidence_id").contains("-ocr-").alias("l_ocr"),
    )
    limits = [c for c in wanted.columns if c.startswith("p_")]
    inside = center_in(box("l_"), box("p_"), 15) if limits else F.lit(True)
    asked = wanted.select(*keys, item, *(c for c in wanted.columns if c not in (*keys, item)))
    met = page_join(asked, kept.withColumn("l_on", F.lit(True)), keys, condition, "left")
    line = F.struct(*(F.col(f"l_{c}").alias(c) for c in ("seq", "evidence_id", "text", "conf", "x", "y", "w", "h", "key", "ocr")), inside.alias("inside"))
    rest = [c for c in asked.columns if c not in (*keys, item)]
    gathered = F.array_sort(F.collect_list(F.when(F.col("l_on"), line))).alias("found")
    return met.groupBy(*keys, item).agg(*(F.first(c).alias(c) for c in rest), gathered)


def one_place(found: Column) -> Column:
    """Of lines in order the one to cite, if all stand within 15 units of the first; else null. Recognised lines come
    before native ones, then the more confident."""
    first = F.get(found, F.lit(0))
    alone = F.forall(found, lambda line: same_place(_box_of(first), _box_of(line)))
    ranked = F.transform(found, lambda line: F.struct((~line["ocr"]).alias("native"), (-line["conf"]).alias("conf"), line["seq"].alias("seq"), line.alias("line")))
    return F.when((F.size(found) > 0) & alone, F.array_min(ranked)["line"])


def joined_lines(found: Column, wanted: Column, value: Column) -> Column:
    """The two lines, or failing that three, that print the wanted key together, in reading order; null if several such
    sets do. They stand near the value: centres within 170, tops from 150 above its top to 20 below; the last begins at
    most 100 below the first."""
    at = _box_of(value)
    near = lambda line: (F.abs(_box_of(line).cx - at.cx) <= 170) & line["y"].between(at.y - 150, at.y + 20)
    pool = F.filter(found, lambda line: line["ocr"] & line["inside"] & line["text"].rlike(_LETTERS) & (line["key"] != "") & wanted.contains(line["key"]) & near(line))
    order = F.array_sort(F.transform(pool, lambda line: F.struct(*(line[c].alias(c) for c in ("y", "x", "seq", "evidence_id", "w", "h", "key")))))

    def after(head: Column, printed: Column) -> Column:
        """head with each later line that goes on with the wanted key."""
        last, first = F.element_at(head, -1), F.element_at(head, 1)
        more = F.filter(order, lambda line: (last < line) & (line["y"] - first["y"] <= 100) & wanted.startswith(F.concat(printed, line["key"])))
        return F.transform(more, lambda line: F.concat(head, F.array(line)))

    text = lambda lines: F.array_join(F.transform(lines, lambda line: line["key"]), "")
    pairs = F.flatten(F.transform(order, lambda a: after(F.array(a), a["key"])))
    two = F.filter(pairs, lambda lines: text(lines) == wanted)
    three = F.filter(F.flatten(F.transform(pairs, lambda lines: after(lines, text(lines)))), lambda lines: text(lines) == wanted)
    sets = F.when(F.size(two) > 0, two).otherwise(three)
    return F.when(F.size(sets) == 1, F.get(sets, F.lit(0)))


def _envelope(lines: Column) -> Column:
    """A struct of evidence_ids, x, y, w, h."""
    each = lambda get: F.transform(lines, get)
    x, y = F.array_min(each(lambda f: f["x"])), F.array_min(each(lambda f: f["y"]))
    right, foot = F.array_max(each(lambda f: f["x"] + f["w"])), F.array_max(each(lambda f: f["y"] + f["h"]))
    ids = each(lambda f: f["evidence_id"])
    return F.when(lines.isNotNull(), F.struct(ids.alias("evidence_ids"), x.alias("x"), y.alias("y"), (right - x).alias("w"), (foot - y).alias("h")))


def unique_printed(wanted: DataFrame, lines: DataFrame, keys: Sequence[str], item: str, text: str) -> DataFrame:
    """keys, item, evidence_id and box of the one place where an item's text is printed, inside its proposal (p_x, p_y,
    p_w, p_h; 15 to every side) where wanted has that. An item printed in two places is declined."""
    asked = wanted.withColumn("_wanted", T.evidence_key(F.col(text))).where("_wanted <> ''")
    found = _with_lines(asked, lines, keys, item, F.col("_wanted") == F.col("l_key"))
    one = found.select(*keys, item, one_place(F.filter("found", lambda line: line["inside"])).alias("_one")).where("_one IS NOT NULL")
    return one.select(*keys, item, *(F.col(f"_one.{c}").alias(c) for c in ("evidence_id", "x", "y", "w", "h")))


def joined_labels(wanted: DataFrame, lines: DataFrame, keys: Sequence[str], item: str, text: str) -> DataFrame:
    """keys, item, evidence_ids and envelope of the lines near an item's value (v_x, v_y, v_w, v_h) that print its label
    together: joined_lines, for labels that no single line prints."""
    asked = wanted.withColumn("_wanted", T.evidence_key(F.col(text)))
    found = _with_lines(asked, lines, keys, item, F.col("_wanted").contains(F.col("l_key")))
    value = F.struct(*(F.col(f"v_{c}").alias(c) for c in "xywh"))
    one = found.select(*keys, item, _envelope(joined_lines(F.col("found"), F.col("_wanted"), value)).alias("_one")).where("_one IS NOT NULL")
    return one.select(*keys, item, "_one.*")


def label_owns_value(label: Box, value: Box) -> Column:
    """The value stands under (or beside) its label."""
    below = value.y - label.bottom
    return (F.abs(label.cx - value.cx) <= F.greatest(F.lit(90.0), (label.w + value.w) * 0.65)) & below.between(-25, 150)


def reconcile_items(claims: DataFrame, lines: DataFrame, observations: DataFrame, owned: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """One decision for each claim.

    claims: keys, item, type (of the proposal), label, value, block (null without a parent), pie (its parent is one), and
    the proposal's box p_x, p_y, p_w, p_h. observations: block, obs, category, series, raw_value, value_evidence_id,
    companion_raw, companion_evidence_id. owned: block, evidence_id of the lines that a block owns.

    percentage_evidence_id: the one owned percentage below a printed amount of a pie, when an observation of it takes the
    amount as companion, or has its label confirmed or corrected."""
    at = [*keys, item]
    key = lambda c: T.evidence_key(F.coalesce(F.col(c), F.lit("")))
    asked = claims.withColumn("_vkey", key("value")).withColumn("_lkey", key("label"))
    part = F.col("l_ocr") & (F.col("l_key") != "") & F.col("_lkey").contains(F.col("l_key"))
    percent = F.col("l_ocr") & F.trim("l_text").rlike(_PERCENT)
    found = _with_lines(asked, lines, keys, item, F.col("l_key").isin(F.col("_vkey"), F.col("_lkey")) | part | percent)
    mine = owned.groupBy("block").agg(F.collect_set("evidence_id").alias("_owned"))  # the lines of one block of a page
    claim = F.struct("obs", "category", "series", key("raw_value").alias("raw"), key("companion_raw").alias("side"), F.col("value_evidence_id").alias("vid"), F.col("companion_evidence_id").alias("cid"))
    seen = observations.groupBy("block").agg(F.array_sort(F.collect_list(claim)).alias("_claims"))
    found = found.join(mine, "block", "left").join(seen, "block", "left")

    printed = lambda wanted: F.filter("found", lambda line: line["inside"] & (wanted != "") & (line["key"] == wanted))
    found = found.withColumn("_value", one_place(printed(F.col("_vkey")))).withColumn("_single", one_place(printed(F.col("_lkey"))))
    several = F.when(F.col("_single").isNull() & F.col("_value").isNotNull(), joined_lines(F.col("found"), F.col("_lkey"), F.col("_value")))
    plain = F.struct(*(F.col(f"_single.{c}").alias(c) for c in ("y", "x", "seq", "evidence_id", "w", "h", "key")))
    found = found.withColumn("_label", _envelope(F.when(F.col("_single").isNotNull(), F.array(plain)).otherwise(several)))
    v, label = F.col("_value"), F.col("_label")
    found = found.withColumn("pair_printed", F.coalesce(label_owns_value(_box_of(label), _box_of(v)), F.lit(False)))
    both_owned = F.coalesce(F.array_contains("_owned", v["evidence_id"]) & (F.size(F.array_except(label["evidence_ids"], F.col("_owned"))) == 0), F.lit(False))

    same = F.filter("_claims", lambda c: (c["raw"] == F.col("_vkey")) | (c["side"] == F.col("_vkey")))
    found = found.withColumn("_same", F.coalesce(same, F.expr("filter(_claims, c -> false)")))
    exact = F.filter("_same", lambda c: F.coalesce(c["vid"] == v["evidence_id"], F.lit(False)) | F.coalesce(c["cid"] == v["evidence_id"], F.lit(False)))
    found = found.withColumn("_chosen", F.when((F.size("_same") > 1) & v.isNotNull(), exact).otherwise(F.col("_same")))
    one = F.coalesce(F.size("_chosen"), F.lit(0)) == 1

    amount = F.col("pair_printed") & (F.col("type") == "chart") & F.col("pie") & v["text"].rlike("[$€£]")
    below = lambda p: (F.abs(_box_of(p).cx - _box_of(v).cx) <= 75) & (p["y"] - _box_of(v).bottom).between(-12, 75)
    stacked = F.filter("found", lambda p: p["ocr"] & F.trim(p["text"]).rlike(_PERCENT) & F.coalesce(F.array_contains("_owned", p["evidence_id"]), F.lit(False)) & below(p))
    found = found.withColumn("_percent", F.when(amount & (F.size(stacked) == 1), F.get(stacked, F.lit(0))))
    of_it = F.filter("_claims", lambda c: (c["vid"] == F.col("_percent.evidence_id")) & (c["raw"] == F.col("_percent.key")))
    found = found.withColumn("_of_it", F.when(F.col("_percent").isNotNull(), of_it)).withColumn("_stacked", F.coalesce(F.size("_of_it"), F.lit(0)) == 1)
    attached = F.col("_stacked") & both_owned & F.get("_of_it", F.lit(0))["cid"].isNull() & T.numeric_value(v["text"])["value"].isNotNull()

    is_kpi, chosen, wanted = F.col("type") == "kpi_panel", F.get("_chosen", F.lit(0)), F.col("_lkey")
    category, series = (T.evidence_key(F.coalesce(chosen[c], F.lit(""))) for c in ("category", "series"))
    own_label = F.when(is_kpi & (series != ""), series).otherwise(category)
    agrees = (own_label == wanted) | (is_kpi & ((series == wanted) | (category == wanted)))
    decision = (
        F.when(F.col("block").isNull(), "no_matching_source_block")
        .when(~one & attached, "printed_amount_attached_to_percentage")
        .when(~one & v.isNotNull(), "printed_vision_value_missing_or_ambiguous_in_source_block")
        .when(~one, "vision_value_not_uniquely_printed")
        .when(agrees, "agreement")
        .when((F.col("type") != "chart") | ~F.col("pair_printed"), "ownership_disagreement_needs_review")
        .when(~both_owned, "printed_pair_outside_block_ownership")
        .otherwise("label_corrected_from_printed_pair")
    )
    found = found.withColumn("decision", decision)
    settled = F.col("decision").isin("agreement", "label_corrected_from_printed_pair", "printed_amount_attached_to_percentage")
    ids = label["evidence_ids"]
    return found.select(*at, "decision", v["evidence_id"].alias("value_evidence_id"), F.get(ids, F.lit(0)).alias("label_evidence_id"), ids.alias("label_evidence_ids"), "pair_printed", F.when(settled & F.col("_stacked"), F.col("_percent.evidence_id")).alias("percentage_evidence_id"))


def companion_percentages(amounts: DataFrame, lines: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """keys, item, evidence_id, text: the one percentage printed right below an amount (75 to either side of its
    centre, from 12 above to 75 below its foot). Amounts with two are declined."""
    percent = lines.where(F.col("evidence_id").contains("-ocr-") & F.trim("text").rlike(r"^\d+(?:\.\d+)?%$"))
    asked = amounts.where(F.col("text").rlike("[$€£]")).select(*keys, item, *(F.col(c).alias(f"a_{c}") for c in "xywh"))
    a, p = box("a_"), box()
    met = page_join(asked, percent.select(*keys, "evidence_id", "text", "x", "y", "w", "h"), keys, (F.abs(p.cx - a.cx) <= 75) & (p.y - a.bottom).between(-12, 75))
    one = met.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("_n"), F.min("evidence_id").alias("evidence_id"), F.min("text").alias("text"))
    return one.where("_n = 1").drop("_n")


def reconcile_cells(proposed: DataFrame, cells: DataFrame, native: DataFrame) -> DataFrame:
    """table_id, item, decision for proposed cells (table_id, item, row_label, column_label, value).

    cells: source cells; native: table_id of tables that the native parser read, whose cells win."""
    key = lambda c: T.evidence_key(F.coalesce(F.col(c), F.lit("")))
    heads = cells.where("row = 0").groupBy("table_id", key("text").alias("_column")).agg(F.count(F.lit(1)).alias("_nc"), F.min("col").alias("col"))
    rows = cells.where("col = 0 AND row > 0").groupBy("table_id", key("text").alias("_row")).agg(F.count(F.lit(1)).alias("_nr"), F.min("row").alias("row"))
    known = cells.select("table_id").distinct().withColumn("_known", F.lit(True))
    asked = proposed.select("table_id", "item", key("row_label").alias("_row"), key("column_label").alias("_column"), key("value").alias("_value"))
    found = asked.join(heads.where("_nc = 1"), ["table_id", "_column"], "left").join(rows.where("_nr = 1"), ["table_id", "_row"], "left")
    body = cells.where("row > 0").select("table_id", "row", "col", key("text").alias("_source"))
    found = found.join(body, ["table_id", "row", "col"], "left").join(known, "table_id", "left").join(native.select("table_id").distinct().withColumn("_native", F.lit(True)), "table_id", "left")
    decision = (
        F.when(F.col("_known").isNull(), "no_matching_source_block")
        .when(F.col("row").isNull() | F.col("col").isNull(), "row_or_column_owner_unresolved")
        .when(F.col("_source") == F.col("_value"), "agreement")
        .when(F.col("_native").isNotNull(), "native_cell_retained_over_vision_disagreement")
        .otherwise("table_cell_disagreement_needs_review")
    )
    return found.select("table_id", "item", decision.alias("decision"))


def visual_bindings(deterministic: DataFrame, model: DataFrame, keys: Sequence[str], additions: bool = True) -> DataFrame:
    """Full outer join on the value's evidence: both agree (confirmed), model alone (added, or unverified when additions
    are not allowed), different labels (conflicted: the deterministic label stays), deterministic alone (retained)."""
    at = [*keys, "value_evidence_id"]
    both = deterministic.select(*at, F.col("label").alias("d_label"), F.col("confidence").alias("d_conf")).join(model.select(*at, F.col("label").alias("m_label"), F.col("confidence").alias("m_conf")), at, "full_outer")
    fold = lambda c: F.lower(F.col(c))
    same = fold("d_label") == fold("m_label")
    status = F.when(F.col("d_label").isNull(), "added" if additions else "unverified").when(F.col("m_label").isNull(), "retained").when(same, "confirmed").otherwise("conflicted")
    conf = F.when(same, F.greatest("d_conf", "m_conf")).otherwise(F.coalesce("d_conf", "m_conf"))
    return both.select(*at, F.coalesce("d_label", "m_label").alias("label"), conf.alias("confidence"), status.alias("status"))


def model_bindings(bindings: DataFrame, lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Model bindings whose value is grounded on one line: by evidence id, else by its text, else by its letters and
    digits, else by a prefix of twelve or more of them. Values with two labels are dropped; of equal ones the most
    confident stays. bindings: keys, item, label, value, evidence_id, confidence."""
    line = lines.select(*keys, F.col("evidence_id").alias("g_id"), F.lower(F.trim("text")).alias("_text"), T.alnum_key(F.col("text")).alias("_key"))
    asked = bindings.select(*keys, "item", "label", "evidence_id", "confidence", F.lower(F.trim("value")).alias("_value"), T.alnum_key(F.col("value")).alias("_vkey"))
    grades = [F.col("evidence_id") == F.col("g_id"), F.col("_value") == F.col("_text"), F.col("_vkey") == F.col("_key"), (F.length("_vkey") >= 12) & F.col("_key").startswith(F.col("_vkey"))]
    grade = F.coalesce(*(F.when(g, n) for n, g in enumerate(grades, 1)))
    met = page_join(asked, line, keys, (grades[0] | grades[1] | grades[2] | grades[3])).withColumn("grade", grade)
    one = met.groupBy(*keys, "item", "label", "confidence", "grade").agg(F.count(F.lit(1)).alias("_n"), F.min("g_id").alias("value_evidence_id"))
    grounded = one.groupBy(*keys, "item", "label", "confidence").agg(F.min(F.struct("grade", "_n", "value_evidence_id")).alias("_b")).where("_b._n = 1")
    grounded = grounded.select(*keys, "item", "label", "confidence", F.col("_b.grade").alias("grade"), F.col("_b.value_evidence_id").alias("value_evidence_id"))
    clear = grounded.groupBy(*keys, "value_evidence_id").agg(F.countDistinct(F.lower("label")).alias("_labels"), F.max(F.struct("confidence", F.col("item") * -1, "label", "grade")).alias("_b")).where("_labels = 1")
    return clear.select(*keys, "value_evidence_id", F.col("_b.label").alias("label"), F.col("_b.confidence").alias("confidence"), F.col("_b.grade").alias("grade"))


def decision_counts(decisions: DataFrame, page: str) -> DataFrame:
    """Decisions of each page and, with page null, of all."""
    counted = decisions.rollup("decision", page).agg(F.count(F.lit(1)).alias("decisions"))
    return counted.where("decision IS NOT NULL").select(F.col(page).alias("page"), "decision", "decisions")


def route_choice(pages: DataFrame) -> DataFrame:
    """page, route: which of the alternative extractions a page keeps.

    Columns: errors_a, errors_b, represented_a, represented_b, structured_a, structured_b, linked_a, linked_b, and of
    the hinted candidate map_iou, map_bindings, pie_verified, pie_items, table_linked, table_baseline, keeps_coverage,
    proposal_type. The earlier route wins only by more content or better links without more errors."""
    content = (F.col("represented_a") >= F.col("represented_b") + 2) & (F.col("structured_a") >= F.col("structured_b"))
    links = (F.col("linked_a") >= F.col("linked_b") + 3) & (F.col("represented_a") >= F.col("represented_b"))
    earlier = (content | links) & (F.col("errors_a") <= F.col("errors_b"))
    clean = F.col("errors_b") == 0
    is_map = (F.col("proposal_type") == "map") & (F.col("map_iou") >= 0.90) & (F.col("map_bindings") >= 5)
    is_pie = (F.col("proposal_type") == "chart") & F.col("pie_verified") & (F.col("pie_items") >= 3)
    is_table = (F.col("proposal_type") == "table") & F.col("keeps_coverage") & (F.col("table_linked") >= 3) & (F.col("table_linked") >= F.col("table_baseline") + 3)
    route = (
        F.when(clean & is_map, "registered_map_candidate_selected")
        .when(clean & is_pie, "verified_chart_candidate_selected")
        .when(clean & is_table, "ocr_supported_table_candidate_selected")
        .when(F.col("proposal_type").isNotNull(), "vision_candidate_rejected_without_independent_support")
        .when(earlier, "pre_paddle_structured_route_preserved_more_ocr_content")
        .otherwise("deterministic_route_retained")
    )
    return pages.select("page", route.alias("route"))


def hint_regions(proposals: DataFrame, regions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """region, hint: the type of the best proposal over each visual region (overlap at least 0.55; two items, one for
    a panel of figures), by overlap, then items."""
    share = overlap_of_smaller(box(), box("r_"), 0)
    enough = F.col("n_items") >= F.when(F.col("type") == "kpi_panel", 1).otherwise(2)
    met = page_join(proposals.where(enough), prefixed(regions, "r_", keys), keys, (F.col("r_kind") == "visual") & (share >= 0.55)).withColumn("share", share)
    return best(met.select(*keys, F.col("r_region").alias("region"), "proposal", "type", "share", "n_items"), [*keys, "region"], [-F.col("share"), -F.col("n_items"), F.col("proposal")], ["type"]).withColumnRenamed("type", "hint")

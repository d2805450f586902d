"""Operators on small tables: declines, planted faults, sinks and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from folioscope.functions.geometry import box, center_in
from folioscope.operators import blocks as B
from folioscope.operators import capture as C
from folioscope.operators import charts as CH
from folioscope.operators import joins as J
from folioscope.operators import ownership as O
from folioscope.operators import reconcile as R
from folioscope.operators import tables as TB
from folioscope.operators import validation as V
from folioscope.sources import proposals as P
from folioscope.sources import sinks
from folioscope.streaming import events as E

LINE = "doc_id long, page long, seq long, evidence_id string, text string, conf long, x long, y long, w long, h long"
REGION = "doc_id long, page long, region long, kind string, x long, y long, w long, h long, conf long"


def lines(spark, *rows):
    return spark.createDataFrame([(1, 1, k, f"p-ocr-{k}", text, 90, x, y, 40, 10) for k, (text, x, y) in enumerate(rows)], LINE)


def regions(spark, *rows):
    return spark.createDataFrame([(1, 1, k, *r) for k, r in enumerate(rows)], REGION)


def test_owner_by_kind_then_size(spark):
    made = lines(spark, ("a", 100, 100), ("b", 400, 400), ("c", 900, 900))
    where = regions(spark, ("decoration", 90, 90, 60, 30, 99), ("normal_text", 0, 0, 600, 600, 50), ("visual", 380, 380, 100, 100, 50), ("normal_text", 390, 390, 80, 80, 50), ("visual", 380, 380, 100, 100, 50))
    assert {r.seq: r.region for r in O.region_owner(made, where).collect()} == {0: 1, 1: 2}
    counted = {r.disposition: r.lines for r in O.dispositions(O.with_owner(made, where)).collect()}
    assert counted == {"normal_text": 1, "visual": 1, "unassigned": 1}


def test_grid_join_equals_page_join(spark):
    import random

    rng = random.Random(2)
    made = lines(spark, *((f"t{k}", rng.randint(0, 950), rng.randint(0, 950)) for k in range(80)))
    where = regions(spark, *(("visual", rng.randint(0, 800), rng.randint(0, 800), rng.randint(1, 300), rng.randint(1, 300), 1) for _ in range(40)))
    right = J.prefixed(where, "r_", ["doc_id", "page"])
    a, b = box(), box("r_")
    ids = lambda df: sorted((r.seq, r.r_region) for r in df.select("seq", "r_region").collect())
    keys = ["doc_id", "page"]
    plain = J.page_join(made, right, keys, center_in(a, b))
    assert ids(J.grid_join(made, right, keys, a, b, center_in(a, b), 100)) == ids(plain) and plain.count() > 20
    assert "Cartesian" not in plain._jdf.queryExecution().toString()


def test_coverage_lists_what_is_missing(spark):
    made = lines(spark, ("$1,200", 100, 100), ("44.5%", 100, 120), ("right 777", 800, 100), ("no digit", 100, 140), ("9", 100, 160))
    content = spark.createDataFrame([(1, 1, 90, 90, 100, 60, "total 1200 and 44.5 %")], "doc_id long, page long, x long, y long, w long, h long, text string")
    found = {r.text: r.represented for r in O.numeric_coverage(made, content).collect()}
    assert found == {"$1,200": True, "44.5%": True, "right 777": False}


def test_bands_need_three_pages(spark):
    rows = [(1, p, 0, "visual", 0, 900, 1000, 80, 50) for p in (1, 2, 3)] + [(1, p, 1, "visual", 0, 20, 1000, 80, 50) for p in (1, 2)] + [(1, 1, 2, "visual", 0, 400, 1000, 80, 50)]
    found = O.repeated_bands(spark.createDataFrame(rows, REGION), "doc_id", "page").collect()
    assert {(r.page, r.region) for r in found} == {(1, 0), (2, 0), (3, 0)}


def cells(spark, grid, name="t"):
    rows = [(name, r, c, v) for r, row in enumerate(grid) for c, v in enumerate(row)]
    return spark.createDataFrame(rows, "table_id string, row long, col long, text string")


def test_totals_need_three_total_rows(spark):
    grid = [["", "A", "B", "C"], ["Total x", "10", "1.5", "-"], ["total y", "(4)", "2", "3"], ["Grand total", "6", "3.6", "3"]]
    found = {r.col: r.passed for r in TB.total_checks(cells(spark, grid)).collect()}
    assert found == {1: True, 2: False}
    assert TB.total_checks(cells(spark, grid[:3])).count() == 0


def test_grounding_uses_a_value_once_and_declines_ties(spark):
    table = cells(spark, [["", "v"], ["Cash", "10"], ["Debt", "10"], ["Fees", "7"]])
    made = [("Cash", 0, 100), ("10", 200, 100), ("Debt", 0, 300), ("10", 200, 300), ("Fees", 0, 500), ("7", 200, 500), ("7", 300, 505)]
    printed = spark.createDataFrame([("t", f"e{k}", t, x, y, 40, 10) for k, (t, x, y) in enumerate(made)], "table_id string, evidence_id string, text string, x long, y long, w long, h long")
    found = {(r.row, r.evidence_id) for r in TB.ground_cells(table, printed, 2, F.lit(500)).collect()}
    assert found == {(1, "e1"), (2, "e3")}
    ordered = {(r.row, r.evidence_id) for r in TB.ground_cells(table, printed, 2, F.lit(500), in_order=True).collect()}
    assert ordered == found


def test_two_or_three_lines_make_a_label(spark):
    made = lines(spark, ("Real", 100, 100), ("Estate", 100, 115), ("Cash", 300, 100), ("Real", 600, 100), ("Other", 600, 115), ("Real", 110, 130), ("Net", 500, 100), ("Asset", 500, 115), ("Value", 500, 130))
    keys, at = ["doc_id", "page"], "doc_id long, page long, item long"
    asked = [(1, 1, 0, "Real Estate", 100, 140), (1, 1, 1, "Cash", 300, 120), (1, 1, 2, "Nothing", 100, 140), (1, 1, 3, "Real Estate", 800, 140), (1, 1, 4, "Net Asset Value", 500, 145), (1, 1, 5, "Estate Real", 100, 140)]
    wanted = spark.createDataFrame([(*r, 40, 10) for r in asked], f"{at}, label string, v_x long, v_y long, v_w long, v_h long")
    found = {r.item: (r.evidence_ids, r.x, r.y, r.h) for r in R.joined_labels(wanted, made, keys, "item", "label").collect()}
    assert found == {0: (["p-ocr-0", "p-ocr-1"], 100, 100, 25), 4: (["p-ocr-6", "p-ocr-7", "p-ocr-8"], 500, 100, 40), 5: (["p-ocr-1", "p-ocr-5"], 100, 115, 25)}
    twice = made.unionByName(lines(spark, ("x", 0, 0), ("Estate", 120, 135)).where("seq = 1").withColumn("evidence_id", F.lit("p-ocr-20")).withColumn("seq", F.lit(20)))
    assert 0 not in {r.item for r in R.joined_labels(wanted, twice, keys, "item", "label").collect()}


def test_a_value_printed_outside_the_proposal_does_not_decline(spark):
    made = lines(spark, ("5%", 100, 100), ("5%", 100, 800))
    asked = spark.createDataFrame([(1, 1, 0, "5%", 90, 90, 100, 50), (1, 1, 1, "5%", 0, 0, 1000, 1000)], "doc_id long, page long, item long, value string, p_x long, p_y long, p_w long, p_h long")
    found = R.unique_printed(asked, made, ["doc_id", "page"], "item", "value").collect()
    assert [(r.item, r.evidence_id) for r in found] == [(0, "p-ocr-0")]


def test_printed_twice_is_declined_unless_in_one_place(spark):
    made = lines(spark, ("5%", 100, 100), ("5 %", 105, 104), ("7%", 100, 300), ("7%", 500, 300))
    asked = spark.createDataFrame([(1, 1, 0, "5%"), (1, 1, 1, "7%"), (1, 1, 2, "")], "doc_id long, page long, item long, value string")
    found = R.unique_printed(asked, made, ["doc_id", "page"], "item", "value").collect()
    assert [(r.item, r.evidence_id) for r in found] == [(0, "p-ocr-0")]


def test_amount_attaches_to_the_percentage_below(spark):
    made = lines(spark, ("Cash", 100, 100), ("$80M", 100, 120), ("80%", 100, 135))
    keys, at = ["doc_id", "page"], "doc_id long, page long, item long"
    claims = spark.createDataFrame([(1, 1, 0, "chart", "Cash", "$80M", 7, True, 0, 0, 1000, 1000)], f"{at}, type string, label string, value string, block long, pie boolean, p_x long, p_y long, p_w long, p_h long")
    schema = "block long, obs long, category string, series string, raw_value string, value_evidence_id string, companion_raw string, companion_evidence_id string"
    observations = spark.createDataFrame([(7, 3, "Cash", None, "80%", "p-ocr-2", None, None)], schema)
    owned = spark.createDataFrame([(7, f"p-ocr-{k}") for k in range(3)], "block long, evidence_id string")
    decide = lambda claims, observations, owned: R.reconcile_items(claims, made, observations, owned, keys, "item").first()
    found = decide(claims, observations, owned)
    assert (found.decision, found.percentage_evidence_id) == ("printed_amount_attached_to_percentage", "p-ocr-2")
    missing = "printed_vision_value_missing_or_ambiguous_in_source_block"
    assert decide(claims, observations, owned.where("evidence_id <> 'p-ocr-2'")).decision == missing
    assert decide(claims.withColumn("pie", F.lit(False)), observations, owned).decision == missing
    taken = spark.createDataFrame([(7, 3, "Cash", None, "80%", "p-ocr-2", "$9M", "p-ocr-9")], schema)
    assert decide(claims, taken, owned).decision == missing
    companion = spark.createDataFrame([(7, 3, "Other", None, "80%", "p-ocr-2", "$80M", "p-ocr-1")], schema)
    assert decide(claims, companion, owned).decision == "label_corrected_from_printed_pair"


def test_bindings_without_additions(spark):
    schema = "page long, value_evidence_id string, label string, confidence long"
    found = R.visual_bindings(spark.createDataFrame([(1, "a", "X", 80)], schema), spark.createDataFrame([(1, "a", "y", 90), (1, "b", "Z", 70)], schema), ["page"], additions=False)
    assert {(r.value_evidence_id, r.label, r.status) for r in found.collect()} == {("a", "X", "conflicted"), ("b", "Z", "unverified")}


def test_every_disposition(spark):
    schema = "doc_id long, page long, obs string, source string, text string, x long, y long, w long, h long"
    rows = [("a", "native_pdf_word", "word", 100, 100), ("b", "native_pdf_word", "held", 100, 200), ("c", "native_pdf_word", "•", 100, 220), ("d", "native_pdf_word", "lost", 100, 230), ("e", "layout_text", "far away text", 900, 900)]
    asked = spark.createDataFrame([(1, 1, k, s, t, x, y, 30, 10) for k, s, t, x, y in rows], schema)
    made = lines(spark, ("the word here", 95, 100))
    held = spark.createDataFrame([(1, 1, 5, 80, 80, 200, 200, "held content")], "doc_id long, page long, block long, x long, y long, w long, h long, content string")
    found = C.observation_dispositions(asked, C.match_observations(asked, made, ["doc_id", "page"]), held, ["doc_id", "page"])
    assert {r.obs: r.disposition for r in found.collect()} == {"a": "matched_ocr", "b": "content_supported", "c": "verbatim_glyph", "d": "raw_attached", "e": "fallback_text"}


def test_native_words_are_added_once(spark):
    made = lines(spark, ("Total", 100, 100))
    words = spark.createDataFrame([(1, 1, 10 + k, f"p-native-{k}", t, 100, x, y, 40, 10) for k, (t, x, y) in enumerate((("total", 105, 110), ("Net", 300, 100), ("NET", 302, 101), ("Total", 500, 100)))], LINE)
    assert sorted(r.text for r in C.add_native(made, words, ["doc_id", "page"]).collect()) == ["Net", "Total", "Total"]


def test_chart_rules(spark):
    charts = spark.createDataFrame([(1, 2, 2, "passed"), (2, 1, 3, "passed"), (3, 2, 2, "needs_review")], "block long, emitted long, expected long, status string")
    seen = spark.createDataFrame([(1, "a", "m1"), (1, "b", "m2"), (2, "c", None), (3, "d", "m3"), (3, "x", "m3")], "block long, value_evidence_id string, mark string")
    owned = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "block long, evidence_id string")
    found = {(r.block, r.rule) for r in V.chart_violations(charts, seen, owned).collect()}
    assert found == {(2, "incomplete_chart_passed"), (3, "mark_used_twice"), (3, "value_evidence_not_owned")}


def test_axis_needs_three_ticks(spark):
    ticks = lines(spark, ("0%", 10, 700), ("10%", 10, 600), ("20%", 10, 500), ("20%", 10, 505), ("5", 10, 650))
    marks = spark.createDataFrame([(1, 1, 0, 300, 595, 10, 10)], "doc_id long, page long, mark long, x long, y long, w long, h long")
    axis = CH.axis_calibration(ticks, marks, ["doc_id", "page"])
    assert axis.first().ticks == 3 and axis.first().accepted
    point = CH.point_ranges(marks, axis, ["doc_id", "page"]).first()
    assert point.low < 10.5 < point.high
    assert not CH.axis_calibration(ticks.where("seq < 2"), marks, ["doc_id", "page"]).first().accepted


def test_native_quality(spark):
    rows = [(1, c, 10.0 * k, 5.0, 8.0, 10.0) for k, c in enumerate("abcdefghij")] + [(2, "a", 1.0, 1.0, 8.0, 10.0)] * 4 + [(2, "�", 9.0, 1.0, 8.0, 10.0)]
    found = {r.page: (r.coverage, r.quality) for r in B.native_quality(spark.createDataFrame(rows, "page long, text string, x double, y double, w double, h double"), ["page"], 8000.0).collect()}
    assert found[1] == (0.1, round(0.45 + 0.35 + 0.2 * 10 / 120, 5))
    assert found[2] == (0.05, round(0.45 * 0.8 + 0.35 * 2 / 5 + 0.2 * 5 / 120, 5))


def test_page_specs_raise(spark):
    spec = lambda s: P.selected_pages(spark.createDataFrame([(1, s, 6)], "doc_id long, spec string, n_pages long"))
    assert sorted(r.page for r in spec("1-3,5,3").collect()) == [1, 2, 3, 5]
    for bad in ("7", "5-2", "0"):
        with pytest.raises(Exception, match="not within the document"):
            spec(bad).collect()


def test_envelope_clamps(spark):
    made = spark.createDataFrame([(1, 2, "text", None, -5.0, 990.0, 2000.0, 50.0, 0.5, "passed", 3, None)], "page long, block long, type string, semantic_role string, x double, y double, w double, h double, confidence double, status string, region long, evidence_ids array<string>")
    found = B.envelope(made, F.lit("d"), F.lit("0" * 64)).first()
    assert list(found.coordinates) == [0, 990, 1000, 10] and found.semantic_role == "body_text" and found.provenance.ocr_evidence_ids == []
    assert B.vision_summary(spark.createDataFrame([(1, 4)], "region long, bar_candidates long"), ["region"]).first().bar_candidates == 4


def test_runs_are_written_once_and_verified(spark, tmp_path):
    made = spark.createDataFrame([(1, 1, 1, "a"), (1, 1, 0, "b"), (1, 2, 0, "c")], "doc_id long, page long, position long, text string")
    collected = sinks.pages(made, ["doc_id", "page"], "position")
    assert [b.text for b in collected.where("page = 1").first().blocks] == ["b", "a"]
    sinks.write_run(collected, str(tmp_path / "run"), ["page"])
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_run(collected, str(tmp_path / "run"), ["page"])
    receipts = sinks.page_receipts(collected, ["doc_id", "page"]).cache()
    assert sinks.verified(receipts, collected, ["doc_id", "page"]).count() == 0
    changed = sinks.pages(made.withColumn("text", F.upper("text")).where("page = 2"), ["doc_id", "page"], "position")
    assert sinks.verified(receipts, changed, ["doc_id", "page"]).count() == 2
    total = sinks.manifest(receipts, "doc_id").first()
    assert (total.pages, total.blocks, total.status) == (2, 3, "complete")


def test_command_line(spark, tmp_path):
    from folioscope import cli

    assert cli.main(["block_violations", "/root/testdata/sf0.001", str(tmp_path / "a")]) == 1
    assert cli.main(["route_choice", "/root/testdata/sf0.001", str(tmp_path / "b")]) == 0


def test_stream_equals_batch(spark, tmp_path):
    source = spark.read.schema(E.EVENTS).parquet("/root/testdata/sf0.001/events.parquet")
    ordered = source.repartitionByRange(4, "ts")
    ordered.write.parquet(str(tmp_path / "in"))
    stream = E.hourly(E.event_stream(spark, str(tmp_path / "in")))
    E.land(stream, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    landed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("hour", "event_type", "events", "cents").collect()}
    whole = {tuple(r) for r in E.hourly(source).collect()}
    assert landed <= whole and len(landed) >= 0.9 * len(whole)  # the last hour stays open behind the watermark


def test_nothing_imports_the_corpus_package():
    import pathlib
    import re

    root = pathlib.Path(__file__).parents[1] / "folioscope"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path


def test_a_proposal_is_parsed_once_for_each_result(spark):
    import json

    block = {"type": "text", "bbox": [0, 0, 9, 9], "title": "t", "text": "", "parent_index": None, "items": []}
    item = lambda name: {"label": name, "value": "1"}
    blocks = [
        ([block | {"items": [item("a"), None, None, None, item("a"), item("b"), item("a")]}, block], None),
        ([block, block | {"items": [item("b"), item("a"), item("c"), item("a"), item("a"), item("a")]}], "repeated_item"),
        ([block | {"items": [None] * 4}], "repeated_item"),
        ([block, block, block | {"bbox": [0, 0, 9, 8]}, block], None),
        ([block, block, block | {"bbox": [0, 0, 9, 8]}, block, block], "repeated_block"),
        ([block | {"parent_index": 1}, block], "invalid_parent"),
        ([block | {"items": [item(str(k)) for k in range(131)]}], "too_many"),
        ([], None),
        (None, "not_json"),
    ]
    raw = spark.createDataFrame([(k, json.dumps({"page_number": k, "blocks": b})) for k, (b, _) in enumerate(blocks)], "page long, raw string")
    found = P.parsed(raw)
    assert {r.page: r.error for r in found.collect()} == {k: error for k, (_, error) in enumerate(blocks)}
    assert sorted((r.page, r.block, r.n_items) for r in P.proposal_blocks(found).collect()) == [(0, 0, 7), (0, 1, 0), (3, 0, 0), (3, 1, 0), (3, 2, 0), (3, 3, 0)]
    assert sorted((r.item, r.label) for r in P.proposal_items(found).collect()) == [(0, "a"), (1, None), (2, None), (3, None), (4, "a"), (5, "b"), (6, "a")]
    for frame in (found, P.proposal_blocks(found), P.proposal_items(found)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_evidence_rules_read_their_rows_once(spark):
    held = [(1, 1, 1, "a"), (1, 1, 2, "a"), (1, 1, 1, "b"), (1, 1, 1, "b"), (1, 1, None, "c"), (1, 2, 1, "d"), (1, 1, 5, "e"), (1, 1, 5, "blank"), (1, 1, None, "lost")]
    ledger = [(1, 1, "a", "t", 1), (1, 1, "b", "t", 2), (1, 1, "b", "t", 1), (1, 1, "c", "t", None), (1, 1, "d", "t", 1), (1, 1, "e", "t", None), (1, 1, "blank", " ", 5), (1, 1, "no text", None, 5)]
    held = spark.createDataFrame(held, "doc_id long, page long, block long, evidence_id string")
    ledger = spark.createDataFrame(ledger, "doc_id long, page long, evidence_id string, text string, owner long")
    found = V.evidence_violations(held, ledger, ["doc_id", "page"])
    assert sorted((r.rule, r.page, r.block) for r in found.collect()) == [
        ("evidence_not_in_ledger", 1, "blank"),
        ("evidence_not_in_ledger", 1, "lost"),
        ("evidence_not_in_ledger", 2, "d"),
        ("ledger_names_other_owner", 1, "b"),
        ("ledger_names_other_owner", 1, "e"),
        ("line_without_owner", 1, "d"),
        ("several_owners", 1, "a"),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("LogicalRDD") == 2


def test_partitions_of_ownership_follow_the_files(spark, tmp_path):
    from folioscope.sources.evidence import evidence_lines, page_regions

    for k in range(3):
        spark.range(k, k + 1).selectExpr("id AS doc_id", "repeat('a line of text\n', 100) AS text").write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    made = evidence_lines(spark, str(tmp_path))
    assert J.pieces(made) == J.pieces(made.join(page_regions(made), ["doc_id", "page"])) == spark.sparkContext.defaultParallelism
    assert J.pieces(made, 100) > 3 * spark.sparkContext.defaultParallelism
    assert J.pieces(lines(spark, ("a", 1, 1))) is None
    assert O.region_owner(made, page_regions(made)).count() == O.with_owner(made, page_regions(made), "inner").count() == O.with_owner(made, page_regions(made)).count() - O.with_owner(made, page_regions(made), "left_anti").count() > 0
    assert "REPARTITION_BY_NUM" in O.region_owner(made, page_regions(made))._jdf.queryExecution().executedPlan().toString()

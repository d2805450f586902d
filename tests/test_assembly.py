"""Assembly of tables, sections and pages on small cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from folioscope.operators import assembly as A
from folioscope.operators import tables as TB


def line(k, text, x, y, w=40, h=10, **more):
    return {"seq": k, "evidence_id": f"p-ocr-{k}", "text": text, "x": x, "y": y, "w": w, "h": h, **more}


@pytest.mark.parametrize(
    ("grid", "want"),
    [
        ([["Fund facts", "", ""], ["", "2023", "2024"], ["Fees", "$", "5"], ["Yield", "7% $", "9"]], ("Fund facts", [["", "2023", "2024"], ["Fees", "", "$5"], ["Yield", "7%", "$9"]])),
        ([["5", "Cash"], ["7", "Debt"]], (None, [["Cash", "5"], ["Debt", "7"]])),
        ([["A", "", "B"], ["x", "", "1"]], (None, [["A", "B"], ["x", "1"]])),
        ([], (None, [])),
        ([["", None]], (None, [])),
    ],
)
def test_normal_grid(grid, want):
    got = A.normal_grid(grid)
    assert (got["title"], got["rows"]) == want


def test_layout_tables_keep_their_scale(spark):
    cells = spark.createDataFrame([(t, 1, 1, "$5M") for t in ("native", "layout")] + [("native", 0, 1, "$"), ("layout", 0, 1, "$")], "table_id string, row long, col long, text string")
    found = A.typed_cells(cells, TB.column_kinds(cells), cells.where("table_id = 'layout'")).collect()
    assert {r.table_id: (r.unit, r.normalized) for r in found} == {"native": ("USD", 5.0), "layout": ("USD", 5e6)}


def test_candidates_take_their_box_by_number(spark):
    html = "<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>"
    rows = [(1, 1000, 500, [("text", 0.9, [0.0, 0.0, 1.0, 1.0]), ("table", 0.8, [100.0, 50.0, 600.0, 550.0])], [(html, None), ("<table><tr><td>x</td></tr></table>", None), ("<table><tr><td>x</td></tr><tr><td>y</td></tr></table>", [0.0, 0.0, 100.0, 100.0])])]
    schema = "page long, width long, height long, boxes array<struct<label string, score double, coordinate array<double>>>, tables array<struct<html string, bbox array<double>>>"
    found = {r.candidate: (r.structure, r.score, r.x, r.y, r.w, r.h) for r in A.table_candidates(spark.createDataFrame(rows, schema)).collect()}
    assert found == {0: ("grid", 0.8, 100, 100, 500, 900), 2: ("layout_only", None, 0, 0, 100, 200)}


def test_ocr_grid_and_aligned_table():
    lines = [line(0, "Name", 0, 0), line(1, "Value", 200, 4), line(2, "Cash", 5, 30), line(3, "5", 210, 34), line(4, "7", 205, 60)]
    assert [(c["row"], c["col"], c["text"]) for c in A.ocr_grid(lines)] == [(0, 0, "Name"), (0, 1, "Value"), (1, 0, "Cash"), (1, 1, "5"), (2, 1, "7")]
    words = [line(0, "2023", 270, 0, 30), line(1, "2024", 470, 0, 30)]
    for k in range(7):
        words += [line(10 * k + 2, f"Item{k}", 50, 20 + 20 * k), line(10 * k + 3, str(100 + k), 280, 20 + 20 * k, 20), line(10 * k + 4, f"{k}.5%", 475, 20 + 20 * k, 25)]
    cells = {(c["row"], c["col"]): c["text"] for c in A.aligned_table(words)}
    assert [cells[0, c] for c in range(3)] == ["", "2023", "2024"] and [cells[7, c] for c in range(3)] == ["Item6", "106", "6.5%"]
    assert A.aligned_table(words[:14]) == []


def test_drawn_charts():
    bars = [{"x": 50 * k, "y": 300 - 20 * k, "w": 30, "h": 100 + 20 * k, "fill": "blue"} for k in range(5)]
    assert len(A.vector_bars(bars)) == 5 and A.vector_bars(bars[:3]) == [] and A.vector_bars([b | {"y": 90 * k} for k, b in enumerate(bars)]) == []
    dots = [{"x": 10 * k, "y": 5, "w": 10, "h": 10} for k in range(8)]
    assert A.raster_chart(dots) == "scatterplot" and A.raster_chart([d | {"h": 90} for d in dots]) == "pie" and A.raster_chart(dots[:7]) is None


def test_segmentation():
    words = {"north": 5, "star": 3, "northstar": 9, "capital": 2, "rare": 1}
    assert A.segmented("NorthStarCapital", words) == ["North", "Star", "Capital"]
    assert A.segmented("NorthRare", words) == ["NorthRare"] and A.segmented("", words) == [""]


def test_profiles_are_used_once():
    rows = [line(0, "", 50, 100, 100, 100, role="photo"), line(1, "", 50, 250, 100, 100, role="photo"), line(2, "bio a", 170, 100, 300, 100, role="text"), line(3, "bio b", 170, 260, 300, 90, role="text"), line(4, "far", 500, 100, 300, 100, role="text")]
    assert A.profile_rows(rows) == [{"photo": 0, "biography": 2}, {"photo": 1, "biography": 3}]


def test_islands_need_exactly_one_item(spark):
    box = "doc_id long, page long, region long, x long, y long, w long, h long"
    islands = spark.createDataFrame([(1, 1, 5, 110, 110, 50, 30), (1, 1, 6, 700, 700, 50, 30)], box)
    visuals = spark.createDataFrame([(1, 1, 9, 100, 100, 300, 300)], box)
    said = spark.createDataFrame([(1, 1, 5, "Cash"), (1, 1, 5, "20 %"), (1, 1, 6, "Cash"), (1, 1, 6, "20 %")], "doc_id long, page long, region long, text string")
    items = lambda n: spark.createDataFrame([(1, 1, 9, k, "cash", "20%") for k in range(n)], "doc_id long, page long, visual long, item long, label string, value string")
    keys = ["doc_id", "page"]
    assert [(r.region, r.visual, r.item) for r in A.absorbed_islands(islands, visuals, items(1), said, keys).collect()] == [(5, 9, 0)]
    assert A.absorbed_islands(islands, visuals, items(2), said, keys).count() == 0


def test_payload_bindings(spark):
    raw = '{"type": "Chart", "bindings": [{"label": "a", "value": "1", "confidence": 3}, null, {"label": "b", "confidence": "high"}, {"label": "c", "confidence": -1}]}'
    found = A.payload_bindings(spark.createDataFrame([(1, raw), (2, "no json")], "page long, raw string")).collect()
    assert [(r.item, r.type, r.label, r.confidence) for r in sorted(found, key=lambda r: r.item)] == [(0, "chart", "a", 1), (1, "chart", "b", 0), (2, "chart", "c", 0)]


def test_run_and_panel_rules(spark):
    listed = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c")], "doc_id long, page long, sha256 string")
    written = spark.createDataFrame([(1, 1, "a"), (1, 2, "x"), (1, 4, "d")], "doc_id long, page long, sha256 string")
    assert {(r.page, r.rule) for r in A.run_violations(listed, written, "doc_id").collect()} == {(2, "hash_differs"), (3, "page_missing"), (4, "page_not_listed")}
    claims = spark.createDataFrame([(1, 1, "text", ["e1"]), (1, 2, " ", ["e9"])], "page long, claim long, text string, evidence_ids array<string>")
    bullets = spark.createDataFrame([(1, k) for k in range(3)], "page long, bullet long")
    ledger = spark.createDataFrame([(1, "e1")], "page long, evidence_id string")
    assert {r.rule for r in A.panel_violations(claims, bullets, ledger, ["page"]).collect()} == {"claim_without_text", "claims_differ_from_bullets", "evidence_not_in_ledger"}


def test_uncaptured_lines(spark):
    made = spark.createDataFrame([(1, 1, "e1", "Cash 5%"), (1, 1, "e2", "lost"), (1, 1, "e3", "kept raw"), (1, 1, "e4", " ")], "page long, block long, evidence_id string, text string")
    content = spark.createDataFrame([(1, 1, "cash: 5 %")], "page long, block long, text string")
    raw = spark.createDataFrame([(1, "e3")], "page long, evidence_id string")
    assert [r.evidence_id for r in A.uncaptured(made, content, raw, ["page"]).collect()] == ["e2"]


def test_every_line_is_in_one_block(spark):
    from folioscope.sources.evidence import evidence_lines, page_regions

    made = evidence_lines(spark, "/root/testdata/sf0.001")
    features = spark.createDataFrame([(0, 1, 0, 5)], "doc_id long, page long, region long, bar_candidates long")
    found = A.page_blocks(made, page_regions(made), features)
    assert found.agg(F.sum("lines")).first()[0] == made.count()
    assert found.groupBy("doc_id", "page", "region").count().where("count > 1").count() == 0

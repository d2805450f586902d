from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.operators import cards as K

SCHEMA = "page long, seq long, evidence_id string, text string, x double, y double, w double, h double"


def lines(spark, *made):
    return spark.createDataFrame([(1, k, f"p1-ocr-{k}", text, float(x), float(y), float(w), float(h)) for k, (text, x, y, w, h) in enumerate(made)], SCHEMA)


CARDS = [
    ("$", 100, 100, 15, 40), ("277", 130, 100, 60, 40), ("Million", 200, 110, 70, 18), ("Loans funded", 120, 170, 120, 18), ("168", 400, 120, 40, 18), ("Accounts", 390, 150, 80, 18),
    ("$", 100, 400, 15, 40), ("1,146.5", 130, 400, 60, 40), ("million", 200, 410, 70, 18), ("Renewals", 120, 470, 120, 18), ("61", 400, 420, 40, 18), ("Accounts", 390, 450, 80, 18), ("As of 12/31/23", 50, 20, 120, 18),
]


def test_cards_with_counts(spark):
    found = K.figure_cards(lines(spark, *CARDS), ["page"]).orderBy("card", "label").collect()
    got = [(r.card, r.series, r.label, r.normalized, r.unit) for r in found]
    assert got == [(0, "Loans funded", "Accounts", 168.0, "count"), (0, "Loans funded", "amount", 277e6, "USD"), (1, "Renewals", "Accounts", 61.0, "count"), (1, "Renewals", "amount", 1146.5e6, "USD")]
    amount = found[1]
    assert (amount.value, amount.value_evidence_id, amount.label_evidence_id) == ("$277 million", "p1-ocr-1", "p1-ocr-3")
    assert (amount.x, amount.y, amount.w, amount.h) == (100, 100, 170, 40)


def test_no_card_without_a_sign_or_a_name(spark):
    assert K.figure_cards(lines(spark, *(c for c in CARDS if c[0] != "$")), ["page"]).count() == 0
    assert K.figure_cards(lines(spark, *CARDS[:3]), ["page"]).count() == 0
    assert K.figure_cards(lines(spark), ["page"]).count() == 0


def test_a_figure_serves_one_unit(spark):
    """The upper of two units takes the nearest figure; the other takes the next, and repeats of a line count once."""
    made = [("$", 80, 100, 15, 20), ("5", 100, 100, 30, 20), ("7", 60, 112, 30, 20), ("$", 20, 112, 15, 20), ("k", 150, 100, 20, 20), ("m", 150, 115, 20, 20), ("Name", 80, 170, 90, 18), ("Name", 85, 172, 90, 18)]
    (page,) = K.amounts(K.page_lines(lines(spark, *made), ["page"])).collect()
    assert [(t.figure.text, t.unit.text) for t in page.taken] == [("5", "k"), ("7", "m")]
    assert len(page.words) == 1


def test_names_drop_parts_of_parts(spark):
    made = lines(spark, ("Total", 0, 0, 50, 18), ("Total loans", 0, 20, 50, 18), ("- this  year", 0, 40, 50, 18))
    name = made.groupBy("page").agg(F.collect_list(F.struct("seq", "evidence_id", "text", "x", "y")).alias("r")).select(K.card_name(F.col("r")).alias("n")).first().n
    assert (name.name, name.evidence_id) == ("Total loans this year", "p1-ocr-1")

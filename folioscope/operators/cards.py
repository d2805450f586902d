"""Cards of figures: a currency sign, a number and a unit side by side, a name below, and perhaps a count with a name of
its own. A page's short lines are gathered once; candidates and choices are array expressions, bands are windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.functions.geometry import Box

# What units multiply by.
SCALES = {"thousand": 1e3, "k": 1e3, "million": 1e6, "m": 1e6, "mm": 1e6, "billion": 1e9, "b": 1e9}
_FIGURE = r"^\d[\d,]*(?:\.\d+)?$"
_AS_OF = r"(?i)\bas\s+of\b"


def _place(line: Column) -> Box:
    return Box(*(line[c] for c in "xywh"))


def _far(a: Column, b: Column) -> Column:
    return F.hypot(_place(a).cx - _place(b).cx, _place(a).cy - _place(b).cy)


def _nearest(lines: Column, to: Column) -> Column:
    """The line with the least distance, the first of tied ones; null of none."""
    return F.array_min(F.transform(lines, lambda line: F.struct(_far(line, to).alias("far"), line["seq"].alias("seq"), line.alias("line"))))["line"]


def _without_repeats(lines: Column) -> Column:
    """Lines without those that repeat the text of one before at its place (20 to the side, 35 up or down)."""
    same = lambda a, b: (F.lower(a["text"]) == F.lower(b["text"])) & (F.abs(_place(a).cx - _place(b).cx) <= 20) & (F.abs(_place(a).cy - _place(b).cy) <= 35)
    return F.aggregate(lines, F.slice(lines, 1, 0), lambda kept, line: F.when(F.exists(kept, lambda k: same(k, line)), kept).otherwise(F.concat(kept, F.array(line))))


def page_lines(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, figures, units, signs, words: a page's lines by what they can be in a card, in order of seq."""
    text = F.trim("text")
    line = F.struct((~F.col("evidence_id").contains("-ocr-")).alias("native"), (-F.length(text)).alias("short"), "seq", "evidence_id", text.alias("text"), *(F.col(c) for c in "xywh"))
    pages = lines.where(text != "").groupBy(*keys).agg(_without_repeats(F.array_sort(F.collect_list(line))).alias("all"))
    unit = lambda r: F.lower(r["text"]).isin(*SCALES)
    kinds = {
        "figures": lambda r: r["text"].rlike(_FIGURE),
        "units": unit,
        "signs": lambda r: r["text"].isin("$", "€", "£"),
        "words": lambda r: r["text"].rlike("[A-Za-z]") & ~unit(r) & ~r["text"].rlike(_AS_OF),
    }
    return pages.select(*keys, *(F.filter("all", kind).alias(name) for name, kind in kinds.items()))


def amounts(pages: DataFrame) -> DataFrame:
    """pages with taken: structs of figure, unit and sign. Units from the top take the nearest figure left that stands on
    their row before their end, if it has a sign before it within 90 up or down."""
    order = F.array_sort(F.transform("units", lambda u: F.struct(u["y"].alias("y"), u["seq"].alias("seq"), u.alias("unit"))))

    def take(taken: Column, entry: Column) -> Column:
        unit = entry["unit"]
        at = _place(unit)
        free = lambda n: ~F.exists(taken, lambda t: t["figure"]["seq"] == n["seq"])
        figure = _nearest(F.filter("figures", lambda n: free(n) & (_place(n).cx < at.cx + 25) & _place(n).cy.between(at.y - 25, at.bottom + 25)), unit)
        sign = _nearest(F.filter("signs", lambda s: (_place(s).cx < _place(figure).cx) & (F.abs(_place(s).cy - _place(figure).cy) <= 90)), figure)
        card = F.struct(figure.alias("figure"), unit.alias("unit"), sign.alias("sign"))
        return F.when(figure.isNotNull() & sign.isNotNull(), F.concat(taken, F.array(card))).otherwise(taken)

    none = F.expr("slice(transform(units, u -> struct(u as figure, u as unit, u as sign)), 1, 0)")
    return pages.withColumn("taken", F.aggregate(order, none, take))


def card_name(lines: Column) -> Column:
    """A struct of name and evidence_id from lines in reading order, without parts that another part contains or that the
    name so far does; null of none."""
    order = F.array_sort(F.transform(lines, lambda r: F.struct(r["y"].alias("y"), r["x"].alias("x"), r["seq"].alias("seq"), F.trim(F.regexp_replace(r["text"], r"\s+", " "), F.lit(" -")).alias("part"), r["evidence_id"].alias("evidence_id"))))
    key = lambda r: F.lower(r["part"])
    said = lambda parts: F.lower(F.array_join(F.transform(parts, lambda p: p["part"]), " "))

    def add(parts: Column, part: Column) -> Column:
        held = F.exists(order, lambda o: (o["seq"] != part["seq"]) & F.contains(key(o), key(part)))
        return F.when((part["part"] == "") | held | F.contains(said(parts), key(part)), parts).otherwise(F.concat(parts, F.array(part)))

    parts = F.aggregate(order, F.slice(order, 1, 0), add)
    name = F.array_join(F.transform(parts, lambda p: p["part"]), " ")
    return F.when(F.size(parts) > 0, F.struct(name.alias("name"), F.get(parts, F.lit(0))["evidence_id"].alias("evidence_id")))


def figure_cards(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bindings of cards: keys, card (from the top), series (the card's name), label, value, numeric_value, unit,
    normalized, value_evidence_id, label_evidence_id and the value's box.

    A card's band reaches half way to the next one, or from 140 above to 180 below its figure."""
    pages = amounts(page_lines(lines, keys)).where(F.size("taken") > 0)
    used = F.transform("taken", lambda t: t["figure"]["seq"])
    each = pages.select(*keys, "figures", "words", used.alias("used"), F.explode("taken").alias("c")).withColumn("middle", _place(F.col("c.figure")).cy)
    down = Window.partitionBy(*keys).orderBy("middle", "c.figure.seq")
    half = lambda other: (other + F.col("middle")) / 2
    each = each.withColumn("card", F.row_number().over(down) - 1).withColumn("low", F.coalesce(half(F.lag("middle").over(down)), F.col("middle") - 140)).withColumn("high", F.coalesce(half(F.lead("middle").over(down)), F.col("middle") + 180))

    def owners(n: Column) -> Column:
        short = lambda r: (r["w"] >= 1.2 * F.greatest(r["h"], F.lit(1))) & ~r["text"].rlike("(?i)" + T.NUMBER) & (F.size(F.split(r["text"], r"\s+")) <= 4)
        return F.filter("words", lambda r: short(r) & (F.abs(_place(r).cx - _place(n).cx) <= 130) & (_place(r).cy - _place(n).cy).between(0, 100))

    free = F.filter("figures", lambda n: ~F.array_contains("used", n["seq"]) & _place(n).cy.between(F.col("low"), F.col("high")))
    named = F.filter(F.transform(free, lambda n: F.struct(n.alias("figure"), _nearest(owners(n), n).alias("owner"))), lambda p: p["owner"].isNotNull())
    count = F.array_min(F.transform(named, lambda p: F.struct(_far(p["figure"], p["owner"]).alias("far"), p["figure"]["seq"].alias("seq"), p.alias("p"))))["p"]
    each = each.withColumn("count", count)
    figure, unit, sign = F.col("c.figure"), F.col("c.unit"), F.col("c.sign")
    limit = F.coalesce(_place(F.col("count.figure")).cx, F.lit(1000.0)) - 30
    below = F.filter("words", lambda r: r["evidence_id"].contains("-ocr-") & _place(r).cy.between(F.greatest(F.col("low"), F.col("middle") + 45), F.col("high")) & (F.abs(_place(r).cx - _place(F.col("c.figure")).cx) <= 190) & (_place(r).cx < limit))
    each = each.withColumn("name", card_name(below)).where("name IS NOT NULL")

    plain = lambda n: F.regexp_replace(n["text"], ",", "").cast("double")
    scale = F.create_map(*(F.lit(x) for pair in SCALES.items() for x in pair))
    x, y = F.least(sign["x"], figure["x"]), F.least(sign["y"], figure["y"], unit["y"])
    right, foot = _place(unit).right, F.greatest(_place(sign).bottom, _place(figure).bottom, _place(unit).bottom)
    row = lambda **columns: F.struct(*(c.alias(n) for n, c in columns.items()))
    amount = row(label=F.lit("amount"), value=F.concat(sign["text"], figure["text"], F.lit(" "), F.lower(unit["text"])), numeric_value=plain(figure), unit=F.lit("USD"), normalized=plain(figure) * F.element_at(scale, F.lower(unit["text"])), value_evidence_id=figure["evidence_id"], label_evidence_id=F.col("name.evidence_id"), x=x, y=y, w=right - x, h=foot - y)
    n, owner = F.col("count.figure"), F.col("count.owner")
    counted = row(label=owner["text"], value=n["text"], numeric_value=plain(n), unit=F.lit("count"), normalized=plain(n), value_evidence_id=n["evidence_id"], label_evidence_id=owner["evidence_id"], x=n["x"], y=n["y"], w=n["w"], h=n["h"])
    both = F.filter(F.array(amount, F.when(F.col("count").isNotNull(), counted)), lambda b: b.isNotNull())
    return each.select(*keys, "card", F.col("name.name").alias("series"), F.explode(both).alias("b")).select(*keys, "card", "series", "b.*")

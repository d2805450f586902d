"""Lossless capture: every printed line and every source observation ends in exactly one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.functions.geometry import box, center_in

from .joins import best, page_join, prefixed


def match_observations(observations: DataFrame, lines: DataFrame, keys: Sequence[str], observation: str = "obs", margin: float = 14) -> DataFrame:
    """keys, obs, evidence_id: printed lines that say the same as an observation near them.

    A native word needs an equal token, or four characters or more inside the line's key. A layout text needs lines of
    three characters or more that it contains, together 60 % of it."""
    asked = observations.withColumn("_key", T.alnum_key(F.col("text"))).where("_key <> ''").select(*keys, observation, "source", "_key", *(F.col(c).alias(f"o_{c}") for c in "xywh"))
    tokens = F.transform(F.regexp_extract_all("text", F.lit(r"(?U)(\w+)"), F.lit(1)), lambda v: T.alnum_key(v))
    line = lines.select(*keys, "evidence_id", "x", "y", "w", "h", T.alnum_key(F.col("text")).alias("_line"), tokens.alias("_tokens"))
    near = center_in(box(), box("o_"), margin) | center_in(box("o_"), box(), margin)
    met = page_join(asked, line, keys, near)
    word = (F.col("source") == "native_pdf_word") & (F.array_contains("_tokens", F.col("_key")) | ((F.length("_key") >= 4) & F.col("_line").contains(F.col("_key"))))
    part = (F.col("source") != "native_pdf_word") & (F.length("_line") >= 3) & F.col("_key").contains(F.col("_line"))
    words = met.where(word).select(*keys, observation, "evidence_id")
    parts = met.where(part)
    enough = parts.groupBy(*keys, observation).agg((F.sum(F.length("_line")) >= F.max(F.length("_key")) * 0.6).alias("_enough")).where("_enough")
    return words.unionByName(parts.join(enough, [*keys, observation], "left_semi").select(*keys, observation, "evidence_id"))


def observation_dispositions(observations: DataFrame, matched: DataFrame, blocks: DataFrame, keys: Sequence[str], observation: str = "obs", margin: float = 8) -> DataFrame:
    """keys, obs, disposition, block. matched_ocr where a line says the same. Otherwise the smallest block around the
    observation's centre decides: content_supported if its content has the text, verbatim_glyph for a bare layout sign,
    raw_attached else; fallback_text where no block is around it.

    blocks: keys, block, box, content. A fallback block is not offered to later observations; operators.paged does that
    page by page."""
    key = T.alnum_key(F.col("text"))
    asked = observations.join(matched.select(*keys, observation).distinct().withColumn("_matched", F.lit(True)), [*keys, observation], "left")
    held = prefixed(blocks.select(*keys, "block", "x", "y", "w", "h", "content"), "b_", keys)
    met = page_join(asked.select(*keys, observation, "x", "y", "w", "h"), held, keys, center_in(box(), box("b_"), margin))
    around = best(met.select(*keys, observation, (F.col("b_w") * F.col("b_h")).alias("area"), F.col("b_block").alias("block"), F.col("b_content").alias("content")), [*keys, observation], [F.col("area"), F.col("block")], ["block", "content"])
    found = asked.join(around, [*keys, observation], "left")
    tokens = F.transform(F.split("content", r"\s+"), lambda v: T.alnum_key(v))
    said = (F.length(key) >= 2) & F.when(F.col("source") == "native_pdf_word", F.array_contains(tokens, key)).otherwise((F.length(key) >= 5) & T.alnum_key(F.col("content")).contains(key))
    disposition = (
        F.when(F.col("_matched").isNotNull(), "matched_ocr")
        .when(F.col("block").isNull(), "fallback_text")
        .when(said, "content_supported")
        .when(T.is_layout_glyph(F.col("source"), F.col("text")), "verbatim_glyph")
        .otherwise("raw_attached")
    )
    return found.select(*keys, observation, disposition.alias("disposition"), F.when(F.col("_matched").isNull(), F.col("block")).alias("block"))


def capture_lines(lines: DataFrame, owners: DataFrame, blocks: DataFrame, keys: Sequence[str], margin: float = 10) -> DataFrame:
    """keys, seq, block, capture for every line: structured where the owner's content has it, raw_evidence where the
    owner lacks it, structured_nearby where no block owns it but exactly one near it has its text (three characters or
    more), fallback else."""
    at = [*keys, "seq"]
    key = T.alnum_key(F.col("text"))
    held = blocks.select(*keys, "block", "x", "y", "w", "h", T.alnum_key(F.col("content")).alias("key"))
    owned = lines.join(owners.select(*at, "block"), at, "left").withColumn("_key", key)
    mine = held.select(*keys, "block", F.col("key").alias("_content"))
    owned = owned.join(mine, [*keys, "block"], "left")
    loose = owned.where("block IS NULL AND length(_key) >= 3").select(*at, "x", "y", "w", "h", "_key")
    near = page_join(loose, prefixed(held, "b_", keys), keys, center_in(box(), box("b_"), margin) & F.col("b_key").contains(F.col("_key")))
    one = near.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), F.min("b_block").alias("_near")).where("_n = 1").drop("_n")
    found = owned.join(one, at, "left")
    inside = F.coalesce(F.col("_content").contains(F.col("_key")), F.lit(False))
    kind = F.when(F.col("block").isNotNull() & inside, "structured").when(F.col("block").isNotNull(), "raw_evidence").when(F.col("_near").isNotNull(), "structured_nearby").otherwise("fallback")
    return found.select(*at, F.coalesce("block", "_near").alias("block"), kind.alias("capture"))


def suppress_duplicates(texts: DataFrame, claims: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Native-only text blocks without those that repeat a claim's label, value or both: half covered by it, or as near
    as 60 units or its size."""
    from folioscope.functions.geometry import distance, overlap_of_smaller

    said = prefixed(claims.select(*keys, "label", "value", "x", "y", "w", "h"), "c_", keys)
    same = T.word_key(F.col("text")).isin(T.word_key(F.col("c_label")), T.word_key(F.col("c_value")), T.word_key(F.concat_ws(" ", "c_label", "c_value")))
    close = distance(box(), box("c_")) <= F.greatest(F.lit(60.0), F.col("c_w").cast("double"), F.col("c_h").cast("double"))
    return page_join(texts, said, keys, same & ((overlap_of_smaller(box(), box("c_")) >= 0.5) | close), "left_anti")


def add_native(lines: DataFrame, native: DataFrame, keys: Sequence[str], dx: float = 15, dy: float = 45) -> DataFrame:
    """Lines and those native words that no line repeats: equal text within dx and dy. A native word that repeats an
    earlier one stays out as well."""
    from pyspark.sql import Window

    word = native.withColumn("_text", F.lower(F.trim("text")))
    said = prefixed(lines.withColumn("_text", F.lower(F.trim("text"))).select(*keys, "_text", "x", "y", "w", "h"), "l_", keys)
    close: Column = (F.abs(box().cx - box("l_").cx) <= dx) & (F.abs(box().cy - box("l_").cy) <= dy)
    new = page_join(word, said, keys, (F.col("_text") == F.col("l__text")) & close, "left_anti")
    again = Window.partitionBy(*keys, "_text", F.floor(F.col("x") / (2 * dx)), F.floor(F.col("y") / (2 * dy))).orderBy("seq")
    fresh = new.withColumn("_n", F.row_number().over(again)).where("_n = 1").drop("_n", "_text")
    return lines.unionByName(fresh, allowMissingColumns=True)


def duplicate_words(phrases: DataFrame, native: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Native words that a recognised phrase of 20 characters or more around them (15 and 18 units wider) has as a run
    of its words: shown once, so these are left out of the reading text."""
    run = lambda c: F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\w+)"), F.lit(1)), " "), F.lit(" "))
    long = prefixed(phrases.where(F.length("text") >= 20).select(*keys, "x", "y", "w", "h", run(F.col("text")).alias("run")), "p_", keys)
    p = box("p_")
    near = box().cx.between(p.x - 15, p.right + 15) & box().cy.between(p.y - 18, p.bottom + 18)
    return page_join(native.withColumn("_run", run(F.col("text"))).where("length(_run) > 2"), long, keys, near & F.col("p_run").contains(F.col("_run")), "left_semi").drop("_run")

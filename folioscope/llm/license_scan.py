"""License scans by diagonal voting.

The hash of every word pair of every document is joined to the places of the templates' word pairs. A match votes for
the diagonal (place in the document less place in the template). Neighbouring diagonals merge, so that a few words
more or less in a copy do not split it; a diagonal is a span by itself, too. Spans with enough votes are verified word by word in order: a phrase must be
equal, a notice may be few edits away (words put in, left out or changed), fewer the shorter it is; its score is one less
the edits' share of the longer side. Texts are split once for the votes; only texts with a span are read again.

Defined results: one row for each row of the documents. Rows are told apart by doc_id and text (row_key), so null and
repeated doc_ids are judged text by text. Null text has no words. Ties among spans go by place and then by label; their
order changes no result. The templates are a fixed table of under two thousand word pairs, which bounds the broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, id_and_text, row_key, stored
from .grams import WORD, gram_hashes, word_array

GRAM = 2
#: Diagonals this close are one span.
NEAR = 2
#: Share of a notice's word pairs that must vote.
VOTES = 0.6
#: A notice of n words may be (n - FIRM) / PER_EDIT edits away.
FIRM = 5
PER_EDIT = 4
#: Notices with so many pairs take no notice of diagonals with a single vote.
LONG = 30
#: Stand-ins for hashes, at the end of a document without words and of any other, and the first of their two numbers.
EMPTY_MARK, END_MARK = -7_046_029_254_386_353_131, -4_417_276_706_812_531_889
ENDED = -2

# Phrases of the contract.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
# Opening words of well-known public licence notices, with labels of this module's own.
NOTICES = [
    ("agpl-notice", "GNU Affero General Public License"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-notice", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa-notice", "licensed under CC BY-SA 4.0"),
    ("cc-notice", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl-notice", "This work is licensed under the GNU General Public License version 3"),
    ("isc-notice", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-notice", "subject to the terms of the Mozilla Public License, v. 2.0"),
]
# Whole texts of well-known public licences and licence headers.
TEXTS = [
    (
        "apache-header",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    (
        "bsd-full",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED.""",
    ),
    (
        "gpl-header",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program.""",
    ),
    (
        "isc-full",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    ),
    (
        "mit-full",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    ),
    (
        "mpl-header",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
]


def template_words() -> list[tuple[str, bool, list[str]]]:
    """label, whether it is a phrase, words."""
    split = lambda text: re.findall(WORD, ascii_lower(text))
    return [(label, True, split(text)) for label, text in PHRASES] + [(label, False, split(text)) for label, text in NOTICES + TEXTS]


def templates(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """template, pairs, exact, at, hash: one row per word pair of each template; and template, label, notice (words).
    The first has two more rows, for the marks that end every document."""
    rows = [(k, *template) for k, template in enumerate(template_words())]
    table = spark.createDataFrame(rows, "template int, label string, exact boolean, notice array<string>")
    pairs = table.select("template", (F.size("notice") - GRAM + 1).alias("pairs"), "exact", F.posexplode(gram_hashes(F.col("notice"), GRAM)).alias("at", "hash"))
    marks = spark.createDataFrame([(ENDED, 0, False, 0, EMPTY_MARK), (ENDED + 1, 0, False, 0, END_MARK)], pairs.schema)
    return pairs.unionByName(marks), table.select("template", "label", "notice")


def _code(words: Column) -> Column:
    """One character for each word, so that edits of words are edits of characters."""
    letter = lambda w: F.hex(F.pmod(F.xxhash64(w), F.lit(20_000)) + 0x4E00)
    return F.decode(F.unhex(F.array_join(F.transform(words, letter), "")), "UTF-16BE")


def _lines(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Stored: doc_id, row_key, part, template, diagonal, votes, first, last. Each document's list of pair hashes ends in
    a mark, which comes through the join with its place, and so the number of words: one split of the text is enough."""
    words = rows.select("doc_id", "row_key", F.spark_partition_id().alias("part"), word_array(F.col("text")).alias("words"))
    mark = F.when(F.size("words") == 0, F.lit(EMPTY_MARK)).otherwise(F.lit(END_MARK))
    pairs = words.select("doc_id", "row_key", "part", F.posexplode(F.concat(gram_hashes(F.col("words"), GRAM), F.array(mark))).alias("place", "hash"))
    votes = pairs.join(F.broadcast(known), "hash").withColumn("diagonal", F.col("place") - F.col("at"))
    keys = ["doc_id", "row_key", "part", "template", "pairs", "exact", "diagonal"]
    return stored(votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("votes"), F.min("place").alias("first"), F.max("place").alias("last")), "license-lines")


def license_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_words, spans: array of (first, last, label, exact, score), verified, in order of place."""
    rows = id_and_text(docs).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    known, notices = templates(docs.sparkSession)
    lines = _lines(rows, known)
    # Rows alike in doc_id and text of one input partition are one line with that many votes.
    ended = lines.where(F.col("template") <= ENDED + 1).where(F.col("template") >= ENDED)
    counted = ended.select("doc_id", "row_key", F.when(F.col("template") == ENDED, 0).otherwise(F.col("last") + GRAM - 1).cast("long").alias("n_words"), F.explode(F.sequence(F.lit(1), F.col("votes"))).alias("copy")).drop("copy")

    line = lines.where(F.col("template") >= 0).groupBy("row_key", "template", "pairs", "exact", "diagonal").agg(F.max("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    line = line.where(F.col("exact") | (F.col("pairs") < LONG) | (F.col("votes") > 1))
    step = Window.partitionBy("row_key", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal", 1).over(step) > NEAR
    banded = line.where("NOT exact").withColumn("band", F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(step))
    band = banded.groupBy("row_key", "template", "pairs", "exact", "band").agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    # A diagonal stands for itself as well: repeats close by would stretch its band.
    each = line.drop("diagonal").unionByName(band.drop("band")).withColumn("last", F.col("last") + GRAM - 1)
    enough = each.where(F.col("votes") >= F.col("pairs") * F.when(F.col("exact"), 1.0).otherwise(VOTES))
    named = enough.join(F.broadcast(notices), "template")
    spans = stored(named.groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("first", "last", "label", "exact", "notice"))).alias("spans")), "license-spans")

    again = rows.join(spans, "row_key").select("row_key", "spans", word_array(F.col("text")).alias("words"))
    scored = again.select("row_key", F.transform("spans", _scored(F.col("words"))).alias("spans")).dropDuplicates(["row_key"])
    real = F.transform(F.filter("spans", lambda s: s["good"]), lambda s: s.dropFields("good"))
    scored = scored.select("row_key", real.alias("spans"))
    none = F.array().cast(scored.schema["spans"].dataType)
    return counted.join(scored, "row_key", "left").withColumn("spans", F.coalesce("spans", none))


def _scored(words: Column):
    def score(span: Column) -> Column:
        inside = F.slice(words, span["first"] + 1, span["last"] - span["first"] + 1)
        longer = F.greatest(F.size(inside), F.size(span["notice"]))
        edits = F.when(span["exact"], F.when(inside == span["notice"], 0).otherwise(longer)).otherwise(F.levenshtein(_code(inside), _code(span["notice"])))
        allowed = F.when(span["exact"], 0).otherwise(F.greatest(F.floor((F.size(span["notice"]) - FIRM) / PER_EDIT), F.lit(0)))
        return F.struct(span["first"].cast("long").alias("first"), span["last"].cast("long").alias("last"), span["label"].alias("label"), span["exact"].alias("exact"), (1 - edits / longer).alias("score"), (edits <= allowed).alias("good"))

    return score


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = license_spans(docs)
    base = F.filter("spans", lambda s: s["exact"])
    found = found.select("doc_id", "n_words", "spans", base.alias("base"))
    join = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["first"])).alias("last_word"),
        join("base").alias("base_labels"),
        join("spans").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )

from __future__ import annotations

import re

from folioscope.llm import license_scan as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    hits = sorted((k, label) for label, phrase in S.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split())
    places = [k for k, _ in hits]
    return len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in hits}))


TEXTS = [
    "Released under the MIT License. mit license, MIT-license mit mit license",
    "GNU General Public License general public public license general general public license",
    "the apache license apache",
    "Permission is hereby granted, free of charge, to any person who obtains a copy of this software and associated documentation files",
    "Licensed under CC BY-NC 4.0.",
    "licensed under the sea",
    "",
    None,
    "MIT",
    "redistribution and use in source and in binary forms, with or without any modification, are permitted provided that these conditions are met",
    "licensed under apache words the apache x licensed under the license version 2 0 apache license 0 2 version",
    "Copyright X. " + dict(S.TEXTS)["mit-full"].replace("merge, ", "").replace("furnished", "given") + " tail words",
    "start " * 50 + dict(S.TEXTS)["gpl-header"] + " end" * 50 + " Licensed under the Apache License, Version 2.0.",
]


def test_base_equals_brute_force(spark, rows):
    table = [(k, t) for k, t in enumerate(TEXTS)] + [(1000 + r[0], r[1]) for r in rows if r[0] != 307]
    found = S.license_report(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert len(found) == len(table)
    want = {d: base(t) for d, t in table}
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id] for r in found)
    by = {r.doc_id: r for r in found}
    assert by[0].labels == "mit,mit-notice" and by[3].labels == "mit-text" and by[4].labels == "cc-by-nc-notice"
    assert by[5].labels == "" and by[5].score == 0 and by[9].labels == "bsd-notice"
    assert all(0 <= r.score <= 1 for r in found)


def edits(a, b):
    """Edit distance of two lists of words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_labels(text):
    """Labels of all templates that some span of the text is near enough to, by trying every span."""
    w, found = WORD.findall((text or "").translate(LOWER)), set()
    for label, exact, notice in S.template_words():
        n = len(notice)
        allowed = 0 if exact else max(0, (n - S.FIRM) // S.PER_EDIT)
        slack = min(allowed, 3)
        if any(edits(w[k : k + m], notice) <= allowed for m in range(max(1, n - slack), n + slack + 1) for k in range(len(w) - m + 1) if len(set(w[k : k + m]) & set(notice)) >= 0.6 * len(set(notice))):
            found.add(label)
    return ",".join(sorted(found))


def test_labels_equal_brute_force(spark):
    found = S.license_report(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    for r in found:
        assert r.labels == brute_labels(TEXTS[r.doc_id]), r.doc_id
    by = {r.doc_id: r for r in found}
    assert by[10].labels == "apache" and by[11].labels == "mit-full,mit-text" and by[12].labels == "apache,apache-notice,gpl,gpl-header"
    assert 0.9 < by[11].score <= 1


def test_null_and_repeated_ids_are_judged_by_their_own_text(spark):
    rows = [(None, "this is the mit license ok"), (None, "nothing here"), (None, "this is the mit license ok"), (5, "apache license"), (5, "words"), (5, None)]
    found = S.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=str)
    assert got == sorted(((d, *base(t)) for d, t in rows), key=str)


def test_clashing_columns_and_empty_table(docs, no_docs):
    assert S.license_report(docs).count() == docs.count()
    assert S.license_report(no_docs).count() == 0

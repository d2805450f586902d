from __future__ import annotations

import random
import re

from folioscope.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items):
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        hit, found = set(), set()
        for item_id, other in items:
            v = words(other)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n and item_id is not None else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r.item_ids)) for r in frame.collect()), key=str)


def test_equals_brute_force(spark, rows):
    rng = random.Random(1)
    texts = [words(t) for _, t, *_ in rows if t and len(words(t)) > 40][:8]
    items = [(k, " ".join(t[5:30]).upper()) for k, t in enumerate(texts[:4])]
    items += [(10, " ".join(texts[4][3:7])), (11, texts[5][0]), (12, "no such words here at all"), (13, ""), (14, None), (15, " ".join(texts[6][:9])), (16, " ".join(texts[0][5:30])), (None, " ".join(texts[7][:12]))]
    extra = [(500 + k, " ".join(rng.sample(t, 5) + t[8:8 + n] + ["tail"] * 3), "en", "s", 1) for k, (t, n) in enumerate((t, n) for t in texts[:4] for n in (9, 10, 11, 17))]
    extra.append((600, "the the the the the the the the the the the the", "en", "s", 1))
    items.append((17, "the the the the the the the the the the the"))
    table = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string, source string, n_chars long")
    found = D.contamination(table, spark.createDataFrame(items, "item_id long, text string"))
    want = brute([*rows, *extra], items)
    assert got(found) == want
    assert any(v[2] for v in want)


def test_joins_without_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    items = spark.createDataFrame([(1, " ".join(words(rows[3][1])[:12])), (2, "a b c")], "item_id long, text string")
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(D.contamination(table, items)) == brute(rows, [(1, " ".join(words(rows[3][1])[:12])), (2, "a b c")])


def test_clashing_columns_and_dropping(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and not {303, 304} & {r.doc_id for r in kept.select("doc_id").collect()}
    assert D.contamination(no_docs, items).count() == 0
    assert D.contamination(docs, items.limit(0)).where("contaminated").count() == 0


def test_plan_is_native(spark, docs):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    plan = D.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_null_and_repeated_ids_are_judged_by_their_own_text(spark):
    item = " ".join(f"w{k}" for k in range(12))
    other = " ".join(f"v{k}" for k in range(12))
    rows = [(None, item), (None, "clean words"), (None, item), (7, f"x {item} y"), (7, f"{other} z"), (7, "clean"), (8, None), (9, item), (9, item)]
    table, items = spark.createDataFrame(rows, "doc_id long, text string"), [(1, item), (2, other)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert got(D.contamination(table, frame)) == brute(rows, items)
    kept = sorted(map(tuple, D.drop_contaminated(table, frame).collect()), key=str)
    assert kept == sorted([(None, "clean words"), (7, "clean"), (8, None)], key=str)


def test_a_window_of_many_items(spark):
    text = " ".join(f"w{k}" for k in range(10))
    items = [(k, f"{text} end{k}") for k in range(300)]
    found = D.contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == brute([(1, text)], items)

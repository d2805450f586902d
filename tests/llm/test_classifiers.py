from __future__ import annotations

from itertools import product

import numpy as np
import pytest

from folioscope.llm import language_id as I
from folioscope.llm import quality as Q
from folioscope.llm.common import documents

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in I.identify(docs).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_odd_texts(docs, no_docs):
    found = {r.doc_id: r for r in I.identify(docs).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (300, 301, 302))
    assert found[305].lang_pred in ("en", "fr")
    assert I.identify(no_docs).count() == 0
    assert {r.lang_pred for r in I.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).replace("", None, "lang")).collect()} == {"und"}


def test_prediction_ignores_other_columns(spark, docs):
    from pyspark.sql import functions as F

    model = I.train(docs)
    text = docs.select("text").where("text IS NOT NULL").first().text
    assert I.predict([text], model) == I.predict([text], model)
    renamed = docs.withColumn("source", F.lit("other"))
    assert sorted(map(tuple, I.identify(docs).collect())) == sorted(map(tuple, I.identify(renamed).collect()))


def test_a_prediction_depends_on_its_own_text_alone(docs, rows):
    """Bit for bit the same alone, and in any batch."""
    model = I.train(docs)
    texts = ["hello there", "xyz", "", "qrs tuv", *(t or "" for _, t, *_ in rows[:50])]
    alone = [tuple(x[0] for x in I.predict([t], model)) for t in texts]
    for batch in (texts, texts[::-1]):
        found = dict(zip(batch, zip(*I.predict(batch, model), strict=True), strict=True))
        assert [found[t] for t in texts] == alone


def brute_language(text, model):
    """Naive Bayes over the n-grams of one text, each hashed by itself in whole numbers."""
    langs, prior, weights = model
    cleaned = "".join(c if c.isalpha() else " " for c in f"  {text.lower()} ")
    if not cleaned.strip():
        return "und"
    mask, shift = 0xFFFFFFFF, 32 - I.BUCKETS.bit_length() + 1
    totals = np.array(prior, float)
    for k in range(len(cleaned)):
        a, b, c = (ord(x) for x in (cleaned + "  ")[k : k + 3])
        one = a * 0x9E3779B1 & mask
        two = ((one ^ b) * 0x85EBCA6B & mask) + 1 & mask
        three = ((two ^ c) * 0xC2B2AE35 & mask) + 2 & mask
        for bucket in (one >> shift, two >> shift, three >> shift):
            totals += weights[:, bucket]
    return langs[int(totals.argmax())]


def test_language_query_equals_brute_force(docs, rows):
    model = I.train(docs)
    want = sorted((d, brute_language(t or "", model)) for d, t, *_ in rows)
    assert sorted((r.doc_id, r.lang_pred) for r in I.identify(docs).collect()) == want


def test_too_many_labels(docs, monkeypatch):
    monkeypatch.setattr(I, "MOST_LANGUAGES", 1)
    with pytest.raises(ValueError):
        I.train(docs)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    transition = rng.normal(size=(2, 2))
    sizes = np.array([3, 1, 4, 2])
    emission = rng.normal(size=(sizes.sum(), 2)) * 2
    bad, pairs, z = Q.marginals(emission, transition, sizes)
    at, want_pairs = 0, np.zeros((2, 2))
    for k, n in enumerate(sizes):
        weights, ones, steps = [], np.zeros(n), np.zeros((2, 2))
        for labels in product((0, 1), repeat=int(n)):
            w = np.exp(sum(emission[at + i, y] for i, y in enumerate(labels)) + sum(transition[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            weights.append(w)
            ones += w * np.array(labels)
            for a, b in zip(labels, labels[1:], strict=False):
                steps[a, b] += w
        assert z[k] == pytest.approx(np.log(sum(weights)))
        assert bad[at : at + n] == pytest.approx(ones / sum(weights))
        want_pairs += steps / sum(weights)
        at += n
    assert pairs == pytest.approx(want_pairs)


def test_objective_and_gradients():
    """The value by enumeration of all labellings, and the gradients by finite differences."""
    rng = np.random.default_rng(4)
    sizes = np.array([3, 1, 4, 2])
    x, truth = rng.normal(size=(10, 3)), rng.integers(0, 2, 10)
    w, transition = rng.normal(size=3), rng.normal(size=(2, 2))
    value, gw, gt = Q.objective(x, sizes, truth, w, transition)
    want, at = 0.0, 0
    for n in sizes:
        def weight(labels, at=at):
            return sum(x[at + i] @ w * y for i, y in enumerate(labels)) + sum(transition[a, b] for a, b in zip(labels, labels[1:], strict=False))
        whole = np.log(sum(np.exp(weight(labels)) for labels in product((0, 1), repeat=int(n))))
        want += (weight(truth[at : at + n]) - whole) / n / len(sizes)
        at += n
    assert value == pytest.approx(want - Q.PENALTY / 2 * ((w**2).sum() + (transition**2).sum()))
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        assert gw[k] == pytest.approx((Q.objective(x, sizes, truth, w + step, transition)[0] - value) / 1e-6, abs=1e-4)
    for a, b in product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-6
        assert gt[a, b] == pytest.approx((Q.objective(x, sizes, truth, w, transition + step)[0] - value) / 1e-6, abs=1e-4)


def test_quality_query_equals_brute_force(spark, docs, rows):
    """Scores of the query from marginals by enumeration of all labellings, text by text."""
    labels = spark.createDataFrame([(k, int(k % 2 == 0)) for k in range(0, 60)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    found = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}
    for doc_id, text, *_ in rows:
        features, per_text, length = Q.line_features([text or ""])
        n = int(per_text[0])
        if n > 8:
            continue
        bad = Q.with_neighbours(features, per_text) @ model["w"]
        share, whole = 0.0, 0.0
        for y in product((0, 1), repeat=n):
            p = np.exp(sum(b * v for b, v in zip(bad, y, strict=True)) + sum(model["transition"][a, b] for a, b in zip(y, y[1:], strict=False)))
            share += p * sum((m + 1) * v for m, v in zip(length, y, strict=True)) / (length + 1).sum()
            whole += p
        x = -float(Q._logit(np.array(share / whole)))
        assert found[doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(model["a"] * x + model["b"], -30, 30))), abs=1e-4)


def test_stray_labels_count_for_nothing(spark, docs):
    pairs = [(k, int(k % 2 == 0)) for k in range(0, 60)]
    plain, stray = (spark.createDataFrame(p, "doc_id long, quality int") for p in (pairs, [*pairs, (30, 2), (31, -1), (77, 5)]))
    want, got = ({r.doc_id: round(r.score, 5) for r in Q.quality_scores(docs, labels).collect()} for labels in (plain, stray))
    assert want == got


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = Q.quality_scores(documents(spark, SF), labels).collect()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    good = [r for r in held if truth[r.doc_id]]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= 0.95
    assert sum(r.predicted for r in good) / len(good) >= 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_quality_of_odd_texts(spark, docs, no_docs):
    labels = spark.createDataFrame([(k, int(k % 2 == 0), 0) for k in range(0, 60)] + [(None, 1, 0), (3, None, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert Q.quality_scores(docs, labels).count() == docs.count()
    assert Q.quality_scores(no_docs, labels).count() == 0
    assert {r.score for r in Q.quality_scores(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {1.0}
    kept = Q.drop_rejected(docs, labels)
    want = {r.doc_id for r in Q.quality_scores(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_training_reads_whole_texts():
    import pyarrow as pa

    text = "\n".join(["A plain line of prose."] * 60 + ["$$ || ## @@"] * 60)
    (batch,) = Q._pack(iter([pa.record_batch([pa.array([1]), pa.array([text]), pa.array([0]), pa.array([False])], names=["doc_id", "text", "quality", "held"])]))
    features, _, length = Q.line_features([text])
    lines = np.frombuffer(batch.column("lines")[0].as_py(), "<f4").reshape(120, -1)
    assert np.array_equal(lines, np.concatenate([features, length[:, None]], 1).astype("<f4"))

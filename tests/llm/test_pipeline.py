from __future__ import annotations

import corpus_pipeline as P
from folioscope.llm import decontamination, exact_dedup, near_dedup, quality
from folioscope.llm import queries as Q
from folioscope.llm.common import documents, stored

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect_on_what_the_last_kept(spark):
    names = [n for n, _ in P.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = documents(spark, SF)
    items, labels = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    wanted = {
        "quality": lambda d: quality.quality_scores(d, labels).where("predicted = 1"),
        "exact_dedup": lambda d: exact_dedup.exact_groups(d).where("kept"),
        "near_dedup": lambda d: near_dedup.near_groups(d, P.NEAR_PERCENT).where("kept"),
        "decontamination": lambda d: decontamination.contamination(d, items).where("NOT contaminated"),
    }
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    effects = 0
    for name, stage in P.STAGES[:-1]:
        kept = stored(stage(spark, docs, SF), name)
        assert kept.columns == docs.columns
        assert ids(kept) == ids(wanted[name](docs))
        effects += kept.count() < docs.count()
        docs = kept
    assert effects >= 3
    packed = P.STAGES[-1][1](spark, docs, SF)
    assert ids(packed.select("doc_id").distinct()) == ids(docs)


def test_stages_equal_brute_force(spark, rows, tmp_path):
    """Rows that stay after each stage, by the rules in plain Python over row after row: null and repeated doc_ids,
    null texts, copies, near copies and passages."""
    import re

    import test_decontamination as leaks
    import test_near_dedup as near

    text = lambda n, mark: " ".join(f"{mark}{k * k % 97}{k}" for k in range(n))
    item = text(14, "item")
    table = [(r[0], r[1]) for r in rows if r[0] < 303] + [(None, "unique null one"), (None, rows[0][1]), (None, rows[0][1]), (5, "only here five")]
    table += [(None, f"x {item} y"), (None, "w " * 30 + item), (7, item), (400, text(60, "q")), (401, text(60, "q") + " more"), (401, "clean namesake"), (400, text(60, "q"))]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = lambda frame: sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)
    same = lambda t: re.sub(r"[ \t-\r]+", " ", t or "")

    found = stored(P.drop_exact(spark, docs, str(tmp_path)), "exact")
    least = {}
    for d, t in table:
        key = same(t)
        least[key] = d if least.get(key) is None else least[key] if d is None else min(d, least[key])
    want = sorted(((d, t) for d, t in table if d == least[same(t)]), key=str)
    assert kept(found) == want

    after = stored(P.drop_near(spark, found, str(tmp_path)), "near")
    sets = [(d, near.shingle_set(t)) for d, t in want]
    up = list(range(len(sets)))
    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if i is not None and j is not None and x and (x == y or 100 * len(x & y) >= P.NEAR_PERCENT * len(x | y)):
                old, new = up[a], up[b]
                up = [new if u == old else u for u in up]
    first = {u: min((sets[k][0] for k in range(len(sets)) if up[k] == u and sets[k][0] is not None), default=None) for u in up}
    want = sorted((want[k] for k in range(len(want)) if sets[k][0] is None or sets[k][0] == first[up[k]]), key=str)
    assert kept(after) == want and (400, text(60, "q")) in want and (401, "clean namesake") in want

    clean = P.drop_leaked(spark, after, str(tmp_path))
    hits = [leaks.brute([row], [(1, item)])[0][2] for row in want]
    assert kept(clean) == [row for row, n in zip(want, hits, strict=True) if not n]
    assert sum(map(bool, hits)) >= 3


def test_run_leaves_no_tables_of_its_middle_stages(spark):
    from pathlib import Path

    from folioscope.llm.common import workspace

    before = set(Path(workspace(spark)).glob("folioscope-*/run-*"))
    assert P.run(spark, SF).count() > 0
    (own,) = set(Path(workspace(spark)).glob("folioscope-*/run-*")) - before
    assert sorted(x.name for x in own.iterdir()) == ["3", "packing"]


def test_contracts_name_their_columns(spark):
    columns = {
        "op1_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        "op2_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
        "op3_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op4_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op5_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
        "op6_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        "op7_token_shards": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op8_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
        "op9_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op10_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    }
    found = Q.queries()
    assert set(found) == {*columns, "pipeline"}
    for name, wanted in columns.items():
        frame = found[name](spark, SF)
        assert frame.columns[: len(wanted)] == wanted, name
        assert frame.count() > 0

"""The registered corpus queries: thin contracts over the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, language_id, language_model, license_scan, near_dedup, packing, quality, secret_scan, token_files
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    place = lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
    spans = lambda found: F.array_join(F.transform(found, place), ",")
    base = F.filter("findings", lambda f: f["kind"] != "model")
    return found.select(
        "doc_id",
        *(count(kind) for kind in ("assign", "access", "hex")),
        F.sha2(spans(base), 256).alias("base_sha256"),
        spans("findings").alias("spans"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f["score"])), F.lit(0.0)).alias("top_score"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    listed = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), 0, 2048, with_ids=False)


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_shards(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), 2)
    return token_files.read_token_shards(spark, path)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir), 85)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_language_id": op3_language_id,
        "op4_decontamination": op4_decontamination,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_token_shards": op7_token_shards,
        "op8_near_dedup": op8_near_dedup,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_license_scan": op10_license_scan,
        "pipeline": pipeline,
    }


OP2_SQL = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM digests d
JOIN (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY 1) g USING (text_sha256)
"""


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sizes AS (SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(len(w), 5)], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT u.b, r.c FROM r JOIN u ON r.doc_id = u.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op4_decontamination": OP4_SQL, "op8_near_dedup": OP8_SQL}

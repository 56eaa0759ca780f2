"""Registered queries of the operators in this subpackage, with their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sortwell.llm import (
    bpe, exactdedup, jaccard_join, langid, license_scan, line_dedup, mixing, periodic_runs, pii, quality_model,
    quality_rules, secret_scan, whitening,
)
from sortwell.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark, sf_dir):
    return langid.language_id(documents(spark, sf_dir))


@query
def op3_exact_dedup(spark, sf_dir):
    return exactdedup.exact_groups(documents(spark, sf_dir, "doc_id", "text"))


ORACLES["op3_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


@query
def op8_bpe(spark, sf_dir):
    return bpe.bpe_digests(documents(spark, sf_dir, "doc_id", "text"), VOCABULARY)


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(documents(spark, sf_dir, "doc_id", "text", "lang", "source"))


@query
def op10_mixing(spark, sf_dir):
    return mixing.mixing_plan(documents(spark, sf_dir, "doc_id", "source"))


@query
def op4_license_scan(spark, sf_dir):
    return license_scan.license_scan(documents(spark, sf_dir, "doc_id", "text"))


@query
def op5_secret_scan(spark, sf_dir):
    return secret_scan.secret_scan(documents(spark, sf_dir, "doc_id", "text"))


@query
def op7_pii(spark, sf_dir):
    return pii.personal_data(documents(spark, sf_dir, "doc_id", "text"))


@query
def op6_quality_classifier(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.quality_scores(documents(spark, sf_dir, "doc_id", "text"), labels)


@query
def op2_ngram_jaccard(spark, sf_dir):
    return jaccard_join.jaccard_components(documents(spark, sf_dir, "doc_id", "text"))


@query
def op11_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(documents(spark, sf_dir, "doc_id", "text"))


ORACLES["op11_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, line, pos, coalesce(keeper <> doc_id, false) AS dropped FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.run_report(documents(spark, sf_dir, "doc_id", "text"))


@query
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whitening_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

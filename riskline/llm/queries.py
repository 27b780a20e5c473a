"""The ``opN_<name>`` queries: each applies its operator, with production parameters, to the whole table.

``QUERIES`` maps names to functions of (spark, sf_dir), ``ORACLE`` names to DuckDB SQL where SQL can state the
result. The others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskline.llm import chat_format, decontamination, embedding_dedup, quality_rules, spelling_variants, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    from riskline.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and the verdict of the rule cascade."""
    from riskline.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents"))


ORACLE["op2_quality_rules"] = quality_rules.ORACLE_SQL


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the interpolated bigram model of the training split (files read the same twice: stable)."""
    from riskline.llm.lm_scoring import score_documents

    return score_documents(table(spark, sf_dir, "documents"), stable=True)


@query
def op4_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and assembled."""
    from riskline.llm.warc import archive_digest

    return archive_digest(table(spark, sf_dir, "pages"))


ORACLE["op4_warc_captures"] = warc.ORACLE_SQL


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact benchmark windows in every document, by the positional inverted index."""
    from riskline.llm.decontamination import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op5_decontamination"] = decontamination.ORACLE_SQL


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from riskline.llm.html_extraction import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op7_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the byte-level BPE vocabulary of 50k tokens."""
    from riskline.llm.bpe import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by naive Bayes support vectors fitted on ``labels.quality``."""
    from riskline.llm.quality_classifier import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that tries control strings, formatted from its event log and read back."""
    from riskline.llm.chat_format import PROBE, conversation_digests

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return conversation_digests(rows.unionByName(probe))


ORACLE["op9_chat_formatting"] = chat_format.ORACLE_SQL


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are 80 % alike or more."""
    from riskline.llm.jaccard_join import near_duplicate_components

    return near_duplicate_components(table(spark, sf_dir, "documents"))


ORACLE["op10_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda x: x <> '') AS a FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i+4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS doc_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(root) AS c FROM r GROUP BY 1) m USING (doc_id)
"""


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every embedding."""
    from riskline.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings linked at a cosine of 0.9 or more, by randomly rotated binary codes."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op12_embedding_near_dedup"] = embedding_dedup.ORACLE_SQL


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents one edit apart, and the frequent form of each."""
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


ORACLE["op13_spelling_variants"] = spelling_variants.ORACLE_SQL

"""The pipeline: every stage decides on all that its predecessor kept, and the last one's rows follow from that."""

import hashlib
import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from riskline.llm import quality_classifier
from tests.conftest import SF001
from tests.llm.test_jaccard_join import brute
from tests.llm.test_native import contaminated, kept

if not os.path.isdir(SF001):
    pytest.skip("no test tables", allow_module_level=True)


def test_stages_follow_each_other(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_stage", "rules_stage", "near_duplicate_stage", "decontamination_stage", "encoding_stage"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    scores = quality_classifier.score_quality(docs, labels).collect()
    good = {r.doc_id for r in scores if r.predicted}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    rows = [(d, t) for d, t in rows if kept(t)[1]]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, brute(rows), strict=True) if d == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = [r for r, c in zip(rows, contaminated(rows, items), strict=True) if not c[-1]]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for d, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, entry.queries()["pipeline"](spark, SF001).collect())) == sorted(want)
    assert 0 < len(want) < docs.count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names

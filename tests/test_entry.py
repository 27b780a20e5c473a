"""Driver contract: entry() runs; every oracle has a query; fast oracle checks at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from riskline.sources.readers import TEST_TABLES
from tests.conftest import SF001

FAST = [
    "c1_missing_summary",
    "c6_simple_imputation",
    "d2_iqr_outlier_summary",
    "d5_continuous_summary",
    "d9_correlation_pairs",
    "d17_chi_square_stats",
    "d20_mann_whitney_u",
    "i1_stratified_split",
    "k11_evaluate_predictions",
    "k12_roc_curve",
    "c7_knn_impute",
]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["method", "column", "count", "percentage"]
    assert len(rows) == 10


def test_registry_consistent():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 80


def _norm(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return v


@pytest.mark.parametrize("name", FAST)
def test_oracle_agreement_small(spark, name):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    srows = sdf.collect()

    def canon(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)

    assert canon(sdf.columns, srows) == canon(dcols, drows)


def test_entry_without_the_optional_parts(tmp_path):
    """The entry imports, and keeps every other query, in a tree without the llm folders; with or without the pipeline file."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(E.__file__).parent
    shutil.copytree(root / "riskline", tmp_path / "riskline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as E; print(len(E.queries()), any(q.startswith('op') or q == 'pipeline' for q in E.queries()))"
    rest = sum(not (q.startswith("op") or q == "pipeline") for q in E.queries())
    for with_pipeline in (False, True):
        if with_pipeline and (root / "corpus_pipeline.py").exists():
            shutil.copy(root / "corpus_pipeline.py", tmp_path)
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
        assert out.split() == [str(rest), "False"]

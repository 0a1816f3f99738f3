"""The corpus queries that SQL can express, against DuckDB on whole tables."""

import pytest

from terrapanel.llm.oracle import LLM_ORACLE
from tests.compare import compare
from tests.conftest import SF01, SF001


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_corpus_queries_match_sql(spark, sf_dir):
    report = compare(spark, sf_dir, list(LLM_ORACLE), verbose=False)
    assert not {k: v for k, v in report.items() if not v.startswith("OK")}

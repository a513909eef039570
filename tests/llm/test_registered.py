"""The text queries in the driver contract: those with SQL against DuckDB, the others listed."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF0001
from notifyq.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, _digest  # noqa: E402

#: Queries that SQL cannot express; each is tested against a plain version or the public library.
ROWS_ONLY = {
    "op1_token_counts", "op3_quality_classifier", "op4_html_text", "op5_jaccard_join", "op6_bpe_codec", "op7_training_order",
    "op8_decontamination", "op9_embedding_dedup", "op12_language_id",
}


def test_queries_are_registered_and_have_sql_or_are_listed():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert "pipeline" not in entry.oracle_sql()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF0001}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    got = QUERIES[name](spark, SF0001)
    rows = [tuple(r) for r in got.collect()]
    want = con.sql(ORACLE[name])
    expected = want.fetchall()
    assert sorted(got.columns) == sorted(want.columns) and len(rows) == len(expected)
    assert _digest(got.columns, rows)[0] == _digest(want.columns, expected)[0]

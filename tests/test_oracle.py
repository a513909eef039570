"""Registered queries against their DuckDB oracle on sf0.001 (the driver runs sf0.01)."""

import os
import subprocess
import sys

import duckdb
import pytest

from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from notifyq.oracle import ORACLE  # noqa: E402
from notifyq.plans.queries import QUERIES  # noqa: E402
from oracle_check import TABLES, _digest  # noqa: E402

SKIP_SLOW: set[str] = set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


NAMES = sorted(set(ORACLE) - SKIP_SLOW)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF0001)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert _digest(sdf.columns, srows)[0] == _digest(rel.columns, orows)[0]


def test_every_query_has_oracle_or_is_model_or_file_op():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"encrypted_rows", "model_comparison", "best_model", "confusion_matrix",
                         "roc_points", "scored_rows", "file_manifest",
                         "classification_report", "model_run_record"}


def test_core_queries_work_where_the_text_side_cannot_be_imported():
    """A missing package of the text operators leaves the other queries in place."""
    code = (
        "import sys; sys.modules['tiktoken'] = sys.modules['regex'] = sys.modules['zstandard'] = None\n"
        "import __spark_entry__ as e; print('NAMES', *e.queries())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    names = done.stdout.partition("NAMES ")[2].split()
    assert done.returncode == 0 and set(QUERIES) == set(names), done.stderr[-500:]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 5

"""Every registered query of the speech-corpus operators against its DuckDB twin."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from voxtable.plans import sinks  # noqa: F401  registers its queries
from voxtable.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "-"
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ours = sorted(tuple(cell(r[c]) for c in columns) for r in got.collect())
    at = [want.columns.index(c) for c in columns]
    assert ours == sorted(tuple(cell(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_without_twin_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_text_operators(tmp_path):
    """The text operators and their tests may be deleted; their pipeline's file may stay or go with them."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "voxtable"), tmp_path / "voxtable", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout.split()
        assert out == [str(len(QUERIES)), "0", "True"]
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_entry_where_a_text_operator_lacks_a_library(tmp_path):
    """What the text operators import may be missing; the other queries are registered all the same."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "xxhash.py").write_text("raise ImportError('no such library')")
    code = "import __spark_entry__ as e; print(len([n for n in e.queries() if not n.startswith('op') and n != 'pipeline']), set(e.oracle_sql()) <= set(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": f"{tmp_path}{os.pathsep}{root}"}, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len([n for n in QUERIES if not n.startswith("op")])), "True"]

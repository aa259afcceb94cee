"""Every query that SQL can express gives the rows that its SQL gives in DuckDB."""

import datetime
import glob
import importlib
import math
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
CORE = importlib.import_module("litquarry.plans.catalogue")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(CORE.ORACLES))
def test_query_equals_its_sql(spark, duck, small, name):
    rows = CORE.QUERIES[name](spark, small)
    columns = sorted(rows.columns)
    got = sorted([plain(r[c]) for c in columns] for r in rows.collect())
    cur = duck.execute(CORE.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    want = sorted([plain(r[names.index(c)]) for c in columns] for r in cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(CORE.QUERIES) - set(CORE.ORACLES)))
def test_query_without_sql_runs(spark, small, name):
    assert CORE.QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_works_without_the_pipeline_package(tmp_path):
    for name in ("__spark_entry__.py", "litquarry"):
        os.symlink(ROOT / name, tmp_path / name) if name.endswith(".py") else None
    (tmp_path / "litquarry").mkdir()
    for p in (ROOT / "litquarry").iterdir():
        if p.name not in ("llm", "__pycache__"):
            os.symlink(p, tmp_path / "litquarry" / p.name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'gap_digest' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op')], list(q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_a_missing_library_leaves_the_core(tmp_path):
    """Where the training-data package cannot be imported, the other queries stay."""
    (tmp_path / "xxhash.py").write_text("raise ImportError('no xxhash here')")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'gap_digest' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op')], list(q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": f"{tmp_path}:{ROOT}"})


def test_singleton_merge_takes_all_suppliers(spark):
    d = "/root/testdata/sf0.01"
    got = sorted(r.outline_id for r in CORE.QUERIES["singleton_merge"](spark, d).collect())
    assert got == sorted(f"o{r.s_suppkey}" for r in spark.read.parquet(f"{d}/supplier.parquet").collect())

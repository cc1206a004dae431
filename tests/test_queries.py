"""Every query against its SQL, at the smallest size; the entry module without the optional subpackage."""

from __future__ import annotations

import math
import os
import subprocess
import sys
from pathlib import Path

import pytest

from tessera.plans import composite_queries  # noqa: F401  (adds its queries to those of core)
from tessera.plans import queries as core

SF = os.environ.get("TESSERA_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, str, bool)) else str(v)


@needs_data
@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    df = core.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in core.ORACLES:
        assert got
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    out = con.sql(core.ORACLES[name])
    assert sorted(out.columns) == columns
    at = [out.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in out.fetchall()), key=repr)


def test_entry_works_without_the_optional_subpackage(tmp_path):
    root = Path(__file__).resolve().parent.parent
    import shutil

    shutil.copytree(root / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not [n for n in q if n.startswith('op')]; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr

"""Every query with SQL against DuckDB over the same tables."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pytest

from tickweave.plans import catalogue, wire  # noqa: F401  (wire adds its queries)

TABLES = "region nation customer supplier part orders lineitem events".split()


def _value(x):
    if isinstance(x, float) and math.isnan(x):
        return None
    return Decimal(x).normalize() if isinstance(x, Decimal) else x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, small, duck, name):
    df = catalogue.queries()[name](spark, small)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(catalogue.oracle_sql()[name])
    expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cursor.description)
    assert got == expected
    assert got


def test_registry_is_consistent(spark, small):
    import __spark_entry__ as entry

    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert catalogue.queries()["stateful_books"](spark, small).count() > 0


def test_entry_imports_without_the_optional_part(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "tickweave", tmp_path / "tickweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(x.startswith('op') for x in q), list(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})

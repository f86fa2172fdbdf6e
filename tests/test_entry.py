import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SMALL = Path("/root/testdata/sf0.001")


def test_core_never_imports_llm():
    code = "import sys; sys.path.insert(0, '.'); import sieveline.plans.catalog; assert not [m for m in sys.modules if m.startswith('sieveline.llm')]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_sql_only_for_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_llm(tmp_path):
    import shutil

    shutil.copytree(ROOT / "sieveline", tmp_path / "sieveline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'nano_ratio' in e.queries() and 'p7_ids' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


@pytest.mark.skipif(not SMALL.exists(), reason="no test data")
def test_found_queries_of_the_core_on_small_data(spark):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    for p in SMALL.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    for name in ("p3_found", "p5_found", "exclusion_reason_counts", "nano_ratio_summary"):
        df = e.queries()[name](spark, str(SMALL))
        got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
        cur = con.execute(e.oracle_sql()[name])
        cols = [c[0] for c in cur.description]
        want = sorted(map(repr, (tuple(dict(zip(cols, r))[c] for c in sorted(cols)) for r in cur.fetchall())))
        assert got == want, name

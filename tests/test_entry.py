"""Every query runs over the smallest test data, and gives what its SQL gives."""

import glob
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest
from conftest import DATA, ROOT

import __spark_entry__ as entry_module
from chronoloom import queries as core

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def plain(x):
    if hasattr(x, "asDict"):
        return {k: plain(v) for k, v in x.asDict().items()}
    if isinstance(x, list):
        return [plain(v) for v in x]
    if isinstance(x, float):
        return None if x != x else round(x, 6) + 0.0
    return x


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(str([plain(r[i]) for i in order]) for r in rows)


def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", list(core.QUERIES))
def test_core_query(spark, name):
    df = core.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name in core.SQL:
        r = duck().execute(core.SQL[name])
        assert bag(df.columns, rows) == bag([d[0] for d in r.description], r.fetchall())


def test_weighted_sums_signs(spark, tmp_path):
    """Zeros keep the signs that the SQL gives them; ``plain`` leaves them out."""
    one = [0.6] + [0.0] * 30 + [0.8]
    rows = [one + one, [0.6, -1e-7, 1e-7] + [0.0] * 28 + [0.8] + one, [-0.0] * 31 + [1.0] + [-0.0] * 31 + [1.0], [-x for x in one] + one]
    spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = {i: str(v) for i, v in con.execute(core.SQL["weighted_sums"]).fetchall()}
    assert "-0.0" in want[1] and {r["id"]: str(r["vector"]) for r in core.QUERIES["weighted_sums"](spark, str(tmp_path)).collect()} == want


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0


def test_core_stands_alone():
    """The rest imports and has its queries where the subpackage is missing."""
    code = "import sys; sys.modules['chronoloom.llm'] = None; import chronoloom.queries as q; import __spark_entry__ as e; assert 'p2_found' in e.queries() and 'p1_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)})
    for f in ROOT.glob("chronoloom/**/*.py"):
        if "llm" not in f.parts:
            assert "chronoloom.llm" not in f.read_text() and "from .llm" not in f.read_text()

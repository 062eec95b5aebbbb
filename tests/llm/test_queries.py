"""Every query of the subpackage runs; those with SQL give the same."""

import os

import pytest
from conftest import DATA
from test_entry import bag, duck

from chronoloom.llm import queries as Q

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
COLUMNS = {
    "p1_found": ["id_a", "id_b"], "p3_found": ["element_id", "group_id"], "p4_found": ["origin", "record_key", "cid"], "p5_found": ["id_a", "id_b"], "p6_found": ["id", "field", "record_id"],
    "p7_found": ["news_id", "start_char", "end_char"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, name):
    df = Q.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len({str(r) for r in rows}) > 0
    if name in Q.SQL:
        r = duck().execute(Q.SQL[name])
        assert bag(df.columns, rows) == bag([d[0] for d in r.description], r.fetchall())

"""The queries run on the smallest tables, with the columns that are wanted."""

import glob
import os

import duckdb
import pytest

from sessionloom.llm import queries

COLUMNS = {
    "p3_found": ["field_name", "row_id", "kind", "surface"], "p4_found": ["field_name", "row_id", "ref_id"], "p5_found": ["field_name", "row_id", "clean_text"],
    "p6_found": ["field_name", "id_a", "id_b"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, tiny, name):
    df = queries.QUERIES[name](spark, tiny)
    rows = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len(set(rows))
    assert rows or name == "p9_found"
    if name in queries.ORACLE:
        duck = duckdb.connect()
        for path in glob.glob(f"{tiny}/*.parquet"):
            duck.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
        cursor = duck.execute(queries.ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(cursor.fetchall()) == sorted(tuple(r[c] for c in names) for r in rows)

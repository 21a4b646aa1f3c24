import glob
import os

import duckdb
import pytest

from tidemark.llm import plans

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["shr_index", "unique_id"], "p2_found": ["victim_entity_id_l", "victim_entity_id_r"], "p3_found": ["addr_id_l", "addr_id_r"],
    "p4_found": ["victim_entity_id", "field_name", "entity_row_id"], "p6_found": ["unique_id", "cluster_id"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_found_queries(spark, name):
    df = plans.QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name]
    rows = df.collect()
    assert len(rows) == len(set(rows)) and rows
    if name in plans.ORACLE:
        con = duckdb.connect()
        for p in glob.glob(f"{SF}/*.parquet"):
            con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
        want = con.execute(plans.ORACLE[name]).df()[df.columns]
        assert sorted(map(tuple, rows)) == sorted(map(tuple, want.astype(object).values))

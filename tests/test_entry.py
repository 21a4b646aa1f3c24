import importlib

import pytest

import __spark_entry__ as entry


def test_registry():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 90


def test_core_does_not_need_the_llm_package():
    import re
    from pathlib import Path

    root = Path(entry.__file__).parent / "tidemark"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"tidemark\.llm|from \.+llm", p.read_text()), p
    assert importlib.import_module("tidemark.plans.registry")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() >= 0


@pytest.mark.parametrize("name", ["p5_found", "p7_found", "q_block_pairs_multi_rule", "q_crosstab_margins", "q_canonical_entity"])
def test_against_sql(spark, name):
    import glob
    import os

    import duckdb

    from compare import rows_of

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    got, want = entry.queries()[name](spark, sf).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)

from pathlib import Path

import pytest

from rostrum.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, tiny, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in Path(tiny).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    got, want = QUERIES[name](spark, tiny), con.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_every_operator_has_its_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))

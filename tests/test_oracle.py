"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables; the others run."""

from __future__ import annotations

import os

import duckdb
import pytest

from folioscope.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(path := f"{SF}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    return round(float(value), 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    frame = registry.queries()[name](spark, SF)
    rows = [tuple(map(plain, (r[c] for c in sorted(frame.columns)))) for r in frame.collect()]
    if name not in registry.oracle_sql():
        return
    cursor = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in sorted(columns)]
    want = [tuple(plain(row[k]) for k in order) for row in cursor.fetchall()]
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_every_decision_occurs(spark):
    from folioscope.operators import reconcile

    seen = {r.decision for r in registry.queries()["reconcile_items"](spark, "/root/testdata/sf0.01").collect()}
    assert seen == set(reconcile.ITEM_DECISIONS)
    cells = {r.decision for r in registry.queries()["reconcile_table_cells"](spark, SF).collect()}
    assert cells == set(reconcile.CELL_DECISIONS)

"""Every registered query with SQL against DuckDB, at the smallest size."""
import os

import duckdb
import pytest

from cadenza.plans.catalog import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(D):
        c.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM read_parquet('{D}/{t}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, D)
    o = duck.execute(ORACLES[name])
    cols = [x[0] for x in o.description]
    assert sorted(df.columns) == sorted(cols)
    key = lambda r: tuple(str(round(v, 9) + 0.0 if isinstance(v, float) else v) for v in r)
    assert sorted(key(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(key(r) for r in o.fetchall())


def test_ghosts_pair_no_lines_of_different_frames(spark, tmp_path):
    """Ghosts of every frame equal the SQL, with repeated lines and null keys; no plan holds all pairs of lines."""
    import duckdb
    from cadenza.plans import catalog

    src = "/root/testdata/sf0.001/lineitem.parquet"
    duckdb.sql(f"COPY (FROM '{src}' UNION ALL FROM '{src}' WHERE l_orderkey % 5 = 0 UNION ALL SELECT * REPLACE (NULL AS l_orderkey) FROM '{src}' WHERE l_orderkey < 9 UNION ALL SELECT * REPLACE (NULL AS l_quantity) FROM '{src}' WHERE l_orderkey % 7 = 0) TO '{tmp_path}/lineitem.parquet'")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS FROM '{tmp_path}/lineitem.parquet'")
    want = sorted(con.execute(catalog.ORACLES["ghost_semi"]).fetchall())
    got = catalog.QUERIES["ghost_semi"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()

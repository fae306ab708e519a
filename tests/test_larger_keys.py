"""Queries held against their SQL on keys beyond the sample tables' own: more digits, ids that met other ids, codes that many claimed."""

import duckdb
import pytest

import __spark_entry__ as entry

SOURCE = "/root/testdata/sf0.001"
ROWS = {
    "customer": "SELECT * REPLACE (c_custkey + k AS c_custkey) FROM '{s}/customer.parquet', (VALUES (0), (9990), (499000), (599000)) v(k)",
    "supplier": "SELECT * REPLACE (s_suppkey + k AS s_suppkey) FROM '{s}/supplier.parquet', (VALUES (0), (5000), (50000)) v(k)",
    "part": "SELECT * REPLACE (p_partkey + k AS p_partkey) FROM '{s}/part.parquet', (VALUES (0), (100000), (1200000), (7200000)) v(k)",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("keys")
    for t in ("region", "nation", "orders", "lineitem"):
        (out / f"{t}.parquet").symlink_to(f"{SOURCE}/{t}.parquet")
    for t, sql in ROWS.items():
        duckdb.sql(f"COPY ({sql.format(s=SOURCE)}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return out


@pytest.mark.parametrize("name", ["fn_normalisers", "rec_resolve", "g2_resolution_status", "rec_parent_collapse", "rec_drug_routes", "cross_property"])
def test_against_sql(spark, folder, name):
    con = duckdb.connect()
    for f in folder.iterdir():
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = entry.queries()[name](spark, str(folder))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name].strip()})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_a_spelling_is_met_once(spark):
    """Targets of one spelling are gathered before the join: hits are no more than variants, and the results stay."""
    from evigraph.operators import reconcile

    asked = spark.sql("select id as k, array(struct(0 as pos, 'n' as kind, 'x' as value)) as v from range(30)")
    index = spark.sql("select 'n' as kind, 'x' as value, id as target from range(40)")
    got = reconcile.route_join(asked, "k", "v", index)
    assert {(r.target, r.route, len(r.also)) for r in got.collect()} == {(0, "n", 39)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.rindex("collect_set(target#")

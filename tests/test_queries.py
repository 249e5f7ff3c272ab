"""Every library query against its SQL twin in DuckDB, on the smallest tables, and not without rows."""

import math

import duckdb
import pytest

from gleanery.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries that may find nothing on the smallest tables.
MAY_BE_EMPTY = {"full_directories", "neardup_hamming_top3", "near_duplicate_report", "contiguity", "contamination"}
#: Queries that SQL can't express; test_semantics compares them with plain code.
NO_SQL = {"edit_replay"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(records, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    value = lambda v: None if v is None or v != v else round(v, 9) if isinstance(v, float) and math.isfinite(v) else v
    return sorted((tuple(value(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    got = rows([tuple(r) for r in df.collect()], df.columns)
    twin = duck.execute(registry.oracle_sql()[name])
    want = rows(twin.fetchall(), [c[0] for c in twin.description])
    assert sorted(df.columns) == sorted(c[0] for c in twin.description)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)), (a, b)
    assert got or name in MAY_BE_EMPTY


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql()) | NO_SQL


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 4


def test_no_nested_loop_join_in_plans(spark, sf_dir):
    for name in ("neardup_hamming_top3", "interval_join", "interpolate_time_asof", "dedup_exact", "validate_pairs"):
        plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = registry.queries()["filter_undersized"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "l_shipdate" not in plan.split("ReadSchema")[-1]

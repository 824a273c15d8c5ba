"""Every query with SQL gives the same rows in both engines."""

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool) or isinstance(v, str):
        return str(v)
    return repr(float(v))


def as_rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(set(entry_module.oracle_sql()) - {"model_roundtrip"}))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = entry_module.queries()[name](spark, sf_dir)
    result = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, expected)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert costly not in plan


@pytest.mark.parametrize("name", ["classifier_logistic", "coefficient_rank", "feature_importance", "text_classifier", "steiner_corridor"])
def test_query_without_sql_runs(spark, sf_dir, name):
    df = entry_module.queries()[name](spark, sf_dir)
    assert not df.isEmpty() and all(f.dataType.simpleString() != "void" for f in df.schema)


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["p_partkey", "nprv_score"]

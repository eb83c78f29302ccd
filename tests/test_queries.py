"""Every meeting query against its SQL in DuckDB at the smallest scale."""

import duckdb
import pytest

from turnloom.plans import decision_queries, queries  # noqa: F401


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in ("documents", "conversations", "part", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_as_sql(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    cursor = duck.execute(queries.SQL[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted(cursor.fetchall(), key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_part_is_a_candidate(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet").count()
    assert queries._candidates(spark, sf).count() == parts
    assert {r["candidate_id"] % 3 for r in queries.symbol_exact(spark, sf).collect()} == {0, 1, 2}
    assert {r["matched_by"] for r in queries.symbol_exact(spark, sf).collect()} == {"name", "code", "bare_code"}


def test_queries_find_something(spark, sf, duck):
    for name, sql in queries.SQL.items():
        assert duck.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0] > 0, name


def test_entry_without_the_training_part(monkeypatch):
    import builtins

    import __spark_entry__

    real = builtins.__import__

    def no_llm(name, *rest):
        if name.startswith(("turnloom.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, *rest)

    monkeypatch.setattr(builtins, "__import__", no_llm)
    assert set(__spark_entry__.queries()) == set(queries.QUERIES) == set(__spark_entry__.oracle_sql())

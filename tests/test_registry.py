"""Every registered query with SQL against DuckDB on the smallest tables."""

import datetime

import duckdb
import pytest

from pyspark.sql import functions as F

from sightline.plans import registry
from sightline.sources import tables

SF = "/root/testdata/sf0.001"
TABLES = ("part", "documents", "pages", "labels", "conversations", "events", "supplier", "orders", "lineitem")


def plain(value):
    return round(value, 9) if isinstance(value, float) else value.isoformat() if isinstance(value, datetime.datetime) else value


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.fixture(autouse=True)
def shuffled(monkeypatch):
    """Inputs lie in random partitions and order."""
    read = tables.read
    monkeypatch.setattr(tables, "read", lambda *args: read(*args).repartition(3, F.rand(len(args[-1]))))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, database, name):
    got = registry.QUERIES[name](spark, SF)
    want = database.sql(registry.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert ordered([tuple(r) for r in got.collect()], got.columns) == ordered(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry_without_the_subpackage(monkeypatch):
    import builtins
    import importlib

    import __spark_entry__

    real = builtins.__import__

    def blocked(name, *args, **kwargs):
        if name == "corpus_pipeline" or name.startswith("sightline.llm"):
            raise ModuleNotFoundError(name, name=name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", blocked)
    assert set(importlib.reload(__spark_entry__).queries()) == set(registry.QUERIES)
    monkeypatch.undo()
    importlib.reload(__spark_entry__)

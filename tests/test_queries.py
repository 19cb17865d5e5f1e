"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, folder, db, name):
    df = entry.queries()[name](spark, folder)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        assert got[1]
        return
    result = db.execute(ORACLE[name])
    want = sorted_rows([d[0] for d in result.description], result.fetchall())
    assert got == want


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["created_day", "ticket_count"]
    assert rows.count() > 0

"""Every registered query against its DuckDB statement, on the smallest data set."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(round(v[i], 9) if isinstance(v[i], float) else v[i]) for i in order) for v in values)


def own_queries():
    """The queries of this package alone; those of an optional part are tested with it."""
    optional = set(entry_points.corpus.queries()) if entry_points.corpus else set()
    return [name for name in entry_points.queries() if name not in optional | {"pipeline"}]


def test_every_query_has_a_statement():
    assert set(own_queries()) <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", own_queries())
def test_query(spark, duck, name):
    result = entry_points.queries()[name](spark, str(SF))
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows(result.columns, result.collect()) == rows(columns, cursor.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["metric", "key", "count"]


def test_a_missing_library_takes_only_the_optional_queries(monkeypatch, tmp_path):
    (tmp_path / "needs_more.py").write_text("import not_installed_anywhere\n")
    (tmp_path / "broken.py").write_text("import logtally.no_such_module\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.warns(UserWarning, match="not_installed_anywhere"):
        assert entry_points._optional("needs_more") is None
    assert entry_points._optional("not_there_at_all") is None
    with pytest.raises(ModuleNotFoundError):
        entry_points._optional("broken")

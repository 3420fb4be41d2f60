"""Every query against its SQL in DuckDB: same columns, same rows, values to the last digit."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    yield connection
    connection.close()


def as_sorted(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, every value as text of full precision."""

    def text(value) -> str:
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        return repr(value) if isinstance(value, float) else str(value)

    frame = frame.reindex(sorted(frame.columns), axis=1)
    as_text = frame.astype(object).map(text)
    return as_text.sort_values(list(as_text.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, sf_dir, duck):
    result = queries()[name](spark, sf_dir)
    if name not in SQL:
        assert result.count() > 0
        return
    expected = duck.sql(SQL[name]).to_arrow_table()
    actual = result.toArrow()
    assert sorted(actual.column_names) == sorted(expected.column_names)
    for column in expected.schema:
        kind, wanted = str(actual.schema.field(column.name).type), str(column.type)
        assert kind.replace("large_", "") == wanted.replace("large_", "") or wanted == "null", column
    pd.testing.assert_frame_equal(as_sorted(actual.to_pandas()), as_sorted(expected.to_pandas()))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns[0] == "mention"

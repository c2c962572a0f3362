"""Comparison of a Spark result with DuckDB's over the same parquet files."""

from __future__ import annotations

import os

import duckdb

from tableferry.plans.catalogue import TABLES


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as con:
        for table in TABLES:
            con.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
        result = con.execute(sql)
        return [c[0] for c in result.description], result.fetchall()


def by_column(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns sorted by name, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted((tuple(row[i] for i in order) for row in rows), key=repr),
    )


def assert_same(df, sf_dir: str, sql: str) -> int:
    expected = by_column(*duckdb_rows(sf_dir, sql))
    actual = by_column(df.columns, [tuple(r) for r in df.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert actual[1] == expected[1]
    return len(actual[1])


SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

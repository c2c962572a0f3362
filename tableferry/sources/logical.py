"""Logical column types that the Spark schema of a source does not show.

A source may deliver a bitmap as text. The column keeps its logical type in the
column metadata, which filters, column selections, views and saved tables
preserve.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tableferry.config import ConfigError, TableSpec, TypesRelation
from tableferry.functions.names import quote

LOGICAL_TYPE = "logical_type"
BITMAP = "bitmap"


def logical_type(field: StructField) -> str | None:
    """The lower-case logical type of a column, if it has one."""
    kind = (field.metadata or {}).get(LOGICAL_TYPE)
    return kind.lower() if isinstance(kind, str) else None


def native_schema(rows: DataFrame) -> list[tuple[str, str]]:
    """Columns in source order with their logical type, else their Spark type."""
    return [(f.name, logical_type(f) or f.dataType.simpleString()) for f in rows.schema.fields]


def tag_logical_types(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Record logical types in the column metadata; unknown columns are an error."""
    if not types:
        return rows
    by_key = {_key(rows, name): kind for name, kind in types.items()}
    missing = sorted(set(by_key) - {_key(rows, c) for c in rows.columns})
    if missing:
        raise ConfigError(f"logical types for unknown columns {missing}; there are {rows.columns}")
    return rows.select(
        *[
            F.col(quote(f.name)).alias(
                f.name,
                metadata={**(f.metadata or {}), LOGICAL_TYPE: by_key[_key(rows, f.name)].lower()},
            )
            if _key(rows, f.name) in by_key
            else F.col(quote(f.name))
            for f in rows.schema.fields
        ]
    )


def _key(rows: DataFrame, column: str) -> str:
    sensitive = rows.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return column if sensitive else column.lower()


def discovered(
    spark: SparkSession, relation: TypesRelation, tables: Sequence[TableSpec]
) -> list[TableSpec]:
    """The tables with the bitmap columns that the source's own list of columns shows.

    Only the columns of these tables are read; types that a table was given by
    hand go before those listed. A table without any listed column is an error: its
    bitmaps would be copied as text.
    """
    reader = spark.read.options(**relation.options)
    if relation.source_format == "catalog":
        listed = reader.table(relation.table)
    else:
        listed = reader.format(relation.source_format).option(relation.table_key, relation.table).load()
    name = F.col(quote(relation.table_column))
    if relation.schema_column:
        name = F.concat_ws(".", F.col(quote(relation.schema_column)), name)
    rows = listed.select(
        name.alias("table"),
        F.col(quote(relation.column_column)).alias("column"),
        F.lower(F.col(quote(relation.type_column))).alias("type"),
    ).where(F.col("table").isin([t.source for t in tables]))
    found: dict[str, dict[str, str]] = {}
    for r in rows.collect():  # a row per column of the tables of this run
        found.setdefault(r["table"], {})[r["column"]] = r["type"]
    missing = [t.source for t in tables if t.source not in found]
    if missing:
        raise ConfigError(f"{relation.table} lists no columns of {missing}")
    return [
        replace(
            t,
            logical_types={
                **{c: BITMAP for c, kind in found[t.source].items() if kind.split("(")[0].strip() == BITMAP},
                **t.logical_types,
            },
        )
        for t in tables
    ]

"""Fingerprints of rows: facts that do not depend on the rows' order and that can be added up.

A fingerprint is the number of rows and the sum of a 64-bit hash of each row, as three sums
over parts of the hash so that none overflows below 2 ** 41 rows. A value that changes, moves to
another column or row, or gets lost changes it; so do two rows where there was one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType, VariantType

from tableferry.functions.names import quote

ROWS = "rows"
PARTS = ("hash_high", "hash_middle", "hash_low")

#: Where Spark notes that a text column is CHAR(n), whose values it pads
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def _flat(value: Column, kind: DataType) -> list[Column]:
    """What is hashed of a value: Spark's hash passes over nulls, so each one is stated."""
    return [_hashable(value, kind), value.isNull()]


def _hashable(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StructType):
        inner = [c for f in kind for c in _flat(value.getField(f.name), f.dataType)]
        return F.struct(*inner) if inner else value.isNull()
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda v: F.struct(*_flat(v, kind.elementType)))
    if isinstance(kind, MapType):
        # Spark does not hash maps, whose entries have no order
        keys = F.array_sort(F.map_keys(value))
        return F.transform(
            keys, lambda k: F.struct(_hashable(k, kind.keyType), *_flat(value[k], kind.valueType))
        )
    if isinstance(kind, VariantType):
        return F.to_json(value)
    return value


def _stored(field: StructField) -> Column:
    """A column as the sink keeps it."""
    value = F.col(quote(field.name)).cast(field.dataType)
    if field.metadata.get(_DECLARED, "").lower().startswith("char"):
        value = F.rtrim(value)
    return value


def row_hash(schema: StructType) -> Column:
    """A 64-bit hash of all columns of ``schema``, cast to its types."""
    return F.xxhash64(*[c for f in schema.fields for c in _flat(_stored(f), f.dataType)])


def facts(schema: StructType) -> list[Column]:
    """The fingerprint as aggregates over rows that have the columns of ``schema``, in any fitting types."""
    h = row_hash(schema)
    parts = (
        F.shiftrightunsigned(h, 43),
        F.shiftrightunsigned(h, 21).bitwiseAND(F.lit(0x3FFFFF)),
        h.bitwiseAND(F.lit(0x1FFFFF)),
    )
    sums = [F.coalesce(F.sum(p), F.lit(0)).alias(name) for p, name in zip(parts, PARTS)]
    return [F.count(F.lit(1)).alias(ROWS), *sums]


def row_count(schema: StructType) -> list[Column]:
    """The number of rows alone, in the shape of :func:`facts`."""
    return [F.count(F.lit(1)).alias(ROWS)]

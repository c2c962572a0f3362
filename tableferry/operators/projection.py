"""The columns a transfer writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tableferry.config import ConfigError
from tableferry.functions.bitmap import bytes_to_text, text_cast_to_bytes, text_to_bytes
from tableferry.functions.names import quote
from tableferry.sources.logical import BITMAP, logical_type


def bitmap_text_columns(rows: DataFrame) -> list[str]:
    """Bitmap columns that hold text and so can be converted to bytes.

    Those that are bytes already need nothing; any other type means that the
    source does not deliver bitmaps as text.
    """
    found = []
    for f in rows.schema.fields:
        if logical_type(f) != BITMAP or isinstance(f.dataType, BinaryType):
            continue
        if not isinstance(f.dataType, StringType):
            raise ConfigError(
                f"bitmap column {f.name!r} has type {f.dataType.simpleString()}, not text; "
                "let the source deliver it as text or switch bitmap_to_binary off"
            )
        found.append(f.name)
    return found


def project(rows: DataFrame, bitmap_to_binary: bool = True) -> DataFrame:
    """Every column in source order, bitmap text as UTF-8 bytes under the same name.

    The converted column keeps its metadata: an expression alone would lose it.
    """
    convert = set(bitmap_text_columns(rows)) if bitmap_to_binary else set()
    if not convert:
        return rows
    return rows.select(
        *[
            text_to_bytes(F.col(quote(f.name))).alias(f.name, metadata=f.metadata)
            if f.name in convert
            else F.col(quote(f.name))
            for f in rows.schema.fields
        ]
    )


def restore_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Undo :func:`project` for some columns, so that source predicates mean the same again."""
    back = {c.lower() for c in columns}
    return rows.select(
        *[
            bytes_to_text(F.col(quote(c))).alias(c) if c.lower() in back else F.col(quote(c))
            for c in rows.columns
        ]
    )


def compare_conversions(rows: DataFrame) -> DataFrame:
    """Each bitmap column raw, converted, cast and decoded, side by side; other columns as is."""
    bitmaps = set(bitmap_text_columns(rows))
    shown = []
    for name in rows.columns:
        text = F.col(quote(name))
        shown.append(text)
        if name in bitmaps:
            shown += [
                F.hex(text_to_bytes(text)).alias(f"{name}_bytes_hex"),
                F.hex(text_cast_to_bytes(text)).alias(f"{name}_cast_hex"),
                bytes_to_text(text_to_bytes(text)).alias(f"{name}_decoded"),
            ]
    return rows.select(*shown)

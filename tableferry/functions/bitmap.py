"""Conversions of bitmap columns, which sources deliver as text.

All are built-in expressions, so they stay inside whole-stage code generation;
NULL stays NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_to_bytes(text: Column) -> Column:
    """UTF-8 bytes of a string: what the transfer writes for a bitmap column.

    Bytes of the string that are not valid UTF-8 become U+FFFD.
    """
    return F.encode(text, "UTF-8")


def text_cast_to_bytes(text: Column) -> Column:
    """The cast variant, kept to compare against :func:`text_to_bytes`.

    The same for valid text; other bytes stay as they are.
    """
    return text.cast("binary")


def bytes_to_text(data: Column) -> Column:
    """Readable form of converted bytes."""
    return F.decode(data, "UTF-8")

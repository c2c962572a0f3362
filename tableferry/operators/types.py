"""Which column types a sink can take without changing a value."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# decimal digits and value bits of whole numbers
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_BITS = {ByteType: 7, ShortType: 15, IntegerType: 31, LongType: 63}
# whole numbers up to so many bits are exact
_EXACT = {FloatType: 24, DoubleType: 53}


def fits(source: DataType, sink: DataType) -> bool:
    """Whether every value of ``source`` is the same value in ``sink``."""
    of, into = type(source), type(sink)
    if isinstance(source, NullType):
        return True
    if isinstance(source, ArrayType) and isinstance(sink, ArrayType):
        return fits(source.elementType, sink.elementType)
    if isinstance(source, MapType) and isinstance(sink, MapType):
        return fits(source.keyType, sink.keyType) and fits(source.valueType, sink.valueType)
    if isinstance(source, StructType) and isinstance(sink, StructType):
        # fields are written by place
        return [f.name.lower() for f in source] == [f.name.lower() for f in sink] and all(
            fits(a.dataType, b.dataType) for a, b in zip(source, sink)
        )
    if isinstance(source, DecimalType) and isinstance(sink, DecimalType):
        whole = source.precision - source.scale
        return sink.scale >= source.scale and sink.precision - sink.scale >= whole
    if of in _DIGITS and isinstance(sink, DecimalType):
        return sink.precision - sink.scale >= _DIGITS[of]
    if of in _BITS and into in _BITS:
        return _BITS[of] <= _BITS[into]
    if of in _BITS and into in _EXACT:
        return _BITS[of] <= _EXACT[into]
    if isinstance(source, DateType) and isinstance(sink, (TimestampType, TimestampNTZType)):
        return True
    if isinstance(source, FloatType) and isinstance(sink, DoubleType):
        return True
    return source == sink

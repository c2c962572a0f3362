"""Ranges of a column that cut a source into scans of even size.

A source that cannot split its scan is read by one task. If it takes a predicate, several
scans of disjoint ranges read it side by side. The ends of the ranges are percentiles of the column, from a
sketch that Spark merges over one scan of that column alone. A value that fills several ranges
gets one of its own, so the others stay even. Nulls go with the first range.
"""

from __future__ import annotations

import datetime
import decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from tableferry.config import ConfigError
from tableferry.functions.names import quote

#: Entries of the percentile sketch for each range: its error is a small part of a range
_ACCURACY = 100


def ends_of_ranges(rows: DataFrame, column: str, ranges: int) -> list:
    """Up to ``ranges - 1`` ascending values; one that comes twice fills a range by itself."""
    kind = rows.schema[column].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise ConfigError(f"{column!r} has type {kind.simpleString()}; split by a number, a date or a time")
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    sketch = F.percentile_approx(F.col(quote(column)), shares, max(10_000, _ACCURACY * ranges))
    return rows.agg(sketch).first()[0] or []


def literal(value) -> str:
    """A value in SQL that most sources share."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{value:f}" if isinstance(value, decimal.Decimal) else repr(value)
    raise ConfigError(f"no literal for {value!r}")


def predicates(column: str, ends: list) -> list[str]:
    """Disjoint conditions that every row meets one of, nulls the first."""
    singles = {e for i, e in enumerate(ends) if i and ends[i - 1] == e}
    cuts = []  # (value, whether rows of that value come after the cut)
    for end in dict.fromkeys(ends):
        cuts.append((end, True))
        if end in singles:
            cuts.append((end, False))
    if not cuts:
        return []

    def above(cut) -> str:
        return f"{column} {'>=' if cut[1] else '>'} {literal(cut[0])}"

    def below(cut) -> str:
        return f"{column} {'<' if cut[1] else '<='} {literal(cut[0])}"

    between = [f"{above(a)} AND {below(b)}" for a, b in zip(cuts, cuts[1:])]
    return [f"{below(cuts[0])} OR {column} IS NULL", *between, above(cuts[-1])]


def both(*conditions: str | None) -> str | None:
    """All of the conditions that there are."""
    given = [c for c in conditions if c and c.strip()]
    return " AND ".join(f"({c})" for c in given) if len(given) > 1 else given[0] if given else None


def united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)

"""Balanced key ranges for parallel snapshot reads.

A source table is read by several tasks, each with a condition on the key.
Evenly spaced bounds give even parts only for evenly spread keys; here the
bounds are quantiles of a sample, so that parts hold like numbers of rows
whatever the keys are: numbers with gaps, dates, UUIDs, prefixed codes.

* ``sample_keys`` draws a sample of the key columns, of a size that depends on
  the number of ranges alone, in one pass over those columns.
* ``split_points`` takes the quantiles of the sorted sample. A key that fills
  more than a range by itself cannot be cut by its own value: it gets a range
  of its own, or is cut further by the next key column where one is given.
* ``range_predicates`` writes the conditions. Condition i is "not below the
  first i bounds, and below the next": each row meets exactly one of them under
  *any* order of the database (a collation that ignores case, say), since a row
  belongs to the first bound it is below. A database that sorts differently
  from Spark makes the ranges uneven, never incomplete or overlapping. Rows
  without a key are in the first range.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

#: Sampled keys for each range: a range's share is then within a few per cent
#: (the standard error of a quantile is below 1 / (2 * sqrt(sample)) of all rows).
SAMPLE_PER_RANGE = 2000


class UnsplittableKeyError(ValueError):
    """A key column of a type that has no order to cut."""


def check_splittable(schema: StructType, columns: Sequence[str]) -> list[DataType]:
    """The types of the key columns, if all of them can be cut."""
    names = {f.name.lower(): f.dataType for f in schema.fields}
    types = []
    for c in columns:
        if c.lower() not in names:
            raise UnsplittableKeyError(f"no column {c!r} among {sorted(names)}")
        kind = names[c.lower()]
        if not isinstance(kind, (NumericType, StringType, DateType, TimestampType, TimestampNTZType)):
            raise UnsplittableKeyError(f"column {c!r} of type {kind.simpleString()} cannot be cut into ranges")
        types.append(kind)
    return types


def sample_keys(keys: DataFrame, columns: Sequence[str], n: int, per_range: int = SAMPLE_PER_RANGE,
                seed: int = 17) -> list[tuple]:
    """A sample of about ``n * per_range`` keys (rows with a null are left out),
    and never above four times that: what reaches the driver is bounded by the
    number of ranges, not by the table."""
    rows = keys.select(*[F.col(c) for c in columns]).dropna()
    total, wanted = rows.count(), n * per_range
    if total > 2 * wanted:
        rows = rows.sample(fraction=1.5 * wanted / total, seed=seed)
    return [tuple(r) for r in rows.limit(4 * wanted).collect()]


def split_points(sample: Sequence[tuple], n: int) -> list[tuple]:
    """At most ``n - 1`` ascending bounds that cut the sorted sample into parts
    of like size. A bound is a tuple of the leading key columns that it needs:
    one column, unless that column's value fills a range by itself."""
    if n < 2 or not sample:
        return []
    ordered = sorted(sample)
    size, share = len(ordered), len(ordered) / n
    width = len(ordered[0])
    points: list[tuple] = []
    last = 0
    while size - last > share and len(points) < n - 1:
        left = n - len(points)
        at = last + max(1, round((size - last) / left))
        if at >= size:
            break
        point = cut_at(ordered, last, at, share, width)
        if point is None:
            break
        points.append(point)
        last = first_not_below(ordered, point)
    return points


def first_not_below(ordered: Sequence[tuple], point: tuple) -> int:
    """The first place whose key is not below the bound."""
    low, high = 0, len(ordered)
    while low < high:
        mid = (low + high) // 2
        if ordered[mid][: len(point)] < point:
            low = mid + 1
        else:
            high = mid
    return low


def cut_at(ordered: Sequence[tuple], last: int, at: int, share: float, width: int) -> tuple | None:
    """The bound near place ``at`` by as few columns as possible: the nearest
    change of the first column if that is at most half a share away, else of
    the first two columns, and so on; the nearest change of all of them if none
    is so near. None if nothing changes behind ``last``."""
    for columns in range(1, width + 1):
        here = ordered[at][:columns]
        before = first_not_below(ordered, here)  # first of the keys like this one
        after = first_above(ordered, here)
        options = [p for p in (before, after) if last < p < len(ordered)]
        if options:
            best = min(options, key=lambda p: abs(p - at))
            if abs(best - at) <= share / 2 or columns == width:
                return ordered[best][:columns]
    return None


def first_above(ordered: Sequence[tuple], prefix: tuple) -> int:
    low, high = 0, len(ordered)
    while low < high:
        mid = (low + high) // 2
        if ordered[mid][: len(prefix)] <= prefix:
            low = mid + 1
        else:
            high = mid
    return low


def literal(value) -> str:
    """A SQL literal that both databases and Spark read."""
    if isinstance(value, bool) or value is None:
        raise UnsplittableKeyError(f"{value!r} is no key")
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise UnsplittableKeyError(f"{value!r} is no key")
        return repr(value)
    if isinstance(value, (int, decimal.Decimal)):
        return f"{value:f}" if isinstance(value, decimal.Decimal) else str(value)
    raise UnsplittableKeyError(f"no literal for {type(value).__name__}")


def below(columns: Sequence[str], point: tuple) -> str:
    """The key (its leading columns) is below the bound."""
    terms = []
    for k, value in enumerate(point):
        equal = [f"{columns[j]} = {literal(point[j])}" for j in range(k)]
        terms.append(" AND ".join([*equal, f"{columns[k]} < {literal(value)}"]))
    return terms[0] if len(terms) == 1 else "(" + " OR ".join(f"({t})" for t in terms) + ")"


def range_predicates(columns: Sequence[str], points: Sequence[tuple]) -> list[str]:
    """Conditions of which every row meets exactly one (see the module's text).
    Where any key column is null the row is in the first range."""
    if not points:
        return ["1 = 1"]
    used = columns[: max(map(len, points))]
    null = " OR ".join(f"{c} IS NULL" for c in used)
    out = []
    for k in range(len(points) + 1):
        terms = [f"NOT {below(columns, p)}" if len(p) > 1 else f"{columns[0]} >= {literal(p[0])}" for p in points[:k]]
        if k < len(points):
            terms.append(below(columns, points[k]))
        inside = " AND ".join(terms)
        out.append(f"(({inside}) OR {null})" if k == 0 else f"({inside}) AND NOT ({null})")
    return out


def balanced_predicates(keys: DataFrame, columns: Sequence[str], n: int, per_range: int = SAMPLE_PER_RANGE) -> list[str]:
    """At most ``n`` conditions for parallel reads of the table whose key
    columns ``keys`` holds, of like numbers of rows."""
    check_splittable(keys.schema, columns)
    sample = [k for k in sample_keys(keys, columns, n, per_range) if all(not isinstance(v, float) or math.isfinite(v) for v in k)]
    return range_predicates(columns, split_points(sample, n))

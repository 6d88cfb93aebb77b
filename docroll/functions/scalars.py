"""Scalar helpers: money, dates, buckets, string maps and JSON text.

All of them return Catalyst expressions, so they stay inside whole-stage
codegen and are pushed, pruned and folded like any other column.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's:
#   bucket thresholds: a total above 2500 -> 1, 3500 -> 2, 4500 -> 3, 5500 -> 4, 6000 -> 5, else 0
#   date cutoff for the conditional customer total: 2010-01-01 (strictly after)
#   text date format: yyyy-MM-dd'T'HH:mm:ss
REFERENCE_BUCKET_THRESHOLDS = (2500.0, 3500.0, 4500.0, 5500.0, 6000.0)
REFERENCE_CUTOFF = "2010-01-01"
REFERENCE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# Text of java.util.Date#toString, e.g. "Tue Jan 05 03:04:05 UTC 2010".
_JAVA_DATE_PATTERN = "EEE MMM dd HH:mm:ss {zone} yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Decimal places that sums of fractional amounts keep.
MONEY_SCALE = 4


def money_sum(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Sum of fractional amounts as a double, exact to ``scale`` decimal places
    and independent of row order: amounts are added as decimals and converted
    once. A NaN among the amounts makes the sum NaN; nulls do not count, and a
    sum of nothing is null. ANSI mode raises when an amount or a sum needs more
    than 38 digits.
    """
    v = _col(c).cast("double")
    exact = F.sum(F.when(~F.isnan(v), v.cast(f"decimal({24 + scale},{scale})"))).cast("double")
    return F.when(F.max(F.isnan(v)), F.lit(float("nan"))).otherwise(exact)


def exact_sum(df: DataFrame, c: str, scale: int = MONEY_SCALE, where: Column | None = None) -> Column:
    """Sum of a column of ``df`` by its type: integers give an integer, anything
    else ``money_sum``. Rows that ``where`` does not hold for count as zero."""
    whole = isinstance(df.schema[c].dataType, T.IntegralType)
    value = F.col(c) if where is None else F.when(where, F.col(c)).otherwise(F.lit(0))
    return F.sum(value) if whole else money_sum(value, scale)


def exact_sum_in_parts(df: DataFrame, c: str, name: str, scale: int = MONEY_SCALE) -> tuple[list[Column], Column]:
    """``exact_sum`` in two steps: aggregates per part of a group, and the aggregate
    over those (named ``__sum_of_name`` and ``__nan_in_name``) that gives the group's sum."""
    if isinstance(df.schema[c].dataType, T.IntegralType):
        return [F.sum(c).alias(f"__sum_of_{name}")], F.sum(f"__sum_of_{name}")
    v = F.col(c).cast("double")
    parts = [F.sum(F.when(~F.isnan(v), v.cast(f"decimal({24 + scale},{scale})"))).alias(f"__sum_of_{name}"), F.max(F.isnan(v)).alias(f"__nan_in_{name}")]
    return parts, F.when(F.max(f"__nan_in_{name}"), F.lit(float("nan"))).otherwise(F.sum(f"__sum_of_{name}").cast("double"))


def ts_literal(value: str | _dt.date | _dt.datetime, like: T.DataType) -> Column:
    """A timestamp literal of the same timestamp kind as a column."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d")
    else:
        text = value
    if isinstance(like, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(like, T.DateType):
        return F.lit(text).cast("date")
    return F.lit(text).cast("timestamp")


def parse_ts(c: Column | str, fmt: str = REFERENCE_TS_FORMAT, strict: bool = True) -> Column:
    """Text -> timestamp (without zone), reading only the pattern's length.

    Like the reference's parser, text after the pattern (``.000Z``) is ignored.
    Unlike it, an impossible value (month 13) is bad data: ``strict`` raises,
    otherwise the result is null.
    """
    width = len(fmt.replace("'", ""))
    head = F.substring(_col(c), 1, width)
    if strict:
        return F.to_timestamp_ntz(head, F.lit(fmt))
    return F.try_to_timestamp(head, F.lit(fmt)).cast("timestamp_ntz")


def java_date_text(c: Column | str, dtype: T.DataType, zone: str = "UTC") -> Column:
    """Timestamp of type ``dtype`` -> the text ``java.util.Date#toString`` gives.

    A timestamp without zone (or a date) is a wall-clock time in ``zone``; a
    timestamp with zone is printed in the session zone, whose short name is
    printed.
    """
    named = "zzz" if isinstance(dtype, T.TimestampType) else f"'{zone}'"
    return F.date_format(_col(c), _JAVA_DATE_PATTERN.format(zone=named))


def bucket(c: Column | str, thresholds: Sequence[float] = REFERENCE_BUCKET_THRESHOLDS) -> Column:
    """Number of thresholds a value is strictly above; NaN and null -> 0.

    ``thresholds`` ascending. With the reference's list: >6000 -> 5,
    >5500 -> 4, >4500 -> 3, >3500 -> 2, >2500 -> 1, else 0.
    """
    v = _col(c).cast("double")
    bounds = sorted(float(t) for t in thresholds)
    expr = F.when(F.isnan(v), F.lit(0))
    for i in range(len(bounds), 0, -1):
        expr = expr.when(v > F.lit(bounds[i - 1]), F.lit(i))
    return expr.otherwise(F.lit(0))


def as_strings(df: DataFrame, names: Mapping[str, Column | str]) -> DataFrame:
    """Flat document with every value as text: ``{out_name: column}``."""
    return df.select(*[_col(c).cast("string").alias(n) for n, c in names.items()])


def string_map(names: Mapping[str, Column | str]) -> Column:
    """``map<string,string>`` of output name -> value as text."""
    parts: list[Column] = []
    for n, c in names.items():
        parts.extend([F.lit(n), _col(c).cast("string")])
    return F.create_map(*parts)


def doc_json(c: Column | str, keep_nulls: bool = True) -> Column:
    """A struct (document) as JSON text; null fields kept by default."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(_col(c), opts)

"""Time-part expressions: timestamp normalisation, partition-time predicates, keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

# Fixed value: string timestamps are ``yyyy-MM-dd HH:mm:ss``, fields unpadded or
# not; what follows the seconds (a fraction, a zone) is ignored.
TS_TEXT = r"^\s*(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:[0-5]?\d:[0-5]?\d)(?!\d)"

PARTITION_PARTS = ("year", "month", "day", "hour")


def normalized_ts(col: str, dtype: DataType, zone: str = "UTC") -> Column:
    """``ts`` as ``timestamp_ntz``; unparseable strings become null (not an error).

    Text keeps its wall clock: it is read field by field, so no time zone and
    no daylight-saving gap can shift it. Impossible dates are null. Zoned
    timestamps become the wall clock of ``zone``; the session zone plays no part.
    """
    c = F.col(col)
    if isinstance(dtype, StringType):
        fields = F.split(F.regexp_extract(c, TS_TEXT, 1), "[- :]")
        year, month, day, hour, minute, second = [F.get(fields, F.lit(i)).try_cast("int") for i in range(6)]
        return F.try_make_timestamp_ntz(year, month, day, hour, minute, second)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        seconds = F.unix_micros(c).cast("decimal(24,0)") / F.lit(1_000_000).cast("decimal(7,0)")
        epoch = F.make_timestamp_ntz(*[F.lit(v) for v in (1970, 1, 1, 0, 0, 0)])
        utc = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
        return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    raise TypeError(f"unsupported type for {col}: {dtype.simpleString()}")


def truncate_watermark(watermark: dt.datetime, parts: Sequence[str]) -> tuple[int, ...]:
    """The watermark as a tuple at the source partition granularity."""
    full = (watermark.year, watermark.month, watermark.day, watermark.hour)
    return tuple(full[PARTITION_PARTS.index(p)] for p in parts)


def partition_after(parts: Sequence[str], watermark: dt.datetime) -> Column:
    """Partition start time strictly after ``watermark``.

    A partition (year, month[, day[, hour]]) starts at the beginning of its
    unit, so ``start > watermark`` is the lexicographic comparison of the part
    tuple with the watermark truncated to the same unit. It is written as an
    OR/AND chain of simple comparisons so Spark can use it both for partition
    pruning and as pushed Parquet row-group filters.
    """
    bounds = truncate_watermark(watermark, parts)

    def chain(i: int) -> Column:
        c, v = F.col(parts[i]), F.lit(bounds[i])
        if i == len(parts) - 1:
            return c > v
        return (c > v) | ((c == v) & chain(i + 1))

    return chain(0)


def in_partitions(parts: Sequence[str], wanted: Sequence[Mapping[str, int]]) -> Column:
    """Whether the partition columns are those of one of ``wanted``: nested equalities, so it prunes directories."""

    def level(i: int, rows: list) -> Column:
        values = dict.fromkeys(r[parts[i]] for r in rows)
        if i == len(parts) - 1:
            return F.col(parts[i]).isin(*values)
        out = F.lit(False)
        for v in values:
            out = out | ((F.col(parts[i]) == v) & level(i + 1, [r for r in rows if r[parts[i]] == v]))
        return out

    return level(0, list(wanted)) if wanted else F.lit(False)


def partition_start(parts: Sequence[str]) -> Column:
    """Start of the partition as ``timestamp_ntz`` (missing parts = start of unit)."""
    vals = {p: F.col(p) if p in parts else F.lit(1 if p in ("month", "day") else 0) for p in PARTITION_PARTS}
    return F.make_timestamp_ntz(vals["year"], vals["month"], vals["day"], vals["hour"], F.lit(0), F.lit(0))


def year_month_unpadded(year: Column, month: Column) -> Column:
    """``concat(year, month)`` without padding: January 2024 is ``20241``."""
    return F.concat(year.cast("string"), month.cast("string"))


def year_month_padded(year: Column, month: Column) -> Column:
    """``yyyy-MM``: sorts correctly as a string."""
    return F.format_string("%04d-%02d", year, month)

"""Joins of points with intervals, as equi-joins on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_P, _I = "_point", "_interval"


def _comparable(points: DataFrame, intervals: DataFrame, point: Column, low: Column, high: Column) -> list[Column]:
    """The three columns in the one type they are compared in, so that no pair has to convert them."""
    one, two = points.select(point.alias("a")), intervals.select(low.alias("b"), high.alias("c"))
    kinds = {f.dataType for f in (*one.schema, *two.schema)}
    if len(kinds) == 1:
        return [point, low, high]
    kind = one.crossJoin(two).select(F.array("a", "b", "c").alias("x")).schema[0].dataType.elementType
    return [c.cast(kind) for c in (point, low, high)]


def _numbers(*given: tuple[DataFrame, Column]) -> list[Column]:
    """Columns as doubles in one unit that keep their order: days of dates, microseconds of timestamps.

    Timestamps without a zone are counted from their parts, so no change of the clocks puts them out of order.
    """
    kinds = [df.select(c.alias("c")).schema[0].dataType for df, c in given]
    columns = [c for _, c in given]
    if all(isinstance(k, T.DateType) for k in kinds):
        return [F.unix_date(c).cast("double") for c in columns]
    if any(isinstance(k, T.TimestampType) for k in kinds):
        return [F.unix_micros(c.cast("timestamp")).cast("double") for c in columns]
    if any(isinstance(k, (T.DateType, T.TimestampNTZType)) for k in kinds):
        clock = lambda c: F.hour(c) * 3600e6 + F.minute(c) * 60e6 + F.extract(F.lit("SECOND"), c).cast("double") * 1e6
        return [F.unix_date(c.cast("date")) * 86400e6 + clock(c.cast("timestamp_ntz")) for c in columns]
    return [c.cast("double") for c in columns]


def range_join(points: DataFrame, intervals: DataFrame, point: Column, low: Column, high: Column, condition: Column | None = None, open_low: bool = False, open_high: bool = False) -> DataFrame:
    """Inner join of the pairs with low <= point <= high (and `condition`), without comparing all pairs.

    `open_low` and `open_high` leave out points on the bound. An interval stands in the two or three bins it touches of the
    power of two from half its length to its length, a point in one bin of each power that some interval has. Both meet on
    (power, bin), an equi-join that adaptive execution splits where a bin is hot; the exact test is part of it, and bounds
    are worked out once an interval, not once a pair. Long and short intervals don't disturb each other. Nulls, and
    intervals that end before they begin, meet nothing. Columns of both sides keep their names and qualifiers.
    """
    p, lo, hi = _numbers((points, point), (intervals, low), (intervals, high))
    at, begin, end = _comparable(points, intervals, point, low, high)
    length = hi - lo
    power = F.when(length > 0, F.ceil(F.log2(length)) - 1).otherwise(0).cast("double")
    bins = lambda c, k: F.floor(c / F.pow(F.lit(2.0), k))
    spans = intervals.where(length >= 0).withColumns({f"{_I}_power": power, f"{_I}_low": begin, f"{_I}_high": end})
    powers = spans.agg(F.collect_set(f"{_I}_power")).scalar()
    first, last = bins(lo, F.col(f"{_I}_power")), bins(hi, F.col(f"{_I}_power"))
    placed = spans.withColumn(f"{_I}_bin", F.explode(F.sequence(F.least(first, last), last)))
    seen = points.where(p.isNotNull()).withColumn(f"{_P}_at", at).withColumn(f"{_P}_power", F.explode(powers))
    seen = seen.withColumn(f"{_P}_bin", bins(p, F.col(f"{_P}_power")))
    meet = (F.col(f"{_P}_power") == F.col(f"{_I}_power")) & (F.col(f"{_P}_bin") == F.col(f"{_I}_bin"))
    value, least, most = F.col(f"{_P}_at"), F.col(f"{_I}_low"), F.col(f"{_I}_high")
    exact = (value > least if open_low else value >= least) & (value < most if open_high else value <= most)
    joined = seen.join(placed, meet & exact if condition is None else meet & exact & condition)
    return joined.drop(f"{_P}_at", f"{_P}_power", f"{_P}_bin", f"{_I}_low", f"{_I}_high", f"{_I}_power", f"{_I}_bin")


def band_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, below, above, condition: Column | None = None) -> DataFrame:
    """Inner join of the pairs whose right key lies from `below` under to `above` over the left key."""
    return range_join(right, left, right_key, left_key - below, left_key + above, condition)

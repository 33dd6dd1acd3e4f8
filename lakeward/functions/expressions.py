"""Column expressions with the warehouse's semantics."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_from(a: Column | list[Column], b: Column | list[Column]) -> Column:
    """IS DISTINCT FROM, for single values or rows."""
    if isinstance(a, list):
        return ~reduce(and_, (x.eqNullSafe(y) for x, y in zip(a, b, strict=True)))
    return ~a.eqNullSafe(b)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def rounded(c: Column, kind: str) -> Column:
    """Narrowing that rounds halves to even instead of cutting off."""
    return F.rint(c.cast("double")).cast(kind)


def flag(c: Column) -> Column:
    """A 0/1 number as boolean; null stays null."""
    return c == 1


def part_of_day(ts: Column, source: str = "America/New_York", target: str = "America/Chicago") -> Column:
    """morning, noon, afternoon or night of a local time, told in another zone."""
    h = F.hour(F.convert_timezone(F.lit(source), F.lit(target), ts))
    return F.when(ts.isNull(), None).when(h < 12, "morning").when(h < 14, "noon").when(h < 17, "afternoon").otherwise("night")


def kickoff(day: Column, clock: Column) -> Column:
    """A date and an HH:mm text as one timestamp without zone."""
    return F.to_timestamp_ntz(F.concat_ws(" ", day.cast("string"), clock), F.lit("yyyy-MM-dd HH:mm"))


def row_hash(columns: list[str]) -> Column:
    """md5 over the columns' texts; null and the empty text hash alike."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)).cast("binary"))

"""Joins of points with the intervals that hold them.

An interval is stored in the bins that it meets at its own level: bins there are at least as wide as it is
long, so it meets two at most, however long it is (more if `few_levels` says so). A point looks into one bin of each
level that intervals of its key are at. So neither long intervals nor keys with many of them are compared with everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.expressions import all_of


def on_axis(df: DataFrame, column: str) -> Column:
    """A date, timestamp or number as a double: days, microseconds or itself."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = F.unix_micros(c.cast("timestamp"))
    return c.cast("double")


def _level(lo: Column, hi: Column) -> Column:
    """The level at which an interval meets two bins at most."""
    return F.when(hi > lo, F.ceil(F.log2(hi - lo))).otherwise(F.lit(0)).cast("int")


def few_levels(intervals: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """Levels for `point_in_interval`, one row a key, where a key has about as many points as intervals: intervals go
    to the next lower level that is kept, into more bins than two, if that makes fewer copies than to have
    all points of the key look into one more level."""
    lo, hi = on_axis(intervals, low), on_axis(intervals, high)
    of = [F.col(k).alias(f"__{k}") for k in keys]
    met = intervals.where(lo <= hi).groupBy(*of, _level(lo, hi).alias("level")).agg(F.count("*").alias("n"), F.sum(hi - lo).alias("length"))
    held = met.groupBy(*(f"__{k}" for k in keys)).agg(F.array_sort(F.collect_list(F.struct("level", "n", "length"))).alias("held"), F.sum("n").alias("points"))
    # the copies of a level's intervals in bins of the last level kept
    copies = "x.length / pow(2.0D, element_at(kept, -1)) + x.n"
    kept = F.expr(f"aggregate(held, array(held[0].level), (kept, x) -> if(x.level = element_at(kept, -1) or {copies} <= points, kept, concat(kept, array(x.level))))")
    return held.select(*(f"__{k}" for k in keys), kept.alias("__levels"))


def point_in_interval(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, low: str, high: str, levels: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Every pair of a point and an interval with equal keys (null equals nothing) and low <= at <= high, both ends
    included, once. Columns of the intervals other than the keys have to have names of their own. An interval
    with a null end, or that ends before it starts, holds nothing. `levels` are those of `few_levels`, by default all
    that intervals of a key are at. Pairs are made in as many `tasks`, by default in as many as what is read is large for."""
    lo, hi = on_axis(intervals, low), on_axis(intervals, high)
    held = intervals.where(lo <= hi).withColumn("__level", _level(lo, hi))
    if levels is not None:
        mine = all_of([F.col(k) == F.col(f"__{k}") for k in keys])
        held = held.join(levels, mine).withColumn("__level", F.expr("array_max(filter(__levels, x -> x <= __level))")).drop("__levels", *(f"__{k}" for k in keys))
    width = F.pow(F.lit(2.0), F.col("__level"))
    bins = F.sequence(F.floor(lo / width), F.floor(hi / width))
    binned = held.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__level").alias("__their"), F.explode(bins).alias("__bin"), *(c for c in intervals.columns if c not in keys))
    if levels is None:
        levels = held.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.collect_set("__level").alias("__levels"))  # some sixty numbers a key at most
    same = all_of([F.col(k) == F.col(f"__{k}") for k in keys])
    spare = [f"__{k}" for k in keys]
    looking = points.join(levels, same).drop(*spare).withColumn("__level", F.explode("__levels")).drop("__levels").withColumn("__look", F.floor(on_axis(points, at) / width))
    if tasks is not None:
        looking = looking.repartition(tasks, *keys, "__level", "__look")
    on = same & (F.col("__level") == F.col("__their")) & (F.col("__look") == F.col("__bin")) & F.col(at).between(F.col(low), F.col(high))
    return looking.join(binned, on).drop("__level", "__look", "__their", "__bin", *spare)

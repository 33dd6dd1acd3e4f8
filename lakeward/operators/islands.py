"""Runs, stints and tenures: gaps and islands, and their collapse over periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.expressions import all_of
from lakeward.sources.scratch import staged

from .split import Split


def islands(df: DataFrame, part: list[str], order: list[str], value: str, name: str = "run_no", split: bool = False) -> DataFrame:
    """Numbers the runs of equal values (null is a value) from 0 in each partition. With `split` a
    partition may hold a large share of the rows: it is dealt over several tasks."""
    if split:
        parts = Split(df, part, order)
        rows = parts.before(parts.rows, "__before", F.col(value))
        new = F.col("__before").isNull() | ~F.col("__before.v").eqNullSafe(F.col(value))
        rows = parts.running_sum(rows.withColumn("__changed", new.cast("int")), "__sum", "__changed")
        return rows.select(*df.columns, (F.col("__sum") - 1).alias(name))
    w = Window.partitionBy(*part).orderBy(*order)
    first = F.row_number().over(w) == 1
    step = (first | ~F.lag(value).over(w).eqNullSafe(F.col(value))).cast("int")
    changed = df.withColumn("__changed", step)
    return changed.withColumn(name, F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("__changed")


def stints(df: DataFrame, part: list[str], order: list[str], value: str, at: str, split: bool = False) -> DataFrame:
    """One row per run: its first and last moment, and how many runs its partition has."""
    runs = islands(df, part, order, value, split=split).groupBy(*part, value, "run_no").agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n"))
    if split:
        runs = staged(runs)
        each = runs.groupBy(*(F.col(k).alias(f"__{k}") for k in part)).agg(F.count("*").alias("stints"))
        return runs.join(each, all_of([F.col(k).eqNullSafe(F.col(f"__{k}")) for k in part])).drop(*(f"__{k}" for k in part))
    return runs.withColumn("stints", F.count("*").over(Window.partitionBy(*part)))


def period_starts(df: DataFrame, key: str, period: str, at: str) -> DataFrame:
    """(period, key, first_day, last_day): a period starts the day after the last day of the
    one before, the first with its first day."""
    bounds = df.groupBy(key, period).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_day"))
    before = F.lag("last_day").over(Window.partitionBy(key).orderBy(period))
    return bounds.select(period, key, F.coalesce(F.date_add(before, 1), F.col("first_seen")).alias("first_day"), "last_day")


def dated_stints(
    runs: DataFrame, calendar: DataFrame, recorded: DataFrame, part: list[str], value: str, recorded_source: str = "recorded", log_source: str = "log"
) -> DataFrame:
    """Stints with dates: what is recorded beats the log of events, which beats the calendar.
    recorded has (part, value, is_interim, start_date, end_date)."""
    h, w = runs.alias("h"), recorded.withColumn("__hit", F.lit(True)).alias("w")
    on = [F.col(f"h.{k}") == F.col(f"w.{k}") for k in (*part, value)]
    last = F.col("h.run_no") == F.col("h.stints") - 1
    started, ended = F.col("w.start_date").isNotNull(), F.col("w.end_date").isNotNull()
    return (
        h.join(calendar.alias("c"), [F.col(f"h.{k}") == F.col(f"c.{k}") for k in part])
        .join(w, on, "left")
        .select(
            *(F.col(f"h.{k}") for k in (*part, value)),
            F.coalesce("w.is_interim", F.lit(False)).alias("is_interim"),
            (started | (F.col("h.run_no") > 0)).alias("explicit_start"),
            F.when(started, F.col("w.start_date")).when(F.col("h.run_no") > 0, F.col("h.first_at")).otherwise(F.col("c.first_day")).alias("start_date"),
            F.when(started, recorded_source).otherwise(log_source).alias("start_source"),
            (ended | ~last).alias("explicit_end"),
            F.when(ended, F.col("w.end_date")).when(~last, F.col("h.last_at")).otherwise(F.col("c.last_day")).alias("end_date"),
            F.when(ended, recorded_source).otherwise(log_source).alias("end_source"),
        )
    )


def recorded_rows(
    recorded: DataFrame, calendar: DataFrame, part: list[str], value: str, role: str, recorded_source: str = "recorded", log_source: str = "log"
) -> DataFrame:
    """Rows known from records alone: an undated interim change leaves the boundaries around it
    unknown, with neither date nor source."""
    unclear = recorded.groupBy(*part, role).agg(F.bool_or(F.col("is_interim") & F.col("start_date").isNull()).alias("unclear"))
    s = recorded.join(calendar, part).join(unclear, [*part, role])
    started, ended = F.col("start_date").isNotNull(), F.col("end_date").isNotNull()
    open_end = F.col("unclear") & ~F.col("is_interim")
    return s.select(
        *part, value, role, "is_interim",
        (started | F.col("is_interim")).alias("explicit_start"),
        F.when(started, F.col("start_date")).when(~F.col("is_interim"), F.col("first_day")).alias("start_date"),
        F.when(started, recorded_source).when(~F.col("is_interim"), log_source).alias("start_source"),
        (ended | open_end).alias("explicit_end"),
        F.when(ended, F.col("end_date")).when(~open_end, F.col("last_day")).alias("end_date"),
        F.when(ended, recorded_source).when(~open_end, log_source).alias("end_source"),
    )


def collapse(df: DataFrame, keys: list[str], period: str, latest: Column | int, split: bool = False) -> DataFrame:
    """Joins rows of consecutive periods to tenures. A tenure starts where there is no
    row before, a period is missing, the row before ended explicitly or this one
    starts so; one that reaches the latest period without an explicit end in it is ongoing. With
    `split` a key may hold a large share of the rows."""
    latest = latest if isinstance(latest, Column) else F.lit(latest)
    order = [F.col(period), F.col("start_date").asc_nulls_first()]
    new = F.col("__prev").isNull() | (F.col("__prev") != F.col(period) - 1) | F.coalesce("__ended", F.lit(False)) | F.col("explicit_start")
    if split:
        parts = Split(df, keys, order)
        seq = parts.before(parts.rows, "__before", F.struct(F.col(period).alias("p"), F.col("explicit_end").alias("e")))
        seq = seq.withColumn("__prev", F.col("__before.v.p")).withColumn("__ended", F.col("__before.v.e"))
        numbered = parts.running_sum(seq.withColumn("__new", new.cast("int")), "tenure_no", "__new")
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
        seq = df.withColumn("__prev", F.lag(period).over(w)).withColumn("__ended", F.lag("explicit_end").over(w))
        numbered = seq.withColumn("tenure_no", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # the greatest (period, ended) tells whether any row of the last period ended
    grouped = numbered.groupBy(*keys, "tenure_no").agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.min_by("start_date", period).alias("start_date"),
        F.min_by("start_source", period).alias("start_source"),
        F.max_by("end_date", period).alias("__end"),
        F.max_by("end_source", period).alias("__source"),
        F.max(F.struct(F.col(period), F.col("explicit_end"))).alias("__last"),
    ).withColumn("__closed", F.col("__last.explicit_end"))
    ongoing = (F.col("last_period") == latest) & ~F.col("__closed")
    return grouped.select(
        *keys, "first_period", "last_period", "start_date", "start_source",
        F.when(~ongoing, F.col("__end")).alias("end_date"), F.when(ongoing, "ongoing").otherwise(F.col("__source")).alias("end_source"),
    )

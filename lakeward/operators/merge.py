"""Incremental loads: new rows, change detection and upserts as new snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.expressions import all_of, distinct_from


def only_new(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows later than the target's latest; rows as late as it do not count. The mark is
    fetched first, so the filter is a literal that reaches the scan."""
    mark = target.agg(F.max(column)).first()[0] if target is not None else None
    return source if mark is None else source.where(F.col(column) > F.lit(mark))


def same_key(a: str, b: str, keys: list[str]):
    return all_of([F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, check: bool = True) -> DataFrame:
    """The next snapshot: matched rows take the source's columns (or only `update`), new
    rows are added, none is removed. A key twice in the source is an error."""
    if check and source.groupBy(*keys).count().where("count > 1").head(1):
        raise ValueError(f"the source repeats a key of {keys}")
    source = source.select(*target.columns)
    if update is None:
        return target.join(source, keys, "left_anti").select(*target.columns).unionByName(source)
    t, s = target.alias("t"), source.withColumn("__hit", F.lit(True)).alias("s")
    merged = t.join(s, same_key("t", "s", keys), "left").select(
        *(F.when(F.col("s.__hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in update else F.col(f"t.{c}") for c in target.columns)
    )
    return merged.unionByName(source.join(target, keys, "left_anti").select(*target.columns))


def changed_only(candidates: DataFrame, existing: DataFrame, keys: list[str], columns: list[str], now) -> DataFrame:
    """Candidates that are new or differ in `columns`; created_at is the existing row's,
    updated_at is `now`, one value for the run. What exists grows with the facts and is never broadcast, however
    small its files are."""
    c, e = candidates.alias("c"), existing.withColumn("__hit", F.lit(True)).alias("e")
    differs = distinct_from([F.col(f"e.{x}") for x in columns], [F.col(f"c.{x}") for x in columns])
    return (
        c.join(e.hint("merge"), same_key("c", "e", keys), "left")
        .where(F.col("e.__hit").isNull() | differs)
        .select("c.*", F.coalesce(F.col("e.created_at"), F.lit(now)).alias("created_at"), F.lit(now).alias("updated_at"))
    )

"""Dimensions and facts: bounded mappings, majority values, role-playing joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import point_in_interval
from .retype import latest_by


def one_at_a_time(mapping: DataFrame) -> DataFrame:
    """The mapping(source_value, canonical_value, valid_from, valid_to) in pieces of which one at most holds in any
    period: where several do, the one that began last counts, of those the smallest canonical value."""
    m = mapping.select("source_value", "canonical_value", F.coalesce("valid_from", F.lit(0)).alias("valid_from"), F.coalesce("valid_to", F.lit(9999)).alias("valid_to"))
    m = m.where("source_value is not null and valid_from <= valid_to").distinct()
    turns = m.select("source_value", F.explode(F.array("valid_from", F.col("valid_to") + 1)).alias("first")).distinct()
    pieces = turns.withColumn("last", F.lead("first").over(Window.partitionBy("source_value").orderBy("first")) - 1).where("last is not null")
    held = point_in_interval(pieces, m, ["source_value"], "first", "valid_from", "valid_to")
    rank = F.struct((-F.col("valid_from")).alias("began"), "canonical_value")
    best = held.groupBy("source_value", "first", "last").agg(F.min(rank).alias("m"))
    return best.select("source_value", "m.canonical_value", F.col("first").alias("valid_from"), F.col("last").alias("valid_to"))


def bounded_mapping(df: DataFrame, column: str, period: str, mapping: DataFrame, large: bool = False) -> DataFrame:
    """`column` replaced where a mapping(source_value, canonical_value, valid_from, valid_to) holds in the row's
    period; open ends reach from 0 to 9999. Where several hold, `one_at_a_time` says which counts, so
    no row is multiplied. A `large` mapping is met by the distinct values and periods alone, by bins of its validity."""
    m = one_at_a_time(mapping)
    if large:
        asked = df.select(F.col(column).alias("source_value"), F.col(period).alias("__period")).where("source_value is not null and __period is not null").distinct()
        m = point_in_interval(asked, m, ["source_value"], "__period", "valid_from", "valid_to").select("source_value", "canonical_value", F.col("__period").alias("valid_from"))
        on = (F.col(column) == F.col("source_value")) & (F.col(period) == F.col("valid_from"))
    else:
        on = (F.col(column) == F.col("source_value")) & F.col(period).between(F.col("valid_from"), F.col("valid_to"))
    mapped = F.coalesce(F.col("canonical_value"), F.col(column))
    return df.join(m, on, "left").select(*(mapped.alias(c) if c == column else F.col(c) for c in df.columns))


def majority_latest(df: DataFrame, key: str, period: str, column: str) -> DataFrame:
    """Per key the value of its latest period that occurs most, the smallest of equals."""
    counted = df.where(F.col(column).isNotNull()).groupBy(key, period, column).agg(F.count("*").alias("n"))
    return latest_by(counted, [key], [F.col(period).desc(), F.col("n").desc(), F.col(column)]).select(key, column)


def roof_rule(df: DataFrame, key: str, column: str, telling: list[str], verdict: str) -> DataFrame:
    """`verdict` if the key ever showed a telling value, else its most frequent value,
    the smallest of equals. Values are counted first, so a key with many rows is never in one task."""
    counted = df.where(F.col(column).isNotNull()).groupBy(key, column).agg(F.count("*").alias("n"))
    mode = F.min(F.struct((-F.col("n")).alias("less"), F.col(column).alias("v")))["v"]
    return counted.groupBy(key).agg(F.when(F.bool_or(F.col(column).isin(*telling)), verdict).otherwise(mode).alias(column))


def sides(result: Column, home: Column, away: Column) -> tuple[Column, Column]:
    """(winner, loser) by the sign of a result; neither on a tie or without one."""
    return F.when(result > 0, home).when(result < 0, away), F.when(result > 0, away).when(result < 0, home)


def unpivot(df: DataFrame, sides_: list[dict[str, str]]) -> DataFrame:
    """One row per side: each dict maps output columns to source columns. A single scan."""
    rows = F.array(*(F.struct(*(F.col(src).alias(out) for out, src in side.items())) for side in sides_))
    return df.select(F.explode(rows).alias("__r")).select("__r.*")

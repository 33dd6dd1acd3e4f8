"""Stable integer identities for names that come in many spellings."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.sources.scratch import staged

IDENTITY = "alias string, id int, name string, source string"


def resolve(spellings: DataFrame, mappings: DataFrame) -> DataFrame:
    """(alias, name, source) of distinct spellings(alias) and the mappings' own
    (source_value, canonical_value); null spellings are ignored."""
    every = spellings.select("alias").where("alias is not null").union(mappings.select("source_value")).distinct()
    m = mappings.select("source_value", "canonical_value")
    return every.join(m, every["alias"] == m["source_value"], "left").select(
        "alias",
        F.coalesce("canonical_value", "alias").alias("name"),
        F.when(F.col("source_value").isNull(), "canonical").otherwise("reference_mappings").alias("source"),
    )


def spellings_of(sources: list[tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Distinct spellings of several (frame, column, extra condition)."""
    parts = [(df.where(extra) if extra else df).select(F.col(c).cast("string").alias("alias")).where("alias is not null").distinct() for df, c, extra in sources]
    return reduce(DataFrame.union, parts).distinct()


#: The highest id given out so far, or a function that reserves so many ids and returns the one before them.
Mark = int | Callable[[int], int]


def mint_ids(names: DataFrame, high_water: Mark, column: str = "name") -> DataFrame:
    """(name, id): ids after high_water in the order of names. Distinct names are dealt by ranges and written, once;
    the ranges' sizes, one number each, say where each begins, so no task sorts all names."""
    own = staged(names.select(column).distinct().repartitionByRange(column).withColumn("__range", F.spark_partition_id()))
    sizes = sorted(map(tuple, own.groupBy("__range").count().collect()))
    n = sum(size for _, size in sizes)
    first = (high_water(n) if n else 0) if callable(high_water) else high_water
    ends = accumulate((size for _, size in sizes), initial=first)
    starts = own.sparkSession.createDataFrame([(r, start) for (r, _), start in zip(sizes, ends, strict=False)], "__range int, __start long")
    nth = F.row_number().over(Window.partitionBy("__range").orderBy(column))
    return own.withColumn("__nth", nth).join(F.broadcast(starts), "__range").select(column, (F.col("__start") + F.col("__nth")).cast("int").alias("id"))  # one row a range


def known_ids(resolved: DataFrame, existing: DataFrame) -> DataFrame:
    """The smallest id that rows of a still valid name hold."""
    return existing.join(resolved.select("name").distinct(), "name", "left_semi").groupBy("name").agg(F.min("id").alias("id"))


def inherited_ids(resolved: DataFrame, existing: DataFrame, known: DataFrame) -> DataFrame:
    """For names without an id, the smallest id of a spelling, if every row that holds that id
    resolves to the name."""
    r, e = resolved.alias("r"), existing.alias("e")
    claims = r.join(e, F.col("r.alias") == F.col("e.alias")).select(F.col("r.name").alias("name"), F.col("e.id").alias("id"))
    claims = claims.join(known.select("name"), "name", "left_anti")
    holders = e.join(r, F.col("r.alias") == F.col("e.alias"), "left").select(F.col("e.id").alias("id"), F.coalesce("r.name", F.lit("")).alias("holder"))
    c, h = claims.alias("c"), holders.alias("h")
    return c.join(h, (F.col("c.id") == F.col("h.id")) & (F.col("h.holder") != F.col("c.name")), "left_anti").groupBy("name").agg(F.min("id").alias("id"))


def identity_rows(spellings: DataFrame, mappings: DataFrame, existing: DataFrame, high_water: Mark) -> DataFrame:
    """New or changed identity rows (alias, id, name, source). A name keeps its id, else takes over a
    spelling's, else gets one after high_water, which no retired id can reach again."""
    resolved = resolve(spellings, mappings)
    known = known_ids(resolved, existing)
    inherited = inherited_ids(resolved, existing, known)
    fresh = resolved.select("name").join(known, "name", "left_anti").join(inherited, "name", "left_anti")
    ids = known.unionByName(inherited).unionByName(mint_ids(fresh, high_water))
    assigned = resolved.join(ids, "name").select("alias", "id", "name", "source")
    a, e = assigned.alias("a"), existing.withColumn("hit", F.lit(True)).alias("e")
    same = F.col("a.id").eqNullSafe(F.col("e.id")) & F.col("a.name").eqNullSafe(F.col("e.name")) & F.col("a.source").eqNullSafe(F.col("e.source"))
    return a.join(e, F.col("a.alias") == F.col("e.alias"), "left").where(F.col("e.hit").isNull() | ~same).select("a.*")


def next_high_water(rows: DataFrame, high_water: int) -> int:
    return max(high_water, rows.agg(F.max("id")).first()[0] or 0)


def alias_pairs(keys: DataFrame, key: str, other: str) -> DataFrame:
    """(alias, name): each key for itself, and its other name where only one key has it
    and it differs. There may be as many keys as facts, so they are never broadcast."""
    unique = keys.groupBy(other).agg(F.count("*").alias("n")).where("n = 1").select(other)
    own = keys.select(F.col(key).cast("string").alias("alias"), F.col(key).cast("string").alias("name"))
    old = keys.join(unique.hint("merge"), other, "left_semi").where(F.col(other).cast("string") != F.col(key).cast("string"))
    return own.unionByName(old.select(F.col(other).cast("string").alias("alias"), F.col(key).cast("string").alias("name")))


def alias_identities(pairs: DataFrame, existing: DataFrame, high_water: Mark) -> DataFrame:
    """(alias, id, name, source) of pairs(alias, name); one id per name in name order. There may be as many
    names as facts, so they are never broadcast."""
    known = existing.groupBy("name").agg(F.min("id").alias("id"))
    fresh = pairs.select("name").join(known.hint("merge"), "name", "left_anti")
    ids = known.unionByName(mint_ids(fresh, high_water))
    return pairs.join(ids.hint("merge"), "name").select("alias", "id", "name", F.when(F.col("alias") == F.col("name"), "canonical").otherwise("alias").alias("source"))


def current_set(facts: DataFrame, period: str, name: str, mappings: DataFrame) -> DataFrame:
    """Names in use in the latest period, after mapping."""
    latest = facts.agg(F.max(period).alias("latest"))
    m = mappings.select("source_value", "canonical_value")
    now = facts.join(F.broadcast(latest), facts[period] == F.col("latest"))  # one row
    return now.join(m, F.col(name).cast("string") == F.col("source_value"), "left").select(F.coalesce("canonical_value", F.col(name).cast("string")).alias("name")).distinct()

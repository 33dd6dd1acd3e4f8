"""Filtered, sorted and paged reads over a fact with role-playing dimensions."""

from __future__ import annotations

import hmac
import threading
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.expressions import all_of
from lakeward.sources.scratch import staged

#: A page that begins after so many rows is sought by ranges of the order.
DEEP = 10_000


class Invalid(ValueError):
    """A query that the caller must correct."""


@dataclass(frozen=True)
class Surface:
    """What a page may be filtered and sorted by."""

    equal: dict[str, str]
    least: dict[str, str]
    most: dict[str, str]
    either: dict[str, tuple[str, str]]
    known: dict[str, str]
    sorts: dict[str, str]
    key: str
    max_limit: int = 1000
    #: What a filter's value must be: one of some values, or of a type.
    choices: dict[str, tuple] = field(default_factory=dict)
    kinds: dict[str, type | tuple[type, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class PageQuery:
    filters: dict[str, Any] = field(default_factory=dict)
    sort: str | None = None
    descending: bool = False
    limit: int = 100
    offset: int = 0


def check_value(surface: Surface, name: str, value: Any) -> None:
    if name in surface.choices and value not in surface.choices[name]:
        raise Invalid(f"{name} is none of {', '.join(map(str, surface.choices[name]))}")
    kind = surface.kinds.get(name)
    if kind and (not isinstance(value, kind) or isinstance(value, bool) is not (kind is bool)):
        raise Invalid(f"{name} has the wrong type")


def predicate(surface: Surface, q: PageQuery) -> Column:
    """All given filters together; a filter that the surface lacks is an error."""
    if not 1 <= q.limit <= surface.max_limit or q.offset < 0:
        raise Invalid("limit or offset out of range")
    parts = []
    for name, value in q.filters.items():
        if value is None:
            continue
        check_value(surface, name, value)
        if name in surface.equal:
            parts.append(F.col(surface.equal[name]) == F.lit(value))
        elif name in surface.least:
            parts.append(F.col(surface.least[name]) >= F.lit(value))
        elif name in surface.most:
            parts.append(F.col(surface.most[name]) <= F.lit(value))
        elif name in surface.either:
            a, b = surface.either[name]
            parts.append((F.col(a) == F.lit(value)) | (F.col(b) == F.lit(value)))
        elif name in surface.known:
            c = F.col(surface.known[name])
            parts.append(c.isNotNull() if value else c.isNull())
        else:
            raise Invalid(f"unknown filter {name}")
    return all_of(parts)


def page(df: DataFrame, surface: Surface, q: PageQuery) -> DataFrame:
    """Nulls come last in either direction, ties follow the key in the same direction."""
    where = predicate(surface, q)
    if q.sort is not None and q.sort not in surface.sorts:
        raise Invalid(f"unknown sort {q.sort}")
    turn = (lambda c: F.col(c).desc_nulls_last()) if q.descending else (lambda c: F.col(c).asc_nulls_last())
    order = [*([turn(surface.sorts[q.sort])] if q.sort else []), turn(surface.key)]
    rows = df.where(where)
    return rows.orderBy(*order).offset(q.offset).limit(q.limit) if q.offset < DEEP else deep_page(rows, order, q)


def deep_page(df: DataFrame, order: list[Column], q: PageQuery) -> DataFrame:
    """A page far from the start: rows are dealt by ranges of the order and written, the ranges' sizes, one number each, say
    which of them hold the page, and only those are numbered. So no task gets all rows that come before."""
    own = staged(staged(df).repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    first, starts = 0, []
    for r in sorted(own.groupBy("__range").agg(F.count("*").alias("n")).collect(), key=lambda r: r["__range"]):
        if first < q.offset + q.limit and first + r.n > q.offset:
            starts.append((r["__range"], first))
        first += r.n
    if not starts:
        return own.limit(0).drop("__range")
    begin = F.element_at(F.create_map(*(F.lit(x) for pair in starts for x in pair)), F.col("__range"))
    at = begin + F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    held = own.where(F.col("__range").isin(*(r for r, _ in starts))).withColumn("__at", at)
    return held.where((F.col("__at") > q.offset) & (F.col("__at") <= q.offset + q.limit)).orderBy("__at").select(*df.columns)


def total(df: DataFrame, surface: Surface, q: PageQuery) -> DataFrame:
    return df.where(predicate(surface, q)).agg(F.count("*").alias("total"))


def with_sides(fact: DataFrame, dim: DataFrame, key: str, name: str, home: str, away: str) -> DataFrame:
    """The fact with a dimension joined twice, as home_name and away_name."""
    out = fact
    for side, c in (("home", home), ("away", away)):
        d = dim.select(F.col(key).alias(f"__{side}"), F.col(name).alias(f"{side}_name"))
        out = out.join(d, F.col(c) == F.col(f"__{side}"), "left").drop(f"__{side}")
    return out


def dimension(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(F.col(order).asc_nulls_last())


def one(df: DataFrame, key: str, value: Any):
    """The row, or None."""
    rows = df.where(F.col(key) == F.lit(value)).limit(1).collect()
    return rows[0] if rows else None


def children_of(parent: DataFrame, child: DataFrame, key: str, value: Any, order: list[str]):
    """None if the parent is unknown, else its children in order, maybe none."""
    if one(parent, key, value) is None:
        return None
    return child.where(F.col(key) == F.lit(value)).orderBy(*order).collect()


def nested(parents: DataFrame, children: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Parents with an array of their children, empty where there are none."""
    fields = [c for c in children.columns if c != key]
    first = F.struct(*(F.col(c) for c in (*order, *(f for f in fields if f not in order))))
    grouped = children.groupBy(key).agg(F.sort_array(F.collect_list(first)).alias(name))
    return parents.join(grouped, key, "left").withColumn(name, F.coalesce(name, F.array().cast(grouped.schema[name].dataType)))


def of_ids(df: DataFrame, key: str, ids: list) -> DataFrame:
    """Rows whose key is one of a page's ids; a literal list, so the filter reaches the scan."""
    return df.where(F.col(key).isin(*ids)) if ids else df.limit(0)


class TimedOut(Exception):
    """A read that took longer than its caller waits."""


def rows_within(df: DataFrame, seconds: float) -> list:
    """The rows, or TimedOut: the jobs of the read are cancelled, those of others go on."""
    context = df.sparkSession.sparkContext
    tag, late = f"read-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        return df.collect()
    except Exception as e:
        if late.is_set():
            raise TimedOut(f"over {seconds} s") from e
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


class Reader:
    """What a service may do with stored tables: read them, each time within `seconds`. It holds a function from
    names to frames, such as `Project.frame`, and the names that are served; it has no way to write,
    and what is not on the list is Invalid."""

    def __init__(self, frame: Callable[[str], DataFrame], served: Iterable[str], seconds: float = 15.0):
        self._frame, self._served, self._seconds = frame, frozenset(served), seconds

    def _of(self, name: str) -> DataFrame:
        if name not in self._served:
            raise Invalid(f"{name} is not served")
        return self._frame(name)

    def page(self, name: str, surface: Surface, q: PageQuery) -> tuple[list, int]:
        """(the page's rows, the number of all rows that pass its filters)."""
        df = self._of(name)
        return rows_within(page(df, surface, q), self._seconds), rows_within(total(df, surface, q), self._seconds)[0][0]

    def dimension(self, name: str, order: str) -> list:
        return rows_within(dimension(self._of(name), order), self._seconds)

    def one(self, name: str, key: str, value: Any):
        """The row, or None."""
        rows = rows_within(self._of(name).where(F.col(key) == F.lit(value)).limit(1), self._seconds)
        return rows[0] if rows else None


def status_of(error: Exception | None) -> int:
    """The HTTP status that tells what a read ended with; None stands for a missing row."""
    if error is None:
        return 404
    if isinstance(error, Invalid):
        return 422
    if isinstance(error, TimedOut):
        return 504
    return 503 if isinstance(error, (AnalysisException, OSError)) else 500


def may_read(given: str | None, key: str | None) -> bool:
    """Whether a caller's key opens the service; without a key it is open."""
    return key is None or (given is not None and hmac.compare_digest(given.encode(), key.encode()))


def latest_runs(runs: DataFrame, n: int, key: str = "run_id") -> DataFrame:
    return runs.orderBy(F.col(key).desc()).limit(n)


def health(runs: DataFrame | None, key: str = "run_id", status: str = "status", good: str = "success") -> DataFrame | None:
    """The latest run and the latest good one; None if nothing was ever run."""
    if runs is None:
        return None
    last = lambda df, kind: df.orderBy(F.col(key).desc()).limit(1).withColumn("kind", F.lit(kind))
    return last(runs, "latest").unionByName(last(runs.where(F.col(status) == good), "latest_success"))

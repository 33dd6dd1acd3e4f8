"""Building models on top of the landing tables: what dbt-like projects declare, as snapshots."""

from __future__ import annotations

import json
import urllib.parse
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.merge import upsert
from lakeward.sources.scratch import scratch, staged
from lakeward.sources.snapshot import Conflict, Table, publish, published

__all__ = ["Marks", "Model", "Project", "scratch", "told"]


@dataclass(frozen=True)
class Model:
    """One table or view. `rows` gets the frames of `inputs` and what the model already holds
    (None at first) and returns what to store: everything, or the rows to merge by `keys`."""

    name: str
    rows: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    #: `merge`, `table` or `view`.
    kind: str = "table"
    keys: tuple[str, ...] = ()
    update: tuple[str, ...] | None = None
    #: The folder it stands in, taken as it is.
    layer: str = "marts"
    #: A full refresh leaves it as it is: its ids must not change.
    kept: bool = False
    #: A column of the keys that its rows are stored by: a merge writes the folders of the values it touches alone.
    partition: str | None = None
    #: Instead of such a column, so many folders by a hash of the keys.
    buckets: int = 0
    #: Columns that single rows are read by.
    lookup: tuple[str, ...] = ()
    #: Name to a function of the built frame that returns violating rows.
    checks: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind == "merge" and self.partition and self.partition not in self.keys:
            raise ValueError(f"{self.name}: a row could change its partition, as {self.partition} is no key")

    def stored(self, rows: DataFrame) -> DataFrame:
        """Rows as they are stored, with their bucket if there are any."""
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")) if self.buckets else rows


class Marks:
    """High-water marks of minted ids by name. They only rise, so an id that is retired is never given out
    again, whatever becomes of the table that held it. Each rise is a file of its own, which of several
    drivers only one can publish; the others see it and go on from there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, name: str) -> str:
        return f"{self.path}/{urllib.parse.quote(name, safe='')}"

    def _latest(self, name: str) -> tuple[int, int]:
        """(number of rises, value); 0, 0 if there was none, any other fault is raised."""
        names = published(self.spark, self._folder(name))
        if not names:
            return 0, 0
        held = self.spark.read.text(f"{self._folder(name)}/{names[-1]}", wholetext=True).first()[0]
        return int(names[-1]), int(held)

    def get(self, name: str) -> int:
        return self._latest(name)[1]

    def _rise(self, name: str, to: Callable[[int], int]) -> tuple[int, int]:
        """(value before, value after) of one rise that nobody else has made."""
        while True:
            n, value = self._latest(name)
            if to(value) <= value:
                return value, value
            try:
                publish(self.spark, f"{self._folder(name)}/{n + 1:012d}", str(to(value)))
            except Conflict:
                continue  # another driver has risen it meanwhile
            return value, to(value)

    def raise_to(self, name: str, value: int) -> int:
        return self._rise(name, lambda held: value)[1]

    def reserve(self, name: str, n: int) -> int:
        """The mark before a rise by `n`: the `n` ids after it are the caller's alone."""
        return self._rise(name, lambda held: held + n)[0]


#: How often a merge that another driver was faster than is tried.
TRIES = 5
#: The column that says which of a model's buckets a row is in.
BUCKET = "__bucket"


class Project:
    """Models in the order of their inputs, each a snapshot table under `root`/layer/name. A source may be a
    function, which is asked when a build needs it."""

    def __init__(self, spark: SparkSession, root: str, models: list[Model], sources: dict[str, Table | DataFrame | Callable[[], DataFrame]]):
        self.spark, self.root, self.sources = spark, root.rstrip("/"), sources
        self.models = {m.name: m for m in models}
        self.views: dict[str, DataFrame] = {}

    def order(self) -> list[str]:
        graph = {m.name: [i for i in m.inputs if i in self.models] for m in self.models.values()}
        return [*TopologicalSorter(graph).static_order()]

    def table(self, name: str) -> Table:
        m = self.models[name]
        return Table(self.spark, f"{self.root}/{m.layer}/{name}", BUCKET if m.buckets else m.partition, m.lookup)

    def frame(self, name: str) -> DataFrame:
        if name in self.views:
            return self.views[name]
        if name in self.models:
            return self.table(name).read().drop(BUCKET)
        held = self.sources[name]
        if callable(held):
            return held()
        return held.read() if isinstance(held, Table) else held

    def build(self, full_refresh: bool = False, only: tuple[str, ...] = ()) -> dict[str, int]:
        """Builds all models, or `only` some, and returns violations by check. Views are
        (re)created, tables replaced, merges add and update and never delete."""
        broken = {}
        for name in self.order():
            m = self.models[name]
            if only and name not in only:
                continue
            table = self.table(name)
            afresh = full_refresh and not m.kept
            held = table.read().drop(BUCKET) if m.kind != "view" and table.exists() and not afresh else None
            rows = m.rows(*(self.frame(i) for i in m.inputs), held)
            if m.kind == "view":
                rows.createOrReplaceTempView(name)
                self.views[name] = rows
            elif m.kind == "merge" and held is not None:
                self._merge(m, table, rows)
            else:
                table.replace_all(m.stored(rows))
            for check, violating in m.checks.items():
                if n := violating(self.frame(name)).count():
                    broken[f"{name}.{check}"] = n
        return broken

    def _merge(self, m: Model, table: Table, rows: DataFrame) -> None:
        """Upserts over the folders that the rows touch. What another driver has published meanwhile is not
        lost: the merge is made again on it."""
        new = staged(m.stored(rows))  # read for the folders it touches, for its keys and for its rows
        change = lambda old, own: upsert(old, own, [*m.keys], None if m.update is None else [*m.update])
        for again in range(TRIES):
            try:
                table.merge_partitions(new, change)
                return
            except Conflict:
                if again == TRIES - 1:
                    raise


def told(violations: dict[str, int]) -> str:
    return json.dumps(violations, sort_keys=True)

"""Windows over keys that may hold a large share of all rows.

Rows are dealt by ranges of key and order, so that a key with many rows lies in several ranges, each of which one
task can hold. A window is then computed range by range, and what it needs from before a range is
carried over from a summary, one row per key and range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakeward.functions.expressions import all_of
from lakeward.sources.scratch import staged

RANGE = "__range"


class Split:
    """`rows` of a frame with the range each is in. They are written once, so that every later step sees the
    same ranges. Rows that agree in key and order share a range: the order has to tell a key's rows apart."""

    def __init__(self, df: DataFrame, part: list[str], order: list[Column | str], ranges: int | None = None):
        by = [*part, *order]
        dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
        self.part, self.order = part, order
        self.rows = staged(dealt.withColumn(RANGE, F.spark_partition_id()))

    def within(self) -> WindowSpec:
        """The window of a key's rows in one range, in order."""
        return Window.partitionBy(*self.part, RANGE).orderBy(*self.order)

    def carried(self, rows: DataFrame, name: str, summary: Column, over: Callable[[str], Column], after: bool = False) -> DataFrame:
        """`rows` with a column `name`: `over` of the summaries of the key's earlier ranges (of the later ones, the last
        range first, if `after`), null if there are none."""
        sums = rows.groupBy(*self.part, RANGE).agg(summary.alias("__sum"))
        far = Window.partitionBy(*self.part).orderBy(F.desc(RANGE) if after else F.asc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
        told = sums.select(*(F.col(k).alias(f"__of_{k}") for k in self.part), F.col(RANGE).alias("__of"), over("__sum").over(far).alias(name))
        on = all_of([F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in self.part] + [F.col(RANGE) == F.col("__of")])
        return rows.join(told, on).drop("__of", *(f"__of_{k}" for k in self.part))

    def before(self, rows: DataFrame, name: str, value: Column) -> DataFrame:
        """`rows` with `name`, the value of the key's row before, as a struct that is null only for a first row."""
        held = F.struct(value.alias("v"))
        at = F.row_number().over(self.within())
        rows = self.carried(rows.withColumn("__at", at), "__last", F.max_by(held, "__at"), lambda s: F.last(s))
        return rows.withColumn(name, F.when(F.col("__at") > 1, F.lag(held).over(self.within())).otherwise(F.col("__last"))).drop("__at", "__last")

    def running_sum(self, rows: DataFrame, name: str, value: str) -> DataFrame:
        """`rows` with `name`, the sum of `value` over the key's rows up to this one."""
        rows = self.carried(rows, "__sum_before", F.sum(value), F.sum)
        own = F.sum(value).over(self.within().rowsBetween(Window.unboundedPreceding, 0))
        return rows.withColumn(name, F.coalesce("__sum_before", F.lit(0)) + own).drop("__sum_before")

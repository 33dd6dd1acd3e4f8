"""Types inferred from the data, and the typed copy that applies them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.expressions import flag, row_hash, rounded

SHORT_MAX = 32767


@dataclass(frozen=True)
class Hints:
    """Columns whose type the data alone cannot tell."""

    keep_text: frozenset[str] = frozenset()
    not_flags: frozenset[str] = frozenset()
    long_flags: frozenset[str] = frozenset()
    dates: frozenset[str] = frozenset()
    timestamps: frozenset[str] = frozenset()
    times: frozenset[str] = frozenset()
    integers: frozenset[str] = frozenset()
    round_first: frozenset[str] = field(default=frozenset())


def profile(df: DataFrame) -> DataFrame:
    """One row: per number column whether all values are 0/1, whether all are whole,
    how many there are and the largest magnitude. One pass for all columns."""
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            out += [
                F.bool_and(c.isin(0.0, 1.0)).alias(f"{f.name}__flag"),
                F.bool_and(c == F.floor(c)).alias(f"{f.name}__whole"),
                F.count(c).alias(f"{f.name}__n"),
                F.max(F.abs(c)).alias(f"{f.name}__max"),
            ]
        elif isinstance(f.dataType, T.LongType):
            out.append(F.max(F.abs(c)).alias(f"{f.name}__max"))
    return df.agg(*out) if out else df.sparkSession.range(1).select()


def infer_casts(df: DataFrame, hints: Hints = Hints()) -> dict[str, str]:
    """Target type per column. In order: kept text, flag, date, timestamp, time, whole
    double, long, double to be rounded, as it is."""
    stats = profile(df).first()
    seen = stats.asDict() if stats else {}
    out = {}
    for f in df.schema.fields:
        c, kind = f.name, f.dataType
        text, double, long = isinstance(kind, T.StringType), isinstance(kind, T.DoubleType), isinstance(kind, T.LongType)
        narrow = lambda most: "int" if c in hints.integers or (most or 0) > SHORT_MAX else "smallint"  # noqa: B023, E731
        if c in hints.keep_text and text:
            out[c] = "string"
        elif (double and c not in hints.not_flags and seen[f"{c}__flag"] and seen[f"{c}__n"]) or (long and c in hints.long_flags):
            out[c] = "boolean"
        elif text and c in hints.dates:
            out[c] = "date"
        elif text and c in hints.timestamps:
            out[c] = "timestamp"
        elif text and c in hints.times:
            out[c] = "time"
        elif double and seen[f"{c}__whole"]:
            out[c] = narrow(seen[f"{c}__max"])
        elif long:
            out[c] = narrow(seen[f"{c}__max"])
        elif double and c in hints.round_first:
            out[c] = "smallint"
        else:
            out[c] = kind.simpleString()
    return out


def typed_copy(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Every column in its target type; numbers round halves to even, text that is no
    date is an error, a time of day stays HH:mm text."""
    out = []
    for f in df.schema.fields:
        c, to = F.col(f"`{f.name}`"), casts.get(f.name, f.dataType.simpleString())
        number = isinstance(f.dataType, (T.DoubleType, T.LongType))
        if to == "boolean" and number:
            c = flag(c)
        elif to in ("smallint", "int") and number:
            c = rounded(c, to)
        elif to == "time":
            c = F.date_format(F.to_timestamp(c, "HH:mm[:ss]"), "HH:mm")
        elif to != f.dataType.simpleString():
            c = c.cast(to)
        out.append(c.alias(f.name))
    return df.select(*out)


def row_id(df: DataFrame, columns: list[str] | None = None, name: str = "_row_id") -> DataFrame:
    return df.select(row_hash(columns or df.columns).alias(name), "*")


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")

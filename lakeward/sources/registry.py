"""Which datasets there are and how they are read."""

from __future__ import annotations

import datetime as dt
import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.types import store_type
from lakeward.sources.snapshot import Table, located

Loader = Callable[..., DataFrame]


class PeriodUnavailable(Exception):
    """The source has nothing for the period; the step is skipped."""


@dataclass(frozen=True)
class Dataset:
    name: str
    table: str
    loader: str | Loader
    partitioned: bool = True
    first_season: int = 0
    options: dict = field(default_factory=dict)
    unique: tuple[str, ...] = ()

    def seasons(self, start: int, end: int) -> list[int]:
        return [*range(max(start, self.first_season), end + 1)]


def parquet(spark: SparkSession, path: str, season: int | None = None, **_) -> DataFrame:
    df = _present(spark, path)
    return df.where(F.col("season") == season) if season is not None and "season" in df.columns else df


def _present(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder; only a missing one means that the source has nothing, any other fault
    is one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise PeriodUnavailable(path) from e
        raise


def mirror(spark: SparkSession, root: str, files: str, season: int | None = None, **_) -> DataFrame:
    """A mirrored source: <root>/<files>.parquet, or <root>/<files>/<season>.parquet."""
    return _present(spark, f"{root.rstrip('/')}/{files}.parquet" if season is None else f"{root.rstrip('/')}/{files}/{season}.parquet")


LOADERS: dict[str, Loader] = {"parquet": parquet, "mirror": mirror}

# The league's datasets with their first seasons and keys.
WHOLE = (("schedules", ("game_id",)), ("teams", ("team_abbr",)), ("players", ("gsis_id",)))
SEASONAL = (
    ("rosters", 1999), ("rosters_weekly", 2002), ("depth_charts", 2001), ("team_stats_week", 1999), ("player_stats_week", 1999),
    ("pbp", 1999), ("participation", 2016), ("coaching_staff", 2010), ("officials", 2015),
)


def league(root: str, staff: Loader | None = None) -> dict[str, Dataset]:
    """All datasets of the league, read from a mirror under `root`; staff lists come from
    `staff` where it is given."""
    at = lambda name: {"root": root, "files": name}
    whole = [Dataset(n, n, "mirror", partitioned=False, options=at(n), unique=key) for n, key in WHOLE]
    by_season = [Dataset(n, n, staff if staff and n == "coaching_staff" else "mirror", first_season=y, options={} if staff and n == "coaching_staff" else at(n)) for n, y in SEASONAL]
    return {d.name: d for d in (*whole, *by_season)}


def loader_of(dataset: Dataset) -> Loader:
    """A loader is a function, a registered name or a dotted path."""
    if callable(dataset.loader):
        return dataset.loader
    if dataset.loader in LOADERS:
        return LOADERS[dataset.loader]
    module, _, name = dataset.loader.rpartition(".")
    return getattr(importlib.import_module(module), name)


def fetch(spark: SparkSession, dataset: Dataset, season: int | None = None) -> DataFrame:
    if dataset.partitioned and season is None:
        raise ValueError(f"{dataset.name} is loaded season by season")
    more = {"season": season} if dataset.partitioned else {}
    return loader_of(dataset)(spark, **dataset.options, **more)


def landed(df: DataFrame, dataset: Dataset, season: int | None, now: dt.datetime) -> DataFrame:
    """What is stored of a source's rows, in one projection: names in lower case, the load's time,
    and for a dataset by season the season, which the file's own must equal."""
    own = {c.lower(): F.col(f"`{c}`") for c in df.columns}
    keep = None
    if dataset.partitioned:
        keep = own["season"] == season if "season" in own else None
        own.setdefault("season", F.lit(season).cast("bigint"))
    last = [own.pop("season")] if dataset.partitioned and "season" not in {c.lower() for c in df.columns} else []
    rows = df if keep is None else df.where(keep)
    return rows.select(*(c.alias(n) for n, c in own.items()), F.lit(now).alias("_loaded_at"), *(c.alias("season") for c in last))


def normalise(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Lower-case names and the time of the load, one value for all rows."""
    return landed(df, Dataset("", "", "", partitioned=False), None, now)


prepare = landed


class NotUnique(ValueError):
    """A source repeats a key that it declares unique."""


def load(spark: SparkSession, dataset: Dataset, season: int | None, table: Table, now: dt.datetime | None = None) -> int:
    """Fetches one dataset, or one season of it, and replaces what the landing table holds of
    it; returns the number of rows. Nothing is replaced if the source repeats a unique key."""
    rows = landed(fetch(spark, dataset, season), dataset, season, now or dt.datetime.now())
    rows = rows.select(*(F.col(f.name).cast(store_type(f.dataType)).alias(f.name) for f in rows.schema.fields))
    told = Observation()
    measures = [F.count(F.lit(1)).alias("n"), F.lit(False).alias("twice")]
    if dataset.unique:  # one window beside the rows tells repeats in the pass that writes them
        rows = rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*dataset.unique).orderBy(F.lit(0))))
        measures[1] = F.max(F.col("__nth") > 1).alias("twice")
    rows = rows.observe(told, *measures).drop("__nth")

    def checked() -> None:
        if told.get["twice"]:
            raise NotUnique(f"{dataset.name} repeats {dataset.unique}")

    table.replace_partition(rows, "season", season, checked) if dataset.partitioned else table.replace_all(rows, checked)
    return told.get["n"]


def seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header and declared types."""
    return spark.read.schema(schema).csv(path, header=True)


def overrides(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV as the given columns: absent ones are null, a missing file is empty."""
    want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    fs, file = located(spark, path)
    if not fs.exists(file):
        return spark.createDataFrame([], want)
    have = spark.read.csv(path, header=True)
    return have.select(*((F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def contract(df: DataFrame) -> str:
    """Columns and types as YAML text."""
    return "columns:\n" + "".join(f"  - name: {f.name}\n    data_type: {f.dataType.simpleString()}\n" for f in df.schema.fields)

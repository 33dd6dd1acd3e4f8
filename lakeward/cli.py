"""The command line: list, load, refresh, backfill, transform, staging truncate, current-season.

Settings come from the environment: LAKEWARD_ROOT (tables), LAKEWARD_MIRROR (sources),
LAKEWARD_START_SEASON, LAKEWARD_WEBHOOK and LAKEWARD_PROJECT, a dotted name of a function that
gets (spark, settings) and returns the build.Project to transform with.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from lakeward.plans import build, runner
from lakeward.sources import registry
from lakeward.sources.snapshot import Table, truncate_tables

#: A season is current from this month of its year on.
FIRST_MONTH = 9


@dataclass(frozen=True)
class Settings:
    root: str
    mirror: str
    start_season: int = 2010
    webhook: str | None = None
    project: str | None = None

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        e = os.environ if env is None else env
        return cls(
            e.get("LAKEWARD_ROOT", "lakeward-data"), e.get("LAKEWARD_MIRROR", "lakeward-mirror"), int(e.get("LAKEWARD_START_SEASON", "2010")), e.get("LAKEWARD_WEBHOOK"), e.get("LAKEWARD_PROJECT")
        )


def current_season(today: dt.date) -> int:
    return today.year if today.month >= FIRST_MONTH else today.year - 1


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeward")
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="the datasets")
    commands.add_parser("current-season", help="the season that refresh loads")
    one = commands.add_parser("load", help="one dataset, one season of it")
    one.add_argument("dataset")
    one.add_argument("--season", type=int)
    for name, told in (("refresh", "the current season of every dataset, then transform"), ("backfill", "a range of seasons, then transform")):
        many = commands.add_parser(name, help=told)
        many.add_argument("-d", "--dataset", action="append", dest="datasets")
        many.add_argument("--workers", type=int, default=4)
        many.add_argument("--retries", type=int, default=2)
        many.add_argument("--retry-delay", type=float, default=30.0)
        many.add_argument("--skip-transform", action="store_true")
        many.add_argument("--full-refresh", action="store_true")
        many.add_argument("--keep-staging", action="store_true")
        many.add_argument("--notify-success", action="store_true")
        if name == "backfill":
            many.add_argument("--start", type=int)
            many.add_argument("--end", type=int)
    again = commands.add_parser("transform", help="build the project")
    again.add_argument("--full-refresh", action="store_true")
    again.add_argument("models", nargs="*")
    staging = commands.add_parser("staging", help="the landing tables").add_subparsers(dest="what", required=True)
    clear = staging.add_parser("truncate")
    clear.add_argument("-d", "--dataset", action="append", dest="datasets")
    clear.add_argument("-y", "--yes", action="store_true")
    return p


@dataclass
class App:
    spark: SparkSession
    settings: Settings
    say: Callable[[str], None] = print
    ask: Callable[[str], str] = input
    today: dt.date | None = None
    project: build.Project | None = None

    def __post_init__(self) -> None:
        self.datasets = registry.league(self.settings.mirror)
        self.tables = {n: Table(self.spark, f"{self.settings.root}/staging/{d.table}", "season" if d.partitioned else None) for n, d in self.datasets.items()}
        if self.project is None and self.settings.project:
            module, _, name = self.settings.project.rpartition(".")
            self.project = getattr(importlib.import_module(module), name)(self.spark, self.settings)

    def chosen(self, names: list[str] | None) -> list[registry.Dataset]:
        if unknown := [n for n in names or () if n not in self.datasets]:
            raise SystemExit(f"unknown datasets: {', '.join(unknown)}")
        return [self.datasets[n] for n in names or self.datasets]

    def load(self, step: runner.Step) -> int:
        return registry.load(self.spark, self.datasets[step.dataset], step.season, self.tables[step.dataset])

    def transform(self, full_refresh: bool = False, models: tuple[str, ...] = ()) -> int:
        broken = self.project.build(full_refresh, models) if self.project else {}
        if broken:
            self.say(build.told(broken))
        return int(bool(broken))

    def clear(self, names: list[str] | None) -> list[str]:
        return truncate_tables(self.tables, names)

    def plan(self, a: argparse.Namespace) -> list[runner.Step]:
        end = getattr(a, "end", None) or current_season(self.today or dt.date.today())
        start = end if a.command == "refresh" else a.start or self.settings.start_season
        return runner.make_plan(self.chosen(a.datasets), start, end)

    def run(self, argv: list[str]) -> int:
        a = parser().parse_args(argv)
        if a.command == "list":
            for d in self.datasets.values():
                self.say(f"{d.name:20} {f'by season from {d.first_season}' if d.partitioned else 'whole'}")
        elif a.command == "current-season":
            self.say(str(current_season(self.today or dt.date.today())))
        elif a.command == "load":
            self.chosen([a.dataset])
            self.say(f"{a.dataset}: {self.load(runner.Step(a.dataset, a.season))} rows")
        elif a.command == "transform":
            return self.transform(a.full_refresh, tuple(a.models))
        elif a.command == "staging":
            self.chosen(a.datasets)
            if not a.yes and self.ask("Clear the landing tables? [y/N] ").strip().lower() != "y":
                return 1
            self.say(", ".join(self.clear(a.datasets)))
        else:
            log = runner.RunLog(self.spark, f"{self.settings.root}/ops")
            return runner.run_pipeline(
                self.plan(a), self.load, (lambda: 0) if a.skip_transform else lambda: self.transform(a.full_refresh),
                (lambda _: None) if a.keep_staging or a.skip_transform else self.clear, runner.History(log.save, started=log.save), lambda text: runner.notify(self.settings.webhook, text),
                kind=a.command, tell_success=a.notify_success, workers=a.workers, retries=a.retries, delay=a.retry_delay,
            )
        return 0


def main() -> None:
    spark = SparkSession.builder.appName("lakeward").getOrCreate()
    sys.exit(App(spark, Settings.from_env()).run(sys.argv[1:]))


if __name__ == "__main__":
    main()

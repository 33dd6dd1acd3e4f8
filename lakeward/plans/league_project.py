"""The league's marts as a project: identities, dimensions, the fact of games and the tenures, stored and merged.

`LAKEWARD_PROJECT=lakeward.plans.league_project.of_settings` lets the command line's `transform` build it
from the landing tables. A build adds what is new or has changed; ids, once minted, stay.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators import identity, retype
from lakeward.plans import marts
from lakeward.plans.build import Marks, Model, Project
from lakeward.sources import registry
from lakeward.sources.snapshot import Table

#: Types of a game's columns, where the landing table holds text or wider numbers.
GAME_TYPES = {
    "season": "smallint", "week": "smallint", "gameday": "date", "home_score": "smallint", "away_score": "smallint", "result": "smallint", "total": "smallint",
    "overtime": "boolean", "div_game": "boolean", "spread_line": "double", "total_line": "double",
}
STAFF_TYPES = {"season": "smallint", "is_interim": "boolean", "start_date": "date", "end_date": "date"}
MAPPINGS = "domain string, source_value string, canonical_value string, valid_from int, valid_to int"
ROLES = "role_id smallint, role string"


def models(spark: SparkSession, marks: Marks, now: dt.datetime) -> list[Model]:
    """Inputs are schedules, staff, teams_source, officials, mappings and roles."""
    stamp = F.lit(now)

    def known(held: DataFrame | None) -> DataFrame:
        return spark.createDataFrame([], identity.IDENTITY) if held is None else held

    def before(held: DataFrame | None, like: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        stamps = {"created_at": F.lit(None).cast("timestamp"), "updated_at": F.lit(None).cast("timestamp")}
        return like.limit(0).select(*keys, *values).withColumns(stamps) if held is None else held

    def minted(name: str):
        return lambda n: marks.reserve(name, n)

    def games(schedules, game_ids, team_ids, coach_ids, referee_ids, place_ids, held):
        rows = marts.games(schedules, game_ids, team_ids, coach_ids, referee_ids, place_ids)
        return marts.schedules(rows, before(held, rows, [], rows.columns), stamp)

    def tenures(schedules, staff, team_ids, coach_ids, mappings, roles, held):
        rows = marts.tenures(schedules, staff, team_ids, coach_ids, mappings, roles)
        return marts.coaching_tenures(rows, before(held, rows, marts.TENURE_KEYS, marts.TENURE_VALUES), stamp)

    def game_ids(schedules, held):
        pairs = identity.alias_pairs(schedules.select("game_id", F.col("espn").cast("string").alias("old")), "game_id", "old")
        return identity.alias_identities(pairs, known(held), minted("game"))

    def teams(ids, attributes, held):
        return marts.teams(ids, attributes, before(held, attributes.withColumn("team_id", F.col("team_id").cast("int")), ["team_id"], marts.TEAM_VALUES), stamp)

    def stadiums(schedules, ids, mappings, held):
        rows = marts.places(schedules, ids, mappings)
        return marts.stadiums(schedules, ids, mappings, before(held, rows, ["stadium_id"], marts.PLACE_VALUES), stamp)

    ids = {"kind": "merge", "keys": ("alias",), "layer": "reference", "kept": True}
    return [
        Model("team_ids", lambda s, t, m, held: marts.team_identities(s, t, m), ("schedules_source", "teams_source", "mappings"), **(ids | {"kind": "table"})),
        Model("coach_ids", lambda s, f, m, held: marts.coach_identities(s, f, m, known(held), minted("coach")), ("schedules_source", "staff", "mappings"), **ids),
        Model("referee_ids", lambda s, o, m, held: marts.referee_identities(s, o, m, known(held), minted("referee")), ("schedules_source", "officials", "mappings"), **ids),
        Model("place_ids", lambda s, held: marts.place_identities(s, known(held), minted("place")), ("schedules_source",), **ids),
        Model("game_ids", game_ids, ("schedules_source",), **ids, buckets=32),
        Model("teams", teams, ("team_ids", "teams_source"), "merge", ("team_id",)),
        Model("stadiums", stadiums, ("schedules_source", "place_ids", "mappings"), "merge", ("stadium_id",)),
        Model("schedules", games, ("schedules_source", "game_ids", "team_ids", "coach_ids", "referee_ids", "place_ids"), "merge", ("season", "game_id"), partition="season", lookup=("game_id",)),
        Model("coaching_tenures", tenures, ("schedules_source", "staff", "team_ids", "coach_ids", "mappings", "roles"), "merge", tuple(marts.TENURE_KEYS), buckets=8),
    ]


def project(spark: SparkSession, root: str, sources: dict, now: dt.datetime | None = None) -> Project:
    return Project(spark, root, models(spark, Marks(spark, f"{root.rstrip('/')}/marks"), now or dt.datetime.now()), sources)


def of_settings(spark: SparkSession, settings) -> Project:
    """The project over the landing tables under the settings' root, with seeds/reference_mappings.csv and
    seeds/coach_roles.csv beside them."""
    held = lambda name: Table(spark, f"{settings.root}/staging/{name}").read()
    typed = lambda df, kinds: retype.typed_copy(df, {c: kinds.get(c, t) for c, t in df.dtypes})
    seeds = f"{settings.root}/seeds"
    sources = {
        "schedules_source": lambda: typed(held("schedules").drop("_loaded_at"), GAME_TYPES), "staff": lambda: typed(held("coaching_staff").withColumnRenamed("person", "coach"), STAFF_TYPES),
        "teams_source": lambda: held("teams"), "officials": lambda: held("officials"), "mappings": lambda: registry.seed(spark, f"{seeds}/reference_mappings.csv", MAPPINGS),
        "roles": lambda: registry.seed(spark, f"{seeds}/coach_roles.csv", ROLES),
    }
    return project(spark, f"{settings.root}/warehouse", sources)

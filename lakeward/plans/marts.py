"""The marts of a league: identities, dimensions, the fact of games and coaching tenures.

Each function puts operators together and returns the rows to merge: those that are new or
have changed. Dimensions and identities are small and meet the games in joins that Spark
broadcasts by their size, but for the ids of games, which are as many as the games.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.expressions import kickoff, part_of_day
from lakeward.operators import dimensions, identity, islands, merge

TENURE_KEYS = ["coach_id", "team_id", "role_id", "first_season", "is_interim"]
TENURE_VALUES = ["start_date", "start_source", "end_date", "end_source", "last_season"]
TEAM_VALUES = ["team_abbr", "team_name", "team_nick", "team_conf", "team_division"]
PLACE_VALUES = ["stadium_code", "stadium_name", "roof", "surface", "first_season", "last_season"]
#: Columns of a game that the fact takes over, some under another name.
GAME_PLAIN = (
    "season", "game_type", "week", "gameday", "weekday", "gametime", "away_score", "home_score", "result", "total", "overtime", "location", "div_game",
    "nfl_detail_id", "away_rest", "home_rest", "away_moneyline", "home_moneyline", "spread_line", "away_spread_odds", "home_spread_odds",
    "total_line", "over_odds", "under_odds", "roof", "temp", "wind",
)
GAME_RENAMED = {"gsis": "gsis_id", "pfr": "pfr_id", "pff": "pff_id", "ftn": "ftn_id"}


def of_domain(mappings: DataFrame, domain: str) -> DataFrame:
    """The mappings of one kind of names."""
    return mappings.where(F.col("domain") == domain).drop("domain")


def coach_identities(schedules: DataFrame, staff: DataFrame, mappings: DataFrame, existing: DataFrame, high_water: identity.Mark) -> DataFrame:
    names = identity.spellings_of([(staff, "coach", None), (schedules, "home_coach", None), (schedules, "away_coach", None)])
    return identity.identity_rows(names, of_domain(mappings, "coach"), existing, high_water)


def referee_identities(schedules: DataFrame, officials: DataFrame, mappings: DataFrame, existing: DataFrame, high_water: identity.Mark) -> DataFrame:
    names = identity.spellings_of([(schedules, "referee", None), (officials, "official_name", "position = 'Referee'")])
    return identity.identity_rows(names, of_domain(mappings, "referee"), existing, high_water)


def place_identities(schedules: DataFrame, existing: DataFrame, high_water: identity.Mark) -> DataFrame:
    """Each code is its own name and keeps its id for good."""
    codes = schedules.select(F.col("stadium_id").alias("alias")).where("alias is not null").distinct()
    pairs = codes.select("alias", F.col("alias").alias("name"))
    rows = identity.alias_identities(pairs, existing, high_water)
    return rows.join(existing.select("alias", "id", "name", "source"), ["alias", "id", "name", "source"], "left_anti")


def team_identities(schedules: DataFrame, teams: DataFrame, mappings: DataFrame) -> DataFrame:
    """(alias, id, name, source): codes of the latest season after mapping, and the spellings that
    map to one of them; a mapping to a code that is no longer in use is dropped. Ids
    are the source's own numbers."""
    own = of_domain(mappings, "team_abbr").select("source_value", "canonical_value")
    current = identity.current_set(schedules, "season", "home_team", own)
    spelled = current.select(F.col("name").alias("alias"), "name", F.lit("canonical").alias("source")).unionByName(
        own.join(current, F.col("canonical_value") == F.col("name"), "left_semi").select(
            F.col("source_value").alias("alias"), F.col("canonical_value").alias("name"), F.lit("reference_mappings").alias("source")
        )
    )
    ids = teams.select(F.col("team_abbr").alias("name"), F.col("team_id").cast("int").alias("id"))
    return spelled.join(ids, "name").select("alias", "id", "name", "source")


def teams(team_ids: DataFrame, attributes: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    own = team_ids.where("source = 'canonical'").select(F.col("id").alias("team_id"), F.col("name").alias("team_abbr"))
    rows = own.join(attributes.drop("team_id"), "team_abbr").select("team_id", *TEAM_VALUES)
    return merge.changed_only(rows, existing, ["team_id"], TEAM_VALUES, now)


def _place_rows(schedules: DataFrame, place_ids: DataFrame, mappings: DataFrame) -> DataFrame:
    named = dimensions.bounded_mapping(schedules.where("stadium_id is not null"), "stadium", "season", of_domain(mappings, "stadium"))
    ids = place_ids.select(F.col("alias").alias("stadium_code"), F.col("id").alias("place"))
    return named.withColumnRenamed("stadium_id", "stadium_code").join(ids, "stadium_code").select(
        "place", "stadium_code", "season", F.col("stadium").alias("stadium_name"), F.nullif("roof", F.lit("")).alias("roof"), F.nullif(F.trim("surface"), F.lit("")).alias("surface")
    )


def places(schedules: DataFrame, place_ids: DataFrame, mappings: DataFrame) -> DataFrame:
    """One row a stadium that has a name: its seasons, its latest name and surface by majority,
    its roof by the rule that one that was ever open or closed can move."""
    games = _place_rows(schedules, place_ids, mappings)
    spans = games.groupBy("place").agg(F.min("stadium_code").alias("stadium_code"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    out = spans.join(dimensions.majority_latest(games, "place", "season", "stadium_name"), "place")
    out = out.join(dimensions.roof_rule(games, "place", "roof", ["open", "closed"], "retractable"), "place", "left")
    out = out.join(dimensions.majority_latest(games, "place", "season", "surface"), "place", "left")
    return out.select(F.col("place").alias("stadium_id"), *PLACE_VALUES)


def stadiums(schedules: DataFrame, place_ids: DataFrame, mappings: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    return merge.changed_only(places(schedules, place_ids, mappings), existing, ["stadium_id"], PLACE_VALUES, now)


def resolved(fact: DataFrame, ids: DataFrame, column: str, out: str, needed: bool = False) -> DataFrame:
    """`out` is the id of the name in `column`; without one the row stays, unless it is needed."""
    own = ids.select(F.col("alias").alias(f"__{out}"), F.col("id").alias(out))
    return fact.join(own, F.col(column) == F.col(f"__{out}"), "inner" if needed else "left").drop(f"__{out}")


def games(schedules: DataFrame, game_ids: DataFrame, team_ids: DataFrame, coach_ids: DataFrame, referee_ids: DataFrame, place_ids: DataFrame) -> DataFrame:
    """The fact: a game with an identity and two known teams, its people and place where they
    are known, and the labels that follow from its result and kickoff."""
    have = set(schedules.columns)
    rows = schedules.withColumnRenamed("game_id", "game_code").withColumnRenamed("stadium_id", "place_code")
    rows = resolved(rows, game_ids.where("source = 'canonical'").hint("merge"), "game_code", "game_id", needed=True)
    for side in ("away", "home"):
        rows = resolved(rows, team_ids, f"{side}_team", f"{side}_team_id", needed=True)
        rows = resolved(rows, coach_ids, f"{side}_coach", f"{side}_coach_id")
    rows = resolved(resolved(rows, referee_ids, "referee", "referee_id"), place_ids, "place_code", "stadium_id")
    won, lost = dimensions.sides(F.col("result"), F.col("home_team_id"), F.col("away_team_id"))
    won_at, lost_at = dimensions.sides(F.col("result"), F.lit("home"), F.lit("away"))
    more = {"espn_id": F.col("espn").cast("int")} if "espn" in have else {}
    if "surface" in have:
        more["surface"] = F.nullif(F.trim("surface"), F.lit(""))
    if "gametime" in have:
        more["time_of_day"] = part_of_day(F.when(F.col("gametime").isNotNull(), kickoff(F.col("gameday"), F.col("gametime"))))
    return rows.select(
        "game_id", *(c for c in GAME_PLAIN if c in have), *(F.col(c).alias(n) for c, n in GAME_RENAMED.items() if c in have), *(e.alias(n) for n, e in more.items()),
        "away_team_id", "home_team_id", won.alias("winning_team_id"), won_at.alias("winning_team_location"), lost.alias("losing_team_id"), lost_at.alias("losing_team_location"),
        "away_coach_id", "home_coach_id", "referee_id", "stadium_id",
    )


def schedules(candidates: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    """New and changed games, all columns but the id compared."""
    return merge.changed_only(candidates, existing, ["game_id"], [c for c in candidates.columns if c != "game_id"], now)


def team_games(fact: DataFrame, team_ids: DataFrame) -> DataFrame:
    """(season, team_id, day, coach, played), one row a side of a game, by a single scan."""
    side = lambda s: {"season": "season", "team": f"{s}_team", "coach": f"{s}_coach", "day": "gameday", "played": "played"}
    rows = dimensions.unpivot(fact.withColumn("played", F.col("home_score").isNotNull()), [side("home"), side("away")])
    return resolved(rows, team_ids, "team", "team_id", needed=True).drop("team")


def tenures(schedules: DataFrame, staff: DataFrame, team_ids: DataFrame, coach_ids: DataFrame, mappings: DataFrame, roles: DataFrame, lead: str = "head_coach") -> DataFrame:
    """Tenures of head coaches, whom the games name, together with those of the other
    roles, which only the staff lists name."""
    sides = team_games(schedules, team_ids)
    names = of_domain(mappings, "coach_role").select(F.col("source_value").alias("role"), F.col("canonical_value").alias("role_name"))
    role_ids = names.join(roles.select("role_id", F.col("role").alias("role_name")), "role_name").select("role", "role_id")
    listed = resolved(resolved(staff, coach_ids, "coach", "coach_id", True), team_ids, "team", "team_id", True).join(role_ids, "role")
    listed = listed.select("season", "team_id", "coach_id", "role", "role_id", "is_interim", "start_date", "end_date")
    calendar = islands.period_starts(sides, "team_id", "season", "day")
    part = ["season", "team_id"]
    led = resolved(sides.where("played"), coach_ids, "coach", "coach_id", True)
    runs = islands.stints(led, part, ["day"], "coach_id", "day")
    leads = islands.dated_stints(runs, calendar, listed.where(F.col("role") == lead).drop("role", "role_id"), part, "coach_id", recorded_source="coaching_staff", log_source="schedules")
    leads = leads.join(role_ids.where(F.col("role") == lead).select("role_id"))  # one row
    others = islands.recorded_rows(listed.where(F.col("role") != lead).drop("role"), calendar, part, "coach_id", "role_id", recorded_source="coaching_staff", log_source="schedules")
    every = leads.unionByName(others.select(*leads.columns))
    seen = [df.agg(F.max("season")).first()[0] for df in (staff, sides.where("played"))]
    latest = max((y for y in seen if y is not None), default=0)
    out = islands.collapse(every, ["coach_id", "team_id", "role_id", "is_interim"], "season", latest)
    return out.withColumnRenamed("first_period", "first_season").withColumnRenamed("last_period", "last_season")


def coaching_tenures(candidates: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    return merge.changed_only(candidates, existing, TENURE_KEYS, TENURE_VALUES, now)

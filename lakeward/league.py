"""Queries over a league made of the driver's tables: an order is a game of its customer's
nation, at home, against another nation. Each has its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.catalog import Tables, query
from lakeward.functions import staff_text
from lakeward.operators import identity, serving
from lakeward.plans import league_project, marts
from lakeward.plans.build import Project
from lakeward.sources.scratch import scratch, staged

NOW = dt.datetime(2024, 6, 1, 12)
NOW_SQL = "TIMESTAMP '2024-06-01 12:00:00'"

GAME = (
    "concat('G', o_orderkey) AS game_id", "CAST(year(o_orderdate) AS SMALLINT) AS season", "CASE WHEN o_orderkey % 16 = 0 THEN 'WC' ELSE 'REG' END AS game_type",
    "CAST(month(o_orderdate) AS SMALLINT) AS week", "CAST(o_orderdate AS DATE) AS gameday", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat(10 + o_orderkey % 12, ':00') END AS gametime",
    "concat('T', c_nationkey) AS home_team", "concat('T', (c_nationkey + 1 + o_orderkey % 24) % 25) AS away_team",
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 31 AS SMALLINT) END AS home_score", "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 31 AS SMALLINT) END AS away_score",
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 31 - o_custkey % 31 AS SMALLINT) END AS result",
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 31 + o_custkey % 31 AS SMALLINT) END AS total",
    "concat('Coach ', CASE WHEN c_nationkey = 24 THEN 3 ELSE c_nationkey END, '-', CAST(floor(year(o_orderdate) / 3) AS INTEGER)) AS home_coach",
    "concat('Coach ', CASE WHEN (c_nationkey + 1 + o_orderkey % 24) % 25 = 24 THEN 3 ELSE (c_nationkey + 1 + o_orderkey % 24) % 25 END, '-', CAST(floor(year(o_orderdate) / 3) AS INTEGER)) AS away_coach",
    "CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('Ref ', o_custkey % 40) END AS referee", "concat('P', c_nationkey % 20) AS stadium_id",
    "concat('Place ', c_nationkey % 20, CASE WHEN o_orderkey % 11 = 0 THEN ' Old' ELSE '' END) AS stadium",
    "CASE WHEN c_nationkey % 4 = 0 THEN 'dome' WHEN c_nationkey % 4 = 1 AND o_custkey % 5 = 0 THEN 'open' WHEN o_custkey % 7 = 0 THEN '' ELSE 'outdoors' END AS roof",
    "CASE WHEN o_custkey % 3 = 0 THEN ' grass ' WHEN o_custkey % 3 = 1 THEN 'turf' ELSE ' ' END AS surface",
    "CAST(o_totalprice / 10000 AS DOUBLE) AS spread_line", "CAST(o_totalprice / 5000 AS DOUBLE) AS total_line", "o_orderkey % 2 = 0 AS div_game", "o_orderkey % 13 = 0 AS overtime", "concat('', o_orderkey) AS espn",
)
STAFF = (
    "season", "team", "role", "coach", "is_interim",
    "CASE WHEN season % 5 = 0 AND NOT is_interim THEN CAST(concat(season, '-09-01') AS DATE) WHEN is_interim AND k % 2 = 0 THEN CAST(concat(season, '-10-15') AS DATE) END AS start_date",
    "CASE WHEN season % 4 = 0 AND NOT is_interim THEN CAST(concat(season, '-11-30') AS DATE) END AS end_date",
)
STAFF_ROWS = (
    "season", "concat('T', k) AS team", "k", "CASE r WHEN 0 THEN 'head_coach' WHEN 1 THEN 'offensive_coordinator' ELSE 'defensive_coordinator' END AS role",
    "CASE r WHEN 0 THEN concat('Coach ', k, '-', CAST(floor(season / 3) AS INTEGER)) WHEN 1 THEN concat('OC ', k % 9, CASE WHEN (season + k) % 6 = 0 THEN ' Sub' ELSE '' END) ELSE concat('DC ', k % 11) END AS coach",
    "(season + k) % 6 = 0 AND r <> 2 AS is_interim",
)
MAPPINGS = [
    ("team_abbr", "T24", "T3", None, None), ("team_abbr", "T99", "T5", None, None), ("team_abbr", "T98", "T97", None, None), ("coach", "Coach 1-666", "Coach 2-666", None, None),
    ("referee", "Ref 7", "Ref 8", None, None), ("stadium", "Place 4 Old", "Place Four", 1996, 1998), ("stadium", "Place 5 Old", "Place Five", None, 2000),
    ("coach_role", "head_coach", "Head Coach", None, None), ("coach_role", "offensive_coordinator", "Offensive Coordinator", None, None), ("coach_role", "defensive_coordinator", "Defensive Coordinator", None, None),
]
ROLES = [(1, "Head Coach"), (2, "Offensive Coordinator"), (3, "Defensive Coordinator")]
LITERAL = {None: "NULL"}


def _values(rows: list[tuple], names: str) -> str:
    told = ", ".join("(" + ", ".join(LITERAL.get(v, repr(v)) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {told}) AS v({names}))"


GAMES_SQL = f"(SELECT {', '.join(GAME)} FROM orders JOIN customer ON c_custkey = o_custkey)"
STAFF_SQL = f"""(SELECT {', '.join(STAFF)} FROM (SELECT {', '.join(STAFF_ROWS)} FROM (SELECT DISTINCT CAST(year(o_orderdate) AS SMALLINT) AS season, c_nationkey AS k FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey <> 24), (SELECT unnest([0, 1, 2]) AS r)))"""
TEAMS_SQL = """(SELECT concat('T', n_nationkey) AS team_abbr, concat('', n_nationkey) AS team_id, n_name AS team_name, lower(n_name) AS team_nick, concat('C', n_regionkey) AS team_conf, concat('D', n_regionkey) AS team_division FROM nation)"""
MAPPINGS_SQL = _values(MAPPINGS, "domain, source_value, canonical_value, valid_from, valid_to")


class League:
    """The frames that the marts take."""

    def __init__(self, t: Tables, written: bool = False):
        """`written`: the games are written first, for those who read them many times."""
        self.t, spark = t, t.spark
        games = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).selectExpr(*GAME)
        self.schedules = staged(games) if written else games
        years = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).where("c_nationkey <> 24").selectExpr("CAST(year(o_orderdate) AS SMALLINT) AS season", "c_nationkey AS k").distinct()
        self.staff = years.withColumn("r", F.explode(F.array(*map(F.lit, (0, 1, 2))))).selectExpr(*STAFF_ROWS).selectExpr(*STAFF)
        self.teams = t.nation.selectExpr(
            "concat('T', n_nationkey) AS team_abbr", "concat('', n_nationkey) AS team_id", "n_name AS team_name", "lower(n_name) AS team_nick",
            "concat('C', n_regionkey) AS team_conf", "concat('D', n_regionkey) AS team_division",
        )
        self.mappings = spark.createDataFrame(MAPPINGS, "domain string, source_value string, canonical_value string, valid_from int, valid_to int")
        self.roles = spark.createDataFrame(ROLES, "role_id smallint, role string")
        self.officials = t.supplier.selectExpr("concat('Ref ', s_suppkey % 45) AS official_name", "CASE WHEN s_suppkey % 2 = 0 THEN 'Referee' ELSE 'Umpire' END AS position")
        self.none = spark.createDataFrame([], identity.IDENTITY)

    def sources(self) -> dict[str, DataFrame]:
        """What a project of the league builds on."""
        return {"schedules_source": self.schedules, "staff": self.staff, "teams_source": self.teams, "officials": self.officials, "mappings": self.mappings, "roles": self.roles}

    def team_ids(self) -> DataFrame:
        return marts.team_identities(self.schedules, self.teams, self.mappings)

    def coach_ids(self) -> DataFrame:
        return marts.coach_identities(self.schedules, self.staff, self.mappings, self.none, 0)

    def referee_ids(self) -> DataFrame:
        return marts.referee_identities(self.schedules, self.officials, self.mappings, self.none, 0)

    def place_ids(self) -> DataFrame:
        return marts.place_identities(self.schedules, self.none, 0)

    def game_ids(self) -> DataFrame:
        pairs = identity.alias_pairs(self.schedules.select("game_id", F.col("espn").alias("old")), "game_id", "old")
        return identity.alias_identities(pairs, self.none, 0)


# -- identities

TEAM_IDS_SQL = f"""(WITH m AS (SELECT * FROM {MAPPINGS_SQL} WHERE domain = 'team_abbr'), latest AS (SELECT home_team FROM {GAMES_SQL} QUALIFY season = max(season) OVER ()),
  names AS (SELECT DISTINCT ifnull(canonical_value, home_team) AS name FROM latest LEFT JOIN m ON home_team = source_value),
  spelled AS (SELECT name, unnest(list_append(list(source_value) FILTER (source_value IS NOT NULL), name)) AS alias FROM names LEFT JOIN m ON canonical_value = name GROUP BY name)
  SELECT alias, CAST(team_id AS INTEGER) AS id, name, if(alias = name, 'canonical', 'reference_mappings') AS source FROM spelled JOIN {TEAMS_SQL} ON team_abbr = name)"""


@query("team_identities", TEAM_IDS_SQL)
def team_identities(t: Tables) -> DataFrame:
    return League(t).team_ids()


def _minted(names: str, domain: str) -> str:
    return f"""(WITH m AS (SELECT * FROM {MAPPINGS_SQL} WHERE domain = '{domain}'), n AS (SELECT alias FROM ({names}) WHERE alias IS NOT NULL UNION SELECT source_value FROM m),
      r AS (SELECT alias, coalesce(canonical_value, alias) AS name, CASE WHEN source_value IS NULL THEN 'canonical' ELSE 'reference_mappings' END AS source FROM n LEFT JOIN m ON source_value = alias),
      i AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id FROM (SELECT DISTINCT name FROM r)) SELECT alias, id, name, source FROM r JOIN i USING (name))"""


COACH_IDS_SQL = _minted(f"SELECT coach AS alias FROM {STAFF_SQL} UNION SELECT home_coach FROM {GAMES_SQL} UNION SELECT away_coach FROM {GAMES_SQL}", "coach")
REFEREE_IDS_SQL = _minted(f"SELECT referee AS alias FROM {GAMES_SQL} UNION SELECT concat('Ref ', s_suppkey % 45) FROM supplier WHERE s_suppkey % 2 = 0", "referee")
PLACE_IDS_SQL = f"(SELECT alias, CAST(row_number() OVER (ORDER BY alias) AS INTEGER) AS id, alias AS name, 'canonical' AS source FROM (SELECT DISTINCT stadium_id AS alias FROM {GAMES_SQL}))"


@query("coach_identities", COACH_IDS_SQL)
def coach_identities(t: Tables) -> DataFrame:
    return League(t).coach_ids()


@query("referee_identities", REFEREE_IDS_SQL)
def referee_identities(t: Tables) -> DataFrame:
    return League(t).referee_ids()


@query("place_identities", f"SELECT alias, CASE WHEN alias = 'P3' THEN 70 ELSE CAST(100 + row_number() OVER (PARTITION BY alias = 'P3' ORDER BY alias) AS INTEGER) END AS id, name, source FROM {PLACE_IDS_SQL} WHERE alias <> 'P5'")
def place_identities(t: Tables) -> DataFrame:
    """A second run: one code has its id already, another had one in another form."""
    league = League(t)
    held = t.spark.createDataFrame([("P3", 70, "P3", "alias"), ("P5", 71, "P5", "canonical")], identity.IDENTITY)
    return marts.place_identities(league.schedules, held, 100)


# -- dimensions

NAMED_SQL = f"""(SELECT i.id, g.stadium_id AS code, g.season, coalesce(m.canonical_value, g.stadium) AS name, nullif(g.roof, '') AS roof, nullif(trim(g.surface), '') AS surface
  FROM {GAMES_SQL} g JOIN {PLACE_IDS_SQL} i ON i.alias = g.stadium_id LEFT JOIN (SELECT * FROM {MAPPINGS_SQL} WHERE domain = 'stadium') m
  ON m.source_value = g.stadium AND g.season BETWEEN coalesce(m.valid_from, 0) AND coalesce(m.valid_to, 9999))"""


def _majority(column: str) -> str:
    return f"""(SELECT id, {column} FROM (SELECT id, {column}, row_number() OVER (PARTITION BY id ORDER BY season DESC, count(*) DESC, {column}) AS r FROM n WHERE {column} IS NOT NULL GROUP BY id, season, {column}) WHERE r = 1)"""


PLACES_SQL = f"""(WITH n AS (SELECT * FROM {NAMED_SQL})
  SELECT s.id AS stadium_id, code AS stadium_code, name AS stadium_name, roof, surface, first_season, last_season
  FROM (SELECT id, min(code) AS code, min(season) AS first_season, max(season) AS last_season FROM n GROUP BY id) s JOIN {_majority('name')} USING (id) LEFT JOIN {_majority('surface')} USING (id)
  LEFT JOIN (SELECT id, CASE WHEN bool_or(moves) THEN 'retractable' ELSE first(roof ORDER BY c DESC, roof) END AS roof
    FROM (SELECT id, roof, count(*) AS c, roof IN ('open', 'closed') AS moves FROM n WHERE roof IS NOT NULL GROUP BY id, roof) GROUP BY id) q USING (id))"""


@query("place_dimension", PLACES_SQL)
def place_dimension(t: Tables) -> DataFrame:
    league = League(t)
    return marts.places(league.schedules, league.place_ids(), league.mappings)


@query(
    "team_dimension",
    f"""SELECT i.id AS team_id, team_abbr, team_name, team_nick, team_conf, team_division, CASE WHEN i.id % 3 = 0 THEN TIMESTAMP '2020-01-01 00:00:00' ELSE {NOW_SQL} END AS created_at, {NOW_SQL} AS updated_at
    FROM {TEAM_IDS_SQL} i JOIN {TEAMS_SQL} ON team_abbr = name WHERE source = 'canonical' AND i.id % 3 <> 1""",
)
def team_dimension(t: Tables) -> DataFrame:
    """A third of the teams is as it was, a third has another name, a third is new."""
    league = League(t)
    old = league.teams.selectExpr("CAST(team_id AS INT) AS team_id", "team_abbr", "CASE WHEN team_id % 3 = 0 THEN 'Old' ELSE team_name END AS team_name", "team_nick", "team_conf", "team_division")
    existing = old.where("team_id % 3 <> 2").withColumns({"created_at": F.lit(dt.datetime(2020, 1, 1)), "updated_at": F.lit(dt.datetime(2020, 1, 1))})
    return marts.teams(league.team_ids(), league.teams, existing, F.lit(NOW))


# -- the fact

GAME_IDS_SQL = f"""(WITH d AS (SELECT game_id AS alias, game_id AS name FROM {GAMES_SQL} UNION ALL SELECT espn, game_id FROM {GAMES_SQL}), i AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id FROM (SELECT DISTINCT name FROM d))
  SELECT alias, id, name, CASE WHEN alias = name THEN 'canonical' ELSE 'alias' END AS source FROM d JOIN i USING (name))"""
PARTS_SQL = "(SELECT * FROM (VALUES ('morning', 0, 11), ('noon', 12, 13), ('afternoon', 14, 16), ('night', 17, 23)) AS p(part, low, high))"
FACT_SQL = f"""(SELECT gi.id AS game_id, g.* EXCLUDE (game_id, home_team, away_team, home_coach, away_coach, referee, stadium_id, stadium, surface, espn), g.espn::INTEGER AS espn_id, nullif(trim(g.surface), '') AS surface,
  part AS time_of_day, away.id AS away_team_id, home.id AS home_team_id, [away.id, NULL, home.id][sign(result) + 2] AS winning_team_id, ['away', NULL, 'home'][sign(result) + 2] AS winning_team_location,
  [home.id, NULL, away.id][sign(result) + 2] AS losing_team_id, ['home', NULL, 'away'][sign(result) + 2] AS losing_team_location, ac.id AS away_coach_id, hc.id AS home_coach_id, r.id AS referee_id, p.id AS stadium_id
  FROM {GAMES_SQL} g JOIN {GAME_IDS_SQL} gi ON gi.alias = g.game_id AND gi.source = 'canonical' JOIN {TEAM_IDS_SQL} home ON home.alias = g.home_team JOIN {TEAM_IDS_SQL} away ON away.alias = g.away_team
  LEFT JOIN {PARTS_SQL} ON g.gametime[:2]::INTEGER - 1 BETWEEN low AND high LEFT JOIN {COACH_IDS_SQL} hc ON hc.alias = g.home_coach LEFT JOIN {COACH_IDS_SQL} ac ON ac.alias = g.away_coach
  LEFT JOIN {REFEREE_IDS_SQL} r ON r.alias = g.referee LEFT JOIN {PLACE_IDS_SQL} p ON p.alias = g.stadium_id)"""


def _fact(t: Tables) -> DataFrame:
    league = League(t, written=True)
    return marts.games(league.schedules, league.game_ids(), league.team_ids(), league.coach_ids(), league.referee_ids(), league.place_ids())


@query("schedules_fact", FACT_SQL)
def schedules_fact(t: Tables) -> DataFrame:
    return _fact(t)


@query(
    "schedules_changed",
    f"""SELECT *, CASE WHEN game_id % 5 = 0 THEN {NOW_SQL} ELSE TIMESTAMP '2021-01-01 00:00:00' END AS created_at, {NOW_SQL} AS updated_at FROM {FACT_SQL}
    WHERE game_id % 5 = 0 OR (game_id % 7 = 0 AND referee_id IS NOT NULL) OR game_id % 11 = 0""",
)
def schedules_changed(t: Tables) -> DataFrame:
    """A second run: a fifth of the games is new, some lack their referee, some have another total."""
    fact = staged(_fact(t))  # it is both the new rows and what the old ones are made of
    old = fact.where("game_id % 5 <> 0").withColumns(
        {
            "referee_id": F.when(F.col("game_id") % 7 != 0, F.col("referee_id")),
            "total": F.when(F.col("game_id") % 11 == 0, F.coalesce(F.col("total"), F.lit(0)) + 1).otherwise(F.col("total")).cast("smallint"),
            "created_at": F.lit(dt.datetime(2021, 1, 1)),
            "updated_at": F.lit(dt.datetime(2021, 1, 1)),
        }
    )
    return marts.schedules(fact, old, F.lit(NOW))


# -- tenures

SIDES_SQL = f"""(SELECT season, i.id AS team_id, coach, gameday AS day, played FROM (SELECT season, home_team AS team, home_coach AS coach, gameday, home_score IS NOT NULL AS played FROM {GAMES_SQL}
  UNION ALL SELECT season, away_team, away_coach, gameday, home_score IS NOT NULL FROM {GAMES_SQL}) JOIN {TEAM_IDS_SQL} i ON i.alias = team)"""
#: In this league a coach leads a team for whole seasons, and a person has one row a season and
#: role, so tenures can be told without counting runs: each begins with a row that no open row of the
#: year before precedes, and lasts until the next that does.
TENURES_SQL = f"""(WITH sides AS MATERIALIZED (SELECT * FROM {SIDES_SQL}), people AS MATERIALIZED (SELECT * FROM {COACH_IDS_SQL}), clubs AS MATERIALIZED (SELECT * FROM {TEAM_IDS_SQL}),
  jobs AS (SELECT source_value AS role, role_id::SMALLINT AS role_id FROM {MAPPINGS_SQL} JOIN {_values(ROLES, 'role_id, title')} ON title = canonical_value WHERE domain = 'coach_role'),
  years AS (SELECT team_id, season, min(day) AS first_game, max(day) AS last_game FROM sides GROUP BY ALL),
  span AS (SELECT y.team_id, y.season, ifnull((SELECT max(z.last_game) + 1 FROM years z WHERE z.team_id = y.team_id AND z.season < y.season), first_game)::DATE AS opens, last_game AS closes FROM years y),
  lists AS MATERIALIZED (SELECT l.season, c.id AS team_id, p.id AS coach_id, l.role, role_id, is_interim, start_date AS began, end_date AS ended FROM {STAFF_SQL} l JOIN people p ON p.alias = l.coach JOIN clubs c ON c.alias = l.team JOIN jobs USING (role)),
  led AS (SELECT DISTINCT season, team_id, p.id AS coach_id FROM sides JOIN people p ON p.alias = coach WHERE played),
  vague AS (SELECT DISTINCT season, team_id, role_id FROM lists WHERE is_interim AND began IS NULL),
  facts AS (
    SELECT season, team_id, coach_id, 1::SMALLINT AS role_id, ifnull(is_interim, false) AS is_interim, began, ended, false AS no_start, false AS no_end FROM led LEFT JOIN (SELECT * FROM lists WHERE role = 'head_coach') USING (season, team_id, coach_id)
    UNION ALL SELECT l.season, l.team_id, coach_id, l.role_id, is_interim, began, ended, is_interim AND began IS NULL, NOT is_interim AND ended IS NULL AND v.role_id IS NOT NULL FROM lists l LEFT JOIN vague v USING (season, team_id, role_id) WHERE role <> 'head_coach'),
  dated AS (SELECT f.*, f.began IS NOT NULL OR no_start AS opened, f.ended IS NOT NULL OR no_end AS shut, if(no_start, NULL, ifnull(began, opens)) AS day_in, if(no_end, NULL, ifnull(f.ended, closes)) AS day_out,
    if(no_start, NULL, if(began IS NULL, 'schedules', 'coaching_staff')) AS src_in, if(no_end, NULL, if(f.ended IS NULL, 'schedules', 'coaching_staff')) AS src_out FROM facts f JOIN span USING (season, team_id)),
  begun AS (SELECT d.*, opened OR NOT EXISTS (SELECT 1 FROM dated b WHERE (b.coach_id, b.team_id, b.role_id, b.is_interim, b.season) = (d.coach_id, d.team_id, d.role_id, d.is_interim, d.season - 1) AND NOT b.shut) AS fresh FROM dated d),
  told AS (SELECT *, max(if(fresh, season, NULL)) OVER (PARTITION BY coach_id, team_id, role_id, is_interim ORDER BY season) AS first_season FROM begun),
  ends AS (SELECT coach_id, team_id, role_id, is_interim, first_season, max(season) AS last_season FROM told GROUP BY ALL),
  now AS (SELECT max(season) AS season FROM (SELECT season FROM {STAFF_SQL} UNION ALL SELECT season FROM sides WHERE played))
  SELECT e.*, a.day_in AS start_date, a.src_in AS start_source, if(last_season = now.season AND NOT z.shut, NULL, z.day_out) AS end_date, if(last_season = now.season AND NOT z.shut, 'ongoing', z.src_out) AS end_source FROM ends e, now
  JOIN told a ON (a.coach_id, a.team_id, a.role_id, a.is_interim, a.season) = (e.coach_id, e.team_id, e.role_id, e.is_interim, e.first_season)
  JOIN told z ON (z.coach_id, z.team_id, z.role_id, z.is_interim, z.season) = (e.coach_id, e.team_id, e.role_id, e.is_interim, e.last_season))"""


def _tenures(t: Tables) -> DataFrame:
    league = League(t)
    return marts.tenures(league.schedules, league.staff, league.team_ids(), league.coach_ids(), league.mappings, league.roles)


@query("coaching_tenures", TENURES_SQL)
def coaching_tenures(t: Tables) -> DataFrame:
    return _tenures(t)


@query(
    "coaching_tenures_changed",
    f"""SELECT *, CASE WHEN coach_id % 5 = 0 THEN {NOW_SQL} ELSE TIMESTAMP '2021-01-01 00:00:00' END AS created_at, {NOW_SQL} AS updated_at FROM {TENURES_SQL}
    WHERE coach_id % 5 = 0 OR (coach_id % 7 = 0 AND end_date IS NOT NULL)""",
)
def coaching_tenures_changed(t: Tables) -> DataFrame:
    """A second run: tenures of a fifth of the coaches are new, some had no end."""
    rows = _tenures(t)
    old = rows.where("coach_id % 5 <> 0").withColumns(
        {"end_date": F.when(F.col("coach_id") % 7 != 0, F.col("end_date")), "created_at": F.lit(dt.datetime(2021, 1, 1)), "updated_at": F.lit(dt.datetime(2021, 1, 1))}
    )
    return marts.coaching_tenures(rows, old, F.lit(NOW))


# -- pages of games

GAMES = serving.Surface(
    equal={c: c for c in ("season", "week", "game_type", "home_team_id", "away_team_id", "referee_id", "stadium_id", "roof", "surface", "div_game", "overtime")},
    least={"season_from": "season", "gameday_from": "gameday", "spread_min": "spread_line", "total_line_min": "total_line"},
    most={"season_to": "season", "gameday_to": "gameday", "spread_max": "spread_line", "total_line_max": "total_line"},
    either={"team_id": ("home_team_id", "away_team_id"), "coach_id": ("home_coach_id", "away_coach_id")}, known={"played": "result"},
    sorts={c: c for c in ("gameday", "season", "week", "game_id", "spread_line", "total_line", "result", "total")}, key="game_id",
    choices={"game_type": ("REG", "WC", "DIV", "CON", "SB"), "roof": ("outdoors", "open", "closed", "dome")},
    kinds={c: int for c in ("season", "season_from", "season_to", "week", "home_team_id", "away_team_id", "referee_id", "stadium_id", "team_id", "coach_id")}
    | {c: bool for c in ("div_game", "overtime", "played")} | {c: (int, float) for c in ("spread_min", "spread_max", "total_line_min", "total_line_max")}
    | {c: dt.date for c in ("gameday_from", "gameday_to")},
)


_projects: dict[tuple[str, str], Project] = {}


def stored(t: Tables) -> Project:
    """The league's marts, built once a session and folder of tables; the pages read what is stored."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _projects:
        made = league_project.project(t.spark, scratch(t.spark), League(t, written=True).sources(), NOW)
        made.build()
        _projects[key] = made
    return _projects[key]


def stored_fact(t: Tables) -> DataFrame:
    return stored(t).frame("schedules").drop("created_at", "updated_at")


def _games_page(name: str, where: str, order: str, q: serving.PageQuery) -> None:
    query(f"games_{name}", f"SELECT * FROM {FACT_SQL} WHERE {where} ORDER BY {order} LIMIT {q.limit} OFFSET {q.offset}")(lambda t: serving.page(stored_fact(t), GAMES, q))
    query(f"games_{name}_total", f"SELECT count(*) AS total FROM {FACT_SQL} WHERE {where}")(lambda t: serving.total(stored_fact(t), GAMES, q))


_games_page(
    "equal", "season = 1997 AND game_type = 'REG' AND home_team_id = 7 AND roof = 'outdoors' AND surface = 'turf' AND div_game = true AND overtime = false AND stadium_id = 18",
    "gameday DESC NULLS LAST, game_id DESC",
    serving.PageQuery({"season": 1997, "game_type": "REG", "home_team_id": 7, "roof": "outdoors", "surface": "turf", "div_game": True, "overtime": False, "stadium_id": 18}, "gameday", True),
)
_games_page("of_referee", "referee_id = 12 AND week = 5", "total NULLS LAST, game_id", serving.PageQuery({"referee_id": 12, "week": 5}, "total"))
_games_page(
    "ranges", "season >= 1996 AND season <= 1999 AND gameday >= DATE '1996-03-01' AND gameday <= DATE '1999-10-31' AND spread_line >= 5.0 AND spread_line <= 25.5 AND total_line >= 12 AND total_line <= 45.0 AND result IS NOT NULL",
    "result DESC NULLS LAST, game_id DESC",
    serving.PageQuery({"season_from": 1996, "season_to": 1999, "gameday_from": dt.date(1996, 3, 1), "gameday_to": dt.date(1999, 10, 31), "spread_min": 5.0, "spread_max": 25.5, "total_line_min": 12, "total_line_max": 45.0, "played": True}, "result", True, 1000),
)
_games_page("of_team_and_coach", "(home_team_id = 3 OR away_team_id = 3) AND (home_coach_id = 30 OR away_coach_id = 30) AND away_team_id = 3", "spread_line NULLS LAST, game_id", serving.PageQuery({"team_id": 3, "coach_id": 30, "away_team_id": 3}, "spread_line", False, 500))


@query("games_by_id", f"SELECT * FROM {FACT_SQL} WHERE game_id IN (SELECT 1 + 40 * range FROM range(25))")
def games_by_id(t: Tables) -> DataFrame:
    """Single games of the stored fact."""
    return serving.of_ids(stored_fact(t), "game_id", [1 + 40 * k for k in range(25)])


@query("stored_tenures", TENURES_SQL)
def stored_tenures(t: Tables) -> DataFrame:
    return stored(t).frame("coaching_tenures").drop("created_at", "updated_at")


@query("stored_stadiums", PLACES_SQL)
def stored_stadiums(t: Tables) -> DataFrame:
    return stored(t).frame("stadiums").drop("created_at", "updated_at")


@query("runs_of_ids", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 25)")
def runs_of_ids(t: Tables) -> DataFrame:
    """The steps of the latest runs, by a list of ids."""
    ids = [r[0] for r in serving.latest_runs(t.orders.select("o_orderkey"), 25, "o_orderkey").collect()]
    return serving.of_ids(t.lineitem, "l_orderkey", ids).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# -- staff pages

PAGE_TEXT = r"""concat('intro {{Other|x}} {{Club final staff
|Coaches=
* [[List of coaches|Head coach]] – [[Al Alpha', n_nationkey, ' (coach, born 1982)|Al  Alpha', n_nationkey, ']]',
  CASE WHEN n_nationkey % 2 = 0 THEN ' ~~(fired November 27)~~' ELSE '' END, '
* Interim head coach/special teams coordinator – Ben Beta', n_nationkey, ', Jr
* Offensive coordinator - Cy', n_nationkey, '<ref name=a>no</ref>',
  CASE WHEN n_nationkey % 3 = 0 THEN '; fired after Week 10' ELSE '' END, '
* Assistant head coach – Di Delta
* Co-defensive coordinator & linebackers: Ed', n_nationkey, '†', CASE WHEN n_nationkey % 5 = 0 THEN ' ~~January 3~~' ELSE '' END,
  '
* Defensive coordinator: Vacant
}} * Head coach – Not Here')"""


@query(
    "staff_pages",
    """WITH p AS (SELECT CAST(2000 + n_nationkey AS INTEGER) AS season, concat('T', n_nationkey) AS team, n_nationkey AS k FROM nation)
    SELECT season, team, 'head_coach' AS role, 'Head coach' AS title, concat('Al Alpha', k) AS person, false AS is_interim, CASE WHEN k % 2 = 0 THEN 'fired November 27' END AS note,
      CAST(NULL AS DATE) AS start_date, CASE WHEN k % 2 = 0 THEN make_date(season, 11, 27) END AS end_date, CASE WHEN k % 2 = 1 THEN 'undated_change' END AS flags FROM p
    UNION ALL SELECT season, team, 'head_coach', 'Interim head coach/special teams coordinator', concat('Ben Beta', k, ' Jr.'), true, NULL, CASE WHEN k % 2 = 0 THEN make_date(season, 11, 27) END, NULL, CASE WHEN k % 2 = 1 THEN 'undated_change' END FROM p
    UNION ALL SELECT season, team, 'offensive_coordinator', 'Offensive coordinator', concat('Cy', k), false, CASE WHEN k % 3 = 0 THEN 'fired after Week 10' END, NULL, CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN make_date(season, 11, 14) END, NULL FROM p
    UNION ALL SELECT season, team, 'defensive_coordinator', 'Co-defensive coordinator & linebackers', concat('Ed', k), false, CASE WHEN k % 5 = 0 THEN 'January 3' END, NULL, CASE WHEN k % 5 = 0 THEN make_date(season + 1, 1, 3) END, CASE WHEN k % 5 = 0 THEN 'date_kind_guessed' END FROM p""",
)
def staff_pages(t: Tables) -> DataFrame:
    """Staff lists written for every nation; week 10 has a game in every other season."""
    pages = t.nation.selectExpr("CAST(2000 + n_nationkey AS INT) AS season", "concat('T', n_nationkey) AS team", f"{PAGE_TEXT} AS text").withColumn("text", F.replace("text", F.lit("~~"), F.lit("''")))
    played = t.nation.where("n_nationkey % 2 = 0").selectExpr("CAST(2000 + n_nationkey AS INT) AS season", "concat('T', n_nationkey) AS team", "10 AS week", "make_date(2000 + n_nationkey, 11, 13) AS day")
    return staff_text.parse_pages(pages, ("Club final staff",), played)


@query(
    "article_titles",
    """SELECT season, team, concat(season, ' ', CASE WHEN team = 'T3' AND season BETWEEN 1995 AND 1996 THEN 'Old Three' WHEN team = 'T4' AND season = 1999 THEN 'Old Four' ELSE n_name END, ' season') AS title
    FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season, concat('T', c_nationkey) AS team, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)""",
)
def article_titles(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    rows = rows.select(F.year("o_orderdate").alias("season"), F.concat(F.lit("T"), "c_nationkey").alias("team"), "n_name").distinct()
    renamed = (("T3", 1995, 1996, "Old Three"), ("T4", 1999, 1999, "Old Four"))
    return rows.select("season", "team", staff_text.article_title(F.col("team"), F.col("n_name"), F.col("season"), renamed).alias("title"))

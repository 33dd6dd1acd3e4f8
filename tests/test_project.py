"""Loading, building, the wiki source, the command line and the service's edges."""

import datetime as dt
import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from lakeward import cli, league
from lakeward.operators import serving, staff
from lakeward.plans import build, runner
from lakeward.sources import pages, registry, snapshot


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_load_refuses_repeated_keys(spark, tmp_path):
    spark.createDataFrame([("A", 1), ("A", 2)], "team_abbr string, N int").write.parquet(f"{tmp_path}/teams.parquet")
    teams, table = registry.league(str(tmp_path))["teams"], snapshot.Table(spark, f"{tmp_path}/t")
    with pytest.raises(registry.NotUnique):
        registry.load(spark, teams, None, table)
    assert not table.exists()
    with pytest.raises(registry.PeriodUnavailable):
        registry.load(spark, registry.league(str(tmp_path))["pbp"], 2020, table)


def test_other_faults_of_a_source_are_no_missing_period(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception) as e:
        registry.mirror(spark, str(tmp_path), "x").collect()
    assert not isinstance(e.value, registry.PeriodUnavailable)


def test_registry_of_the_league():
    sets = registry.league("m")
    assert len(sets) == 12 and sets["participation"].seasons(2010, 2017) == [2016, 2017] and not sets["schedules"].partitioned
    assert [s.season for s in runner.make_plan([sets["officials"], sets["teams"]], 2014, 2016)] == [2015, 2016, None]


def project(spark, root, source, log):
    def totals(orders, held):
        log.append(("totals", held is None))
        return orders.groupBy("k").agg(F.sum("v").alias("v"))

    def ids(totals, held):
        return totals.select("k", (F.col("k") * 10).alias("id")) if held is None else totals.join(held, "k", "left_anti").select("k", (F.col("k") * 10).alias("id"))

    models = [
        build.Model("report", lambda i, t, _: i.join(t, "k"), ("ids", "totals"), "view"),
        build.Model("ids", ids, ("totals",), "merge", ("k",), layer="reference", kept=True),
        build.Model("totals", totals, ("orders",), "merge", ("k",), checks={"positive": lambda df: df.where("v < 0")}),
    ]
    return build.Project(spark, str(root), models, {"orders": source})


def test_project(spark, tmp_path):
    log, one = [], spark.createDataFrame([(1, 5), (1, 6), (2, -7)], "k long, v long")
    p = project(spark, tmp_path, one, log)
    assert p.order().index("totals") < p.order().index("ids") < p.order().index("report")
    assert p.build() == {"totals.positive": 1} and rows(p.frame("report")) == [(1, 10, 11), (2, 20, -7)]
    p = project(spark, tmp_path, spark.createDataFrame([(3, 1)], "k long, v long"), log)
    p.build()
    assert rows(p.frame("ids")) == [(1, 10), (2, 20), (3, 30)] and p.table("ids").path.endswith("/reference/ids")
    p.build(full_refresh=True)
    assert rows(p.frame("totals")) == [(3, 1)] and rows(p.frame("ids")) == [(1, 10), (2, 20), (3, 30)]
    assert log == [("totals", True), ("totals", False), ("totals", True)]


def test_marks_only_rise(spark, tmp_path):
    marks = build.Marks(spark, str(tmp_path / "m"))
    assert marks.get("a") == 0 and marks.raise_to("a", 7) == 7 and marks.raise_to("a", 3) == 7 and marks.get("b") == 0


# -- the wiki


def test_pages_follow_redirects_and_wait():
    asked, slept, now = [], [], [0.0]

    def get(params):
        asked.append(params["titles"].split("|"))
        if len(asked) in (1, 2):
            raise pages.Busy(7.0 if len(asked) == 1 else None)
        there = {"Real": "text", "T1": "one"}
        return {"query": {"normalized": [{"from": "real page", "to": "Real page"}], "redirects": [{"from": "Real page", "to": "Real"}],
                          "pages": [{"title": t, "revisions": [{"slots": {"main": {"content": x}}}]} for t, x in there.items()] + [{"title": "Gone", "missing": True}]}}

    def sleep(s):
        slept.append(s)
        now[0] += s

    source = pages.Wiki(get, sleep, lambda: now[0])
    got = source.texts(["real page", "Gone", *(f"T{k}" for k in range(60)), "Gone"])
    assert got["real page"] == "text" and got["T1"] == "one" and got["Gone"] is None and got["T2"] is None and len(got) == 62
    assert [len(a) for a in asked] == [50, 50, 50, 12] and [s for s in slept if s > 1] == [7.0, pages.FIRST_PAUSE]

    assert pages.last_of("a", {"a": "b", "b": "c", "c": "d", "d": "e", "e": "f"}) == "f" and pages.last_of("a", {"a": "b", "b": "a"}) in ("a", "b")

    def never(params):
        raise pages.Busy()

    slept.clear()
    with pytest.raises(pages.Busy):
        pages.Wiki(never, sleep, lambda: now[0]).texts(["x"])
    assert [s for s in slept if s > 1] == [10, 20, 40, 80, 120]


# -- likely aliases


def test_likely_aliases_lose_no_pair(spark):
    r = random.Random(8)
    parts = ["jo", "hn", "ann", "smi", "th", "er", "berg", "lee", "x", "mar", "ia", "o'", "de ", "van "]
    made = {" ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))).strip() for _ in range(r.randint(1, 2))) for _ in range(150)}
    names = sorted(made | {n[:-1] + "k" for n in made if len(n) > 3} | {"ab", "abc", "aba", "aaaa", "aaaaa", "A. B. Jr.", "a b", "", "Émile Zola", "Emile Zola", "Bo 12", "12", "B. Lee Jr", "Bob Lee", "Li", "Lia", "La", "Lisa"})

    def plain(s):
        return re.sub(r"[^a-z ]", "", re.sub(r"\s+(jr|sr|ii|iii|iv)\.?$", "", s.lower().strip()))

    last = lambda s: (s.lower().split() or [None])[-1]

    want = set()
    for a in names:
        for b in names:
            p, q = plain(a), plain(b)
            ratio = difflib.SequenceMatcher(None, p, q).ratio()
            if a < b and (ratio >= 0.8 or (last(a) and last(a) == last(b) and a[0].lower() == b[0].lower() and ratio >= 0.6)):
                want.add((a, b))
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = staff.likely_aliases(df).collect()
    assert {(x.a, x.b) for x in got if x.a and x.b} == {(a, b) for a, b in want if a and b}
    settled = names[::4]
    left = staff.likely_aliases(df, mapped=spark.createDataFrame([(n,) for n in settled], "source_value string")).collect()
    assert {(x.a, x.b) for x in left} == {(x.a, x.b) for x in got if x.a not in settled and x.b not in settled}
    assert [x.ratio for x in got] == sorted((x.ratio for x in got), reverse=True)


def test_edit_pairs(spark):
    df = spark.createDataFrame([("kitten",), ("sitten",), ("sittin",), ("kiten",), ("",), ("a",), ("kitten",)], "name string")
    assert rows(staff.edit_pairs(df)) == [("", "a", 1), ("kiten", "kitten", 1), ("kitten", "sitten", 1), ("sitten", "sittin", 1)]
    assert ("kitten", "sittin", 2) in rows(staff.edit_pairs(df, most=2))


# -- the service


@pytest.mark.parametrize(
    "filters", [{"game_type": "PRE"}, {"roof": "glass"}, {"season": "1999"}, {"season": True}, {"played": 1}, {"gameday_from": "1999-01-01"}, {"spread_min": "3"}, {"sesaon": 1999}]
)
def test_filters_are_checked(filters):
    with pytest.raises(serving.Invalid) as e:
        serving.predicate(league.GAMES, serving.PageQuery(filters))
    assert serving.status_of(e.value) == 422


def test_service_edges(spark):
    good = {"game_type": "REG", "roof": "dome", "season": 1999, "played": True, "gameday_from": dt.date(1999, 1, 1), "spread_min": 3}
    serving.predicate(league.GAMES, serving.PageQuery(good))
    for q in (serving.PageQuery(limit=0), serving.PageQuery(limit=1001), serving.PageQuery(offset=-1)):
        with pytest.raises(serving.Invalid):
            serving.predicate(league.GAMES, q)
    assert serving.status_of(None) == 404 and serving.status_of(serving.TimedOut()) == 504 and serving.status_of(OSError()) == 503 and serving.status_of(KeyError()) == 500
    assert serving.may_read(None, None) and serving.may_read("k", "k") and not serving.may_read("x", "k") and not serving.may_read(None, "k")
    assert serving.of_ids(spark.range(9), "id", [3, 5]).count() == 2 and serving.of_ids(spark.range(9), "id", []).count() == 0
    assert len(serving.rows_within(spark.range(5), 60)) == 5
    slow = spark.range(0, 400_000_000_000, 1, 4).selectExpr("max(xxhash64(id)) as m")
    with pytest.raises(serving.TimedOut):
        serving.rows_within(slow, 2)


# -- the command line


def app(spark, tmp_path, **more):
    said = []
    return cli.App(spark, cli.Settings(f"{tmp_path}/root", f"{tmp_path}/mirror", 2019), said.append, today=dt.date(2021, 3, 1), **more), said


def test_command_line(spark, tmp_path):
    for y in (2019, 2020):
        spark.createDataFrame([(y, "A"), (y, "B")], "season int, Team string").write.parquet(f"{tmp_path}/mirror/rosters/{y}.parquet")
    spark.createDataFrame([("A", "1")], "team_abbr string, team_id string").write.parquet(f"{tmp_path}/mirror/teams.parquet")
    a, said = app(spark, tmp_path)
    assert a.run(["list"]) == 0 and len(said) == 12
    assert a.run(["current-season"]) == 0 and said[-1] == "2020" and cli.current_season(dt.date(2021, 9, 1)) == 2021
    assert a.run(["load", "rosters", "--season", "2019"]) == 0 and said[-1] == "rosters: 2 rows"
    assert a.run(["backfill", "-d", "rosters", "-d", "teams", "--keep-staging", "--retries", "0"]) == 0
    assert rows(a.tables["rosters"].read().select("season", "team")) == [(2019, "A"), (2019, "B"), (2020, "A"), (2020, "B")]
    assert a.run(["refresh", "-d", "rosters", "-d", "pbp", "--retries", "0"]) == 0 and a.tables["rosters"].read().count() == 0 and a.tables["teams"].read().count() == 1
    log = runner.RunLog(spark, f"{tmp_path}/root/ops")
    assert sorted(r.kind for r in log.runs().collect()) == ["backfill", "refresh"] and {r.status for r in log.steps().collect()} == {"success", "skipped"}
    a.ask = lambda _: "n"
    assert a.run(["staging", "truncate"]) == 1 and a.tables["teams"].read().count() == 1
    assert a.run(["staging", "truncate", "-y", "-d", "teams"]) == 0 and a.tables["teams"].read().count() == 0
    with pytest.raises(SystemExit):
        a.run(["load", "nothing"])


def test_transform_reports_broken_checks(spark, tmp_path):
    source = spark.createDataFrame([(1, -5)], "k long, v long")
    a, said = app(spark, tmp_path, project=project(spark, tmp_path / "p", source, []))
    assert a.run(["transform"]) == 1 and said[-1] == '{"totals.positive": 1}'
    assert cli.Settings.from_env({"LAKEWARD_ROOT": "r", "LAKEWARD_START_SEASON": "2001"}).start_season == 2001

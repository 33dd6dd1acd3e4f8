import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakeward.functions import staff_text as st
from lakeward.plans import runner
from lakeward.sources import registry, snapshot
from lakeward.streaming.incremental import upsert_stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_partitions_are_replaced(spark, tmp_path):
    t = snapshot.Table(spark, str(tmp_path / "t"))
    assert not t.exists() and t.schema() == {}
    t.replace_all(spark.createDataFrame([(2001, 1), (2002, 2)], "season long, v long"))
    t.replace_partition(spark.createDataFrame([(2002, 1.5, "n")], "season long, v double, extra string"), "season", 2002)
    assert rows(t.read().select("season", "v", "extra")) == [(2001, 1.0, None), (2002, 1.5, "n")]
    t.replace_partition(t.read().limit(0), "season", 2001)
    assert [r.season for r in t.read().collect()] == [2002]
    assert t.read(1).count() == 2
    snapshot.truncate_tables({"t": t}, [])
    assert t.read().count() == 1
    snapshot.truncate_tables({"t": t}, None)
    assert t.read().count() == 0 and t.schema()["v"] == "double"


def test_unlike_types_meet_in_text(spark, tmp_path):
    t = snapshot.Table(spark, str(tmp_path / "u"))
    t.replace_all(spark.createDataFrame([(1, 5)], "season long, v long"))
    t.replace_partition(spark.createDataFrame([(2, dt.date(2024, 1, 1))], "season long, v date"), "season", 2)
    assert rows(t.read()) == [(1, "5"), (2, "2024-01-01")]


def test_partitions_keep_their_folders(spark, tmp_path):
    t = snapshot.Table(spark, str(tmp_path / "p"), "season")
    t.replace_all(spark.createDataFrame([(2001, 1), (2002, 2), (None, 3)], "season long, v long"))
    before = t.parts()
    t.replace_partition(spark.createDataFrame([(2002, 5), (2002, 6)], "season long, v long"), "season", 2002)
    after = t.parts()
    assert {k: after[k] == before[k] for k in before} == {"2001": True, "2002": False, snapshot.NULL_VALUE: True}
    assert rows(t.read()) == sorted([(2001, 1), (2002, 5), (2002, 6), (None, 3)], key=repr) and rows(t.read(1))[0] == (2001, 1)
    t.replace_partition(t.read().limit(0), "season", None)
    assert rows(t.read()) == [(2001, 1), (2002, 5), (2002, 6)]
    t.replace_partition(spark.createDataFrame([(2001, 1.5)], "season long, v double"), "season", 2001)
    assert rows(t.read()) == [(2001, 1.5), (2002, 5.0), (2002, 6.0)] and t.version() == 4
    assert t.clean_up(keep=1) == 3 and t.read().count() == 3 and t.version() == 4


def test_two_writers_of_one_version(spark, tmp_path):
    t = snapshot.Table(spark, str(tmp_path / "w"))
    t.replace_all(spark.range(3))
    with pytest.raises(snapshot.Conflict):
        t._commit(1, {}, t.read().schema)
    assert t.read().count() == 3 and t.version() == 1


def test_fetch_and_prepare(spark, tmp_path):
    spark.createDataFrame([(2001, "x"), (2002, "y")], "season long, Name string").write.parquet(str(tmp_path / "d"))
    d = registry.Dataset("d", "d", "parquet", first_season=2001, options={"path": str(tmp_path / "d")})
    now = dt.datetime(2024, 1, 1)
    got = registry.prepare(registry.fetch(spark, d, 2002), d, 2002, now)
    assert [(r.season, r.name) for r in got.collect()] == [(2002, "y")]
    assert d.seasons(1999, 2003) == [2001, 2002, 2003]
    with pytest.raises(ValueError):
        registry.fetch(spark, d)
    gone = registry.Dataset("g", "g", "parquet", options={"path": str(tmp_path / "none")})
    with pytest.raises(registry.PeriodUnavailable):
        registry.fetch(spark, gone, 2001)
    dotted = registry.Dataset("e", "e", "lakeward.sources.registry.empty", partitioned=False, options={"schema": "a int"})
    assert registry.fetch(spark, dotted).columns == ["a"]
    stamped = registry.prepare(spark.createDataFrame([(1,)], "A int"), d, 2005, now)
    assert stamped.columns == ["a", "_loaded_at", "season"] and stamped.first().season == 2005


def test_overrides_file(spark, tmp_path):
    (tmp_path / "o.csv").write_text("team,season\nA,2001\n")
    got = registry.overrides(spark, str(tmp_path / "o.csv"), "season int, team string, note string")
    assert rows(got) == [(2001, "A", None)]
    assert registry.overrides(spark, str(tmp_path / "no.csv"), "season int").count() == 0
    assert "data_type: int" in registry.contract(got)


def plan():
    return [runner.Step("a", 1), runner.Step("a", 2), runner.Step("b", None)]


def test_plan_runs_in_order_and_retries():
    slept, seen, fails = [], [], {("a", 2): 2}

    def load(step):
        seen.append((step.dataset, step.season))
        if fails.get((step.dataset, step.season), 0):
            fails[step.dataset, step.season] -= 1
            raise ConnectionError("try again")
        return 5

    got = runner.run_plan(plan(), load, workers=1, retries=2, delay=30, sleep=slept.append)
    assert [r.status for r in got] == ["success"] * 3 and slept == [30, 60] and got[1].attempts == 3
    assert seen[:2] == [("a", 1), ("a", 2)] and runner.summarise(got) == {"success": 3, "skipped": 0, "failed": 0, "rows": 15}


def test_local_errors_are_not_retried():
    def load(step):
        raise FileNotFoundError("gone")

    assert runner.run_step(plan()[0], load, 3, 1, lambda _: pytest.fail("slept")).status == "failed"

    def skip(step):
        raise registry.PeriodUnavailable("too early")

    assert runner.run_step(plan()[0], skip, 3, 1, lambda _: None).status == "skipped"


@pytest.mark.parametrize(
    "fails,built,cleared,code", [(False, 0, True, 0), (True, None, False, 1), (False, 2, False, 2)]
)
def test_gate(fails, built, cleared, code):
    calls, told, saved = [], [], []

    def load(step):
        if fails:
            raise RuntimeError("bad")
        return 1

    def transform():
        calls.append("transform")
        return built

    got = runner.run_pipeline(plan(), load, transform, lambda names: calls.append(names), runner.History(saved.append), told.append, retries=0)
    assert got == code and ("transform" in calls) is not fails and (["a", "b"] in calls) is cleared and bool(told) is bool(code)
    assert saved[0]["status"] == ("success" if code == 0 else "failed") and len(saved[0]["steps"]) == 3


def test_run_log(spark, tmp_path):
    log = runner.RunLog(spark, str(tmp_path / "log"))
    assert log.runs().count() == 0 and log.steps().count() == 0
    runner.run_pipeline(plan(), lambda s: 5, lambda: 0, lambda names: None, runner.History(log.save), retries=0)
    assert [(r.kind, r.status) for r in log.runs().collect()] == [("refresh", "success")]
    assert sorted((r.position, r.dataset, r.season, r.status, r.n_rows) for r in log.steps().collect()) == [(0, "a", 1, "success", 5), (1, "a", 2, "success", 5), (2, "b", None, "success", 5)]


def test_datasets_run_side_by_side():
    import threading

    met, order = threading.Barrier(2, timeout=10), []

    def load(step):
        if step.season in (1, None):
            met.wait()
        order.append((step.dataset, step.season))
        return 1

    got = runner.run_plan(plan(), load, workers=2, retries=0)
    assert [r.step for r in got] == plan() and order.index(("a", 1)) < order.index(("a", 2))


def test_recording_and_telling_never_raise():
    def broken(*_):
        raise OSError

    runner.History(broken).record("k", "s", [], {})
    assert runner.notify("http://x", "hi", broken) is False and runner.notify(None, "hi") is False
    sent = []
    assert runner.notify("http://x", "hi", lambda u, b: sent.append(json.loads(b))) and sent == [{"text": "hi", "content": "hi"}]


def test_stream_upserts_once(spark, tmp_path):
    src, t = str(tmp_path / "src"), snapshot.Table(spark, str(tmp_path / "t"))
    run = lambda: upsert_stream(spark.readStream.schema("k int, v int").parquet(src), t, ["k"], [F.desc("v")], str(tmp_path / "ck"))
    spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "k int, v int").coalesce(1).write.parquet(src)
    run()
    spark.createDataFrame([(2, 9), (3, 3)], "k int, v int").coalesce(1).write.mode("append").parquet(src)
    run()
    version = t.version()
    run()
    assert rows(t.read()) == [(1, 2), (2, 9), (3, 3)] and t.version() == version


def test_stream_rewrites_touched_partitions(spark, tmp_path):
    src, t = str(tmp_path / "src"), snapshot.Table(spark, str(tmp_path / "t"), "day")
    run = lambda: upsert_stream(spark.readStream.schema("day int, k int, v int").parquet(src), t, ["day", "k"], [F.desc("v")], str(tmp_path / "ck"))
    spark.createDataFrame([(1, 1, 1), (2, 1, 5)], "day int, k int, v int").coalesce(1).write.parquet(src)
    run()
    before = t.parts()
    spark.createDataFrame([(2, 1, 9), (3, 3, 3)], "day int, k int, v int").coalesce(1).write.mode("append").parquet(src)
    run()
    assert rows(t.read()) == [(1, 1, 1), (2, 1, 9), (3, 3, 3)] and t.parts()["1"] == before["1"]


PAGE = """{{Club final staff
* Head coach – [[Al Alpha (coach)|Al Alpha]] ''(fired November 27)''
* Interim head coach/special teams coordinator – Ben Beta, Jr
* Offensive coordinator – [[Cy Gamma]]{{ref}}
* Assistant head coach – Di Delta
* Defensive coordinator: Vacant
}} * Head coach – Not Here"""


def staff(spark, text, season=2020, templates=(), games=None):
    pages = spark.createDataFrame([(season, "T", text)], "season int, team string, text string")
    held = games and spark.createDataFrame([(season, "T", w, d) for w, d in games.items()], "season int, team string, week int, day date")
    return st.parse_pages(pages, templates, held).collect()


def value(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], list(given)).select(column).first()[0]


def test_staff_page(spark):
    got = {(e.role, e.person): e for e in staff(spark, PAGE, templates=("Club final staff",))}
    assert set(got) == {("head_coach", "Al Alpha"), ("head_coach", "Ben Beta Jr."), ("offensive_coordinator", "Cy Gamma")}
    lead, sub = got["head_coach", "Al Alpha"], got["head_coach", "Ben Beta Jr."]
    assert lead.end_date == sub.start_date == dt.date(2020, 11, 27) and sub.is_interim and not lead.is_interim
    assert staff(spark, "nothing here") == []
    assert [e.person for e in staff(spark, "* Head coach - Ed Eps")] == ["Ed Eps"]


def test_staff_block(spark):
    text = "a {{Other|{{x}}}} b {{Club final staff\n* {{y|{{z}}}} *\n}} c }}"
    assert value(spark, st.staff_block(F.col("t"), ("None such", "Club final staff")), t=text) == "{{Club final staff\n* {{y|{{z}}}} *\n}}"
    assert value(spark, st.staff_block(F.col("t"), ("Club",)), t="{{Club * Head coach - A").startswith("{{Club")
    assert value(spark, st.staff_block(F.col("t")), t="* [[X|Head coach]] - A") == "* [[X|Head coach]] - A"
    assert value(spark, st.staff_block(F.col("t")), t="Head coach - A") is None


def test_dates_in_notes(spark):
    day = lambda note: value(spark, st.day_in(F.col("n"), F.lit(2020)), n=note)
    assert day("until January 5") == dt.date(2021, 1, 5)
    assert day("on March 3") == dt.date(2020, 3, 3)
    assert day("June 1, 2019") == dt.date(2019, 6, 1)
    assert day("February 30") is None and day("no date") is None
    game = F.lit(dt.date(2020, 11, 15))
    week = lambda note: value(spark, F.struct(st.week_in(F.col("n")), st.week_day(F.col("n"), game)), n=note)
    assert tuple(week("fired after Week 10")) == (10, dt.date(2020, 11, 16))
    assert tuple(week("before week 10")) == (10, dt.date(2020, 11, 15)) and week("in October")[0] is None


@pytest.mark.parametrize(
    "title,want",
    [
        ("Head coach", [("head_coach", False)]),
        ("Interim head coach/special teams coordinator", [("head_coach", True)]),
        ("Acting  Defensive Coordinator and linebackers", [("defensive_coordinator", True)]),
        ("Co-offensive coordinator & tight ends", [("offensive_coordinator", False)]),
        ("Assistant head coach / offensive coordinator", [("offensive_coordinator", False)]),
        ("Associate head coach", []),
        ("Passing game coordinator", []),
        ("Head coach emeritus", []),
    ],
)
def test_roles(spark, title, want):
    assert [tuple(r) for r in value(spark, st.roles_of(F.col("t")), t=title)] == want


@pytest.mark.parametrize("raw,want", [("Pete  Car, Jr.", "Pete Car Jr."), ("Ken Nor Sr", "Ken Nor Sr."), ("A B†", "A B"), (" x , ", "x"), ("C D III", "C D III")])
def test_person_names(spark, raw, want):
    assert value(spark, st.person_name(F.col("n")), n=raw) == want


def test_undated_change_is_flagged(spark):
    got = staff(spark, "* Head coach - A B\n* Acting head coach - C D")
    assert all(e.flags == "undated_change" for e in got) and len(got) == 2


def test_flags_and_open_ends(spark):
    two = staff(spark, "* Head coach - A B\n* Head coach - C D")
    assert [e.flags for e in two] == ["ambiguous_multiple"] * 2
    one = {e.person: e for e in staff(spark, "* Head coach - A B ''(demoted October 1)''\n* Head coach - C D\n* Defensive coordinator - E F; October 9")}
    assert one["A B"].end_date == dt.date(2020, 10, 1) and one["A B"].flags is None and one["C D"].flags is None
    assert (one["E F"].end_date, one["E F"].flags, one["E F"].note) == (dt.date(2020, 10, 9), "date_kind_guessed", "October 9")
    back = {e.person: e for e in staff(spark, "* Head coach - A B\n* Interim head coach - C D ''(took over before Week 3)''", games={3: dt.date(2020, 9, 20)})}
    assert back["A B"].end_date == back["C D"].start_date == dt.date(2020, 9, 20)
    named = staff(spark, "* [[Coaches|Head coach]] – [[G H (coach, born 1982)|G H]] (interim)<ref>x</ref>")[0]
    assert (named.person, named.is_interim, named.note) == ("G H", True, None)


def test_pages_are_parsed_together(spark):
    pages = spark.createDataFrame([(2020, "T", PAGE), (2020, "U", None), (2021, "T", PAGE)], "season int, team string, text string")
    assert st.parse_pages(pages, ("Club final staff",)).count() == 6


def test_article_titles(spark):
    title = lambda y: value(spark, st.article_title(F.col("t"), F.lit("New Name"), F.lit(y), (("T", 2000, 2009, "Old Name"),)), t="T")
    assert title(2009) == "2009 Old Name season" and title(2010) == "2010 New Name season"

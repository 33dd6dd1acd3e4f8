"""Queries that go through storage: loads, replaced partitions, upserts, projects. Each writes
to a scratch folder of its own and has its SQL."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.catalog import Tables, query
from lakeward.functions.expressions import kickoff
from lakeward.operators import identity, merge, retype, serving, staff
from lakeward.plans import build, runner
from lakeward.sources import registry, snapshot
from lakeward.sources.pages import Wiki, load_staff
from lakeward.streaming.incremental import upsert_stream

NOW = dt.datetime(2024, 6, 1, 12)


def _yearly(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("season"))


YEARLY_SQL = "(SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS season FROM orders)"


@query("landing_partition_replaced", f"""SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_totalprice, season, NULL AS note FROM {YEARLY_SQL} WHERE season NOT IN (1996, 1997)
    UNION ALL SELECT o_orderkey, o_custkey + 0.5, o_totalprice, season, 'again' FROM {YEARLY_SQL} WHERE season = 1996 AND o_orderkey % 2 = 0""")  # fmt: skip
def landing_partition_replaced(t: Tables) -> DataFrame:
    """One season comes again with a wider type and a new column, another comes empty."""
    table = snapshot.Table(t.spark, build.scratch(t.spark), "season")
    rows = _yearly(t)
    table.replace_all(rows)
    table.replace_partition(rows.limit(0), "season", 1997)
    again = rows.where("season = 1996 and o_orderkey % 2 = 0").withColumn("o_custkey", F.col("o_custkey") + F.lit(0.5)).withColumn("note", F.lit("again"))
    table.replace_partition(again, "season", 1996)
    return table.read()


@query("landing_versions", f"SELECT 1 AS version, count(*) AS n FROM {YEARLY_SQL} UNION ALL SELECT 2, count(*) FROM {YEARLY_SQL} WHERE season <> 1998 UNION ALL SELECT 3, 0")
def landing_versions(t: Tables) -> DataFrame:
    """Readers of a version keep it while others write; truncating keeps the columns."""
    table = snapshot.Table(t.spark, build.scratch(t.spark), "season")
    table.replace_all(_yearly(t))
    table.replace_partition(_yearly(t).limit(0), "season", 1998)
    table.truncate()
    each = [table.read(v).agg(F.count("*").alias("n")).select(F.lit(v).alias("version"), "n") for v in (1, 2, 3)]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("landing_types", "SELECT * FROM (VALUES ('l_linenumber', 'bigint'), ('l_discount', 'double'), ('l_shipdate', 'string'), ('l_returnflag', 'string'), ('l_partkey', 'double'), ('extra', 'date'), ('flag', 'bigint')) AS v(name, kind)")
def landing_types(t: Tables) -> DataFrame:
    """What columns become where a later load brings other types."""
    table = snapshot.Table(t.spark, build.scratch(t.spark), "l_linenumber")
    rows = t.lineitem.select(F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_discount", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_returnflag", "l_partkey", (F.col("l_tax") > 0).alias("flag"))
    table.replace_all(rows)
    other = rows.select("l_linenumber", F.col("l_discount").cast("bigint").alias("l_discount"), F.lit(7).cast("bigint").alias("l_shipdate"), "l_returnflag", F.col("l_partkey").cast("double").alias("l_partkey"), F.lit(1).cast("bigint").alias("flag"), F.current_date().alias("extra"))
    table.replace_partition(other.where("l_linenumber = 1"), "l_linenumber", 1)
    return t.spark.createDataFrame(sorted(table.schema().items()), "name string, kind string")


@query(
    "landing_widened",
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS wider, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS unlike, CAST(o_custkey AS VARCHAR) AS text, o_totalprice > 1000 AS same, CAST(NULL AS DATE) AS added, year(o_orderdate) AS season
    FROM orders WHERE year(o_orderdate) = 1996 UNION ALL SELECT o_orderkey, o_custkey / 2.0, CAST(o_custkey AS VARCHAR), concat('c', o_custkey), o_totalprice > 2000, CAST(o_orderdate AS DATE), 1997 FROM orders WHERE year(o_orderdate) = 1997""",
)
def landing_widened(t: Tables) -> DataFrame:
    """A season of other types is landed beside one that is there: values in types that hold both."""
    table, day, key = snapshot.Table(t.spark, build.scratch(t.spark), "season"), F.col("o_orderdate").cast("date"), F.col("o_custkey").cast("bigint")
    rows = t.orders.withColumn("season", F.year("o_orderdate").cast("bigint"))
    one = rows.select("o_orderkey", key.alias("wider"), day.alias("unlike"), key.alias("text"), (F.col("o_totalprice") > 1000).alias("same"), "season")
    two = rows.select("o_orderkey", (F.col("o_custkey") / 2).alias("wider"), key.alias("unlike"), F.concat(F.lit("c"), "o_custkey").alias("text"), (F.col("o_totalprice") > 2000).alias("same"), day.alias("added"), "season")
    table.replace_partition(one.where("season = 1996"), "season", 1996)
    table.replace_partition(two.where("season = 1997"), "season", 1997)
    return table.read()


@query("load_step", "SELECT o_orderkey, o_orderstatus, year(o_orderdate) AS season FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def load_step(t: Tables) -> DataFrame:
    """Three of four planned seasons exist at the source; each is fetched, stamped and landed."""
    root = build.scratch(t.spark)
    for y in (1996, 1997, 1998):
        t.orders.where(F.year("o_orderdate") == y).select("o_orderkey", F.col("o_orderstatus").alias("O_OrderStatus")).write.parquet(f"{root}/source/games/{y}.parquet")
    games = registry.Dataset("games", "games", "mirror", first_season=1996, options={"root": f"{root}/source", "files": "games"})
    table = snapshot.Table(t.spark, f"{root}/staging", "season")
    done = runner.run_plan(runner.make_plan([games], 1990, 1999), lambda s: registry.load(t.spark, games, s.season, table, NOW), workers=2, retries=0)
    if [r.status for r in done] != ["success"] * 3 + ["skipped"]:
        raise AssertionError(done)
    return table.read().select("o_orderkey", "o_orderstatus", "season")


@query(
    "plan_results",
    "SELECT 'orders' AS dataset, CAST(y AS INTEGER) AS season, 'success' AS status, n AS n_rows FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1) WHERE y BETWEEN 1995 AND 2001 UNION ALL SELECT 'orders', 2002, 'skipped', 0 UNION ALL SELECT 'parts', NULL, 'failed', 0",
)
def plan_results(t: Tables) -> DataFrame:
    """The run log of a plan with steps that succeed, are not there yet, and fail."""
    sets = [registry.Dataset("orders", "orders", "mirror", first_season=1995), registry.Dataset("parts", "parts", "mirror", partitioned=False)]

    def load(step: runner.Step) -> int:
        if step.dataset == "parts":
            raise ValueError("no such column")
        n = t.orders.where(F.year("o_orderdate") == step.season).count()
        if not n:
            raise registry.PeriodUnavailable(str(step.season))
        return n

    log = runner.RunLog(t.spark, build.scratch(t.spark))
    runner.run_pipeline(runner.make_plan(sets, 1990, 2002), load, lambda: 0, lambda _: None, runner.History(log.save), retries=0)
    return log.steps().select("dataset", "season", "status", "n_rows")


YEARS_SQL = "(SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS n FROM orders GROUP BY 1)"
RUN_SQL = f"""(SELECT 'refresh' AS kind, CASE WHEN season % 3 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN season % 3 = 0 THEN 'no rows of ' || season END AS error, season AS began,
  season AS step, CASE WHEN season % 3 = 0 THEN 0 ELSE n END AS n_rows FROM {YEARS_SQL} UNION ALL SELECT 'backfill', 'running', NULL, 9999, NULL, NULL)"""


def _history(t: Tables) -> runner.RunLog:
    """One run a year of orders, in order; every third year fails, and a last run has begun and not ended."""
    log, games = runner.RunLog(t.spark, build.scratch(t.spark)), registry.Dataset("orders", "orders", "mirror", first_season=1990)
    per_year = {r.season: r.n for r in _yearly(t).groupBy("season").agg(F.count("*").alias("n")).collect()}

    def load(step: runner.Step) -> int:
        if step.season % 3 == 0:
            raise ValueError(f"no rows of {step.season}")
        return per_year[step.season]

    history = runner.History(log.save, started=log.save)
    for season in sorted(per_year):
        runner.run_pipeline(runner.make_plan([games], season, season), load, lambda: 0, lambda _: None, history, retries=0)
    history.begin("backfill", {})
    return log


@query("run_history", f"SELECT kind, status, error, step AS season, n_rows FROM {RUN_SQL} ORDER BY began DESC LIMIT 5")
def run_history(t: Tables) -> DataFrame:
    """The latest runs of the library's own log, with what their steps loaded."""
    log = _history(t)
    steps = log.steps().select("run_id", "season", "n_rows")
    return serving.latest_runs(log.runs(), 5).join(steps, "run_id", "left").select("kind", "status", "error", "season", "n_rows")


@query("run_health", f"""SELECT 'latest' AS which, kind, status FROM (SELECT * FROM {RUN_SQL} ORDER BY began DESC LIMIT 1)
    UNION ALL SELECT 'latest_success', kind, status FROM (SELECT * FROM {RUN_SQL} WHERE status = 'success' ORDER BY began DESC LIMIT 1)""")  # fmt: skip
def run_health(t: Tables) -> DataFrame:
    told = serving.health(_history(t).runs().withColumnRenamed("kind", "of_kind"))
    return told.select(F.col("kind").alias("which"), F.col("of_kind").alias("kind"), "status")


@query("minted_by_two", """SELECT o_clerk AS name, CAST(row_number() OVER (ORDER BY o_orderpriority, o_clerk) AS INTEGER) AS id
    FROM (SELECT DISTINCT concat(o_orderpriority, ' ', o_custkey % 700) AS o_clerk, left(o_orderpriority, 1) AS o_orderpriority FROM orders)""")  # fmt: skip
def minted_by_two(t: Tables) -> DataFrame:
    """Several builders that share the marks reserve their ids one after another."""
    path, names = f"{build.scratch(t.spark)}/marks", t.orders.select(F.concat("o_orderpriority", F.lit(" "), F.col("o_custkey") % 700).alias("name"))
    each = [identity.mint_ids(names.where(F.col("name").startswith(str(k))), lambda n: build.Marks(t.spark, path).reserve("clerk", n)) for k in range(1, 6)]
    return reduce(DataFrame.unionByName, each)


@query("merged_buckets", """SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT -1 - o_orderkey, 0.0 FROM orders WHERE o_orderkey % 90 = 0""")  # fmt: skip
def merged_buckets(t: Tables) -> DataFrame:
    """A second build merges changed and new rows into a model stored in buckets of its key."""
    rows = t.orders.select("o_orderkey", "o_totalprice")
    new = rows.where("o_orderkey % 40 = 0").withColumn("o_totalprice", F.lit(-1.0)).unionByName(rows.where("o_orderkey % 90 = 0").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit(0.0).alias("o_totalprice")))
    model = build.Model("prices", lambda own, _: own, ("source",), "merge", ("o_orderkey",), buckets=8)
    root = build.scratch(t.spark)
    build.Project(t.spark, root, [model], {"source": rows}).build()
    second = build.Project(t.spark, root, [model], {"source": new})
    second.build()
    return second.frame("prices")


@query("rows_by_id", f"SELECT o_orderkey, o_custkey, o_totalprice, season FROM {YEARLY_SQL} WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders))")
def rows_by_id(t: Tables) -> DataFrame:
    """Single rows of a stored fact by their ids: files in order of it and Bloom filters spare the other row groups."""
    table = snapshot.Table(t.spark, build.scratch(t.spark), "season", lookup=("o_orderkey",))
    table.replace_all(_yearly(t))
    first = t.orders.agg(F.min("o_custkey")).first()[0]
    ids = [r[0] for r in t.orders.where(F.col("o_custkey") == first).select("o_orderkey").collect()]  # one customer's orders
    return serving.of_ids(table.read(), "o_orderkey", ids)


@query(
    "project_second_build",
    """WITH s AS (SELECT DISTINCT p_brand AS alias FROM part), o AS (SELECT alias, CAST(row_number() OVER (ORDER BY alias) AS INTEGER) AS id FROM s WHERE alias NOT LIKE '%5')
    SELECT alias, id FROM o UNION ALL SELECT alias, CAST((SELECT max(id) FROM o) + row_number() OVER (ORDER BY alias) AS INTEGER) FROM s WHERE alias LIKE '%5'""",
)
def project_second_build(t: Tables) -> DataFrame:
    """Brands get ids; the second build is a full refresh with more brands, and the ids stay."""
    root, spark = build.scratch(t.spark), t.spark
    marks = build.Marks(spark, f"{root}/marks")

    def rows(brands: DataFrame, held: DataFrame | None) -> DataFrame:
        known = spark.createDataFrame([], identity.IDENTITY) if held is None else held
        return identity.identity_rows(brands, spark.createDataFrame([], "source_value string, canonical_value string"), known, lambda n: marks.reserve("brand", n))

    models = [
        build.Model("brand_ids", rows, ("brands",), "merge", ("alias",), layer="reference", kept=True),
        build.Model("named", lambda ids, _: ids.select("alias", "id"), ("brand_ids",), "view"),
    ]
    brands = t.part.select(F.col("p_brand").alias("alias")).distinct()
    build.Project(spark, root, models, {"brands": brands.where("alias not like '%5'")}).build()
    second = build.Project(spark, root, models, {"brands": brands})
    second.build(full_refresh=True)
    return second.frame("named")


@query(
    "project_checks",
    """SELECT * FROM (SELECT 'customers.twice' AS name, (SELECT count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)) AS n
    UNION ALL SELECT 'customers.poor', (SELECT count(*) FROM customer WHERE c_acctbal < 0)) WHERE n > 0""",
)
def project_checks(t: Tables) -> DataFrame:
    checks = {"twice": lambda df: df.groupBy("c_nationkey").count().where("count > 1"), "poor": lambda df: df.where("c_acctbal < 0"), "none": lambda df: df.where("c_custkey is null")}
    project = build.Project(t.spark, build.scratch(t.spark), [build.Model("customers", lambda c, _: c, ("customer",), checks=checks)], {"customer": t.customer})
    return t.spark.createDataFrame(sorted(project.build().items()), "name string, n bigint")


@query(
    "staff_of_season",
    """SELECT 2020 AS season, concat('T', n_nationkey) AS team, 'head_coach' AS role, concat('Coach of ', CASE WHEN n_nationkey = 3 THEN 'Three' ELSE n_name END) AS person, 'override' AS flags, 1 AS k FROM nation WHERE n_nationkey < 0
    UNION ALL SELECT 2020, concat('T', n_nationkey), 'head_coach', CASE WHEN n_nationkey = 2 THEN 'Corrected' ELSE concat('Coach of ', CASE WHEN n_nationkey = 3 THEN 'Three' ELSE n_name END) END, CASE WHEN n_nationkey = 2 THEN 'override' END, 1 FROM nation WHERE n_nationkey <> 4""",
)
def staff_of_season(t: Tables) -> DataFrame:
    """Articles of a made-up wiki: one team had another name, one article is missing, one coach
    is corrected by hand."""
    names = {r.n_nationkey: r.n_name for r in t.nation.collect()}
    titles = {f"2020 {'Three' if k == 3 else n} season": f"* Head coach – Coach of {'Three' if k == 3 else n}" for k, n in names.items() if k != 4}

    def get(params: dict) -> dict:
        asked = params["titles"].split("|")
        there = [{"title": x, "revisions": [{"slots": {"main": {"content": titles[x]}}}]} if x in titles else {"title": x, "missing": True} for x in asked]
        return {"query": {"pages": there}}

    games = t.nation.selectExpr("2020 AS season", "concat('T', n_nationkey) AS home_team", "concat('T', n_nationkey) AS away_team", "'REG' AS game_type", "1 AS week", "date'2020-09-10' AS gameday")
    teams = t.nation.selectExpr("concat('T', n_nationkey) AS team_abbr", "n_name AS team_name")
    fixed = t.spark.createDataFrame([(2020, "T2", "head_coach", "Head coach", "Corrected", False)], "season int, team string, role string, title string, person string, is_interim boolean")
    for c, kind in (("note", "string"), ("start_date", "date"), ("end_date", "date"), ("flags", "string")):
        fixed = fixed.withColumn(c, F.lit(None).cast(kind))
    rows = load_staff(t.spark, Wiki(get, sleep=lambda _: None), 2020, games, teams, (), (("T3", 2000, 2020, "Three"),), fixed)
    return rows.select("season", "team", "role", "person", "flags", F.lit(1).alias("k"))


@query(
    "edit_pairs",
    """WITH n AS (SELECT DISTINCT p_type AS name FROM part UNION SELECT n_name FROM nation UNION SELECT s_name FROM supplier)
    SELECT x.name AS a, y.name AS b, CAST(levenshtein(x.name, y.name) AS INTEGER) AS distance FROM n x JOIN n y ON x.name < y.name WHERE levenshtein(x.name, y.name) <= 1""",
)
def edit_pairs(t: Tables) -> DataFrame:
    names = t.part.select(F.col("p_type").alias("name")).union(t.nation.select("n_name")).union(t.supplier.select("s_name"))
    return staff.edit_pairs(names)


@query("upsert_partitions", f"""SELECT o_orderkey, o_custkey, CASE WHEN season = 1996 AND o_orderkey % 3 = 0 THEN 1.0 ELSE o_totalprice END AS o_totalprice, season FROM {YEARLY_SQL}
    UNION ALL SELECT -o_orderkey, o_custkey, 1.0, season FROM {YEARLY_SQL} WHERE season = 1996 AND o_orderkey % 7 = 0""")  # fmt: skip
def upsert_partitions(t: Tables) -> DataFrame:
    """An upsert that touches one season leaves the folders of the others."""
    table = snapshot.Table(t.spark, build.scratch(t.spark), "season")
    rows = _yearly(t)
    table.replace_all(rows)
    before = table.parts()
    one = rows.where("season = 1996")
    new = one.where("o_orderkey % 3 = 0").unionByName(one.where("o_orderkey % 7 = 0").withColumn("o_orderkey", -F.col("o_orderkey"))).withColumn("o_totalprice", F.lit(1.0))
    table.merge_partitions(new, lambda held, rows: merge.upsert(held, rows, ["season", "o_orderkey"]))
    if {k for k, f in table.parts().items() if f != before.get(k)} - {"1996"}:
        raise AssertionError("an untouched partition was written")
    return table.read()


# -- smaller pieces of loading


@query("kickoffs", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(10 + o_orderkey % 12 AS INTEGER)) AS kickoff FROM orders")
def kickoffs(t: Tables) -> DataFrame:
    clock = F.concat((F.lit(10) + F.col("o_orderkey") % 12).cast("string"), F.lit(":00"))
    return t.orders.select("o_orderkey", kickoff(F.col("o_orderdate").cast("date"), clock).alias("kickoff"))


@query(
    "typed_times",
    "SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS ts, strftime(ts, '%H:%M') AS clock, event_id % 2 = 0 AS even, CAST(round_even(value, 0) AS INTEGER) AS value FROM events",
)
def typed_times(t: Tables) -> DataFrame:
    """Dates, timestamps and clock times that arrived as text, and a number to be rounded."""
    text = t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.date_format("ts", "HH:mm").alias("clock"),
        F.when(F.col("event_id") % 2 == 0, 1.0).otherwise(0.0).alias("even"), "value",
    )
    return retype.typed_copy(text, {"day": "date", "ts": "timestamp_ntz", "clock": "string", "even": "boolean", "value": "int"})


@query("week_days", """SELECT DISTINCT season, team, week, day FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, concat('T', unnest([c_nationkey, (c_nationkey + 1) % 25])) AS team,
    CAST(o_orderkey AS INTEGER) AS week, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 4 <> 0)""")  # fmt: skip
def week_days(t: Tables) -> DataFrame:
    games = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).selectExpr(
        "CAST(year(o_orderdate) AS INT) AS season", "concat('T', c_nationkey) AS home_team", "concat('T', (c_nationkey + 1) % 25) AS away_team", "CAST(o_orderkey AS INT) AS week",
        "CAST(o_orderdate AS DATE) AS gameday", "CASE WHEN o_orderkey % 4 = 0 THEN 'WC' ELSE 'REG' END AS game_type",
    )
    return staff.week_days(games)


@query(
    "overrides_applied",
    """WITH p AS (SELECT CAST(2000 + n_regionkey AS INTEGER) AS season, concat('T', n_nationkey) AS team, 'r' || CAST(n_nationkey % 2 AS VARCHAR) AS role, n_name AS person FROM nation WHERE n_regionkey < 4)
    SELECT season, team, role, person, CAST(NULL AS VARCHAR) AS flags FROM p WHERE team <> 'T1' UNION ALL SELECT season, team, role, 'By Hand', 'override' FROM p WHERE team = 'T1'""",
)
def overrides_applied(t: Tables) -> DataFrame:
    """A hand-kept file replaces one key; its rows of seasons that were not parsed are left out."""
    path = f"{build.scratch(t.spark)}/overrides"
    own = t.nation.selectExpr("CAST(2000 + n_regionkey AS INT) AS season", "concat('T', n_nationkey) AS team", "concat('r', n_nationkey % 2) AS role", "n_name AS person", "CAST(NULL AS STRING) AS flags")
    own.where("team = 'T1' or season = 2004").selectExpr("season", "team", "role", "'By Hand' AS person").coalesce(1).write.csv(path, header=True)
    by_hand = registry.overrides(t.spark, path, "season int, team string, role string, person string, flags string")
    return staff.with_overrides(own.where("season < 2004"), by_hand)


@query("seeded", "SELECT n_nationkey AS source_value, n_name AS canonical_value, CAST(n_regionkey + 1990 AS SMALLINT) AS valid_from, NULL AS note FROM nation")
def seeded(t: Tables) -> DataFrame:
    """A seed with declared types."""
    path = f"{build.scratch(t.spark)}/seed"
    t.nation.selectExpr("n_nationkey", "n_name", "n_regionkey + 1990", "''").write.csv(path, header=True)
    return registry.seed(t.spark, path, "source_value int, canonical_value string, valid_from smallint, note string")


@query("spellings_with_condition", "SELECT c_mktsegment AS alias FROM customer WHERE c_acctbal < 0 UNION SELECT n_name FROM nation UNION SELECT CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_acctbal > 5000")
def spellings_with_condition(t: Tables) -> DataFrame:
    return identity.spellings_of([(t.customer, "c_mktsegment", "c_acctbal < 0"), (t.nation, "n_name", None), (t.supplier, "s_nationkey", "s_acctbal > 5000")])


@query("fetched_season", "SELECT o_orderkey, o_orderstatus, CAST(1997 AS BIGINT) AS season, TIMESTAMP '2024-06-01 12:00:00' AS _loaded_at FROM orders WHERE year(o_orderdate) = 1997")
def fetched_season(t: Tables) -> DataFrame:
    """One season of a file that holds several, as it lands."""
    path = f"{build.scratch(t.spark)}/all"
    t.orders.select(F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderstatus"), F.year("o_orderdate").cast("bigint").alias("season")).write.parquet(path)
    games = registry.Dataset("games", "games", "lakeward.sources.registry.parquet", options={"path": path})
    return registry.landed(registry.fetch(t.spark, games, 1997), games, 1997, NOW)


@query("stream_upserted", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2 DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def stream_upserted(t: Tables) -> DataFrame:
    """Events that arrive in two parts, the even ids first, upserted by a stream that reads what has
    come and ends: a part's latest row of a key replaces that of the part before."""
    root = build.scratch(t.spark)
    rows = t.events.select("user_id", "event_type", "event_id", "value")
    table = snapshot.Table(t.spark, f"{root}/table", "event_type")
    for part in (0, 1):
        rows.where(F.col("event_id") % 2 == part).coalesce(1).write.mode("append").parquet(f"{root}/source")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/source")
        upsert_stream(stream, table, ["user_id", "event_type"], [F.desc("event_id")], f"{root}/checkpoint")
    return table.read()

"""Queries over the driver's tables, each with its SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeward.functions import staff_text
from lakeward.functions.expressions import part_of_day, row_hash
from lakeward.operators import dimensions, identity, islands, merge, quality, retype, serving
from lakeward.operators import staff as staff_ops

FLAGSHIP = "tenure_collapse"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


# -- typed copies


@query(
    "typed_copy",
    """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(round_even(l_quantity / 4, 0) AS SMALLINT) AS quarter,
    l_discount = 0 AS no_discount, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem""",
)
def typed_copy(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), (F.col("l_quantity") / 4).alias("quarter"),
        F.when(F.col("l_discount") == 0, 1.0).otherwise(0.0).alias("no_discount"), F.col("l_shipdate").cast("date").cast("string").alias("ship_day"),
    )
    return retype.typed_copy(rows, {"l_linenumber": "smallint", "quarter": "smallint", "no_discount": "boolean", "ship_day": "date"})


@query(
    "infer_flags",
    """SELECT bool_and(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END IN (0, 1)) AS zero__flag, true AS zero__whole, count(*) AS zero__n,
    CAST(max(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS zero__max,
    bool_and(l_quantity IN (0, 1)) AS quantity__flag, bool_and(l_quantity = floor(l_quantity)) AS quantity__whole, count(l_quantity) AS quantity__n,
    max(abs(l_quantity)) AS quantity__max, max(abs(l_partkey)) AS part__max FROM lineitem""",
)
def infer_flags(t: Tables) -> DataFrame:
    return retype.profile(
        t.lineitem.select(F.when(F.col("l_discount") == 0, 1.0).otherwise(0.0).alias("zero"), F.col("l_quantity").alias("quantity"), F.col("l_partkey").alias("part"))
    )


@query(
    "inferred_types",
    """WITH v AS (SELECT c_acctbal AS a, c_custkey AS k, CAST(c_custkey % 2 AS DOUBLE) AS e, floor(c_acctbal) AS w FROM customer)
    SELECT 'c_acctbal' AS column_name, CASE WHEN bool_and(a IN (0, 1)) THEN 'boolean' WHEN bool_and(a = floor(a)) THEN CASE WHEN max(abs(a)) > 32767 THEN 'int' ELSE 'smallint' END ELSE 'double' END AS target FROM v
    UNION ALL SELECT 'c_custkey', CASE WHEN max(abs(k)) > 32767 THEN 'int' ELSE 'smallint' END FROM v
    UNION ALL SELECT 'is_even', CASE WHEN bool_and(e IN (0, 1)) THEN 'boolean' ELSE 'smallint' END FROM v
    UNION ALL SELECT 'whole', CASE WHEN bool_and(w IN (0, 1)) THEN 'boolean' WHEN max(abs(w)) > 32767 THEN 'int' ELSE 'smallint' END FROM v""",
)
def inferred_types(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal", (F.col("c_custkey") % 2).cast("double").alias("is_even"), F.floor(F.col("c_acctbal")).cast("double").alias("whole"))
    return t.spark.createDataFrame(sorted(retype.infer_casts(rows).items()), "column_name string, target string")


@query(
    "row_id_latest",
    """SELECT id, l_shipdate, l_partkey FROM (SELECT md5(concat_ws('|', coalesce(CAST(l_orderkey AS VARCHAR), ''), coalesce(CAST(l_linenumber AS VARCHAR), ''))) AS id,
    l_shipdate, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem) WHERE n = 1""",
)
def row_id_latest(t: Tables) -> DataFrame:
    rows = retype.row_id(t.lineitem, ["l_orderkey", "l_linenumber"], "id")
    return retype.latest_by(rows, ["id"], [F.desc("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]).select("id", "l_shipdate", "l_partkey")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
def latest_per_key(t: Tables) -> DataFrame:
    return retype.latest_by(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


# -- incremental loads


@query(
    "only_new_rows",
    """SELECT event_id, ts, event_type FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-20')""",
)
def only_new_rows(t: Tables) -> DataFrame:
    target = t.events.where("event_type = 'click' and ts < timestamp_ntz'2024-01-20'")
    return merge.only_new(t.events, target, "ts").select("event_id", "ts", "event_type")


UPDATES = """SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice FROM orders WHERE o_orderkey % 50 = 0"""


def _updates(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = base.where("o_orderkey % 3 = 0").select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    added = base.where("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 1000000000).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"), "o_totalprice")
    return base, changed.unionByName(added)


@query(
    "upsert_rows",
    f"""WITH u AS ({UPDATES}) SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u) UNION ALL SELECT * FROM u""",
)
def upsert_rows(t: Tables) -> DataFrame:
    base, source = _updates(t)
    return merge.upsert(base, source, ["o_orderkey"], check=False)


@query(
    "upsert_some_columns",
    f"""WITH u AS ({UPDATES}) SELECT o.o_orderkey, o.o_custkey, coalesce(u.o_orderstatus, o.o_orderstatus) AS o_orderstatus, o.o_totalprice
    FROM orders o LEFT JOIN u USING (o_orderkey) UNION ALL SELECT * FROM u WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def upsert_some_columns(t: Tables) -> DataFrame:
    base, source = _updates(t)
    return merge.upsert(base, source, ["o_orderkey"], ["o_orderstatus"], check=False)


@query(
    "changed_rows",
    """WITH e AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 10 <> 0),
    c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)
    SELECT c.*, CASE WHEN e.c_custkey IS NULL THEN 2 ELSE 1 END AS created_at, 2 AS updated_at FROM c LEFT JOIN e USING (c_custkey)
    WHERE e.c_custkey IS NULL OR (e.c_name, e.c_mktsegment) IS DISTINCT FROM (c.c_name, c.c_mktsegment)""",
)
def changed_rows(t: Tables) -> DataFrame:
    cut = lambda n: F.when(F.col("c_custkey") % n != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    existing = t.customer.where("c_custkey % 10 <> 0").select("c_custkey", "c_name", cut(7), F.lit(1).alias("created_at"))
    return merge.changed_only(t.customer.select("c_custkey", "c_name", cut(14)), existing, ["c_custkey"], ["c_name", "c_mktsegment"], 2)


# -- identities

MAPPED = [("BUILDING", "HOUSING"), ("HOUSEHOLD", "HOUSING"), ("OLD NAME", "MACHINERY")]
MAPPED_SQL = "(VALUES ('BUILDING', 'HOUSING'), ('HOUSEHOLD', 'HOUSING'), ('OLD NAME', 'MACHINERY')) AS m(source_value, canonical_value)"
RESOLVED_SQL = f"""SELECT alias, coalesce(canonical_value, alias) AS name, CASE WHEN canonical_value IS NULL THEN 'canonical' ELSE 'reference_mappings' END AS source
FROM (SELECT c_mktsegment AS alias FROM customer UNION SELECT source_value FROM {MAPPED_SQL}) LEFT JOIN {MAPPED_SQL} ON alias = source_value"""


def _mapped(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(MAPPED, "source_value string, canonical_value string")


def _spellings(t: Tables) -> DataFrame:
    return identity.spellings_of([(t.customer, "c_mktsegment", None)])


@query("resolve_spellings", RESOLVED_SQL)
def resolve_spellings(t: Tables) -> DataFrame:
    return identity.resolve(_spellings(t), _mapped(t))


@query(
    "identities_first_run",
    f"""WITH r AS ({RESOLVED_SQL}), i AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id FROM (SELECT DISTINCT name FROM r))
    SELECT alias, id, name, source FROM r JOIN i USING (name)""",
)
def identities_first_run(t: Tables) -> DataFrame:
    return identity.identity_rows(_spellings(t), _mapped(t), t.spark.createDataFrame([], identity.IDENTITY), 0)


HELD = [("BUILDING", 7, "BUILDING", "canonical"), ("MACHINERY", 9, "MACHINERY", "canonical"), ("OLD NAME", 4, "OLD NAME", "canonical"), ("HOUSEHOLD", 7, "BUILDING", "reference_mappings")]


@query(
    "identities_second_run",
    f"""WITH r AS ({RESOLVED_SQL}), e AS (SELECT * FROM (VALUES ('BUILDING', 7, 'BUILDING', 'canonical'), ('MACHINERY', 9, 'MACHINERY', 'canonical'),
      ('OLD NAME', 4, 'OLD NAME', 'canonical'), ('HOUSEHOLD', 7, 'BUILDING', 'reference_mappings')) AS v(alias, id, name, source)),
    k AS (SELECT name, min(id) AS id FROM e WHERE name IN (SELECT name FROM r) GROUP BY name),
    i AS (SELECT r.name, min(e.id) AS id FROM r JOIN e USING (alias) WHERE r.name NOT IN (SELECT name FROM k)
      AND NOT EXISTS (SELECT 1 FROM e e2 LEFT JOIN r r2 USING (alias) WHERE e2.id = e.id AND coalesce(r2.name, '') <> r.name) GROUP BY r.name),
    n AS (SELECT name, CAST(20 + row_number() OVER (ORDER BY name) AS INTEGER) AS id FROM (SELECT DISTINCT name FROM r) WHERE name NOT IN (SELECT name FROM k) AND name NOT IN (SELECT name FROM i)),
    a AS (SELECT alias, coalesce(k.id, i.id, n.id) AS id, r.name, r.source FROM r LEFT JOIN k USING (name) LEFT JOIN i USING (name) LEFT JOIN n USING (name))
    SELECT a.* FROM a LEFT JOIN e USING (alias) WHERE e.alias IS NULL OR (e.id, e.name, e.source) IS DISTINCT FROM (a.id, a.name, a.source)""",
)
def identities_second_run(t: Tables) -> DataFrame:
    return identity.identity_rows(_spellings(t), _mapped(t), t.spark.createDataFrame(HELD, identity.IDENTITY), 20)


PAIRS_SQL = """WITH d AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS other FROM orders),
    u AS (SELECT other FROM d GROUP BY other HAVING count(*) = 1)
    SELECT key AS alias, key AS name FROM d UNION ALL SELECT other, key FROM d WHERE other IN (SELECT other FROM u) AND other <> key"""


def _pairs(t: Tables) -> DataFrame:
    keys = t.orders.select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderdate").cast("date").cast("string").alias("other"))
    return identity.alias_pairs(keys, "key", "other")


@query("unique_aliases", PAIRS_SQL)
def unique_aliases(t: Tables) -> DataFrame:
    return _pairs(t)


@query(
    "alias_identities",
    """WITH p AS (SELECT p_brand AS alias, p_brand AS name FROM (SELECT DISTINCT p_brand FROM part) UNION ALL SELECT lower(p_brand), p_brand FROM (SELECT DISTINCT p_brand FROM part)),
    i AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id FROM (SELECT DISTINCT name FROM p))
    SELECT alias, id, name, CASE WHEN alias = name THEN 'canonical' ELSE 'alias' END AS source FROM p JOIN i USING (name)""",
)
def alias_identities(t: Tables) -> DataFrame:
    keys = t.part.select("p_brand", F.lower("p_brand").alias("small")).distinct()
    return identity.alias_identities(identity.alias_pairs(keys, "p_brand", "small"), t.spark.createDataFrame([], identity.IDENTITY), 0)


@query(
    "current_names",
    f"""SELECT DISTINCT coalesce(canonical_value, o_orderpriority) AS name FROM (SELECT *, year(o_orderdate) AS y FROM orders)
    LEFT JOIN (SELECT * FROM (VALUES ('1-URGENT', 'FAST'), ('2-HIGH', 'FAST')) AS m(source_value, canonical_value)) ON o_orderpriority = source_value
    WHERE y = (SELECT max(year(o_orderdate)) FROM orders)""",
)
def current_names(t: Tables) -> DataFrame:
    m = t.spark.createDataFrame([("1-URGENT", "FAST"), ("2-HIGH", "FAST")], "source_value string, canonical_value string")
    return identity.current_set(t.orders.withColumn("y", F.year("o_orderdate")), "y", "o_orderpriority", m)


# -- sets and unpivots


@query("nation_codes_distinct", "SELECT c_nationkey AS code FROM customer UNION SELECT s_nationkey FROM supplier")
def nation_codes_distinct(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("code")).union(t.supplier.select("s_nationkey")).distinct()


@query(
    "sides_unpivoted",
    """SELECT side, nation, count(*) AS n, sum(quantity) AS quantity FROM (
      SELECT 'customer' AS side, c_nationkey AS nation, l_quantity AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      UNION ALL SELECT 'supplier', s_nationkey, l_quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
    GROUP BY ALL""",
)
def sides_unpivoted(t: Tables) -> DataFrame:
    wide = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("c_nationkey", "s_nationkey", "l_quantity", F.lit("customer").alias("c"), F.lit("supplier").alias("s"))
    )
    sides = dimensions.unpivot(wide, [{"side": "c", "nation": "c_nationkey", "quantity": "l_quantity"}, {"side": "s", "nation": "s_nationkey", "quantity": "l_quantity"}])
    return sides.groupBy("side", "nation").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


# -- islands and tenures

SEASONS_SQL = "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderdate AS DATE) AS day FROM orders"


def _seasons(t: Tables) -> DataFrame:
    return t.orders.select("*", F.year("o_orderdate").alias("season"), F.col("o_orderdate").cast("date").alias("day"))


CALENDAR_SQL = f"""SELECT season, o_custkey, CAST(coalesce(lag(last_day) OVER (PARTITION BY o_custkey ORDER BY season) + 1, first_seen) AS DATE) AS first_day, last_day
FROM (SELECT season, o_custkey, min(day) AS first_seen, max(day) AS last_day FROM ({SEASONS_SQL}) GROUP BY ALL)"""


@query("calendar", CALENDAR_SQL)
def calendar(t: Tables) -> DataFrame:
    return islands.period_starts(_seasons(t), "o_custkey", "season", "day")


RUNS_SQL = """SELECT *, sum(changed) OVER (PARTITION BY {part} ORDER BY {order} ROWS UNBOUNDED PRECEDING) - 1 AS run_no FROM (
  SELECT *, CASE WHEN row_number() OVER w = 1 OR lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus THEN 1 ELSE 0 END AS changed FROM {rows} WINDOW w AS (PARTITION BY {part} ORDER BY {order}))"""


@query("status_runs", f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(run_no AS BIGINT) AS run_no FROM ({RUNS_SQL.format(part='o_custkey', order='o_orderdate, o_orderkey', rows='orders')})")
def status_runs(t: Tables) -> DataFrame:
    return islands.islands(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus").select("o_orderkey", "o_custkey", "o_orderstatus", "run_no")


STINTS_SQL = f"""SELECT season, o_custkey, o_orderstatus, CAST(run_no AS BIGINT) AS run_no, min(day) AS first_at, max(day) AS last_at, count(*) AS n,
  count(*) OVER (PARTITION BY season, o_custkey) AS stints FROM ({RUNS_SQL.format(part='season, o_custkey', order='o_orderdate, o_orderkey', rows='(' + SEASONS_SQL + ')')})
  GROUP BY season, o_custkey, o_orderstatus, run_no"""


@query("stints", STINTS_SQL)
def stints(t: Tables) -> DataFrame:
    return islands.stints(_seasons(t), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", "day")


#: A third of the orders under one customer.
HOT_SQL = "(SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey) FROM orders)"


def _hot(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")))


@query("status_runs_split", f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(run_no AS BIGINT) AS run_no FROM ({RUNS_SQL.format(part='o_custkey', order='o_orderdate, o_orderkey', rows=HOT_SQL)})")
def status_runs_split(t: Tables) -> DataFrame:
    return islands.islands(_hot(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", split=True).select("o_orderkey", "o_custkey", "o_orderstatus", "run_no")


@query("stints_split", f"""SELECT o_custkey, o_orderstatus, CAST(run_no AS BIGINT) AS run_no, min(day) AS first_at, max(day) AS last_at, count(*) AS n, count(*) OVER (PARTITION BY o_custkey) AS stints
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM ({RUNS_SQL.format(part='o_custkey', order='o_orderdate, o_orderkey', rows=HOT_SQL)})) GROUP BY o_custkey, o_orderstatus, run_no""")  # fmt: skip
def stints_split(t: Tables) -> DataFrame:
    return islands.stints(_hot(t).withColumn("day", F.col("o_orderdate").cast("date")), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", "day", split=True)


ALL_RECORDED_SQL = f"""SELECT season, o_custkey, o_orderstatus, count(*) % 2 = 0 AS is_interim,
  CASE WHEN min(o_orderkey) % 3 = 0 THEN min(day) END AS start_date, CASE WHEN max(o_orderkey) % 5 = 0 THEN max(day) END AS end_date
  FROM ({SEASONS_SQL}) GROUP BY ALL"""
#: Records of some customers only: the others' stints have none.
RECORDED_SQL = f"SELECT * FROM ({ALL_RECORDED_SQL}) WHERE o_custkey % 4 = 0"
DATED_SQL = f"""SELECT h.season, h.o_custkey, h.o_orderstatus, coalesce(w.is_interim, false) AS is_interim, w.start_date IS NOT NULL OR run_no > 0 AS explicit_start,
  CASE WHEN w.start_date IS NOT NULL THEN w.start_date WHEN run_no > 0 THEN first_at ELSE first_day END AS start_date, CASE WHEN w.start_date IS NOT NULL THEN 'recorded' ELSE 'log' END AS start_source,
  w.end_date IS NOT NULL OR run_no < stints - 1 AS explicit_end, CASE WHEN w.end_date IS NOT NULL THEN w.end_date WHEN run_no < stints - 1 THEN last_at ELSE last_day END AS end_date,
  CASE WHEN w.end_date IS NOT NULL THEN 'recorded' ELSE 'log' END AS end_source
  FROM ({STINTS_SQL}) h JOIN ({CALENDAR_SQL}) c USING (season, o_custkey) LEFT JOIN ({RECORDED_SQL}) w ON w.season = h.season AND w.o_custkey = h.o_custkey AND w.o_orderstatus = h.o_orderstatus"""


def _recorded(t: Tables) -> DataFrame:
    return (
        _seasons(t).groupBy("season", "o_custkey", "o_orderstatus")
        .agg((F.count("*") % 2 == 0).alias("is_interim"), F.when(F.min("o_orderkey") % 3 == 0, F.min("day")).alias("start_date"), F.when(F.max("o_orderkey") % 5 == 0, F.max("day")).alias("end_date"))
    )


@query("dated_stints", DATED_SQL)
def dated_stints(t: Tables) -> DataFrame:
    return islands.dated_stints(stints(t), calendar(t), _recorded(t).where("o_custkey % 4 = 0"), ["season", "o_custkey"], "o_orderstatus")


@query(
    "recorded_rows",
    f"""WITH s AS ({ALL_RECORDED_SQL}), c AS ({CALENDAR_SQL}), u AS (SELECT season, o_custkey, o_orderstatus, bool_or(is_interim AND start_date IS NULL) AS unclear FROM s GROUP BY ALL)
    SELECT season, o_custkey, 1 AS person, o_orderstatus, is_interim, start_date IS NOT NULL OR is_interim AS explicit_start,
    CASE WHEN start_date IS NOT NULL THEN start_date WHEN is_interim THEN NULL ELSE first_day END AS start_date, CASE WHEN start_date IS NOT NULL THEN 'recorded' WHEN is_interim THEN NULL ELSE 'log' END AS start_source,
    end_date IS NOT NULL OR (unclear AND NOT is_interim) AS explicit_end, CASE WHEN end_date IS NOT NULL THEN end_date WHEN unclear AND NOT is_interim THEN NULL ELSE last_day END AS end_date,
    CASE WHEN end_date IS NOT NULL THEN 'recorded' WHEN unclear AND NOT is_interim THEN NULL ELSE 'log' END AS end_source
    FROM s JOIN c USING (season, o_custkey) JOIN u USING (season, o_custkey, o_orderstatus)""",
)
def recorded_rows(t: Tables) -> DataFrame:
    return islands.recorded_rows(_recorded(t).withColumn("person", F.lit(1)), calendar(t), ["season", "o_custkey"], "person", "o_orderstatus")


# one row a customer, status and season, as a tenure's key needs
YEARLY_SQL = f"""SELECT season, o_custkey, o_orderstatus, bool_or(is_interim) AS is_interim, bool_or(explicit_start) AS explicit_start, min(start_date) AS start_date, max(start_source) AS start_source,
  bool_or(explicit_end) AS explicit_end, max(end_date) AS end_date, max(end_source) AS end_source FROM ({DATED_SQL}) GROUP BY season, o_custkey, o_orderstatus"""
TENURES_SQL = f"""WITH r AS ({YEARLY_SQL}), l AS (SELECT max(season) AS latest FROM r),
  s AS (SELECT *, lag(season) OVER w AS prev, lag(explicit_end) OVER w AS ended FROM r WINDOW w AS (PARTITION BY o_custkey, o_orderstatus, is_interim ORDER BY season, start_date NULLS FIRST)),
  n AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> season - 1 OR ended OR explicit_start THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey, o_orderstatus, is_interim ORDER BY season, start_date NULLS FIRST ROWS UNBOUNDED PRECEDING) AS no FROM s),
  b AS (SELECT *, min(season) OVER t AS first_period, max(season) OVER t AS last_period FROM n WINDOW t AS (PARTITION BY o_custkey, o_orderstatus, is_interim, no)),
  g AS (SELECT o_custkey, o_orderstatus, is_interim, first_period, last_period, (array_agg(start_date ORDER BY season))[1] AS start_date, (array_agg(start_source ORDER BY season))[1] AS start_source,
    (array_agg(end_date ORDER BY season DESC))[1] AS e, (array_agg(end_source ORDER BY season DESC))[1] AS src, bool_or(explicit_end AND season = last_period) AS closed FROM b
    GROUP BY o_custkey, o_orderstatus, is_interim, no, first_period, last_period)
  SELECT o_custkey, o_orderstatus, is_interim, first_period, last_period, start_date, start_source, CASE WHEN last_period = latest AND NOT closed THEN NULL ELSE e END AS end_date,
    CASE WHEN last_period = latest AND NOT closed THEN 'ongoing' ELSE src END AS end_source FROM g, l"""


def _yearly(t: Tables) -> DataFrame:
    return dated_stints(t).groupBy("season", "o_custkey", "o_orderstatus").agg(
        F.bool_or("is_interim").alias("is_interim"), F.bool_or("explicit_start").alias("explicit_start"), F.min("start_date").alias("start_date"), F.max("start_source").alias("start_source"),
        F.bool_or("explicit_end").alias("explicit_end"), F.max("end_date").alias("end_date"), F.max("end_source").alias("end_source"),
    )


@query("tenure_collapse", TENURES_SQL)
def tenure_collapse(t: Tables) -> DataFrame:
    latest = _seasons(t).agg(F.max("season")).first()[0]
    return islands.collapse(_yearly(t), ["o_custkey", "o_orderstatus", "is_interim"], "season", F.lit(latest))


DAILY_SQL = f"""SELECT o_custkey, CAST(datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_no, CAST(min(o_orderdate) AS DATE) AS start_date, 'log' AS start_source,
  CAST(max(o_orderdate) AS DATE) AS end_date, 'log' AS end_source, bool_or(o_orderkey % 11 = 0) AS explicit_start, bool_or(o_orderkey % 7 = 0) AS explicit_end FROM {HOT_SQL} GROUP BY ALL"""


@query(
    "tenure_collapse_split",
    f"""WITH r AS ({DAILY_SQL}), s AS (SELECT *, lag(day_no) OVER w AS prev, lag(explicit_end) OVER w AS ended FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY day_no)),
    n AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> day_no - 1 OR ended OR explicit_start THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY day_no ROWS UNBOUNDED PRECEDING) AS no FROM s),
    g AS (SELECT o_custkey, min(day_no) AS first_period, max(day_no) AS last_period, min(start_date) AS start_date, max(end_date) AS e, arg_max(explicit_end, day_no) AS closed FROM n GROUP BY o_custkey, no)
    SELECT o_custkey, first_period, last_period, start_date, 'log' AS start_source, CASE WHEN closed OR last_period < latest THEN e END AS end_date,
    CASE WHEN closed OR last_period < latest THEN 'log' ELSE 'ongoing' END AS end_source FROM g, (SELECT max(day_no) AS latest FROM r)""",
)
def tenure_collapse_split(t: Tables) -> DataFrame:
    """Days in a row on which a customer ordered, a third of the orders being one customer's."""
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit(dt.date(1990, 1, 1)))
    days = _hot(t).groupBy("o_custkey", day.alias("day_no")).agg(
        F.min("o_orderdate").cast("date").alias("start_date"), F.lit("log").alias("start_source"), F.max("o_orderdate").cast("date").alias("end_date"), F.lit("log").alias("end_source"),
        F.bool_or(F.col("o_orderkey") % 11 == 0).alias("explicit_start"), F.bool_or(F.col("o_orderkey") % 7 == 0).alias("explicit_end"),
    )
    latest = t.orders.agg(F.max(day)).first()[0]
    return islands.collapse(days, ["o_custkey"], "day_no", F.lit(latest), split=True)


@query(
    "tenure_details",
    f"""SELECT c_name, n_name, o_orderstatus, first_period, last_period, start_date, end_date FROM ({TENURES_SQL}) JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
)
def tenure_details(t: Tables) -> DataFrame:
    return (
        tenure_collapse(t).join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("c_name", "n_name", "o_orderstatus", "first_period", "last_period", "start_date", "end_date")
    )


@query(
    "latest_season",
    "SELECT greatest((SELECT max(year(o_orderdate)) FROM orders WHERE o_orderstatus = 'F'), (SELECT max(year(l_shipdate)) FROM lineitem WHERE l_linestatus = 'F')) AS season",
)
def latest_season(t: Tables) -> DataFrame:
    a = t.orders.where("o_orderstatus = 'F'").agg(F.max(F.year("o_orderdate")).cast("bigint").alias("a"))
    b = t.lineitem.where("l_linestatus = 'F'").agg(F.max(F.year("l_shipdate")).cast("bigint").alias("b"))
    return a.join(b).select(F.greatest("a", "b").alias("season"))  # one row each


# -- dimensions and facts

BOUNDED = [("F", "FINISHED", None, 1997), ("O", "OPEN", 1996, None), ("F", "DONE", 1998, None)]
BOUNDED_SQL = "(VALUES ('F', 'FINISHED', NULL, 1997), ('O', 'OPEN', 1996, NULL), ('F', 'DONE', 1998, NULL)) AS m(source_value, canonical_value, valid_from, valid_to)"


@query(
    "bounded_mapping",
    f"""SELECT o_orderkey, coalesce(canonical_value, o_orderstatus) AS o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders
    LEFT JOIN {BOUNDED_SQL} ON o_orderstatus = source_value AND year(o_orderdate) BETWEEN coalesce(valid_from, 0) AND coalesce(valid_to, 9999)""",
)
def bounded_mapping(t: Tables) -> DataFrame:
    m = t.spark.createDataFrame(BOUNDED, "source_value string, canonical_value string, valid_from int, valid_to int")
    return dimensions.bounded_mapping(_seasons(t).select("o_orderkey", "o_orderstatus", "season"), "o_orderstatus", "season", m)


#: Overlapping validity: five sources with about five mappings each.
OVERLAPPING = ("concat(1 + n_nationkey % 5, '-') AS source_value", "n_name AS canonical_value", "CAST(CASE WHEN n_nationkey % 4 <> 0 THEN 1991 + n_nationkey % 6 END AS INT) AS valid_from", "CAST(CASE WHEN n_nationkey % 3 <> 0 THEN 1993 + n_nationkey % 5 END AS INT) AS valid_to")
OVERLAPPING_SQL = f"""SELECT o_orderkey, coalesce(canonical_value, o_orderpriority) AS o_orderpriority, season FROM (
  SELECT o_orderkey, left(o_orderpriority, 2) AS o_orderpriority, canonical_value, CAST(year(o_orderdate) AS INTEGER) AS season,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY coalesce(valid_from, 0) DESC, canonical_value) AS r
  FROM orders LEFT JOIN (SELECT {', '.join(OVERLAPPING)} FROM nation) ON left(o_orderpriority, 2) = source_value AND year(o_orderdate) BETWEEN coalesce(valid_from, 0) AND coalesce(valid_to, 9999)) WHERE r = 1"""


def _overlapping(t: Tables, large: bool) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 2).alias("o_orderpriority"), F.year("o_orderdate").alias("season"))
    return dimensions.bounded_mapping(rows, "o_orderpriority", "season", t.nation.selectExpr(*OVERLAPPING), large)


@query("bounded_mapping_overlapping", OVERLAPPING_SQL)
def bounded_mapping_overlapping(t: Tables) -> DataFrame:
    """Several mappings hold at once: the one that began last counts, and no row is multiplied."""
    return _overlapping(t, False)


@query("bounded_mapping_large", OVERLAPPING_SQL)
def bounded_mapping_large(t: Tables) -> DataFrame:
    """The same by bins of validity, for mappings beyond a broadcast."""
    return _overlapping(t, True)


@query(
    "telling_or_mode_hot",
    f"""SELECT o_custkey, CASE WHEN bool_or(p IN ('2-HIGH') AND o_custkey <> 0) THEN 'high once' ELSE mode() WITHIN GROUP (ORDER BY p) END AS p
    FROM (SELECT o_custkey, CASE WHEN o_custkey = 0 AND o_orderpriority = '2-HIGH' THEN '3-MEDIUM' ELSE o_orderpriority END AS p FROM {HOT_SQL}) GROUP BY o_custkey""",
)
def telling_or_mode_hot(t: Tables) -> DataFrame:
    """One customer has a third of the rows and none of the telling values."""
    p = F.when((F.col("o_custkey") == 0) & (F.col("o_orderpriority") == "2-HIGH"), "3-MEDIUM").otherwise(F.col("o_orderpriority"))
    return dimensions.roof_rule(_hot(t).select("o_custkey", p.alias("p")), "o_custkey", "p", ["2-HIGH"], "high once")


@query(
    "majority_latest",
    """SELECT p_brand, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY y DESC, n DESC, l_returnflag) AS r FROM (
      SELECT p_brand, year(l_shipdate) AS y, l_returnflag, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)) WHERE r = 1""",
)
def majority_latest(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.year("l_shipdate").alias("y"), "l_returnflag")
    return dimensions.majority_latest(rows, "p_brand", "y", "l_returnflag")


@query(
    "telling_or_mode",
    """SELECT o_custkey, CASE WHEN bool_or(p IN ('1-URGENT')) THEN 'urgent once' ELSE mode() WITHIN GROUP (ORDER BY p) END AS p
    FROM (SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders) WHERE p IS NOT NULL GROUP BY o_custkey""",
)
def telling_or_mode(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"))
    return dimensions.roof_rule(rows, "o_custkey", "p", ["1-URGENT"], "urgent once")


@query(
    "part_of_day",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL WHEN h < 12 THEN 'morning' WHEN h < 14 THEN 'noon' WHEN h < 17 THEN 'afternoon' ELSE 'night' END AS part
    FROM (SELECT event_id, hour(ts - INTERVAL 1 HOUR) AS h FROM events)""",
)
def part_of_day_query(t: Tables) -> DataFrame:
    return t.events.select("event_id", part_of_day(F.when(F.col("event_id") % 9 != 0, F.col("ts"))).alias("part"))


@query(
    "part_of_day_all_year",
    """WITH o AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts FROM orders),
    y AS (SELECT *, make_date(year(ts), 4, 1) AS april, make_date(year(ts), 10, 31) AS october FROM o),
    s AS (SELECT o_orderkey, ts, ts >= april + CAST((7 - dayofweek(april)) % 7 AS INTEGER) + INTERVAL 8 HOUR AND ts < october - CAST(dayofweek(october) AS INTEGER) + INTERVAL 7 HOUR AS summer FROM y),
    h AS (SELECT o_orderkey, summer, hour(ts - CASE WHEN summer THEN INTERVAL 5 HOUR ELSE INTERVAL 6 HOUR END) AS h FROM s)
    SELECT o_orderkey, summer, CASE WHEN h < 12 THEN 'morning' WHEN h < 14 THEN 'noon' WHEN h < 17 THEN 'afternoon' ELSE 'night' END AS part FROM h""",
)
def part_of_day_all_year(t: Tables) -> DataFrame:
    """Hours of all days of the years from 1995 to 2006, told where summer time holds from April's first Sunday to October's last."""
    ts = (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey") % 24)).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/Chicago"), ts)
    return t.orders.select("o_orderkey", (F.timestamp_diff("HOUR", local, ts) == 5).alias("summer"), part_of_day(ts, "UTC").alias("part"))


SIDES_SQL = """SELECT o_orderkey, CASE WHEN r > 0 THEN o_custkey WHEN r < 0 THEN s END AS winner, CASE WHEN r > 0 THEN s WHEN r < 0 THEN o_custkey END AS loser FROM (
    SELECT o_orderkey, o_custkey, o_custkey + 1 AS s, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 0 ELSE o_totalprice - 150000 END AS r FROM orders)"""


@query("winners_losers", SIDES_SQL)
def winners_losers(t: Tables) -> DataFrame:
    r = F.when(F.col("o_orderkey") % 4 == 0, None).when(F.col("o_orderkey") % 4 == 1, 0.0).otherwise(F.col("o_totalprice") - 150000)
    winner, loser = dimensions.sides(r, F.col("o_custkey"), F.col("o_custkey") + 1)
    return t.orders.select("o_orderkey", winner.alias("winner"), loser.alias("loser"))


@query(
    "star_resolve",
    """SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n, CAST(round(sum(l_quantity), 2) AS DOUBLE) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 5 <> 0) ON l_suppkey = s_suppkey
    LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY ALL""",
)
def star_resolve(t: Tables) -> DataFrame:
    fact = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier.where("s_suppkey % 5 <> 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    named = serving.with_sides(fact, t.nation, "n_nationkey", "n_name", "c_nationkey", "s_nationkey")
    return named.groupBy(F.col("home_name").alias("customer_nation"), F.col("away_name").alias("supplier_nation")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


# -- serving

SURFACE = serving.Surface(
    equal={"status": "o_orderstatus", "priority": "o_orderpriority", "order": "o_orderkey"},
    least={"price_min": "o_totalprice"}, most={"price_max": "o_totalprice"},
    either={"nation": ("home", "away")}, known={"supplied": "away"},
    sorts={"price": "o_totalprice", "away": "away", "date": "o_orderdate"}, key="o_orderkey",
)
GAMES_SQL = """SELECT g.*, h.n_name AS home_name, a.n_name AS away_name FROM (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate, c_nationkey AS home, s_nationkey AS away FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = s) g
  LEFT JOIN nation h ON h.n_nationkey = home LEFT JOIN nation a ON a.n_nationkey = away"""


def _games(t: Tables) -> DataFrame:
    lowest = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s"))
    fact = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(lowest, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t.supplier, F.col("s_suppkey") == F.col("s"), "left")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate", F.col("c_nationkey").alias("home"), F.col("s_nationkey").alias("away"))
    )
    return serving.with_sides(fact, t.nation, "n_nationkey", "n_name", "home", "away")


def _page(name: str, where: str, order: str, q: serving.PageQuery) -> None:
    query(f"page_{name}", f"SELECT * FROM ({GAMES_SQL}) WHERE {where} ORDER BY {order} LIMIT {q.limit} OFFSET {q.offset}")(lambda t: serving.page(_games(t), SURFACE, q))
    query(f"total_{name}", f"SELECT count(*) AS total FROM ({GAMES_SQL}) WHERE {where}")(lambda t: serving.total(_games(t), SURFACE, q))


_page("filtered", "o_orderstatus = 'F' AND o_totalprice >= 1000.0 AND o_totalprice <= 300000.0", "o_totalprice DESC NULLS LAST, o_orderkey DESC",
      serving.PageQuery({"status": "F", "price_min": 1000.0, "price_max": 300000.0, "priority": None}, "price", True, 100, 20))
_page("either_side", "(home = 3 OR away = 3)", "away NULLS LAST, o_orderkey", serving.PageQuery({"nation": 3}, "away", False, 1000))
_page("nulls_last", "true", "away DESC NULLS LAST, o_orderkey DESC", serving.PageQuery({}, "away", True, 1000, 0))
_page("unsupplied", "away IS NULL", "o_orderkey", serving.PageQuery({"supplied": False}))
_page("past_the_end", "away IS NOT NULL", "o_orderkey", serving.PageQuery({"supplied": True}, None, False, 10, 10_000_000))


@query("dimension_sorted", "SELECT s_suppkey, s_name, s_nationkey FROM supplier ORDER BY s_name NULLS LAST")
def dimension_sorted(t: Tables) -> DataFrame:
    return serving.dimension(t.supplier, "s_name").select("s_suppkey", "s_name", "s_nationkey")


@query(
    "health",
    """(SELECT o_orderkey, o_orderstatus, 'latest' AS kind FROM orders ORDER BY o_orderkey DESC LIMIT 1) UNION ALL
    (SELECT o_orderkey, o_orderstatus, 'latest_success' FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey DESC LIMIT 1)""",
)
def health(t: Tables) -> DataFrame:
    return serving.health(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", "P")


@query("latest_runs", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 25")
def latest_runs(t: Tables) -> DataFrame:
    return serving.latest_runs(t.events.select("event_id", "event_type"), 25, "event_id")


@query(
    "runs_with_steps",
    """SELECT o_orderkey, coalesce(n, 0) AS n_steps, coalesce(steps, '') AS steps FROM orders LEFT JOIN (
      SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS steps FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def runs_with_steps(t: Tables) -> DataFrame:
    steps = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    rows = serving.nested(t.orders.select("o_orderkey"), steps, "o_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "steps")
    text = F.transform("steps", lambda s: F.concat(s["l_linenumber"].cast("string"), F.lit(":"), s["l_partkey"].cast("string")))
    return rows.select("o_orderkey", F.size("steps").cast("bigint").alias("n_steps"), F.array_join(text, ",").alias("steps"))


# -- checks


@query("check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def check_unique(t: Tables) -> DataFrame:
    return quality.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("check_primary_key", "SELECT k, count(*) AS n FROM (SELECT nullif(o_custkey, 1) AS k FROM orders) GROUP BY k HAVING count(*) > 1 OR k IS NULL")
def check_primary_key(t: Tables) -> DataFrame:
    return quality.check_primary_key(t.orders.select(F.nullif(F.col("o_custkey"), F.lit(1)).alias("k")), ["k"])


@query("check_not_null", "SELECT o_orderkey, k FROM (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS k FROM orders) WHERE k IS NULL")
def check_not_null(t: Tables) -> DataFrame:
    return quality.check_not_null(t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("k")), ["k"])


@query("check_accepted", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type")
def check_accepted(t: Tables) -> DataFrame:
    return quality.check_accepted(t.events, "event_type", ["click", "view"])


@query("check_relationship", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0) GROUP BY o_custkey")
def check_relationship(t: Tables) -> DataFrame:
    return quality.check_relationship(t.orders, "o_custkey", t.customer.where("c_custkey % 9 <> 0"), "c_custkey")


@query(
    "check_codes",
    """SELECT source, code FROM (SELECT 'customer' AS source, CAST(c_nationkey AS VARCHAR) AS code FROM customer UNION SELECT 'supplier', CAST(s_nationkey AS VARCHAR) FROM supplier)
    WHERE code NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey < 20)""",
)
def check_codes(t: Tables) -> DataFrame:
    aliases = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("alias"))
    return quality.check_codes_resolve([(t.customer, "c_nationkey", "customer"), (t.supplier, "s_nationkey", "supplier")], aliases)


@query(
    "check_overlap",
    f"""WITH x AS (SELECT * FROM ({TENURES_SQL}) WHERE NOT is_interim) SELECT a.o_custkey, a.first_period AS earlier, b.first_period AS later FROM x a JOIN x b ON a.o_custkey = b.o_custkey AND b.first_period > a.first_period AND b.start_date <= a.end_date""",
)
def check_overlap(t: Tables) -> DataFrame:
    return quality.check_overlap(tenure_collapse(t).where("not is_interim"), ["o_custkey"], "first_period", "start_date", "end_date")


SPANS_SQL = f"(SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS opens, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 17 = 0 THEN 9 ELSE o_orderkey % 3 END AS INTEGER) END AS shuts FROM {HOT_SQL} WHERE o_custkey % 3 <> 1)"


@query(
    "check_overlap_split",
    f"""SELECT a.o_custkey, a.o_orderkey AS earlier, b.o_orderkey AS later FROM {SPANS_SQL} a JOIN {SPANS_SQL} b ON a.o_custkey = b.o_custkey AND (a.opens, a.o_orderkey) < (b.opens, b.o_orderkey) AND b.opens <= a.shuts""",
)
def check_overlap_split(t: Tables) -> DataFrame:
    """Short spans of time, most of them one customer's, some without an end: who overlaps whom."""
    days = F.when(F.col("o_orderkey") % 17 == 0, F.lit(9)).otherwise(F.col("o_orderkey") % 3).cast("int")
    opens = F.col("o_orderdate").cast("date")
    rows = _hot(t).where("o_custkey % 3 <> 1").select("o_custkey", F.struct(opens.alias("d"), "o_orderkey").alias("at"), opens.alias("opens"), F.when(F.col("o_orderkey") % 50 != 0, F.date_add(opens, days)).alias("shuts"))
    return quality.check_overlap(rows, ["o_custkey"], "at", "opens", "shuts").select("o_custkey", F.col("earlier.o_orderkey").alias("earlier"), F.col("later.o_orderkey").alias("later"))


@query("check_order", "SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate")
def check_order(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")
    return quality.check_order(rows, "o_orderdate", "l_shipdate")


@query(
    "check_bijection",
    """SELECT 'p_brand' AS side, p_brand AS value, count(DISTINCT p_size) AS n FROM part GROUP BY p_brand HAVING count(DISTINCT p_size) > 1 UNION ALL
    SELECT 'p_size', CAST(p_size AS VARCHAR), count(DISTINCT p_brand) FROM part GROUP BY p_size HAVING count(DISTINCT p_brand) > 1""",
)
def check_bijection(t: Tables) -> DataFrame:
    return quality.check_bijection(t.part, "p_brand", "p_size")


CHAIN_SQL = "SELECT DISTINCT c_mktsegment AS domain, concat('N', c_nationkey) AS source_value, concat('N', (c_nationkey + c_custkey % 2 * 5) % 25) AS canonical_value FROM customer"


@query(
    "check_chain",
    f"""SELECT a.domain, a.source_value, a.canonical_value FROM ({CHAIN_SQL}) a JOIN ({CHAIN_SQL}) b ON a.domain = b.domain AND a.canonical_value = b.source_value AND b.source_value <> b.canonical_value""",
)
def check_chain(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("c_mktsegment AS domain", "concat('N', c_nationkey) AS source_value", "concat('N', (c_nationkey + c_custkey % 2 * 5) % 25) AS canonical_value").distinct()
    return quality.check_chain(rows)


@query(
    "check_one_name",
    """SELECT p_brand, string_agg(p_type, ', ' ORDER BY p_type) AS names, count(*) AS n FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_type NOT ILIKE '%steel%') GROUP BY p_brand HAVING count(*) > 1""",
)
def check_one_name(t: Tables) -> DataFrame:
    return quality.check_one_name(t.part, "p_brand", "p_type", "%steel%")


@query(
    "check_labels",
    f"""SELECT o_orderkey, winner, loser, expected, problem FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE winner END AS expected, 'winner' AS problem FROM ({SIDES_SQL})) WHERE winner IS DISTINCT FROM expected""",
)
def check_labels(t: Tables) -> DataFrame:
    rows = winners_losers(t).withColumn("expected", F.when(F.col("o_orderkey") % 5 != 0, F.col("winner")))
    return quality.check_labels(rows, {"winner": "expected"}).select("o_orderkey", "winner", "loser", "expected", "problem")


# -- reports


@query(
    "average_by_flag",
    "SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS price, round(avg(l_discount), 6) AS discount, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY 1, 2",
)
def average_by_flag(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(F.round(F.avg("l_extendedprice"), 4).alias("price"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count("*").alias("n")).orderBy("l_returnflag", "l_linestatus")
    )


@query(
    "join_two_facts",
    """SELECT c_mktsegment, year(o_orderdate) AS y, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def join_two_facts(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rows.groupBy("c_mktsegment", F.year("o_orderdate").cast("bigint").alias("y")).agg(F.count("*").alias("n"), F.round(revenue, 2).alias("revenue"))


@query(
    "share_in_period",
    "SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY year(o_orderdate), o_custkey), 6) AS share FROM orders",
)
def share_in_period(t: Tables) -> DataFrame:
    whole = F.sum("o_totalprice").over(Window.partitionBy(F.year("o_orderdate"), "o_custkey"))
    return t.orders.select("o_orderkey", F.round(F.col("o_totalprice") / whole, 6).alias("share"))


@query("row_hashes", "SELECT event_id, md5(concat_ws('|', event_type, CAST(user_id AS VARCHAR), coalesce(nullif(event_type, 'view'), ''))) AS id FROM events")
def row_hashes(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type", "user_id", F.nullif(F.col("event_type"), F.lit("view")).alias("k")).select("event_id", row_hash(["event_type", "user_id", "k"]).alias("id"))


@query("likely_aliases")
def likely_aliases(t: Tables) -> DataFrame:
    return staff_ops.likely_aliases(t.nation.select(F.col("n_name").alias("name")).union(t.region.select("r_name")).union(t.nation.select(F.initcap("n_name"))))


LINK_SQL = r"regexp_replace({}, '\[\[(?:[^|\]]*\|)?([^\]]*)\]\]', '\1', 'g')"
MARKED = "concat('[[A|', page_id, ']] <ref name=x>[[gone]]</ref>{{t|1}}<ref b/> ', html, ' [[B]]')"


@query(
    "clean_markup",
    f"""SELECT page_id, trim(regexp_replace({LINK_SQL.format(f"regexp_replace({LINK_SQL.format(MARKED)}, '(?s)<ref[^>]*/>|<ref[^>]*>.*?</ref>', '', 'g')")}, '{{{{[^}}]*}}}}|<[^>]+>', '', 'g')) AS plain FROM pages""".replace("'{{[^}]*}}|", r"'\{\{[^}]*\}\}|"),
)
def clean_markup(t: Tables) -> DataFrame:
    return t.pages.select("page_id", staff_text.clean(F.expr(MARKED)).alias("plain"))


from lakeward import landing, league  # noqa: E402, F401  their queries are added to QUERIES

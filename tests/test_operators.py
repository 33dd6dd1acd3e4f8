import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.expressions import part_of_day, rounded
from lakeward.functions.types import store_type, widened_type
from lakeward.operators import identity, islands, merge, retype, serving, staff
from lakeward.operators import quality as q

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "old,new,want",
    [
        (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.DoubleType(), T.LongType(), None),
        (T.LongType(), T.DateType(), T.StringType()),
        (T.BooleanType(), T.LongType(), T.LongType()),
        (T.StringType(), T.LongType(), None),
        (T.LongType(), T.LongType(), None),
        (T.DateType(), T.StringType(), T.StringType()),
    ],
)
def test_widening(old, new, want):
    assert widened_type(old, new) == want


def test_stored_types():
    assert store_type(T.ShortType()) == T.LongType()
    assert store_type(T.DecimalType(9, 2)) == T.DoubleType()
    assert store_type(T.NullType()) == T.StringType()
    for nested in (T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.LongType()), T.StructType()):
        with pytest.raises(TypeError):
            store_type(nested)


def test_halves_round_to_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.7,), (None,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"), "smallint")).collect()] == [2, 4, -3, None]


def test_inferred_casts(spark):
    data = [(1.0, 3.0, 70000, None, "2024-01-02", 1, 1.5, "07:05"), (0.0, 1.0, 5, None, "2024-02-03", 0, 2.5, "13:00")]
    df = spark.createDataFrame(data, "f double, season double, big long, nothing double, day string, div long, height double, at string")
    hints = retype.Hints(not_flags=frozenset({"season"}), dates=frozenset({"day"}), long_flags=frozenset({"div"}), round_first=frozenset({"height"}), times=frozenset({"at"}))
    casts = retype.infer_casts(df, hints)
    assert casts == {"f": "boolean", "season": "smallint", "big": "int", "nothing": "double", "day": "date", "div": "boolean", "height": "smallint", "at": "time"}
    first = retype.typed_copy(df, casts).first()
    assert (first.f, first.season, first.big, first.day, first.div, first.height, first.at) == (True, 3, 70000, D(2024, 1, 2), True, 2, "07:05")


def test_latest_copy_wins(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("b", 2)], "k string, at int")
    assert rows(retype.latest_by(df, ["k"], [F.desc("at")])) == [("a", 3), ("b", 2)]


def test_row_id_hides_nulls(spark):
    df = retype.row_id(spark.createDataFrame([(None, "x"), ("", "x")], "a string, b string"))
    assert len({r._row_id for r in df.collect()}) == 1


def test_only_new_is_strict(spark):
    src = spark.createDataFrame([(1,), (2,), (3,)], "at int")
    assert rows(merge.only_new(src, src.where("at <= 2"), "at")) == [(3,)]
    assert merge.only_new(src, src.limit(0), "at").count() == 3
    assert merge.only_new(src, None, "at").count() == 3


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, created int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 9)], "k int, v string, created int")
    assert rows(merge.upsert(old, new, ["k"])) == [(1, "a", 0), (2, None, 9), (3, "c", 9)]
    assert rows(merge.upsert(old, new, ["k"], ["v"])) == [(1, "a", 0), (2, None, 0), (3, "c", 9)]
    with pytest.raises(ValueError):
        merge.upsert(old, new.union(new), ["k"])


def test_change_detection(spark):
    old = spark.createDataFrame([(1, None, "x", 5), (2, None, "x", 5), (3, "a", "x", 5)], "k int, a string, b string, created_at int")
    new = spark.createDataFrame([(1, None, "x"), (2, "v", "x"), (3, "a", None), (4, "n", "n")], "k int, a string, b string")
    got = merge.changed_only(new, old, ["k"], ["a", "b"], 7)
    assert rows(got) == [(2, "v", "x", 5, 7), (3, "a", None, 5, 7), (4, "n", "n", 7, 7)]


def names(spark, *aliases):
    return spark.createDataFrame([(a,) for a in aliases], "alias string")


def mappings(spark, *pairs):
    return spark.createDataFrame(list(pairs), "source_value string, canonical_value string")


def held(spark, *r):
    return spark.createDataFrame(list(r), identity.IDENTITY)


def test_identity_first_and_second_run(spark):
    m = mappings(spark, ("Bob", "Robert"))
    first = identity.identity_rows(names(spark, "Zed", "Robert", None), m, held(spark), 0)
    assert rows(first) == [("Bob", 1, "Robert", "reference_mappings"), ("Robert", 1, "Robert", "canonical"), ("Zed", 2, "Zed", "canonical")]
    again = identity.identity_rows(names(spark, "Zed", "Robert"), m, held(spark, *rows(first)), 2)
    assert again.count() == 0
    assert identity.next_high_water(first, 0) == 2


def test_identity_merge_keeps_the_canonical_id(spark):
    old = held(spark, ("A", 1, "A", "canonical"), ("B", 2, "B", "canonical"))
    got = identity.identity_rows(names(spark, "A", "B"), mappings(spark, ("A", "B")), old, 2)
    assert rows(got) == [("A", 2, "B", "reference_mappings")]
    later = identity.identity_rows(names(spark, "C"), mappings(spark), held(spark, ("A", 2, "B", "reference_mappings"), ("B", 2, "B", "canonical")), 2)
    assert rows(later) == [("C", 3, "C", "canonical")]


def test_identity_inherits_only_undivided_ids(spark):
    old = held(spark, ("A", 1, "A", "canonical"))
    assert rows(identity.identity_rows(names(spark, "A"), mappings(spark, ("A", "New")), old, 1)) == [("A", 1, "New", "reference_mappings")] or rows(
        identity.identity_rows(names(spark, "A", "New"), mappings(spark, ("A", "New")), old, 1)
    ) == [("A", 1, "New", "reference_mappings"), ("New", 1, "New", "canonical")]
    shared = held(spark, ("A", 1, "Old", "reference_mappings"), ("B", 1, "Old", "reference_mappings"))
    got = identity.identity_rows(names(spark, "A", "B", "New"), mappings(spark, ("A", "New"), ("B", "B2")), shared, 1)
    assert {r[2]: r[1] for r in rows(got)} == {"B2": 2, "New": 3}


def test_alias_pairs(spark):
    keys = spark.createDataFrame([("g1", "x"), ("g2", "x"), ("g3", "y"), ("g4", "g4")], "key string, other string")
    assert rows(identity.alias_pairs(keys, "key", "other")) == [("g1", "g1"), ("g2", "g2"), ("g3", "g3"), ("g4", "g4"), ("y", "g3")]


def test_islands_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a"), (1, 4, "b"), (1, 5, "a")], "p int, t int, v string")
    assert [r.run_no for r in islands.islands(df, ["p"], ["t"], "v").orderBy("t").collect()] == [0, 0, 1, 2, 3]


def season(s, first=None, last=None, start=False, end=False, interim=False):
    return ("c", interim, s, start, first or D(s, 3, 1), "log", end, last or D(s, 12, 31), "log")


TENURE = "who string, is_interim boolean, season int, explicit_start boolean, start_date date, start_source string, explicit_end boolean, end_date date, end_source string"


def collapsed(spark, *r, latest=2030):
    got = islands.collapse(spark.createDataFrame(list(r), TENURE), ["who", "is_interim"], "season", latest)
    return [(x.first_period, x.last_period, x.end_source) for x in got.orderBy("is_interim", "first_period").collect()]


def test_collapse(spark):
    assert collapsed(spark, season(2001), season(2002), season(2003)) == [(2001, 2003, "log")]
    assert collapsed(spark, season(2001), season(2003)) == [(2001, 2001, "log"), (2003, 2003, "log")]
    assert collapsed(spark, season(2001, end=True), season(2002)) == [(2001, 2001, "log"), (2002, 2002, "log")]
    assert collapsed(spark, season(2001), season(2002, start=True)) == [(2001, 2001, "log"), (2002, 2002, "log")]
    assert collapsed(spark, season(2001), season(2002, interim=True)) == [(2001, 2001, "log"), (2002, 2002, "log")]
    assert collapsed(spark, season(2001), season(2002), latest=2002) == [(2001, 2002, "ongoing")]
    assert collapsed(spark, season(2001), season(2002, end=True), latest=2002) == [(2001, 2002, "log")]


def test_calendar_over_a_missing_season(spark):
    df = spark.createDataFrame([("t", 2001, D(2001, 9, 1)), ("t", 2001, D(2002, 1, 5)), ("t", 2003, D(2003, 9, 9))], "team string, season int, day date")
    assert rows(islands.period_starts(df, "team", "season", "day")) == [(2001, "t", D(2001, 9, 1), D(2002, 1, 5)), (2003, "t", D(2002, 1, 6), D(2003, 9, 9))]


def test_undated_interim_leaves_boundaries_open(spark):
    staff_ = [("t", 2001, "lead", "oc", False, None, None), ("t", 2001, "sub", "oc", True, None, None)]
    rec = spark.createDataFrame(staff_, "team string, season int, who string, role string, is_interim boolean, start_date date, end_date date")
    cal = spark.createDataFrame([("t", 2001, D(2001, 2, 1), D(2002, 1, 1))], "team string, season int, first_day date, last_day date")
    got = {r.who: r for r in islands.recorded_rows(rec, cal, ["team", "season"], "who", "role").collect()}
    assert (got["lead"].start_date, got["lead"].end_date, got["lead"].end_source) == (D(2001, 2, 1), None, None)
    assert (got["sub"].start_date, got["sub"].start_source, got["sub"].end_date) == (None, None, D(2002, 1, 1))


@pytest.mark.parametrize("at,want", [("12:59", "morning"), ("13:00", "noon"), ("14:59", "noon"), ("15:00", "afternoon"), ("17:59", "afternoon"), ("18:00", "night"), (None, None)])
@pytest.mark.parametrize("day", ["2024-01-10", "2024-07-10"])
def test_part_of_day(spark, day, at, want):
    df = spark.createDataFrame([(at and f"{day} {at}:00",)], "t string").select(part_of_day(F.to_timestamp_ntz("t")))
    assert df.first()[0] == want


SURFACE = serving.Surface({"a": "a"}, {"low": "b"}, {"high": "b"}, {"side": ("a", "b")}, {"has_b": "b"}, {"b": "b"}, "k", 100)


@pytest.fixture(scope="module")
def paged(spark):
    return spark.createDataFrame([(1, 1, 5), (2, 5, None), (3, 2, 7), (4, 1, None)], "k int, a int, b int")


def keys(df):
    return [r.k for r in df.collect()]


def test_pages(paged):
    page = lambda f, **o: keys(serving.page(paged, SURFACE, serving.PageQuery(f, **o)))
    assert page({}, sort="b") == [1, 3, 2, 4] and page({}, sort="b", descending=True) == [3, 1, 4, 2]
    assert page({"a": 1}) == [1, 4] and page({"low": 6}) == [3] and page({"high": 6}) == [1]
    assert page({"side": 5}) == [1, 2] and page({"has_b": False}) == [2, 4] and page({"has_b": None}) == [1, 2, 3, 4]
    assert page({}, offset=9) == [] and serving.total(paged, SURFACE, serving.PageQuery({}, offset=9)).first()[0] == 4


@pytest.mark.parametrize("query", [{"filters": {"zzz": 1}}, {"sort": "zzz"}, {"limit": 0}, {"limit": 101}, {"offset": -1}])
def test_invalid_pages(paged, query):
    with pytest.raises(serving.Invalid):
        serving.page(paged, SURFACE, serving.PageQuery(**query))


def test_children(spark, paged):
    child = spark.createDataFrame([(1, "x"), (1, "w")], "k int, name string")
    assert serving.children_of(paged, child, "k", 99, ["name"]) is None
    assert serving.children_of(paged, child, "k", 2, ["name"]) == []
    assert [r.name for r in serving.children_of(paged, child, "k", 1, ["name"])] == ["w", "x"]
    assert [len(r.kids) for r in serving.nested(paged, child, "k", ["name"], "kids").orderBy("k").collect()] == [2, 0, 0, 0]
    assert serving.health(None) is None


def test_checks_pass_and_fail(spark):
    ok = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    bad = spark.createDataFrame([(1, "a"), (1, "z"), (None, "a")], "k int, v string")
    assert q.check_unique(ok, ["k"]).count() == 0 and rows(q.check_unique(bad, ["k"])) == [(1, 2)]
    assert q.check_not_null(ok, ["k"]).count() == 0 and q.check_not_null(bad, ["k"]).count() == 1
    assert q.check_primary_key(ok, ["k"]).count() == 0 and q.check_primary_key(bad, ["k"]).count() == 2
    assert q.check_accepted(ok, "v", ["a"]).count() == 0 and rows(q.check_accepted(bad, "v", ["a"])) == [("z", 1)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert q.check_relationship(bad, "k", parent, "id").count() == 0 and rows(q.check_relationship(ok, "k", parent, "id")) == [(2, 1)]
    spans = spark.createDataFrame([("a", 1, 1, 5), ("a", 2, 5, 6), ("b", 1, 1, None)], "k string, o int, s int, e int")
    assert rows(q.check_overlap(spans, ["k"], "o", "s", "e")) == [("a", 1, 2)] and q.check_order(spans, "s", "e").count() == 0


def test_overrides(spark):
    kinds = "season int, team string, role string, coach string, flags string"
    parsed = spark.createDataFrame([(2001, "A", "hc", "x", None), (2001, "A", "oc", "y", None)], kinds)
    fixes = spark.createDataFrame([(2001, "A", "hc", "new", None), (1999, "A", "hc", "old", None)], kinds)
    assert rows(staff.with_overrides(parsed, fixes)) == [(2001, "A", "hc", "new", "override"), (2001, "A", "oc", "y", None)]
    assert staff.with_overrides(parsed.limit(0), fixes).count() == 2


def test_likely_aliases(spark):
    df = spark.createDataFrame([("Jon Smith",), ("John Smith",), ("Jane Doe",), ("Mary Smith",)], "name string")
    assert [(r.a, r.b) for r in staff.likely_aliases(df).collect()] == [("John Smith", "Jon Smith")]


def test_likely_aliases_of_all_pairs(spark):
    df = spark.createDataFrame([("Jon Smith",), ("John Smyth",), ("Geoff Schwarz",), ("Jeff Schwartz",), ("Al Ray Jr.",), ("Al Ray",)], "name string")
    assert {(r.a, r.b) for r in staff.likely_aliases(df).collect()} == {("John Smyth", "Jon Smith"), ("Geoff Schwarz", "Jeff Schwartz"), ("Al Ray", "Al Ray Jr.")}


def test_ids_are_minted_in_ranges(spark):
    names = spark.range(3000).selectExpr("concat('n', id * 7919 % 3000) as name").repartition(5)
    got = {r.name: r.id for r in identity.mint_ids(names, 10).collect()}
    assert got == {n: 11 + k for k, n in enumerate(sorted(f"n{i}" for i in range(3000)))}
    assert identity.mint_ids(names.limit(0), 10).count() == 0

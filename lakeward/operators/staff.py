"""Curated corrections of parsed staff entries, and likely aliases among names."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.sources.scratch import staged

from .dimensions import unpivot

# Fixed value: endings that do not count.
SUFFIX = re.compile(r"\s+(jr|sr|ii|iii|iv)\.?$")


def with_overrides(parsed: DataFrame, overrides: DataFrame, season: str = "season", keys: tuple[str, ...] = ("season", "team", "role")) -> DataFrame:
    """Parsed rows, those of an overridden key replaced by the overrides of seasons that were parsed;
    all overrides if nothing was parsed."""
    loaded = parsed.select(season).distinct()
    mine = overrides if not parsed.head(1) else overrides.join(loaded, season, "left_semi")
    flagged = mine.select(*parsed.columns).withColumn("flags", F.lit("override")) if "flags" in parsed.columns else mine.select(*parsed.columns)
    return parsed.join(mine.select(*keys).distinct(), [*keys], "left_anti").select(*parsed.columns).unionByName(flagged)


def week_days(games: DataFrame) -> DataFrame:
    """(season, team, week, day) of regular games, one row for each side."""
    regular = games.where("game_type = 'REG'")
    side = lambda c: {"season": "season", "team": c, "week": "week", "day": "gameday"}
    return unpivot(regular, [side("home_team"), side("away_team")])


def _gram_pairs(names: DataFrame) -> DataFrame:
    """Pairs (a, b) of names with p and q, their plain forms, that may reach a ratio of 0.8.

    Names that match that well in more than five characters together share two that stand
    side by side: were all matched characters apart, there would be a gap for each but one,
    more than a fifth of all characters allows. Of n neighbours at least n / 3 - 1 are shared, so
    the rarest two thirds of each name hold one of them. Two forms of at most four characters match that
    well if they are equal or one is the other without a character, so they meet in such forms."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("p") - 1, F.lit(1))), lambda i: F.substring(F.col("p"), i, F.lit(2))))
    each = names.select("a", "p", F.explode(grams).alias("g"))
    seen = each.join(each.groupBy("g").agg(F.count("*").alias("df")), "g")
    rank = F.row_number().over(Window.partitionBy("a").orderBy("df", "g"))
    size = F.count("*").over(Window.partitionBy("a"))
    repeats = F.length("p") - 1 - F.col("size")  # neighbours that stand more than once
    marks = seen.withColumn("rank", rank).withColumn("size", size).where(F.col("rank") <= F.ceil(F.lit(2) * F.col("size") / 3) + 2 + repeats).select("a", "p", F.col("g").alias("mark"))
    spared = F.explode(F.sequence(F.lit(0), F.length("p")))
    short = names.where("length(p) <= 4").select("a", "p", spared.alias("i")).select("a", "p", F.concat(F.lit("="), without(F.col("p"), F.col("i"))).alias("mark")).distinct()
    x = marks.unionByName(short)
    y = x.select(F.col("a").alias("b"), F.col("p").alias("q"), "mark")
    fits = "a < b and 3 * least(length(p), length(q)) >= 2 * greatest(length(p), length(q))"
    return x.join(y, "mark").where(fits).select("a", "b", "p", "q").distinct()


def likely_aliases(names: DataFrame, column: str = "name", strong: float = 0.8, weak: float = 0.6, mapped: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b, ratio) of names that may be one person's, the likeliest first: their plain forms, a to z
    and blanks without suffixes such as Jr., are similar as a whole, or somewhat similar with the same last word and initial
    of the names as they stand. Names that mapped(source_value) holds are settled and left out. No pair is lost: see _gram_pairs
    for `strong` (0.8 at least), and `weak` pairs meet under their last word and initial."""
    if strong < 0.8:
        raise ValueError("the pairing is complete for 0.8 and above")
    plain = F.regexp_replace(F.regexp_replace(F.trim(F.lower("a")), SUFFIX.pattern, ""), "[^a-z ]", "")
    keyed = names.select(F.col(column).alias("a")).where("a is not null").distinct().withColumn("p", plain)
    if mapped is not None:
        keyed = keyed.join(mapped.select(F.col("source_value").alias("a")), "a", "left_anti")
    whole = F.lower("a")
    kin = keyed.where("trim(a) <> ''").withColumn("mark", F.concat(F.left(whole, F.lit(1)), F.lit(" "), F.element_at(F.split(F.trim(whole), r"\s+"), -1)))
    other = kin.select(F.col("a").alias("b"), F.col("p").alias("q"), "mark")
    related = kin.join(other, "mark").where("a < b").select("a", "b", "p", "q", F.lit(True).alias("same"))
    pairs = _gram_pairs(keyed).withColumn("same", F.lit(False)).unionByName(related).groupBy("a", "b", "p", "q").agg(F.bool_or("same").alias("same"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for x, y, p, q, same in frame[["a", "b", "p", "q", "same"]].itertuples(index=False):
                r = difflib.SequenceMatcher(None, p, q).ratio()
                if r >= strong or same and r >= weak:
                    rows.append((x, y, r))
            yield pd.DataFrame(rows, columns=["a", "b", "ratio"])

    return pairs.mapInPandas(run, "a string, b string, ratio double").orderBy(F.desc("ratio"), "a", "b")


def without(text: Column, i: Column) -> Column:
    """The text without its i-th character; 0 leaves it whole."""
    return F.when(i == 0, text).otherwise(F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))


def edit_pairs(names: DataFrame, column: str = "name", most: int = 1) -> DataFrame:
    """Pairs (a, b, distance) of distinct names at most `most` edits apart, which then share a form
    with at most so many characters left out. Forms are rows, written once and joined with themselves."""
    forms = names.select(F.col(column).alias("a")).where("a is not null").distinct().withColumn("form", F.col("a"))
    for _ in range(most):
        forms = forms.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("form")))).select("a", without(F.col("form"), F.col("i")).alias("form")).distinct()
    each = staged(forms)
    both = each.join(each.select(F.col("a").alias("b"), "form"), "form").where("a < b").select("a", "b").distinct()
    return both.withColumn("distance", F.levenshtein("a", "b", most)).where(F.col("distance").between(0, most))

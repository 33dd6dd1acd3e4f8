"""Staff lists from a wiki: pages are fetched by title, parsed, and corrected by hand-kept rows.

Fetching is driver work by nature: a few hundred small texts a season, one request a second.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import batched, chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import staff_text
from lakeward.operators.staff import week_days, with_overrides

# What the source allows.
TITLES_AT_ONCE = 50
TRIES, FIRST_PAUSE, LONGEST_PAUSE, SPACING = 6, 10.0, 120.0, 1.0
BUSY = (429, 503)


class Busy(Exception):
    """The server asks to come back later."""

    def __init__(self, seconds: float | None = None):
        super().__init__(f"busy, come back in {seconds} s")
        self.seconds = seconds


def http_get(url: str, agent: str) -> dict:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=30) as r:
            return json.loads(r.read())
    except urllib.error.HTTPError as e:
        if e.code in BUSY:
            after = e.headers.get("Retry-After", "")
            raise Busy(float(after) if after.isdigit() else None) from e
        raise


@dataclass
class Wiki:
    """Pages by title. `get` answers a request's parameters; requests are spaced, and a busy
    server is asked again after the pause it names or one that doubles."""

    get: Callable[[dict], dict]
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _next: float = field(default=0.0, init=False)

    def ask(self, **params) -> dict:
        pause = FIRST_PAUSE
        for left in reversed(range(TRIES)):
            self.sleep(max(0.0, self._next - self.clock()))
            self._next = self.clock() + SPACING
            try:
                return self.get(params)
            except Busy as e:
                if not left:
                    raise
                if e.seconds is not None:
                    self.sleep(e.seconds)
                    continue
                self.sleep(pause)
                pause = min(2 * pause, LONGEST_PAUSE)
        raise AssertionError

    def answers(self, titles: Iterable[str]) -> Iterator[dict]:
        for some in batched(titles, TITLES_AT_ONCE):
            asked = {"action": "query", "prop": "revisions", "rvprop": "content", "rvslots": "main", "redirects": 1, "format": "json", "formatversion": 2}
            yield self.ask(titles="|".join(some), **asked)["query"]

    def texts(self, titles: Iterable[str]) -> dict[str, str | None]:
        """Title to wikitext, None for a missing page. Other spellings and redirects, told by whatever
        answer, lead from title to title until one is a page's own; those that lead in a circle have none."""
        wanted = [*dict.fromkeys(titles)]
        moved: dict[str, str] = {}
        held: dict[str, str] = {}
        for answer in self.answers(wanted):
            for step in chain(answer.get("normalized", ()), answer.get("redirects", ())):
                moved[step["from"]] = step["to"]
            for page in answer.get("pages", ()):
                if not page.get("missing"):
                    held[page["title"]] = page["revisions"][0]["slots"]["main"]["content"]
        return {t: held.get(last_of(t, moved)) for t in wanted}


def last_of(title: str, moved: dict[str, str]) -> str:
    """Where a chain of moves ends, or closes on itself."""
    passed: set[str] = set()
    while title in moved and title not in passed:
        passed.add(title)
        title = moved[title]
    return title


def wiki(api: str, agent: str) -> Wiki:
    return Wiki(lambda params: http_get(f"{api}?{urllib.parse.urlencode(params)}", agent))


STAFF = "season int, team string, role string, title string, person string, is_interim boolean, note string, start_date date, end_date date, flags string"


def load_staff(
    spark: SparkSession, source: Wiki, season: int, schedules: DataFrame, teams: DataFrame, templates: tuple[str, ...], renamed: tuple = (), overrides: DataFrame | None = None
) -> DataFrame:
    """Staff entries of one season: the article of each team that plays in it, by its name in
    that season, parsed and corrected by the overrides."""
    played = schedules.where(F.col("season") == season)
    codes = played.select(F.explode(F.array("home_team", "away_team")).alias("team")).distinct()
    named = codes.join(teams.select(F.col("team_abbr").alias("team"), "team_name"), "team", "left")
    title = staff_text.article_title(F.col("team"), F.coalesce("team_name", "team"), F.lit(season), renamed)
    asked = {r.team: r.title for r in named.select("team", title.alias("title")).collect()}
    got = source.texts(asked.values())
    pages = spark.createDataFrame([(season, team, got[t]) for team, t in sorted(asked.items())], "season int, team string, text string")
    parsed = staff_text.parse_pages(pages, templates, week_days(played))
    return parsed if overrides is None else with_overrides(parsed, overrides)

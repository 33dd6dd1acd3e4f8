"""Loading: a plan of steps, run with retries, then gated transformations."""

from __future__ import annotations

import heapq
import json
import logging
import socket
import threading
import time
import urllib.request
import uuid
from collections import Counter, deque
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.registry import Dataset, PeriodUnavailable
from lakeward.sources.snapshot import located

log = logging.getLogger(__name__)
#: Failures of the machine itself; trying again does not help.
LOCAL_ERRORS = (FileNotFoundError, PermissionError, IsADirectoryError, NotADirectoryError)


@dataclass(frozen=True)
class Step:
    dataset: str
    season: int | None


@dataclass
class Result:
    step: Step
    status: str
    rows: int = 0
    attempts: int = 1
    error: str | None = None


def make_plan(datasets: list[Dataset], start: int, end: int) -> list[Step]:
    return [Step(d.name, s) for d in datasets for s in (d.seasons(start, end) if d.partitioned else [None])]


def tried(step: Step, load: Callable[[Step], int]) -> tuple[str, int, str | None]:
    """(status, rows, error) of one try; status `again` says that another may help, which holds
    for what comes from outside the machine."""
    try:
        return "success", load(step), None
    except PeriodUnavailable as gone:
        return "skipped", 0, str(gone)
    except Exception as e:  # noqa: BLE001  a step's failure is its result
        outside = isinstance(e, OSError) and not isinstance(e, LOCAL_ERRORS)
        return "again" if outside else "failed", 0, str(e)


def run_step(step: Step, load: Callable[[Step], int], retries: int, delay: float, sleep: Callable[[float], None]) -> Result:
    """Waits `delay`, then twice as long each time, `retries` times at most."""
    pauses = [delay * 2**k for k in range(retries)]
    status, rows, error = tried(step, load)
    used = 0
    while status == "again" and used < len(pauses):
        sleep(pauses[used])
        used += 1
        status, rows, error = tried(step, load)
    return Result(step, "failed" if status == "again" else status, rows, 1 + used, error)


def run_plan(
    steps: list[Step], load: Callable[[Step], int], workers: int = 4, retries: int = 2, delay: float = 30, sleep: Callable[[float], None] = time.sleep
) -> list[Result]:
    """Each dataset is a queue: its next season is ready when the one before has ended, and a
    free worker takes the ready step that stands first in the plan. Results are in its order."""
    queues: dict[str, deque[int]] = {}
    for at, s in enumerate(steps):
        queues.setdefault(s.dataset, deque()).append(at)
    ready = sorted(q.popleft() for q in queues.values())
    results: list[Result | None] = [None] * len(steps)
    with ThreadPoolExecutor(max(1, workers)) as pool:
        running: dict[Future, int] = {}
        while ready or running:
            while ready and len(running) < max(1, workers):
                at = heapq.heappop(ready)
                running[pool.submit(run_step, steps[at], load, retries, delay, sleep)] = at
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                at = running.pop(ended)
                results[at] = ended.result()
                if queue := queues[steps[at].dataset]:
                    heapq.heappush(ready, queue.popleft())
    return results


def summarise(results: list[Result]) -> dict[str, int]:
    by = Counter(r.status for r in results)
    return {"success": by["success"], "skipped": by["skipped"], "failed": by["failed"], "rows": sum(r.rows for r in results)}


_ids, _latest = threading.Lock(), [0]


def new_run_id() -> str:
    """Ids that follow each other as their runs begin: microseconds since 1970, then a suffix that no other driver has."""
    with _ids:
        _latest[0] = max(_latest[0] + 1, time.time_ns() // 1000)
        return f"{_latest[0]:018d}-{uuid.uuid4().hex[:8]}"


@dataclass
class History:
    """Runs and their steps. `save` gets a run as it ends, `started`, if there is one, as it begins, with
    status `running`. Recording is best effort: its errors are logged, not raised."""

    save: Callable[[dict], None]
    runs: list[dict] = field(default_factory=list)
    started: Callable[[dict], None] | None = None

    def begin(self, kind: str, args: dict) -> dict:
        run = {"run_id": new_run_id(), "kind": kind, "status": "running", "args": json.dumps(args), "host": socket.gethostname(), "began": time.time(), "steps": [], "error": None}
        if self.started:
            self._told(self.started, run)
        return run

    def end(self, run: dict, status: str, results: list[Result], error: str | None = None) -> None:
        steps = [vars(r) | {"step": vars(r.step)} for r in results]
        ended = run | {"status": status, "steps": steps, "seconds": time.time() - run["began"], "error": error}
        if self._told(self.save, ended):
            self.runs.append(ended)

    def record(self, kind: str, status: str, results: list[Result], args: dict) -> None:
        self.end(self.begin(kind, args), status, results)

    def _told(self, save: Callable[[dict], None], run: dict) -> bool:
        try:
            save(run)
        except Exception:  # noqa: BLE001
            log.exception("the run could not be recorded")
            return False
        return True


class RunLog:
    """Runs and steps as two tables under `path`. A run adds a row as it begins and one as it ends, in files of
    its own, so writers never meet; `save` is what a History calls. Ids rise with time, so
    `serving.latest_runs` and `serving.health` read `runs` in their order."""

    RUNS = "run_id string, kind string, status string, args string, host string, seconds double, error string, recorded_at timestamp"
    STEPS = "run_id string, position int, dataset string, season int, status string, n_rows bigint, attempts int, error string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, run: dict) -> None:
        run_id = run.get("run_id") or new_run_id()
        steps = [(run_id, k, r["step"]["dataset"], r["step"]["season"], r["status"], r["rows"], r["attempts"], r["error"]) for k, r in enumerate(run["steps"])]
        if steps:
            self._add("steps", self.spark.createDataFrame(steps, self.STEPS))
        row = (run_id, *(run.get(c) for c in ("kind", "status", "args", "host", "seconds", "error")))
        self._add("runs", self.spark.createDataFrame([row], self.RUNS.rpartition(",")[0]).withColumn("recorded_at", F.current_timestamp()))

    def _add(self, name: str, df: DataFrame) -> None:
        df.coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        fs, path = located(self.spark, f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if fs.exists(path) else self.spark.createDataFrame([], schema)

    def runs(self) -> DataFrame:
        """One row a run: how it ended, or that it is running."""
        names = [c.split()[0] for c in self.RUNS.split(", ")]
        state = F.struct((F.col("status") != "running").alias("over"), "recorded_at", *(c for c in names if c not in ("run_id", "recorded_at")))
        latest = self._read("runs", self.RUNS).groupBy("run_id").agg(F.max(state).alias("s"))
        return latest.select("run_id", *(f"s.{c}" for c in names[1:]))

    def steps(self) -> DataFrame:
        """Steps of recorded runs; those of a run that broke off in writing are left out."""
        return self._read("steps", self.STEPS).join(self.runs().select("run_id"), "run_id", "left_semi")


def notify(url: str | None, text: str, post: Callable[[str, bytes], None] | None = None) -> bool:
    """Posts to a webhook; never raises."""
    if not url:
        return False

    def send(to: str, body: bytes) -> None:
        urllib.request.urlopen(urllib.request.Request(to, body, {"Content-Type": "application/json"}), timeout=10).close()

    try:
        (post or send)(url, json.dumps({"text": text, "content": text}).encode())
    except Exception:  # noqa: BLE001
        log.exception("the webhook failed")
        return False
    return True


def run_pipeline(
    steps: list[Step],
    load: Callable[[Step], int],
    transform: Callable[[], int],
    truncate: Callable[[list[str]], None],
    history: History | None = None,
    tell: Callable[[str], None] = lambda _: None,
    kind: str = "refresh",
    tell_success: bool = False,
    **options,
) -> int:
    """Loads, transforms if nothing failed, clears the landing tables if that went well,
    records and tells. 0: all went well."""
    run = history.begin(kind, options and {k: str(v) for k, v in options.items()}) if history else {}
    results: list[Result] = []
    try:
        results = run_plan(steps, load, **options)
        counts, code = summarise(results), 0
        if counts["failed"]:
            code = 1
        else:
            code = transform()
            if code == 0:
                try:
                    truncate(sorted({r.step.dataset for r in results if r.status == "success"}))
                except Exception:  # noqa: BLE001  the data is already transformed
                    log.exception("landing tables could not be cleared")
    except BaseException as e:
        if history:
            history.end(run, "failed", results, str(e))
        raise
    status = "success" if code == 0 else "failed"
    if history:
        history.end(run, status, results, next((r.error for r in results if r.status == "failed"), None))
    if code or tell_success:
        tell(f"run {status}: {counts}")
    return code

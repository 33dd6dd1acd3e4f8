"""Tables as immutable snapshots: every write makes a version, readers keep theirs."""

from __future__ import annotations

import json
import threading
import urllib.parse
import uuid
from collections import defaultdict
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.types import store_type, widened_type

#: Stands for null in the names of partitions.
NULL_VALUE = "__null__"
_locks: dict[str, threading.RLock] = defaultdict(threading.RLock)


class Conflict(Exception):
    """Another writer was first; the write can be tried again on the new version."""


def located(spark: SparkSession, name: str):
    """The file system and the path of `name`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def publish(spark: SparkSession, name: str, text: str) -> None:
    """Makes the file `name` with this text, whole, by a rename that fails with Conflict if it is there already.
    That holds where renames are exclusive: on HDFS and on disks, not on object stores."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    fs, final = located(spark, name)
    fs.mkdirs(final.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(final), options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise Conflict(f"another writer was first with {name}") from e
        raise


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder of published ones, in order; none if the folder is missing."""
    fs, path = located(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n for n in names if not n.startswith("."))


class Table:
    """A table under `path`. Each version is a list of folders, one for each value of the
    partition column or one for all rows, that is written last: readers keep their version,
    a write touches the folders it replaces only, and of two drivers that write the same
    version the file system lets one succeed."""

    def __init__(self, spark: SparkSession, path: str, partition: str | None = None, lookup: tuple[str, ...] = ()):
        """`lookup` names columns that single rows are asked for by: files are sorted by the first, so few
        row groups can hold a value of it, and have a Bloom filter for each."""
        self.spark, self.path, self.partition, self.lookup = spark, path.rstrip("/"), partition, lookup

    @property
    def lock(self) -> threading.RLock:
        return _locks[self.path]

    def _file(self, name: str):
        return located(self.spark, f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        fs, path = self._file(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def version(self) -> int:
        return max((int(n[:-5]) for n in self._names("_versions") if n.endswith(".json")), default=0)

    def exists(self) -> bool:
        return self.version() > 0

    def parts(self, version: int | None = None) -> dict[str, str]:
        """Partition value, as text, to folder; `*` is the folder of a table without partitions."""
        name = f"{self.path}/_versions/{version or self.version():09d}.json"
        return json.loads(self.spark.read.text(name, wholetext=True).first()[0])["parts"]

    def read(self, version: int | None = None) -> DataFrame:
        known = json.loads(self.spark.read.text(f"{self.path}/_versions/{version or self.version():09d}.json", wholetext=True).first()[0])
        schema = T.StructType.fromJson(known["schema"])
        if not known["parts"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in known["parts"].values()))

    def schema(self) -> dict[str, str]:
        """Name to type; empty if the table does not exist."""
        return dict(self.read().dtypes) if self.exists() else {}

    def _writer(self, df: DataFrame, shadow: str | None = None) -> DataFrameWriter:
        if not self.lookup:
            return df.write
        by = [c for c in (shadow, self.lookup[0]) if c]
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.lookup}
        return df.repartitionByRange(*by).sortWithinPartitions(*by).write.options(**options)

    def _data(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        self._writer(df).parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, version: int, parts: dict[str, str], schema: T.StructType) -> int:
        """Publishes the version whole; of two writers of one version one gets a Conflict."""
        publish(self.spark, f"{self.path}/_versions/{version:09d}.json", json.dumps({"parts": parts, "schema": schema.jsonValue()}))
        return version

    def _split(self, df: DataFrame) -> dict[str, str]:
        """A folder for each value of the partition column: one write, told apart by folder names."""
        if self.partition is None:
            return {"*": self._data(df)}
        folder = f"data/{uuid.uuid4().hex}"
        shadow = f"__{self.partition}"
        named = df.withColumn(shadow, F.coalesce(F.col(self.partition).cast("string"), F.lit(NULL_VALUE)))
        self._writer(named, shadow).partitionBy(shadow).parquet(f"{self.path}/{folder}")
        named = [n for n in self._names(folder) if n.startswith(f"{shadow}=")]
        return {unescaped(n.partition("=")[2]): f"{folder}/{n}" for n in named}

    def write(self, df: DataFrame, check: Callable[[], None] = lambda: None) -> int:
        """The next version, with these rows alone. `check` is called when they are written and may raise, which
        leaves the table as it is."""
        with self.lock:
            version, parts = self.version() + 1, self._split(df)
            check()
            return self._commit(version, parts, df.schema)

    def replace_all(self, df: DataFrame, check: Callable[[], None] = lambda: None) -> int:
        return self.write(df, check)

    def replace_partition(self, df: DataFrame, key: str, value, check: Callable[[], None] = lambda: None) -> int:
        """The rows of one partition are replaced; an empty frame clears it. A table that is
        partitioned by `key` keeps its other folders, unless a column changes its type."""
        with self.lock:
            if not self.exists():
                return self.write(df, check)
            version = self.version()
            stored = self.read(version)
            old, df = align(stored, df)
            if self.partition == key and all(old.schema[c].dataType == t.dataType for c, t in ((f.name, f) for f in stored.schema.fields)):
                parts = self.parts(version)
                named = self.spark.range(1).select(F.lit(value).cast(old.schema[key].dataType).cast("string")).first()[0]  # as Spark spells it
                parts.pop(NULL_VALUE if named is None else named, None)
                new = self._split(df.where(F.col(key).eqNullSafe(F.lit(value))))
                check()
                return self._commit(version + 1, parts | new, old.schema)
            rest = old.where(~F.col(key).eqNullSafe(F.lit(value))).unionByName(df)
            new = self._split(rest)
            check()
            return self._commit(version + 1, new, rest.schema)

    def merge_partitions(self, df: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """change(stored, incoming) over the partitions that the incoming rows touch; the other
        folders stay. Their number is the number of partitions, not of rows."""
        with self.lock:
            version = self.version()
            stored = self.read(version)
            if self.partition is None:
                return self._commit(version + 1, self._split(change(stored, df)), stored.schema)
            touched = {NULL_VALUE if r[0] is None else r[0] for r in df.select(F.col(self.partition).cast("string")).distinct().collect()}
            parts = self.parts(version)
            mine = [f for v, f in parts.items() if v in touched]
            old = self.spark.read.schema(stored.schema).parquet(*(f"{self.path}/{f}" for f in mine)) if mine else stored.limit(0)
            new = self._split(change(old, df.select(*stored.columns)))
            return self._commit(version + 1, {v: f for v, f in parts.items() if v not in touched} | new, stored.schema)

    def truncate(self) -> int:
        with self.lock:
            version = self.version()
            return self._commit(version + 1, {}, self.read(version).schema)

    def clean_up(self, keep: int = 2) -> int:
        """Forgets all versions but the last `keep` and deletes folders that none of those
        names; returns how many folders went. Readers of older versions must have ended, and
        no write may be under way."""
        with self.lock:
            now = self.version()
            held = {f.split("/")[1] for v in range(max(1, now - keep + 1), now + 1) for f in self.parts(v).values()}
            gone = [n for n in self._names("data") if n not in held]
            for v in range(1, now - keep + 1):
                fs, path = self._file(f"_versions/{v:09d}.json")
                fs.delete(path, False)
            for n in gone:
                fs, path = self._file(f"data/{n}")
                fs.delete(path, True)
            return len(gone)


def unescaped(name: str) -> str:
    """A folder's name as the value it stands for."""
    return urllib.parse.unquote(name)


def align(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of their columns, in types that hold both."""
    old = {f.name: f.dataType for f in stored.schema.fields}
    new = {f.name: store_type(f.dataType) for f in incoming.schema.fields}
    kinds: dict[str, T.DataType] = {}
    for c in (*old, *(c for c in new if c not in old)):
        kinds[c] = (widened_type(old[c], new[c]) or old[c]) if c in old and c in new else old.get(c) or new[c]
    fit = lambda df, have: df.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))
    return fit(stored, old), fit(incoming, new)


def truncate_tables(tables: dict[str, Table], names: list[str] | None) -> list[str]:
    """None: all; an empty list: none."""
    done = [*tables] if names is None else names
    for n in done:
        if tables[n].exists():
            tables[n].truncate()
    return done

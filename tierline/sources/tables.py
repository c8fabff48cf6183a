"""Tables on plain parquet folders, updated without MERGE.

Parquet cannot update rows in place, and a table cannot be overwritten while
the same job reads it. So a table here is a folder of immutable numbered parts plus
a commit log (:class:`CommitLog`). A writer first claims a number, which no other
writer can have, and writes its data under that number; one new file of the log then
makes it visible. Readers open committed numbers only, so a job that dies leaves
data that nobody reads, and a writer that is refused has replaced nothing.

``VersionedTable``: each version is the whole table. ``LoadLog``: an append-only table of
loads. ``DimensionStore``: an SCD2 dimension whose current rows lie in buckets of
their key's hash; a load rewrites only the buckets that its changes touch.

Housekeeping: ``vacuum`` removes superseded versions, ``compact_log`` puts the many
small files of an append-only log together.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.keybuckets import bucket_of
from tierline.sources.files import list_folders, list_names, path_exists, publish, read_text, remove, widen


class ConcurrentWriteError(RuntimeError):
    """Another writer has committed since this one began."""


def write_observed(df: DataFrame, path: str, partition_by: Sequence[str] = (), **metrics: Column) -> dict[str, int]:
    """Overwrite ``path`` with ``df``; its row count (``rows``) and further counts, observed by the write itself."""
    obs = Observation(f"write_{uuid.uuid4().hex}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()])
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return {name: int(value or 0) for name, value in obs.get.items()}


def append_rows(df: DataFrame, path: str) -> None:
    """Append to an append-only log folder (marks, run/audit/metric logs, quarantine)."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """An append-only log folder; an empty frame of ``schema`` if nothing was written yet."""
    if not path_exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    last = CommitLog(spark, f"{path}/{_COMPACTIONS}").last()
    if last is None:
        return spark.read.parquet(path)
    late = [f"{path}/{n}" for n in _log_files(spark, path) if n not in set(last["covered"])]
    return spark.read.schema(_stored_schema(last)).parquet(_compacted(path, last["number"]), *late)


#: Folder of a log's compactions; Spark's readers of the log's own folder pass it over.
_COMPACTIONS = "_compactions"


def _compacted(path: str, number: int) -> str:
    return f"{path}/{_COMPACTIONS}/rows-{number:012}"


def _log_files(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, path) if not n.startswith(("_", "."))]


def _stored_schema(entry: Mapping) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))


def compact_log(spark: SparkSession, path: str) -> int:
    """Put an append-only log's rows together in one folder, also while jobs append to it; returns the files it took in.

    The commit names the files whose rows the folder holds: readers take the folder and the
    files that are not named. These stay until the next compaction, for readers that began
    before this one; of two at once the second to commit is refused
    (``ConcurrentWriteError``) and has changed nothing. Nothing new, or no log: 0.
    """
    log = CommitLog(spark, f"{path}/{_COMPACTIONS}")
    last = log.last()
    names = _log_files(spark, path)  # after the entry, so that each file is in it or in the listing
    covered = set() if last is None else set(last["covered"])
    new = [n for n in names if n not in covered]
    if not new:
        return 0
    rows = spark.read.option("mergeSchema", "true").parquet(*[f"{path}/{n}" for n in new])
    if last is not None:
        before = spark.read.schema(_stored_schema(last)).parquet(_compacted(path, last["number"]))
        rows = before.unionByName(rows, allowMissingColumns=True)
    number = log.claim(last)
    rows.hint("rebalance").write.parquet(_compacted(path, number))
    old = covered & set(names)
    log.commit(last, number, {"covered": sorted(old | set(new)), "schema": rows.schema.json()})
    for name in sorted(old):
        remove(spark, f"{path}/{name}")
    for folder in list_folders(spark, f"{path}/{_COMPACTIONS}"):
        if last is not None and folder < f"rows-{last['number']:012}":
            remove(spark, f"{path}/{_COMPACTIONS}/{folder}")
    return len(new)


def ensure_log(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for an append-only log folder: an empty parquet file with the schema."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)


class CommitLog:
    """Commits of a table: ``commit-<sequence>.json``, each created once and never changed.

    An entry holds the whole state that a reader needs (its ``number``: the newest part;
    ``dropped``: numbers up to it that are not to be read), so reading a table takes one
    listing and one small file, no job. The commit after entry ``k`` is file ``k + 1``:
    of two writers that began from the same entry only one can create it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self, kind: str) -> list[int]:
        return [int(n[len(kind) + 1 : -5]) for n in list_names(self.spark, self.path) if n.startswith(f"{kind}-")]

    def file(self, sequence: int) -> str:
        return f"{self.path}/commit-{sequence:012}.json"

    def last(self) -> dict | None:
        """The newest entry with its ``sequence``, or None."""
        sequence = max(self._numbers("commit"), default=None)
        if sequence is None:
            return None
        return {**json.loads(read_text(self.spark, self.file(sequence))), "sequence": sequence}

    def entry(self, sequence: int) -> dict | None:
        """The entry of that sequence, or None."""
        file = self.file(sequence)
        return {**json.loads(read_text(self.spark, file)), "sequence": sequence} if path_exists(self.spark, file) else None

    def claim(self, base: dict | None) -> int:
        """A number for new data that no other writer has or will get."""
        number = max([*self._numbers("claim"), 0 if base is None else base["number"]], default=0) + 1
        while not publish(self.spark, f"{self.path}/claim-{number:012}.json", "{}"):
            number += 1
        return number

    def commit(self, base: dict | None, number: int, entry: Mapping) -> None:
        """Add an entry after ``base``; numbers passed over (claimed, but never committed) are dropped."""
        before = 0 if base is None else base["number"]
        if number < before:
            raise ConcurrentWriteError(f"{self.path}: {before} was committed after {number} was claimed")
        dropped = {*(() if base is None else base["dropped"]), *range(before + 1, number)}
        row = {
            **entry, "number": number, "dropped": sorted(dropped),
            "committed_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(),
        }
        if not publish(self.spark, self.file(1 + (0 if base is None else base["sequence"])), json.dumps(row)):
            raise ConcurrentWriteError(f"{self.path}: another writer has committed meanwhile")


def visible(column: str, entry: Mapping, after: int | None = None) -> Column:
    """Filter on a partition column: committed numbers, of those after ``after`` only if it is given."""
    found = F.col(column) <= F.lit(entry["number"])
    if entry["dropped"]:
        found = found & ~F.col(column).isin([n for n in entry["dropped"] if after is None or n > after])
    return found if after is None else found & (F.col(column) > F.lit(after))


class VersionedTable:
    """``v=N``: each version is the whole table; the newest committed one is read."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self.log = CommitLog(spark, f"{self.base}/_commits")

    def exists(self) -> bool:
        return self.log.last() is not None

    def latest_version(self) -> int | None:
        last = self.log.last()
        return None if last is None else last["number"]

    def path(self, version: int) -> str:
        return f"{self.base}/v={version}"

    def read(self, version: int | None = None) -> DataFrame:
        v = self.latest_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version in {self.base}")
        return self.spark.read.parquet(self.path(v))

    def write(self, df: DataFrame) -> int:
        """Write ``df`` as the next version and commit it; returns the version."""
        return self.write_counted(df)[0]

    def write_counted(self, df: DataFrame) -> tuple[int, int]:
        """``(version, rows)`` of the next version; the rows are counted by the write."""
        base = self.log.last()
        v = self.log.claim(base)
        rows = write_observed(df, self.path(v))["rows"]
        self.log.commit(base, v, {"rows": rows})
        return v, rows

    def vacuum(self, keep: int = 1) -> list[int]:
        """Remove all but the newest ``keep`` committed versions, and what dead writers left before them; the removed numbers.

        Versions after the newest committed one may be a running writer's, so they stay.
        """
        last = self.log.last()
        if last is None:
            return []
        there = sorted(_numbered(list_folders(self.spark, self.base), "v"))
        kept = [v for v in there if v <= last["number"] and v not in last["dropped"]][-max(1, keep) :]
        gone = [v for v in there if v < last["number"] and v not in kept]
        for v in gone:
            remove(self.spark, self.path(v))
        return gone


def _numbered(folders: Iterable[str], column: str) -> list[int]:
    """Values of a partition column that folders are named by."""
    return [int(f.removeprefix(f"{column}=")) for f in folders if f.startswith(f"{column}=")]


#: Buckets of a new dimension: about a hundred files for one of a billion rows and more with ``buckets``.
DIMENSION_BUCKETS = 16


class DimensionStore:
    """SCD2 dimension: ``rows/state=current/v=N/bucket=K`` and ``rows/state=expired/v=N``.

    The commit names the version of each bucket of current rows. A load writes the
    buckets that its changes touch, and the rows that it expires, in one pass; all
    other buckets stay where they are. Reading the current rows opens one folder a
    bucket; reading some keys' current rows opens their buckets only. Expired rows are
    never rewritten. ``is_current`` is a constant in each branch, so a filter on it
    removes the other branch from the plan.
    """

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str] = (), buckets: int = DIMENSION_BUCKETS) -> None:
        """``keys`` and ``buckets`` are those of a new dimension; later they come from its log."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.log = CommitLog(spark, f"{self.base}/_commits")
        self.last = self.log.last()
        self.keys = list(keys) if self.last is None else self.last["keys"]
        self.buckets = buckets if self.last is None else self.last["buckets"]

    def exists(self) -> bool:
        return self.last is not None

    def latest_version(self) -> int | None:
        return None if self.last is None else self.last["number"]

    def _needed(self) -> dict:
        if self.last is None:
            raise FileNotFoundError(f"no committed version in {self.base}")
        return self.last

    def committed_max_key(self) -> int | None:
        """The largest surrogate key recorded with any commit (None if not recorded)."""
        return None if self.last is None else self.last["max_key"]

    def committed_position(self) -> int | None:
        """How far the loads have read their source (None if not recorded)."""
        return None if self.last is None else self.last["position"]

    def _schema(self, *partitions: str) -> T.StructType:
        fields = T.StructType.fromJson(json.loads(self._needed()["schema"])).fields
        return T.StructType([*fields, *(T.StructField(p, T.LongType()) for p in partitions)])

    def current(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Current rows, of some buckets only if they are given."""
        versions = self._needed()["versions"]
        wanted = versions if buckets is None else [str(b) for b in buckets if str(b) in versions]
        folder = f"{self.base}/rows/state=current"
        paths = [f"{folder}/v={versions[b]}/bucket={b}" for b in wanted]
        schema = self._schema()
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.withColumn("is_current", F.lit(True))

    def history(self) -> DataFrame | None:
        """Expired rows, with the current rows' columns (NULL where an older file lacks one)."""
        if not self._needed()["expired"]:
            return None
        rows = self.spark.read.schema(self._schema("v", "bucket")).parquet(f"{self.base}/rows/state=expired")
        return rows.filter(visible("v", self.last)).drop("v", "bucket").withColumn("is_current", F.lit(False))

    def read(self) -> DataFrame:
        cur, hist = self.current(), self.history()
        return cur if hist is None else cur.unionByName(hist.select(*cur.columns))

    def bucket(self) -> Column:
        return bucket_of(self.keys, self.buckets)

    def write_load(
        self, rows: DataFrame, touched: Iterable[int], max_key: int | None = None, position: int | None = None
    ) -> int:
        """Write a load and commit it; returns the version.

        ``rows`` are all rows of the ``touched`` buckets after the load: the current ones,
        and with ``is_current`` false those that it expires.
        """
        version = self.log.claim(self.last)
        touched = list(touched)
        schema = T.StructType([f for f in rows.schema.fields if f.name != "is_current"])
        if touched:
            placed = rows.withColumn("bucket", F.when(F.col("is_current"), self.bucket()).otherwise(F.lit(-1)))
            placed = placed.withColumn("state", F.when(F.col("is_current"), "current").otherwise("expired"))
            placed = placed.withColumn("v", F.lit(version)).drop("is_current").hint("rebalance", "state", "bucket")
            placed.write.mode("append").partitionBy("state", "v", "bucket").parquet(f"{self.base}/rows")
        known = None if self.last is None else self._schema()
        versions = {} if self.last is None else dict(self.last["versions"])
        present = set(self._written(version))
        for b in touched:
            versions.pop(str(b), None)
            if b in present:
                versions[str(b)] = version
        entry = {
            "keys": self.keys, "buckets": self.buckets, "versions": versions, "schema": widen(known, schema).json(),
            "max_key": max_key, "position": position,
            "expired": path_exists(self.spark, f"{self.base}/rows/state=expired"),
        }
        self._commit(version, entry)
        return version

    def _written(self, version: int) -> list[int]:
        """Buckets of current rows that the version has written (a bucket may have lost its last row)."""
        return _numbered(list_folders(self.spark, f"{self.base}/rows/state=current/v={version}"), "bucket")

    def vacuum(self, keep: int = 1) -> int:
        """Remove the folders of current rows that none of the newest ``keep`` commits names, and dead writers' expired rows.

        Returns how many folders went. ``keep`` must cover the readers that are still at work
        on an earlier commit. Numbers after the newest commit may be a running writer's, so they stay.
        """
        last = self.log.last()
        if last is None:
            return 0
        entries = [e for e in (self.log.entry(last["sequence"] - k) for k in range(max(1, keep))) if e is not None]
        named = {(int(v), int(b)) for e in entries for b, v in e["versions"].items()}
        current, expired = (f"{self.base}/rows/state={s}" for s in ("current", "expired"))
        gone = []
        for v in _numbered(list_folders(self.spark, current), "v"):
            buckets = _numbered(list_folders(self.spark, f"{current}/v={v}"), "bucket")
            old = [b for b in buckets if (v, b) not in named] if v <= last["number"] else []
            gone += [f"{current}/v={v}"] if old and len(old) == len(buckets) else [f"{current}/v={v}/bucket={b}" for b in old]
        gone += [f"{expired}/v={v}" for v in _numbered(list_folders(self.spark, expired), "v") if v in last["dropped"]]
        for folder in gone:
            remove(self.spark, folder)
        return len(gone)

    def advance(self, position: int) -> None:
        """Record that the source was read to ``position`` without any change."""
        last = self._needed()
        self._commit(last["number"], {**last, "position": position})

    def _commit(self, version: int, entry: Mapping) -> None:
        entry = {k: v for k, v in entry.items() if k != "sequence"}
        self.log.commit(self.last, version, entry)
        self.last = self.log.last()


@dataclass(frozen=True)
class Load:
    """A load being written: its number, its folder, and the log entry that it follows."""

    number: int
    folder: str
    base: dict | None


class LoadLog:
    """An append-only table made of ``load=<number>`` folders, and its commits.

    A load becomes visible to readers only once its commit is there, and a committed load
    is never rewritten. The entry also says how far the loads have read each of their
    sources, so the data, the log and the progress commit as one. Readers filter the
    partition column by number: no list of loads, no join, and a reader that wants the
    loads after some number opens only those. Loads may be laid out in further
    partition columns, which readers can filter and do not see; a later load may
    replace the rows of earlier ones whose such column is 1. ``state`` holds what the
    table's jobs carry from load to load.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self.log = CommitLog(spark, f"{self.base}/_loads")

    def last(self) -> dict | None:
        """The newest entry, or None: number, rows, positions, schema, partitions, state, committed_at."""
        found = self.log.last()
        return None if found is None else {**found, "committed_at": dt.datetime.fromisoformat(found["committed_at"]).replace(tzinfo=dt.timezone.utc)}

    def positions(self, last: dict | None = None) -> dict[str, int]:
        """How far the loads have read each source."""
        last = last or self.last()
        return {} if last is None else last["positions"]

    def begin(self, last: dict | None = None) -> Load:
        """A new load after ``last`` (default: the newest entry), with a folder that is nobody else's."""
        base = last or self.last()
        number = self.log.claim(base)
        return Load(number, f"{self.base}/load={number}", base)

    def commit(
        self, load: Load, rows: int, positions: Mapping[str, int], schema: T.StructType,
        partitions: Sequence[str] = (), state: Mapping | None = None, replaced: Mapping[str, Iterable[int]] | None = None,
    ) -> None:
        """Make a written load visible; its positions and columns are added to those before.

        ``replaced``: by partition column, earlier loads whose rows with 1 there are in this one.
        """
        base = load.base or {"positions": {}, "schema": None, "partitions": [], "state": {}, "replaced": {}}
        gone = {c: sorted({*base["replaced"].get(c, ()), *n}) for c, n in {**base["replaced"], **(replaced or {})}.items()}
        known = None if base["schema"] is None else T.StructType.fromJson(json.loads(base["schema"]))
        fields = T.StructType([f for f in schema.fields if f.name not in partitions])
        entry = {
            "rows": int(rows), "positions": {**base["positions"], **positions}, "schema": widen(known, fields).json(),
            "partitions": list(dict.fromkeys([*base["partitions"], *partitions])), "state": {**base["state"], **(state or {})},
            "replaced": gone,
        }
        self.log.commit(load.base, load.number, entry)

    def read(self, after: int | None = None, last: dict | None = None, where: Column | None = None) -> DataFrame | None:
        """Rows of committed loads (with their ``load`` number), of those after ``after`` only if it is given.

        ``where`` may filter the partition columns. ``None`` if nothing was loaded yet.
        Columns that a later load added are NULL in earlier ones.
        """
        last = last or self.last()
        if last is None:
            return None
        hidden = last["partitions"]
        fields = [f for f in T.StructType.fromJson(json.loads(last["schema"])).fields if f.name != "load"]
        parts = [T.StructField(c, T.LongType()) for c in ("load", *hidden)]
        df = self.spark.read.schema(T.StructType([*fields, *parts])).parquet(self.base)
        df = df.filter(visible("load", last, after))
        for column, numbers in last["replaced"].items():
            if numbers:
                df = df.filter(~(F.col("load").isin(numbers) & (F.col(column) == 1)))
        return (df if where is None else df.filter(where)).drop(*hidden)

"""Incremental file ingestion into a bronze table (Structured Streaming, run to completion).

Every run picks up only files not seen before, writes them with lineage columns, and
stops (``availableNow``). A rerun with no new files adds nothing. Each micro-batch goes
to its own ``batch_id=N`` folder under a number that the table gives, and one commit
(:class:`~tierline.sources.tables.CommitLog`) makes it visible.

Progress belongs to the table. A commit names its batch's files and the stream (by
its checkpoint's id) and batch that brought them. A replayed batch is known by stream
and number. While one stream has fed the table, its checkpoint vouches that files
are new; once another has (a new or copied checkpoint), each batch's files are looked
up among all committed ones, so every file counts once whatever checkpoints there
were.

* CSV: a CSV reader maps columns by position, so files whose headers differ
  (added, missing or reordered columns) would be misread. New files stream in as
  text; a batch's headers (each file's first line that is not blank) are found and
  parsed by the CSV parser, every line is
  parsed once into an array, and each value placed by its file's header, whatever
  the number of different headers. Fields beyond the header go to the rescue column
  as the raw line. With ``multiLine`` the files are read by the CSV reader, one
  read per distinct header.
* JSON: new files stream in as text lines, parsed as ``map<string,string>`` (every
  top-level field as text, nested objects as their JSON text). Malformed lines keep
  their raw text in the rescue column.
* Multi-line JSON and XML: only the new files' paths stream in; the batch's files
  are then inferred and read by Spark's own reader, all columns as text, so no file
  is ever held as one value.
* parquet, text: the stream reads with the files' schema.

Column names go through a registry (:class:`~tierline.sources.names.ColumnNames`) that
the commits carry on: a change of case is no new column, and fields named like the
table's own columns are moved aside.

``maxFilesPerTrigger`` always bounds a micro-batch: one huge backlog is processed
as several batches of bounded size, and the per-file rows that reach the driver
(paths, headers) are bounded with it.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.files import (
    infer_names,
    load_schema,
    parse_headers,
    read_csv_groups,
    read_text,
    save_schema,
    string_schema,
    widen,
)
from tierline.sources.names import RESERVED, ColumnNames, most_together
from tierline.sources.tables import CommitLog, visible, write_observed

DEFAULT_MAX_FILES = 1000
RESCUE_COLUMN = "_rescued_data"
#: Most distinct field names of one JSON batch; wider data needs an explicit schema.
MAX_JSON_FIELDS = 10_000
STREAM_OPTIONS = ("maxFilesPerTrigger", "pathGlobFilter", "recursiveFileLookup", "maxFileAge", "latestFirst")


@dataclass
class IngestResult:
    rows: int
    batches: int


def resolve_schema(
    spark: SparkSession,
    source: str,
    fmt: str,
    options: Mapping[str, str],
    schema: T.StructType | str | None,
    schema_location: str | None,
) -> T.StructType | str:
    if schema is not None:
        return schema
    stored = load_schema(spark, schema_location) if schema_location else None
    if fmt == "parquet":
        seen = spark.read.parquet(source).schema
    else:
        seen = infer_names(spark, source, fmt, options)
    resolved = widen(stored, seen)
    if schema_location and resolved != stored:
        save_schema(spark, resolved, schema_location)
    return resolved


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    schema_location: str | None = None,
    max_files_per_trigger: int = DEFAULT_MAX_FILES,
    path_glob: str | None = None,
    rescue_column: str | None = RESCUE_COLUMN,
) -> IngestResult:
    """Ingest new files of ``source`` into the bronze folder ``target``; returns rows and batches.

    ``rescue_column`` (``None``: off) keeps the raw text of malformed CSV, JSON and XML records.
    """
    if not max_files_per_trigger or max_files_per_trigger < 1:
        raise ValueError("max_files_per_trigger must be positive: it bounds every micro-batch")
    opts = {k: str(v) for k, v in (options or {}).items()}
    if path_glob:
        opts["pathGlobFilter"] = path_glob
    opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream_opts = {k: v for k, v in opts.items() if k in STREAM_OPTIONS}
    read_opts = {k: v for k, v in opts.items() if k not in STREAM_OPTIONS}
    multi_line = read_opts.get("multiLine", "false").lower() == "true"

    bronze = BronzeTable(spark, target, checkpoint, rescue_column)
    if fmt == "csv":
        csv_opts = {k: v for k, v in read_opts.items() if k != "header"}
        make = _csv_files if multi_line else _csv_lines
        return _ingest(
            _text_lines(spark, source, stream_opts), bronze, checkpoint,
            lambda batch: make(batch, bronze, csv_opts, rescue_column), keep=not multi_line,
        )
    if fmt in ("json", "xml"):
        evolve = _Evolving(spark, schema, schema_location, bronze)
        if fmt == "json" and not multi_line:
            return _ingest(
                _text_lines(spark, source, stream_opts), bronze, checkpoint,
                lambda batch: _json_lines(batch, bronze, evolve, rescue_column), keep=True,
            )
        paths = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).options(**stream_opts).load(source).select("path")
        return _ingest(
            paths, bronze, checkpoint, lambda batch: _whole_files(batch, bronze, fmt, read_opts, evolve, rescue_column)
        )

    resolved = resolve_schema(spark, source, fmt, read_opts, schema, schema_location)
    stream = spark.readStream.format(fmt).schema(resolved).options(**opts).load(source)
    # the table's own names are taken before the lineage column is added
    named = zip(stream.columns, bronze.names.header(stream.columns), strict=True)
    stream = stream.select(*(F.col(f"`{n}`").alias(c) for n, c in named), F.col("_metadata.file_path").alias("file_path"))
    return _ingest(stream, bronze, checkpoint, lambda batch: _rows_of_files(batch, bronze))


#: Fixed columns of the binary file source; only the path is read.
_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _text_lines(spark: SparkSession, source: str, stream_opts: Mapping[str, str]) -> DataFrame:
    return (
        spark.readStream.format("text")
        .options(**stream_opts)
        .load(source)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )


#: What a batch gives: rows (``None``: none) and the files that they came from.
Made = tuple[DataFrame | None, Sequence[str]]


def _ingest(
    stream: DataFrame, bronze: BronzeTable, checkpoint: str, make: Callable[[DataFrame], Made], keep: bool = False
) -> IngestResult:
    """Run the stream to completion; ``make`` turns a micro-batch into bronze rows.

    ``keep`` persists the batch while ``make``'s frame is built and written: it is
    bounded, read twice (names or headers, then data), and a lost executor only
    recomputes its part from the batch's files.
    """
    result = IngestResult(0, 0)

    def process(batch: DataFrame, batch_id: int) -> None:
        if bronze.is_replay(batch_id):
            return
        if keep:
            batch = batch.withColumn("_tl_mid", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            data, files = make(batch)
            if data is not None:
                rows = bronze.write(data.withColumn("ingestion_time", F.current_timestamp()), batch_id, files)
                result.rows += rows
                result.batches += 1 if rows else 0
        finally:
            if keep:
                batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return result


# ---------------------------------------------------------------- formats


#: A line with more than blanks and control characters; Spark's CSV reader skips the others.
_NOT_BLANK = "[^\\x00-\\x20]"


def _headers(lines: DataFrame) -> list[Row]:
    """``(file_path, header, _tl_hmid)`` of each file: its first line that is not blank.

    Ids ascend within a file's block and are unique in the batch, so the header is
    found by a hash aggregate over blocks and ids (first the least id of each block: a least
    pair is found by sorting) and joined back by id.
    """
    firsts = lines.filter(F.col("value").rlike(_NOT_BLANK)).groupBy("file_path", "block").agg(F.min("_tl_mid").alias("_tl_mid"))
    firsts = firsts.groupBy("file_path").agg(F.min(F.struct("block", "_tl_mid")).alias("_tl_first"))
    firsts = firsts.select(F.col("_tl_first._tl_mid").alias("_tl_hmid"))  # one row per file of this bounded batch
    found = lines.join(F.broadcast(firsts), F.col("_tl_mid") == F.col("_tl_hmid"))
    return found.select("file_path", F.col("value").alias("header"), "_tl_hmid").collect()


def _new_headers(lines: DataFrame, bronze: BronzeTable) -> list[Row]:
    heads = _headers(lines)
    seen = bronze.known(r["file_path"] for r in heads)
    return [r for r in heads if r["file_path"] not in seen]


def _csv_lines(lines: DataFrame, bronze: BronzeTable, csv_opts: Mapping[str, str], rescue_column: str | None) -> Made:
    """Parse a batch's CSV lines in place, each value placed by its own file's header, in one pass."""
    spark = lines.sparkSession
    heads = _new_headers(lines, bronze)
    if not heads:
        return None, ()
    opts = {k: v for k, v in csv_opts.items() if k not in ("multiLine", "inferSchema")}
    names_of = parse_headers(spark, {r["header"] for r in heads}, opts)
    names_of = {h: bronze.names.header(names_of[h]) for h in sorted(names_of)}
    names = bronze.names.columns
    width = max(len(n) for n in names_of.values())
    head_df = spark.createDataFrame(
        [
            (r["file_path"], r["_tl_hmid"], len(own := names_of[r["header"]]), [own.index(n) if n in own else -1 for n in names])
            for r in heads
        ],
        "_tl_file string, _tl_hmid long, _tl_width int, _tl_at array<int>",
    )
    body = lines.join(F.broadcast(head_df), F.col("file_path") == F.col("_tl_file")).filter(
        (F.col("_tl_mid") != F.col("_tl_hmid")) & F.col("value").rlike(_NOT_BLANK)
    )
    ddl = ", ".join(f"c{i} STRING" for i in range(width + 1))  # one more than the widest header
    parsed = body.withColumn("_tl_row", F.from_csv("value", ddl, opts)).withColumn(
        "_tl_fields", F.array(*[F.col(f"_tl_row.c{i}") for i in range(width + 1)])
    )
    at = F.col("_tl_at")
    cols = [F.when(at[j] >= 0, F.get("_tl_fields", at[j])).alias(n) for j, n in enumerate(names)]
    if rescue_column:
        beyond = F.coalesce(*[F.when(F.col("_tl_width") <= i, F.col(f"_tl_row.c{i}")) for i in range(width + 1)])
        cols.append(F.when(beyond.isNotNull(), F.col("value")).alias(rescue_column))
    return parsed.select(*cols, "file_path"), [r["file_path"] for r in heads]


def _csv_files(batch: DataFrame, bronze: BronzeTable, csv_opts: Mapping[str, str], rescue_column: str | None) -> Made:
    """Quoted fields may span lines: read the batch's files with the CSV reader, grouped by header."""
    spark = batch.sparkSession
    heads = _new_headers(batch.withColumn("_tl_mid", F.monotonically_increasing_id()), bronze)
    if not heads:
        return None, ()
    quote = csv_opts.get("quote", '"')
    whole = [r for r in heads if not quote or r["header"].count(quote) % 2 == 0]
    names_of = parse_headers(spark, {r["header"] for r in whole}, csv_opts) if whole else {}
    of_file = {r["file_path"]: names_of[r["header"]] for r in whole}
    for r in heads:  # a name that holds a line break: the reader finds the header's end
        if r["file_path"] not in of_file:
            seen = spark.read.options(**dict(csv_opts)).option("header", "true").option("inferSchema", "false").csv(r["file_path"])
            of_file[r["file_path"]] = [n.strip() for n in seen.columns]
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file in sorted(of_file):
        groups[tuple(bronze.names.header(of_file[file]))].append(file)
    return read_csv_groups(spark, groups, csv_opts, rescue_column), list(of_file)


class _Evolving:
    """The fields of a JSON or XML source: fixed, or the registry's, widened by each batch's."""

    def __init__(self, spark: SparkSession, schema: T.StructType | str | None, location: str | None, bronze: BronzeTable) -> None:
        self.spark, self.location, self.names = spark, location, bronze.names
        self.fixed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        stored = load_schema(spark, location) if location and self.fixed is None else self.fixed
        self.stored = stored
        if stored is not None:
            self.names.learn(stored.fieldNames())

    def learn(self, names: Iterable[str]) -> None:
        """Take a batch's field names into the registry and the stored schema."""
        if self.fixed is not None:
            return
        self.names.learn(names)
        spellings = [s for g in self.names.groups.values() for s in g.spellings]
        known = () if self.stored is None else self.stored.fieldNames()
        wider = string_schema([*known, *(s for s in spellings if s not in known)])
        if self.location and wider != self.stored:
            save_schema(self.spark, wider, self.location)
        self.stored = wider

    def columns(self, value: Callable[[str], Column]) -> list[Column]:
        if self.fixed is None:
            return self.names.select(value)
        typed = {f.name: f.dataType for f in self.fixed.fields}
        return [
            value(f).try_cast(typed[f]).alias(g.columns[0])
            for g in self.names.groups.values()
            for f in g.spellings
            if f in typed
        ]

    def spread(self, rows: DataFrame, value: Callable[[str], Column]) -> None:
        """A column for each spelling of a name that some record holds beside another (a job only where there are several)."""
        several = self.names.several() if self.fixed is None else {}
        if several:
            found = rows.agg(*[most_together(s, value).alias(f"n{i}") for i, s in enumerate(several.values())]).first()
            for key, places in zip(several, found, strict=True):
                self.names.widen(key, places or 1)


def _files_of(batch: DataFrame, column: str = "file_path") -> list[str]:
    return [r[0] for r in batch.select(column).distinct().collect()]  # bounded per batch


def _without(batch: DataFrame, seen: set[str]) -> DataFrame:
    return batch.filter(~F.col("file_path").isin(sorted(seen))) if seen else batch


def _rows_of_files(batch: DataFrame, bronze: BronzeTable) -> Made:
    files = _files_of(batch)
    seen = bronze.known(files)
    if len(seen) == len(files):
        return None, ()
    return _without(batch, seen), [f for f in files if f not in seen]


def _json_lines(batch: DataFrame, bronze: BronzeTable, evolve: _Evolving, rescue_column: str | None) -> Made:
    batch = batch.filter(F.trim("value") != "")
    batch, files = _rows_of_files(batch, bronze)
    if batch is None:
        return None, ()
    records = batch.select(F.from_json("value", "map<string,string>").alias("m"), "value", "file_path")
    if evolve.fixed is None:
        found = records.select(F.explode(F.map_keys("m")).alias("k")).distinct().limit(MAX_JSON_FIELDS + 1).collect()
        if len(found) > MAX_JSON_FIELDS:
            raise ValueError(f"more than {MAX_JSON_FIELDS} distinct JSON fields in one batch: pass a schema")
        evolve.learn(sorted(r["k"] for r in found))

    def value(name: str) -> Column:
        return F.col("m").getItem(name)

    evolve.spread(records, value)
    cols = evolve.columns(value)
    if rescue_column:
        cols.append(F.when(F.col("m").isNull(), F.col("value")).alias(rescue_column))
    return records.select(*cols, "file_path"), files


def _whole_files(
    batch: DataFrame, bronze: BronzeTable, fmt: str, read_opts: Mapping[str, str], evolve: _Evolving, rescue_column: str | None
) -> Made:
    """Multi-line JSON or XML: the batch's paths, inferred and read by Spark's reader."""
    files = _files_of(batch, "path")
    seen = bronze.known(files)
    files = [f for f in files if f not in seen]
    if not files:
        return None, ()
    # a session of its own that tells names apart by case, as the files do
    spark = batch.sparkSession.newSession()
    spark.conf.set("spark.sql.caseSensitive", "true")
    corrupt = "_tl_corrupt"
    opts = {**read_opts, "columnNameOfCorruptRecord": corrupt}
    if evolve.fixed is None:
        # only the names are wanted: values are not tried for types
        plain = {"inferSchema": "false"} if fmt == "xml" else {"primitivesAsString": "true"}
        evolve.learn(f.name for f in spark.read.format(fmt).options(**{**opts, **plain}).load(files).schema.fields if f.name != corrupt)
        source = string_schema([s for g in evolve.names.groups.values() for s in g.spellings])
    else:
        source = evolve.fixed
    full = T.StructType([*source.fields, T.StructField(corrupt, T.StringType())])
    data = spark.read.format(fmt).options(**opts).schema(full).load(files)
    data = data.select("*", F.col("_metadata.file_path").alias("_tl_file"))

    def value(name: str) -> Column:
        return F.col(f"`{name}`")

    evolve.spread(data, value)
    cols = evolve.columns(value)
    if rescue_column:
        cols.append(F.col(corrupt).alias(rescue_column))
    return data.select(*cols, F.col("_tl_file").alias("file_path")), files


# ---------------------------------------------------------------- the table


class BronzeTable:
    """Folders ``batch_id=N`` of a bronze table and its commits (see module docstring)."""

    def __init__(self, spark: SparkSession, target: str, checkpoint: str, rescue_column: str | None = RESCUE_COLUMN) -> None:
        self.spark, self.target, self.checkpoint = spark, target.rstrip("/"), checkpoint.rstrip("/")
        self.log = commit_log(spark, target)
        self.last = self.log.last()
        self._reserved = [*RESERVED, *([rescue_column] if rescue_column else [])]
        self.names = self._known_names()
        self._stream: str | None = None

    def _known_names(self) -> ColumnNames:
        return ColumnNames(() if self.last is None else self.last["names"], self._reserved)

    @property
    def stream(self) -> str:
        """The id that the checkpoint gives its stream (there once the stream has started)."""
        if self._stream is None:
            self._stream = json.loads(read_text(self.spark, f"{self.checkpoint}/metadata"))["id"]
        return self._stream

    @property
    def streams(self) -> dict[str, int]:
        """The newest batch of each stream that has fed the table."""
        return {} if self.last is None else self.last["streams"]

    def is_replay(self, batch_id: int) -> bool:
        """Whether this stream's batch is committed."""
        return self.streams.get(self.stream, -1) >= batch_id

    def known(self, files: Iterable[str]) -> set[str]:
        """Those of a batch's files that the table holds already.

        Only where another stream has fed the table are the committed files read, and of
        them only those that are asked for come back.
        """
        if set(self.streams) <= {self.stream}:
            return set()
        wanted = self.spark.createDataFrame([(f,) for f in files], "file string")
        ledger = file_ledger(self.spark, self.target)
        return {r["file"] for r in ledger.join(F.broadcast(wanted), "file").select("file").distinct().collect()}

    def write(self, data: DataFrame, batch_id: int, files: Iterable[str] = ()) -> int:
        """Write one micro-batch under the table's next number and commit it; return its rows, counted by the write."""
        number = self.log.claim(self.last)
        seen = write_observed(data, f"{self.target}/batch_id={number}", micros=F.max(F.unix_micros("ingestion_time")))
        before = None if self.last is None else T.StructType.fromJson(json.loads(self.last["schema"]))
        entry = {
            "rows": seen["rows"], "micros": seen["micros"] if seen["rows"] else None,
            "schema": widen(before, data.schema).json(), "names": self.names.state,
            "streams": {**self.streams, self.stream: batch_id}, "files": sorted(files),
        }
        self.log.commit(self.last, number, entry)
        self.last = self.log.last()
        return seen["rows"]


def commit_log(spark: SparkSession, target: str) -> CommitLog:
    """The commits of a bronze table (a ``_``-folder, which Spark's readers skip)."""
    return CommitLog(spark, f"{target.rstrip('/')}/_batches")


def file_ledger(spark: SparkSession, target: str) -> DataFrame:
    """(file, number): the files of every committed batch."""
    commits = spark.read.schema("files array<string>, number long").json(f"{commit_log(spark, target).path}/commit-*.json")
    return commits.select(F.explode("files").alias("file"), "number")


def last_batches(spark: SparkSession, targets: Mapping[str, str]) -> dict[str, dict]:
    """Newest commit of each bronze table that has one, with its ``ingestion_time``; no job."""
    found = {name: commit_log(spark, target).last() for name, target in targets.items()}
    for entry in filter(None, found.values()):
        micros = entry["micros"]
        entry["ingestion_time"] = None if micros is None else dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)
    return {name: entry for name, entry in found.items() if entry is not None}


def committed_batch(spark: SparkSession, target: str) -> int | None:
    """The newest committed batch number, or None."""
    newest = commit_log(spark, target).last()
    return None if newest is None else newest["number"]


def read_batches(spark: SparkSession, target: str, newest: Mapping, after: int | None = None) -> DataFrame:
    """Rows of the batches up to ``newest`` (a :func:`last_batches` entry), of those after ``after`` if it is given.

    Both bounds are on the partition column, so an increment opens its own folders only.
    """
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    schema = T.StructType([*[f for f in schema.fields if f.name != "batch_id"], T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(target).filter(visible("batch_id", newest, after))


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    """The bronze table: all committed batches by column name (columns a batch lacks are NULL).

    Batch folders are read with the schema recorded in the commits, so no
    footer of any file is opened to plan the read.
    """
    newest = commit_log(spark, target).last()
    if newest is None:
        raise FileNotFoundError(f"no completed batch in {target}")
    return read_batches(spark, target, newest)


def csv_stream(spark: SparkSession, path: str, schema_location: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A streaming CSV DataFrame (header on) whose column names persist in ``schema_location``.

    Names come from the stored schema, else from the headers of the files
    present now (then stored). This is the plain reader for declared datasets;
    it maps columns by position within one schema, so folders whose files may
    differ in header should go through ``ingest_files(..., "csv")`` instead.
    """
    opts = {"header": "true", **{k: str(v) for k, v in (options or {}).items()}}
    schema = load_schema(spark, schema_location)
    if schema is None:
        schema = infer_names(spark, path, "csv", opts)
        save_schema(spark, schema, schema_location)
    return spark.readStream.schema(schema).options(**opts).csv(path)

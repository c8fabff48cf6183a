"""File sources for the bronze layer: lineage columns, persisted schemas,
header-aware CSV reads, and writers for source-shaped files.

Bronze keeps every source column as text; types are applied in silver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE_COLUMNS = ("file_path", "ingestion_time")

# Writer options that keep full precision of NTZ timestamps in text files.
TEXT_TIMESTAMP_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def with_lineage(df: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """All source columns + ``file_path`` (from the hidden file metadata) + ``ingestion_time``.

    ``current_timestamp()`` is fixed per query (per micro-batch in a stream), so
    every row of one batch carries the same ingestion time.
    """
    when = F.current_timestamp() if ingestion_time is None else ingestion_time
    return df.select("*", F.col("_metadata.file_path").alias("file_path"), when.alias("ingestion_time"))


def string_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def as_strings(schema: T.StructType) -> T.StructType:
    """Top-level fields as text (nested objects then arrive as their raw JSON/XML text)."""
    return string_schema([f.name for f in schema.fields])


def widen(stored: T.StructType | None, seen: T.StructType) -> T.StructType:
    """Stored schema plus any new columns of ``seen`` appended at the end (never drops)."""
    if stored is None:
        return seen
    have = {f.name.lower() for f in stored.fields}  # Spark's tables match names without case
    return T.StructType([*stored.fields, *[f for f in seen.fields if f.name.lower() not in have]])


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    """Persist a schema as one JSON text row in a folder of the shared file system."""
    spark.createDataFrame([(schema.json(),)], "value STRING").coalesce(1).write.mode("overwrite").text(location)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, through the session's Hadoop file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, qualified path)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(conf)
    return fs, fs.makeQualified(hpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder (none if there is no folder), through the session's Hadoop file system."""
    fs, hpath = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isFile()] if fs.exists(hpath) else []


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if there is no folder)."""
    fs, hpath = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()] if fs.exists(hpath) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; one that is not there is no error."""
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, hpath = _file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear with all its content, unless there is one of that name: then False.

    Written beside and renamed without overwriting, which the file system does as
    one step (HDFS and its like; object stores by their committer's conditional put).
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, target = _file_system(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, False)
    out.write(bytearray(text.encode()))
    out.close()
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(beside, target, no_options)
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" not in e.java_exception.toString():
            raise
        return False
    return True


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    if not path_exists(spark, location):
        return None
    row = spark.read.text(location).first()
    return None if row is None else T.StructType.fromJson(json.loads(row["value"]))


def infer_names(spark: SparkSession, path: str, fmt: str, options: Mapping[str, str] | None = None) -> T.StructType:
    """Column names a batch reader sees in ``path`` (types dropped to text).

    JSON and XML infer over ``samplingRatio`` of the rows when that option is
    given; pass it for large folders.
    """
    reader = spark.read.format(fmt).options(**dict(options or {}))
    return as_strings(reader.load(path).schema)


def parse_headers(spark: SparkSession, headers: Iterable[str], options: Mapping[str, str] | None = None) -> dict[str, list[str]]:
    """Column names of header lines, cut by the CSV parser with the data's own options.

    A name may be quoted and hold the separator. Names are trimmed; an empty one
    becomes ``_cN`` and a repeated one gets its position as a suffix.
    """
    opts = {k: v for k, v in (options or {}).items() if k not in ("multiLine", "inferSchema", "header")}
    sep = opts.get("sep", opts.get("delimiter", ","))
    lines = sorted(set(headers))
    width = max(line.count(sep) for line in lines) + 1
    ddl = ", ".join(f"c{i} STRING" for i in range(width))
    frame = spark.createDataFrame([(line,) for line in lines], "header STRING")  # one row per distinct header
    # an unlikely text stands for NULL, so that an empty name differs from a missing one
    found = frame.select("header", F.from_csv("header", ddl, {**opts, "nullValue": "\u0001", "emptyValue": ""}).alias("n"))
    out: dict[str, list[str]] = {}
    for row in found.collect():
        names = [n for n in row["n"]]
        while names and names[-1] is None:
            names.pop()
        taken: list[str] = []
        for i, name in enumerate(names):
            name = (name or "").strip() or f"_c{i}"
            taken.append(f"{name}_{i}" if name in taken else name)
        out[row["header"]] = taken
    return out


def read_csv_groups(
    spark: SparkSession,
    groups: Mapping[Sequence[str], Sequence[str]],
    options: Mapping[str, str] | None = None,
    rescue_column: str | None = None,
) -> DataFrame | None:
    """Read CSV files grouped by their column names, each group with its own, union by name.

    A plain CSV read with one schema maps columns *by position*, so a file
    with reordered columns would put values in the wrong columns. Reading
    each header group separately and unioning by name lands every value in
    its own column; a column missing from a group is NULL there. Records whose
    fields do not fit the header keep their text in the rescue column.
    """
    out: DataFrame | None = None
    for names, files in groups.items():
        reader = spark.read.options(**dict(options or {})).option("header", "true")
        columns = list(names)
        if rescue_column:
            columns.append(rescue_column)
            reader = reader.option("columnNameOfCorruptRecord", rescue_column)
        part = reader.schema(string_schema(columns)).csv(list(files))
        part = part.select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_source_files(
    df: DataFrame,
    path: str,
    fmt: str,
    folder_by: str | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "append",
) -> None:
    """Write rows the way an upstream system would drop them (CSV with header, JSON
    lines, XML records, parquet), optionally one sub-folder per value of a column."""
    opts = {**TEXT_TIMESTAMP_OPTIONS, **dict(options or {})} if fmt in ("csv", "json", "xml") else dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
    if fmt == "xml":
        opts.setdefault("rowTag", "record")
        opts.setdefault("rootTag", "records")
    writer = df.write.mode(mode).format(fmt).options(**opts)
    if folder_by:
        writer = writer.partitionBy(folder_by)
    writer.save(path)


def load_fixture(spark: SparkSession, path: str, schema: T.StructType | str, suffix: str | None = None) -> DataFrame:
    """A JSON (lines) or CSV (with header) fixture read with an explicit schema, by file suffix (given for a folder)."""
    kind = suffix or path
    if kind.endswith(".json") or kind.endswith(".jsonl"):
        return spark.read.schema(schema).json(path)
    if kind.endswith(".csv"):
        return spark.read.schema(schema).option("header", "true").csv(path)
    raise ValueError(f"unsupported fixture type: {path}")

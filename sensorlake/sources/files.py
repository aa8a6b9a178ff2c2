"""Readers. Everything is a lazy Spark read; schema checks happen on the
driver from file headers/metadata, never from collected data."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.text import basename, strip_bom
from sensorlake.functions.time import kelvin_to_c, lenient_double, lenient_ts
from sensorlake.operators.merge import upsert
from sensorlake.operators.reshape import FROM_POINT
from sensorlake.operators.util import bounded_broadcast
from sensorlake.schemas import FACT, PUBLIC, PUBLIC_COLS, REGISTRY, SEEDS, SERIES_KEY, WEATHER
from sensorlake.session import scratch_path


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, cols: Sequence[str], where: str = "input") -> DataFrame:
    """Q03: fail before any job when required columns are absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"{where}: missing columns {missing}")
    return df


def place_in_file() -> F.Column:
    """Number that grows inside a file, over all its splits.

    A task numbers the rows of its splits from 0. Splits together hold fewer
    rows than the split size in bytes, so a split's first byte plus the
    task's row number stays below the first byte of the next split.
    """
    return F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)


def load_seq(file, mtime, place) -> F.Column:
    """Write order of a row: file time, then file name, then place in the file; larger is later."""
    return F.struct(mtime.cast("timestamp_ntz").alias("at"), basename(file).alias("file"), place.alias("place")).alias("load_seq")


ORIGIN = ("_file", "_mtime", "_line")


def first_lines(lines: DataFrame, comment: str | None = None) -> DataFrame:
    """(file, line): hash of the first line of each file of a text read that is neither blank nor a comment.

    A scan that keeps two numbers a file: with the line itself the aggregate
    would sort every line in its task. ``header_lines`` has the text of the
    few different ones. Spark has no reader that stops inside
    a split (a Python stage that returns early still gets the whole split
    sent), so this reads the text once.
    """
    x = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("id"))
    x = x.filter((F.col("block") == 0) & (F.trim("value") != ""))
    if comment:
        x = x.filter(~F.col("value").startswith(comment))
    return x.groupBy("file").agg(F.min_by(F.xxhash64("value"), "id").alias("line"))


def header_lines(lines: DataFrame, heads: DataFrame) -> list[tuple[str, int, str]]:
    """(header, hash, smallest file) of each different line of ``first_lines``, sorted; one short read for each, up to that line."""
    out = []
    for g in heads.groupBy("line").agg(F.min("file").alias("file")).collect():
        own = lines.filter((F.col("_metadata.file_path") == g["file"]) & (F.xxhash64("value") == g["line"]))
        out.append((own.select(F.regexp_replace("value", "\r$", "")).first()[0], g["line"], g["file"]))
    return sorted(out)


def header_names(header: str, sep: str = ",", rename: Mapping[str, str] | None = None) -> list[str]:
    """Column names of a header line. Blank names become ``_c<place>``; a name that occurs before (in any case) or
    is one of ``ORIGIN`` gets its place appended, so every column can be told apart."""
    names, seen = [], set(ORIGIN)
    for i, n in enumerate(next(csv.reader([header.removeprefix("\ufeff")], delimiter=sep))):
        n = (rename or {}).get(n, n) or f"_c{i}"
        while n.lower() in seen:
            n = f"{n}_{i}"
        seen.add(n.lower())
        names.append(n)
    return names


def csv_by_name(spark: SparkSession, path: str | Sequence[str], required: Sequence[str] = (), comment: str | None = None,
                sep: str = ",", glob: str | None = None, recursive: bool = False, rename: Mapping[str, str] | None = None,
                skip_corrupt: bool = False) -> DataFrame:
    """CSV files with a header each, columns as text, bound by name file by file.

    Spark binds columns by place, so the header of each file is looked up
    first (``first_lines``). All files are then read in one scan. One header:
    its names are the schema. Several: columns are read by place and each
    name takes, for a row's file, the place it has in that file's header;
    files and headers meet in a join, and only the different headers reach
    the driver. A file without a ``required`` column
    (after ``rename``) raises with its path. ``_file``, ``_mtime`` and
    ``_line`` tell where a row comes from.
    """
    def reader():
        r = spark.read.option("recursiveFileLookup", recursive)
        if skip_corrupt:
            r = r.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        return r.option("pathGlobFilter", glob) if glob else r

    paths = [path] if isinstance(path, str) else list(path)
    text = reader().text(paths)
    heads = first_lines(text, comment)
    found = header_lines(text, heads)
    layouts = {h: header_names(h, sep, rename) for h, _, _ in found}
    for h, _, file in found:
        missing = [c for c in required if c not in layouts[h]]
        if missing:
            raise MissingColumns(f"{file}: missing columns {missing}")
    if not layouts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in required]
                                                      + [T.StructField("_file", T.StringType()), T.StructField("_mtime", T.TimestampType()),
                                                         T.StructField("_line", T.LongType())]))

    def rows(columns: Sequence[str]) -> DataFrame:
        r = reader().schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("header", True).option("sep", sep)
        r = r.option("comment", comment) if comment else r
        return r.csv(paths).select("*", F.col("_metadata.file_path").alias("_file"),
                                   F.col("_metadata.file_modification_time").alias("_mtime"), place_in_file().alias("_line"))

    if len(layouts) == 1:
        return rows(next(iter(layouts.values())))
    kinds = spark.createDataFrame([(line, list(layouts).index(h)) for h, line, _ in found], "line long, layout int")
    heads_path = scratch_path(spark, "file-headers")                # one row a file
    heads.join(F.broadcast(kinds), "line").select(F.col("file").alias("_head_file"), "layout").write.parquet(heads_path)
    heads = spark.read.schema("_head_file string, layout int").parquet(heads_path)
    x = rows([f"c{i}" for i in range(max(map(len, layouts.values())))])
    x = x.join(bounded_broadcast(heads), F.col("_file") == F.col("_head_file"))
    spelling: dict[str, str] = {}                   # names of two files match in any case, as in a union by name
    for n in (n for names in layouts.values() for n in names):
        spelling.setdefault(n.lower(), n)
    places = [{n.lower(): k for k, n in enumerate(names)} for names in layouts.values()]
    columns = []
    for low, name in spelling.items():
        value = F.lit(None).cast("string")
        for i, own in enumerate(places):
            if low in own:
                value = F.when(F.col("layout") == i, F.col(f"c{own[low]}")).otherwise(value)
        columns.append(value.alias(name))
    return x.select(*columns, *ORIGIN)


def header_diff(spark: SparkSession, path: str | Sequence[str], expected: Sequence[str], comment: str | None = None, sep: str = ",",
                glob: str | None = None, recursive: bool = False, extra_severity: str = "warn") -> DataFrame:
    """U04 over stored files: (file, file_name, column, issue, severity) of every CSV file whose header differs from ``expected``.

    Headers are compared once for each different one and joined back to their
    files. A file without a header line (empty, blank) is not listed.
    """
    r = spark.read.option("recursiveFileLookup", recursive)
    text = (r.option("pathGlobFilter", glob) if glob else r).text([path] if isinstance(path, str) else list(path))
    heads = first_lines(text, comment)
    rows = []
    for header, line, _ in header_lines(text, heads):
        names = header_names(header, sep)
        rows += [(line, c, "missing", "error") for c in expected if c not in names]
        rows += [(line, c, "unexpected", extra_severity) for c in names if c not in expected]
    issues = spark.createDataFrame(rows, "line long, column string, issue string, severity string")
    return heads.join(F.broadcast(issues), "line").select(
        "file", logical_file_name(F.col("file")).alias("file_name"), "column", "issue", "severity")


def read_wide(spark: SparkSession, path: str, sep: str = ",", origin: bool = False) -> DataFrame:
    """CSV with header; every column as text, bound by name per file; column set discovered at read.

    ``origin`` adds ``load_seq``, the write order of each row.
    """
    df = csv_by_name(spark, path, sep=sep)
    if origin:
        df = df.withColumn("load_seq", load_seq(F.col("_file"), F.col("_mtime"), F.col("_line")))
    return df.drop(*ORIGIN)


def read_fact(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The narrow four-column history table (typed)."""
    if fmt == "parquet":
        return spark.read.schema(FACT).parquet(path)
    return spark.read.schema(FACT).option("header", True).csv(path)


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the lookup seeds with its fixed schema; ``_row`` keeps file order."""
    df = spark.read.schema(SEEDS[name]).option("header", True).option("encoding", "UTF-8").csv(path)
    return df.withColumn("_row", F.monotonically_increasing_id())


def read_lines(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Text lines with their exact position: (file, block, line_id, text).

    Order inside a file is (block, line_id): a file split is read by one
    task, rows in file order, and ``monotonically_increasing_id`` grows
    inside a task. No file is ever forced into a single row or task.
    """
    reader = spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n")
    try:
        raw = reader.text(path)
    except Exception as e:   # no input at all -> an empty line table, same schema
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "file string, block long, line_id long, text string, mtime timestamp")
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.regexp_replace(F.col("value"), "\r$", "").alias("text"),
        F.col("_metadata.file_modification_time").alias("mtime"),
    )


def logical_file_name(path_col) -> "F.Column":
    """Base name of a file; for Spark part files inside a ``key=value``
    directory (drops written with ``partitionBy``), the partition value."""
    part = F.regexp_extract(path_col, r"/[^/=]+=([^/]+)/part-[^/]*$", 1)
    return F.when(part != "", part).otherwise(basename(path_col))


def drop_lines(spark: SparkSession, path: str, origin: bool = False) -> DataFrame:
    """Device drop files as positioned lines (file, file_name, block, line_id,
    text), BOM stripped, headers not yet identified: the detection pass
    finds them inside its own window (no extra read of the text).
    ``origin`` adds ``mtime``, the file's modification time."""
    lines = read_lines(spark, path)
    return lines.select("file", logical_file_name(F.col("file")).alias("file_name"), "block", "line_id",
                        strip_bom(F.col("text")).alias("text"), *(["mtime"] if origin else []))


def read_sensor_drops(spark: SparkSession, path: str, header_lines: int = 2, keep_header: bool = False) -> DataFrame:
    """Device drop files -> lines (file, file_name, block, line_id, text[, is_header]).

    The first ``header_lines`` lines of each file are headers (dropped unless
    ``keep_header``), the UTF-8 BOM is stripped. Headers are found by the
    position inside the first block of the same scan (ids of two scans are
    not comparable); parsing whole runs goes through ``drop_lines``, which
    moves no text.
    """
    from pyspark.sql import Window
    lines = read_lines(spark, path)
    pos = F.row_number().over(Window.partitionBy("file", "block").orderBy("line_id"))
    out = lines.withColumn("is_header", (F.col("block") == 0) & (pos <= header_lines))
    if not keep_header:
        out = out.filter(~F.col("is_header"))
    cols = ["file", logical_file_name(F.col("file")).alias("file_name"), "block", "line_id",
            strip_bom(F.col("text")).alias("text")]
    return out.select(*cols, *(["is_header"] if keep_header else []))


TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_monthly(spark: SparkSession, path: str, required: Sequence[str] = PUBLIC_COLS,
                 layout: str = "named") -> DataFrame:
    """Monthly hourly exports.

    ``layout='named'``: files `{additive,nonadditive}_YYYY-MM.hourly.csv`
    anywhere under ``path``; ``layout='partitioned'``: the
    ``measurement=/year_month=`` directories written by ``write_monthly``
    (partition filters on them prune whole months). Missing required
    columns raise; unparseable time/value become NULL and stay (quirk K7).
    No matching file -> empty typed frame.
    """
    try:
        if layout == "named":
            df = csv_by_name(spark, path, required, recursive=True,
                             glob="{additive,nonadditive}_[0-9][0-9][0-9][0-9]-[0-9][0-9].hourly.csv")
        else:
            df = require_columns(spark.read.option("header", True).option("timestampNTZFormat", TS_TEXT).csv(path), required, path)
    except Exception as e:  # no file matched: Spark cannot infer a schema
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], PUBLIC)
        raise
    return df.select(lenient_ts(F.col("time").cast("string")).alias("time"), "location", "source", "measurement",
                     "data_key", lenient_double(F.col("data_value").cast("string")).alias("data_value"))


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """Annotated CSV: `#` lines are comments; repeated header rows drop
    out because their time does not parse."""
    df = csv_by_name(spark, path, comment="#", rename=FROM_POINT)
    out = df.select(lenient_ts("time").alias("time"), *[F.col(c) for c in SERIES_KEY if c in df.columns],
                    lenient_double("data_value").alias("data_value"))
    return out.filter(F.col("time").isNotNull())


def reload_exports(spark: SparkSession, path: str, base: DataFrame | None = None) -> DataFrame:
    """Every earlier export under ``path`` (recursive), bad or empty files
    skipped, then upserted: re-import is idempotent; later files, and later
    lines inside a file, win."""
    df = csv_by_name(spark, path, comment="#", rename=FROM_POINT, recursive=True, glob="*.csv", skip_corrupt=True)
    pts = df.select(lenient_ts("time").alias("time"), *[F.col(c) for c in SERIES_KEY],
                    lenient_double("data_value").alias("data_value"), "_file", "_mtime", "_line")   # _line grows inside a file
    pts = pts.filter(F.col("time").isNotNull())
    key = ["time", *SERIES_KEY]
    if base is not None:
        pts = base.select(*key, "data_value", F.lit("").alias("_file"), F.lit(None).cast("timestamp").alias("_mtime"),
                          F.lit(None).cast("long").alias("_line")).unionByName(pts)
    # write order: file modification time, then file, then line -- the last write wins
    return upsert(pts, None, key, order=["_mtime", "_file", "_line"]).drop("_file", "_mtime", "_line")


def damaged_exports(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold bytes but give ``reload_exports`` no line: (file, length); unreadable or blank.

    Files of length 0 hold nothing to miss, and Spark's readers leave them out.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
             .select(F.col("_metadata.file_path").alias("file"), "length"))      # contents are not read
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("ignoreCorruptFiles", True)
             .option("ignoreMissingFiles", True).text(path).filter(F.trim("value") != "")
             .select(F.col("_metadata.file_path").alias("file")).distinct())
    return files.join(lines, "file", "left_anti")


def months_to_process(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Sorted distinct `YYYY-MM` of the input (one small aggregate)."""
    return (df.filter(F.col(time_col).isNotNull()).select(F.date_format(time_col, "yyyy-MM").alias("year_month"))
              .distinct().orderBy("year_month"))


def read_per_location(spark: SparkSession, paths: Sequence[str] | str, pattern: str = r"([^/_.]+)\.csv$") -> DataFrame:
    """Files of one shape, the location taken from each file name."""
    df = csv_by_name(spark, paths)
    return df.withColumn("location", F.regexp_extract(logical_file_name(F.col("_file")), pattern, 1)).drop(*ORIGIN)


def read_public(spark: SparkSession, path: str) -> DataFrame:
    """Consumer view of the public Parquet: time, location, source, type, metric, value."""
    df = spark.read.parquet(path)
    return df.select("time", "location", "source", F.col("measurement").alias("type"),
                     F.col("data_key").alias("metric"), F.col("data_value").alias("value"))


def read_registered(spark: SparkSession, registry: DataFrame, base_path: str = "") -> DataFrame:
    """Config-driven ingest -- one read per active registry row.

    The registry is a handful of configuration rows (bounded by the number
    of datasources), so it is read on the driver; each source is validated
    against its required columns, tagged, and all are unioned by name.
    """
    rows = registry.filter(F.col("status") == "active").collect()
    frames = []
    for r in rows:
        path = f"{base_path.rstrip('/')}/{r['file_pattern']}" if base_path else r["file_pattern"]
        req = [c.strip() for c in (r["required_columns"] or "").split(",") if c.strip()]
        try:
            df = csv_by_name(spark, path, req)
        except MissingColumns as e:
            raise MissingColumns(f"datasource {r['datasource_id']}: {e}") from e
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            raise FileNotFoundError(f"datasource {r['datasource_id']}: no files for {path}") from e
        frames.append(df.withColumn("datasource_id", F.lit(r["datasource_id"])).withColumnRenamed("_file", "_source_file")
                        .drop("_mtime", "_line"))
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField("datasource_id", T.StringType())]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def land(df: DataFrame, ingested_at=None) -> DataFrame:
    """Raw copy plus ingestion time and source file."""
    ts = F.lit(ingested_at).cast("timestamp_ntz") if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumn("_ingestion_timestamp", ts).withColumn("_source_file", F.col("_metadata.file_path"))


def land_counts(landed: DataFrame) -> DataFrame:
    """S17 metadata: rows per landed file."""
    return landed.groupBy("_source_file").agg(F.count(F.lit(1)).alias("row_count"))


def read_json_source(spark: SparkSession, path: str) -> DataFrame:
    """Weather JSON lines; Kelvin -> Celsius; typed time."""
    df = spark.read.schema(WEATHER).json(path)
    return df.select(lenient_ts("timestamp").alias("time"), "location",
                     kelvin_to_c("temperature_kelvin").alias("temperature_c"), "humidity_pct", "pressure_hpa")


REGISTRY_SCHEMA = REGISTRY

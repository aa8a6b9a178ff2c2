"""Structured Streaming forms of the daily incremental batch.

Event time: the warehouse keeps TIMESTAMP_NTZ, but ``withWatermark``
needs a zoned timestamp, so streams cast to TIMESTAMP (session zone UTC,
no shift) before the watermark and back afterwards.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions.time import year_month
from sensorlake.operators.merge import upsert
from sensorlake.operators.quality import RowRule
from sensorlake.schemas import SERIES_KEY

EVENT_TS = "_event_ts"


def with_event_time(df: DataFrame, time_col: str = "time", delay: str = "1 hour") -> DataFrame:
    """Zoned event-time column + watermark (NTZ is rejected by ``withWatermark``)."""
    return df.withColumn(EVENT_TS, F.col(time_col).cast("timestamp")).withWatermark(EVENT_TS, delay)


#: Listing many folders: few tasks for all of them, none for the files of a micro-batch (the default is a task a path).
LISTING = {
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "64",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}
#: Many micro-batches: the list of the files seen, which grows with the stream, is rewritten less often, and archiving
#: keeps pace with them.
MANY_BATCHES = LISTING | {
    "spark.sql.streaming.fileSource.log.compactInterval": "100",
    "spark.sql.streaming.fileSource.cleaner.numThreads": "4",
}
#: On a local file system the default manager starts a process for each look at a link; both rename without a guard there.
LOCAL_CHECKPOINT = {"spark.sql.streaming.checkpointFileManagerClass":
                    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}


@contextlib.contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """``conf`` holds for as long as the block runs; a stream that starts in it keeps what concerns its micro-batches."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_available_now(df: DataFrame, checkpoint: str, *, path: str | None = None, fmt: str = "parquet",
                      mode: str = "append", foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Process everything available now, then stop (the daily job as a stream).

    A ``foreach_batch`` with a ``finish`` gets it called once, after the last micro-batch; its ``settings`` hold
    during the micro-batches.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    local = LOCAL_CHECKPOINT if checkpoint.startswith(("/", "file:")) else {}
    with settings(df.sparkSession, MANY_BATCHES | local | getattr(foreach_batch, "settings", {})):
        q = w.start()
        q.awaitTermination()
    if hasattr(foreach_batch, "finish"):
        foreach_batch.finish(df.sparkSession)
    return q


# ---------------------------------------------------------------- T01
def stream_drops(spark: SparkSession, path: str, archive_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """New drop files as a stream of text lines with their file path and
    block; processed files are moved to ``archive_dir`` after commit."""
    r = spark.readStream.option("recursiveFileLookup", True)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    with settings(spark, LISTING):
        lines = r.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


class DropsWriter:
    """foreachBatch body for T01 and the parsing that follows it.

    A micro-batch only stores its lines (one partition per micro-batch,
    overwritten on a retry), so its cost does not hold the planning of the
    whole detection. ``finish`` detects and parses (D01/D02) all stored lines
    that are not parsed yet in one job: each micro-batch holds whole files, so
    the files of many are independent. A run that ends before ``finish``
    leaves its lines stored, and the next ``finish`` parses them.
    """

    #: Few tasks a micro-batch while its files are small, so few files are stored.
    settings = {"spark.sql.files.minPartitionNum": "4", "spark.sql.files.openCostInBytes": "512k",
                "spark.sql.files.maxPartitionBytes": "32m"}

    def __init__(self, out_path: str, today, strict: bool = True, default: str = "DMY", header_lines: int = 2):
        self.base = out_path.rstrip("/")
        self.today, self.strict, self.default, self.header_lines = today, strict, default, header_lines

    @functools.cached_property
    def stored_line(self) -> list[Column]:
        from sensorlake.functions.text import strip_bom
        from sensorlake.sources.files import logical_file_name
        return [F.col("file"), logical_file_name(F.col("file")).alias("file_name"), F.col("block"),
                F.monotonically_increasing_id().alias("line_id"),
                strip_bom(F.regexp_replace("value", "\r$", "")).alias("text")]

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        # a micro-batch's folder, overwritten as a whole: the plan is the same for every micro-batch
        (batch.select(*self.stored_line).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False)
              .parquet(f"{self.base}_lines/_batch={epoch}"))

    def _write(self, frame: DataFrame, suffix: str = "") -> None:
        # a re-executed batch (foreachBatch is at-least-once) or ``finish`` cannot duplicate rows
        (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch")
              .parquet(self.base + suffix))

    def finish(self, spark: SparkSession) -> None:
        """Stored lines -> output; lines and files that were not parsed are kept beside it."""
        # tasks share the folders of the micro-batches, however little is in them
        with settings(spark, LISTING | {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}):
            self._finish(spark)

    def _finish(self, spark: SparkSession) -> None:
        from sensorlake.operators.datefmt import FORMATS, detect_date_format, parse_drops_once
        from sensorlake.session import materialize, scratch_path
        from sensorlake.sources.sinks import stored
        lines = stored(spark, f"{self.base}_lines")
        if lines is None:
            return
        done = stored(spark, f"{self.base}_parsed")
        if done is not None:
            lines = lines.join(F.broadcast(done.select("_batch")), "_batch", "left_anti")      # one row per micro-batch
        # detection and parsing read the lines several times: the small files of the micro-batches are opened once
        together = scratch_path(spark, "drop-lines")
        lines.write.parquet(together)
        lines = spark.read.schema(lines.schema).parquet(together)
        # a path may come again in a later micro-batch, as another file
        x = lines.withColumn("file", F.concat_ws("\n", F.col("_batch").cast("string"), "file"))
        batch, path = F.substring_index("file", "\n", 1).cast("int"), F.expr("substring(file, locate('\n', file) + 1)")
        dec = materialize(detect_date_format(x, self.today, self.strict, self.default, header_lines=self.header_lines))
        good, quarantine = parse_drops_once(x, dec, header_lines=self.header_lines, keep=("_batch",))
        undecided = dec.filter(~F.col("fmt").isin(*FORMATS)).withColumn("_batch", batch)
        # the hint gathers a batch's rows, so the tasks do not leave a file each in every batch
        self._write(good.hint("rebalance", "_batch"))
        self._write(quarantine.withColumn("file", path).hint("rebalance", "_batch"), "_quarantine")
        self._write(undecided.withColumn("file", path), "_undecided")
        parsed = dec.select(batch.alias("_batch")).distinct().withColumn("parsed", F.lit(True))
        self._write(parsed.repartition(16, "_batch"), "_parsed")


def drops_batch_writer(out_path: str, today, strict: bool = True, default: str = "DMY", header_lines: int = 2) -> DropsWriter:
    """foreachBatch body for T01; ``run_available_now`` calls its ``finish`` when the stream has ended."""
    return DropsWriter(out_path, today, strict, default, header_lines)


# ---------------------------------------------------------------- T02
def stream_resample(df: DataFrame, every: str = "1 hour", delay: str = "1 hour", series: Sequence[str] = SERIES_KEY,
                    time_col: str = "time", value_col: str = "data_value", label: str = "end") -> DataFrame:
    """Hourly sum (additive) / mean (others) per series on a stream."""
    x = with_event_time(df.filter(F.col(value_col).isNotNull()), time_col, delay)
    v = F.col(value_col)
    out = x.groupBy(F.window(EVENT_TS, every).alias("_w"), *series).agg(
        F.when(F.col("measurement") == "additive", F.sum(v)).otherwise(F.avg(v)).alias(value_col))
    return out.select(F.col(f"_w.{label}").cast("timestamp_ntz").alias(time_col), *series, value_col)


# ---------------------------------------------------------------- T03
def stream_dedupe(df: DataFrame, key: Sequence[str], delay: str = "1 hour", time_col: str = "time") -> DataFrame:
    """Re-imported rows are dropped (state kept for ``delay``)."""
    return with_event_time(df, time_col, delay).dropDuplicatesWithinWatermark(list(key)).drop(EVENT_TS)


# ---------------------------------------------------------------- T04
def upsert_months(batch: DataFrame, path: str, key: Sequence[str], order: Sequence[str], time_col: str = "time",
                  partition_cols: Sequence[str] = ("measurement", "year_month")) -> None:
    """U06 into a month-partitioned table: merge ``batch`` with the months it
    touches and rewrite only those months (batch or micro-batch)."""
    upsert_months_writer(path, key, order, time_col, partition_cols)(batch, 0)


def upsert_months_writer(path: str, key: Sequence[str], order: Sequence[str], time_col: str = "time",
                         partition_cols: Sequence[str] = ("measurement", "year_month")) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for T04: the batch is merged with the month
    partitions it touches and only those months are rewritten (dynamic
    partition overwrite).

    The touched partitions (measurements x months of one batch) become a
    partition filter, null-safe, so only those directories are listed and
    read. The merged months go to a staging
    table in the shared checkpoint folder first -- the overwrite then reads
    the staging copy, never the files it replaces. Idempotent: a re-executed
    batch upserts the same rows again and yields the same months. Several
    months are not replaced at once; ``sources.snapshots.snapshot_writer``
    makes a batch visible as a whole.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        from sensorlake.session import scratch_path
        from sensorlake.sources.sinks import stored
        b = batch.withColumn("year_month", year_month(time_col))
        spark = b.sparkSession
        existing = stored(spark, path)
        if existing is None:
            merged = upsert(b, None, [*key], order)
        else:
            cond = F.lit(False)
            for t in b.select(*partition_cols).distinct().collect():       # partition values, not rows
                one = F.lit(True)
                for c in partition_cols:
                    one = one & F.col(c).eqNullSafe(F.lit(t[c]))
                cond = cond | one
            old = existing.filter(cond)
            merged = upsert(old.select(b.columns), b, [*key], order)
            staging = scratch_path(spark, "upsert-staging")
            merged.write.parquet(staging)
            merged = spark.read.parquet(staging)
        # the hint gathers a month's rows, so a batch does not leave a file per task in every month
        (merged.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*partition_cols).parquet(path))
    return run


# ---------------------------------------------------------------- T05
def late_data(df: DataFrame, start, time_col: str = "time", delay: str | None = None) -> DataFrame:
    """Rows older than the retention start are excluded (a larger
    ``history`` + batch rerun is the backfill path)."""
    from sensorlake.functions.time import ts_literal
    out = df.filter(F.col(time_col) >= ts_literal(start))
    return with_event_time(out, time_col, delay).drop(EVENT_TS) if delay else out


# ---------------------------------------------------------------- T06
def changed_months(current: DataFrame, state: DataFrame, key: Sequence[str] = ("source", "year_month"),
                   marker: str = "max_loaded_at") -> DataFrame:
    """Groups that are new or fresher than recorded in the state table (null keys are keys too)."""
    c, s = current.alias("c"), state.select(*key, marker).alias("s")
    same = functools.reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key])
    fresh = F.coalesce(F.col(f"s.{marker}") >= F.col(f"c.{marker}"), F.col(f"c.{marker}").isNull())
    return c.join(s, same & fresh, "left_anti")


def month_markers(df: DataFrame, by: Sequence[str] = ("source",), time_col: str = "time",
                  loaded_col: str | None = None) -> DataFrame:
    """Per (group, month): newest load marker and row count -- the state T06 compares."""
    lc = loaded_col or time_col
    return df.groupBy(*by, year_month(time_col).alias("year_month")).agg(
        F.max(lc).alias("max_loaded_at"), F.count(F.lit(1)).alias("row_count"))


# ---------------------------------------------------------------- T07
def stream_alerts(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """One alert row per (row, broken rule) -- stateless, any sink."""
    arr = F.filter(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return df.withColumn("rule", F.explode(arr))


# ---------------------------------------------------------------- T08
def stream_sessions(df: DataFrame, gap: str = "2 hours", delay: str = "1 hour",
                    series: Sequence[str] = ("location", "data_key"), time_col: str = "time") -> DataFrame:
    """Activity sessions per series; the spans between them are outages."""
    x = with_event_time(df, time_col, delay)
    out = x.groupBy(F.session_window(EVENT_TS, gap).alias("_s"), *series).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*series, F.col("_s.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("_s.end").cast("timestamp_ntz").alias("session_end"), "n")

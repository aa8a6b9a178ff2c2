"""Tables as versions that name immutable partition files.

``files/run=<version>/<partition>`` holds what one run wrote. A version is
one small file under ``commits`` that names the folder of each of its
partitions; partitions a run did not touch are named again, not written.
The commit comes after the data, so a run that dies in between leaves the
version before it, whole. One writer at a time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.sources.sinks import TS_TEXT

COMMIT = "partition array<string>, run string, n long, fmt string, columns string, note string"
#: A version without any partition is one row that says so.
_NONE = "-"


def _root(root: str) -> str:
    return root.rstrip("/")


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(_root(root)).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """Finished versions, oldest first: those whose commit file is in place."""
    path, fs = _fs(spark, root)
    top = path(f"{_root(root)}/commits")
    if not fs.exists(top):
        return []
    found = [f.getPath() for f in fs.listStatus(top) if f.getPath().getName().startswith("version=")]
    done = [p.getName().removeprefix("version=") for p in found if any(f.getPath().getName().startswith("part-") for f in fs.listStatus(p))]
    return sorted(done)


def manifest(spark: SparkSession, root: str, version: str | None = None) -> list:
    """The partitions of a version (the newest by default): metadata, a row per partition."""
    version = version or max(versions(spark, root), default=None)
    if version is None:
        return []
    return spark.read.schema(COMMIT).parquet(f"{_root(root)}/commits/version={version}").collect()


def notes(spark: SparkSession, root: str) -> dict[tuple, str]:
    """What the newest version notes of each of its partitions."""
    return {tuple(r["partition"]): r["note"] for r in manifest(spark, root) if r["run"] != _NONE}


def runs(spark: SparkSession, root: str) -> dict[tuple, str]:
    """The run that wrote each partition of the newest version: the same run means the same files."""
    return {tuple(r["partition"]): r["run"] for r in manifest(spark, root) if r["run"] != _NONE}


def _folder(spark: SparkSession, root: str, by: Sequence[str], row) -> str:
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([f"{_root(root)}/files/run={row['run']}", *[name(c, v) for c, v in zip(by, row["partition"])]])


def commit(df: DataFrame, root: str, by: Sequence[str] = ("year_month",), replaced: Sequence[Sequence] = (),
           keep_if: Callable[[tuple], bool] | None = None, fmt: str = "parquet", note: str | Mapping[tuple, str] = "",
           within: Sequence[str] = ()) -> str:
    """A new version: the partitions in ``df`` take the place of theirs, and so do those of ``replaced``, even without rows.

    All others are carried over by name; those for which ``keep_if`` says
    no are left out (retention). With ``within`` the rows of a partition are
    in that order over its files, nulls last. ``note`` is kept beside the
    written partitions, one text or one for each.
    """
    spark, by = df.sparkSession, list(by)
    version = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    before = versions(spark, root)
    if before and version <= before[-1]:
        raise RuntimeError(f"{root}: the newest version {before[-1]} lies in the future")
    path = f"{_root(root)}/files/run={version}"
    columns = T.StructType([f for f in df.schema.fields if f.name not in by])
    # the hint gathers a partition's rows and splits what is larger than a task should write; a sort does so by ranges
    out = df.orderBy(*by, *[F.asc_nulls_last(c) for c in within]) if within else df.hint("rebalance", *by)
    writer = out.write.partitionBy(*by).mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("compression", "gzip").option("timestampNTZFormat", TS_TEXT).csv(path)
    else:
        writer.parquet(path)
    keys = T.StructType([T.StructField(c, T.StringType()) for c in by])
    full = T.StructType([*columns.fields, *keys.fields])
    # only partition values are asked for, so no column is read
    written = _reader(spark, fmt, full).load(path).groupBy(*by).agg(F.count("*").alias("n")).collect()
    told = (lambda partition: note) if isinstance(note, str) else (lambda partition: note.get(partition, ""))
    new = [(list(k), version, n, fmt, columns.json(), told(k)) for k, n in ((tuple(map(_text, r[:-1])), r["n"]) for r in written)]
    gone = {tuple(x[0]) for x in new} | {tuple(map(_text, r)) for r in replaced}
    keep = keep_if or (lambda partition: True)
    old = [tuple(r) for r in manifest(spark, root, before[-1]) if r["run"] != _NONE] if before else []
    rows = [r for r in [*[o for o in old if tuple(o[0]) not in gone], *new] if keep(tuple(r[0]))]
    rows = rows or [([], _NONE, 0, fmt, columns.json(), "")]
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.parquet(f"{_root(root)}/commits/version={version}")
    return version


def _text(v):
    return None if v is None else str(v)


def _reader(spark: SparkSession, fmt: str, schema: T.StructType):
    r = spark.read.schema(schema).format(fmt)
    return r.option("header", True).option("timestampNTZFormat", TS_TEXT) if fmt == "csv" else r


def read_snapshot(spark: SparkSession, root: str, by: Sequence[str] = ("year_month",), version: str | None = None,
                  only: Callable[[tuple], bool] | None = None) -> DataFrame | None:
    """The newest (or the named) version, partition columns last; ``None`` if there is none.

    ``only`` picks partitions by their values: the others are not even listed.
    """
    rows = manifest(spark, root, version)
    if not rows:
        return None
    keys = [T.StructField(c, T.StringType()) for c in by]
    columns = T.StructType.fromJson(_json(rows[0]["columns"]))
    full = T.StructType([*columns.fields, *keys])
    rows = [r for r in rows if r["run"] != _NONE and (only is None or only(tuple(r["partition"])))]
    if not rows:
        return spark.createDataFrame([], full)
    reader = _reader(spark, rows[0]["fmt"], full).option("basePath", f"{_root(root)}/files")
    return reader.load([_folder(spark, root, by, r) for r in rows]).select(*full.names)


def _json(text: str) -> dict:
    import json
    return json.loads(text)


def drop_versions(spark: SparkSession, root: str, by: Sequence[str] = ("year_month",), keep: int = 7) -> list[str]:
    """Forget all but the newest ``keep`` versions and delete the files that only those named.

    Commits go first, so no reader meets a version with missing files.
    What a run left behind that died before its commit goes as well.
    """
    all_ = versions(spark, root)
    old, kept = all_[:-keep], all_[-keep:]
    if not old:
        return []
    named = {(r["run"], tuple(r["partition"])) for v in kept for r in manifest(spark, root, v)}
    dropped = [r for v in old for r in manifest(spark, root, v) if r["run"] != _NONE and (r["run"], tuple(r["partition"])) not in named]
    path, fs = _fs(spark, root)
    for v in old:
        fs.delete(path(f"{_root(root)}/commits/version={v}"), True)
    for r in dropped:
        fs.delete(path(_folder(spark, root, by, r)), True)
    runs = {r for r, _ in named}
    for f in fs.listStatus(path(f"{_root(root)}/files")):
        run = f.getPath().getName().removeprefix("run=")
        if run <= kept[-1] and run not in runs:
            fs.delete(f.getPath(), True)
    return old


def upsert_snapshot(batch: DataFrame, root: str, key: Sequence[str], order: Sequence[str] = (), time_col: str = "time",
                    by: Sequence[str] = ("measurement", "year_month"), older: bool = False,
                    note: str | Mapping[tuple, str] = "") -> str | None:
    """U06 into a snapshot table: only the partitions the batch touches are read and written, and one commit makes all of them visible.

    ``older``: rows of the table win over those of the batch (a reload of earlier exports).
    """
    from sensorlake.functions.time import year_month
    from sensorlake.operators.merge import upsert
    spark = batch.sparkSession
    b = batch.withColumn("year_month", year_month(time_col)) if "year_month" in by else batch
    touched = {tuple(map(_text, r)) for r in b.select(*by).distinct().collect()}        # partition values, not rows
    if not touched:
        return None
    table = read_snapshot(spark, root, by, only=lambda p: p in touched)
    if table is None:
        return commit(upsert(b, None, [*key], order), root, by, note=note)
    table = table.select(b.columns)
    merged = upsert(b, table, [*key], order) if older else upsert(table, b, [*key], order)
    return commit(merged, root, by, replaced=touched, note=note)


def snapshot_writer(root: str, key: Sequence[str], order: Sequence[str] = (), time_col: str = "time",
                    by: Sequence[str] = ("measurement", "year_month"), keep: int = 3) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: each micro-batch is one version. A batch run again upserts the same rows and changes nothing."""
    def run(batch: DataFrame, epoch: int) -> None:
        upsert_snapshot(batch, root, key, order, time_col, by, note=f"batch {epoch}")
        drop_versions(batch.sparkSession, root, by, keep)
    return run

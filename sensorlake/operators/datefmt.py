"""Day/month order detection and parsing of device drops.

Input is the line table of ``sources.files.read_sensor_drops``:
(file, file_name, block, line_id, text). Line order inside a file is
(block, line_id). Windows are partitioned by (file, block), so no file is
ever sorted whole in one task; the state a block needs from the blocks
before it (the previous valid timestamp) comes from a one-row-per-block
summary. Everything else is grouped aggregation with partial combine.

``line_id`` orders lines within one scan only: another scan of the same
files may be split differently, so ids never cross scans. Detection tells
per file how many header lines look like data (``header_valid``, nearly
always 0: then the line rule F08 alone removes the header); only files
where some do are numbered again, inside the parsing scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions.quality import count_if
from sensorlake.functions.text import is_numeric, null_tokens, sensor_id
from sensorlake.functions.time import build_ts, ts_num, valid_day, ymd_num
from sensorlake.operators.filters import valid_line

FORMATS = ("DMY", "MDY")


def split_fields(lines: DataFrame) -> DataFrame:
    """Comma fields of each line plus the numeric date/time parts.

    Adds: date_text, time_text, temp_text, rh_text, valid, p1, p2, y, hh, mi, ss.
    Parts are NULL on lines that are not valid.
    """
    f = F.split(F.col("text"), ",")
    date_t = f.getItem(0)
    time_t = F.try_element_at(f, F.lit(2))
    valid = valid_line(date_t, time_t)
    if "is_header" in lines.columns:        # header lines never count as data
        valid = valid & ~F.col("is_header")
    t = F.split(time_t, ":")

    def part(e: Column) -> Column:
        return F.when(valid, e.cast("int"))

    return lines.select(
        "*",
        date_t.alias("date_text"), time_t.alias("time_text"),
        F.try_element_at(f, F.lit(3)).alias("temp_text"), F.try_element_at(f, F.lit(4)).alias("rh_text"),
        valid.alias("valid"),
        part(F.substring(date_t, 1, 2)).alias("p1"), part(F.substring(date_t, 4, 2)).alias("p2"),
        part(F.substring(date_t, 7, 4)).alias("y"),
        part(t.getItem(0)).alias("hh"), part(t.getItem(1)).alias("mi"),
        F.when(valid, F.coalesce(F.try_element_at(t, F.lit(3)).cast("int"), F.lit(0))).alias("ss"),
    )


def _with_readings(fields: DataFrame) -> DataFrame:
    """ts_mdy / ts_dmy: the line's timestamp number under each reading, NULL
    when the line is invalid or the date impossible under that reading."""
    v = F.col("valid")
    return (fields.withColumn("ts_mdy", F.when(v & valid_day(F.col("p2"), F.col("p1")),
                                               ts_num("y", "p1", "p2", "hh", "mi", "ss")))
                  .withColumn("ts_dmy", F.when(v & valid_day(F.col("p1"), F.col("p2")),
                                               ts_num("y", "p2", "p1", "hh", "mi", "ss"))))


def _in_block_window():
    return Window.partitionBy("file", "block").orderBy("line_id").rowsBetween(Window.unboundedPreceding, -1)


def _blocks_window():
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _in_block(x: DataFrame) -> DataFrame:
    """One ordered window per (file, block): previous valid timestamp of each reading."""
    w = _in_block_window()
    return (x.withColumn("_pm", F.last("ts_mdy", ignorenulls=True).over(w))
             .withColumn("_pd", F.last("ts_dmy", ignorenulls=True).over(w)))


def _header_flags(lines: DataFrame, header_lines: int) -> DataFrame:
    """Header flags from the line position inside block 0."""
    if "is_header" in lines.columns:
        return lines
    pos = F.row_number().over(Window.partitionBy("file", "block").orderBy("line_id")) - 1
    return lines.withColumn("is_header", (F.col("block") == 0) & (pos < header_lines))


PARTS = ("p1", "p2", "y", "hh", "mi", "ss")


def _positions(lines: DataFrame, header_lines: int) -> DataFrame:
    """Fields of each line without its text, with header flags: what is shuffled
    to the ordered windows is the file, the position and the small parts."""
    given = ["is_header"] if "is_header" in lines.columns else []
    fields = split_fields(lines.drop("is_header")) if not given else split_fields(
        lines.withColumn("_header", F.col("is_header")).drop("is_header")).withColumnRenamed("_header", "is_header")
    fields = fields.select("file", "file_name", "block", "line_id", "valid", *PARTS, *given)
    x = _header_flags(fields, header_lines)
    x = x.withColumn("header_valid", F.col("valid") & F.col("is_header")).withColumn("valid", F.col("valid") & ~F.col("is_header"))
    return x.select("file", "file_name", "block", "line_id", "is_header", "valid", "header_valid",
                    *[F.when(F.col("valid"), F.col(c)).alias(c) for c in PARTS])


def _first_last(col: str) -> list[Column]:
    key = F.when(F.col(col).isNotNull(), F.col("line_id"))
    return [F.min_by(F.col(col), key).alias(f"_first_{col}"), F.max_by(F.col(col), key).alias(f"_last_{col}")]


def _carry(blocks: DataFrame) -> DataFrame:
    """Per block: last valid timestamp of the nearest earlier block (per reading)."""
    w = _blocks_window()
    return (blocks.withColumn("_carry_mdy", F.last("_last_ts_mdy", ignorenulls=True).over(w))
                  .withColumn("_carry_dmy", F.last("_last_ts_dmy", ignorenulls=True).over(w)))


def order_breaks(fields: DataFrame) -> DataFrame:
    """Per line, whether its timestamp read as MDY / DMY is lower than the
    previous line that was a valid MDY / DMY date (the two readings are
    tracked apart; an invalid line does not reset them).

    Inside a block the previous value comes from the ordered window; the
    first line of a block compares with the last value of the earlier
    blocks (per-block summary, joined on the window's own partitioning).
    """
    x = _in_block(_with_readings(fields))
    blocks = _carry(x.groupBy("file", "block").agg(*_first_last("ts_mdy"), *_first_last("ts_dmy")))
    x = x.join(blocks.select("file", "block", "_carry_mdy", "_carry_dmy"), ["file", "block"], "inner")
    x = x.withColumn("prev_mdy", F.coalesce("_pm", "_carry_mdy")).withColumn("prev_dmy", F.coalesce("_pd", "_carry_dmy"))
    return (x.withColumn("break_mdy", F.coalesce(F.col("ts_mdy") < F.col("prev_mdy"), F.lit(False)))
             .withColumn("break_dmy", F.coalesce(F.col("ts_dmy") < F.col("prev_dmy"), F.lit(False)))
             .drop("_pm", "_pd", "_carry_mdy", "_carry_dmy"))


def _bits(c: Column, lo: int) -> Column:
    """One bit per two-digit value (two 64-bit words cover 0..99)."""
    inside = c.between(lo, lo + 62)
    return F.when(inside, F.pow(F.lit(2.0), c - lo).cast("long"))   # exact: powers of two below 2^63


def date_evidence(lines: DataFrame, header_lines: int = 2) -> DataFrame:
    """A06 (+W02): per file -- data lines, valid lines, distinct first/second
    parts, DMY/MDY hints, order breaks in each reading, last valid line.

    A parallel prefix over blocks: one ordered window per (file, block)
    yields the breaks inside each block; each block is summarised (counts,
    bitmasks of the day/month parts seen, first/last timestamp of each
    reading, last valid line); the few rows per file are then combined --
    including the breaks at block starts -- without moving any line again.
    """
    x = _in_block(_with_readings(_positions(lines, header_lines)))
    v = F.col("valid")
    p1, p2 = F.col("p1"), F.col("p2")
    data = ~F.col("is_header")
    blocks = x.groupBy("file", "file_name", "block").agg(
        count_if(data).alias("n_lines"),
        count_if(v).alias("n_valid"),
        F.bit_or(_bits(p1, 0)).alias("m1a"), F.bit_or(_bits(p1, 63)).alias("m1b"),
        F.bit_or(_bits(p2, 0)).alias("m2a"), F.bit_or(_bits(p2, 63)).alias("m2b"),
        count_if(v & (p1 > 12) & (p2 <= 12)).alias("hint_dmy"),
        count_if(v & (p2 > 12) & (p1 <= 12)).alias("hint_mdy"),
        count_if(F.col("ts_dmy") < F.col("_pd")).alias("in_dmy"),
        count_if(F.col("ts_mdy") < F.col("_pm")).alias("in_mdy"),
        *_first_last("ts_mdy"), *_first_last("ts_dmy"),
        # last valid line's parts packed in one long (p1, p2 < 100, y < 10000):
        # primitive buffers keep this a hash aggregate
        F.max_by(F.col("p1") * 1000000 + F.col("p2") * 10000 + F.col("y"), F.when(v, F.col("line_id")))
         .alias("_last_line"),
        count_if(F.col("header_valid")).alias("header_valid"),
    )
    blocks = _carry(blocks)
    pops = [F.bit_count(F.coalesce(F.bit_or(c), F.lit(0).cast("long"))) for c in ("m1a", "m1b", "m2a", "m2b")]
    out = blocks.groupBy("file", "file_name").agg(
        F.sum("n_lines").alias("n_lines"),
        F.sum("n_valid").alias("n_valid"),
        (pops[0] + pops[1]).cast("long").alias("uniq_p1"),
        (pops[2] + pops[3]).cast("long").alias("uniq_p2"),
        F.sum("hint_dmy").alias("hint_dmy"),
        F.sum("hint_mdy").alias("hint_mdy"),
        (F.sum("in_dmy") + count_if(F.col("_first_ts_dmy") < F.col("_carry_dmy"))).alias("breaks_dmy"),
        (F.sum("in_mdy") + count_if(F.col("_first_ts_mdy") < F.col("_carry_mdy"))).alias("breaks_mdy"),
        F.max_by(F.col("_last_line"), F.when(F.col("_last_line").isNotNull(), F.col("block"))).alias("_last"),
        F.sum("header_valid").alias("header_valid"),
    )
    code = F.col("_last")
    last = F.when(code.isNotNull(), F.struct((code / 1000000).cast("int").alias("p1"),
                                             ((code / 10000) % 100).cast("int").alias("p2"),
                                             (code % 10000).cast("int").alias("y")))
    return out.withColumn("last", last).drop("_last")


def last_valid_line(lines: DataFrame) -> DataFrame:
    """The last line of each file that passes F08."""
    s = split_fields(lines)
    return s.groupBy("file", "file_name").agg(
        F.max_by(F.col("text"), F.when(F.col("valid"), F.struct("block", "line_id"))).alias("last_line"))


def _ymd_int(d: _dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def decide(evidence: DataFrame, today: _dt.date | str, strict: bool = True, default: str = "DMY",
           force: str | None = None, window_days: int = 6) -> DataFrame:
    """D01 decision, first rule that separates (rule name in ``rule``)."""
    if isinstance(today, str):
        today = _dt.date.fromisoformat(today)
    t = _ymd_int(today)
    ws = _ymd_int(today - _dt.timedelta(days=window_days))
    last = F.col("last")
    md = F.when(valid_day(last.p2, last.p1), ymd_num(last.y, last.p1, last.p2)).otherwise(F.lit(-1))
    dm = F.when(valid_day(last.p1, last.p2), ymd_num(last.y, last.p2, last.p1)).otherwise(F.lit(-1))
    in_md = md.between(ws, t)
    in_dm = dm.between(ws, t)
    hd, hm = F.col("hint_dmy"), F.col("hint_mdy")
    bd, bm = F.col("breaks_dmy"), F.col("breaks_mdy")
    u1, u2 = F.col("uniq_p1"), F.col("uniq_p2")
    fallback = F.lit("UNKNOWN") if strict else F.lit(default)
    steps = [
        (F.col("sensor").isNull(), F.lit("SKIPPED"), "no_sensor"),
        (F.col("n_lines") == 0, F.lit("SKIPPED"), "empty"),
    ]
    if force:
        steps.append((F.lit(True), F.lit(force), "force"))
    steps += [
        (F.col("n_valid") == 0, F.lit("UNKNOWN"), "no_valid_line"),
        ((md == t) & (dm != t), F.lit("MDY"), "today"),
        ((dm == t) & (md != t), F.lit("DMY"), "today"),
        (in_md & ~in_dm, F.lit("MDY"), "last_week"),
        (in_dm & ~in_md, F.lit("DMY"), "last_week"),
        ((u2 == 1) & (u1 > 1), F.lit("DMY"), "constant_part"),
        ((u1 == 1) & (u2 > 1), F.lit("MDY"), "constant_part"),
        (hd > hm, F.lit("DMY"), "hints"),
        (hm > hd, F.lit("MDY"), "hints"),
        (bd < bm, F.lit("DMY"), "breaks"),
        (bm < bd, F.lit("MDY"), "breaks"),
        (F.lit(True), fallback, "strict" if strict else "default"),
    ]
    fmt = rule = None
    for cond, value, name in reversed(steps):
        fmt = value if fmt is None else F.when(cond, value).otherwise(fmt)
        rule = F.lit(name) if rule is None else F.when(cond, F.lit(name)).otherwise(rule)
    return evidence.withColumn("fmt", fmt).withColumn("rule", rule)


def detect_date_format(lines: DataFrame, today, strict: bool = True, default: str = "DMY",
                       force: str | None = None, header_lines: int = 2) -> DataFrame:
    """One decision row per file: (file, file_name, sensor, fmt, rule, evidence...).

    ``lines`` must include the header lines (``drop_lines`` or
    ``read_sensor_drops(keep_header=True)``) so that files with no data line
    are still listed (rule ``empty``). ``header_valid`` counts header lines
    that pass the line rule, which ``parse_drops`` must find by position.
    """
    ev = date_evidence(lines, header_lines)
    ev = ev.withColumn("sensor", sensor_id(F.col("file_name")))
    out = decide(ev, today, strict, default, force)
    return out.select("file", "file_name", "sensor", "fmt", "rule", "n_lines", "n_valid", "uniq_p1", "uniq_p2",
                      "hint_dmy", "hint_mdy", "breaks_dmy", "breaks_mdy",
                      F.col("last.p1").alias("last_p1"), F.col("last.p2").alias("last_p2"), F.col("last.y").alias("last_y"),
                      "header_valid")


def _tokens(lines: DataFrame) -> DataFrame:
    s = split_fields(lines).filter(F.col("valid"))
    return (s.withColumn("temp", null_tokens(F.coalesce(F.col("temp_text"), F.lit(""))))
             .withColumn("rh", null_tokens(F.coalesce(F.col("rh_text"), F.lit(""))))
             .withColumn("had_any", F.col("temp").isNull() | F.col("rh").isNull())
             .withColumn("had_both", F.col("temp").isNull() & F.col("rh").isNull()))


def _parsed(lines: DataFrame, decisions: DataFrame, header_lines: int):
    """(rows of ``parse_drops`` before they are told apart, whether a row is bad, its reason, columns of a good row by name)."""
    from sensorlake.session import scratch_path
    spark = lines.sparkSession
    path = scratch_path(spark, "drop-decisions")        # one row per file, read by several branches
    decisions.filter(F.col("fmt").isin(*FORMATS)).select(
        "file", "fmt", F.col("sensor").alias("Location"), "header_valid").write.parquet(path)
    fmt = spark.read.parquet(path)
    if "is_header" in lines.columns:
        x = lines.join(fmt, "file").filter(~F.col("is_header")).drop("is_header")
    else:
        # F08 removes the headers, unless they look like data
        x = lines.join(fmt.filter(F.col("header_valid") == 0), "file")
        odd = fmt.filter(F.col("header_valid") > 0)
        if not odd.isEmpty():
            x = x.unionByName(_header_flags(lines.join(odd, "file"), header_lines).filter(~F.col("is_header")).drop("is_header"))
    x = _tokens(x)
    dmy = F.col("fmt") == "DMY"
    day = F.when(dmy, F.col("p1")).otherwise(F.col("p2"))
    month = F.when(dmy, F.col("p2")).otherwise(F.col("p1"))
    x = x.filter(~F.col("had_both")).withColumn("month", month).withColumn(
        "Datetime", build_ts(F.col("y"), month, day, F.col("hh"), F.col("mi"), F.col("ss")))
    bad_num = ((F.col("temp").isNotNull() & ~is_numeric("temp")) | (F.col("rh").isNotNull() & ~is_numeric("rh")))
    bad = F.coalesce(bad_num, F.lit(False)) | F.col("Datetime").isNull()
    reason = F.when(F.col("month") > 12, "month_gt_12").when(F.col("Datetime").isNull(), "bad_timestamp") \
        .when(bad_num, "non_numeric")
    cols = {"Datetime": F.col("Datetime"), "Temperature_Celsius": F.col("temp").cast("double"),
            "Relative_Humidity(%)": F.col("rh").cast("double"), "Location": F.col("Location")}
    if "mtime" in lines.columns:            # lines that know their origin give rows that do
        from sensorlake.sources.files import load_seq
        place = F.col("block") + F.col("line_id").bitwiseAND((1 << 33) - 1)
        cols["load_seq"] = load_seq(F.col("file"), F.col("mtime"), place)
    return x, bad, reason, cols


def parse_drops(lines: DataFrame, decisions: DataFrame, on_bad: str = "quarantine", header_lines: int = 2, keep: Sequence[str] = ()):
    """Valid lines -> (Datetime, Temperature_Celsius, Relative_Humidity(%), Location).

    Day/month follow the file's decided format; null tokens become NULL;
    rows with both measures NULL are dropped; non-numeric measures and
    impossible timestamps (month > 12, 31/02, 99:99) go to quarantine (or
    fail the job with ``on_bad='fail'``). Files whose format is not
    DMY/MDY are not parsed. ``keep`` names columns of ``lines`` that go into
    both results. Returns (good, quarantine).
    """
    x, bad, reason, cols = _parsed(lines, decisions, header_lines)
    cols = [c.alias(name) for name, c in cols.items()] + list(keep)
    quarantine = x.filter(bad).select("file", "line_id", "text", reason.alias("reason"), *keep)
    if on_bad == "fail":
        # the assertion is the only predicate, so it is evaluated on every row
        # (NULL when it holds); a bad row fails the job
        good = x.filter(F.assert_true(~bad, F.lit("bad drop line (non-numeric or impossible date)")).isNull())
        return good.select(*cols), quarantine.limit(0)
    good = x.filter(~bad).select(*cols)
    return good, quarantine


def parse_drops_once(lines: DataFrame, decisions: DataFrame, header_lines: int = 2, keep: Sequence[str] = ()):
    """``parse_drops`` for callers that read both results: the lines are parsed once, the rows stored and told apart."""
    from sensorlake.session import scratch_path
    x, bad, reason, cols = _parsed(lines, decisions, header_lines)
    place = ("file", "line_id", "text")
    path = scratch_path(lines.sparkSession, "drop-rows")
    x.select(bad.alias("_bad"), *[F.when(~bad, c).alias(name) for name, c in cols.items()],
             *[F.when(bad, F.col(c)).alias(c) for c in place], reason.alias("reason"), *keep).write.parquet(path)
    rows = lines.sparkSession.read.parquet(path)
    return (rows.filter(~F.col("_bad")).select(*[F.col(f"`{name}`") for name in cols], *keep),
            rows.filter("_bad").select(*place, "reason", *keep))


def sensor_health(lines: DataFrame) -> DataFrame:
    """Per sensor file -- input data lines (K14), valid lines, rows with any
    null token, rows with both (the "check batteries" case), rows kept."""
    s = _tokens(lines.select("file", "file_name", "block", "line_id", "text"))
    valid_stats = s.groupBy("file_name").agg(
        count_if(F.col("had_any")).alias("rows_any_null"),
        count_if(F.col("had_both")).alias("rows_both_null"),
        count_if(~F.col("had_both")).alias("rows_kept"),
        F.count(F.lit(1)).alias("valid_lines"))
    all_lines = lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("input_lines"))
    out = all_lines.join(valid_stats, "file_name", "left").fillna(0)
    return out.select(sensor_id(F.col("file_name")).alias("sensor"), "file_name", "input_lines", "valid_lines",
                      "rows_any_null", "rows_both_null", "rows_kept",
                      (F.col("rows_both_null") > 0).alias("check_batteries"))


def merge_drops(spark, path: str, today, strict: bool = True, default: str = "DMY", force: str | None = None,
                on_bad: str = "quarantine", origin: bool = False):
    """Entry 2 front half: drops -> merged indoor table (+ decisions, quarantine).

    ``origin`` adds ``load_seq``, the write order of each row.

    Two passes over the text: detection (one shuffle of the lines), then
    parsing (lines joined with the broadcast per-file decisions, no shuffle).
    """
    from sensorlake.session import materialize
    from sensorlake.sources.files import drop_lines
    lines = drop_lines(spark, path, origin)
    decisions = materialize(detect_date_format(lines, today, strict, default, force))      # one row per file, read twice
    good, quarantine = parse_drops(lines, decisions, on_bad)
    return good, decisions, quarantine


"""Small helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup tables (seeds, dimensions) are broadcast up to this many rows and bytes.
DEFAULT_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def proven_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True if ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes of text form.

    One ``limit(max_rows + 1)`` job, which stops reading as soon as the row bound is exceeded.
    """
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    found = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                      materialize_first: bool = False) -> DataFrame:
    """Broadcast hint only for a side proven to be small in rows and bytes.

    Beyond the bound the plain frame is returned and the planner (AQE on
    runtime sizes) picks a shuffle join. ``max_rows=None`` skips the check
    and leaves the choice to AQE. ``materialize_first`` stores a derived side
    (e.g. one row per input file computed from all lines) in the checkpoint
    folder before the check, so the proof and the join do not each recompute it.
    """
    if max_rows is None:
        return df
    if materialize_first:
        from sensorlake.session import materialize
        df = materialize(df)
    return F.broadcast(df) if proven_small(df, max_rows) else df

"""Words of letters and digits in A-Z lower case, and blocks of a query table of proven size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import word_bounds

#: What a byte of UTF-8 text becomes: a blank outside of words, a small letter for a capital.
_PLAIN = np.full(256, 32, np.uint8)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _PLAIN[_a:_b] = np.arange(_a, _b)
_PLAIN[0x41:0x5B] += 32


def words(flat: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of consecutive texts as one binary array, and per text the number of its first word (n + 1).

    Words are runs of digits, A-Z, a-z and characters from U+0080 on.
    """
    plain = _PLAIN[flat]
    starts, ends, first = word_bounds(plain, offsets)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    body = plain[plain != 32]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)]), first


def blocks(rows: DataFrame, weight: str, most: int) -> list[DataFrame]:
    """Disjoint parts of distinct rows, each measured to hold at most ``most`` of ``weight`` (or a single heavier row).

    A stated query set is worked off part by part, so what is sent to the
    tasks at once has a bound whatever the size of the set.
    """
    number = 1
    while True:
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(number))
        sizes = rows.groupBy(part.alias("part")).agg(F.sum(weight).alias("w"), F.count("*").alias("n"))
        worst = sizes.where("n > 1").agg(F.max("w")).first()[0]
        if worst is None or worst <= most:
            return [rows.where(part == p) for p in range(number)]
        number *= 2

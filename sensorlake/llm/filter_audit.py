"""How filters interact: a Gray-code walk over all subsets of five filters.

Each document is judged once; what the walk reads are the cells (part, mask
of failed filters) with their documents, good documents and toxic ones.
The walk visits the 32 subsets of filters in Gray order, so each move
toggles one filter. Every cell keeps a counter of its failures among the
active filters: a counter that rises to one takes the cell from the running
survivors, one that falls to zero gives it back. The survivors of each
subset are stored; any step of any order of the filters is the difference
of two stored states, and so are redundant failures and Shapley sums.

The filters (A to E, fixed values below) read whole texts. E compares
texts by their SHA-256: the smallest id of each text passes. Copies of a
text meet only as partial aggregates, and a text's smallest id is joined
back by (text, id), so a text held by a third of all rows is not a hot key.

Defined results: a null text is an empty text, and all of those are
identical; a null source is the part ''; a null id is neither smaller than
another nor has a smaller one; rows with equal ids and texts are not copies
of each other and all counted; of several labels of one id any quality 1
and any toxic 1 counts; labels without an id belong to no document; an empty table
has no part; further columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import col, staged, table, words_of

# The filters' letters and limits.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
COUNTS = ("n", "n_good", "n_toxic")


def judged(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, mask, same): bits of the failed filters A to D, and the hash that stands for the text."""
    body = F.coalesce(col(text), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"),
                       body.alias("body"), words_of(col(text)).alias("words"))
    n = F.size("words")
    fails = [n < MIN_WORDS, 100 * F.size(F.array_distinct("words")).cast("long") < MIN_DISTINCT_PERCENT * n.cast("long"),
             100 * F.regexp_count("body", F.lit("[A-Z]")).cast("long") > MAX_CAPITALS_PERCENT * F.length("body").cast("long"),
             F.col("body").rlike(SYMBOLS)]
    mask = F.lit(0)
    for bit, fail in enumerate(fails):
        mask = mask.bitwiseOR(F.when(fail, F.lit(1 << bit)).otherwise(F.lit(0)))
    return rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("same"))


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents by the set of filters they fail, E among them."""
    # texts are read once: two branches read the narrow rows; equal rows become one with a count
    rows = staged(judged(docs, id_col, text, part).groupBy("id", "part", "mask", "same").agg(F.count("*").alias("n")), "filter-judged")
    firsts = (rows.where("id IS NOT NULL").groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True)))
    told = (labels.where(col(id_col).isNotNull()).groupBy(col(id_col).alias("id"))
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")))
    rows = rows.join(firsts, ["id", "same"], "left").join(told, "id", "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask").bitwiseOR(F.when(copy, F.lit(1 << 4)).otherwise(F.lit(0)))
    counted = lambda flag: F.sum(F.when(F.col(flag) == 1, F.col("n")).otherwise(F.lit(0).cast("long")))
    return rows.groupBy("part", mask.alias("mask")).agg(F.sum("n").alias("n"), counted("good").alias("n_good"),
                                                       counted("bad").alias("n_toxic"))


def gray_walk(cell_counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters.

    ``cell_counts`` is (parts, masks, measures); the result has the subset in place of the mask.
    """
    masks = np.arange(1 << filters)
    failing = np.zeros(1 << filters, np.int64)      # active filters that each cell fails
    survivors = cell_counts.sum(axis=1)
    states = np.empty_like(cell_counts)
    states[:, 0] = survivors
    active = 0
    for move in range(1, 1 << filters):
        bit = (move & -move).bit_length() - 1       # the bit in which neighbours of the Gray order differ
        hit = masks >> bit & 1 == 1
        active ^= 1 << bit
        if active >> bit & 1:
            failing[hit] += 1
            survivors = survivors - cell_counts[:, hit & (failing == 1)].sum(axis=1)
        else:
            failing[hit] -= 1
            survivors = survivors + cell_counts[:, hit & (failing == 0)].sum(axis=1)
        states[:, active] = survivors
    return states


def _steps(counts: np.ndarray, letters: str) -> tuple[list[tuple[str, int]], np.ndarray]:
    """(order, step) of every row and (parts, rows, columns) of its figures."""
    k = len(letters)
    states = gray_walk(counts, k)
    total, alone = states[:, 0] - states[:, [1 << f for f in range(k)]].transpose(1, 0, 2), counts[:, [1 << f for f in range(k)], 0]
    shapley = np.zeros((len(counts), k), np.int64)
    for f in range(k):
        for s in range(1 << k):
            if not s >> f & 1:
                before = s.bit_count()
                shapley[:, f] += factorial(before) * factorial(k - 1 - before) * (states[:, s, 0] - states[:, s | 1 << f, 0])
    names, figures = [], []
    for order in permutations(range(k)):
        done = 0
        for step, f in enumerate(order, 1):
            gone = states[:, done] - states[:, done | 1 << f]
            done |= 1 << f
            names.append(("".join(letters[i] for i in order), step))
            figures.append(np.stack([states[:, done, 0], gone[:, 0], total[f][:, 0] - gone[:, 0], alone[:, f], gone[:, 1], gone[:, 2],
                                     shapley[:, f]], axis=1))
    return names, np.stack(figures, axis=1)


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(cell_rows: DataFrame, letters: str = FILTERS, together: int = 64) -> DataFrame:
    """Per part, order of the filters and step: the seven figures. One walk serves up to ``together`` parts."""
    size = 1 << len(letters)
    cell = F.struct("mask", *COUNTS)
    # at most one entry a mask, so a part's cells are a bounded row
    parts = cell_rows.groupBy("part").agg(F.collect_list(cell).alias("cells"))

    def walk(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, together):
                some = batch.slice(a, together)
                counts = np.zeros((some.num_rows, size, len(COUNTS)), np.int64)
                for p, entries in enumerate(some.column("cells").to_pylist()):
                    for e in entries:
                        counts[p, e["mask"]] = [e[c] for c in COUNTS]
                names, figures = _steps(counts, letters)
                n = len(names)
                orders, steps = zip(*names)
                yield pa.RecordBatch.from_arrays(
                    [some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), n))), pa.array(orders * some.num_rows),
                     pa.array(steps * some.num_rows, pa.int32())]
                    + [pa.array(figures[:, :, i].ravel(), pa.int64()) for i in range(len(FIGURES))],
                    ["part", "filter_order", "step", *FIGURES])

    return parts.mapInArrow(walk, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in FIGURES))


def op12_filter_audit(spark, sf_dir):
    """Per source, order of the five filters and step: what is kept, removed, redundant, lost, and Shapley sums."""
    return audit(cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask,
        coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS n_good, sum(bad) AS n_toxic FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step - 1]) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, any_value(own) AS own,
        sum(CASE WHEN mask & (coalesce(before, 0) | own) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & coalesce(before, 0) <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & own <> 0 THEN n_good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & own <> 0 THEN n_toxic ELSE 0 END) AS toxic_lost
      FROM c, (SELECT filter_order, step, CAST(own AS INTEGER) AS own, CAST(before AS INTEGER) AS before FROM s) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""

"""Substring deduplication over anchored blocks and the windows at their boundaries.

This stands in for relative Lempel-Ziv parsing: no longest factors are
sought and none are merged. The result asked for is a union of fixed
windows of ``min_words`` words, not a parse, and block contents and
windows compared by hash give that union exactly, by aggregates and joins
whose rows stay independent; extending a match over the blocks that
follow would need the reference documents in sequence.

Every document is cut into reference blocks at content-defined anchors: a
window of ``min_words`` words belongs to its smallest (leftmost on ties)
hashed gram of ``anchor_words`` words, and consecutive windows with the
same anchor form a block. Equal windows have equal anchors wherever they
stand, so indexing blocks by anchor misses no repetition; about one row
per twenty words reaches a shuffle.

A block whose whole content is held by a document with a smaller id is
covered as a whole. Where an anchor is shared but block contents differ,
the windows of the blocks not covered so are looked up one by one.
Covered words are the union of blocks and windows: exactly
the words of windows that also start in a document with a smaller id.

Identity is by 128 bits: a word has two independent 64-bit hashes (the
halves of its XXH3-128), blocks are told apart by a polynomial of the one
and their anchor of the other, windows by one polynomial of each.

Defined results: null or empty text has no words; documents shorter than
``min_words`` lose nothing; rows with equal ids do not remove each other's
words; rows with a null id lose nothing and are no reference; an empty
table gives an empty result; further columns are carried, never read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, col, slices, staged, table, text_buffer, text_key, word_bounds

MIN_WORDS, ANCHOR_WORDS = 50, 10
_M = (1 << 64) - 1


class _Spans:
    """Polynomial hashes modulo 2^64 of spans of a sequence, from one running sum."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(values)
        self._powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=total[1:])
        return mixed((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Odd bases of independent families for words in a span.
_GRAM, _BLOCK, _WINDOW_1, _WINDOW_2 = (_Spans(b) for b in (
    0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_IS_GAP = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word; every different word is hashed once."""
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    body = flat[~_IS_GAP[flat]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)])
    coded = words.dictionary_encode()
    both = np.array([divmod(xxhash.xxh3_128_intdigest(w), 1 << 64) for w in coded.dictionary.to_pylist()], np.uint64).reshape(-1, 2)
    code = coded.indices.to_numpy()
    return both[code, 0], both[code, 1]


def _blocks(words: np.ndarray, others: np.ndarray, first: np.ndarray, size: int, k: int):
    """Blocks of consecutive documents: row, start (word in its row), windows, anchor hash, content hash.

    ``words`` and ``others`` are the words' two hashes; ``first[i]`` is the number of row i's first word.
    """
    n = len(words)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < size:
        return none
    at = np.arange(n - k + 1)
    value = _GRAM(words, at, at + k)
    place = at
    span, width = size - k + 1, 1               # grams in a window; smallest over [i, i + width)
    while width < span:
        step = min(width, span - width)
        left, right = value[:-step], value[step:]
        take = right < left
        place = np.where(take, place[step:], place[:-step])
        value = np.where(take, right, left)
        width += step
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.arange(len(value))
    good = starts + size <= first[1:][row[:len(value)]]
    starts, place, row = starts[good], place[good], row[:len(value)][good]
    if not len(starts):
        return none
    head = np.ones(len(starts), bool)
    head[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(starts)))
    begin, row = starts[at], row[at]
    anchor = _GRAM(words, place[at], place[at] + k)
    content = _BLOCK(others, begin, begin + length + size - 1)
    return row, begin - first[row], length, anchor, content


def _lists(values: np.ndarray, offsets: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def blocks(docs: DataFrame, id_col: str, text: str, size: int, k: int) -> DataFrame:
    """One row per document: id, key (hash of its text), n_words, sha256 of its words, and lists of its blocks."""
    bound_batches(docs.sparkSession)
    source = docs.select(col(id_col).alias("id"), text_key(text).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            flat, offsets = text_buffer(batch.column("text"))
            for a, b in slices(offsets, 2 << 20):
                part, own = flat[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                starts, ends, first = word_bounds(part, own)
                row, begin, length, anchor, content = _blocks(*word_hashes(part, starts, ends), first, size, k)
                raw = part.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[own[i]:own[i + 1]].split())).hexdigest() for i in range(b - a)]
                cut = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), batch.column("key").slice(a, b - a),
                    pa.array(np.diff(first)), pa.array(sha), _lists(begin, cut, pa.int64()),
                    _lists(length, cut, pa.int64()), _lists(anchor.view(np.int64), cut, pa.int64()),
                    _lists(content.view(np.int64), cut, pa.int64())],
                    ["id", "key", "n_words", "sha", "begin", "length", "anchor", "content"])

    return source.mapInArrow(each, f"id {kind}, key long, n_words long, sha string, begin array<long>, "
                                   "length array<long>, anchor array<long>, content array<long>")


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """(id, key, start, w1, w2) of the windows of the blocks listed in each row (id, key, text, at, n)."""
    kind = rows.schema["id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            flat, offsets = text_buffer(batch.column("text"))
            at, many = batch.column("at").to_pylist(), batch.column("n").to_pylist()
            ids, keys = batch.column("id"), batch.column("key")
            for i in range(batch.num_rows):
                part = flat[offsets[i]:offsets[i + 1]]
                starts, ends, _ = word_bounds(part, np.array([0, len(part)]))
                words, others = word_hashes(part, starts, ends)
                s = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(at[i], many[i])]))
                one = pa.array(np.full(len(s), i))
                yield pa.RecordBatch.from_arrays([
                    ids.take(one), keys.take(one), pa.array(s), pa.array(_WINDOW_1(words, s, s + size).view(np.int64)),
                    pa.array(_WINDOW_2(others, s, s + size).view(np.int64))], ["id", "key", "start", "w1", "w2"])

    return rows.mapInArrow(each, f"id {kind}, key long, start long, w1 long, w2 long")


def _without(rows: DataFrame, size: int) -> DataFrame:
    """(id, key, n_removed, kept) from rows (id, key, text, at, n): words at .. at + n + size - 2 go."""
    kind = rows.schema["id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            removed, kept = [], []
            for text, at, many in zip(batch.column("text").to_pylist(), batch.column("at").to_pylist(),
                                      batch.column("n").to_pylist()):
                words = text.encode().split()
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, np.array(at), 1)
                np.add.at(step, np.array(at) + np.array(many) + size - 1, -1)
                stay = np.cumsum(step[:-1]) == 0
                removed.append(len(words) - int(stay.sum()))
                kept.append(b" ".join(compress(words, stay.tolist())).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], ["id", "key", "n_removed", "kept"])

    return rows.mapInArrow(each, f"id {kind}, key long, n_removed long, kept string")


def parse(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
          anchor_words: int = ANCHOR_WORDS) -> tuple[DataFrame, DataFrame]:
    """Per document (id, key, n_words, sha); and for those that lose words (id, key, n_removed, kept).

    ``key`` is ``xxhash64(coalesce(text, ''))``: with the id it names a row's content.
    """
    k = min(anchor_words, min_words)
    whole = staged(blocks(docs, id_col, text, min_words, k), "blocks")
    runs = (whole.where("id IS NOT NULL").select("id", "key", F.explode(F.arrays_zip("begin", "length", "anchor", "content")).alias("b"))
            .select("id", "key", F.col("b.begin").alias("at"), F.col("b.length").alias("n"), F.col("b.anchor").alias("anchor"),
                    F.col("b.content").alias("content")))
    # anchors of two documents at least: partial aggregates take a frequent anchor apart before the shuffle
    # aggregates are written before they are joined, so the join's large side is a plain exchange that Spark can split
    shared = staged(runs.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                    .where("low < high").select("anchor"), "shared-anchors")
    runs = staged(runs.join(shared, "anchor", "left_semi"), "shared-blocks")
    variants = staged(runs.groupBy("anchor", "content", "n").agg(F.min("id").alias("first_id")), "block-contents")
    # more than one content under an anchor: a factor boundary
    mixed_up = staged(variants.groupBy("anchor").agg(F.min("content").alias("c0"), F.max("content").alias("c1"),
                                                     F.min("n").alias("n0"), F.max("n").alias("n1"))
                      .where("c0 <> c1 OR n0 <> n1").select("anchor"), "boundary-anchors")
    judged = staged(runs.join(variants, ["anchor", "content", "n"]).select(
        "id", "key", "at", "n", "anchor", (F.col("first_id") < F.col("id")).alias("factor")), "judged-blocks")
    factors = judged.where("factor").select("id", "key", "at", "n")
    edges = judged.where("NOT factor").join(mixed_up, "anchor", "left_semi").select("id", "key", "at", "n")
    texts = docs.select(col(id_col).alias("id"), text_key(text).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    per_doc = (factors.withColumn("edge", F.lit(False)).union(edges.withColumn("edge", F.lit(True)))
               .groupBy("id", "key").agg(
                   # sets: a row repeated many times gathers its blocks once, so never more than a document's words
                   F.collect_set(F.when(~F.col("edge"), F.struct("at", "n"))).alias("factors"),
                   F.collect_set(F.when(F.col("edge"), F.struct("at", "n"))).alias("edges")))
    touched = staged(texts.join(per_doc, ["id", "key"]).dropDuplicates(["id", "key"]), "touched-documents")
    windows = staged(_windows(touched.where(F.size("edges") > 0).select(
        "id", "key", "text", F.col("edges.at").alias("at"), F.col("edges.n").alias("n")), min_words), "boundary-windows")
    known = staged(windows.groupBy("w1", "w2").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high"),
                   "repeated-windows")
    repeated = (windows.join(known, ["w1", "w2"]).where("low < id").groupBy("id", "key").agg(
        F.collect_list(F.struct(F.col("start").alias("at"), F.lit(1).cast("long").alias("n"))).alias("more")))
    spans = touched.join(repeated, ["id", "key"], "left").select(
        "id", "key", "text", F.concat("factors", F.coalesce("more", F.array().cast("array<struct<at:bigint,n:bigint>>"))).alias("s"))
    removed = _without(spans.where(F.size("s") > 0).select(
        "id", "key", "text", F.col("s.at").alias("at"), F.col("s.n").alias("n")), min_words)
    return whole.select("id", "key", "n_words", "sha"), removed


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its columns; texts that lose words are their kept words joined by one space."""
    _, removed = parse(docs, id_col, text, min_words)
    cut = removed.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("kept").alias("__kept"))
    joined = docs.join(cut, (docs[f"`{id_col}`"] == cut["__id"]) & (text_key(text) == cut["__key"]), "left")
    return joined.select(*[F.coalesce("__kept", col(c)).alias(c) if c == text else col(c) for c in docs.columns])


def op5_substring_dedup(spark, sf_dir):
    """Per document its words, the words removed, and the SHA-256 of the words kept."""
    whole, removed = parse(table(spark, sf_dir, "documents"))
    cut = removed.select("id", "key", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("cut_sha"))
    return whole.join(cut, ["id", "key"], "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("cut_sha", "sha").alias("kept_sha256"))

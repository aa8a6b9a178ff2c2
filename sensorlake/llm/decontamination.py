"""Benchmark decontamination with an FM-index per training shard.

Words of documents are gathered in shards of at most ``SHARD_WORDS``. For
each shard a task sorts the suffixes of its words (prefix doubling over the
suffixes that are still tied; a terminator of its own ends every document,
so copies do not stay tied beyond their end) and stores an FM-index as one
row: the shard's dictionary, symbol counts, the last column of the sorted
suffixes as a wavelet matrix, and the text positions of every
``SAMPLE``-th word and of document starts. The index does not depend on
the benchmark and serves several of them.

Test phrases, the windows of ``WINDOW`` consecutive words of an item, are
found by backward search: each word narrows an interval of sorted suffixes
by two ranks in the wavelet matrix, all phrases of a block at once.
Occurrences are located by stepping back to the next sampled position, and
overlapping or adjoining ones are merged into the spans to remove. Items
are worked off in blocks of bounded size, each over all shards.

A document longer than a shard is cut into pieces that overlap by
``WINDOW - 1`` words; its spans are merged again at the end.

Defined results: null or empty text has no words; an item without words
has no phrase, one with fewer than ``WINDOW`` words is one phrase; an item
without an id has its words marked but is neither listed nor counted; rows
of one item id are one item; repeated documents repeat their result; empty
documents or an empty benchmark give no hit; further columns are not
looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, col, staged, table, text_buffer
from sensorlake.llm._words import blocks, words

WINDOW, SHARD_WORDS, SAMPLE = 10, 1 << 20, 16
#: Words of test items that one pass over the shards looks for.
PASS_WORDS = 1 << 18
#: Occurrences located at once.
LOCATE_ROWS = 1 << 18


def cuts(n: int, most: int, window: int) -> list[tuple[int, int]]:
    """Pieces of n words, of at most ``most``, that hold every window whole."""
    step = most - window + 1
    return [(a, min(n, a + most)) for a in range(0, max(1, n - window + 1), step)]


# ------------------------------------------------------------------ one shard
def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s``, whose last symbol occurs once in it."""
    n = len(s)
    bits = max(1, int(s.max()).bit_length())
    h = min(8, 62 // bits)
    key = s.astype(np.int64)
    for i in range(1, h):
        key <<= bits
        key[:max(0, n - i)] |= s[i:]
    order = np.argsort(key)
    key = key[order]
    opens = np.ones(n, bool)            # first of a run of tied suffixes
    np.not_equal(key[1:], key[:-1], out=opens[1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    tied = np.flatnonzero(~(opens & np.append(opens[1:], True)))
    while len(tied):
        at = order[tied]
        key = rank[at] * n + rank[at + h]       # tied over h symbols: no terminator among them, so at + h is inside
        again = np.argsort(key)
        key, at = key[again], at[again]
        order[tied] = at
        opens = np.ones(len(tied), bool)
        np.not_equal(key[1:], key[:-1], out=opens[1:])
        rank[at] = np.maximum.accumulate(np.where(opens, tied, 0))
        tied = tied[~(opens & np.append(opens[1:], True))]
        h *= 2
    return order


class Bits:
    """A bit vector with ranks."""

    def __init__(self, words_: np.ndarray):
        self.words = words_
        self.before = np.zeros(len(words_) + 1, np.int64)
        np.cumsum(np.bitwise_count(words_), out=self.before[1:])

    @staticmethod
    def packed(bits: np.ndarray) -> np.ndarray:
        raw = np.zeros(8 * (len(bits) // 64 + 1), np.uint8)     # one bit more than there are, so every rank has a word
        some = np.packbits(bits, bitorder="little")
        raw[:len(some)] = some
        return raw.view("<u8")

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        low = self.words[i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[i >> 6] + np.bitwise_count(low)


class FmIndex:
    """Backward search and location over one shard, read from the arrays of its row."""

    def __init__(self, counts: np.ndarray, wavelet: bytes, marks: bytes, samples: np.ndarray):
        self.n, symbols = int(counts.sum()), len(counts)
        self.levels = max(1, (symbols - 1).bit_length())
        self.below = np.cumsum(counts) - counts                  # suffixes that start with a smaller symbol
        level = np.frombuffer(wavelet, "<u8").reshape(self.levels, -1)
        self.bits = [Bits(x) for x in level]
        self.zeros = [self.n - int(b.before[-1]) for b in self.bits]
        turned = np.zeros(symbols, np.int64)
        for i in range(self.levels):
            turned |= (np.arange(symbols) >> i & 1) << self.levels - 1 - i
        self.block = np.empty(symbols, np.int64)                  # where a symbol's run starts below the last level
        by = np.argsort(turned)
        self.block[by] = np.cumsum(counts[by]) - counts[by]
        self.marks, self.samples = Bits(np.frombuffer(marks, "<u8")), samples

    @staticmethod
    def build(symbols: np.ndarray, ends: np.ndarray, size: int, sample: int) -> dict:
        """``symbols`` 1.. are words and 0 ends a document (at ``ends``); ``size`` is the number of symbols."""
        n, k = len(symbols), len(ends)
        s = symbols + (k - 1)
        s[ends] = np.arange(k)
        order = suffix_array(s)
        column = symbols[order - 1]
        levels = max(1, (size - 1).bit_length())
        wavelet, rest = [], column
        for level in range(levels - 1, -1, -1):
            one = (rest >> level & 1).astype(bool)
            wavelet.append(Bits.packed(one))
            rest = np.concatenate([rest[~one], rest[one]])
        kept = order % sample == 0
        starts = np.zeros(n, bool)
        starts[np.append(0, ends[:-1] + 1)] = True
        kept |= starts[order]
        return {"counts": np.bincount(symbols, minlength=size).astype("<i4").tobytes(), "wavelet": b"".join(w.tobytes() for w in wavelet),
                "marks": Bits.packed(kept).tobytes(), "samples": order[kept].astype("<i4").tobytes()}

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before row i of the last column."""
        for level, bits in enumerate(self.bits):
            ones = bits.rank(i)
            i = np.where(symbol >> self.levels - 1 - level & 1, self.zeros[level] + ones, i - ones)
        return i - self.block[symbol]

    def back(self, i: np.ndarray) -> np.ndarray:
        """Row of the suffix that is one word longer than that of row i."""
        symbol = np.zeros(len(i), np.int64)
        for level, bits in enumerate(self.bits):
            bit, ones = bits.get(i), bits.rank(i)
            i = np.where(bit, self.zeros[level] + ones, i - ones)
            symbol = symbol << 1 | bit
        return self.below[symbol] + i - self.block[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of rows per phrase. Phrases are rows of symbols, last word first, filled up with -1."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for words_ in phrases.T:
            on = np.flatnonzero((words_ >= 0) & (low < high))
            if not len(on):
                break
            c = words_[on]
            low[on], high[on] = self.below[c] + self.rank(c, low[on]), self.below[c] + self.rank(c, high[on])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        out, open_ = np.empty(len(row), np.int64), np.arange(len(row))
        steps, row = 0, row.copy()
        while len(open_):
            there = self.marks.get(row) == 1
            out[open_[there]] = self.samples[self.marks.rank(row[there])] + steps
            open_, row, steps = open_[~there], self.back(row[~there]), steps + 1
        return out


# ------------------------------------------------------------------ all shards
def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
                sample: int = SAMPLE) -> DataFrame:
    """One row per shard: its dictionary, FM-index and the pieces of documents in it, written once."""
    bound_batches(docs.sparkSession)
    source = docs.select(col(id_col).alias("id"), col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    fields = (f"doc array<bigint>, ids array<{kind}>, n_words array<bigint>, start array<bigint>, ends binary, "
              "dictionary array<binary>, counts binary, wavelet binary, marks binary, samples binary")

    def each(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId() << 32
        serial, held, size = 0, [], 0

        def shard():
            doc, ids, n_words, start, parts = zip(*held)
            together = pa.chunked_array(parts, pa.large_binary()).combine_chunks()
            coded = together.dictionary_encode()
            symbols = np.zeros(len(together) + len(parts), np.int64)
            ends = np.cumsum([len(p) + 1 for p in parts]) - 1
            inside = np.ones(len(symbols), bool)
            inside[ends] = False
            symbols[inside] = coded.indices.to_numpy() + 1
            index = FmIndex.build(symbols, ends, len(coded.dictionary) + 1, sample)
            row = {"doc": pa.array([list(doc)], pa.list_(pa.int64())),
                   "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids)),
                   "n_words": pa.array([list(n_words)], pa.list_(pa.int64())), "start": pa.array([list(start)], pa.list_(pa.int64())),
                   "ends": pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                   "dictionary": pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.binary()))}
            row |= {name: pa.array([raw], pa.binary()) for name, raw in index.items()}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            all_words, first = words(*text_buffer(batch.column("text")))
            id_values = batch.column("id")
            for r in range(batch.num_rows):
                n = int(first[r + 1] - first[r])
                for a, b in cuts(n, shard_words, window):
                    if held and size + b - a > shard_words:
                        yield shard()
                        held, size = [], 0
                    held.append((task + serial, id_values.slice(r, 1), n, a, all_words.slice(first[r] + a, b - a)))
                    size += b - a
                serial += 1
        if held:
            yield shard()

    return staged(source.mapInArrow(each, fields), "decontamination-index")


def phrases_of(benchmark: DataFrame, item_col: str = "item_id", text: str = "text", window: int = WINDOW,
               most: int = PASS_WORDS) -> DataFrame:
    """(item, n, words): distinct pieces of items with their words; a phrase is in one piece at least."""
    bound_batches(benchmark.sparkSession)

    def each(batches):
        for batch in batches:
            all_words, first = words(*text_buffer(batch.column("text")))
            items, sizes, parts = [], [], []
            for r, item in enumerate(batch.column("item").to_pylist()):
                n = int(first[r + 1] - first[r])
                for a, b in cuts(n, most, window) if n else ():
                    items.append(item)
                    sizes.append(b - a)
                    parts.append(all_words.slice(first[r] + a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(sizes, pa.int64()), pa.array(parts, pa.list_(pa.binary()))],
                                             ["item", "n", "words"])

    rows = benchmark.select(col(item_col).cast("string").alias("item"), col(text).alias("text"))
    return staged(rows.mapInArrow(each, "item string, n long, words array<binary>").distinct(), "decontamination-phrases")


def _windows(pieces: list[tuple], window: int):
    """Vocabulary, item names, distinct phrases (words last first, -1 after the first) and the item of each."""
    flat = pa.array([w for _, ws in pieces for w in ws], pa.large_binary()).dictionary_encode()
    codes = flat.indices.to_numpy().astype(np.int64)
    names: dict = {}
    owner, rows, at = [], [], 0
    for item, ws in pieces:
        code = codes[at:at + len(ws)]
        at += len(ws)
        short = np.full((1, window), -1, np.int64)
        short[0, :min(len(ws), window)] = code[:window][::-1]
        some = short if len(ws) < window else np.lib.stride_tricks.sliding_window_view(code, window)[:, ::-1]
        rows.append(some)
        owner.append(np.full(len(some), names.setdefault(item, len(names))))
    told = np.unique(np.column_stack([np.concatenate(rows), np.concatenate(owner)]), axis=0)
    return flat.dictionary, list(names), told[:, :-1], told[:, -1]


def _found(index: FmIndex, phrases: np.ndarray, owner: np.ndarray):
    """Positions, lengths and items of all occurrences, some at a time."""
    low, high = index.search(phrases)
    length, n = (phrases >= 0).sum(axis=1), high - low
    hit = np.flatnonzero(n)
    total = np.cumsum(n[hit])
    for a in range(0, int(total[-1]) if len(hit) else 0, LOCATE_ROWS):
        i = np.arange(a, min(a + LOCATE_ROWS, total[-1]))
        which = np.searchsorted(total, i, "right")
        row = low[hit[which]] + i - (total - n[hit])[which]
        yield index.locate(row), length[hit[which]], owner[hit[which]]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, adjoining ones joined."""
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(ends[by])
    opens = np.ones(len(starts), bool)
    opens[1:] = starts[1:] > reach[:-1]
    return starts[opens], reach[np.append(opens[1:], True)] if len(starts) else reach


def search(index: DataFrame, pieces: list[tuple], window: int = WINDOW) -> DataFrame:
    """(doc, id, n_words, spans, items) per piece of a document; spans are words [first, end) of the document."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    span = pa.struct([("first", pa.int64()), ("end", pa.int64())])

    def each(batches):
        vocabulary, names, phrases, owner = _windows(pieces, window) if pieces else (None, [], np.zeros((0, window), np.int64), None)
        for batch in batches:
            for r in range(batch.num_rows):
                shard = {f: batch.column(f)[r] for f in batch.schema.names}
                starts_in_doc = shard["start"].values.to_numpy()
                ends = np.frombuffer(shard["ends"].as_py(), "<i8")
                spans, items = [[] for _ in ends], [None for _ in ends]
                if pieces:
                    symbol = pc.index_in(vocabulary, value_set=shard["dictionary"].values.cast(pa.large_binary())).fill_null(-1).to_numpy() + 1
                    known = np.where(phrases < 0, -1, symbol[phrases])
                    here = (known != 0).all(axis=1)             # no word is missing in this shard
                    fm = FmIndex(np.frombuffer(shard["counts"].as_py(), "<i4").astype(np.int64), shard["wavelet"].as_py(),
                                 shard["marks"].as_py(), np.frombuffer(shard["samples"].as_py(), "<i4").astype(np.int64))
                    a, b, pair = [], [], []
                    for at, length, item in _found(fm, known[here], owner[here]):
                        x, y = merged(at, at + length)
                        a.append(x)
                        b.append(y)
                        pair.append(np.unique(np.searchsorted(ends, at) * len(names) + item))
                    if a:
                        x, y = merged(np.concatenate(a), np.concatenate(b))
                        piece = np.searchsorted(ends, x)
                        offset = starts_in_doc[piece] - np.append(0, ends[:-1] + 1)[piece]
                        for p, i, j in zip(piece.tolist(), (x + offset).tolist(), (y + offset).tolist()):
                            spans[p].append((i, j))
                        pairs = np.unique(np.concatenate(pair))
                        for p, i in zip((pairs // len(names)).tolist(), (pairs % len(names)).tolist()):
                            if names[i] is not None:
                                items[p] = [*(items[p] or ()), names[i]]
                yield pa.RecordBatch.from_arrays(
                    [shard["doc"].values, shard["ids"].values, shard["n_words"].values,
                     pa.array([[{"first": i, "end": j} for i, j in s] for s in spans], pa.list_(span)),
                     pa.array([x or [] for x in items], pa.list_(pa.string()))], ["doc", "id", "n_words", "spans", "items"])

    return index.mapInArrow(each, f"doc long, id {kind}, n_words long, spans array<struct<first:long,end:long>>, items array<string>")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS, pass_words: int = PASS_WORDS) -> DataFrame:
    """Per document: id, n_words, the spans [first, end) of words to remove, and the items found in it."""
    index = build_index(docs, id_col, text, window, shard_words)
    told = phrases_of(benchmark, item_col, item_text, window, pass_words)
    found = None
    for block in blocks(told, "n", pass_words):       # each block is measured to be small
        some = search(index, [(r["item"], [bytes(w) for w in r["words"]]) for r in block.toLocalIterator()], window)
        found = some if found is None else found.unionByName(some)
    per_doc = found.groupBy("doc").agg(F.first("id").alias("id"), F.max("n_words").alias("n_words"),
                                       F.flatten(F.collect_list("spans")).alias("spans"),
                                       F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    kind, span = index.schema["ids"].dataType.elementType.simpleString(), pa.struct([("first", pa.int64()), ("end", pa.int64())])

    def united(batches):
        for batch in batches:
            lists = batch.column("spans")
            out = []
            for r in range(batch.num_rows):
                x = lists[r].values
                if len(x) > 1:
                    a, b = merged(x.field("first").to_numpy(), x.field("end").to_numpy())
                    out.append([{"first": i, "end": j} for i, j in zip(a.tolist(), b.tolist())])
                else:
                    out.append(x.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(out, pa.list_(span)), batch.column("items")],
                                             ["id", "n_words", "spans", "items"])

    return per_doc.select("id", "n_words", "spans", "items").mapInArrow(
        united, f"id {kind}, n_words long, spans array<struct<first:long,end:long>>, items array<string>")


def op13_benchmark_decontamination(spark, sf_dir):
    """Per document its words, those inside a benchmark phrase, and a digest of the items found."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return out.select(F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP13_SQL = rf"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
k AS (SELECT item_id, w, least(len(w), 10) AS size FROM i WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, size, array_to_string(w[a:a + size - 1], ' ') AS phrase
      FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS a FROM k)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT rid, size, a, array_to_string(w[a:a + size - 1], ' ') AS phrase
      FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS a FROM d, (SELECT DISTINCT size FROM q) WHERE len(w) >= size)),
h AS (SELECT rid, item_id, a, g.size FROM g JOIN q ON g.phrase = q.phrase AND g.size = q.size),
c AS (SELECT rid, count(DISTINCT word) AS n_hit FROM (SELECT rid, unnest(range(a, a + size)) AS word FROM (SELECT DISTINCT rid, a, size FROM h)) GROUP BY rid),
s AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN s USING (rid)
"""

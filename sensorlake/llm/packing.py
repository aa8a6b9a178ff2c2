"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Documents are cut into pieces of at most ``capacity`` tokens. Pieces are
range-sorted by length across the cluster and ranked within their length.
Pieces of one length are interchangeable, and so are sequences with one
gap, so the bulk-synchronous rounds run on runs of ranks: each round takes
the longest length left, sweeps the sorted gaps upward from it (its
successors), gives contended gaps to the lowest ranks, updates the gaps,
and opens sequences for what is left. There are at most ``capacity``
rounds, and runs are bounded by the capacity, not by the number of
documents; the plan of runs is broadcast and every piece looks up its
place by (length, rank).

Tokens never cross a shuffle: only (id, piece, length, checksum) rows do.

The strings of special tokens ('<|endoftext|>') in a text are single ids,
as in the tokenizer's plain call.

Defined results: null or empty text is one piece holding the end token;
pieces that are equal in length are ranked by id, so ties and repeated
rows only exchange places; an empty table gives an empty result; further
columns are not looked at.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, slices, staged, table, text_buffer

CAPACITY, END_ID = 2048, 0
#: Words whose ids a worker remembers in each of two generations; words in use move on to the next one.
MEMO_WORDS = 800_000

# Letters and numbers below U+0250, as the tokenizer's own pattern classifies them.
_L = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_WORD = re.compile(rf"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^\s{_L}{_N}]+")
#: The same for lower-cased ASCII.
_ASCII_WORD = re.compile(r"[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-z0-9]+", re.ASCII)
#: Capitals up to U+024F with a lower case beyond it: words are lowered first, so these are outside as well.
_FAR = "".join(c for c in map(chr, range(0xa1, 0x250)) if max(c.lower()) > "ɏ")
#: Anything outside printable Latin text is left to the tokenizer library as a whole.
_OTHER = re.compile(rf"[^\t-\r\x20-\x7e\xa1-ɏ]|[{_FAR}]")
_PLAIN = bytes([*range(9, 14), *range(0x20, 0x7F)])


class _Memo(dict):
    """ids of words; a word of the older generation moves over, an unknown one gets an empty buffer in ``new``, filled later."""

    def __init__(self, older: dict[str, bytes]):
        super().__init__()
        self.older, self.new = older, {}

    def __missing__(self, word: str) -> bytes | bytearray:
        raw = self.older.get(word)
        if raw is None:
            return self.new.setdefault(word, bytearray())
        self[word] = raw
        return raw


class WordTokenizer:
    """ids of whole texts; remembers the ids of words, which the tokenizer encodes independently."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        # texts that hold the string of an added token go to the library whole
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values() if t.content]
        self.memo = _Memo({})
        vocabulary = self.lib.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)     # tokens that end a word
        for token, i in vocabulary.items():
            self.closes[i] = token.endswith("</w>")

    @staticmethod
    def _raw(encoding) -> bytes:
        return np.array(encoding.ids, "<u4").tobytes()

    def _learn(self, new: list[str], together: int = 64) -> None:
        """Words are encoded several to a call, parted by blanks, and told apart by the tokens that end a word."""
        if not new:
            return
        lines = [" ".join(new[i:i + together]) for i in range(0, len(new), together)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.lib.encode_batch_fast(lines, add_special_tokens=False)])
        ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
        if len(ends) == len(new):
            raw, ends = ids.tobytes(), ends.tolist()
            self.memo.update(zip(new, [raw[a:b] for a, b in zip([0, *ends], ends)]))
        else:
            for w, e in zip(new, self.lib.encode_batch_fast(new, add_special_tokens=False)):
                self.memo[w] = self._raw(e)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.older = {}
            self.memo = _Memo(self.memo)
        get, new = self.memo.__getitem__, self.memo.new
        found = []
        for t in texts:
            # plain ASCII cannot be outside, so only the rest of a text is looked at
            rest = t.encode().translate(None, _PLAIN)
            if rest and _OTHER.search(rest.decode()) or any(a in t for a in self.added):
                found.append([self._raw(self.lib.encode_batch([t], add_special_tokens=False)[0])])
            else:
                found.append(list(map(get, (_WORD if rest else _ASCII_WORD).findall(t.lower()))))
        if new:
            self._learn(list(new))
            for word, raw in new.items():
                raw += self.memo[word]
            new.clear()
        return [b"".join(f) for f in found]


_LOADED: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): ids is the piece as little-endian 32-bit integers."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def each(batches):
        if tokenizer not in _LOADED:
            _LOADED[tokenizer] = WordTokenizer(tokenizer)
        encode = _LOADED[tokenizer].encode
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for a, b in slices(offsets, 1 << 20):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                owner, number, length, crc, ids = [], [], [], [], []
                for i, raw in enumerate(encode([t or "" for t in texts])):
                    raw += end
                    for p, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at:at + 4 * capacity]
                        owner.append(a + i)
                        number.append(p)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            ids.append(part)
                number = np.array(number, np.int64)
                columns = [batch.column("id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32(), safe=False),
                           pa.array(number * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(each, f"id {kind}, piece int, start long, length long, ids_crc32 long"
                             + ", ids binary" * keep_ids)


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, last rank, first sequence, offset): rank r goes to sequence first + (r - first rank).

    ``counts`` has the number of pieces of each length: at most ``capacity`` entries.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]    # by gap: runs (first sequence, how many)
    plan, opened = [], 0

    def fill(length: int, rank: int, left: int, first: int, many: int, gap: int) -> int:
        """Puts pieces into a run of equal sequences, as many into each as fit; how many were placed."""
        fit = gap // length
        full, rest = min(many, left // fit), 0
        if full < many:
            rest = left - full * fit
        at = rank
        for run, first_of, n in ((full, first, fit), (1 if rest else 0, first + full, rest)):
            for j in range(n if run else 0):
                plan.append((length, at, at + run - 1, first_of, capacity - gap + j * length))
                at += run
            if run and gap > n * length:
                gaps[gap - n * length].append((first_of, run))
        untouched = many - full - (1 if rest else 0)
        if untouched and gap:
            gaps[gap].append((first + many - untouched, untouched))
        return at - rank

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for gap in range(length, capacity + 1):          # the successor sweep
            if not left:
                break
            runs, gaps[gap] = gaps[gap], []
            for k, (first, many) in enumerate(runs):
                if not left:
                    gaps[gap].extend(runs[k:])
                    break
                placed = fill(length, rank, left, first, many, gap)
                rank, left = rank + placed, left - placed
        if left:
            many = -(-left // (capacity // length))
            fill(length, rank, left, opened, many, capacity)
            opened += many
    return plan


def ranked(cut: DataFrame) -> DataFrame:
    """The pieces with ``rank`` within their length, from 0, by id and piece number."""
    kind = cut.schema
    names = cut.columns

    def number(batches):
        seen: dict[int, int] = {}
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for batch in batches:
            length = batch.column("length").to_numpy()
            local = np.empty(len(length), np.int64)
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                local[at] = np.arange(len(at)) + seen.get(int(v), 0)
                seen[int(v)] = int(local[at[-1]]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(length), part), pa.int32()), pa.array(local)],
                [*batch.schema.names, "part", "local"])

    from pyspark.sql.types import IntegerType, LongType, StructType
    schema = StructType([*kind.fields]).add("part", IntegerType()).add("local", LongType())
    order = [F.col("length"), F.col("id"), F.col("piece")]
    placed = staged(cut.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema), "ranked-pieces")
    # a partition holds a narrow range of lengths: about one row per partition and length
    sizes = placed.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return placed.join(offsets, ["length", "part"]).select(*names, (F.col("skip") + F.col("local")).alias("rank"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    # written before the range sort, which would otherwise tokenize a second time to sample its bounds
    cut = ranked(staged(pieces(docs, tokenizer, id_col, text, capacity, keep_ids), "pieces"))
    # at most ``capacity`` rows, whatever the input
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(best_fit_plan(counts, capacity),
                                 "run_length long, first_rank long, last_rank long, first_sequence long, offset long")
    out = cut.join(F.broadcast(plan), (F.col("length") == F.col("run_length"))
                   & F.col("rank").between(F.col("first_rank"), F.col("last_rank")))
    return out.select("id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids,
                      (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def op9_best_fit_packing(spark, sf_dir):
    """Per piece its place in a sequence of at most 2048 tokens."""
    import public_tokenizers
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumnRenamed("id", "doc_id")

"""Byte-level BPE encoding as a monoid reduced over a tree of halves, and decoding up the same tree.

An element is an encoded span of text: its ids and where its tail starts,
the first pre-token that further text could change. A pre-token is final
once it ends before the span does and the pattern's longest literal
(``REACH`` characters) tried at its start fits into the span; all others
form the tail. Two neighbours are joined by scanning a window from the
left one's tail, growing to the right until a final pre-token ends where
one of the right element ends too. The scan has no memory but its
position, so from there on the right element's tokens hold. Only the
window between is encoded again.

Short texts are one leaf. The text of a row is split inside its task;
rows are spread by Spark.

Defined results: null or empty text has no tokens; a text without any
pre-token boundary (one endless word) makes the window grow to the whole
text and is then encoded as one piece; repeated rows repeat their result;
an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, table

LEAF_CHARS, WINDOW_CHARS, LEAF_IDS = 4096, 64, 4096
#: Characters of the longest literal in the pattern ("'re").
REACH = 3


class Span:
    """Ids of text[a:b] and the start of its tail."""

    __slots__ = ("a", "b", "ids", "tail")

    def __init__(self, a: int, b: int, ids: np.ndarray, tail: int):
        self.a, self.b, self.ids, self.tail = a, b, ids, tail


def _open(start: int, end: int, stop: int) -> bool:
    """Text after ``stop`` could change this pre-token."""
    return end >= stop or start + REACH > stop


class TreeBPE:
    def __init__(self, ranks_path: str, pattern: str, leaf: int = LEAF_CHARS, window: int = WINDOW_CHARS):
        import tiktoken
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.scan = regex.compile(pattern)
        self.leaf, self.window = leaf, window

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode_ordinary(text), "<u4")

    def _span(self, text: str, a: int, b: int) -> Span:
        if b - a <= self.leaf:
            tail = next((x for x, y in self._scan(text, a, b) if _open(x, y, b)), a)
            return Span(a, b, self._encode(text[a:b]), tail)
        m = (a + b) // 2
        return self.join(text, self._span(text, a, m), self._span(text, m, b))

    def _scan(self, text: str, a: int, b: int) -> list[tuple[int, int]]:
        return [(a + x.start(), a + x.end()) for x in self.scan.finditer(text[a:b])]

    def join(self, text: str, left: Span, right: Span) -> Span:
        """The element of text[left.a:right.b]."""
        a, m, b = left.tail, left.b, right.b
        size = self.window
        while True:
            q = min(b, m + size)
            final = q == b              # the element ends here: its own end is the end of the scan
            ours, theirs = self._scan(text, a, q), self._scan(text, m, q)
            if not final:
                ours = [x for x in ours if not _open(*x, q)]
                theirs = [x for x in theirs if not _open(*x, q)]
            stable = {e for _, e in theirs}
            seam = next((e for _, e in ours if e >= m and (e in stable or e == m)), None)
            if seam is not None:
                break
            if final:
                raise AssertionError("a scan to the end always meets the right element's end")
            size *= 2
        new = [self._encode(text[s:e]) for s, e in ours if e <= seam]
        gone_left = len(self._encode(text[a:m]))
        gone_right = sum(len(self._encode(text[s:e])) for s, e in theirs if e <= seam)
        ids = np.concatenate([left.ids[:len(left.ids) - gone_left], *new, right.ids[gone_right:]])
        tail = right.tail if right.tail >= seam else next((s for s, e in ours if e <= seam and _open(s, e, b)), seam)
        return Span(left.a, b, ids, tail)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text, as little-endian unsigned 32-bit integers."""
        if len(text) <= self.leaf:
            return self._encode(text)
        return self._span(text, 0, len(text)).ids

    def decode(self, ids) -> bytes:
        """Bytes of the ids, concatenated up the tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        m = len(ids) // 2
        return self.decode(ids[:m]) + self.decode(ids[m:])


_LOADED: dict[tuple[str, str], TreeBPE] = {}


def _codec(path: str, pattern: str) -> TreeBPE:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = TreeBPE(path, pattern)
    return _LOADED[path, pattern]


def _per_batch(docs: DataFrame, columns: list, make, out: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    source = docs.select(*columns)
    kind = source.schema["id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), *make(batch)], ["id", *[c.split()[0] for c in out.split(", ")]])

    return source.mapInArrow(each, f"id {kind}, {out}")


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit integers."""
    def make(batch):
        codec = _codec(ranks, pattern)
        ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
        return [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]

    return _per_batch(docs, [F.col(id_col).alias("id"), F.col(text).alias("text")], make, "n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(id, n_tokens, ids, decoded) of encoded rows."""
    def make(batch):
        codec = _codec(ranks, pattern)
        raw = batch.column("ids").to_pylist()
        return [batch.column("n_tokens"), batch.column("ids"),
                pa.array([codec.decode(np.frombuffer(x or b"", "<u4")) for x in raw], pa.binary())]

    return _per_batch(encoded, ["id", "n_tokens", "ids"], make, "n_tokens long, ids binary, decoded binary")


def op10_byte_bpe(spark, sf_dir):
    """Per document its token count and the SHA-256 of its ids and of the decoded bytes."""
    import public_tokenizers as P
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    out = decode(encode(table(spark, sf_dir, "documents"), ranks, P.PATTERN), ranks, P.PATTERN)
    return out.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))

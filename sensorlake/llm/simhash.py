"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint has two segments of 32 bits, each with a table
(segment, value) -> fingerprints. If two fingerprints differ in at most
two bits, the upper halves differ in at most one bit, or the lower halves
are equal. So a probe enumerates the ball of radius one in the upper
segment and the value itself in the lower one, fetches the fingerprints
of these table entries, and verifies the complete distance. Of two upper
halves that differ in one bit, the one without the bit reaches the other,
so balls hold set bits only.

Distinct fingerprints of one family can crowd into one table entry, where
a fetch would form all pairs. Entries of more than ``LARGE_ENTRY``
fingerprints are therefore not fetched: everything that probes one goes
through ``neighbourhood_links``, an exact way whose entries hold at most
65 fingerprints whatever the data. Distances above two are an error.

Copies collapse before anything is enumerated (one row per fingerprint),
and components are found by large-star / small-star contraction over
fingerprint links, staged in the shared checkpoint folder.

Defined results: null or empty text, or text without words, has
fingerprint 0 and links like any other; repeated rows share a component;
a null id never names a component unless no other id is in it; an empty
table gives an empty result; further input columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, col, staged, table, text_key

SEED = 42
BITS = 64
#: Contract of this operator: words in a shingle, differing bits of a link.
SHINGLE_WORDS, MAX_BITS = 3, 2
#: Table entries of more distinct fingerprints are worked off by whole fingerprints.
LARGE_ENTRY = 256
SEGMENT_BITS = 32


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text: a bit is one if it is set in over half the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: only A-Z change
    if not words:
        return 0
    line = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    counts = np.zeros(BITS, np.int64)
    for a in range(0, n, 1 << 16):
        b = min(n, a + (1 << 16))
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[a:b].tolist(), ends[a + k - 1:b + k - 1].tolist())],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for c in range(0, len(bits), 255):           # sums of up to 255 fit a byte
            counts += bits[c:c + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, key, fp) per row: key is the hash of the text, fp its fingerprint as a signed long."""
    bound_batches(docs.sparkSession)
    source = docs.select(col(id_col).alias("id"), text_key(text).alias("key"), col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            fps = np.array([fingerprint_of(t, shingle_words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(fps.view(np.int64))], ["id", "key", "fp"])

    return source.mapInArrow(each, f"id {kind}, key long, fp long")


def _flips(fp):
    """The 64 fingerprints that differ in one bit."""
    masks = [1 << b if b < BITS - 1 else -1 << b for b in range(BITS)]
    return [fp.bitwiseXOR(F.lit(m).cast("long")) for m in masks]


def _segments(fp):
    """Table keys of a fingerprint: its upper half, and its lower half with a mark above the 32 bits."""
    upper = F.shiftrightunsigned(fp, SEGMENT_BITS)
    lower = fp.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1).cast("long"))
    return upper, lower.bitwiseOR(F.lit(1 << SEGMENT_BITS).cast("long"))


def _ball(value):
    """Values with one more bit set than a segment's value (null where the bit is set already)."""
    bits = [F.lit(1 << b).cast("long") for b in range(SEGMENT_BITS)]
    return [F.when(value.bitwiseAND(b) == 0, value.bitwiseOR(b)) for b in bits]


def _verified(near: DataFrame, max_bits: int) -> DataFrame:
    return near.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def neighbourhood_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links whose closure joins all pairs within one or two bits, by whole fingerprints.

    An entry is a fingerprint or one with one bit flipped. Two fingerprints
    share an entry exactly if they differ in at most two bits; the at most
    65 fingerprints of an entry are chained one to the next. For one bit,
    the neighbours fetch fingerprints.
    """
    fp = F.col("fp")
    if max_bits == 1:
        probe = prints.select(fp.alias("a"), F.explode(F.array(*_flips(fp))).alias("key"))
        near = probe.join(prints.select(fp.alias("b")), F.col("key") == F.col("b"))
    else:
        from pyspark.sql import Window
        entries = prints.select(fp, F.explode(F.array(fp, *_flips(fp))).alias("key"))
        by_key = Window.partitionBy("key").orderBy("fp")
        near = entries.select(F.lag("fp").over(by_key).alias("a"), fp.alias("b")).where(F.col("a").isNotNull())
    return _verified(near, max_bits)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints whose closure joins all pairs within ``max_bits``.

    ``prints`` has one row per fingerprint in column fp.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits is 0, 1 or 2")
    spark = prints.sparkSession
    if max_bits == 0:
        return spark.createDataFrame([], "a long, b long")
    fp = F.col("fp")
    upper, lower = _segments(fp)
    # one differing bit leaves one half as it is, so a distance of one needs no ball
    probed = [upper, lower, *(_ball(upper) if max_bits == 2 else [])]
    tables = prints.select(fp.alias("b"), F.explode(F.array(upper, lower)).alias("key"))
    probes = prints.select(fp.alias("a"), F.explode(F.array(*probed)).alias("key")).where(F.col("key").isNotNull())
    large = staged(tables.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > LARGE_ENTRY).select("key"), "large-entries")
    if large.isEmpty():
        return _verified(probes.join(tables, "key"), max_bits).distinct()
    fetched = _verified(probes.join(tables.join(large, "key", "left_anti"), "key"), max_bits)
    # a pair that meets in a large entry: both sides probe it
    crowded = staged(probes.join(large, "key", "left_semi").select(F.col("a").alias("fp")).distinct(), "crowded")
    return fetched.union(neighbourhood_links(crowded, max_bits)).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node of its component.

    Alternating large-star and small-star steps: each keeps the
    components and shortens the paths to the smallest node, ending when no
    link changes (logarithmically many rounds). Stars are built with a
    minimum per node and a join, so no neighbourhood is gathered in a task.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    before = None
    for _ in range(rounds):
        near = both(edges)
        low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (near.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        down = large                                               # a > b
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = staged(small, "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, key, fp, component, root): component is the smallest id reachable through links, the row's own included.

    ``root`` is a fingerprint of the component and names it even if no id does.
    """
    marked = staged(fingerprints(docs, id_col, text, shingle_words), "fingerprints")
    prints = staged(marked.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-fingerprints")
    found = components(links(prints, max_bits))
    member = prints.join(found, prints.fp == found.node).select("fp", "root", "first_id")
    named = member.groupBy("root").agg(F.min("first_id").alias("component"))
    linked = member.join(named, "root").select(F.col("fp").alias("linked_fp"), "component", "root")
    owner = staged(prints.join(linked, prints.fp == linked.linked_fp, "left")
                   .select(F.col("fp").alias("own_fp"), F.coalesce("component", "first_id").alias("component"),
                           F.coalesce("root", "fp").alias("root")), "fingerprint-components")
    # a fingerprint shared by a third of all rows is one row of owner; Spark splits such a join's large side
    return marked.join(owner, marked.fp == owner.own_fp).select("id", "key", "fp", "component", "root")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay when each near-duplicate component keeps its smallest id (nulls last)."""
    rows = near_duplicates(docs, id_col, text, **how).groupBy("root", "id", "key").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key", "n"))
    stay = staged(rows.groupBy("root").agg(first.alias("r")).select(
        F.col("r.id").alias("__id"), F.col("r.key").alias("__key"), F.col("r.n").alias("__n")), "survivors")

    def chosen(of: DataFrame) -> DataFrame:
        same = docs[f"`{id_col}`"].eqNullSafe(of["__id"]) & (text_key(text) == of["__key"])
        return docs.join(of, same, "left_semi")

    out = chosen(stay.where("__n = 1"))
    repeated = stay.where("__n > 1")
    if repeated.isEmpty():
        return out
    # the same row several times: one is taken
    return out.union(chosen(repeated).withColumn("__key", text_key(text)).dropDuplicates([id_col, "__key"]).drop("__key"))


def op6_simhash_near_dedup(spark, sf_dir):
    """Per document its fingerprint and the smallest doc_id of its near-duplicate component."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))

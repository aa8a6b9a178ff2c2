"""Ranked lexical search by pipelined term partitioning.

Documents are counted once into blocks of at most ``BLOCK_DOCS``, each with
one row per term: the documents of the block that hold it and how often.
Terms are dealt to owners, the rarest terms to the first one, so that every
owner holds about as many postings. Items travel in bundles: per block a
bundle starts empty and visits the owners one after another; at each stage
it is cogrouped with the owner's postings of that block, adds their integer
contributions to its sparse accumulators (item, document, score) and moves
on. After the last owner each block names its best documents per item, and
the best of those are ranked over all blocks.

A bundle carries only what can still matter: an accumulator is left behind,
or not opened, when even the largest contributions of the owners to come
cannot lift it to the block's k-th score, which never falls. That drops no
result, ties included.

Postings are dealt by (block, bundle), so a term that stands in every
document is spread over all blocks. What is sent to all tasks is bounded:
items are worked off in passes of measured size.

Defined results: null or empty text has no terms, is in neither N nor any
ranking; a document counts as often as its row is repeated; equal scores
are ranked by id, null ids last; rows of one item id with equal texts are
one item, with different texts each has a ranking of its own; items
without terms, or without a document, have no rows; empty tables give an
empty result; further columns are not looked at. Scores are 64-bit
integers; products that do not fit raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, col, staged, table, text_buffer
from sensorlake.llm._words import blocks, words

TOP, OWNERS, BLOCK_DOCS, BUNDLE_ITEMS = 50, 4, 2000, 256
#: Terms of items worked off in one pass, and distinct terms up to which documents are indexed by the items' terms only.
PASS_TERMS, VOCABULARY = 1 << 18, 1 << 18


def _item_terms(items: DataFrame, item_col: str, text: str) -> DataFrame:
    """(item, digest, terms, n): one row per item with its distinct terms."""
    bound_batches(items.sparkSession)
    source = items.select(col(item_col).alias("item"), F.coalesce(col(text), F.lit("")).alias("text")).distinct()
    kind = source.schema["item"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            found, first = words(*text_buffer(batch.column("text")))
            terms = [found.slice(a, b - a).unique().to_pylist() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(terms, pa.list_(pa.binary())), pa.array(map(len, terms), pa.int64())],
                                             ["item", "terms", "n"])

    # number names an item from here on: stored, so it does not change
    out = source.mapInArrow(each, f"item {kind}, terms array<binary>, n long").where("n > 0")
    return staged(out.withColumn("number", F.monotonically_increasing_id()), "search-items")


def index_terms(docs: DataFrame, id_col: str = "doc_id", text: str = "text", only: list[bytes] | None = None) -> DataFrame:
    """Postings (block, term, docs, tfs, df, most) and, with a null term, each block's ids and lengths; written once.

    ``docs`` are places in the block and ``tfs`` occurrences, as little-endian integers. ``only`` limits the terms.
    """
    bound_batches(docs.sparkSession)
    source = docs.select(col(id_col).alias("id"), col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def each(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        wanted = None if only is None else pa.array(only, pa.large_binary())
        for whole in batches:
            for a in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(a, BLOCK_DOCS)
                found, first = words(*text_buffer(batch.column("text")))
                n = np.diff(first)
                coded = found.dictionary_encode()
                code, doc = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(n)), n)
                if wanted is not None:
                    use = pc.is_in(coded.dictionary, value_set=wanted).to_numpy(zero_copy_only=False)[code]
                    code, doc = code[use], doc[use]
                pair, tf = np.unique(code * len(n) + doc, return_counts=True)
                code, doc = pair // len(n), pair % len(n)
                at = np.append(np.flatnonzero(np.append(True, code[1:] != code[:-1])), len(code)) if len(code) else np.zeros(1, np.int64)
                places, times = doc.astype("<u2").tobytes(), tf.astype("<u4").tobytes()
                edge = at.tolist()
                rows = len(edge) - 1
                pad = lambda values, more, t: pa.array([*values, more], t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * (rows + 1), pa.int64()),
                     pad(coded.dictionary.take(pa.array(code[at[:-1]])).to_pylist() if rows else [], None, pa.binary()),
                     pad([places[2 * i:2 * j] for i, j in zip(edge, edge[1:])], None, pa.binary()),
                     pad([times[4 * i:4 * j] for i, j in zip(edge, edge[1:])], None, pa.binary()),
                     pad(np.diff(at).tolist(), None, pa.int64()),
                     pad(np.maximum.reduceat(tf, at[:-1]).tolist() if rows else [], None, pa.int64()),
                     pa.concat_arrays([pa.nulls(rows, pa.list_(whole.column("id").type)),
                                       pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), batch.column("id"))]),
                     pad([None] * rows, n.astype("<i8").tobytes(), pa.binary())],
                    ["block", "term", "docs", "tfs", "df", "most", "ids", "lengths"])
                block += 1

    return staged(source.mapInArrow(each, f"block long, term binary, docs binary, tfs binary, df long, most long, ids array<{kind}>, "
                                          "lengths binary"), "search-index")


def length_weight(n: np.ndarray, docs: int, words_: int) -> np.ndarray:
    """m of documents with n terms."""
    if int(n.max(initial=0)) * docs * 50 < 1 << 63:
        return 50 + 50 * n * docs // max(words_, 1)
    return np.array([50 + 50 * int(x) * docs // words_ for x in n], np.int64)


def contributions(weight: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def at_most(weight: int, most: int) -> int:
    """No document gets more from a term that occurs ``most`` times at most (m is 50 at least)."""
    return weight * (1_000_000_000 * most // (1000 * most + 1000))


class Accumulators:
    """Scores of a bundle's items in one block, and what they may still gain."""

    def __init__(self, items: int, docs: int, top: int):
        self.score, self.top = np.zeros((items, docs), np.int64), top

    def load(self, counts: bytes, places: bytes, scores: bytes) -> None:
        if not places:
            return
        item = np.repeat(np.arange(len(self.score)), np.frombuffer(counts, "<u4"))
        self.score[item, np.frombuffer(places, "<u2")] = np.frombuffer(scores, "<i8")

    def bar(self) -> np.ndarray:
        """Per item the block's k-th score; zero if there are fewer documents."""
        if self.score.shape[1] < self.top:
            return np.zeros(len(self.score), np.int64)
        return np.partition(self.score, -self.top, axis=1)[:, -self.top]

    def visit(self, postings: list[tuple], m: np.ndarray, gain: np.ndarray, left: np.ndarray) -> None:
        """Add an owner's postings; ``gain`` is what items may get here and later, ``left`` what later."""
        shut = gain < self.bar()                    # no document without an accumulator can reach the bar
        shut_items = np.flatnonzero(shut)
        had = self.score[shut_items] > 0
        for docs, tfs, weight, items in postings:
            d = np.frombuffer(docs, "<u2")
            c = contributions(weight, np.frombuffer(tfs, "<u4").astype(np.int64), m[d])
            for i in items:
                self.score[i, d] += c
        self.score[shut_items] *= had
        self.score *= self.score + left[:, None] >= self.bar()[:, None]

    def stored(self) -> tuple[bytes, bytes, bytes]:
        item, doc = np.nonzero(self.score)
        return (np.bincount(item, minlength=len(self.score)).astype("<u4").tobytes(), doc.astype("<u2").tobytes(),
                self.score[item, doc].astype("<i8").tobytes())


def _pass(postings: DataFrame, block_rows: DataFrame, weights: list, sizes: dict[int, int], total: tuple[int, int], top: int, owners: int,
          kind: str) -> DataFrame:
    """Best documents per block and item of one pass: (bundle, slot, id, score).

    ``weights``: (term, weight, postings, most, [(bundle, [slots])]), rarest first; ``sizes``: items of each bundle.
    """
    spark = postings.sparkSession
    mass, all_ = np.cumsum([w[2] for w in weights]), sum(w[2] for w in weights)
    # the posting in the middle decides: owners get equal shares of all postings
    owner = [min(owners - 1, int(owners * (m - w[2] / 2) / max(all_, 1))) for m, w in zip(mass.tolist(), weights)]
    gains = {b: np.zeros((owners + 1, n), np.int64) for b, n in sizes.items()}
    for o, (_, weight, _, most, where) in zip(owner, weights):
        for b, slots in where:
            gains[b][:o + 1, slots] += at_most(weight, most)
    owned = spark.createDataFrame([(t, o, w, [(b, slots) for b, slots in where]) for o, (t, w, _, _, where) in zip(owner, weights)],
                                  "term binary, owner int, weight long, places array<struct<bundle:int,slots:array<int>>>")
    # every bundle visits every block, with nothing yet
    state = block_rows.select(F.col("block").alias("block"), "ids", "lengths", F.explode(F.array(*[F.lit(b) for b in sizes])).alias("bundle"))
    none = F.lit(b"").cast("binary")
    state = state.select("block", "bundle", "ids", "lengths", none.alias("counts"), none.alias("places"), none.alias("scores"))
    schema = f"block long, bundle int, ids array<{kind}>, lengths binary, counts binary, places binary, scores binary"

    def stage(o: int):
        last = o == owners - 1

        def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return left
            row = {c: left.column(c)[0] for c in left.column_names}
            n = np.frombuffer(row["lengths"].as_py(), "<i8")
            bundle = row["bundle"].as_py()
            acc = Accumulators(sizes[bundle], len(n), top)
            acc.load(row["counts"].as_py(), row["places"].as_py(), row["scores"].as_py())
            given = [(d.as_py(), t.as_py(), w.as_py(), s.as_py()) for d, t, w, s in zip(*(right.column(c) for c in ("docs", "tfs", "weight", "slots")))]
            acc.visit(given, length_weight(n, *total), gains[bundle][o], gains[bundle][o + 1])
            if not last:
                counts, places, scores = acc.stored()
                out = {"counts": counts, "places": places, "scores": scores}
                return pa.table({c: pa.array([out[c]], pa.binary()) if c in out else left.column(c).slice(0, 1) for c in left.column_names})
            ids = row["ids"].values
            bar = acc.bar()
            parts = []
            for i, scores in enumerate(acc.score):
                d = np.flatnonzero((scores > 0) & (scores >= bar[i]))
                best = pa.table({"bundle": pa.array([bundle] * len(d), pa.int32()), "slot": pa.array([i] * len(d), pa.int32()),
                                 "id": ids.take(pa.array(d)), "score": pa.array(scores[d], pa.int64())})
                by = pc.sort_indices(best, sort_keys=[("score", "descending"), ("id", "ascending")])
                parts.append(best.take(by[:top]))
            return pa.concat_tables(parts)

        return run, f"bundle int, slot int, id {kind}, score long" if last else schema

    for o in range(owners):
        here = (postings.join(F.broadcast(owned.where(F.col("owner") == o)), "term")
                .select("block", "docs", "tfs", "weight", F.explode("places").alias("p"))
                .select("block", F.col("p.bundle").alias("bundle"), "docs", "tfs", "weight", F.col("p.slots").alias("slots")))
        run, out = stage(o)
        state = state.groupBy("block", "bundle").cogroup(here.groupBy("block", "bundle")).applyInArrow(run, out)
    return state


def ranked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
           item_text: str = "text", top: int = TOP, owners: int = OWNERS, bundle_items: int = BUNDLE_ITEMS, pass_terms: int = PASS_TERMS,
           vocabulary: int = VOCABULARY) -> DataFrame:
    """(item, rank, id, score): each item's ``top`` highest-scoring documents."""
    spark = docs.sparkSession
    asked = _item_terms(items, item_col, item_text)
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    some = terms.limit(vocabulary + 1).collect()        # bounded; with more terms documents are indexed by all of theirs
    index = index_terms(docs, id_col, text, [bytes(r["term"]) for r in some] if len(some) <= vocabulary else None)
    kind = index.schema["ids"].dataType.elementType.simpleString()
    postings = index.where("term IS NOT NULL").select("block", "term", "docs", "tfs", "df", "most")
    block_rows = index.where("term IS NULL").select("block", "ids", "lengths")
    total = _totals(block_rows)
    stats = postings.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))
    stats = staged(stats.withColumn("weight", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total[0] + 2) / (2.0 * F.col("df") + 1)))), "search-terms")
    out = None
    for block in blocks(asked, "n", pass_terms):
        numbers = [r["number"] for r in block.select("number").orderBy("number").toLocalIterator()]
        slot = {n: (i // bundle_items, i % bundle_items) for i, n in enumerate(numbers)}
        sizes = {b: min(bundle_items, len(numbers) - b * bundle_items) for b in range((len(numbers) + bundle_items - 1) // bundle_items)}
        # terms of this pass only: as many as the pass may have
        rows = (block.select("number", F.explode("terms").alias("term")).groupBy("term").agg(F.collect_list("number").alias("numbers"))
                .join(stats, "term").orderBy("df", "term"))
        weights = []
        for r in rows.toLocalIterator():
            where: dict[int, list[int]] = {}
            for b, s in sorted(slot[n] for n in r["numbers"]):
                where.setdefault(b, []).append(s)
            if r["weight"] > 0:
                weights.append((bytes(r["term"]), r["weight"], r["df"], r["most"], list(where.items())))
        if not weights:
            continue
        best = _pass(postings, block_rows, weights, sizes, total, top, owners, kind)
        names = spark.createDataFrame([(*slot[n], n) for n in numbers], "bundle int, slot int, number long")
        found = best.join(F.broadcast(names), ["bundle", "slot"]).select("number", "id", "score")
        out = found if out is None else out.unionByName(found)
    item_kind = asked.schema["item"].dataType.simpleString()
    if out is None:
        return spark.createDataFrame([], f"item {item_kind}, rank int, id {kind}, score long")
    first = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    out = out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return out.join(asked.select("number", "item"), "number").select("item", "rank", "id", "score")


def _totals(block_rows: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms of documents."""

    def each(batches):
        for batch in batches:
            n = [np.frombuffer(x, "<i8") for x in batch.column("lengths").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in n], pa.int64()), pa.array([int(x.sum()) for x in n], pa.int64())],
                                             ["docs", "words"])

    r = block_rows.select("lengths").mapInArrow(each, "docs long, words long").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    return r["docs"] or 0, r["words"] or 0


def op11_ranked_search(spark, sf_dir):
    """Per benchmark item its 50 highest-scoring documents."""
    out = ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP11_SQL = rf"""
WITH i AS (SELECT row_number() OVER () AS number, item_id, list_distinct(w) AS terms
           FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text, {_WORDS} AS w FROM benchmark)),
it AS (SELECT number, item_id, unnest(terms) AS term FROM i),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_words FROM d WHERE len(w) > 0),
m AS (SELECT rid, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_words) AS m FROM d, g WHERE len(w) > 0),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM p, g WHERE term IN (SELECT term FROM it) GROUP BY term, n_docs),
s AS (SELECT number, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM it JOIN w USING (term) JOIN p USING (term) JOIN m USING (rid) GROUP BY number, item_id, rid, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""

"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product
(binding) of its letters' vectors, each rotated by its place; a text is
the sum (bundle) of its trigrams, a language the sum over its training
texts. A text takes the language whose prototype has the largest cosine.

Training counts trigrams per language in slices, sums them by Spark, and
bundles partial prototypes on the executors; the driver sees one vector
per language. Letters outside a-z share ``SYMBOLS - 27`` vectors by code
point, so the tables have one size for all scripts.

Defined results: null text or text without a letter is ``und`` with score
0, as is everything if nothing was learned; ties go to the first language
in order; rows with a null id are not learned from; repeated rows are
learned and judged one by one; an empty table gives an empty result;
further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, slices, table, text_buffer

DIMENSIONS, SYMBOLS, SEED = 1024, 128, 7
#: Trigrams bundled at a time: bounds a task's memory whatever the text holds.
BUNDLE_TRIGRAMS = 4096
UNKNOWN = "und"

_TABLES: dict[str, np.ndarray] = {}


def symbols() -> np.ndarray:
    """By code point: 0 for what is no letter, 1-26 for a-z in either case, else a shared symbol of the lower case."""
    if "symbols" not in _TABLES:
        out = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = ord(chr(c).lower()[0])
                out[c] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 11) % (SYMBOLS - 27)
        _TABLES["symbols"] = out
    return _TABLES["symbols"]


def letter_vectors(dimensions: int = DIMENSIONS) -> np.ndarray:
    name = f"letters-{dimensions}"
    if name not in _TABLES:
        draw = np.random.Generator(np.random.PCG64(SEED))
        _TABLES[name] = (draw.integers(0, 2, (SYMBOLS, dimensions), np.int8) * 2 - 1).astype(np.int8)
    return _TABLES[name]


def trigram_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bound vectors of trigram codes, one row each."""
    v = letter_vectors(dimensions)
    a, b, c = codes >> 14, codes >> 7 & 127, codes & 127
    return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of all texts in a row, and the text each belongs to.

    Anything between letters counts as one boundary symbol; trigrams are
    centred on letters, so none reaches from one text into the next.
    """
    joined = "\n" + "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    sym = symbols()[points].astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    stay = sym != 0
    stay[1:] |= sym[:-1] != 0
    stay[0] = True
    owner = owner[stay[1:]] if len(texts) else owner
    sym = sym[stay]
    middle = np.flatnonzero(sym[1:-1]) + 1
    codes = sym[middle - 1] << 14 | sym[middle] << 7 | sym[middle + 1]
    return codes, owner[middle - 1]


def bundles(codes: np.ndarray, owner: np.ndarray, n_texts: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Sum of the trigram vectors of each text, ``BUNDLE_TRIGRAMS`` different trigrams at a time."""
    out = np.zeros((n_texts, dimensions), np.float32)
    seen, column = np.unique(codes, return_inverse=True)
    cells, n = np.unique(column * n_texts + owner, return_counts=True)
    column, owner = np.divmod(cells, n_texts)
    for a in range(0, len(seen), BUNDLE_TRIGRAMS):
        part = seen[a:a + BUNDLE_TRIGRAMS]
        lo, hi = np.searchsorted(column, (a, a + len(part)))
        counts = np.zeros((n_texts, len(part)), np.float32)
        counts[owner[lo:hi], column[lo:hi] - a] = n[lo:hi]
        out += counts @ trigram_vectors(part, dimensions).astype(np.float32)
    return out


def _text_slices(batch: pa.RecordBatch, most: int):
    _, offsets = text_buffer(batch.column("text"))
    for a, b in slices(offsets, most):
        part = batch.slice(a, b - a)
        yield part, [t or "" for t in part.column("text").to_pylist()]


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, n) over all rows with a language."""
    bound_batches(docs.sparkSession)

    def each(batches):
        for batch in batches:
            for part, texts in _text_slices(batch, 4 << 20):
                codes, owner = trigrams(texts)
                names, index = np.unique(np.array(part.column("lang").to_pylist(), object), return_inverse=True)
                both, n = np.unique(index[owner].astype(np.int64) << 21 | codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[both >> 21], pa.string()), pa.array((both & 0x1FFFFF).astype(np.int32)),
                                                  pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.mapInArrow(each, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototype of every learned language: (number of languages) x ``dimensions`` numbers reach the driver."""
    def bundle(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            codes, n = batch.column("code").to_numpy(), batch.column("n").to_numpy().astype(np.float64)
            for name in np.unique(names):
                at = np.flatnonzero(names == name)
                part = n[at] @ trigram_vectors(codes[at], dimensions).astype(np.float64)
                total[name] = total.get(name, 0) + part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                                         ["lang", "v"])

    partial = trigram_counts(docs, text, lang).mapInArrow(bundle, "lang string, v array<double>")
    summed = partial.select("lang", F.posexplode("v").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():
        out.setdefault(r["lang"], np.zeros(dimensions))[r["d"]] = r["x"]
    return {k: out[k] / (np.linalg.norm(out[k]) or 1.0) for k in sorted(out)}


def classify(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns, lang_pred and score (cosine, not below 0) per row."""
    bound_batches(docs.sparkSession)
    names = list(model)
    matrix = np.array([model[k] for k in names], np.float32).T if names else None
    dimensions = matrix.shape[0] if names else DIMENSIONS
    source = docs.select(*(keep or []), F.col(text).alias("text"))
    kept = [c for c in source.columns if c != "text"]

    def each(batches):
        for batch in batches:
            for part, texts in _text_slices(batch, 1 << 20):
                codes, owner = trigrams(texts)
                best, score = np.full(len(texts), -1), np.zeros(len(texts))
                if len(codes) and names:
                    bundle = bundles(codes, owner, len(texts), dimensions)
                    norm = np.linalg.norm(bundle, axis=1)
                    cosine = (bundle @ matrix) / np.where(norm > 0, norm, 1)[:, None]
                    has = np.bincount(owner, minlength=len(texts)) > 0
                    best[has] = np.argmax(cosine[has], axis=1)
                    score[has] = np.clip(cosine[has].max(axis=1), 0, 1)
                predicted = [names[b] if b >= 0 else UNKNOWN for b in best]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(predicted, pa.string()), pa.array(score)],
                                                 [*kept, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType
    schema = StructType([source.schema[c] for c in kept]).add("lang_pred", StringType()).add("score", DoubleType())
    return source.mapInArrow(each, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """One document in five, by checksum of its id; null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def op7_language_id(spark, sf_dir):
    """Per document the language predicted from its text by prototypes of the documents not held out."""
    docs = table(spark, sf_dir, "documents")
    model = prototypes(docs.where(~held_out()))
    return classify(docs, model, keep=[F.col("doc_id"), held_out().alias("held_out")])

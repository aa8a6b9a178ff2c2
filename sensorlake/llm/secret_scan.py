"""Secret scans with corpus-wide ownership frequency.

Candidates come from patterns, once per text. Base kinds are always
secrets. Candidates of the looser kinds (provider tokens, random-looking
strings) are only judged by how the whole corpus holds their value: a
value found in many repositories or with many owners is a widely copied
example and left alone; one that stays with few owners looks live and is
added. Values travel as hashes; counts are distinct repositories and
distinct owners per hash, combined before the shuffle.

Offsets are code points, ends exclusive; a span is the whole match.

Defined results: null or empty text has no spans; rows are judged one by
one, so repeated rows repeat their result; rows with one text, whatever
their ids, count as one owner unless a column names owners; rows with a
null repository or owner count under no repository or owner; an empty
table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, col, slices, staged, table, text_buffer, text_key

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("token", "random")
KINDS = BASE_KINDS + ADDED_KINDS
#: A value in more repositories, or with more owners, is a copied example.
MAX_REPOS, MAX_OWNERS = 2, 4

# The base patterns.
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
# Added kinds.
_TOKEN = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[rs]k_live_[A-Za-z0-9]{16,}"
                    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}")
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_MARKS = ("gh", "xox", "k_live_", "eyJ")


# How words, names and paths go on: kind of character after kind of character, and letters of English text in percent.
_NEXT = {"lower": {"lower": 0.78, "upper": 0.12, "digit": 0.02, "sign": 0.08}, "upper": {"lower": 0.58, "upper": 0.36, "digit": 0.02, "sign": 0.04},
         "digit": {"lower": 0.1, "upper": 0.1, "digit": 0.55, "sign": 0.25}, "sign": {"lower": 0.55, "upper": 0.3, "digit": 0.13, "sign": 0.02}}
_LETTERS = dict(zip("etaoinsrhldcumfpgwybvkxjqz", (12.0, 9.1, 8.1, 7.7, 7.3, 6.9, 6.3, 6.0, 5.9, 4.3, 4.0, 2.7, 2.9, 2.6, 2.3, 1.8, 2.0, 2.1, 2.1,
                                                   1.5, 1.1, 0.9, 0.4, 0.3, 0.3, 0.2)))
_CHARS = ({c: ("lower", p / 100) for c, p in _LETTERS.items()} | {c.upper(): ("upper", p / 100) for c, p in _LETTERS.items()}
          | {c: ("digit", 1 / 10) for c in "0123456789"} | {c: ("sign", 1 / 4) for c in "+/_-"})
#: Bits by which a character after another one speaks for random characters and against words.
_BITS = {a + b: -math.log2(64 * _NEXT[_CHARS[a][0]][_CHARS[b][0]] * _CHARS[b][1]) for a in _CHARS for b in _CHARS}


def _looks_random(value: str) -> bool:
    """Upper and lower case, an entropy near that of random characters of its length (four bits suffice), and four digits
    or characters that follow each other as random ones do rather than as in words."""
    if value.lower() == value or value.upper() == value:
        return False
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    if entropy < min(4.0, 0.77 * math.log2(n)):
        return False
    return entropy >= 4.0 and sum(c.isdigit() for c in value) >= 4 or sum(map(_BITS.__getitem__, map("".join, zip("-" + value, value)))) >= 0


def _apart(more: list[tuple], found: list[tuple]) -> list[tuple]:
    """Those of ``more`` that overlap nothing in ``found``."""
    if not more or not found:
        return more
    begins, ends = zip(*sorted((f[1], f[2]) for f in found))
    reach = list(accumulate(ends, max))         # furthest end of the spans up to each one
    before = [bisect_left(begins, c[2]) for c in more]
    return [c for c, i in zip(more, before) if not i or reach[i - 1] <= c[1]]


def _masked(text: str, starts, ends, mark: str) -> str:
    """``text`` with every range replaced by ``mark``; a range that starts inside an earlier one joins it."""
    out, at = [], 0
    for a, b in sorted(zip(starts, ends)):
        if a >= at:
            out += (text[at:a], mark)
        at = max(at, b)
    return "".join((*out, text[at:]))


def candidates(text: str) -> list[tuple[int, int, int, int, str]]:
    """(kind, start, end, value start, value) of every candidate; added kinds never overlap base ones."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(0, m.start(), m.end(), m.start(2), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m.start(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, m.start(), m.end(), m.start(), m[0]) for m in _HEX.finditer(text)]
    if any(k in text for k in _MARKS):
        found += _apart([(3, m.start(), m.end(), m.start(), m[0]) for m in _TOKEN.finditer(text)], found)
    found += _apart([(4, m.start(), m.end(), m.start(), m[0]) for m in _RANDOM.finditer(text) if _looks_random(m[0])], found)
    return sorted(found, key=lambda c: (c[1], c[0]))


_SPANS = "array<struct<kind:int,start:long,end:long,vstart:long,vhash:long>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", repo_col: str = "source",
         owner_col: str | None = None) -> DataFrame:
    """One row per text: id, key (hash of the text), repo, owner and its candidate spans.

    Without an owner column the text is the owner, so copies of one document are one.
    """
    bound_batches(docs.sparkSession)
    source = docs.select(col(id_col).alias("id"), text_key(text).alias("key"),
                         col(repo_col).cast("string").alias("repo"),
                         (text_key(text) if owner_col is None else col(owner_col)).cast("string").alias("owner"),
                         col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("vstart", pa.int64()),
                                ("vhash", pa.int64())]))

    def digest(value: str) -> int:
        return int.from_bytes(hashlib.sha256(value.encode()).digest()[:8], "little", signed=True)

    def each(batches):
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for a, b in slices(offsets):
                part = batch.slice(a, b - a)
                rows = [[{"kind": k, "start": s, "end": e, "vstart": v, "vhash": digest(x)}
                         for k, s, e, v, x in candidates(t or "")] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("id", "key", "repo", "owner")]
                                                 + [pa.array(rows, spans)], ["id", "key", "repo", "owner", "spans"])

    return source.mapInArrow(each, f"id {kind}, key long, repo string, owner string, spans {_SPANS}")


def ownership(found: DataFrame) -> DataFrame:
    """(vhash, n_repos, n_owners) of every candidate value over the corpus."""
    return (found.select("repo", "owner", F.explode(F.array_distinct("spans.vhash")).alias("vhash"))
            .groupBy("vhash").agg(F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners")))


def secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", repo_col: str = "source",
            owner_col: str | None = None, max_repos: int = MAX_REPOS, max_owners: int = MAX_OWNERS) -> DataFrame:
    """Per text: id, key, ``spans`` (kept ones, by start and kind) and ``n_live``, spans whose value stays with few owners."""
    found = staged(scan(docs, id_col, text, repo_col, owner_col), "secret-candidates")
    live = ownership(found).where((F.col("n_repos") <= max_repos) & (F.col("n_owners") <= max_owners)).select("vhash")
    each = (found.where(F.size("spans") > 0).select("id", "key", F.explode(F.array_distinct("spans.vhash")).alias("vhash"))
            .distinct().join(live, "vhash", "left_semi")
            .groupBy("id", "key").agg(F.collect_list("vhash").alias("live")))     # values of one text
    each = each.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "live")
    joined = found.join(each, found.id.eqNullSafe(each["__id"]) & (found.key == each["__key"]), "left")
    own = F.coalesce("live", F.array().cast("array<bigint>"))
    return joined.select("id", "key", F.filter("spans", lambda s: (s["kind"] < len(BASE_KINDS))
                                               | F.array_contains(own, s["vhash"])).alias("spans"),
                         F.size(F.filter("spans", lambda s: F.array_contains(own, s["vhash"]))).cast("long").alias("n_live"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text: str = "text", repo_col: str = "source",
             owner_col: str | None = None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with its columns; the values of all secrets are replaced by ``mark``."""
    bound_batches(docs.sparkSession)
    spans = secrets(docs, id_col, text, repo_col, owner_col).where(F.size("spans") > 0).dropDuplicates(["id", "key"])
    spans = spans.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    joined = docs.join(spans, docs[f"`{id_col}`"].eqNullSafe(spans["__id"]) & (text_key(text) == spans["__key"]), "left")
    body = col(text)

    @F.pandas_udf("string")
    def masked(t: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else _masked(x, a, b, mark) for x, a, b in zip(t, starts, ends)], dtype=object)

    # texts without secrets stay in the JVM: null is sent in their place
    cut = masked(F.when(F.col("__spans").isNotNull(), body), F.col("__spans.vstart"), F.col("__spans.end"))
    clean = F.when(F.col("__spans").isNull(), body).otherwise(cut)
    return joined.select(*[clean.alias(c) if c == text else col(c) for c in docs.columns])


def _joined(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def op4_secret_scan(spark, sf_dir):
    """Per document its secrets by kind, a digest of the base spans, all spans, and how many look live."""
    out = secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))

    def n(k):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    return out.select(F.col("id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                      F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
                      "n_live")

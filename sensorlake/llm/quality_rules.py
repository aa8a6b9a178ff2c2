"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the
measurements and one long whose bit *i* says that rule *i* failed.
Policies are versioned masks over that long, so a new policy or an
ablation needs no second look at the texts: verdicts are ``bits & mask``,
ablations come from the histogram of ``bits`` (at most 2^rules rows).

DataFrame functions only. Defined results: null or empty text has no
words and fails ``few_words``; rows are judged one by one, so repeated
rows repeat their result; an empty table gives an empty ledger; further
columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import col, staged, table, words_of


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str          # SQL condition over the measurements


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


#: Order gives the bit; append only, so stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
    Rule("exclamations", "5 * n_exclaims > n_words"),
)

POLICIES = {p.version: p for p in (
    Policy("base-1", ("few_words", "repeated_words")),
    Policy("full-1", tuple(r.name for r in RULES)),
)}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims")


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bit = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bit[name] for name in set(policy.rules))


def _repeated_positions(grams: Column) -> Column:
    """Words covered by windows of three whose hash stands at two or more places."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    # transform over a one-element array binds its element once
    again = F.transform(F.array(placed), lambda s: F.filter(s, lambda e, k: (
        (k > 0) & (F.get(s, k - 1)["g"] == e["g"])) | (
        (k < F.size(s) - 1) & (F.get(s, k + 1)["g"] == e["g"]))))[0]
    at = F.sort_array(F.transform(again, lambda e: e["i"]))
    covered = F.transform(F.array(at), lambda p: F.aggregate(
        F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
                   lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0), lambda total, x: total + x))[0]
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(covered)


def measured(docs: DataFrame, text: str = "text", keep: str = "doc") -> DataFrame:
    """The input row as a struct named ``keep``, with the measurements beside it."""
    body = F.coalesce(col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counted = "[#*$%&|<>]"
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias(keep), words_of(col(text)).alias("words"),
                       lines.alias("lines"), F.regexp_count(body, F.lit(counted)).alias("n_symbols"),
                       (F.octet_length(body) - F.octet_length(F.replace(body, F.lit("!"), F.lit("")))).alias("n_exclaims"))
    n = F.size("words")
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(keep, n.alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"), "n_symbols",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                       F.size("lines").alias("n_lines"), "n_exclaims", grams.alias("grams"))
    found = F.struct(*[(_repeated_positions(F.col("grams")) if c == "n_repeat_words" else F.col(c)).cast("long").alias(c)
                       for c in MEASURES])
    # a generator of one row: a filter on measurements is not pushed below it, where it would evaluate them again
    return rows.select(keep, F.inline(F.array(found)))


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep: str = "doc") -> DataFrame:
    """``keep`` (the input row), the measurements and ``failed_bits``: every rule evaluated once."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, text, keep).withColumn("failed_bits", bits)


def kept_by(policy: Policy, rules: tuple[Rule, ...] = RULES, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def accepted(docs: DataFrame, policy: Policy, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass the policy, with their own columns."""
    return ledger(docs, text, rules).where(kept_by(policy, rules)).select("doc.*")


def ablation(book: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents failing it, rejected by it alone, and left rejected without it.

    One bitwise aggregation over the ledger; what follows reads its at most
    2^rules groups.
    """
    whole = mask(policy, rules)
    groups = (book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits"))
              .agg(F.count("*").alias("n")))
    own = [(r.name, 1 << i) for i, r in enumerate(rules) if r.name in policy.rules]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit"))
                               for name, bit in own])).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return (groups.select("bits", "n", each).groupBy(F.col("r.rule").alias("rule"))
            .agg(total(hit).alias("n_failed"), total(alone).alias("n_rejected_alone"),
                 total((F.col("bits") != 0) & ~alone).alias("n_rejected_without"))
            .select(F.lit(policy.version).alias("policy"), "rule", "n_failed", "n_rejected_alone", "n_rejected_without"))


def store_ledger(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The ledger without texts, written once, for several policies and ablations."""
    return staged(ledger(docs.select(id_col, text), text).select(
        F.col(f"doc.{id_col}").alias(id_col), *MEASURES, "failed_bits"), "quality-ledger")


def op1_quality_rules(spark, sf_dir):
    """Per document its measurements, failure bits and verdict under policy ``full-1``."""
    book = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ~kept_by(POLICIES["base-1"])
    return book.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", base.alias("base_failed"), kept_by(POLICIES["full-1"]).alias("kept"),
                       "failed_bits")


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
h AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM g),
c AS (SELECT rid, count(DISTINCT i + k) AS covered FROM h, (VALUES (0), (1), (2)) AS s(k) WHERE n >= 2 GROUP BY rid),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(covered, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclaims
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
      + (CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
      + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 30 * n_words THEN 32 ELSE 0 END)
      + (CASE WHEN 5 * n_exclaims > n_words THEN 64 ELSE 0 END) AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits FROM b
"""

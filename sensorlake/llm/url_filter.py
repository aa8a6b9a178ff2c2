"""URL filters: explicit rules first, gradient-boosted trees on lexical features for the rest.

Trees are fitted on labelled URLs (here: those a rule decides) with
features of the URL's characters only: lengths, depth, digit and symbol
ratios, entropy, parameters, and for the host's last label how often it
is blocked among the labelled URLs. Fitting uses at most
``TRAINING_ROWS`` labelled rows, chosen by hash of the URL, half of them
for each class (all of a class that has fewer); suffix statistics use all
labelled rows.

Defined results: a null URL, or one without ``://``, has an empty host and
path and is judged by the trees; if the labelled URLs have one class only,
every other URL takes it (``allow`` if there are none); rows are judged one by one; an
empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm._util import staged, table

TRAINING_ROWS = 20_000

# Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

FEATURES = ("length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_ratio", "symbol_ratio", "hyphens",
            "entropy", "n_params", "has_fragment", "suffix_blocked", "suffix_seen")


def parts(pages: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(id, u, host, path): u is the URL, null as empty."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("u"))
    rest = F.expr("CASE WHEN locate('://', u) > 0 THEN substring(u, locate('://', u) + 3) ELSE '' END")
    lower = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rows.select("id", "u", lower.alias("host"), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))


def by_rules(found: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (the longest that fits, else null) and ``ruled`` (its verdict)."""
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):        # the longest is tested first
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        ruled = F.when(fits, F.lit(verdict)).otherwise(ruled)
    return found.withColumn("rule", rule).withColumn("ruled", ruled)


def features(found: DataFrame, suffixes: DataFrame, prior: float) -> DataFrame:
    """Lexical features of every URL; ``suffixes`` has suffix, blocked share and count among labelled URLs."""
    u = F.col("u")
    size = F.greatest(F.length(u), F.lit(1))
    chars = F.array_distinct(F.split(u, ""))
    share = lambda c: F.greatest(F.length(u) - F.length(F.replace(u, c, F.lit(""))), F.lit(0)) / size
    entropy = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0),
                          lambda acc, c: acc - share(c) * F.log2(F.greatest(share(c), F.lit(1e-9))))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(u, r"(?s)^[^?#]*\?([^#]*)", 1)
    found = found.withColumn("suffix", F.element_at(labels, -1))
    joined = found.join(suffixes, "suffix", "left")
    return joined.select(
        "id", "u", "host", "path", "rule", "ruled",
        F.length(u).cast("double").alias("length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.size(F.filter(F.split("path", "/"), lambda s: s != "")).cast("double").alias("depth"), F.size(labels).cast("double").alias("labels"),
        F.array_max(F.transform(labels, F.length)).cast("double").alias("longest_label"),
        (F.regexp_count(u, F.lit("[0-9]")) / size).alias("digit_ratio"), (F.regexp_count(u, F.lit("[^A-Za-z0-9]")) / size).alias("symbol_ratio"),
        F.regexp_count("host", F.lit("-")).cast("double").alias("hyphens"), entropy.alias("entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")).alias("n_params"),
        F.contains(u, F.lit("#")).cast("double").alias("has_fragment"),
        F.coalesce("blocked", F.lit(prior)).alias("suffix_blocked"), F.log1p(F.coalesce("seen", F.lit(0))).alias("suffix_seen"))


def filtered(pages: DataFrame, id_col: str = "page_id", url: str = "url", rules=RULES, training_rows: int = TRAINING_ROWS,
             rounds: int = 20, depth: int = 4) -> DataFrame:
    """(id, host, path, rule, verdict, blocked_by_trees): the rule's verdict, else that of the trees."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    found = staged(by_rules(parts(pages, id_col, url), rules), "urls")
    blocked = (F.col("ruled") == "block").cast("double")
    labelled = found.where("ruled IS NOT NULL")
    place = F.pmod(F.xxhash64("u", "id"), F.lit(1 << 30))
    totals = labelled.agg(F.count("*").alias("n"), F.coalesce(F.avg(blocked), F.lit(0.0)).alias("share"),
                          F.coalesce(F.sum(blocked), F.lit(0.0)).cast("long").alias("n_blocked"),
                          F.min(F.when(blocked == 0, place)).alias("low_0"), F.min(F.when(blocked == 1, place)).alias("low_1")).first()
    named = lambda col: F.when(col > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    verdict = lambda col: F.coalesce("ruled", named(col)).alias("verdict")
    if totals["share"] in (0.0, 1.0):
        one = F.lit(totals["share"])
        return found.select("id", "host", "path", "rule", verdict(one), one.alias("blocked_by_trees"))
    suffixes = (labelled.withColumn("suffix", F.element_at(F.split("host", r"\."), -1)).groupBy("suffix")
                .agg(F.avg(blocked).alias("blocked"), F.count("*").alias("seen")))
    wide = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(found, suffixes, totals["share"]))
    # a bounded sample by hash: half of it for each class, or more where the other has fewer; both classes weigh the same
    n, some = {1: totals["n_blocked"], 0: totals["n"] - totals["n_blocked"]}, {}
    for label in n:
        some[label] = min(n[label], max(training_rows // 2, training_rows - n[1 - label]))
    weight = F.when(F.col("label") == 1, F.lit(0.5 * sum(some.values()) / max(some[1], 1))).otherwise(F.lit(0.5 * sum(some.values()) / max(some[0], 1)))
    # a threshold on the hash spares a global sort; the smallest hash of a class is always below its own
    below = {label: max((some[label] << 30) // n[label], totals[f"low_{label}"] + 1) for label in n}
    chosen = place < F.when(blocked == 1, F.lit(below[1])).otherwise(F.lit(below[0]))
    train = staged(wide.where(F.col("ruled").isNotNull() & chosen).withColumn("label", blocked).withColumn("weight", weight)
                   .select("features", "label", "weight"), "labelled-urls")
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, weightCol="weight", seed=7, checkpointInterval=-1).fit(train)
    judged = model.transform(wide)
    return judged.select("id", "host", "path", "rule", verdict(F.col("prediction")), F.col("prediction").alias("blocked_by_trees"))


def op8_url_filter(spark, sf_dir):
    """Per page its host and path, the rule that fits, and the verdict of the rule or else of the trees."""
    out = filtered(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")

"""License scans by diagonal voting.

All rolling word k-grams of every text are joined to the positions of the
same k-grams in license templates. A match votes for a diagonal (text
position minus template position); votes are aggregated by template and
diagonal, neighbouring diagonals (a few words inserted or missing) are
merged into spans, and a span is verified by the share of the template's
words it covers and by its own length, which insertions may not stretch
beyond ``MAX_STRETCH`` times the template's. The join compares the words themselves, so a hash only
selects what to compare. Phrases are templates that must match whole, on
one diagonal.

Templates are a fixed, small table and broadcast; k-grams are made,
hashed and probed in one stage and only matches reach a shuffle.

Defined results: null or empty text has no words and no label; repeated
rows repeat their result; an empty table gives an empty result; further
columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm._util import col, staged, table, text_key

K = 3
#: Diagonals this close belong to one span; a span must cover this share of its template.
NEAR_DIAGONALS, MIN_COVERED = 4, 0.7
#: Words of a span for each word of its template, at most.
MAX_STRETCH = 1.5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False        # must stand word for word


# Phrases and their labels, then sentences of public license notices.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License."),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met"),
    Template("gpl-2", "GNU General Public License, version 2", True),
    Template("gpl-3", "GNU General Public License, version 3", True),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation"),
    Template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
             "published by the Free Software Foundation"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
             "to this work."),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted"),
)


def template_words(text: str) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(SEPARATORS, lower) if w]


def _lower(text: Column) -> Column:
    """A-Z in lower case, as far as words of template letters can tell."""
    # these two are the characters outside A-Z whose lower case holds a letter of A-Z
    odd = text.rlike("[İK]")
    exact = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(odd, exact).otherwise(F.lower(text))


def positions(spark: SparkSession, templates) -> DataFrame:
    """(t, p, w0 .. w2): the k-gram at word p of template t; a template of fewer than K words is an error."""
    short = [x.text for x in templates if len(template_words(x.text)) < K]
    if short:
        raise ValueError(f"templates need {K} words at least: {short}")
    rows = [(t, p, *w[p:p + K]) for t, w in enumerate(template_words(x.text) for x in templates) for p in range(len(w) - K + 1)]
    return spark.createDataFrame(rows, "t int, p int, w0 string, w1 string, w2 string")


def votes(docs: DataFrame, templates, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text (id, key): a row with its number of words (t null), and one per k-gram match (t, p, at)."""
    body = F.coalesce(col(text), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), text_key(text).alias("key"),
                       F.array_remove(F.split(_lower(body), SEPARATORS, -1), "").alias("w"))
    n = F.size("w")
    rows = rows.select("id", "key", "w", n.cast("long").alias("n_words"), F.explode(F.sequence(F.lit(-1), F.greatest(n - K, F.lit(-1)))).alias("at"))
    rows = rows.withColumn("h", F.when(F.col("at") >= 0, F.xxhash64(F.get("w", F.col("at")), F.get("w", F.col("at") + 1), F.get("w", F.col("at") + 2))))
    grams = positions(docs.sparkSession, templates).withColumn("th", F.xxhash64("w0", "w1", "w2"))
    same = F.col("h") == F.col("th")
    for i in range(K):      # two inequalities: Spark would take an equality into the hash key
        word = F.get("w", F.col("at") + i)
        same = same & (word >= F.col(f"w{i}")) & (word <= F.col(f"w{i}"))
    out = rows.join(F.broadcast(grams), same, "left").where((F.col("at") < 0) | F.col("t").isNotNull())
    return out.select("id", "key", "n_words", F.col("at").cast("long").alias("at"), "t", "p")


def spans(voted: DataFrame, templates) -> DataFrame:
    """Verified spans (id, key, t, first, last, covered): words first .. last of the text, share of the template."""
    size = [len(template_words(x.text)) for x in templates]
    by = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("t"))
    # one row per diagonal: which template positions voted, never more than the template has
    lines = (voted.where("t IS NOT NULL").groupBy("id", "key", "t", (F.col("at") - F.col("p")).alias("diagonal"))
             .agg(F.collect_set("p").alias("ps")))
    phrase = by([x.phrase for x in templates])
    near = Window.partitionBy("id", "key", "t").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(near)
    lines = lines.withColumn("new", (phrase | gap.isNull() | (gap > NEAR_DIAGONALS)).cast("int"))
    lines = lines.withColumn("span", F.sum("new").over(near))
    merged = lines.groupBy("id", "key", "t", "span").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.array_distinct(F.flatten(F.collect_list("ps"))).alias("ps"))
    words = F.array_distinct(F.flatten(F.transform("ps", lambda p: F.array(*[p + i for i in range(K)]))))
    merged = merged.withColumn("covered", F.size(words) / by(size)).withColumn("need", by([1.0 if x.phrase else MIN_COVERED for x in templates]))
    merged = merged.withColumns({"first": F.col("low") + F.array_min("ps"), "last": F.col("high") + F.array_max("ps") + K - 1})
    close = F.col("last") - F.col("first") + 1 <= MAX_STRETCH * by(size)
    return merged.select("id", "key", "t", "first", "last", F.when(close, F.col("covered")).otherwise(F.lit(0.0)).alias("covered"),
                         (close & (F.col("covered") >= F.col("need"))).alias("verified"))


def licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per text: id, n_words, phrase places and labels, all labels, best coverage and the verified spans."""
    templates = tuple(phrases) + tuple(notices)
    # matches and one row per text: few, and read twice
    voted = staged(votes(docs, templates, id_col, text), "license-votes")
    by = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("t"))
    found = spans(voted, templates).withColumn("label", by([x.label for x in templates]))
    base = (F.col("t") < len(phrases)) & F.col("verified")
    per_doc = found.groupBy("id", "key").agg(
        F.sum(base.cast("long")).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(F.col("verified"), F.col("label")))).alias("labels"),
        F.max("covered").alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("verified"), F.struct("first", "last", "label")))).alias("spans"))
    per_doc = per_doc.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "n_base", "first_word", "last_word", "base_labels",
                             "labels", "score", "spans")
    texts = voted.where("at < 0").select("id", "key", "n_words")
    out = texts.join(per_doc, texts.id.eqNullSafe(per_doc["__id"]) & (texts.key == per_doc["__key"]), "left")
    none = F.array().cast("array<string>")
    return out.select("id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"), "spans")


def op3_license_scan(spark, sf_dir):
    """Per document the places of license phrases, its labels and the best template coverage."""
    out = licenses(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")

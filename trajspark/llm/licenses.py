"""License scans by diagonal voting.

Rolling word k-grams of every text are joined with the k-grams of license templates by their
hashes. A match votes for the diagonal (place in the text minus place in the template), and
diagonals of a template that lie next to each other are merged (words put in or left out shift
them). A span is verified by the share of the template's places that it holds, each counted once and
in order, and by all k-grams of the template's key phrase, the words that tell it from its likes. Of
verified spans that overlap the one that holds most wins. A phrase whose k-grams all vote for one
diagonal stands there word for word. DataFrame functions only.
"""

import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from trajspark.llm.common import let

GRAM = 3                 # words of a k-gram
NEXT_TO = 3              # diagonals at most so far apart belong to one span
VERIFIED = 0.6           # share of a template's k-grams that a span must hold
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))
# Opening or typical sentences of public licenses, their key phrases in brackets.
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction including without limitation the rights to use copy modify "
            "merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the [apache license version 2] 0 the license you may not use this "
                 "file except in compliance with the license you may obtain a copy of the license "
                 "at http www apache org licenses license 2 0"),
    ("apache-2", "licensed under the [apache license version 2] 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted provided that the above copyright notice and this "
            "permission notice appear in all copies"),
    ("mpl-2", "this source code form is subject to the terms of the [mozilla public license v 2] 0 "
              "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the "
              "[eclipse public license 2] 0 which is available at"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is "
                  "free to copy modify publish use compile sell or distribute this software"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"))
GNU = (("gpl", "program", "gnu general"), ("lgpl", "library", "gnu lesser general"),
       ("agpl", "program", "gnu affero general"))
COMMONS = (("cc-by", "attribution"), ("cc-by-sa", "attribution sharealike"),
           ("cc-by-nc", "attribution noncommercial"), ("cc-by-nd", "attribution noderivatives"),
           ("cc-by-nd", "attribution noderivs"),
           ("cc-by-nc-sa", "attribution noncommercial sharealike"),
           ("cc-by-nc-nd", "attribution noncommercial noderivatives"),
           ("cc-by-nc-nd", "attribution noncommercial noderivs"))
VERSIONS = ("4 0] international", "3 0] unported")
TEMPLATES = TEXTS + tuple(
    (label, f"this {work} is free software you can redistribute it and or modify it under the terms "
            f"of [the {name} public license] as published by the free software foundation")
    for label, work, name in GNU) + tuple(
    (label, f"licensed under [the {name} public license]") for label, _, name in GNU) + tuple(
    (label, f"licensed under a creative [commons {name} {version} license")
    for label, name in COMMONS for version in VERSIONS)


def template_words(text):
    return [w for w in re.split(GAPS, text) if w]


def _grams(phrases=PHRASES, templates=TEMPLATES):
    """(template, label, base, place, total, key, n_key, words) of every k-gram; `key` marks those
    of the key phrase."""
    rows = []
    for t, (base, label, text) in enumerate(
            [(True, label, text) for text, label in phrases]
            + [(False, label, text) for label, text in templates]):
        words = template_words(text)
        before, _, rest = text.partition("[")
        key = template_words(rest.partition("]")[0])
        first, size = len(template_words(before)), max(0, len(key) - GRAM + 1)
        total = len(words) - GRAM + 1
        rows += [(t, label, base, k, total, first <= k < first + size, size, *words[k:k + GRAM])
                 for k in range(total)]
    return rows


def _values(**texts):
    return ", ".join(f"({t}, '{label}', {str(base).lower()}, {k}, {total}, {str(key).lower()}, {n}, "
                     + ", ".join(f"'{w}'" for w in words) + ")"
                     for t, label, base, k, total, key, n, *words in _grams(**texts))


COLUMNS = ("template", "label", "base", "place", "total", "key", "n_key")


def template_grams(spark: SparkSession, **texts) -> DataFrame:
    names = [f"w{k}" for k in range(GRAM)]
    rows = spark.sql(f"SELECT * FROM VALUES {_values(**texts)} AS "
                     f"t({', '.join(COLUMNS)}, {', '.join(names)})")
    return rows.withColumn("hash", F.xxhash64(*names)).drop(*names)


def _hashes(words):
    last = F.size(words) - GRAM
    gram = lambda k: F.xxhash64(*[F.get(words, k + j) for j in range(GRAM)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(
        F.array().cast("array<bigint>"))


DOC = ("doc_id", "h1", "h2")
SPAN = (*DOC, "n_words", "template", "label", "base", "total", "n_key", "span")


def _votes(docs, grams):
    """One row per document, diagonal and place of a template, and one per document without a
    template. Rows that agree in doc_id and text are one document, `copies` times."""
    # A Kelvin sign would become an ASCII k; no other character of a word becomes an ASCII one.
    text = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    # Place 0 of the exploded array stands for the document itself.
    found = let(F.array_remove(F.split(text, GAPS), ""), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.concat(F.array(F.lit(0).cast("bigint")), _hashes(w)).alias("hashes")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("h1"),
                       F.xxhash64(F.lit(1), "text").alias("h2"), found.alias("f"))
    rows = rows.select(*DOC, "f.n_words", F.posexplode("f.hashes").alias("spot", "h"))
    joined = rows.join(F.broadcast(grams), F.expr("h = hash and spot > 0"), "left")
    return (joined.filter("spot = 0 or template is not null")
            .withColumn("diagonal", F.col("spot") - 1 - F.col("place"))
            .groupBy(*DOC, "n_words", *COLUMNS, "diagonal").agg(F.count("*").alias("copies")))


def _spans(votes):
    """One row per merged run of diagonals: `found`, its places with their first words, and the
    places where a base phrase stands whole (`n_base`, `first_word`, `last_word`)."""
    by_place = Window.partitionBy(*DOC, "template").orderBy("diagonal", "place")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_place) > NEXT_TO, F.lit(True))
    on_diagonal = F.count("*").over(Window.partitionBy(*DOC, "template", "diagonal"))
    hit = F.expr("base and place = 0") & (on_diagonal == F.col("total"))
    placed = votes.withColumns({"span": F.sum(new.cast("int")).over(by_place), "hit": hit})
    at_hit = F.when(F.col("hit"), F.col("diagonal"))
    # A phrase may be repeated without end in one span; its places are few.
    places = placed.groupBy(*SPAN, "place", "key").agg(
        F.min(F.col("diagonal") + F.col("place")).alias("at"), F.count_if("hit").alias("hits"),
        F.min(at_hit).alias("first"), F.max(at_hit).alias("last"), F.max("copies").alias("copies"))
    return places.groupBy(*SPAN).agg(
        F.sort_array(F.collect_list(F.struct("place", "at"))).alias("found"),
        F.count_if("key").alias("keys"), F.sum("hits").alias("n_base"), F.max("copies").alias("copies"),
        F.min("first").alias("first_word"), F.max("last").alias("last_word"),
        F.min("at").alias("start"), (F.max("at") + GRAM).alias("end"))


def _winners(spans):
    """Adds `wins`: verified spans, but of those that overlap the best one of their run, and what
    does not overlap it."""
    in_order = F.size(F.filter(F.transform("found", lambda p, k: F.coalesce(
        p["at"] > F.get("found", k - 1)["at"], F.lit(True))), lambda x: x))
    spans = spans.withColumn("held", F.when(F.col("total").isNotNull(), in_order)).drop("found")
    spans = spans.withColumn("share", F.col("held") / F.col("total"))
    spans = spans.withColumn("verified", F.coalesce(
        ~F.col("base") & (F.col("share") >= VERIFIED) & (F.col("keys") == F.col("n_key")),
        F.lit(False)))
    in_text = Window.partitionBy(*DOC).orderBy(F.desc("verified"), "start", "end", "template", "span")
    reached = F.max(F.when(F.col("verified"), F.col("end"))).over(
        in_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce(F.col("start") >= reached, F.lit(True)))
    spans = spans.withColumn("run", F.sum(F.col("new").cast("int")).over(
        in_text.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.first(F.struct("start", "end", "template", "span")).over(
        Window.partitionBy(*DOC, "run").orderBy(F.desc("verified"), F.desc("held"), F.desc("share"),
                                                "template", "span"))
    spans = spans.withColumn("best", best)
    is_best = F.expr("best.template = template and best.span = span")
    apart = F.expr("start >= best.end or end <= best.start")
    return spans.withColumn("wins", F.col("verified") & (is_best | apart))


def license_scan(docs: DataFrame, **texts) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    The templates are broadcast; their number is fixed by the arguments. `score` is the largest
    share of a template found in one place, 1 where a base phrase stands. A phrase shorter than
    a k-gram cannot be found, so phrases have three words or more. Null texts count as empty;
    texts without matches have null places, empty labels and a score of 0. Repeated rows are
    returned each. Other columns are ignored; an empty table gives an empty result. Equality of
    words is that of 64-bit hashes of three words.
    """
    spans = _winners(_spans(_votes(docs.select("doc_id", "text"), template_grams(
        docs.sparkSession, **texts))))
    labels = lambda when: F.array_join(F.array_sort(F.collect_set(
        F.when(when, F.col("label")))), ",")
    found = spans.groupBy(*DOC, "n_words").agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").cast("long").alias("first_word"),
        F.max("last_word").cast("long").alias("last_word"),
        labels(F.expr("n_base > 0")).alias("base_labels"),
        labels(F.expr("n_base > 0 or wins")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("base"), F.when(F.expr("n_base > 0"), 1.0)
                                .otherwise(0.0)).otherwise(F.col("share"))), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"))
    names = [c for c in found.columns if c not in ("h1", "h2", "copies")]
    return found.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy")
                        ).select(*names)


ORACLE_SQL = f"""
WITH grams AS (
  SELECT *, concat_ws(' ', w0, w1, w2) AS gram
  FROM (VALUES {_values()}) t({', '.join(COLUMNS)}, w0, w1, w2)),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents),
spots AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 3], ' ') AS gram
  FROM docs, LATERAL (SELECT unnest(range(len(w) - 2)) AS i) WHERE len(w) > 2),
matches AS (
  SELECT doc_id, template, label, base, total, key, n_key, place, i, i - place AS diagonal
  FROM spots JOIN grams USING (gram)),
whole AS (
  SELECT doc_id, label, diagonal FROM matches WHERE base
  GROUP BY doc_id, template, label, total, diagonal HAVING count(*) = total),
marked AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (
      PARTITION BY doc_id, template ORDER BY diagonal, place) > 3, true) AS new FROM matches),
numbered AS (
  SELECT *, sum(CAST(new AS INT)) OVER (
      PARTITION BY doc_id, template ORDER BY diagonal, place) AS span FROM marked),
places AS (
  SELECT doc_id, template, label, base, total, n_key, key, span, place, min(i) AS first
  FROM numbered GROUP BY ALL),
stepped AS (
  SELECT *, coalesce(first > lag(first) OVER (
      PARTITION BY doc_id, template, span ORDER BY place), true) AS on_way FROM places),
spans AS (
  SELECT doc_id, template, label, base, span, total, min(first) AS a, max(first) + 3 AS b,
    count(*) FILTER (on_way) AS held, count(*) FILTER (on_way) / total AS share,
    NOT base AND count(*) FILTER (on_way) / total >= {VERIFIED}
      AND count(*) FILTER (key) = n_key AS verified
  FROM stepped GROUP BY doc_id, template, label, base, span, total, n_key),
runs AS (
  SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY a, b, template, span) AS run
  FROM (SELECT *, coalesce(a >= max(b) OVER (PARTITION BY doc_id ORDER BY a, b, template, span
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM spans WHERE verified)),
ranked AS (
  SELECT *, first(a) OVER best AS best_a, first(b) OVER best AS best_b,
    row_number() OVER best AS place
  FROM runs WINDOW best AS (PARTITION BY doc_id, run ORDER BY held DESC, share DESC, template, span)),
winners AS (SELECT doc_id, label FROM ranked WHERE place = 1 OR a >= best_b OR b <= best_a),
bases AS (
  SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM whole GROUP BY doc_id),
named AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM whole UNION ALL SELECT * FROM winners) GROUP BY doc_id),
scores AS (SELECT doc_id, max(share) AS score FROM spans WHERE NOT base GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(score, 0) END AS DOUBLE) AS score
FROM docs d LEFT JOIN bases USING (doc_id) LEFT JOIN named USING (doc_id)
LEFT JOIN scores USING (doc_id)
"""

"""License texts found by diagonal voting of word k-grams against templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.common import pick
from tallyloom.llm.url_filters import LOWER, UPPER

K = 3
#: Diagonals this near to the one before belong to one span: a word more or less moves them by one.
NEAR = 2
#: Share of a template's k-grams that a span must hold.
SHARE = 0.6

# Phrases whose places are counted exactly, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Telling passages of common licenses, as words, with their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("all rights reserved no part of this publication may be reproduced", "reserved"),
    ("this is free and unencumbered software released into the public domain", "public-domain"),
)


def words_text(text: Column) -> Column:
    """The words, A-Z in lower case, with one space between them; empty for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lower, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def template_grams(spark, templates=TEMPLATES) -> DataFrame:
    """(template, label, n_grams, t_pos, gram) of every template: a table as long as the templates."""
    values = ", ".join(f"({i}, '{label}', split('{text}', ' '))" for i, (text, label) in enumerate(templates))
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, words)")
    rows = rows.withColumn("n_grams", F.size("words") - (K - 1))
    return rows.select("template", "label", "n_grams", F.posexplode(_grams("words")).alias("t_pos", "gram")).filter("t_pos < n_grams")


def _grams(words: str) -> Column:
    """A hash for each word and the ``K - 1`` after it; the last ``K - 1`` are cut short."""
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, K)]))


def license_scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """Words, exact phrase places and the license labels of every whole text.

    All rolling k-gram hashes are joined with the template positions; hits of one text and template
    are counted by diagonal (text position minus template position), neighbouring diagonals are
    merged, and a span counts if it holds ``SHARE`` of the template's k-grams within about the
    template's length. ``score`` is the largest share found, 1 where a phrase stands in full and 0
    without any hit. The template table is fixed by its author, so it may be broadcast; only hits
    are shuffled, and never more than those of one text meet.

    Null and empty texts have no words, empty labels and null places. Rows with the same key and
    words get the same result, one row each; a null key is kept. Windows run within one text and template.
    """
    rows = pick(docs, key, text).select(F.col(key).alias("k"), words_text(F.col(text)).alias("norm"))
    rows = rows.withColumn("h", F.xxhash64("norm"))
    grams = rows.filter("norm <> ''").select("k", "h", F.split("norm", " ").alias("words"))
    grams = grams.withColumn("n", F.size("words")).select("k", "h", "n", F.posexplode(_grams("words")).alias("pos", "gram")).filter(F.col("pos") <= F.col("n") - K)
    table = template_grams(docs.sparkSession, templates)
    hits = grams.join(table, "gram").groupBy("k", "h", "template", "label", "n_grams", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
    votes = hits.agg(F.collect_set("t_pos").alias("held"), F.min("pos").alias("begin"), F.max("pos").alias("end"))
    one = Window.partitionBy("k", "h", "template").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(one) <= NEAR, 0).otherwise(1)
    merged = votes.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(one)).groupBy("k", "h", "template", "label", "n_grams", "span")
    spans = merged.agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"), F.min("begin").alias("begin"), F.max("end").alias("end"))
    share = F.size("held") / F.col("n_grams")
    fits = (share >= SHARE) & (F.col("end") - F.col("begin") + 1 <= 2 * F.col("n_grams") + K)
    found = spans.groupBy("k", "h").agg(F.max(share).alias("share"), F.collect_set(F.when(fits, F.col("label"))).alias("found"))

    padded = rows.withColumn("padded", F.concat(F.lit(" "), "norm", F.lit(" ")))
    places, firsts, lasts, names = [], [], [], []
    for phrase, label in PHRASES:
        p = f" {phrase} "
        held = F.contains("padded", F.lit(p))
        places.append(F.when(held, F.regexp_count("padded", F.lit(f"(?={p})"))).otherwise(0))
        at = F.when(held, F.instr("padded", p))
        firsts.append(_spaces(F.substring("padded", F.lit(1), at - 1)))
        back = F.when(held, F.instr(F.reverse("padded"), p[::-1]))
        lasts.append(_spaces(F.substring("padded", F.lit(1), F.length("padded") - (back - 1) - len(p))))
        names.append(F.when(held, F.lit(label)))
    base = padded.select(
        "k",
        "h",
        F.when(F.col("norm") == "", 0).otherwise(_spaces(F.col("norm")) + 1).cast("long").alias("n_words"),
        sum(places[1:], places[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*names)).alias("own"),
    )
    found = found.select(F.col("k").alias("k2"), F.col("h").alias("h2"), "share", "found")
    joined = base.join(found, base["k"].eqNullSafe(found["k2"]) & (base["h"] == found["h2"]), "left")
    labels = F.sort_array(F.array_union("own", F.coalesce("found", F.array().cast("array<string>"))))
    return joined.select(
        F.col("k").alias(key),
        *("n_words", "n_base", "first_word", "last_word"),
        F.array_join(F.sort_array(F.array_distinct("own")), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )

"""Licence scan by diagonal voting.

Every two-word gram of every text is joined with the grams of licence templates.
A template that stands in a text puts its hits on one diagonal (place in the
text minus place in the template); words added or lost move the rest to a
neighbouring diagonal.  Neighbouring diagonals are merged, those of a single vote
too, and the merged span is verified: a phrase needs all its words in a row, a
longer notice ``COVERED`` of its grams inside a span of at most twice its length,
each gram counted once, and two grams at least.  A notice that is not complete gives
no label where longer matches of other notices hold all the grams it has.
The join compares the words themselves, so a hash collision is no hit.

Defined cases: a null or empty text has no words and no labels; rows that repeat
id and text get equal results; a null ``doc_id`` is a key like any other; an empty
table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sharding import small_table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
COVERED = 0.7
GAP = 4  # diagonals this close belong to one occurrence

# Phrases of the base scan.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Notices and opening sentences of public licences.
NOTICES = (
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
     "apache-2.0"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("released under the mit license", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
)


def template_grams(phrases=PHRASES, notices=NOTICES) -> list[tuple]:
    """(template, label, base, grams, place, one, two) of every two-word gram."""
    rows = []
    for t, (text, label, base) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices]):
        words = re.findall(WORD, text)
        rows += [(t, label, base, len(words) - 1, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    return rows


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    # the matches of WORD in the lowered text, at a small part of the cost of a pattern
    words = F.array_remove(F.split(F.translate(text, _BETWEEN + _UPPER, " " * len(_BETWEEN) + _LOWER), " "), "")
    key = ["doc_id", "text_key"]
    base = docs.select("doc_id", F.xxhash64(text).alias("text_key"), words.alias("words"))
    # the templates are a parameter of a few hundred rows
    grams = F.broadcast(small_table(
        spark, template_grams(phrases, notices),
        "template int, label string, base boolean, grams int, place int, one string, two string")
        .withColumn("gram", F.xxhash64("one", "two")))
    rolled = base.select(*key, "words", F.posexplode(F.zip_with(
        "words", F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b))).alias("at", "gram"))
    hits = rolled.join(grams, "gram").where(
        (F.get("words", F.col("at")) == F.col("one")) & (F.get("words", F.col("at") + 1) == F.col("two"))).select(
        *key, "template", "label", "base", "grams", "place", "at", (F.col("at") - F.col("place")).alias("diagonal"))
    # all that follows is done per text: hits are dealt out once
    hits = hits.repartition(*[F.col(c) for c in key]).distinct()
    # a phrase keeps its diagonal; a notice may continue on the next ones, with a single vote too
    run = Window.partitionBy(*key, "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(run) > F.when(F.col("base"), 0).otherwise(GAP), F.lit(True))
    runs = hits.withColumn("new", far.cast("int")).withColumn("group", F.sum("new").over(run))
    # of each run the stretch of at most twice the template's length that holds most of its grams
    longest = max((len(re.findall(WORD, t[0])) for t in (*phrases, *notices)), default=1)
    ahead = Window.partitionBy(*key, "template", "group").orderBy("at").rangeBetween(0, 2 * longest)
    inside = F.filter(F.collect_list(F.struct("at", "place")).over(ahead),
                      lambda h: h["at"] < F.col("at") + 2 * F.col("grams"))
    stretch = runs.withColumn("inside", inside).select(
        *key, "template", "label", "base", "grams", "group", "diagonal", F.struct(
            F.size(F.array_distinct("inside.place")).alias("votes"), (-F.col("at")).alias("first"),
            F.array_distinct("inside.at").alias("ats")).alias("stretch"))
    least = F.when(F.col("base"), F.col("grams")).otherwise(F.least(F.lit(2), F.col("grams")))
    merged = stretch.groupBy(*key, "template", "label", "base", "grams", "group").agg(
        F.min("diagonal").alias("diagonal"), F.max("stretch").alias("stretch")).select(
        "*", "stretch.votes", "stretch.ats").where(F.col("votes") >= least).withColumn(
        "covered", F.col("votes") / F.col("grams"))
    # part of a notice is no sign of it where longer matches hold all its grams (cc by in cc by nc)
    enough = ~F.col("base") & (F.col("covered") >= COVERED)
    most = F.max("votes").over(Window.partitionBy(*key, "word"))
    spans = merged.withColumn("word", F.explode_outer(F.when(enough, F.col("ats")))).withColumn("most", most).groupBy(
        *key, "template", "label", "base", "group", "diagonal", "covered").agg(
        F.bool_or(enough & ((F.col("votes") == F.col("most")) | (F.col("votes") == F.col("grams")))).alias("sure"))
    sure = F.col("sure")

    def named(condition):
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    found = spans.groupBy(*key).agg(
        F.count_if(F.col("base")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("diagonal"))).cast("long").alias("last_word"),
        named(F.col("base")).alias("base_labels"), named(F.col("base") | sure).alias("labels"),
        F.max("covered").alias("score"))
    k1, k2 = (F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), F.col("d.text_key") == F.col("f.text_key"))
    sizes = base.select(*key, F.size("words").cast("long").alias("n_words"))
    return sizes.alias("d").join(found.alias("f"), k1 & k2, "left").select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

"""License scans by diagonal voting, in Spark expressions only.

All rolling word grams of every text are joined, by hash, to the places of license templates. A template place that
stands d words before its place in the text votes for diagonal d. Four neighbouring diagonals, for up to three words put
in or left out, make a band; a band whose votes reach a share of the template's grams carries the template's label. The
join compares the grams' words beside their hashes, so each vote is verified, and as a band does not grow with its
votes, they all lie in one span of about the template's length. A phrase stands where its template has all votes of
one diagonal.

Missing and empty texts have no words, no labels and score 0. Rows that share a doc_id are judged each by its own
text; fully equal rows give one row each, with the same values; a missing doc_id is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.words import positions

GRAM = 3
#: The diagonals of a band are at most so far apart.
SLACK = 3
SHARE = 0.7

#: Phrases whose places are counted, with their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Further license texts, told by their bands.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("all rights reserved", "all-rights-reserved"),
]
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per place of a template: as many as the fixed texts above have words, and one that every text has."""
    rows = [(-1, 0, 0, False, "", "")]
    for number, (text, label) in enumerate(BASE + TEMPLATES):
        w = text.split()
        n = len(w) - GRAM + 1
        rows += [(number, at, n, number < len(BASE), label, " ".join(w[at : at + GRAM])) for at in range(n)]
    return spark.createDataFrame(rows, "template int, at int, grams int, base boolean, label string, gram string").withColumn(
        "hash", F.xxhash64("gram")
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    # Only A-Z matter, since templates are ASCII; the one other letter that lower() makes ASCII is put aside.
    lower = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    w = F.col("w")
    grams = F.transform(
        positions(w, GRAM), lambda i: F.struct(i.alias("at"), F.concat_ws(" ", *[F.get(w, i + k) for k in range(GRAM)]).alias("gram"))
    )
    marker = F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("gram")))
    rolled = (
        docs.select("doc_id", F.xxhash64("text").alias("row"), F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0)).alias("w"))
        .select("doc_id", "row", F.size("w").cast("long").alias("n_words"), F.explode(F.concat(marker, grams)).alias("g"))
        .select("doc_id", "row", "n_words", F.col("g.at").alias("start"), "g.gram", F.xxhash64("g.gram").alias("hash"))
    )
    places = template_grams(docs.sparkSession)
    # The templates are fixed texts of some hundred words, so they go to every task.
    votes = rolled.join(F.broadcast(places), ["hash", "gram"]).select(
        "doc_id", "row", "n_words", "template", "at", "grams", "base", "label", (F.col("start") - F.col("at")).alias("diagonal")
    )
    lines = votes.groupBy("doc_id", "row", "n_words", "template", "grams", "base", "label", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_set("at").alias("ats")
    )
    # The votes of a band of SLACK + 1 diagonals lie in one span, longer than the template by SLACK words at most, and
    # stand in the template's order but for as many places.
    band = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal").rangeBetween(0, SLACK)
    whole = F.size("ats") == F.col("grams")
    told = lines.withColumn("whole", whole).withColumn(
        "share",
        F.when(F.col("template") >= 0, F.size(F.array_distinct(F.flatten(F.collect_list("ats").over(band)))) / F.col("grams")).otherwise(0.0),
    )
    is_base = F.col("base") & F.col("whole")
    labels = lambda rule: F.array_join(F.array_sort(F.collect_set(F.when(rule, F.col("label")))), ",")
    per_text = told.groupBy("doc_id", "row", "n_words").agg(
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("diagonal"))).cast("long").alias("last_word"),
        labels(is_base).alias("base_labels"),
        labels((F.col("template") >= 0) & (F.col("share") >= SHARE)).alias("labels"),
        F.max("share").cast("double").alias("score"),
        # Repeated rows of one text vote alike; the marker has one vote for each of them.
        F.max(F.when(F.col("template") < 0, F.col("votes"))).alias("copies"),
    )
    out = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return per_text.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*out)

"""License scans: a positional index of licence words, entered by each template's rarest mandatory word.

Templates are short public licence notices cut into words.  Of each file the
licence words (template words that are not function words) are kept with their
places and the words that follow; their document frequencies over all files give
an IDF.  Every template is entered by the licence word of its mandatory key phrase
that has the highest IDF: each place of that word in a file proposes where the
template would begin.  No template is missed, for its key phrase has to stand there
as a whole.  The template's postings, shifted to that beginning, are intersected with the
file's by place and word; the key phrase is verified word for word, function
words by what follows the licence words, and the template counts if the IDF share
of matched words is high enough.  What is proposed depends on neither the other
licences of a file nor other files.  Base phrases are looked up alike, by all
their words.

Only licence words leave the scan, so no text is shuffled.  All of it is
DataFrame functions.

Defined results: null text counts as empty: no words, no labels, score 0; a null
doc_id is kept; repeated rows each give a row; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import durable

#: The phrases every scan reports in full.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Public licence notices as (label, words, mandatory key phrase).
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("proprietary", "proprietary and confidential unauthorized copying of this file via any medium is strictly prohibited", "proprietary and confidential"),
]

#: Function words, which are no licence words: a fifth of all text, they tell nothing.  Those of a base phrase are.
FUNCTION_WORDS = {"a", "and", "any", "are", "as", "at", "for", "in", "into", "is", "it", "may", "not", "of", "or", "that", "the", "this", "to", "under", "use", "via", "with", "without", "you"}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Function words that stand between two licence words of a key phrase, at most.
GAP = 4


def _postings() -> list[tuple[int, str, str, int, bool, bool, str]]:
    """(template, label, word, place, mandatory, base, then) of every posting; then are the key phrase's words up to its next posting."""
    out = []
    for k, (phrase, label) in enumerate(BASE):
        out += [(k, label, w, i, True, True, "") for i, w in enumerate(phrase.split())]
    for k, (label, text, key) in enumerate(TEMPLATES, len(BASE)):
        words, must = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
        for i, w in enumerate(words):
            if w not in FUNCTION_WORDS:
                inside, then = at <= i < at + len(must), []
                while inside and i + 1 + len(then) < at + len(must) and words[i + 1 + len(then)] in FUNCTION_WORDS:
                    then.append(words[i + 1 + len(then)])
                out.append((k, label, w, i, inside, False, " ".join(then)))
    return out


def postings(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({k}, '{label}', '{w}', {i}, {str(m).lower()}, {str(b).lower()}, '{t}')" for k, label, w, i, m, b, t in _postings())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS p(template, label, word, place, mandatory, base, then)")


def scan_licenses(docs: DataFrame, *, share: float = 0.6) -> DataFrame:
    """One row per row of docs: doc_id, n_words, base_places, base_labels, labels (arrays) and score.

    score is the largest IDF share of an accepted template, 1 for a base phrase alone, 0 without labels.
    """
    spark = docs.sparkSession
    vocabulary = sorted({p[2] for p in _postings()})
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    after = lambda i: F.array_join(F.slice("words", i + 2, GAP), " ")
    hit = F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("at"), w.alias("word"), after(i).alias("after"))))
    files = durable(
        docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
        .select("doc_id", "row", F.size("words").cast("long").alias("n_words"), F.filter(hit, lambda h: h.isNotNull()).alias("hits")))
    hits = files.select("row", F.explode("hits").alias("h")).select("row", "h.*")

    n = files.agg(F.count(F.lit(1)).alias("n"))
    idf = hits.select("row", "word").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("df")).crossJoin(n)
    idf = idf.select("word", F.log((F.col("n") + 1) / (F.col("df") + 0.5)).alias("idf"))
    index = durable(postings(spark).join(idf, "word", "left").fillna(0.0, ["idf"]))  # a row per template word, a few hundred

    rarest = F.max_by(F.struct("word", "place"), F.struct("idf", -F.col("place")))
    entry = index.where("mandatory").groupBy("template").agg(rarest.alias("e"), F.count_if("mandatory").alias("needed")).select("template", "e.word", "e.place", "needed")
    whole = index.groupBy("template").agg(F.sum("idf").alias("all"))
    begins = hits.join(F.broadcast(entry.join(whole, "template")), "word").select("row", "template", "needed", "all", (F.col("at") - F.col("place")).alias("begin"))
    expected = begins.join(F.broadcast(index), "template").withColumn("at", F.col("begin") + F.col("place"))
    met = expected.join(hits, ["row", "at", "word"])
    follows = (F.col("then") == "") | F.concat("after", F.lit(" ")).startswith(F.concat("then", F.lit(" ")))
    both = met.groupBy("row", "template", "label", "base", "needed", "all", "begin").agg(F.count_if(F.col("mandatory") & follows).alias("must"), F.sum("idf").alias("weight")).where("must = needed")
    both = both.withColumn("share", F.when(F.col("base") | (F.col("all") <= 0), 1.0).otherwise(F.col("weight") / F.col("all"))).where(F.col("base") | (F.col("share") >= share))
    found = both.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("begin")))).alias("base_places"),
        F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.least(F.lit(1.0), F.max("share")).alias("score"))
    out = files.select("row", "doc_id", "n_words").join(found, "row", "left")
    none, places = F.expr("array()").cast("array<string>"), F.expr("array()").cast("array<int>")
    return out.select("doc_id", "n_words", F.coalesce("base_places", places).alias("base_places"), F.coalesce("base_labels", none).alias("base_labels"),
                      F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places").cast("long").alias("first_word"), F.array_max("base_places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")

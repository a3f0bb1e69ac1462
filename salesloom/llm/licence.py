"""License scan with a positional index of rare license words; DataFrame functions only.

The words of all license templates form a small vocabulary. One pass over all files counts in
how many each of them occurs. In every file that holds a template's mandatory key phrase the template
is looked up by the rarest of its own words there, however frequent they are: each place of such a word
votes, for every position it has in the template, for a template at the place where it would
have to begin. Votes for the same beginning come from words in the right relative positions. A
template counts where enough of its looked-up words agree on one beginning. A file's result
depends on other files by the choice of words only.

Beside the method stand base labels: places where a license's name stands word for word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of licenses, as words, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Sentences of public license texts and notices, as words; the label of each; the
# phrase that must stand in a file besides.
TEMPLATES = [
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
    ),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    (
        "apache",
        "apache license",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
    ),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
    ),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ),
    (
        "mpl",
        "mozilla public license",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
]

#: Rarest words of a template, of those that stand in the file, by which it is looked up.
LOOKED_UP = 12
#: Share of a template's looked-up words that must agree on one beginning.
AGREEING = 0.8

#: Everything that isn't a word: ASCII but digits and small letters.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def vocabulary() -> list[str]:
    return sorted({word for _, _, text in TEMPLATES for word in text.split()})


def padded(text: str) -> Column:
    """The words of a text in lower case, one blank before and after each; null is empty.

    Letters beyond A-Z may change here too. They stay letters, so words begin and end where they
    did, and none of them turns into a letter of a base phrase.
    """
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), _GAPS, " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def word_count(words: Column) -> Column:
    return F.when(words == "  ", F.lit(0).cast("long")).otherwise(blanks(words) - 1)


def base(words: Column, n_words: Column) -> dict[str, Column]:
    """n_base, first_word, last_word and the base label of each phrase found."""
    places, first, last, labels = [], [], [], []
    for phrase, label in BASE_PHRASES.items():
        inside = f" {phrase} "
        found = F.contains(words, F.lit(inside))
        # The blank behind a phrase may be the one before the next: it is looked at, not taken.
        places.append(F.when(found, F.regexp_count(words, F.lit(f" {phrase}(?= )"))).otherwise(0).cast("long"))
        begins = F.instr(words, F.lit(inside))
        first.append(F.when(found, blanks(F.substring(words, F.lit(1), begins - 1))))
        behind = F.instr(F.reverse(words), F.lit(inside[::-1]))
        after = blanks(F.reverse(F.substring(F.reverse(words), F.lit(1), behind - 1)))
        last.append(F.when(found, n_words - after - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    return {
        "n_base": reduce(lambda a, b: a + b, places),
        "first_word": F.least(*first),
        "last_word": F.greatest(*last),
        "found": F.array_compact(F.array(*labels)),
    }


def rarest_first(files: DataFrame) -> list[str]:
    """The license words of a corpus (column words), by ascending number of files.

    All files count. What comes to the driver is a number for each word of the templates.
    """
    known = F.array(*(F.lit(word) for word in vocabulary()))
    hits = files.select(F.explode(F.array_intersect(known, F.split("words", " "))).alias("word"))
    counts = {row["word"]: row["n"] for row in hits.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary(), key=lambda w: (counts.get(w, 0), w))


def matched(files: DataFrame, rarest: list[str]) -> DataFrame:
    """doc_id, text_hash, method (labels), agreement: of files with a template, each once.

    files: doc_id, text_hash, words. A file's words are exploded only where a key phrase stands.
    """
    texts = [text.split() for _, _, text in TEMPLATES]
    index = [(word, n, place) for n, words in enumerate(texts) for place, word in enumerate(words)]
    index = files.sparkSession.createDataFrame(index, "word string, template int, place int")

    def listed(words: list[str]) -> Column:
        return F.array(*(F.lit(word) for word in words))

    def looked_up(n: int) -> Column:
        """Template n with its rarest words among those of the file, and their places in it."""
        ordered = listed([word for word in rarest if word in texts[n]])
        chosen = F.slice(F.array_intersect(ordered, F.split("words", " ")), 1, LOOKED_UP)
        could = F.size(F.filter(listed(texts[n]), lambda w: F.array_contains(chosen, w)))
        found = F.contains("words", F.lit(f" {TEMPLATES[n][1]} "))
        return F.when(found, F.struct(F.lit(n).alias("template"), chosen.alias("chosen"), could.alias("could")))

    held = F.array_compact(F.array(*(looked_up(n) for n in range(len(TEMPLATES)))))
    any_phrase = reduce(lambda a, b: a | b, (F.contains("words", F.lit(f" {phrase} ")) for _, phrase, _ in TEMPLATES))
    candidates = files.where(any_phrase).withColumn("held", held)
    places = candidates.select(
        "doc_id", "text_hash", "held", F.posexplode(F.split(F.trim("words"), " ")).alias("at", "word")
    ).where(F.array_contains(listed(vocabulary()), F.col("word")))
    label = F.element_at(listed([label for label, _, _ in TEMPLATES]), F.col("template") + 1)
    # The index has a row for each word of the templates: a fixed, small number.
    return (
        places.join(F.broadcast(index), "word")
        .withColumn("own", F.expr("filter(held, x -> x.template = template AND array_contains(x.chosen, word))"))
        .where(F.size("own") > 0)
        .withColumn("could", F.get("own", F.lit(0))["could"])
        .groupBy("doc_id", "text_hash", "template", "could", (F.col("at") - F.col("place")).alias("begins"))
        .agg(F.count_distinct("place").alias("votes"))
        .withColumn("agreement", F.col("votes") / F.col("could"))
        .where(F.col("agreement") >= AGREEING)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(label).alias("method"), F.max("agreement").alias("agreement"))
    )


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each file.

    documents: doc_id, text; other columns are dropped. A null text is empty. score is 1 where a
    base label stands, else the best agreement of a template, else 0. Rows that repeat id and
    text get the same result; files without licenses have empty labels and null places.
    """
    files = documents.select("doc_id", padded("text").alias("words"))
    files = files.withColumn("text_hash", F.xxhash64("words"))
    method = matched(files, rarest_first(files))
    n_words = word_count(F.col("words"))
    found = files.select("doc_id", "text_hash", "words", n_words.alias("n_words"))
    columns = base(F.col("words"), F.col("n_words"))
    found = found.select("doc_id", "text_hash", "n_words", *(c.alias(name) for name, c in columns.items()))
    same = [found["text_hash"] == method["text_hash"], found["doc_id"].eqNullSafe(method["doc_id"])]
    none = F.array().cast(T.ArrayType(T.StringType()))
    labels = F.array_union("found", F.coalesce("method", none))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.join(method, same, "left").select(
        found["doc_id"],
        "n_words",
        "n_base",
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        joined(F.col("found")).alias("base_labels"),
        joined(labels).alias("labels"),
        F.when(F.size("found") > 0, 1.0).otherwise(F.coalesce("agreement", F.lit(0.0))).alias("score"),
    )

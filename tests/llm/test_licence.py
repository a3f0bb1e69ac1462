from __future__ import annotations

import re

import frames

from salesloom.llm import licence

TEXTS = [
    (1, "Released under the MIT License."),
    (2, "mit license mit license MIT-LICENSE"),
    (3, "Apache  License, and the General Public License; mit license"),
    (4, None),
    (5, ""),
    (6, " - "),
    (7, "omit license, mit licenses, MITé License"),
    (8, "word " * 3000 + "licensed under CC BY-NC 4.0 " + "tail " * 3000),
    (9, "cc by nc is a phrase alone"),
    (10, "PERMISSION is hereby granted, free of charge, to any person obtaining a copy of this software and "
         "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    (11, "license mit apache general"),
    (1, "Released under the MIT License."),
    (None, "general public license"),
]


def expected(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def scanned(spark, rows):
    noise = [(1000 + k, frames.text(k, 40)) for k in range(300)]
    frame = spark.createDataFrame(rows + noise, "doc_id long, text string")
    return [r for r in licence.scan(frames.clashing(frame)).collect() if (r["doc_id"] or 0) < 1000]


def test_base_equals_brute_force(spark):
    found = sorted(
        ((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in scanned(spark, TEXTS)),
        key=str,
    )
    assert found == sorted(((i, *expected(t)) for i, t in TEXTS), key=str)


def test_templates_are_found_and_need_their_phrase(spark):
    found = {r["doc_id"]: r for r in scanned(spark, TEXTS)}
    assert found[8]["labels"] == "cc-by-nc" and found[8]["base_labels"] == "" and found[8]["score"] == 1.0
    assert found[10]["labels"] == "mit" and found[10]["base_labels"] == ""
    assert found[9]["labels"] == "cc-by-nc" and found[11]["labels"] == "" and found[7]["labels"] == ""
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in found.values())
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_empty_table(spark):
    assert licence.scan(frames.none(spark)).count() == 0
    assert licence.scan(frames.documents(spark)).count() == len(frames.rows())


def test_frequent_notices_are_found(spark):
    """A notice in all files, in two of two, and a file with several texts: each is found by its own words."""
    bsd = next(text for label, _, text in licence.TEMPLATES if label == "bsd")
    for copies in (2, 60):
        rows = [(k, f"head {k} {bsd} tail; licensed under CC BY-NC 4.0") for k in range(copies)]
        found = licence.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert [r["labels"] for r in found] == ["bsd,cc-by-nc"] * copies
    whole = " ; ".join(text for _, _, text in licence.TEMPLATES)
    (row,) = licence.scan(spark.createDataFrame([(1, whole)], "doc_id long, text string")).collect()
    assert set(row["labels"].split(",")) == {label for label, _, _ in licence.TEMPLATES}

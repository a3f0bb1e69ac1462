"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 300) -> list[str]:
    chance = random.Random(seed)
    return [f"w{chance.randrange(vocabulary)}" for _ in range(n)]


def text(seed: int, n: int) -> str:
    return " ".join(words(seed, n))


def rows() -> list[tuple]:
    base = words(1, 120)
    near = base.copy()
    near[60] = "other"
    far = base.copy()
    far[::9] = ["x"] * len(far[::9])
    out = [
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, " ".join(far)),
        (4, " ".join(base).upper()),
        (5, "  " + "\n".join(base) + "\t"),
        (6, None),
        (7, ""),
        (8, " \n\t "),
        (9, "one two"),
        (10, "one two"),
        (11, "Two One"),
        (12, "ha " * 300),
        (13, text(2, 5000)),
        (14, text(2, 5000) + " " + text(3, 40)),
        (15, text(4, 34)),
        (16, text(4, 34)),
        (17, text(5, 35)),
        (18, text(5, 35) + " tail"),
        (None, text(6, 80)),
        (None, text(6, 80)),
        (19, text(7, 90)),
        (19, text(7, 90)),
        (19, text(8, 90)),
        (20, "é ñ \x1c\x85 nbsp\xa0here " + text(9, 50)),
        (21, "\x0b".join(words(10, 60))),
    ]
    common = " ".join(words(11, 40))
    out += [(100 + k, text(200 + k, 30) + " " + common + " " + text(400 + k, 30)) for k in range(30)]
    out += [(200 + k, common) for k in range(30)]
    return [(i, t, None if i is None or i % 7 == 0 else "en", "s", len(t or "")) for i, t in out]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), DOCUMENTS)


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def clashing(frame: DataFrame) -> DataFrame:
    """The same rows with columns named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ("node", "text_key", "own_key", "own_id", "own_parts", "quality_score", "label", "features", "packed", "n")
    return frame.withColumns({name: F.lit(1) for name in names})

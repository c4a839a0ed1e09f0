"""Small tables with the odd rows that every operator has to take."""

from __future__ import annotations

import random

# Columns whose names operators use themselves.
CLASHING = ["name", "cell", "item", "length", "ids", "score", "label", "labels", "row", "block"]
SCHEMA = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)


def documents(spark, rows):
    extra = ["x"] * len(CLASHING)
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SCHEMA)


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Null, empty and long texts, repeated rows, ties and a row without id."""
    long = " ".join(f"word{i % 977} Ünï{i % 31}, the" for i in range(30_000))
    return [
        (0, "The cat sat on the mat and looked at the dog."),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, long),
        (5, "The cat sat on the mat and looked at the dog."),
        (5, "The cat sat on the mat and looked at the dog."),
        (6, "a"),
        (7, "漢字 かな \U0001f600 <|endoftext|> \x00 x"),
        (None, "no id here, but some words to count all the same"),
    ]


def sentences(seed: int, count: int, words: int = 30) -> list[str]:
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "rt", "lé", "")]
    return [" ".join(rng.choices(vocabulary, k=words)) for _ in range(count)]

"""Small inputs for the operators' tests."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, stem: str = "w") -> str:
    return " ".join(f"{stem}{rng.randrange(4000)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(3)
    passage = sentence(rng, 60)
    near = sentence(rng, 120).split()
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "  \n\t ", "en", "a", 5),
        (4, passage, "en", "a", 1),
        (5, sentence(rng, 30) + " " + passage + "\n" + sentence(rng, 30), "en", "b", 2),
        (6, passage, "en", "b", 1),
        (7, passage.replace(" ", "  \n"), "en", "b", 1),
        (8, " ".join(near), "en", "b", 1),
        (9, " ".join([*near[:60], "other", *near[61:]]), "en", "b", 1),
        (10, " ".join([*near[:60], "OTHER", *near[61:119]]).upper(), "en", None, 1),
        (11, "one two", "en", "b", 1),
        (12, "One  two", "en", "b", 1),
        (13, "12 345 . !!", "en", "b", 1),
        (14, sentence(rng, 9000), "en", "b", 1),
        (15, "x" * 5000, "de", "b", 1),
        (16, "é ü ß ñ à", "fr", "b", 1),
        (5, sentence(rng, 55) + " " + passage, "en", "b", 2),
        (17, "repeated row with some words", "en", "c", 1),
        (17, "repeated row with some words", "en", "c", 1),
        (None, passage, "en", "c", 1),
    ]
    return rows


def frame(spark, rows, schema=COLUMNS):
    return spark.createDataFrame(rows, schema)


def many(n: int, seed: int = 1) -> list[tuple]:
    """Random documents with copies, near copies and shared passages."""
    rng = random.Random(seed)
    shared = [sentence(rng, 70) for _ in range(4)]
    rows: list[tuple] = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.15 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.4 and rows:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(1, 4)):
                if words:
                    words[rng.randrange(len(words))] = f"n{rng.randrange(50)}"
            text = " ".join(words)
        elif kind < 0.6:
            text = f"{sentence(rng, rng.randrange(40))} {rng.choice(shared)} {sentence(rng, rng.randrange(40))}"
        else:
            text = sentence(rng, rng.randrange(1, 160))
        rows.append((i, text, "en", "s", len(text)))
    return rows

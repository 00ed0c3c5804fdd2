"""Small tables that every operator and stage must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; the extra columns must neither crash nor change results.
CLASHING = ["hash", "line", "doc", "n", "part", "length", "component", "host", "tid", "size", "rank", "word", "label", "kept", "frequent", "_drop0"]

WORDS = "river stone market winter garden letter engine valley paper silver window bridge forest summer copper harbour night field music road".split()


def sentence(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(f"{draw.choice(WORDS)}{draw.randint(0, 400)}" for _ in range(n))


def changed(text: str, at: int, word: str = "other") -> str:
    own = text.split(" ")
    own[at] = word
    return " ".join(own)


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing columns."""
    base, line = sentence(1, 60), sentence(2, 14)
    texts = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, changed(base, 30), None, "a"),
        (4, None, "en", "b"),
        (5, "", "de", None),
        (6, " \n\t ", None, "b"),
        (7, "one two", "en", "a"),
        (8, "One\ttwo", "en", "a"),
        (9, sentence(3, 40) + "\n" + line, "de", "c"),
        (10, sentence(4, 40) + "\n" + changed(line, 5) + "\n" + line.upper(), "de", "c"),
        (11, "\n".join([line] * 3), "de", "c"),
        (12, " ".join(sentence(5 + k, 500) for k in range(40)), "en", "c"),
        (None, sentence(90, 30), "en", None),
        (None, None, None, None),
        (13, "x" * 50_000, "en", "a"),
        (14, "é ß 中文 … \x85 \xa0 😀 ﻿ z", None, "a"),
    ]
    rows = [(*r, None if r[1] is None else len(r[1])) for r in texts]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("extra").alias(c) for c in CLASHING])


def rows(df) -> list[tuple]:
    """All rows in one order, whatever their nulls."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])

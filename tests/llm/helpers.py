"""Small tables with nulls, empty and long texts, repeats and clashing columns."""

from __future__ import annotations

import random

SYLLABLES = "an the re on ti or ing ed st ly ha ou wh es nd".split()


def words(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    out = words(seed, n)
    return "".join(w + (".\n" if i % 11 == 10 else ", " if i % 7 == 6 else " ")
                   for i, w in enumerate(out)).strip()


def frame(spark, rows, ddl="doc_id long, text string", **extra):
    """The rows, with columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, ddl)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


CLASHING = {"score": "mine", "block": 7, "ids": "x", "rank": 1, "template": "t",
            "label": "l", "hash": "h", "n_tokens": "n", "entities": "e", "length": "q"}
ODD_TEXTS = [None, "", "   \n\t ", "12 34!", "That it.", "That it.", "é", "x" * 5000,
             prose(3, 4000), "\u00a0a\u00a0b", "idiot you are.\r\nNo", "日本語 テキスト"]
ODD_ROWS = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(4, "That it."), (None, "That it."),
                                                       (None, None), (5, "other text")]

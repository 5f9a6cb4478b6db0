"""Small tables with every awkward case: nulls anywhere, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside
CLASH = "row string, id string, hits string, score double, component_id long, removed string, copies int, size long, place long"


def prose(seed: int, n: int, words: int = 400) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("abcdefghilmnoprstuv", k=rnd.randint(2, 7))) for _ in range(min(n, words)))


def awkward_rows():
    base = prose(1, 60)
    return [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (3, base + " tail", None, "b", None), (4, None, "en", "a", 0),
        (5, "", "en", None, 0), (6, " \t\n ", None, None, None), (7, "one two", "en", "b", 7), (8, "One  TWO", "en", "c", 7),
        (9, prose(9, 60), "en", "c", 1), (9, prose(9, 60), "en", "c", 1), (10, prose(10, 60), "de", "a", 2),
        (10, prose(11, 60), "de", "a", 2), (None, prose(12, 60), "fr", "b", 3), (None, None, None, None, None),
        (11, "x" * 70_000, "en", "a", 70_000), (12, " ".join(prose(s, 400) for s in range(40, 70)), "en", "b", 9),
        (13, "Ünï ćodé — 漢字 🙂 ñandú é", "es", "c", 4),
    ]


def frame(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for c in CLASH.split(", "):
            name, kind = c.split()
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df

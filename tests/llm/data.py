"""Small odd tables: nulls in any column, empty and long texts, ties, repeated rows, columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, key string, label string, text_sha256 string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def odd_rows() -> list[tuple]:
    long = prose(1, 30_000)
    base = prose(2, 200)
    near = base.split()
    near[100] = "changed"
    more = ("r", 1, "k", "l", "s")
    rows = [
        (1, base, "en", "a", 3), (2, " ".join(near), "en", "a", 4), (3, base, "en", None, 5), (3, base, "en", None, 5),
        (4, None, None, "b", None), (5, "", "en", "b", 0), (6, " \n\t", None, "b", 3), (7, long, "en", "c", None), (None, base, "en", "a", 1),
        (None, None, None, None, None), (8, "one two", "en", "a", 7), (9, "One  TWO", "en", "a", 8), (10, "éß漢字 \U0001f600", "xx", "ü", 5),
        (11, "12 34 !!", "en", "a", 8), (11, "other text with the same number", "en", "a", 8), (12, long + " end", "en", "c", 0),
    ]
    return [(*r, *more) for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(df, folder) -> str:
    path = str(folder / "table.parquet")
    df.write.parquet(path)
    return path

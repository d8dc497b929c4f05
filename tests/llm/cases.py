"""Small tables with the cases that every operator has to stand."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Columns that operators use inside, here as columns of the caller's table.
CLASHING = """_id _text _key fp key raw ids n row rest number position part score predicted items
n_words hit_starts hit_ends file at a b value cell word spans kept copies label terms n_removed
quality _html _0 anchor digest""".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(words)
    )


def rows() -> list[tuple]:
    """Nulls everywhere, empty and very long texts, ties, repeated rows, other scripts."""
    long = prose(1, 30_000)
    passage = prose(2, 120)
    texts = [
        (1, prose(3, 80)),
        (1, prose(3, 80)),  # a repeated row
        (1, prose(4, 80)),  # the same id with another text
        (2, None),
        (None, None),
        (None, prose(5, 60)),
        (None, prose(5, 60)),
        (3, ""),
        (4, " \t\n \n"),
        (5, long),
        (6, long[:90_000] + " " + prose(6, 50)),
        (7, prose(7, 40) + "\n" + passage + "\n" + prose(8, 40)),
        (8, prose(9, 30) + "\n" + passage),
        (9, "日本語のテキスト é ü ß x \U0001f600 " + prose(10, 20)),
        (10, "one"),
        (11, "One"),
        (12, "a b c a b c a b c " * 60),
        (13, "WORD!! " * 70),
        (14, prose(3, 80) + " more"),
        (15, "x\u0000y\r\nz <|endoftext|> " + prose(11, 5)),
    ]
    return [
        (i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src0", None if t is None else len(t))
        for k, (i, t) in enumerate(texts)
    ]


def edge(spark, extra: bool = True):
    df = spark.createDataFrame(rows(), DOCS).repartition(3)
    if extra:
        for name in CLASHING:
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)

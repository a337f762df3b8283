import random

import pytest

# Rows with an extra column whose name an operator uses inside, nulls, empty and blank texts, repeated rows.
WORDS = [a + b for a in ("lo", "mi", "ra", "te", "su", "ve", "no", "ka") for b in ("ren", "dal", "mot", "sil", "par", "gun", "bex", "zot")]


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(count))


@pytest.fixture(scope="session")
def documents(spark):
    base = [prose(i, 60) for i in range(12)]
    shared = prose(99, 45)
    rows = [(i, text, "xx", "s", 1) for i, text in enumerate(base)]
    rows += [
        (20, base[0], "xx", "s", 1), (21, base[0].upper(), "xx", "s", 1), (22, base[1] + " extra", "xx", "s", 1),
        (30, prose(31, 20) + " " + shared + " " + prose(32, 20), "xx", "s", 1), (31, shared + "\n" + prose(33, 10), "xx", "s", 1),
        (40, None, None, None, None), (41, "", "xx", "s", 1), (42, " \t\n", "xx", "s", 1), (43, "one", "xx", "s", 1),
        (44, "one", "xx", "s", 1), (45, "two words", "xx", "s", 1), (46, "Déjà vu — Größe ñ 日本 \U0001F600", None, "s", 1),
        (None, base[2], "xx", None, 1), (50, base[3], "xx", "s", 1), (50, base[3], "xx", "s", 1),
        (60, "same " * 200, "xx", "s", 1), (61, "same " * 90, "xx", "s", 1), (62, prose(7, 30000), "xx", "s", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def odd(documents):
    """The documents with columns named as operators name their own."""
    from pyspark.sql import functions as F

    names = ["id", "key", "score", "text_", "row", "kept", "words", "lang_pred", "ids", "tile", "gone", "twice", "n_words"]
    return documents.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("false")

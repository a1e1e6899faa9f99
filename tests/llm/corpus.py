"""Small tables with the cases that every corpus operator must take."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use for their own columns.
        T.StructField("kept", T.IntegerType()),
        T.StructField("size", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("position", T.DoubleType()),
    ]
)
_WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box five liquor jugs and sing".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(_WORDS) for _ in range(n)).capitalize() + "."


def texts(seed: int = 7) -> list[str | None]:
    rng = random.Random(seed)
    plain = ["\n".join(sentence(rng, rng.randrange(8, 20)) for _ in range(rng.randrange(2, 9))) for _ in range(20)]
    near = [plain[0] + " Extra.", plain[1].replace("fox", "cat", 1), plain[2][:-1] + "!"]
    return [
        None, "", "  \t\n", "A.", *plain, *near, plain[0], plain[0].replace(" ", "  ", 3), plain[3] + " ", None,
        " ".join(sentence(rng, 30) for _ in range(3000)),  # long
        "é" * 60 + " ß 日本 😀 " + "x" * 300, "don't we'll 's 123 <|endoftext|> token = \"abcdef123456\"",
        "Home | About | Contact | Terms\nHome | About | Contact | Terms", "### *** $$$ %%% " * 20,
    ]


def documents(spark, rows=None):
    """The texts as a table: some keys null, one row given twice, sources null and of unequal size."""
    if rows is None:
        rows = []
        for i, text in enumerate(texts()):
            source = None if i % 11 == 5 else "hot" if i % 3 == 0 else f"s{i % 4}"
            rows.append((i * 3 + 1, text, ("en", "de", None)[i % 3], source))
        rows.append(rows[6])
        rows.append((None, "A text without a key, which no other row has.", "en", "s1"))
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 0.5) for r in rows], DOCUMENTS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]

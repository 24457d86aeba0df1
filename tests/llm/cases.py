"""Small documents with the awkward cases: nulls, empty, long, tied and repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def prose(rng: random.Random, n: int, vocab: int = 400) -> str:
    words = [f"w{rng.randrange(vocab)}" for _ in range(n)]
    return " ".join(w.capitalize() if rng.random() < 0.1 else w for w in words)


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    out = [(i if i < 100 else 1000 + i, prose(rng, rng.choice([3, 10, 30, 80, 200])), rng.choice(["en", "fr"]), f"s{min(rng.randrange(6), 3)}", 0) for i in range(n)]
    long = prose(rng, 6000)
    out += [(100, long, "en", "s0", 0), (101, long, "en", "s1", 0), (102, long + " tail", "en", "s0", 0),
            (103, None, "en", "s0", None), (104, "", None, None, 0), (105, " \n\t ", "de", "s0", 0),
            (106, "one", "de", "s0", 0), (107, "one two", "xx", "s9", 0), (None, "no id here at all", "en", None, 1),
            (None, None, None, None, None), (108, "ÀÉ ßtraße ﬁ ▁x \x0b\x0c mixed\r\nline nbsp \u0001", "fr", "s0", 0),
            (109, "dup row", "en", "s0", 0), (109, "dup row", "en", "s0", 0), (110, out[5][1], "en", "s0", 0)]
    return out


def documents(spark, data=None, clash=()):
    """The rows as a table, with further columns of the names in ``clash``."""
    df = spark.createDataFrame(rows() if data is None else data, DOCS).repartition(3)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("clash") for c in clash}) if clash else df

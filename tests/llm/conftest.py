import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, size long"


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use inside."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, line = prose(60), "\n".join(prose(9) for _ in range(12))
    texts = [
        None, "", " \t\n", "one", "a b c d e f g h " * 40, prose(30), prose(400), passage, prose(20) + " " + passage + " " + prose(25), passage + " " + prose(5),
        line, "top\n" + line, line + "\nend", "x" * 5000, prose(9000), "same words " * 3, "same words " * 3, "\n\n\n\n\n", prose(13), prose(12),
        "Mail me@x.org or a@b.c.d, at 10.0.0.255 or 10.0.0.256; card 4111 1111 1111 1111, call +1 (555) 123-4567 now +12.",
        "call +1 555 0001112 ok", "call +1 555 0001113 ok", "call +1 555 0001114 ok", "call +1 555 0001115 ok", "call 555-0199-22 now",
        "Licensed under the Apache License, Version 2.0 or the MIT License. GNU General Public License v3; CC BY-NC 4.0 mit license mit license",
        "# * $ %\n# * $ %\n\n# * $ %", "😀 é漢字 " * 30,
    ]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t or ""), 0.5, i, 3) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en", "s1", 0, None, None, None), (100, texts[6] + " tail", None, "s1", None, 1.0, 1, 1), (101, texts[6], "de", "s2", 1, 1.0, 1, 1)]
    rows += [(None, "no id here at all", "en", "s1", 1, 1.0, 1, 1), (None, None, None, None, None, None, None, None), (-3, prose(50), "en", "s2", 1, 1.0, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def given(spark, hard):
    """The hard rows together with the synthetic documents."""
    real = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    for name, kind in (("score", "double"), ("row", "long"), ("size", "long")):
        real = real.withColumn(name, F.lit(None).cast(kind))
    return hard.unionByName(real).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").withColumn("doc_id", F.col("doc_id") + 1000)

import random

import pytest
from pyspark.sql import types as T

WORDS = "the of a river stone cloud and maison rouge der Hund über corazón blue green walk run 12 it's don't".split()

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    # columns with names that operators use inside
    + [T.StructField(n, T.IntegerType()) for n in ("id", "n", "key", "h", "norm", "node", "size", "words", "target", "root", "hits")]
)


def texts() -> list[tuple]:
    r = random.Random(5)
    base = [" ".join(r.choice(WORDS) for _ in range(r.randrange(6, 120))) for _ in range(30)]
    found = [None, "", " \n\t ", "one", "Two  words", "CC BY", "cc by cc by 4", "All rights reserved. Released under the MIT License.", "<|endoftext|> and <|startoftext|>x", "é é ΣΑΣ  \x1c x" * 3]
    found += base + base[:4] + [b + " tail" for b in base[:6]] + [base[0].replace(" ", "\n")]
    found.append(" ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(20000)))
    found.append("x" * 3000)
    return found


@pytest.fixture(scope="session")
def rows():
    out = []
    for i, t in enumerate(texts()):
        out.append((i * 7 % 101, t, "en", None if i % 11 == 0 else f"s{i % 4}", *[i] * 11))
    out.append(out[15])  # a repeated row
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd_ids(spark, rows):
    """Two rows without an id besides others."""
    return spark.createDataFrame([(None, *r[1:]) if k < 2 else r for k, r in enumerate(rows[:12])], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(k % 3 == 0)) for k, r in enumerate(rows)], "doc_id long, toxic int")

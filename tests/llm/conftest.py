import random

import pytest


@pytest.fixture
def frame(spark):
    """frame(rows, ddl): rows dealt over three partitions."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl).repartition(3) if rows else spark.createDataFrame([], ddl)


@pytest.fixture
def prose():
    """prose(seed, words): made-up words, the same for the same seed."""

    def make(seed, words):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(words))

    return make

"""Texts and frames for the tests of this folder."""

import pytest

WORDS = (
    "amber basin cedar delta ember fjord grove harbor island juniper kettle lagoon meadow nectar orchard pebble quarry "
    "river summit timber upland valley willow yonder zephyr anchor bridge canyon desert engine forest garden hollow"
).split()


def prose(seed: int, n: int) -> str:
    """n words, different for every seed."""
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(1000)) for _ in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text), spread over several partitions, with columns that clash with result columns."""

    def make(rows, clash=()):
        df = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string").repartition(3)
        for name in clash:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("mine"))
        return df

    return make

import pytest
from pyspark.sql import functions as F

from parcelstar.llm.workers import prepare

SCHEMA = "doc_id long, text string"
#: Names that operators use inside; a table may have them too.
CLASHING = [
    "key", "node", "n", "pos", "fp", "size", "shard", "slot", "rank", "length", "piece", "_text",
    "_words", "_n", "_c", "_gone", "_doc", "_key", "_bad_doc", "n_words", "turns", "hash", "matches",
]


@pytest.fixture(autouse=True)
def shipped(spark):
    prepare(spark)


@pytest.fixture
def docs(spark):
    def make(rows, clashing=True):
        df = spark.createDataFrame(rows, SCHEMA)
        return df.withColumns({c: F.lit(c) for c in CLASHING}) if clashing else df

    return make


def prose(n, seed=0, words=None):
    """n words that do not repeat in windows."""
    words = words or "the of and to in that it is was for on are as with his they at be this from".split()
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(words[(state >> 8) % len(words)] + str((state >> 13) % 50))
    return " ".join(out)

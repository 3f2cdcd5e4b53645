import pytest

WORDS = "the river runs past an old mill where grain was ground for bread and the miller kept careful accounts of every sack".split()


@pytest.fixture(scope="session")
def prose():
    """Different texts of made-up words, the same for the same number."""
    import random

    def make(number: int, words: int = 60) -> str:
        rng = random.Random(number)
        return " ".join(rng.choice(WORDS) + rng.choice(["", "ly", "ing", "er", "ed", "ish"]) + rng.choice("abcdefgh") for _ in range(words))

    return make


@pytest.fixture(scope="session")
def table(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(rows, ddl="doc_id long, text string"):
        extra = [(*r, 1, "x", 2.0) for r in rows]
        return spark.createDataFrame(extra, ddl + ", _row int, key string, n double")

    return make

import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source)."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, ROWS)

    return make


LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))

#: Nulls, blanks, ties, repeated rows, a very long text and odd characters.
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog and runs away into the deep dark forest where nobody lives any more"),
    (2, "the quick brown fox jumps over the lazy dog and runs away into the deep dark forest where nobody lives any more"),
    (2, "the quick brown fox jumps over the lazy dog and runs away into the deep dark forest where nobody lives any more"),
    (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "), (6, "a"), (None, "text without an id " * 8), (None, None),
    (7, LONG, None), (8, "naïve  café \U0001f600 日本語\nnaïve", "b"), (9, "x " * 500, "b"),
    (10, "call +1 (212) 555-0199 or 4111 1111 1111 1111, born 1984-02-29", "é"),
]


@pytest.fixture(scope="session")
def awkward(docs_of):
    return docs_of(*AWKWARD)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("id", "size", "score", "fingerprint", "component", "block", "name", "spans", "mixed", "times", "place", "value", "found")
    return awkward.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of((1, "x")).limit(0)

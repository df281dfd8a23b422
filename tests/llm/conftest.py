import pytest

# Columns that operators use inside; a table may have them as well.
CLASHING = ("_t", "h", "node", "n_lines", "dropped", "spans", "score", "email", "terms", "kept_text", "_rest", "label")


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with every odd case: nulls, empty, repeated, long, clashing columns."""

    def made(rows):
        plain = spark.createDataFrame(rows, "doc_id long, text string")
        return plain.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING])

    return made


@pytest.fixture(scope="session")
def odd_rows():
    long_text = " ".join(f"word{i % 977} other{i}" for i in range(40_000))
    lines = "\n".join(f"line {i % 50}" for i in range(3_000))
    return [
        (None, None), (None, "of nobody a@b.cd"), (1, ""), (2, None), (3, " \t\n "), (4, "one"),
        (5, "same words in both of these rows, all of them"), (5, "same words in both of these rows, all of them"),
        (6, long_text), (7, lines), (8, "é" * 500), (9, "\n\n\n"), (10, "."), (10, "other text of the same id"),
        (11, "x" * 70_000),
    ]

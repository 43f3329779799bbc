import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, gone int, rate string, `a.b` string"


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with all that may be odd: nulls, empties, long ones, ties, repeated rows, names that clash."""

    def make(texts):
        rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", None, 0.5, 1, "x", "y") for i, t in enumerate(texts)]
        rows += [rows[0], (None, "no id here at all", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def texts():
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    line = lambda k, n: " ".join(word[(k * 7 + i * (k % 5 + 1)) % 20] + str((k + i) % 7) for i in range(n))
    return [line(1, 40), line(1, 40).upper(), None, "", "   ", "one", line(2, 60), line(3, 3000), "x" * 30_000, "é " * 50, line(2, 60)]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

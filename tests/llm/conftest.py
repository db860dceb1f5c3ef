import pytest

LONG = "wort " * 60_000


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, a very long one, ties and repeated rows."""
    prose = "One plain sentence follows another here. It is not long, but long enough to count.\nA second line ends it."
    return [(1, prose), (1, prose), (2, prose), (3, None), (4, ""), (5, " \n\t "), (6, "x"), (None, prose + " More."),
            (None, None), (7, LONG), (8, "é" * 500), (9, "123 !!"), (10, prose.upper())]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows as documents, with further columns whose names the operators use themselves."""
    clash = ("key string, n int, size int, part int, token string, piece int, host string, rank int, shard int, slot int, "
             "hub int, score double, quality int, fingerprint string, bucket int, body string, spans string, cell_0 int")
    n = len(clash.split(","))
    rows = [(i, t, "en" if t else None, "src", len(t) if t else None, *[None] * n) for i, t in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {clash}")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("doc_id < 0")

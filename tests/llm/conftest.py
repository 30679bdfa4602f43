import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n=60):
    """Words that follow from ``seed`` alone."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 12) % len(WORDS)] + (str(x % 7) if x % 3 == 0 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text) of every awkward kind: NULLs, empty, white space, no words, very long, copies, repeated rows."""
    long_text = "\n".join(prose(i, 200) for i in range(120))
    return [
        (1, prose(1)), (2, None), (3, ""), (4, " \n\n\t"), (5, "?!"), (6, prose(1)), (7, prose(7) + "\n" + prose(8)),
        (7, prose(7) + "\n" + prose(8)), (8, long_text), (None, prose(9)), (None, None), (9, "Élan vital ÀÉ ß 汉字 😀"),
        (10, "one"), (11, prose(10, 400)), (12, prose(10, 400) + " tail"), (13, "x" * 5000),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with further columns named like those the operators make."""
    rows = [(i, t, "en" if k % 2 else None, "src", 0, "r", 1, 2, 0.5, "k", 3) for k, (i, t) in enumerate(odd_rows)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, row string, id long, th long, "
              "score double, word string, h1 long")
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

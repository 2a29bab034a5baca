import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block long, kept string, n_words string"


def documents():
    """Rows with nulls, empty, odd and long texts, copies, near-copies, shared
    passages and repeated rows."""
    r = random.Random(5)
    vocabulary = ["the", "and", "of", "to", "in"] * 8 + [
        "".join(r.choice("abdeginorstu") for _ in range(r.randint(3, 9))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(150)
    near = base.split()
    near[40] = "changed"
    near[110] = "altered"
    texts = [None, "", " \n\t ", "one", "one two three", "Ünïcode 漢字 🙂 \\ <| x", base, base, " ".join(near),
             base.replace(" ", "  \n", 30), text(30) + " " + passage + " " + text(25), passage + " " + text(200),
             text(80) + "\n" + passage, "same line here\n" * 30, "a " * 300, "### *** " * 40 + text(20),
             text(3000), "x" * 3000, *(text(r.randint(5, 120)) for _ in range(60))]
    rows = [(i, t, ("en", "fr", None)[i % 3], (None, "s1", "s2", "é", "s1", "s1")[i % 6], 0, 7, "k", "w")
            for i, t in enumerate(texts)]
    return [*rows, (None, text(50), "en", "s2", None, None, None, None), (None, None, None, None, 0, 0, "", ""),
            rows[20], rows[20]]


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

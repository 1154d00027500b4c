import random

import pytest

CLASHING = (
    "component_id string, n_lines string, score string, rate string, bucket string, h1 string, d string, "
    "spans string, tokens string, ids string, w string, component string, y string, __id string, __doc string, "
    "__score string, half string, copies string, __range string, weight string, rank string"
)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(20_000))


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text), with columns whose names clash with the operators' own."""

    def build(rows):
        full = [(i, t, "en", "s", len(t or ""), *["x"] * (CLASHING.count(",") + 1)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null id, repeated rows, ties, a very long text."""
    return [
        (1, None), (2, ""), (3, "  \n\t "), (None, "no id here"), (4, "same text twice"), (4, "same text twice"),
        (5, "a b c d e f g"), (6, "a b c d e f g"), (7, LONG), (8, LONG + " end"), (9, "ÄÖ é 🙂 中文\nsame text twice"),
    ]


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(12)] + [(4, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def prose():
    """A reproducible text of made-up words."""

    def build(seed, words=120):
        chance = random.Random(seed)
        return " ".join("".join(chance.choices("abcdefgh", k=4)) for _ in range(words))

    return build

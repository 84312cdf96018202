import random

import pytest

CLASHING = "kept boolean, spans string, bands int, th int, digest string, size int, bin int, mask int, piece int, label string, n int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """A small table with every odd case: nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    rng = random.Random(5)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "été", "Straße", "naïve", "😀", "x1", "of", "the"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(n))
    base = prose(120)
    near = base.split()
    near[7] = "changed"
    passage = "this passage of well over fifty bytes is shared by several documents of the table"
    rows = [
        (1, base, "b"), (2, base, "b"), (3, " ".join(near), "a"), (4, None, None), (5, "", "a"), (6, " \n\t ", None), (7, "one", "b"), (8, "One", "b"),
        (None, base, "a"), (None, None, None), (9, prose(30_000), "c"), (10, "Atouou " * 3000, "c"), (11, prose(60) + " " + passage + " " + prose(40), "a"),
        (12, passage, "b"), (13, prose(20) + passage + prose(70), "b"), (14, "a" * 49, "c"), (15, "a" * 50, "c"), (16, "a" * 120, "c"), (17, "é" * 40, "a"),
        (18, prose(80), "a"), (18, prose(80), "a"), (19, base, "c"), (19, base, "c"), (20, "tail\x00\x00 of a text with zero bytes " * 4, "d"),
        (21, "nul\x00\x00 of a text with zero bytes " * 4, "d"), (22, "gnu general public license mit license mit license", None),
    ]
    rows += [(100 + i, prose(rng.randint(1, 90)), rng.choice("abcde")) for i in range(60)]
    data = [(i, t, "xx", s, None if t is None else len(t), True, "x", 1, 2, "d", 3, 4, 5, 6, "l", 7) for i, t, s in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING).repartition(4)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


def collected(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="session")
def rows_of():
    return collected

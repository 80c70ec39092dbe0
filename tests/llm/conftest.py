import random

import pytest

WORDS = "oak elm ash fir yew pine lime birch alder beech cedar larch maple rowan aspen hazel holly".split()


@pytest.fixture
def documents():
    """(doc_id, text) rows with copies, near copies, shared passages, nulls, empty, long and odd texts."""
    rnd = random.Random(11)
    bases = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 120))) for _ in range(10)]
    passage = " ".join(rnd.choice(WORDS) for _ in range(60))
    rows: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \n\t"), (3, "a" * 300), (4, "é" * 120), (5, "Straße, 漢字 İ ﬁn.")]
    for doc in range(6, 160):
        words = rnd.choice(bases).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS) + rnd.choice("xyz")
        text = " ".join(words)
        if rnd.random() < 0.2:
            text = f"{text[: len(text) // 2]}\n{passage}\n{text[len(text) // 2 :]}"
        rows.append((doc, text.upper() if doc % 9 == 0 else text))
    rows.append((160, " ".join(rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(20_000)) + " " + passage))
    return rows


@pytest.fixture
def frame(spark):
    """A frame of (doc_id, text) rows with a column more, whose name some operator uses."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.selectExpr("*", "'x' AS part", "1 AS bucket", "2 AS start", "'y' AS term", "'z' AS words", "3 AS doc")

    return make

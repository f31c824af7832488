import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, score double, digest string, row long, "
          "label long, region long, gone long")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with other columns whose names operators use themselves."""
    def make(rows, parts=3):
        full = [(i, t, "en", 0.5, "d", 1, 2, 3, i) for i, t in rows]
        frame = spark.createDataFrame(full, SCHEMA)
        return frame.repartition(parts) if rows else frame
    return make


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text) with nulls, empty and long texts, ties and repeated rows."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "über", "naïve", "x"]
    rows = [(None, "a b c d"), (None, None), (1, None), (2, ""), (3, "  \n\t "), (4, "One word"),
            (5, "one  WORD"), (6, "One word"), (6, "One word"), (7, "One\tword"),
            (8, " ".join(r.choice(words) for _ in range(30_000))), (9, "x" * 50_000),
            (10, "   non breaking"), (11, "ends with nul \x00 inside")]
    for i in range(20, 60):
        rows.append((i, " ".join(r.choice(words) for _ in range(r.randrange(0, 60)))))
    return rows

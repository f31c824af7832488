"""Stages decide about rows, also where ids are null or repeat."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def prose():
    r = random.Random(6)
    return lambda: " ".join(f"w{r.randrange(5000)}" for _ in range(80))


def run(spark, tmp_path, stage, rows):
    path = f"{tmp_path}/given"
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA) \
        .repartition(3).write.parquet(path)
    out = stage(spark, spark.read.parquet(path), str(tmp_path))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted(((x.doc_id, x.text) for x in out.collect()), key=repr)


def test_near_copies_of_null_and_repeated_ids(spark, tmp_path, prose):
    a, b, c, d, e, f, g = (prose() for _ in range(7))
    rows = [(None, a), (None, a + " more"), (None, b), (5, c), (5, c + " more"),
            (8, d), (7, d + " more"), (3, e), (3, f), (None, g), (9, g + " more"),
            (None, None), (3, "")]
    found = run(spark, tmp_path, corpus_pipeline.near_copies, rows)
    for text, i in ((a, None), (c, 5)):  # equal ids: one of the two, whichever
        assert len({(i, text), (i, text + " more")} & set(found)) == 1
    rest = [x for x in found if not (x[1] or "").startswith((a, c))]
    assert rest == sorted([(None, b), (7, d + " more"), (3, e), (3, f), (9, g + " more"),
                           (None, None), (3, "")], key=repr)
    assert len(found) == 9


def test_benchmark_texts_of_null_and_repeated_ids(spark, tmp_path, prose):
    item = "one sentence of the benchmark that no clean document should ever hold"
    spark.createDataFrame([(1, item)], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, prose()), (None, prose()), (4, prose()), (5, prose()), (None, None)]
    held = [(None, f"{prose()} {item}"), (4, f"{item} {prose()}"), (6, item)]
    found = run(spark, tmp_path, corpus_pipeline.benchmark_texts, held + clean)
    assert found == sorted(clean, key=repr)

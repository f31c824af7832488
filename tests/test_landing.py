import pytest
from pyspark.sql import functions as F

from tidecast.operators import reports
from tidecast.sources import landing, sinks


def load(spark, *rows):
    return spark.createDataFrame(rows, "series string, year int, value double")


def found(spark, folder, records):
    back = landing.landed_records(spark, folder, records.schema)
    return sorted(((r.series, r.year, r.value, r.batch) for r in back.collect()), key=repr)


def test_a_killed_load_is_run_again(spark, tmp_path):
    folder, keys = str(tmp_path), ("series", "year")
    first = load(spark, ("a", 1, 1.0), ("a", 1, 2.0), (None, 1, 3.0))
    assert {(r.series, r.n_rows) for r in landing.land(first, folder, "1", keys).collect()} == {
        ("a", 2), (None, 1)}
    more = first.union(load(spark, ("a", 2, 4.0), ("b", 1, 5.0)))
    whole = [("a", 1, 1.0, "1"), ("a", 1, 2.0, "1"), ("a", 2, 4.0, "2"), ("b", 1, 5.0, "2"),
             (None, 1, 3.0, "1")]
    landing.write_records(more, folder, "2")  # killed after its records
    assert found(spark, folder, first) == [r for r in whole if r[3] == "1"]
    more.groupBy(*keys).count().withColumnRenamed("count", "n_rows").write.parquet(
        f"{folder}/units/batch=2")  # killed before its commit
    assert landing.ledger(spark, folder, first.schema, keys).count() == 2
    for _ in range(2):
        landing.land(more, folder, "2", keys)
        assert found(spark, folder, first) == sorted(whole, key=repr)
    # A committed batch stays, whatever comes under its name; a new one has only what is new.
    landing.land(load(spark, ("c", 1, 6.0)), folder, "2", keys)
    assert found(spark, folder, first) == sorted(whole, key=repr)
    landing.land(more, folder, "3", keys)
    assert found(spark, folder, first) == sorted(whole, key=repr)
    assert landing.committed(spark, folder).count() == 3


def test_nothing_landed_and_names(spark, tmp_path):
    empty = load(spark)
    assert found(spark, str(tmp_path), empty) == []
    assert landing.land(empty, str(tmp_path), "x").collect() == []
    with pytest.raises(ValueError):
        landing.land(empty, str(tmp_path), "a/b")


def test_order_certificate_finds_breaks(spark, tmp_path):
    days = spark.range(40).select(
        F.lit("M").alias("Model"), F.format_string("s%02d", F.col("id")).alias("Ticker"),
        F.lit("2024-01-02").alias("Date"), F.lit(1.0).alias("Actual"), F.lit(1.0).alias("Predicted"))
    columns = ["Ticker", "Date", "Actual", "Predicted", "Model"]
    def checked(name, frame):
        path = str(tmp_path / name)
        frame.select(columns).write.csv(path, header=True)
        rows = sinks.order_certificate(spark, path).orderBy("file").collect()
        return [r.n_rows for r in rows], sum(r.n_breaks for r in rows), rows
    sizes, breaks, rows = checked("ordered", days.repartitionByRange(4, "Ticker")
                                  .sortWithinPartitions("Ticker"))
    assert sum(sizes) == 40 and len(sizes) == 4 and breaks == 0
    assert rows[0]["first"].series == "s00" and rows[-1]["last"].series == "s39"
    # parts in reverse: sorted each, three boundaries crossed
    reverse = days.repartitionByRange(4, F.desc("Ticker")).sortWithinPartitions("Ticker")
    assert checked("parts", reverse)[1] == 3
    within = days.coalesce(1).orderBy(F.col("Ticker") == "s05", "Ticker").coalesce(1)
    assert checked("inside", within)[1] == 1


def test_ranked_matrix_has_gaps_and_ties(spark):
    metrics = spark.createDataFrame(
        [("a", "X", 1.0, 2.0, None, 0.5), ("a", "Y", 3.0, 1.0, 4.0, 0.1),
         ("b", "W", 1.0, 2.0, 3.0, 0.0)],
        "series string, model string, mae double, rmse double, mape double, r2 double")
    rows = {r.series: r for r in reports.metric_matrix_ranked(metrics).collect()}
    assert rows["a"].models == rows["b"].models == reports.model_order(metrics) == ["Y", "W", "X"]
    assert rows["a"].rmse == [1.0, None, 2.0] and rows["a"].mape == [4.0, None, None]
    assert rows["b"].mae == [None, 1.0, None]

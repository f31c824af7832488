import datetime as dt

from tidecast.functions import text


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clean_number(spark):
    values = ["22,600", "-950", "1,450", "N/A", "", None, "113,197.70", " 7 ", "5d", "-"]
    assert column(spark, values, text.clean_number("c")) == [
        22600.0, -950.0, 1450.0, None, None, None, 113197.7, 7.0, None, None]


def test_parse_day(spark):
    values = ["05/01/2026", "5/1/2026", "31/02/2026", "2026-01-05", None]
    day = dt.date(2026, 1, 5)
    assert column(spark, values, text.parse_day("c")) == [day, day, None, None, None]


def test_lenient_day(spark):
    values = ["5/1/2026", "2026-01-05", "05-01-2026", "soon"]
    day = dt.date(2026, 1, 5)
    assert column(spark, values, text.parse_day_lenient("c")) == [day, day, day, None]


def test_iso_both_ways(spark):
    assert column(spark, ["2026-01-05", "05/01/2026"], text.parse_iso("c")) == [
        dt.date(2026, 1, 5), None]
    assert column(spark, ["2026-01-05"], text.iso_text(text.parse_iso("c"))) == ["2026-01-05"]


def test_year_part(spark):
    assert column(spark, ["02/01/2018", "2018"], text.year_part("c")) == ["2018", None]


def test_mark_missing_only_first_run(spark):
    values = [" a ", "#####", "##########", "x ##### y #####", "\n 1 \t"]
    assert column(spark, values, text.mark_missing("c")) == [
        "a", "N/A", "N/A#####", "x N/A y #####", "1"]


def test_plain_text(spark):
    assert column(spark, ["<b>a &amp; b</b> &lt;c&gt;"], text.plain_text("c")) == ["a & b <c>"]

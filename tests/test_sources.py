import bz2
import datetime as dt
import gzip
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidecast.plans import queries
from tidecast.sources import csv_scan, ingest, pages, sinks
from tidecast.sources.schema import MIN_ROWS, RAW_COLUMNS

HEADER = ",".join(RAW_COLUMNS)


def record(no, date, ticker, close):
    cells = {"No": str(no), "Date": date, "Ticker": ticker, "Close_price": f'"{close}"'}
    return ",".join(cells.get(c, "0") for c in RAW_COLUMNS)


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def folder(tmp_path):
    write(tmp_path, "AAA_2018_2026.csv", HEADER,
          record(1, "02/01/2026", "AAA", "22,600"), record(2, "01/01/2026", "AAA", "N/A"))
    write(tmp_path, "BBB_2018_2026.csv", HEADER, record(1, "3/1/2026", "BBB", "1,450"))
    (tmp_path / "results").mkdir()
    write(tmp_path / "results", "metrics.csv", "Ticker,Model", "AAA,GBT")
    return tmp_path


def test_uniform_scan(spark, folder):
    raw = csv_scan.read_raw(spark, str(folder))
    assert raw.columns == RAW_COLUMNS and raw.count() == 3
    rows = csv_scan.raw_to_series(raw).orderBy("series").collect()
    assert [(r.series, r.date, r.value) for r in rows] == [
        ("AAA", dt.date(2026, 1, 2), 22600.0), ("BBB", dt.date(2026, 1, 3), 1450.0)]


def test_scan_by_name_over_different_headers(spark, folder):
    write(folder, "CCC.csv", "Close_price,Date,Ticker,Note", '"7,000",05/01/2026,CCC,late')
    (folder / "zero.csv").write_text("")
    (folder / "empty.csv").write_text("\n")
    (folder / "broken.csv").write_bytes(b"\xff\xfe\x00bad\xff\n1,2\n")
    raw = csv_scan.scan_files(spark, str(folder))
    assert set(raw.columns) == {*RAW_COLUMNS, "Note"}
    rows = {r.Ticker: r for r in raw.collect()}
    assert len(rows) == 3 and raw.count() == 4
    assert rows["CCC"].Close_price == "7,000" and rows["CCC"].Note == "late"
    assert rows["CCC"].Market_cap is None and rows["AAA"].Note is None
    assert csv_scan.raw_to_series(raw).count() == 3
    status = csv_scan.file_status(spark, str(folder)).collect()
    assert sorted(r.status for r in status) == ["empty", "ok", "ok", "ok", "unreadable"]


def test_scan_of_one_header(spark, folder):
    assert csv_scan.scan_files(spark, str(folder)).count() == 3


@pytest.mark.parametrize("more", [False, True])
def test_odd_files_read_alike_beside_one_header_or_two(spark, folder, more):
    write(folder, "x#1 a%20b.csv", HEADER, record(1, "04/01/2026", "HASH", "5"))
    write(folder, "blank.csv", "", "  ", HEADER, record(1, "05/01/2026", "LATE", "6"))
    (folder / "bom.csv").write_bytes(
        b"\xef\xbb\xbf" + f"{HEADER}\r\n{record(1, '06/01/2026', 'BOM', '7')}\r\n".encode())
    (folder / "broken.csv").write_bytes(b"\xff\xfe\x00bad\xff\n1,2\n")
    (folder / "torn.csv.gz").write_bytes(b"\x1f\x8b\x08\x00not gzip at all")
    if more:
        write(folder, "other.csv", 'Ticker,"Close, ""net""",Date', "OTHER,1,07/01/2026")
    raw = csv_scan.scan_files(spark, str(folder), "*.csv*")
    tickers = {"AAA", "BBB", "HASH", "LATE", "BOM"} | ({"OTHER"} if more else set())
    assert {r.Ticker for r in raw.collect()} == tickers
    status = {r.file_path.rsplit("/", 1)[1]: r.status
              for r in csv_scan.file_status(spark, str(folder), "*.csv*").collect()}
    assert status["broken.csv"] == status["torn.csv.gz"] == "unreadable"
    assert ('Close, "net"' in raw.columns) == more


def test_a_compressed_file_cut_off_is_left_out_as_a_whole(spark, folder):
    r = random.Random(2)
    lines = [HEADER] + [record(i, "04/01/2026", "LONG", r.randrange(10 ** 9)) for i in range(40_000)]
    packed = gzip.compress("\n".join(lines).encode())
    (folder / "whole.csv.gz").write_bytes(packed)
    (folder / "cut #1 a%20b.csv.gz").write_bytes(packed[:len(packed) // 2])
    flipped = bytearray(packed)
    flipped[-6] ^= 1  # in the checksum or the length
    (folder / "flipped.csv.gz").write_bytes(bytes(flipped))
    raw = csv_scan.scan_files(spark, str(folder), "*.csv*")
    assert dict(raw.groupBy("Ticker").count().collect()) == {"AAA": 2, "BBB": 1, "LONG": 40_000}
    status = {r.file_path.rsplit("/", 1)[1]: (r.status, r.error)
              for r in csv_scan.file_status(spark, str(folder), "*.csv*").collect()}
    assert status.pop("whole.csv.gz") == ("ok", None)
    broken = [v for k, v in status.items() if k.endswith(".gz")]
    assert broken == [("unreadable", "not readable to its end")] * 2


def test_many_torn_files_are_found_in_one_pass(spark, folder, monkeypatch):
    """Each status is written once, whatever number of files is broken."""
    whole = gzip.compress(f"{HEADER}\n{record(1, '04/01/2026', 'Z', '5')}\n".encode() * 200)
    for i in range(20):
        (folder / f"cut{i}.csv.gz").write_bytes(whole[:-1 - i])
    two = gzip.compress(f"{HEADER}\n".encode()) + gzip.compress(
        (record(1, "04/01/2026", "TWO", "5") + "\n").encode())
    (folder / "two.csv.gz").write_bytes(two)
    (folder / "cut.csv.bz2").write_bytes(bz2.compress(whole * 3)[:-4])
    (folder / "ok.csv.bz2").write_bytes(
        bz2.compress(f"{HEADER}\n{record(1, '04/01/2026', 'BZ', '5')}\n".encode()))
    writes = []
    inner = csv_scan._until_whole
    monkeypatch.setattr(csv_scan, "_until_whole", lambda spark, location, write: inner(
        spark, location, lambda torn: (writes.append(len(torn)), write(torn))))
    raw = csv_scan.scan_files(spark, str(folder), "*.csv*")
    assert writes == [21]
    assert dict(raw.groupBy("Ticker").count().collect()) == {"AAA": 2, "BBB": 1, "TWO": 1, "BZ": 1}


def test_repeated_names_are_numbered(spark, tmp_path):
    write(tmp_path, "a.csv", "Ticker,Close,Close,Close_2,Close", "A,1,2,3,4")
    write(tmp_path, "b.csv", "Close,Ticker", "5,B")
    raw = csv_scan.scan_files(spark, str(tmp_path))
    rows = {r.Ticker: r.asDict() for r in raw.collect()}
    assert rows["A"] == {"Ticker": "A", "Close": "1", "Close_3": "2", "Close_2": "3", "Close_4": "4"}
    assert rows["B"] == {"Ticker": "B", "Close": "5", "Close_3": None, "Close_2": None,
                         "Close_4": None}


def test_rows_of_every_piece_meet_the_header(spark, folder, monkeypatch):
    monkeypatch.setattr(csv_scan, "PIECE", 1000)
    write(folder, "long.csv", HEADER, *[record(i, "04/01/2026", "LONG", i) for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = csv_scan.scan_files(spark, str(folder))
        assert raw.where("Ticker = 'LONG'").agg(F.sum("Close_price"), F.count("*")).first() == (
            4999 * 2500, 5000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wide_header_and_many_headers(spark, tmp_path):
    names = [f"column_{i:03d}_{'x' * 400}" for i in range(180)]
    assert len(",".join(names)) > 65536
    write(tmp_path, "wide.csv", ",".join(names), ",".join(map(str, range(180))))
    row = csv_scan.scan_files(spark, str(tmp_path)).select(names[0], names[-1]).first()
    assert tuple(row) == ("0", "179")
    (tmp_path / "many").mkdir()
    for i, names in enumerate(itertools.islice(itertools.permutations("abcdefg"), 1001)):
        write(tmp_path / "many", f"{i}.csv", ",".join(names), ",".join(f"{n}{i}" for n in names))
    many = csv_scan.scan_files(spark, str(tmp_path / "many"))
    assert sorted(many.columns) == list("abcdefg")
    assert many.agg(*[F.count_if(F.col(c).startswith(c)) for c in "abcdefg"]).first() == (1001,) * 7


def test_no_readable_file_is_an_error(spark, tmp_path):
    (tmp_path / "broken.csv").write_bytes(b"\xff\xfe\x00bad\xff\n1,2\n")
    with pytest.raises(ValueError, match="unreadable"):
        csv_scan.scan_files(spark, str(tmp_path))


def test_scan_of_nothing(spark, tmp_path):
    out = csv_scan.scan_files(spark, str(tmp_path))
    assert out.columns == RAW_COLUMNS and out.count() == 0


def test_columns_are_cleaned_only_where_present(spark):
    df = spark.createDataFrame([("1,000", "x,y")], "Close_price string, Other string")
    row = csv_scan.clean_columns(df).first()
    assert (row.Close_price, row.Other) == (1000.0, "x,y")


def test_typed_records(spark, folder):
    row = csv_scan.typed_records(csv_scan.read_raw(spark, str(folder))).filter(
        "Ticker = 'BBB'").first()
    assert (row.No, row.Date, row.Close_price, row.Total_volume) == (
        1, dt.date(2026, 1, 3), 1450.0, 0.0)


def test_upload_without_series_name(spark):
    df = spark.createDataFrame(
        [("2026-01-05", "1,000"), ("6/1/2026", "2"), ("soon", "3"), ("7/1/2026", None)],
        "Date string, Close_price string")
    rows = csv_scan.upload_to_series(df).orderBy("date").collect()
    assert [(r.series, r.date.day, r.value) for r in rows] == [
        ("upload", 5, 1000.0), ("upload", 6, 2.0)]
    with pytest.raises(ValueError):
        csv_scan.upload_to_series(df.drop("Date"))


def test_file_keys(spark, folder, tmp_path):
    raw = csv_scan.read_raw(spark, str(folder))
    keyed = csv_scan.with_file_key(raw).filter("Ticker = 'AAA'").first()
    assert (keyed.file_series, keyed.year_from, keyed.year_to) == ("AAA", 2018, 2026)
    out = str(tmp_path / "written")
    csv_scan.write_raw(raw, out, 2018, 2026)
    back = csv_scan.read_written(spark, out)
    assert {(r.Ticker, r.file_series) for r in back.collect()} == {
        ("AAA", "AAA"), ("BBB", "BBB")}
    assert back.count() == 3


def test_ingest_steps(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "s string, n int")
    assert ingest.drop_exact_duplicates(df).count() == 2
    units = spark.createDataFrame([("a", 2018, 2026), ("b", 2018, 2026)],
                                  "series string, year_from int, year_to int")
    left = ingest.not_yet_landed(units, units.filter("series = 'a'"))
    assert [r.series for r in left.collect()] == ["b"]
    lengths = spark.createDataFrame([("a", 30, "accepted"), ("b", 3, "rejected")],
                                    "series string, total long, status string")
    status = ingest.ingest_status(lengths)
    assert {r.series: r.reason for r in status.collect()} == {"a": None, "b": "only 3 rows"}
    assert {r.status: r.units for r in ingest.ingest_summary(status).collect()} == {
        "ok": 1, "failed": 1}
    assert MIN_ROWS == 20


def test_file_status_becomes_an_ingest_report(spark, folder):
    (folder / "CCC_2018_2026.csv").write_bytes(b"\xff\xfe\x00bad\xff\n1,2\n")
    status = ingest.files_status(csv_scan.file_status(spark, str(folder)))
    assert {r.unit: r.status for r in status.collect()} == {
        "AAA_2018_2026": "ok", "BBB_2018_2026": "ok", "CCC_2018_2026": "failed"}
    assert [(r.unit, r.reason) for r in ingest.failed_units(status).collect()] == [
        ("CCC_2018_2026", "unreadable: header isn't UTF-8")]
    assert {r.status: (r.units, r.first_unit) for r in
            ingest.ingest_summary(status).collect()} == {
        "ok": (2, "AAA_2018_2026"), "failed": (1, "CCC_2018_2026")}


def cells(n, first="<b>1</b>"):
    return "".join(f"<td class='x'> {first if i == 0 else i} </td>" for i in range(n))


def test_table_rows_need_eighteen_cells(spark):
    marked = cells(18).replace("> 5 <", ">##########<").replace("> 6 <", "> a &amp; b\n<")
    html = "<table>" + "".join(f"<TR id=r>{c}</TR>" for c in (cells(17), marked, cells(19)))
    df = spark.createDataFrame([(1, html + "</table>"), (2, "no table"), (3, None)],
                               "page_id int, html string")
    rows = pages.page_rows(df).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.page_id, row.row_no, row.No, row.Date) == (1, 1, "1", "1")
    assert (row.Close_price, row.Highest_price) == ("N/A#####", "a & b")


def test_source_urls(make_series):
    out = pages.source_urls(make_series(a=[1, 2]), "https://data.example.com/%s/x").collect()
    assert [(r.series, r.url) for r in out] == [("a", "https://data.example.com/a/x")]


def test_metrics_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "GBT", 1.0, 2.0, None, 0.5)],
                               "series string, model string, mae double, rmse double, "
                               "mape double, r2 double")
    sinks.write_metrics(df, str(tmp_path))
    back = sinks.read_metrics(spark, str(tmp_path))
    assert back.collect() == df.collect()
    assert back.filter(F.col("mape").isNull()).count() == 1


@pytest.fixture
def line_items(spark, tmp_path):
    items = [(i, 7, 1 + i % 3, 1, 2.0, 1234.5 + i, 0.1, 0.02,
              dt.datetime(2019 + i % 4, 1, 1 + i % 20)) for i in range(200)]
    spark.createDataFrame(
        items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        "l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


DAYS = {(i % 3, i % 4, i % 20) for i in range(200)}


def test_round_trip_moves_text_once(spark, line_items, monkeypatch):
    """records are placed by ticker as numbers, and their files are compressed."""
    calls, write_raw = [], csv_scan.write_raw
    monkeypatch.setattr(csv_scan, "write_raw", lambda raw, path, *more, **kinds: (
        calls.append((raw, path)), write_raw(raw, path, *more, **kinds)))
    out = queries.csv_round_trip(spark, line_items).collect()
    assert {(r.file_series, r.year_from, r.year_to) for r in out} == {
        (str(s), 2019, 2022) for s in (1, 2, 3)}
    assert sum(r.n_rows for r in out) == len(DAYS)
    raw, path = calls[0]
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    # the placement lies under the text, so that the window adds none of its own
    assert plan.index("format_number") < plan.index("RepartitionByExpression [Ticker")
    files = spark.read.format("binaryFile").load(f"{path}/bucket=*/*.csv*").select("path")
    assert all(f.path.endswith(".csv.snappy") for f in files.collect())


def test_mixed_headers_are_read_once_for_their_rows(spark, line_items):
    """sums and averages come from one scan."""
    out = queries.scan_mixed_headers(spark, line_items)
    assert out._jdf.queryExecution().optimizedPlan().toString().count(" csv") == 1
    assert {(r.series, r.Note, r.averages) for r in out.collect()} == {
        (str(s), "of 2" if s == 2 else None, 0 if s == 2 else sum(k + 1 == s for k, _, _ in DAYS))
        for s in (1, 2, 3)}


def test_a_load_of_many_files_arrives_in_parts(spark, tmp_path, monkeypatch):
    """The driver lists few files at a time, in few tasks; the status has all, as in one part."""
    from tidecast.plans import queries
    day = dt.date(2024, 5, 6)
    spark.createDataFrame([(i * 10, 1, i % 40, day, 5.0) for i in range(80)],
                          "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate date, "
                          "l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, -1.0 if i % 4 == 0 else 2.0) for i in range(40)],
                          "s_suppkey long, s_acctbal double").write.parquet(
        f"{tmp_path}/supplier.parquet")
    seen, inner = [], csv_scan.file_status

    def status(*given):
        found = inner(*given)
        seen.append(found.count())
        return found
    monkeypatch.setattr(csv_scan, "file_status", status)
    rows = []
    for most in (1000, 9):
        monkeypatch.setattr(queries, "UNITS_AT_ONCE", most)
        rows.append(sorted(map(tuple, queries.ingest_files(spark, str(tmp_path)).collect()), key=str))
    assert rows[0] == rows[1] and len(rows[0]) == 40
    assert sum(r[1] == "failed" for r in rows[0]) == 10
    assert seen[0] == 40 and len(seen) > 3 and max(seen[1:]) < 20 and sum(seen[1:]) == 40
    cost = "spark.sql.files.openCostInBytes"
    kept = spark.conf.get(cost)
    with csv_scan._many_files(spark):
        assert int(spark.conf.get(cost)) == csv_scan.MANY_FILES[cost]
    assert spark.conf.get(cost) == kept
